import random
import re

import pytest

from hoptally.llm import substring
from hoptally.llm.substring import PRODUCTION, substring_dedup, without_repeats

PASSAGE = " ".join(f"Here sentence number {n} of the passage has nine words." for n in "one two three four five six".split())


def own(k, n=4):
    return " ".join(f"Only document {k} says this in line {i} and {k * 7 + i}." for i in range(n))


def test_passages(spark):
    rows = [(0, own(0) + " " + PASSAGE + " " + own(90)), (-2, " \n\t "), (-2, " \n\t "), (1, own(1) + "\n" + PASSAGE + "\n" + own(91)), (2, own(2) + " and so " + PASSAGE), (3, own(3)), (4, PASSAGE), (5, None), (6, ""), (None, own(5) + " " + PASSAGE),
            (7, own(3, 2)), (8, "Of. In. The. It was."), (9, "Of. In. The. It was."), (10, "a " * 50_000 + own(11))]
    docs = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, pos string")
    out = {r["doc_id"]: r for r in substring_dedup(docs).collect()}
    assert out[0]["text"] == rows[0][1]  # the first keeps it
    assert out[1]["text"] == own(1) + "\n" + own(91)
    for i in (2, None):
        assert PASSAGE not in out[i]["text"] and out[i]["removed_words"] >= 50
    assert out[4]["text"] == "" and out[4]["removed_spans"] == 1
    assert out[3]["text"] == own(3) and out[8]["text"] == dict(rows)[8]
    assert out[7]["text"] == own(3, 2)  # fewer sentences than a run
    assert out[9]["text"] == "" and out[9]["removed_words"] == 5  # four short sentences, but a run
    assert out[-2]["text"] == " \n\t "
    kept = {r["doc_id"]: r for r in substring_dedup(docs, least_words=6).collect()}
    assert kept[9]["text"] == dict(rows)[9] and kept[4]["text"] == ""
    assert out[5]["text"] == out[6]["text"] == ""
    left = without_repeats(docs)
    assert left.columns == docs.columns and 4 not in {r["doc_id"] for r in left.collect()}
    assert substring_dedup(docs.limit(0)).count() == 0


def test_copies(spark):
    docs = spark.createDataFrame([(2, PASSAGE), (1, PASSAGE), (1, PASSAGE)], "doc_id long, text string")
    out = sorted((r["doc_id"], r["text"]) for r in substring_dedup(docs).collect())
    assert out == [(1, PASSAGE), (1, PASSAGE), (2, "")]  # alike rows are one document; the least id is first


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Der alte Mann sah den Hund im Garten und die Katze auf dem Dach.", 1),
        ("We met John Smith in New York City yesterday. It was fine.", 2),
        ("Dr. Smith (of the U.S.) met J. Doe. Then he left!", 2),
        ("Er sagte: „Komm!“ Dann ging er z.B. nach Hause. \"Gut.\" Ende", 4),
        ("¿Qué? ¡No! Está bien… Sí.", 4),
        ("A heading\nA line without an end\n\nAnd another one.", 3),
        ("", 0),
        (" \n ", 0),
    ],
)
def test_sentences(text, want):
    import pyarrow as pa

    assert len(substring.sentences(substring.words_of(pa.array([text])))[0]) == want


def brute_force(rows, run, least_words):
    """All runs of all documents in a dictionary."""
    split = {}
    for i, t in rows:
        out, cur = [], []
        for line in (t or "").split("\n"):
            for w in re.findall(r"[^\x20\x09-\x0D]+", line):
                cur.append(w)
                if substring._ends(w):
                    out, cur = [*out, cur], []
            if cur:
                out, cur = [*out, cur], []
        split[i, t] = out
    first = {}
    for (i, t), s in sorted(split.items(), key=lambda x: (2**63 if x[0][0] is None else x[0][0], 0)):
        for k in range(len(s) - run + 1):
            first.setdefault(tuple(map(tuple, s[k : k + run])), (i, t, k))
    removed = {}
    for (i, t), s in split.items():
        covered = [False] * len(s)
        for k in range(len(s) - run + 1):
            if first[tuple(map(tuple, s[k : k + run]))] != (i, t, k):
                covered[k : k + run] = [True] * run
        total, k = 0, 0
        while k < len(s):
            j = k
            while j < len(s) and covered[j] == covered[k]:
                j += 1
            words = sum(map(len, s[k:j]))
            total += words if covered[k] and words >= least_words else 0
            k = j
        removed[i] = total
    return removed


@pytest.mark.parametrize(("run", "least_words"), [(3, 0), (2, 0), (2, 15)])
def test_against_brute_force(spark, run, least_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len({i for i, _ in rows}) == len(rows)
    got = {r["doc_id"]: r["removed_words"] for r in substring_dedup(docs, run, least_words).collect()}
    assert got == brute_force(rows, run, least_words)
    assert sum(got.values()) > 100


def test_hot_runs_over_many_slices(spark, monkeypatch):
    """Runs that many slices of a task hold: the same result, and about one place a task is handed on."""
    monkeypatch.setattr(substring, "slices", lambda batches, column: (b.slice(k, 20) for b in batches for k in range(0, b.num_rows, 20)))
    rows = [(997 * k % 1000, f"Own text number {k} is here. " + (PASSAGE if k % 3 else f"Nothing {k}. Of that {k}. In here {k}.")) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["removed_words"] for r in substring_dedup(docs).collect()}
    assert got == brute_force(rows, 3, 0)


def test_passages_of_over_50_words_go(spark):
    """What earlier documents hold word for word, over 50 words, is found unless it has fewer whole sentences than a run."""
    rows = [(r["doc_id"], (r["text"] or "").split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    first, later = {}, {}
    for i, w in sorted(rows):
        for k in range(len(w) - 50):
            x = hash(tuple(w[k : k + 51]))
            if first.setdefault(x, i) != i:
                later.setdefault(i, set()).update(range(k, k + 51))
    out = {r["doc_id"]: r["removed_words"] for r in substring_dedup(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), **PRODUCTION).collect()}
    assert len(later) > 50
    assert sum(out[i] > 0 for i in later) >= 0.93 * len(later)
    assert sum(out[i] >= len(x) / 2 for i, x in later.items()) >= 0.88 * len(later)


def test_passages_with_fewer_sentences_than_a_run(spark):
    """51 words that an earlier document holds, inside of sentences on both sides or of one word again and again: 38 go at least, and none but those."""
    rng = random.Random(3)
    made = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [made(51) for _ in range(40)] + [made(20) + ["End."] + made(30), ["the"] * 51, ["a", "b", "c"] * 17]
    rows = []
    for k, x in enumerate(passages):
        rows += [(k, " ".join(made(rng.randrange(30)) + x + made(9))), (100 + k, " ".join(made(k) + x + made(60 - k)))]
    rows += [(200, " ".join(passages[0][:37])), (201, " ".join(passages[1][:37])), (202, "x " * 151), (203, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in substring_dedup(docs, **PRODUCTION).collect()}
    for k, x in enumerate(passages):
        assert out[k]["removed_words"] == 0
        assert 38 <= out[100 + k]["removed_words"] <= 51
        assert set(dict(rows)[100 + k].split()) - set(out[100 + k]["text"].split()) <= set(x)
    assert all(out[k]["text"] == dict(rows)[k] for k in (200, 201, 202, 203))
