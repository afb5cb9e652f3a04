import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Reader

from hoptally.llm.packing import VOCABULARY, Tokenizer, pack, plan, tokenizer

READER = Reader.from_file(public_tokenizers.path(VOCABULARY))


def best_fit(lengths, size):
    """One piece at a time: remaining capacities, as a multiset."""
    open_ = []
    for n in sorted(lengths, reverse=True):
        fits = [c for c in open_ if c >= n]
        best = min(fits) if fits else None
        if best is not None:
            open_.remove(best)
        open_.append((best if best is not None else size) - n)
    return Counter(open_)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_plan_is_best_fit_decreasing(lengths):
    rows = plan(Counter(lengths), 16)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, first, pieces, sequence, offset, per in rows:
        for k in range(pieces):
            ranks[length].append(first + k)
            used[sequence + k // per].append((offset + k % per * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in Counter(lengths).items()}
    left = Counter()
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
        left[16 - at] += 1
    assert left == best_fit(lengths, 16)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z1.,'\n\té  —<|endoftext|>"), max_size=30), max_size=6))
def test_ids_are_those_of_whole_texts(texts):
    import pyarrow as pa

    ids, at = tokenizer(None).flat(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == READER.encode(text, add_special_tokens=False).ids


def test_special_tokens_are_one_id():
    import pyarrow as pa

    ids, _ = tokenizer(None).flat(pa.array(["some <|endoftext|> here", "plain <|endof text|>"]))
    assert ids.tolist() == [x for t in ("some <|endoftext|> here", "plain <|endof text|>") for x in READER.encode(t, add_special_tokens=False).ids]
    assert READER.token_to_id("<|endoftext|>") in ids.tolist()


def test_new_words_beyond_the_cache(monkeypatch):
    import pyarrow as pa

    import hoptally.llm.packing as module

    monkeypatch.setattr(module, "CACHED", 2)
    one = Tokenizer(None)
    for text in ("some words here and there", "other words here or elsewhere"):
        assert one.flat(pa.array([text]))[0].tolist() == READER.encode(text, add_special_tokens=False).ids
    assert len(one.known) == 2


def test_pack(spark):
    texts = [None, "", "short one", "word " * 5000, "short one", "Ünïcödé — text\n\n with  spaces "]
    rows = [(i if i != 2 else None, t, "x", "clash", i) for i, t in enumerate(texts)] + [(4, "short one", "x", "clash", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, part string, rank int")
    out = pack(docs).collect()
    whole = lambda t: np.array([*READER.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    by = defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    for i, t, *_ in rows[:6]:
        ids = whole(t)
        pieces = sorted(by[i], key=lambda r: r["start"])
        if i == 4:
            assert len(pieces) == 2
            pieces = pieces[:1]
        assert sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    filled = defaultdict(list)
    for r in out:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert pack(docs.limit(0)).count() == 0


def test_words_that_were_met_are_not_encoded_again(monkeypatch):
    """A worker keeps the ids of more words than its first few million bytes of text hold; they are those of the whole text."""
    reader = Tokenizer(None)
    words = [f"w{k}" for k in range(220_000)]
    texts = pa.array(["x " + " ".join(words[k : k + 2000]) for k in range(0, len(words), 2000)])
    first, at = reader.flat(texts)
    again = []
    encode = reader.encode
    monkeypatch.setattr(reader, "encode", lambda x: again.extend(x) or encode(x))
    second, _ = reader.flat(texts)
    assert (first == second).all()
    assert not again
    assert (first[: at[1]] == encode(texts[:1].to_pylist())[0]).all()
