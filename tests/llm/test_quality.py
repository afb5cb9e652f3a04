import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from hoptally.llm.quality import cleaned, judged, quality_rules


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab #|é\n\t\x0b \r"), max_size=40)), max_size=8))
def test_base(texts):
    import pyarrow as pa

    out, _ = judged(pa.array(texts, pa.string()), True)
    for k, text in enumerate(texts):
        assert tuple(out[n][k] for n in NAMES) == brute(text)


GOOD = "\n".join(" ".join(f"word{k * 11 + i}" for i in range(11)) + "." for k in range(7))


def test_rules(spark):
    junk = "\n".join("WORD!! OTHER!! THING!! MORE!!" for _ in range(10))
    menu = "Home | News | Sport | About | Contact us | More"
    texts = [GOOD, GOOD + "\n" + menu, GOOD + "\nAll rights reserved.", junk + "\n" + GOOD[:80], None, "", "\n\n", GOOD, "x" * 200_000 + " " + GOOD]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, kept string, n_chars long")
    rows = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert [rows[i]["kept"] for i in range(9)] == [True, True, True, False, False, False, False, True, True]
    assert rows[0]["clean_text"] == rows[1]["clean_text"] == rows[2]["clean_text"] == GOOD
    left = cleaned(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["n_chars"]) for r in left.collect())[:3] == [(0, len(GOOD)), (1, len(GOOD)), (2, len(GOOD))]
    assert quality_rules(docs.limit(0)).count() == cleaned(docs.limit(0)).count() == 0
