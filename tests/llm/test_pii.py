import hashlib
import random
import re
import time

import pytest

from hoptally.llm import pii

#: The contract's patterns, run by the regular expressions' own leftmost non-overlapping search.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            fine = {
                "email": lambda m, _: True,
                "ip": lambda m, _: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")),
                "card": lambda _, d: 14 <= len(d) <= 19 and sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate(d[::-1])) % 10 == 0,
                "phone": lambda _, d: 10 <= len(d) <= 15,
            }[kind](m, digits)
            if fine:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], pii.KINDS.index(x[2])))


@pytest.mark.parametrize("alphabet", ["ab@.+-1 ", "0123456789.", "0123456789 -", "+1 ().-3a", "a1@-.%_+é\n (", "@.a"])
def test_base_is_what_the_patterns_find(alphabet):
    rng = random.Random(alphabet)
    for _ in range(6000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert pii.found(text)[0] == plain(text), text


def test_cards_among_digits():
    rng = random.Random(5)
    for _ in range(3000):
        digits = "".join(rng.choices("0123456789", k=rng.randint(13, 20)))
        text = "".join(d + rng.choice(["", "", " ", "-"]) for d in digits) + "x"
        assert pii.found(text)[0] == plain(text), text


def added(text):
    base, whole = pii.found(text)
    return [(text[a:b], k) for a, b, k in whole if (a, b, k) not in set(base)]


def test_what_is_added():
    assert added("write to jo.doe (at) mail [dot] example [dot] org today") == [("jo.doe (at) mail [dot] example [dot] org", "email")]
    assert added("see ftp://me:pw1@host/x") == [("ftp://me:pw1@host", "login")]
    assert pii.found("ftp://me:pw1@host.example/x")[1] == [(9, 25, "email")]  # a base span stays, and what overlaps it isn't added
    assert added("IBAN: DE89 3704 0044 0532 0130 00 und mehr") == [("DE89 3704 0044 0532 0130 00", "iban")]
    assert added("IBAN: DE88 3704 0044 0532 0130 00") == []
    assert added("SSN 123-45-6789.") == [("123-45-6789", "ssn")] and added("SSN 000-45-6789") == []
    assert added("account number: 00123456, passport no. X1234567") == [("00123456", "account"), ("X1234567", "account")]
    assert added('x token = "269b1cea0846965f2d3ecb5cdb87"') == [("269b1cea0846965f2d3ecb5cdb87", "secret")]
    assert added("call +1 (843) 555-7672 170.106.47.218 now") == [("+1 (843) 555-7672", "phone")]
    assert added("Tel. 030 1234567") == [("030 1234567", "phone")]
    assert added("no 4963198541998638 12") == [("4963198541998638", "card")]
    for clean in ("The token of love, a secret garden; my account is closed. Bearer of news.", "In 1999 there were 12,345 people at 10.5 degrees.", "x@y and +1 and 1.2.3 and passwords are long", "compter konto", "secretariat = everything1"):
        assert pii.found(clean) == ([], []), clean


def test_added_spans_keep_clear():
    rng = random.Random(8)
    pieces = ["token = ", "IBAN ", "DE89370400440532013000", "a@b.cd", " (at) ", "1.2.3.4", "+1 234 567 8901", "4963198541998638", " ", "://", "u:p", "tel ", "ssn 123-45-6789", "é", '"']
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=12))
        base, whole = pii.found(text)
        assert base == plain(text) and set(base) <= set(whole)
        own = [x for x in whole if x not in set(base)]
        for a in own:
            assert 0 <= a[0] < a[1] <= len(text)
            assert all(a[1] <= b[0] or b[1] <= a[0] for b in whole if b != a)


@pytest.mark.parametrize("unit", ["1", "1 ", "1.", "1.1.1.1", "+1", "+1 (", "a@", "a@b.", "@", "tel 1", "token=", "12345678901234 ", "iban de11", "(at)a.", "://a:", "account 1"])
def test_long_texts_take_time_in_proportion(unit):
    text = unit * (1_000_000 // len(unit))
    began = time.process_time()
    pii.found(text)
    assert time.process_time() - began < 10


def test_rows(spark):
    long = "word " * 100_000 + "a.b@c.de"
    rows = [(1, "é a@b.cd 1.2.3.4", "x"), (1, "é a@b.cd 1.2.3.4", "x"), (None, None, None), (2, "", "y"), (3, long, "z"), (None, "İ +1 234 567 8901", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(repr, pii.pii_digest(docs).collect()))
    want = []
    for i, t, _ in rows:
        base = plain(t or "")
        named = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        want.append((i, *(sum(x[2] == k for x in base) for k in pii.BASE), hashlib.sha256(named.encode()).hexdigest(), named))
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert pii.pii_digest(docs).columns == columns
    assert got == sorted(repr(spark.createDataFrame([w], "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string").first()) for w in want)
    assert pii.pii_digest(docs.limit(0)).count() == 0
    whole = {r["doc_id"]: r["pii"] for r in pii.find_pii(docs).where("doc_id = 1").collect()}
    assert [(s["start"], s["end"], s["kind"], s["base"]) for s in whole[1]] == [(2, 8, "email", True), (9, 16, "ip", True)]
    hidden = pii.masked(docs.withColumnRenamed("spans", "n_chars").withColumn("n_chars", docs.doc_id)).collect()
    assert [r["text"] for r in hidden if r["doc_id"] == 1] == ["é <EMAIL> <IP>"] * 2 and [r["n_chars"] for r in hidden if r["doc_id"] == 1] == [14, 14]
    assert [r["text"] for r in hidden if r["text"] is None] == [None]


def test_given_documents(spark):
    """On the given table: base spans as by the patterns, and nothing found in texts without a digit, an at-sign or a cue."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in pii.pii_digest(docs).collect():
        named = ",".join(f"{k}:{a}:{b}" for a, b, k in plain(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        if not re.search(r"[0-9@]", texts[r["doc_id"]]):
            assert r["spans"] == ""
