"""Personal data in texts by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass: at-signs (plain and masked), the colon and slashes of a
scheme, plus signs, digits, and cues that name an identifier in four languages. From an anchor a local parser expands to the
boundaries of what it may be and validates it. Parsers read each character a bounded number of times, so a text takes time
in proportion to its length, and whole texts are read.

Base kinds (contract): email, ip, card, phone. What the parsers add to them, never overlapping a span that is there already:
  email   masked at-signs: name (at) host [dot] tld
  card    a run of groups of 3 digits or more inside a longer chain, 14 to 19 digits that pass Luhn
  phone   the numbers that a failed base match holds ("+1 ... 555-0123 10.0.0.1"), and national numbers after a cue
  login   user and password in the authority of a URL
  iban    after its cue, by the check digits
  ssn     after its cue, without the areas that are never dealt
  account identifiers with at least 5 digits after a cue of an account, passport or tax number
  secret  the value that a cue such as token, password or api_key is set to, 8 characters or more
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, slices

#: The kinds in the order in which spans of one start are listed.
KINDS = ["email", "ip", "card", "phone", "login", "iban", "ssn", "account", "secret"]
BASE = KINDS[:4]

#: Cues in lower case, by what follows them.
CUES = {
    "iban": ["iban"],
    "ssn": ["ssn", "social security"],
    "account": [
        "account", "acct", "passport", "tax id", "customer id", "konto", "reisepass", "steuernummer", "kundennummer", "cuenta", "pasaporte",
        "compte", "passeport",
    ],
    "secret": ["token", "password", "passwd", "passwort", "contraseña", "mot de passe", "api_key", "api-key", "apikey", "secret", "access_key", "private_key", "bearer"],
    "tel": ["tel", "phone", "telefon", "teléfono", "téléphone", "fax", "mobile"],
}
#: At-signs in disguise.
MASKED = ["(at)", "[at]", "{at}", "<at>"]

#: Local parsers of the base kinds, as the contract has them; possessive where backing off can't help.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_SCHEME = _LOCAL.replace("_", "").replace("%", "")

#: Local parsers of what is added.
_HIDDEN = re.compile(r"[ ]?[A-Za-z0-9-]{1,63}(?:[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\}|<dot>)[ ]?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_LOGIN = re.compile(r"[^\s/@:?#]{1,256}:[^\s/@?#]{1,256}@[A-Za-z0-9.-]{1,253}")
_GROUP = re.compile(r"[0-9]+")
_LINK = re.compile(r"""\.?(?:[ ]?(?:number|nummer|no\.?|nr\.?|id|núm\.?|número|numéro|n°|key))?[ ]?[:=#]{0,2}[ ]?["']?""", re.I)
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ ]?[A-Za-z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}([ -])[0-9]{2}\1[0-9]{4}(?![0-9])")
_ACCOUNT = re.compile(r"[A-Za-z]{0,3}[0-9][A-Za-z0-9-]{4,33}(?![A-Za-z0-9])")
_SET = re.compile(r"""["']?[ ]{0,2}(?:[:=]|=>)[ ]{0,2}["']?|[ ]""")
_VALUE = re.compile(r"[A-Za-z0-9_+/=.~!$%^&*-]{8,512}")
_NATIONAL = re.compile(r"\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,14}(?![0-9])")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _iban(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """What starts a parser: anchor to (its parser, length)."""
    a = ahocorasick.Automaton()
    for anchor, parser in [("@", "at"), ("://", "scheme"), ("+", "plus"), *((str(d), "digit") for d in range(10)), *((x, "masked") for x in MASKED)]:
        a.add_word(anchor, (parser, len(anchor)))
    for parser, cues in CUES.items():
        for cue in cues:
            a.add_word(cue, (parser, len(cue)))
    a.make_automaton()
    return a


def _lower(text: str) -> str:
    """In lower case, character by character: positions stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(x := c.lower()) > 1 else x for c in text)


class _Text:
    """The spans of one text: base ones from at-signs, digits and plus signs, then the others, which have to keep clear of them."""

    def __init__(self, text: str):
        self.text = text
        self.base: list[tuple[int, int, str]] = []
        self.later: list[tuple[int, int, str]] = []  # candidates of the added kinds
        self.email_end = self.ip_end = self.chain_end = self.seen = 0

    def at(self, begin: int, end: int) -> None:
        since = max(self.email_end, self.seen)
        before = self.text[since:begin]
        self.seen = end  # an at-sign isn't part of a name
        local = len(before) - len(before.rstrip(_LOCAL))
        if local and (m := _DOMAIN.match(self.text, end)):
            self.base.append((begin - local, m.end(), "email"))
            self.email_end = m.end()

    def digit(self, begin: int, end: int) -> None:
        if begin >= self.ip_end:
            if m := _IP.match(self.text, begin):
                self.ip_end = m.end()
                if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m.group().split(".")):
                    self.base.append((begin, m.end(), "ip"))
            else:
                self.ip_end = _DIGITS.match(self.text, begin).end()
        if begin >= self.chain_end:
            m = _CHAIN.match(self.text, begin)
            self.chain_end = m.end() if m else end
            if m and len(m.group()) >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    self.base.append((begin, m.end(), "card"))
                elif len(digits) > 14:
                    self._groups(m)

    def _groups(self, chain: re.Match) -> None:
        """Cards inside a chain that isn't one: the first, longest runs of whole groups, of 3 digits at least, that are."""
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(chain.string, chain.start(), chain.end())]
        k = 0
        while k < len(groups):
            best, digits = None, ""
            for n in range(k, len(groups)):
                if not 3 <= groups[n][1] - groups[n][0] <= 19 - len(digits):
                    break
                digits += chain.string[slice(*groups[n])]
                if len(digits) >= 14 and luhn(digits):
                    best = n
            if best is not None:
                self.later.append((groups[k][0], groups[best][1], "card"))
                k = best
            k += 1

    def plus(self, begin: int, end: int) -> None:
        m = _PHONE.match(self.text, begin)
        if not m:
            return
        if 10 <= sum(map(str.isdigit, m.group())) <= 15:
            self.base.append((begin, m.end(), "phone"))
            return
        digits, best = 0, None  # the longest number that ends with a group of digits, of four if there is one
        for g in _GROUP.finditer(m.group()):
            digits += g.end() - g.start()
            if digits > 15:
                break
            if digits >= 10 and (best is None or g.end() - g.start() == 4):
                best = begin + g.end()
                if g.end() - g.start() == 4:
                    break
        if best:
            self.later.append((begin, best, "phone"))

    def masked(self, begin: int, end: int) -> None:
        at = begin - 1 if begin and self.text[begin - 1] == " " else begin
        before = self.text[max(0, at - 64) : at]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local and (m := _HIDDEN.match(self.text, end)):
            self.later.append((at - local, m.end(), "email"))

    def scheme(self, begin: int, end: int) -> None:
        before = self.text[max(0, begin - 32) : begin]
        name = len(before) - len(before.rstrip(_SCHEME))
        if name and (m := _LOGIN.match(self.text, end)):
            self.later.append((begin - name, m.end(), "login"))

    def _cued(self, begin: int, end: int, pattern: re.Pattern) -> re.Match | None:
        if begin and self.text[begin - 1].isalpha():
            return None
        return pattern.match(self.text, _LINK.match(self.text, end).end())

    def iban(self, begin: int, end: int) -> None:
        if m := self._cued(begin, end, _IBAN):
            whole = m.group()
            ends = [k for k in range(15, len(whole)) if whole[k] == " "] + [len(whole)] * (not self.text[m.end() : m.end() + 1].isalnum())
            for k in reversed(ends):  # words may follow: the longest that passes
                if len(x := whole[:k].replace(" ", "")) >= 15 and _iban(x):
                    self.later.append((m.start(), m.start() + k, "iban"))
                    return

    def ssn(self, begin: int, end: int) -> None:
        if (m := self._cued(begin, end, _SSN)) and m.group()[:3] not in {"000", "666"} and m.group()[0] != "9" and m.group()[4:6] != "00" and m.group()[7:] != "0000":
            self.later.append((*m.span(), "ssn"))

    def account(self, begin: int, end: int) -> None:
        if (m := self._cued(begin, end, _ACCOUNT)) and sum(map(str.isdigit, m.group())) >= 5:
            self.later.append((m.start(), m.start() + len(m.group().rstrip("-")), "account"))

    def secret(self, begin: int, end: int) -> None:
        if begin and self.text[begin - 1].isalpha() or not (link := _SET.match(self.text, end)):
            return
        bare = link.group() == " "
        m = _VALUE.match(self.text, link.end())
        if m and (not bare or (self.text[begin:end].lower() == "bearer" and len(m.group()) >= 16)):
            value = m.group().rstrip(".!")
            if len(value) >= 8 and any(map(str.isdigit, value)):
                self.later.append((m.start(), m.start() + len(value), "secret"))

    def tel(self, begin: int, end: int) -> None:
        if m := self._cued(begin, end, _NATIONAL):
            self.later.append((*m.span(), "phone"))

    def spans(self) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """(base, all), each sorted by start, then kind."""
        for end, (parser, size) in automaton().iter(_lower(self.text)):
            begin = end - size + 1
            if parser == "digit" and begin < self.ip_end and begin < self.chain_end:
                continue
            getattr(self, parser)(begin, end + 1)
        order = lambda x: (x[0], KINDS.index(x[2]))
        base = sorted(self.base, key=order)
        if not self.later:
            return base, base
        taken = bytearray()
        for low, high, _ in base:
            if high > len(taken):
                taken.extend(bytes(high - len(taken)))
            taken[low:high] = b"\1" * (high - low)
        added = []
        for low, high, kind in sorted(set(self.later), key=lambda x: (x[0] - x[1], order(x))):  # longer ones first
            if high > len(taken):
                taken.extend(bytes(high - len(taken)))
            if not any(taken[low:high]):
                taken[low:high] = b"\1" * (high - low)
                added.append((low, high, kind))
        return base, sorted(base + added, key=order)


def found(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans and all spans (start, end, kind) of a text, in code points."""
    return _Text(text).spans()


SPANS = "array<struct<start: long, end: long, kind: string, base: boolean>>"


def _scanned(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))
    for batch in slices(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            base, whole = found(text or "")
            own = set(base)
            rows.append([{"start": low, "end": high, "kind": k, "base": (low, high, k) in own} for low, high, k in whole])
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in extra), pa.array(rows, kind)], [*extra, "pii"])


def find_pii(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows' ids and pii, an array of their spans (start, end, kind, base) by start, then kind; one row for each row of docs.

    Positions count code points, end is exclusive; base tells the contract's spans from added ones. A null text is empty and
    has no spans; repeated rows and null ids are rows like others; other columns are ignored, whatever their names; an empty
    table gives no rows. A text may be of any length."""
    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda b: _scanned(b, ["id"]), f"id {dict(rows.dtypes)['id']}, pii {SPANS}").withColumnRenamed("id", id_col)


def masked(docs: DataFrame) -> DataFrame:
    """docs with each span of text replaced by <KIND>; of overlapping base spans the first, then the longest stays. n_chars, if
    there is one, follows."""

    def hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = []
            for text in batch.column("text").to_pylist():
                out, at = [], 0
                for low, high, kind in sorted(found(text or "")[1], key=lambda x: (x[0], -x[1])):
                    if low >= at:
                        out += [text[at:low], f"<{kind.upper()}>"]
                        at = high
                texts.append(None if text is None else "".join(out) + text[at:])
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, "text", pa.array(texts, batch.schema.field(k).type))

    out = map_arrow(docs, hidden, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        counts: dict[str, list[int]] = {k: [] for k in BASE}
        hashes, spans = [], []
        for text in batch.column("text").to_pylist():
            base, whole = found(text or "")
            for k in BASE:
                counts[k].append(sum(x[2] == k for x in base))
            named = [",".join(f"{kind}:{low}:{high}" for low, high, kind in x) for x in (base, whole)]
            hashes.append(hashlib.sha256(named[0].encode()).hexdigest())
            spans.append(named[1])
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(hashes, pa.string()), pa.array(spans, pa.string())], ["id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of base spans, base_sha256 and all spans as kind:start:end. Rows are as in find_pii."""
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, {', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string"
    return map_arrow(rows, _digest, schema).withColumnRenamed("id", "doc_id")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(read(spark, sf_dir, "documents"))
