"""Line-first cleaning: lines that fail a rule go, then documents that lost too much of their text.

Rules of a line with a word (limits are the constants below):
shouting (capitals), symbols (symbol characters to words), navigation (separator words such as |),
boilerplate (licence, cookie and menu phrases in a short line), punctuation (a short line that ends without
any). Lines without a word stay. A document is rejected if the lines that fail hold over MOST_LOST of its
words, or if it fails the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, slices, words_of

#: Fixed values of the contract.
SYMBOLS, LEAST_WORDS, MOST_REPEATED = "#*$%&|<>", 50, 50
#: A line with over this share of its cased ASCII letters in capitals, and at least SHOUT_WORDS words, shouts.
SHOUT, SHOUT_WORDS = 0.7, 3
#: Symbol characters to words, from LEAST_SYMBOLS on.
SYMBOL_SHARE, LEAST_SYMBOLS = 0.4, 4
#: Separator words of navigation, and from how many on and over which share of the words they make a line navigation.
SEPARATORS, NAV_WORDS, NAV_SHARE = ["|", ">", "»", "/", "•", "·", "::"], 2, 0.2
#: Phrases of boilerplate (compared in lower case), in lines of at most BOILER_WORDS words.
BOILERPLATE = [
    "all rights reserved", "licensed under the", "released under the", "creative commons", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "accept cookies", "enable javascript", "sign up for our newsletter", "general public license",
]
BOILER_WORDS = 25
#: What a line of fewer words than PLAIN_WORDS has to end with.
ENDINGS, PLAIN_WORDS = [".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]", "。"], 8
MOST_LOST = 0.3

_SYMBOL, _UPPER, _LOWER = (np.zeros(256, bool) for _ in range(3))
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER[ord("a") : ord("z") + 1] = True

METRICS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "kept": "boolean", "lines_removed": "long", "words_removed": "long",
}


def _within(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between at[i] and at[i+1]."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _repeated(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words lie in a 3-word window that its document holds twice or more."""
    covered = np.zeros(len(ids), bool)
    if len(ids) < 4:
        return covered
    common = np.bincount(ids)[ids] > 1  # a word that is met once is in no repeated window
    at = np.flatnonzero((doc[:-2] == doc[2:]) & common[:-2] & common[1:-1] & common[2:])
    if not len(at):
        return covered
    kinds = int(ids.max()) + 1
    pair = ids[at] * kinds + ids[at + 1]
    if kinds >= 1 << 21:  # else three ids fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, count = np.unique(pair * kinds + ids[at + 2], return_inverse=True, return_counts=True)
    at, window = at[keep := count[window] > 1], window[keep]
    _, inverse, count = np.unique((doc[at] << 32) | window, return_inverse=True, return_counts=True)
    at = at[count[inverse] > 1]
    for k in range(3):
        covered[at + k] = True
    return covered


def judged(texts: pa.Array, cleaned: bool) -> tuple[dict[str, np.ndarray], pa.Array]:
    """The metrics of each text, and (if cleaned) the texts without the lines that failed."""
    texts = texts.cast(pa.large_string()).fill_null("")
    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    line_at = np.concatenate([[0], np.cumsum(per_text, dtype=np.int64)])
    text_of = np.repeat(np.arange(len(texts)), per_text)
    w = words_of(lines)
    n = w.counts
    doc = text_of[w.text_of]
    words = w.array.dictionary_encode()
    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def of_text(by_line: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(by_line)])[line_at])

    symbols = _within(_SYMBOL[w.buf], w.text_at)
    upper, lower = _within(_UPPER[w.buf], w.text_at), _within(_LOWER[w.buf], w.text_at)
    solid = np.diff(np.concatenate([[0], np.cumsum(pc.utf8_length(w.array).to_numpy(zero_copy_only=False), dtype=np.int64)])[w.first])
    has = n > 0
    same = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = ((text_of << 32) | same)[has]
    firsts = np.unique(key, return_index=True)[1]
    repeat = np.ones(len(key), bool)
    repeat[firsts] = False
    dup = np.zeros(len(n), bool)
    dup[has] = repeat

    last = np.minimum(w.first[1:] - 1, max(len(ids) - 1, 0))  # of each line, its last word
    ends = np.zeros(len(words.dictionary), bool)
    for x in ENDINGS:
        ends |= pc.ends_with(words.dictionary, x).to_numpy(zero_copy_only=False)
    ends = ends[ids[last]] if len(ids) else np.ones(len(n), bool)
    separators = _within(pc.is_in(words.dictionary, pa.array(SEPARATORS, words.dictionary.type)).to_numpy(zero_copy_only=False)[ids], w.first)
    short = pc.utf8_lower(pc.if_else(pa.array(has & (n <= BOILER_WORDS)), lines, ""))
    boiler = np.zeros(len(n), bool)
    for phrase in BOILERPLATE:
        boiler |= pc.match_substring(short, phrase).to_numpy(zero_copy_only=False)
    fails = has & (
        ((n >= SHOUT_WORDS) & (upper > SHOUT * (upper + lower)) & (upper > 0))
        | ((symbols >= LEAST_SYMBOLS) & (symbols > SYMBOL_SHARE * n))
        | ((separators >= NAV_WORDS) & (separators > NAV_SHARE * n))
        | boiler
        | (~ends & (n < PLAIN_WORDS))
    )
    n_words, lost = of_text(n), of_text(np.where(fails, n, 0))
    repeats = _within(_repeated(ids, doc), np.concatenate([[0], np.cumsum(n_words)]))
    base_failed = (n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * n_words)
    out = {
        "n_words": n_words, "word_chars": of_text(solid), "n_symbols": of_text(symbols), "n_dup_lines": of_text(dup),
        "n_repeat_words": repeats, "base_failed": base_failed, "kept": ~base_failed & (lost <= MOST_LOST * n_words),
        "lines_removed": of_text(fails), "words_removed": lost,
    }
    if cleaned and fails.any():
        touched = out["lines_removed"] > 0
        stays = pa.array(~fails & touched[text_of])
        counts = of_text(~fails & touched[text_of])
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)), lines.filter(stays))
        texts = pc.if_else(pa.array(touched), pc.binary_join(lists, pa.scalar("\n", pa.large_string())), texts)
    return out, texts


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the cleaned text (clean_text) and METRICS of every row of docs (doc_id, text).

    A null or empty text has no words: it fails the base rules. Repeated rows are judged each for itself.
    Other columns are ignored; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out, texts = judged(batch.column("text"), True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), texts.cast(pa.string()), *(pa.array(out[k]) for k in METRICS)], ["doc_id", "clean_text", *METRICS]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(
        docs.select("doc_id", F.col("text").cast("string")), run, f"doc_id {kind}, clean_text string, " + ", ".join(f"{k} {t}" for k, t in METRICS.items())
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their cleaned text and its n_chars; all columns of docs, no others."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out, texts = judged(batch.column("text"), True)
            at = names.index("text")
            columns = [*batch.columns[:at], texts.cast(batch.column(at).type), *batch.columns[at + 1 :]]
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pc.utf8_length(texts).cast(columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(out["kept"]))

    return map_arrow(docs, run, schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents")).drop("clean_text")


def _like(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


OP7_SQL = f"""
WITH lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS at FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) ls FROM documents)),
worded AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') w FROM lines),
judged AS (SELECT *, len(w) n, length(regexp_replace(line, '[^A-Z]', '', 'g')) up, length(regexp_replace(line, '[^a-z]', '', 'g')) low,
  length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) sym, len(list_filter(w, lambda x: x IN ({_like(SEPARATORS)}))) sep FROM worded),
failed AS (SELECT *, n > 0 AND ((n >= {SHOUT_WORDS} AND up > {SHOUT}::DOUBLE * (up + low) AND up > 0) OR (sym >= {LEAST_SYMBOLS} AND sym > {SYMBOL_SHARE}::DOUBLE * n)
  OR (sep >= {NAV_WORDS} AND sep > {NAV_SHARE}::DOUBLE * n) OR (n <= {BOILER_WORDS} AND ({" OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)}))
  OR (n < {PLAIN_WORDS} AND NOT ({" OR ".join(f"ends_with(w[-1], {_like([e])})" for e in ENDINGS)}))) fails FROM judged),
sums AS (SELECT doc_id, sum(n)::BIGINT n_words, sum(list_sum(list_transform(w, lambda x: length(x))))::BIGINT chars, sum(sym)::BIGINT n_symbols,
  count(*) FILTER (n > 0)::BIGINT - count(DISTINCT CASE WHEN n > 0 THEN line END) n_dup_lines, count(*) FILTER (fails) lines_removed, sum(CASE WHEN fails THEN n ELSE 0 END)::BIGINT words_removed FROM failed GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS p FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w FROM documents)),
three AS (SELECT doc_id, p, w, lead(w, 1) OVER o w2, lead(w, 2) OVER o w3 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
twice AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w, w2, w3) c FROM three WHERE w3 IS NOT NULL) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT q)::BIGINT r FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) q FROM twice) GROUP BY doc_id)
SELECT doc_id, n_words, coalesce(chars, 0) word_chars, n_symbols, n_dup_lines, coalesce(r, 0) n_repeat_words,
  (n_words < {LEAST_WORDS} OR 100 * coalesce(r, 0) > {MOST_REPEATED} * n_words) base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * coalesce(r, 0) > {MOST_REPEATED} * n_words) AND words_removed <= {MOST_LOST}::DOUBLE * n_words kept, lines_removed, words_removed
FROM sums LEFT JOIN covered USING (doc_id)
"""
