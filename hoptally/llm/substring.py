"""Substring dedup: runs of consecutive sentences that an earlier place of the corpus holds too are removed.

A sentence ends at a line's end, and with a word that ends in . ! ? or an ellipsis (closing marks may follow), unless that
is an abbreviation, an initial or has a dot inside. Every run of so many sentences is hashed and joined globally. Of a
hash's places the first (by doc_id, hash of the text, position) stays, and the sentences that any other place covers go.
A parameter, least_words, keeps shorter stretches of covered sentences; it is 0 unless the caller sets it. Hashes have 64 bits.

Runs of sentences miss passages that lie in a long sentence, or that begin and end inside of sentences and hold fewer whole
ones than a run. So, if the caller wants it, windows of so many words are hashed and joined with the runs. A window begins where
the hash of three words is the least of STARTS consecutive ones, wherever that text stands, so of any window + STARTS - 1 words
in a row that an earlier document holds at least a window's go. What a document holds before itself doesn't count for windows.

A task settles the runs that it meets more than once itself: within a slice of texts, and from slice to slice for runs
that were common in one before. So the shuffle by hash sees a hot run about once a task, however often the corpus holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptally.llm.common import Words, map_arrow, mixed, read, row_key, slices, words_of

#: Sentences of a run.
RUN = 3
#: Words of a window, and places of which one begins a window.
WINDOW, STARTS = 38, 14
#: The registered query's and the pipeline's parameters: whatever a repeated run or window covers goes, however short.
PRODUCTION = {"run": RUN, "least_words": 0, "window": WINDOW}
ENDS = (".", "!", "?", "…")
#: Closing marks that may follow the end of a sentence.
CLOSING = "\"')]}»“”’›"
#: Words (in lower case) whose last dot ends no sentence, besides initials and words with a dot inside.
ABBREVIATIONS = {
    "mr.", "mrs.", "ms.", "dr.", "prof.", "st.", "no.", "vs.", "fig.", "approx.", "gen.", "bzw.", "ca.", "nr.", "str.", "hr.", "abs.", "vgl.",
    "mme.", "mlle.", "env.", "cf.", "sr.", "sra.", "srta.", "dra.", "ud.", "uds.", "núm.", "pág.",
}
#: Common runs that a task remembers from slice to slice (a power of two).
REMEMBERED = 1 << 16


def _ends(word: str) -> bool:
    """Whether a sentence ends with a word."""
    bare = word.rstrip(CLOSING)
    if not bare.endswith(ENDS):
        return False
    if not bare.endswith("."):
        return True
    stem = bare.lstrip("\"'([{«“‘¿¡")
    return not (stem.lower() in ABBREVIATIONS or (len(stem) == 2 and stem[0].isupper()) or "." in stem.rstrip("."))


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The first word of each sentence, and the hash of each word."""
    coded = w.array.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    kinds = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in kinds), np.uint64, len(kinds))
    ends = np.fromiter(map(_ends, kinds), bool, len(kinds))
    begins = np.zeros(len(ids), bool)
    begins[1:] = ends[ids[:-1]]
    lines = np.concatenate([[0], np.cumsum(w.buf == ord("\n"))])
    begins[1:] |= lines[w.start[1:]] > lines[w.end[:-1]]
    begins[w.first[:-1][w.counts > 0]] = True
    return np.flatnonzero(begins), hashes[ids]


def runs(w: Words, at: np.ndarray, word: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of so many sentences: its text, its first word there, its hash. at, word: as sentences() gives them."""
    if not len(at):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    size = np.diff(np.append(at, len(word)))
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    one = mixed(np.add.reduceat(mixed(word) * powers[np.arange(len(word)) - np.repeat(at, size)], at))
    text = w.text_of[at]
    n = len(at) - run + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    total = np.zeros(n, np.uint64)
    for k in range(run):
        total = mixed(total * np.uint64(0xD6E8FEB86659FD93) + one[k : k + n])
    keep = text[:n] == text[run - 1 :]
    return text[:n][keep], (at - w.first[:-1][text])[:n][keep], total[keep]


def _slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or the greatest, as pick says, of each x[i : i + width]."""
    size = 1
    while size < width:
        step = min(size, width - size)
        x, size = pick(x[:-step], x[step:]), size + step
    return x


def windows(w: Words, word: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of so many words (3 at least) that begin at chosen places: the text, the first word there, the hash."""
    n, text = len(word) - window + 1, w.text_of
    if n < STARTS:  # as many places for the few windows of so few words
        chosen = np.flatnonzero(text[: max(n, 0)] == text[window - 1 :])
    else:
        top = np.uint64(2**64 - 1)
        x = mixed(mixed(word[:n] * np.uint64(3) + word[1 : n + 1]) * np.uint64(3) + word[2 : n + 2])
        inside = text[:n] == text[window - 1 :]
        x[~inside] = top
        least = np.concatenate([np.zeros(STARTS - 1, np.uint64), _slide(x, STARTS, np.minimum), np.zeros(STARTS - 1, np.uint64)])
        like = np.concatenate([[0, 0], np.cumsum(word[1:] == word[:-1])])  # of each word, neighbours up to it that are alike
        plain = like[window : window + n] - like[:n] >= window  # the window of the same word as the one before it: one in STARTS will do
        chosen = np.flatnonzero(inside & (x == _slide(least, STARTS, np.maximum)) & (~plain | (np.arange(n) % STARTS == 0)))
    total = np.full(len(chosen), 0x94D049BB133111EB, np.uint64)
    for k in range(window):
        total = total * np.uint64(0xD6E8FEB86659FD93) + word[chosen + k]
    return text[chosen], chosen - w.first[:-1][text[chosen]], mixed(total)


class _Common:
    """The least place known of runs that were common in a slice: a slot for each of REMEMBERED remainders of the hash."""

    def __init__(self) -> None:
        self.there, self.key = np.zeros(REMEMBERED, bool), np.zeros(REMEMBERED, np.uint64)
        self.place = [np.zeros(REMEMBERED, np.int64) for _ in range(3)]

    def later(self, key: np.ndarray, place: list[np.ndarray], common: np.ndarray) -> np.ndarray:
        """Which of these runs, each given once with its least place in a slice, are known from a lower place; learns common ones."""
        slot = (key % np.uint64(REMEMBERED)).astype(np.int64)
        known = self.there[slot] & (self.key[slot] == key)
        lower, same = np.zeros(len(key), bool), np.ones(len(key), bool)
        for mine, all_ in zip(place, self.place, strict=True):
            lower |= same & (all_[slot] < mine)
            same &= all_[slot] == mine
        put = np.flatnonzero((known & ~lower & ~same) | (common & ~known))
        self.there[slot[put]], self.key[slot[put]] = True, key[put]
        for mine, all_ in zip(place, self.place, strict=True):
            all_[slot[put]] = mine[put]
        return known & lower


def repeats(docs: DataFrame, run: int = RUN, window: int = 0) -> DataFrame:
    """_id, _h, pos of every run that isn't the first of its kind, and every window that isn't of the first document of its kind; docs as row_key leaves them.

    pos: twice the first word's place in the text, and 1 more for a window."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Common()
        for batch in slices(batches, "text"):
            w = words_of(batch.column("text"))
            at, word = sentences(w)
            text, pos, hashed = runs(w, at, word, run)
            pos = pos * 2
            if window:
                more = windows(w, word, window)
                text, pos, hashed = (np.concatenate(x) for x in zip((text, pos, hashed), (more[0], more[1] * 2 + 1, more[2]), strict=True))
            ids, hs = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("_id", "_h"))
            order = np.lexsort((hs, ids))
            turn = np.empty(len(order), np.int64)  # of each text among those of the slice; the same for alike rows
            new = np.ones(len(order), bool)
            new[1:] = (ids[order][1:] != ids[order][:-1]) | (hs[order][1:] != hs[order][:-1])
            turn[order] = np.cumsum(new)
            by = np.lexsort((pos, turn[text], hashed))
            text, pos, hashed = text[by], pos[by], hashed[by]
            within = np.where(pos % 2 == 1, 0, pos)  # the places of a window in one document are none before the other
            first = np.ones(len(by), bool)
            first[1:] = hashed[1:] != hashed[:-1]
            lead = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0)) if len(by) else np.zeros(0, np.int64)
            sure = (turn[text] != turn[text[lead]]) | (within != within[lead])
            stay, heads = np.ones(len(by), bool), np.flatnonzero(first)
            stay[1:] = first[1:] | (turn[text[1:]] != turn[text[:-1]]) | (pos[1:] != pos[:-1])
            place = [ids[text[heads]], hs[text[heads]], within[heads]]
            sure[heads] = known.later(hashed[heads], place, np.diff(np.append(heads, len(by))) > 1)
            key = np.where(sure, mixed(hashed + pos.astype(np.uint64) + ids[text].astype(np.uint64)), hashed)[stay]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key.astype(np.int64), sure[stay], ids[text[stay]], hs[text[stay]], pos[stay].astype(np.int32))],
                ["key", "sure", "_id", "_h", "pos"],
            )

    places = map_arrow(docs.select("_id", "_h", "text"), found, "key long, sure boolean, _id long, _h long, pos int")
    rank = F.dense_rank().over(Window.partitionBy("key", "sure").orderBy("_id", "_h", F.expr("if(pos % 2 = 1, 0, pos)")))
    return places.withColumn("rank", rank).where("sure or rank > 1").select("_id", "_h", "pos")


def _cut(texts: pa.Array, positions: pa.Array, run: int, least_words: int, window: int = 0) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The texts without the passages that the runs and windows at positions cover; words, words removed and passages removed of each."""
    w = words_of(texts)
    at, word = sentences(w)
    n, m, text = len(w.counts), len(word), w.text_of
    flat = positions.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(n), pc.list_value_length(positions).fill_null(0).to_numpy(zero_copy_only=False))
    low, wide = w.first[of] + flat // 2, flat % 2 == 1
    bounds = np.append(at, np.full(run + 1, m))
    high = np.where(wide, low + window, bounds[np.searchsorted(at, low) + run])
    depth = np.bincount(low, minlength=m + 1) - np.bincount(high, minlength=m + 1)
    covered = np.cumsum(depth)[:m] > 0
    edge = np.ones(m, bool)  # where a stretch of covered or other words begins
    edge[1:] = (covered[1:] != covered[:-1]) | (text[1:] != text[:-1])
    begin_word = np.flatnonzero(edge)
    end_word = np.append(begin_word[1:], m) if m else begin_word
    gone = covered[begin_word] & (end_word - begin_word >= least_words)
    begin_word, end_word = begin_word[gone], end_word[gone]
    owner = text[begin_word]
    removed, spans = np.zeros(n, np.int64), np.bincount(owner, minlength=n)
    np.add.at(removed, owner, end_word - begin_word)
    out = np.zeros(len(w.buf) + 1, np.int64)
    last = end_word == w.first[owner + 1]  # to the end of the text: then the space before goes, not the one after
    opening = begin_word == w.first[owner]
    low = np.where(last & ~opening, w.end[np.maximum(begin_word - 1, 0)], w.start[begin_word]) if len(owner) else begin_word
    high = np.where(last, w.text_at[owner + 1], w.start[np.minimum(end_word, len(w.start) - 1)]) if len(owner) else end_word
    np.add.at(out, low, 1)
    np.add.at(out, high, -1)
    keep = np.cumsum(out)[:-1] <= 0
    offsets = np.concatenate([[0], np.cumsum(keep)])[w.text_at].astype(np.int64)
    made = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(w.buf[keep])))
    return made.cast(pa.string()), w.counts, removed, spans


def marked(docs: DataFrame, run: int = RUN, window: int = 0) -> DataFrame:
    """docs with _id, _h and _pos, the sorted positions of the runs and windows to remove (null if there are none)."""
    keyed = row_key(docs)
    places = repeats(keyed, run, window).groupBy("_id", "_h").agg(F.array_sort(F.collect_set("pos")).alias("_pos"))
    return keyed.join(places, ["_id", "_h"], "left")


def substring_dedup(docs: DataFrame, run: int = RUN, least_words: int = 0, window: int = 0) -> DataFrame:
    """doc_id, the text without repeated passages, n_words, removed_words, removed_spans of every row of docs.

    run: sentences of a run; least_words: stretches of covered words with fewer of them stay; window: words of a window, 0 for none. A null text is empty,
    and one of white space alone has no sentences and stays as it is; so does one of fewer than run sentences without a window. Rows that agree in doc_id and text are one document: none of them counts as the other's
    earlier copy, and they get the same text. Rows of the same text with other ids are copies, of which the first
    keeps its text. A null doc_id comes after all others. Other columns are ignored; no rows give no rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = _cut(batch.column("text"), batch.column("_pos"), run, least_words, window)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out[0], *(pa.array(x.astype(np.int64)) for x in out[1:])], ["doc_id", "text", "n_words", "removed_words", "removed_spans"])

    kind = dict(docs.dtypes)["doc_id"]
    wide = marked(docs.select("doc_id", F.col("text").cast("string")), run, window).select("doc_id", "text", "_pos")
    return map_arrow(wide, cut, f"doc_id {kind}, text string, n_words long, removed_words long, removed_spans long")


def without_repeats(docs: DataFrame, run: int = RUN, least_words: int = 0, window: int = 0) -> DataFrame:
    """The rows of docs with repeated passages removed from text, n_chars counted anew; all columns of docs, no others.

    A document of which no word is left goes; one that had none stays. Odd rows as in substring_dedup."""
    names, schema = docs.columns, docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, words, removed, _ = _cut(batch.column("text"), batch.column("_pos"), run, least_words, window)
            columns = [batch.column(x) for x in names]
            columns[names.index("text")] = text
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pc.utf8_length(text).cast(columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array((words == 0) | (removed < words)))

    return map_arrow(marked(docs, run, window).select(*names, "_pos"), cut, schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"), **PRODUCTION)
