"""Packing documents into sequences of at most 1024 tokens by best-fit decreasing.

Documents are tokenised where they lie and cut into full windows and one remainder. Best-fit decreasing
only looks at lengths, and a length is one of 1..1024, so the driver plans over the *histogram* of lengths
(at most 1024 numbers, whatever the corpus): windows with the same content are one group with a count.
A segment tree indexed by remaining capacity finds the tightest open window. The plan, a few thousand
intervals, is broadcast; each piece finds its window by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, slices, written

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
#: Distinct words whose ids a worker keeps (about 200 bytes each).
CACHED = 500_000
#: New pieces to a call.
JOINED = 256
#: Unicode's white space beyond ASCII, and the separators 0x1C-0x1F: next to these a text isn't cut at spaces.
ODD = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class CapacityTree:
    """A segment tree over remaining capacities 0..size that knows which of them have open windows."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.some = np.zeros(2 * self.leaves, bool)

    def set(self, capacity: int, some: bool) -> None:
        at = capacity + self.leaves
        self.some[at] = some
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, least: int) -> int:
        """The smallest capacity of at least `least` with an open window, or -1."""
        at = least + self.leaves
        if self.some[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return -1


def plan(histogram: dict[int, int], size: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of histogram[length] pieces of each length.

    Rows (length, first_rank, pieces, first_sequence, offset, per): the pieces of that length with ranks from
    first_rank on lie `per` to a window, from `offset` on, in windows from first_sequence on."""
    tree = CapacityTree(size)
    open_: dict[int, list[list]] = {}
    groups: list[list] = []  # [windows, steps]; a step: (length, first rank, per, offset, rank of the group's first window)
    done: list[list] = []

    def put(remaining: int, group: list) -> None:
        if remaining:
            open_.setdefault(remaining, []).append(group)
            tree.set(remaining, True)
        else:
            done.append(group)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity < 0:
                per = size // length
                full, rest = divmod(left, per)
                if full:
                    put(size - per * length, [full, [(length, rank, per, 0)]])
                if rest:
                    put(size - rest * length, [1, [(length, rank + full * per, rest, 0)]])
                left = 0
                continue
            windows, steps = group = open_[capacity].pop()
            if not open_[capacity]:
                tree.set(capacity, False)
            per, offset = capacity // length, size - capacity
            full = min(windows, left // per)
            rest = left - full * per if full < windows else 0
            rest = rest if rest < per else 0
            used, taken = full, full * per
            if full:
                put(capacity - per * length, [full, _moved(steps, 0) + [(length, rank, per, offset)]])
            if rest:
                put(capacity - rest * length, [1, _moved(steps, used) + [(length, rank + taken, rest, offset)]])
                used, taken = used + 1, taken + rest
            if used < windows:
                put(capacity, [windows - used, _moved(steps, used)])
            left, rank = left - taken, rank + taken
    groups = done + [g for gs in open_.values() for g in gs]
    rows, sequence = [], 0
    for windows, steps in groups:
        rows += [(length, first, windows * per, sequence, offset, per) for length, first, per, offset in steps]
        sequence += windows
    return sorted(rows)


def _moved(steps: list[tuple], windows: int) -> list[tuple]:
    """The steps of the windows that follow the first `windows` of a group."""
    return [(length, first + windows * per, per, offset) for length, first, per, offset in steps]


class Tokenizer:
    """Byte-level BPE ids of whole texts.

    The split before BPE never joins what stands on both sides of a single space between two characters that
    aren't white space, so such texts are cut there and each distinct piece is encoded once. New pieces are
    encoded many at a time, joined by those spaces again; the bytes that each id stands for show where one ends."""

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer as Reader

        self.reader = Reader.from_file(path or public_tokenizers.path(VOCABULARY))
        special = [re.escape(x.content) for x in self.reader.get_added_tokens_decoder().values()]
        #: Texts with a match are encoded whole: odd white space, and the tokenizer's special tokens, which are one id.
        self.whole = "|".join(["^[ ]|[ ]$|[ ][\\s\\x0b]|[\\s\\x0b][ ]", ODD, *special])
        vocabulary = self.reader.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.kind = np.dtype(np.uint16 if len(self.bytes_of) <= 1 << 16 else np.uint32)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.reader.encode_batch_fast(texts, add_special_tokens=False)]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids start (and the end)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        pieces = split.flatten().dictionary_encode()
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), out=first[1:])
        code = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        leads = np.zeros(len(code), bool)
        leads[first[:-1][np.diff(first) > 0]] = True
        code = 2 * code + ~leads  # an odd code: with a space before it
        seen = np.bincount(code, minlength=2 * len(pieces.dictionary)) > 0
        used = np.flatnonzero(seen)
        code = (np.cumsum(seen) - 1)[code]
        values = pieces.dictionary.take(pa.array(used // 2)).to_pylist()
        ids = self.ids([" " + v if c % 2 else v for v, c in zip(values, used.tolist(), strict=True)])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        flat, at = np.frombuffer(b"".join(ids), self.kind), np.cumsum(size) - size
        each = size[code]
        ends = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.repeat(at[code] - ends[:-1], each) + np.arange(ends[-1])]
        bounds = ends[first]
        if odd.any():  # encoded whole, and put in their places
            rows = np.flatnonzero(odd)
            whole = dict(zip(rows.tolist(), self.encode(texts.take(pa.array(rows)).to_pylist()), strict=True))
            parts = [whole[i] if i in whole else out[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
            out = np.concatenate(parts) if parts else out
        return out, bounds

    def ids(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        got = list(map(known.get, pieces))
        new = [i for i, x in enumerate(got) if x is None]
        spaced = [i for i in new if pieces[i][:1] == " "]
        for at in range(0, len(spaced), JOINED):
            run = [pieces[i] for i in spaced[at : at + JOINED]]
            ids = self.encode(["".join(run)])[0]
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(x.encode()) for x in run])) + 1
            raw, begin = ids.tobytes(), 0
            for i, end in zip(spaced[at : at + JOINED], (ends * self.kind.itemsize).tolist(), strict=True):
                got[i] = raw[begin:end]
                begin = end
        rest = [i for i in new if pieces[i][:1] != " "]
        for i, x in zip(rest, self.encode([pieces[i] for i in rest]), strict=True):
            got[i] = x.tobytes()
        for i in new[: max(0, CACHED - len(known))]:
            known[pieces[i]] = got[i]
        return got


@cache
def tokenizer(path: str | None) -> Tokenizer:
    """One per worker process, so that later tasks find the words that earlier ones met."""
    return Tokenizer(path)


def pieces(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each document's pieces; part and rank number those of a length in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, part, seen = tokenizer(tokenizer_path), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, at = reader.flat(batch.column("text"))
            n = np.diff(at) + 1  # with the end
            cuts = -(-n // window)
            row = np.repeat(np.arange(len(n)), cuts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
            length = np.minimum(window, n[row] - start)
            whole = np.zeros(len(ids) + len(n), "<u4")
            own = at + np.arange(len(at))
            keep = np.ones(len(whole), bool)
            keep[own[1:] - 1] = False
            whole[keep] = ids
            begin = own[row] + start
            raw = memoryview(whole.tobytes())
            crc = np.fromiter((zlib.crc32(raw[4 * b : 4 * (b + k)]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)), np.int64, len(row))
            order = np.argsort(length, kind="stable")
            sizes, first, count = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.repeat(first, count) + np.repeat(seen[sizes], count)
            seen[sizes] += count
            doc = batch.column("doc_id").cast(pa.int64()).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [doc, *(pa.array(x.astype(np.int64)) for x in (start, length, crc, n[row], np.full(len(row), part), rank))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, rank long")


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of docs is a document, also repeated rows and those with a null id; a null or empty text is
    one piece with the end token alone. No documents: no pieces. Other columns are ignored. The padding of
    a sequence is window less its pieces' lengths; a sequence whose length is a power of two isn't padded."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer_path, window))
    counts = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("part", "length", before.alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # window rows at most
    intervals = spark.sparkContext.broadcast(np.array(plan(histogram, window), np.int64).reshape(-1, 6))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = intervals.value
        keys = [(int(a), int(b)) for a, b in rows[:, :2]]
        low = {length: bisect.bisect_left(keys, (length, -1)) for length in {k[0] for k in keys}}
        high = {length: bisect.bisect_left(keys, (length + 1, -1)) for length in low}
        for batch in batches:
            length, rank = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for size in np.unique(length).tolist():
                mine = length == size
                at[mine] = low[size] + np.searchsorted(rows[low[size] : high[size], 1], rank[mine], "right") - 1
            found = rows[at]
            turn = rank - found[:, 1]
            sequence, offset = found[:, 3] + turn // found[:, 5], found[:, 4] + turn % found[:, 5] * length
            keep = [batch.column(x) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # tasks times lengths, so it grows with the corpus: never broadcast
    ranked = cut.join(base.hint("merge"), ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank")).alias("rank"))
    return map_arrow(ranked, place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
