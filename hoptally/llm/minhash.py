"""Near-duplicate documents by order MinHash.

A text's 5-word shingles are labelled with their occurrence (first, second, ... of that shingle in the text).
For each of SKETCHES hash functions the two labelled shingles of least hash are taken *in text order*: two texts
agree on a sketch if both shingles are among their least and stand in the same order, which makes agreement
follow edit similarity. Two texts at SIMILARITY itself seldom agree on two shingles, so SINGLES sketches are of the one
shingle of least hash, and short texts have some of shorter shingles too. Texts that share a sketch are candidates; a banded alignment of their words decides
(1 - edit distance / words of the longer >= SIMILARITY). Classes are the connected components of verified links.

Copies of a text count once. Pairs are aligned only if their lengths and outlines (bags of words, of long texts signatures too) let them be
near; outlines are compared where the texts of a sketch's bucket meet, in chunks, and no other pair leaves that place. A bucket of few such
pairs is done with when these are aligned, which most are at once. In others the texts are first compared with the one that may be near the
most others, then each with the one of another class that is likeliest near it; then all of them that aren't in one class yet are compared
with each other, so that the classes are those of all pairs that share a sketch. Of the buckets that a pair still shares it leaves the first alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptally.llm.common import components, map_arrow, mixed, nearer_stars, read, slices, words_of, written

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES = 24
#: Sketches of one shingle, for pairs near SIMILARITY whose shingles agree too little for two.
SINGLES = 40
#: Texts of so many words at most also have sketches of one shingle of fewer words: a few edits leave none of SHINGLE words.
SHORT, SHORT_SHINGLE, SHORT_SINGLES = 40, 2, 16
#: Cells of a text's bag of words and bytes of its signature, cells of a long text's bag (a multiple of BAG), cells of the bag that rules out most pairs (BAG is a multiple), members of a bucket that meet at once, pairs of them that are looked at at once, pairs whose outlines
#: are compared at once (their copies take 3 KB a pair at most), and bits by which texts are picked.
BAG, WIDE, COARSE, CHUNK, PAIRS, COMPARED, BITS = 256, 512, 32, 4096, 1 << 16, 4096, 1 << 22
#: Chunks of a bucket beyond which they are made by length, so that each meets those of near lengths alone.
BANDED = 3
#: Members of a group by which the one that has most pairs is told, where the group has more than twice as many; cells that are moved count to so many.
PIVOTS, CAP = 64, 15
#: Words from which on a text has a signature and a bag of WIDE cells, and the share of its bytes that have to agree (0.43 is expected at SIMILARITY).
LONG, AGREE = 400, 0.26

_ODD = mixed(np.arange(1, max(SKETCHES, SINGLES, SHORT_SINGLES) + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words of at most so many bytes are hashed at once, and the first 0 to 8 of eight bytes.
WORD = 64
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@dataclass
class Hashed:
    """A hash of each word of some texts, and of each text its first word (and the end)."""

    word: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def only(self, some: np.ndarray) -> Hashed:
        """Of these texts alone."""
        counts = self.counts
        return Hashed(self.word[np.repeat(some, counts)], np.concatenate([[0], np.cumsum(counts[some])]))


def hashed(texts: pa.Array) -> Hashed:
    """Words are hashed eight bytes at a time, those of over WORD bytes one by one."""
    w = words_of(texts)
    at = np.frombuffer(w.array.buffers()[1], np.int64)[: len(w.array) + 1]
    data = np.concatenate([np.frombuffer(w.array.buffers()[2], np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    start, size = at[:-1], np.diff(at)
    out = size.astype(np.uint64)
    for k in range(0, min(int(size.max(initial=0)), WORD), 8):
        some = np.flatnonzero(size > k)
        x = eight[start[some] + k] & _BYTES[np.minimum(size[some] - k, 8)]
        out[some] = mixed(out[some] * np.uint64(0xD6E8FEB86659FD93) + x)
    for k in np.flatnonzero(size > WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[at[k] : at[k + 1]])
    return Hashed(mixed(out), w.first)


def shingles(words: Hashed, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingle hashes of all texts in text order, and where each text's begin.

    A text of fewer than width words has one shingle of all its words; one without words has none."""
    word, counts = words.word, words.counts
    size = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    at = np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(counts)), size)
    begin = words.first[:-1][text] + np.arange(at[-1]) - at[:-1][text]
    stop = words.first[1:][text]
    out = np.zeros(len(text), np.uint64)
    for k in range(width):
        inside = begin + k < stop
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, word[np.minimum(begin + k, max(len(word) - 1, 0))], np.uint64(k)))
    own = mixed(out + text.astype(np.uint64) * _STEP)  # the same only for the same shingle of the same text
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    again = np.sort(order[np.append(same, False) | np.append(False, same)]) if len(own) else order  # most stand once
    order = again[np.argsort(own[again], kind="stable")]
    first = np.ones(len(order), bool)
    first[1:] = own[order][1:] != own[order][:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else order
    occurrence = np.zeros(len(own), np.uint64)
    occurrence[order] = (np.arange(len(order)) - lead).astype(np.uint64)
    return mixed(out + occurrence * _STEP), at


def sketches(labelled: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SKETCHES columns for each text that has shingles."""
    starts = at[:-1][np.diff(at) > 0]
    size = np.diff(np.append(starts, len(labelled)))
    out = np.empty((len(starts), SKETCHES), np.uint64)
    if not len(starts):
        return out
    top = np.uint64(2**64 - 1)
    for k in range(SKETCHES):
        v = labelled * _ODD[k]
        low = np.minimum.reduceat(v, starts)
        place = np.flatnonzero(v == np.repeat(low, size))
        v[place] = top
        second = np.minimum.reduceat(v, starts)
        after = np.flatnonzero(v == np.repeat(second, size))
        one = size == 1
        swap = (after < place) & ~one if len(after) == len(place) else np.zeros(len(starts), bool)
        second = np.where(one, np.uint64(0), second)
        out[:, k] = mixed(mixed(np.where(swap, second, low)) * np.uint64(3) + np.where(swap, low, second))
    return out


def singles(labelled: np.ndarray, at: np.ndarray, many: int) -> np.ndarray:
    """The least shingle by each of so many hash functions, for each text that has shingles."""
    starts = at[:-1][np.diff(at) > 0]
    return np.stack([mixed(np.minimum.reduceat(labelled * _ODD[k], starts)) if len(starts) else np.zeros(0, np.uint64) for k in range(many)], 1)


def keys_of(texts: pa.Array, words: Hashed | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each text, a column a sketch; which of them it has; and words of each text. words: those of the texts, if known."""
    words = words or hashed(texts)
    (labelled, at), counts = shingles(words), words.counts
    some, short = counts > 0, (counts > 0) & (counts <= SHORT)
    kinds = SKETCHES, SINGLES, SHORT_SINGLES
    keys = np.zeros((len(counts), sum(kinds)), np.uint64)
    keys[some, :SKETCHES] = sketches(labelled, at)
    keys[some, SKETCHES:-SHORT_SINGLES] = singles(labelled, at, SINGLES)
    keys[short, -SHORT_SINGLES:] = singles(*shingles(words.only(short), SHORT_SHINGLE), SHORT_SINGLES)
    has = np.stack([some] * (SKETCHES + SINGLES) + [short] * SHORT_SINGLES, 1)
    return mixed(keys + np.arange(1, sum(kinds) + 1, dtype=np.uint64) * _STEP), has, counts


def edit_distance_within(a: list, b: list, most: int) -> int:
    """The edit distance of two word lists, or most + 1 if it is greater.

    Bit-parallel alignment in a band of `most` diagonals to either side: a bit of the vectors is a diagonal."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    if not b:
        return len(a)
    n, m = len(a), len(b)
    most = min(most, n - 1)  # the distance is n at most
    width = 2 * most + 2
    full = (1 << width) - 1
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    up = (full << (width - most - 1)) & full
    down, distance, shift = 0, most, most + 1 - width
    corner, row = 1 << (width - 1), 1 << (width - 2)
    limit = most + m - (n - most)
    for j, x in enumerate(b):
        match = places.get(x, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & full
        zero = ((((match & up) + up) ^ up) | match | down) & full
        plus = (down | ~(zero | up)) & full
        minus = zero & up
        if j < n - most:
            distance += not zero & corner
        else:
            distance += bool(plus & row) - bool(minus & row)
            row >>= 1
        if distance > limit:
            return most + 1
        zero >>= 1
        up = (minus | ~(zero | plus)) & full
        down = zero & plus
        shift += 1
    return min(distance, most + 1)


def alike(a: str, b: str) -> bool:
    """Whether two texts are near copies of each other."""
    x, y = a.encode().split(), b.encode().split()
    longest, least = max(len(x), len(y)), min(len(x), len(y))
    most = int((1 - SIMILARITY) * longest + 1e-9)
    if least < longest - most:
        return False
    if sum(map(ne, x, y)) + longest - least <= most:  # an alignment place by place will do
        return True
    if (Counter(x) & Counter(y)).total() < longest - most:  # what isn't common has to be edited
        return False
    same = 0
    while same < least and x[same] == y[same]:
        same += 1
    end = 0
    while end < least - same and x[-1 - end] == y[-1 - end]:
        end += 1
    return edit_distance_within(x[same : len(x) - end], y[same : len(y) - end], most) <= most


def _keyed(docs: DataFrame) -> DataFrame:
    """_id: doc_id, or for a null one a negative number from the text's hash; _h, _g: hashes of the text (null as empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h = F.xxhash64(text)
    own = F.when(h < 0, h).otherwise(-h - 1)
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), own), "_h": h, "_g": F.xxhash64(F.lit("g"), text)})


def _sketched(keyed: DataFrame) -> DataFrame:
    """Of every distinct text of a slice: id, h, g, words (n), its bag and its keys, one a sketch. Of copies within a slice: id and
    the copy's id (of)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, h, g = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("_id", "_h", "_g"))
            order = np.lexsort((ids, g, h))
            first = np.ones(len(order), bool)
            first[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
            lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            copies = pa.array(ids[order][~first]), pa.array(ids[lead][~first])
            one = np.sort(order[first])
            texts = batch.column("text").take(pa.array(one))
            words = hashed(texts)
            keys, has, counts = keys_of(texts, words)
            held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], has.sum(1).cumsum()]).astype(np.int32)), pa.array(keys[has].astype(np.int64)))
            none = pa.nulls(len(one), pa.int64())
            bag = packed(outlines(texts, counts, words), counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids[one]), none, pa.array(h[one]), pa.array(g[one]), pa.array(counts.astype(np.int64)), bag, held], _SKETCHED)
            none = [pa.nulls(len(copies[0]), t) for t in (*[pa.int64()] * 3, pa.binary(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*copies, *none], _SKETCHED)

    return written(map_arrow(keyed.select("_id", "_h", "_g", "text"), run, "id long, of long, h long, g long, n long, bag binary, keys array<long>"))


_SKETCHED = ["id", "of", "h", "g", "n", "bag", "keys"]


def bags(texts: pa.Array | Hashed, cells: int = BAG) -> list[bytes]:
    """Of each text how many of its words fall in each of so many cells (255 at most).

    An edit changes two cells by one at most, and takes one word away or adds one, so texts whose bags and lengths differ by more than
    twice an edit distance together are further apart than that: the comparison drops pairs, but never a near one."""
    words = texts if isinstance(texts, Hashed) else hashed(texts)
    many, cell = len(words.counts), (words.word % np.uint64(cells)).astype(np.int64)
    got = np.bincount(np.repeat(np.arange(many) * cells, words.counts) + cell, minlength=many * cells).reshape(many, cells)
    return [x.tobytes() for x in np.minimum(got, 255).astype(np.uint8)]


def signatures(words: Hashed) -> list[bytes]:
    """Of each text the least hash of its occurrence-labelled pairs of words in each of BAG parts of the hashes, a byte each (255: none).

    An edit takes two pairs away and adds two at most, so texts at SIMILARITY share three sevenths of all their pairs at least, and
    about as many bytes; texts that have nothing but a language in common share few."""
    labelled, at = shingles(words, 2)
    many = len(at) - 1
    text = np.repeat(np.arange(many), np.diff(at))
    out = np.full(many * BAG, 2**64 - 1, np.uint64)
    np.minimum.at(out, text * BAG + (labelled % np.uint64(BAG)).astype(np.int64), labelled >> np.uint64(8))
    byte = np.where(out == np.uint64(2**64 - 1), np.uint64(255), out % np.uint64(255)).astype(np.uint8)
    return [x.tobytes() for x in byte.reshape(many, BAG)]


def outlines(texts: pa.Array, n: np.ndarray, words: Hashed | None = None) -> pa.Array:
    """bags of texts of fewer than LONG words; of the others, whose words fill BAG cells much alike, signatures and bags of WIDE cells.
    words: those of the texts, if known."""
    long, words = n >= LONG, words or hashed(texts)
    out = np.empty(len(texts), object)
    few, many = words.only(~long), words.only(long)
    out[~long] = bags(few)
    out[long] = [x + y for x, y in zip(signatures(many), bags(many, WIDE), strict=True)]
    return pa.array(out.tolist(), pa.binary())


def packed(bag: pa.Array, n: np.ndarray) -> pa.Array:
    """The outlines of texts of n words as they are moved: those of fewer than LONG words with two cells to a byte, CAP at most each.

    An edit changes a capped cell by one at most too, so these never rule out a near pair either."""
    raw, some = bag.to_pylist(), np.flatnonzero(n < LONG)
    cells = np.minimum(np.frombuffer(b"".join([raw[k] for k in some]), np.uint8).reshape(-1, BAG), CAP)
    for k, x in zip(some, cells[:, ::2] | cells[:, 1::2] << 4, strict=True):
        raw[k] = x.tobytes()
    return pa.array(raw, pa.binary())


def _matrix(bag: pa.ChunkedArray, n: np.ndarray) -> np.ndarray:
    """The outlines of texts of n words, packed or not, a row each."""
    raw, long = bag.to_pylist(), n >= LONG
    out = np.zeros((len(n), BAG + WIDE * bool(long.any())), np.uint8)
    half = np.fromiter((len(x) == BAG // 2 for x in raw), bool, len(raw))
    for some, width in ((half, BAG // 2), (~long & ~half, BAG), (long, BAG + WIDE)):
        at = np.flatnonzero(some)
        if len(at):
            cells = np.frombuffer(b"".join([raw[k] for k in at]), np.uint8).reshape(-1, width)
            out[at, : max(width, BAG)] = np.stack([cells & CAP, cells >> 4], 2).reshape(-1, BAG) if width < BAG else cells
    return out


def _sums(rows: np.ndarray) -> np.ndarray:
    """The sum of each row of bytes (a multiple of 8, 2048 at most), in lanes of 16 bits."""
    x = np.ascontiguousarray(rows).view(np.uint64)
    low = np.uint64(0x00FF00FF00FF00FF)
    x = ((x & low) + (x >> np.uint64(8) & low)).sum(1)
    return sum((x >> np.uint64(k) & np.uint64(0xFFFF)).astype(np.int64) for k in (0, 16, 32, 48))


def apart(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Half of what the bags of outlines x, y of texts of n and m words differ by, and their lengths: their edit distance at least."""
    out = np.abs(n - m)
    long, other = n >= LONG, m >= LONG
    for some, wide in ((~long & ~other, False), (long & other, True)):
        at = np.flatnonzero(some)
        a, b = (z[at, BAG:] if wide else z[at, :BAG] for z in (x, y))
        out[at] += _sums(np.maximum(a, b) - np.minimum(a, b))
    for some, a, b in ((long & ~other, x, y), (~long & other, y, x)):  # cells of the wide bag that fall in one of the other
        at = np.flatnonzero(some)
        if len(at):
            folded = np.minimum(a[at, BAG:].reshape(-1, WIDE // BAG, BAG).sum(1, dtype=np.int16), CAP).astype(np.uint8)
            few = np.minimum(b[at, :BAG], CAP)  # packed or not
            out[at] += _sums(np.maximum(folded, few) - np.minimum(folded, few))
    return out / 2


def coarse(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bags of COARSE cells, from outlines x of texts of n words; those of texts within an edit distance differ by no more than their bags may."""
    cells, long = np.minimum(x[:, :BAG], CAP), np.flatnonzero(n >= LONG)
    if len(long):
        cells[long] = np.minimum(x[long, BAG:].reshape(-1, WIDE // BAG, BAG).sum(1, dtype=np.int16), CAP)
    return cells.reshape(-1, COARSE, BAG // COARSE).sum(2, dtype=np.uint8)  # CAP * BAG / COARSE at most


def could_be(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which pairs of outlines x, y of texts of n and m words may be those of near copies. Bags never rule out such a pair; signatures
    do in one of a hundred thousand at SIMILARITY itself, if each edit stands alone."""
    most = np.floor((1 - SIMILARITY) * np.maximum(n, m) + 1e-9)
    fits = np.ones(len(n), bool)
    long = np.flatnonzero((n >= LONG) & (m >= LONG))
    some = (x[long, :BAG] != 255) | (y[long, :BAG] != 255)
    fits[long] = _sums(((x[long, :BAG] == y[long, :BAG]) & some).view(np.uint8)) >= AGREE * _sums(some.view(np.uint8))
    left = np.flatnonzero(fits)
    fits[left] = apart(x[left], y[left], n[left], m[left]) <= most[left]
    return fits


def _band(n: F.Column) -> F.Column:
    """By length, so that near copies are in one band or in bands that follow each other."""
    return F.floor(F.log(n.cast("double")) / -np.log(SIMILARITY) + 1e-9).cast("int")


def _with_near_lengths(rows: DataFrame) -> DataFrame:
    """The rows (id, n, key) with the size of their key's bucket, but for those of which no other of the bucket is near in length: exactly so of
    two, by the bands that are there of more."""
    one, band = F.lit(1).cast("long"), F.least(_band(F.col("n")), F.lit(62))
    per = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.bit_or(F.call_function("shiftleft", one, band)).alias("bands"))
    per = written(per.where((F.col("size") > 1) & ((F.col("size") > 2) | (F.col("low") >= SIMILARITY * F.col("high") - 1e-9))))
    there = lambda k: F.call_function("shiftright", F.col("bands"), k).bitwiseAND(one) == 1
    several = F.col("size") > F.bit_count("bands")  # some band has two
    return rows.join(per, "key").where(several | there(F.least(band + 1, F.lit(63))) | there(F.greatest(band - 1, F.lit(0)))).select("id", "n", "key", "size")


def _unlike(rows: DataFrame) -> DataFrame:
    """The rows (id, n, key) of one bucket, that of the least key, of those that have the same members: near copies share many sketches, and
    most of these no other text has. Sets are told apart by 97 bits of hashes and their size."""
    sets = rows.groupBy("key").agg(F.count("*").alias("many"), F.bit_xor(F.xxhash64("id", "n")).alias("x"), F.sum(F.shiftright(F.xxhash64(F.lit(1), "id", "n"), 31)).alias("y"))
    return rows.join(sets.groupBy("many", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def _among(members: DataFrame, parts: int, only: str = "") -> DataFrame:
    """Pairs (a, b) of bucket members (key, before, id, n, class, size, bag) of different classes that may be near copies by their lengths and
    outlines, but for those that share a bucket of before. only: of a group with more pairs than members, "hub", those of the member that has
    most, "likeliest", the likeliest pair of each member; a third column, which has nothing to do with the first two, then has the keys of
    the buckets that may have other pairs.

    Members are dealt to chunks, and the chunks of a bucket meet in pairs, each in one place, that only what may be near leaves. The
    chunks of large buckets are of one band of lengths, and meet those of the same band and the next ones: texts further apart in length
    aren't near."""
    chunks = F.ceil(F.col("size") / CHUNK).cast("long")
    few = members.where(chunks <= BANDED).withColumn("chunks", chunks)
    few = few.withColumn("chunk", F.pmod(F.hash("id"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    many = members.where(chunks > BANDED).withColumn("band", _band(F.col("n")).cast("long"))
    bands = written(many.groupBy("key", "band").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks")))
    beside = bands.select("key", F.col("band").alias("from"), F.explode(F.expr("transform(sequence(0L, chunks - 1), x -> shiftleft(band, 20) + x)")).alias("other"))
    beside = beside.withColumn("band", F.explode(F.expr("sequence(from - 1, from + 1)"))).groupBy("key", "band").agg(F.collect_list("other").alias("others"))  # a number a chunk
    many = many.join(bands.join(beside, ["key", "band"]), ["key", "band"]).withColumn("chunk", F.expr("shiftleft(band, 20) + pmod(hash(id), chunks)")).withColumn("other", F.explode("others"))
    cols = ["key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "id", "n", "class", "bag", "before"]
    dealt = few.select(*cols).unionByName(many.select(*cols))
    dealt = dealt.repartition(parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def near(held: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.zeros(held.num_rows, np.int64)
        for c in ("key", "lo", "hi"):
            x = held.column(c).to_numpy()
            group[1:] |= x[1:] != x[:-1]
        group = np.cumsum(group)
        order = np.lexsort((held.column("class").to_numpy(), group))  # members of one class follow each other, and don't meet
        held = held.take(pa.array(order)).combine_chunks()
        key, lo, hi, chunk, ids, n, cls = (held.column(c).to_numpy() for c in ("key", "lo", "hi", "chunk", "id", "n", "class"))
        bag, before = _matrix(held.column("bag"), n), held.column("before").combine_chunks()
        small, alone = coarse(bag, n), bool((lo == hi).all())
        known, known_at = before.values.to_numpy(), before.offsets.to_numpy()
        members = np.bincount(group)
        start = np.cumsum(members) - members
        last = np.append((group[1:] != group[:-1]) | (cls[1:] != cls[:-1]), True)
        begin = np.flatnonzero(last)[np.cumsum(last) - last] + 1  # of each row, the first of the next class
        after = (start + members)[group] - begin  # and how many of its group follow from there
        large = (members > 2 * PIVOTS) & (only == "hub")

        def may_be(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Those of the pairs that may be near, COMPARED looked at at once."""
            keep = cls[i] != cls[j]
            if not alone:
                keep &= (lo[i] == hi[i]) | (chunk[i] != chunk[j])
            a, b = n[i], n[j]
            most = np.floor((1 - SIMILARITY) * np.maximum(a, b) + 1e-9) * 2 - np.abs(a - b)  # what their bags may differ by
            keep = np.flatnonzero(keep & (most >= np.abs(a - b)))
            i, j, most = i[keep], j[keep], most[keep]
            x, y = small[i], small[j]
            keep = _sums(np.maximum(x, y) - np.minimum(x, y)) <= most
            i, j = i[keep], j[keep]
            for k in range(0, len(i), COMPARED):
                x, y = i[k : k + COMPARED], j[k : k + COMPARED]
                fits = could_be(bag[x], bag[y], n[x], n[y])
                if fits.any():
                    yield x[fits], y[fits]

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            at, upto = 0, np.cumsum(after)
            while at < len(ids):
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
                i = np.repeat(np.arange(at, stop), after[at:stop])
                yield from may_be(i, np.arange(len(i)) - np.repeat(np.cumsum(after[at:stop]) - after[at:stop], after[at:stop]) + begin[i])
                at = stop

        def with_pivots() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Members of large groups with PIVOTS of their group that lie evenly in it."""
            some, each = np.flatnonzero(large[group]), PAIRS // PIVOTS
            for k in range(0, len(some), each):
                i = np.repeat(some[k : k + each], PIVOTS)
                of, turn = group[i], np.tile(np.arange(PIVOTS), len(i) // PIVOTS)
                yield from may_be(i, start[of] + members[of] * turn // PIVOTS)

        def here() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """The pairs that share no bucket of before; those of one row follow each other."""
            keys_of = lambda r: known[known_at[r] : known_at[r + 1]].tolist()
            for i, j in pairs():
                fresh, at, own = np.ones(len(i), bool), -1, frozenset()
                for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
                    if a != at:
                        at, own = a, frozenset(keys_of(a))
                    fresh[k] = own.isdisjoint(keys_of(b))
                yield i[fresh], j[fresh]

        def found(i: np.ndarray, j: np.ndarray, open_: np.ndarray | None = None) -> pa.RecordBatch:
            both = np.unique(np.stack([np.maximum(ids[i], ids[j]), np.minimum(ids[i], ids[j])]), axis=1)
            cols = [*both] if open_ is None else [*both, np.unique(key[start[open_]])]
            rows = max(map(len, cols))
            return pa.RecordBatch.from_arrays([pa.array(np.pad(x, (0, rows - len(x))), mask=np.arange(rows) >= len(x)) for x in cols], ["a", "b", "key"][: len(cols)])

        if not only:
            for i, j in here():
                yield found(i, j)
            return
        many, whole = np.zeros(len(members), np.int64), []  # pairs of each group; those of groups of few
        degree = np.zeros(len(ids), np.int64)
        for i, _ in with_pivots():
            np.add.at(degree, i, 1)
        large &= np.bincount(group, degree, minlength=len(members)) > 2 * PIVOTS  # others have fewer pairs than members, as it seems, and are compared whole
        degree[~large[group]] = after[large[group]] = 0
        least, partner = np.full(len(ids), np.inf), np.full(len(ids), -1)
        for i, j in pairs() if only == "hub" else here():
            many += np.bincount(group[i], minlength=len(many))
            few = many[group[i]] <= members[group[i]]
            whole.append((i[few], j[few]))
            if only == "hub":
                np.add.at(degree, i, 1)
                np.add.at(degree, j, 1)
                continue
            score = np.tile(apart(bag[i], bag[j], n[i], n[j]) / np.maximum(n[i], n[j]), 2)
            row, other = np.concatenate([i, j]), np.concatenate([j, i])
            order = np.lexsort((score, row))
            first = order[np.append(True, np.diff(row[order]) != 0)] if len(order) else order
            first = first[score[first] < least[row[first]]]
            least[row[first]], partner[row[first]] = score[first], other[first]
        open_ = many > members
        whole = [(i[few], j[few]) for i, j in whole for few in [~open_[group[i]]]]
        if only == "hub":
            open_ |= large
            order = np.lexsort((-ids, degree, group))  # of each group the last: most pairs, then the least id
            best = order[np.append(np.flatnonzero(np.diff(group[order])), len(order) - 1)][group] if len(order) else order
            some = np.flatnonzero((degree[best] > 0) & (best != np.arange(len(ids))) & open_[group])
            whole += may_be(some, best[some])
        else:
            some = np.flatnonzero((partner >= 0) & open_[group])
            whole.append((some, partner[some]))
        i, j = np.concatenate([np.zeros((2, 0), np.int64), *whole], axis=1)
        yield found(i, j, np.flatnonzero(open_))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 4 * CHUNK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table.column(c)[-1].as_py() for c in ("key", "lo", "hi")]
            same = np.logical_and.reduce([table.column(c).to_numpy() == x for c, x in zip(("key", "lo", "hi"), last, strict=True)])
            cut = int(np.argmax(same))  # the last group may go on
            if cut:
                yield from near(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
        if held:
            yield from near(pa.Table.from_batches(held).combine_chunks())

    return map_arrow(dealt, run, "a long, b long, key long") if only else map_arrow(dealt, run, "a long, b long").distinct()


def _marked(texts: DataFrame, ids: DataFrame, by: str) -> DataFrame:
    """The texts with _in: false for most of those whose `by` isn't one of the ids (x), true for all others, so that few are moved: by BITS bits,
    which are broadcast (BITS / 64 rows at most)."""
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(BITS))
    one = F.lit(1).cast("long")
    bits = ids.select(place("x").alias("p"))
    bits = bits.groupBy(F.expr("p div 64").alias("_word")).agg(F.bit_or(F.call_function("shiftleft", one, (F.col("p") % 64).cast("int"))).alias("_bits"))
    found = texts.withColumn("_p", place(by)).withColumn("_word", F.expr("_p div 64")).join(F.broadcast(bits), "_word", "left")
    hit = F.coalesce("_bits", F.lit(0)).bitwiseAND(F.call_function("shiftleft", one, (F.col("_p") % 64).cast("int"))) != 0
    return found.withColumn("_in", hit).drop("_p", "_word", "_bits")


def _needed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts but for most of those whose _id no pair (a, b) has."""
    return _marked(texts, pairs.select(F.explode(F.array("a", "b")).alias("x")), "_id").where("_in").drop("_in")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b), as written, that an alignment of their texts (_id, text) finds alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = [alike(x[i].as_py(), y[i].as_py()) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = _needed(texts, pairs)
    doubt = pairs.join(texts.select(F.col("_id").alias("a"), F.col("text").alias("x")), "a")
    doubt = doubt.join(texts.select(F.col("_id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    return written(map_arrow(doubt, run, "a long, b long"))


def links(docs: DataFrame) -> DataFrame:
    """Pairs a > b of documents (as _id) of one class, with the classes of all candidates that are near copies as their components."""
    keyed = _keyed(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    texts = keyed.select("_id", "_h", "text")
    if keyed.groupBy("_id").count().where("count > 1").limit(1).count():  # else no id stands twice, and this would move all texts for nothing
        texts = texts.dropDuplicates(["_id", "_h"])
    found = _sketched(keyed)
    own = found.where("of is null")
    lead = own.select("id", "h", "g").join(own.groupBy("h", "g").agg(F.min("id").alias("lead")), ["h", "g"]).where("id <> lead")
    lead = written(lead)  # copies in other slices; what is wide stays where it was written
    exact = found.where("of is not null").select("id", "of").unionByName(lead.select("id", F.col("lead").alias("of")))
    exact = exact.where("id <> of").select(F.greatest("id", "of").alias("a"), F.least("id", "of").alias("b")).distinct()
    bag = own.select("id", F.col("n").alias("words"), "bag")  # an id may have several texts: each bag goes with its number of words
    # sums by bucket are written before they are joined: a bucket may hold any share of the texts, and a join that doesn't follow
    # from its own sum's shuffle is one whose large buckets Spark can split
    one = _marked(own.where("n > 0").select("id", "h", "g", "n", "keys"), lead.select(F.col("id").alias("x")), "id")
    one = one.where("not _in").unionByName(one.where("_in").join(lead, ["id", "h", "g"], "left_anti"))
    rows = written(_unlike(written(_with_near_lengths(one.select("id", "n", F.explode("keys").alias("key"))))))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nothing = F.array().cast("array<long>")
    members = rows.withColumns({"class": F.col("id"), "before": nothing}).join(bag, "id").where("n = words")
    star, done = exact, None
    # what is open is compared again, in the end all that shares a bucket and isn't in one class yet, so that the classes are those of all pairs that share a sketch
    for only in ("hub", "likeliest", ""):
        met = written(_among(members, parts, only))
        pairs = met.select("a", "b").where("a is not null").distinct()
        pairs = written(pairs.join(done, ["a", "b"], "left_anti") if done else pairs)
        star = star.unionByName(_verified(pairs, texts))
        if not only or (left := written(met.select("key").where("key is not null").distinct())).isEmpty():
            break
        done = done.unionByName(pairs) if done else pairs
        star = written(nearer_stars(star))  # all links so far, in as few
        of = written(star.groupBy("a").agg(F.min("b").alias("b")))  # a class is the least node two steps away; what that tells apart is compared once more
        of = of.join(of.select(F.col("a").alias("b"), F.col("b").alias("far")), "b", "left").select(F.col("a").alias("id"), F.coalesce("far", "b").alias("class"))
        rows = rows.select("id", "n", "key", "size").join(left, "key", "left_semi")
        rows = written(rows.join(of, "id", "left").withColumn("class", F.coalesce("class", "id")))
        open_ = written(rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key"))
        if open_.isEmpty():
            break
        rows = written(rows.join(open_, "key"))
        keys = rows.groupBy("id").agg(F.collect_list("key").alias("keys"))  # as many as a text has sketches at most
        members = rows.join(keys.join(bag, "id"), "id").where("n = words").withColumn("before", F.expr("filter(keys, x -> x < key)")).drop("keys")
    return star


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_rows and kept of every row of docs.

    Rows of one doc_id are one document. A null text is empty, and empty texts are copies of each other; a row
    with a null doc_id is told apart by its text, and its class has a null class_id if no other id is in it. Texts without
    words are near copies only if they are the same.
    One row of each class is kept: of the least doc_id (none null), of its texts the one of least hash, and of
    repeated rows one. Other columns are ignored; no rows give no rows."""
    rows = _keyed(docs.select("doc_id", "text")).select("doc_id", "_id", "_h")
    classes = components(links(docs), docs.sparkSession)
    rows = written(rows.join(classes.withColumnRenamed("node", "_id"), "_id", "left").withColumn("class", F.coalesce("component", "_id")))
    per_class = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "_id", "_h")).alias("best"))
    per_class = written(per_class)  # so that the join has a shuffle of its own, whose large classes Spark can split
    out = rows.join(per_class, "class")
    best = (F.col("_id") == F.col("best._id")) & (F.col("_h") == F.col("best._h"))
    one = F.row_number().over(Window.partitionBy("_id", "_h").orderBy(F.lit(0))) == 1
    return out.select("doc_id", "class_id", "class_rows", F.when(best, one).otherwise(F.lit(False)).alias("kept"), "_id", "_h")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that near_dedup keeps; all columns of docs, no others."""
    keep = near_dedup(docs).where("kept").select("_id", "_h")
    rows = _keyed(docs).join(keep, ["_id", "_h"])
    turn = F.row_number().over(Window.partitionBy("_id", "_h").orderBy(F.lit(0)))
    return rows.withColumn("_turn", turn).where("_turn = 1").select(*docs.columns)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents")).drop("_id", "_h")
