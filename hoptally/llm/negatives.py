"""Hard negatives by segment summary filtering.

A vector is cut into segments, and each segment's mean and deviation are stored. Over a segment of m components the inner
product of two vectors is m * mean * mean, give or take m * deviation * deviation (Cauchy's inequality on what is left beside
the means); summed over the segments this bounds the score from both sides. Segments are refined in levels of 1, 4 and 16:
a pair whose bounds can't reach what an anchor still wants goes, the others meet finer segments, and what is left is scored
exactly. Coarser summaries follow from the finest ones, which are all that is stored.

Work is dealt out in tiles: the vectors in chunks, the anchors (a stated query set) in blocks, each pair of them a group that one
task streams through, with the best of each anchor as its bound. What leaves a task are at most the few best of each anchor.
Positives meet within their label, whose chunks deal out a hot one; negatives meet all chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, written

#: Fixed values of the contract.
SCALE, EVERY, RELABEL, LABELS, POSITIVES, NEGATIVES, LEAST, MOST = 256, 100, 7, 10, 5, 10, 30, 90
#: Segments of each level. The last is stored.
LEVELS = (1, 4, 16)
#: Vectors to a chunk and anchors to a block, at most, and pairs that are looked at at once.
CHUNK, BLOCK, AT_ONCE = 8192, 8192, 1 << 18
#: Anchors that are looked at at once.
TALL = 256
#: Chunks to a shuffle partition, while chunks have LEAST_CHUNK vectors or more.
SPREAD, LEAST_CHUNK = 2, 512
#: Below this share of pairs left, they are scored one by one.
SPARSE = 0.05
#: Sums up to here are exact in doubles.
EXACT = 2.0**53
LAST = 2**63 - 1


def cuts(size: int, segments: int) -> np.ndarray:
    """Where the segments start, and the end; those of 4 * n segments lie within those of n."""
    return np.arange(segments + 1) * size // segments


def summaries(v: np.ndarray, segments: int = LEVELS[-1]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment, 0 for an empty one."""
    at = cuts(v.shape[1], segments)
    m = np.diff(at)
    mean, dev = np.zeros((2, len(v), segments))
    for s in np.flatnonzero(m):
        part = v[:, at[s] : at[s + 1]]
        mean[:, s] = part.mean(1)
        dev[:, s] = part.std(1)
    return mean, dev


def folded(mean: np.ndarray, dev: np.ndarray, size: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The summaries of fewer segments, each times the root of its length, so that products of them are sums over segments."""
    fine = len(mean[0]) if len(mean) else LEVELS[-1]
    m = np.diff(cuts(size, fine)).astype(float)
    group = fine // segments
    whole = m.reshape(segments, group).sum(1)
    some = np.maximum(whole, 1)
    first = (mean * m).reshape(len(mean), segments, group).sum(2) / some
    second = ((dev**2 + mean**2) * m).reshape(len(mean), segments, group).sum(2) / some
    return first * np.sqrt(whole), np.sqrt(np.maximum(second - first**2, 0) * whole)


@dataclass
class Side:
    """Vectors of one length, with their summaries at each level."""

    ids: np.ndarray
    uid: np.ndarray
    label: np.ndarray
    v: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    norm: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, size: int) -> Side:
        ids, uid, label = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "uid", "label"))
        v, mean, dev = (batch.column(x).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), n) for x, n in (("v", size), ("mean", LEVELS[-1]), ("dev", LEVELS[-1])))
        return cls(ids, uid, label, v, [folded(mean, dev, size, s) for s in LEVELS], np.sqrt((v**2).sum(1)))

    def rows(self, at: np.ndarray | slice) -> Side:
        return Side(self.ids[at], self.uid[at], self.label[at], self.v[at], [(a[at], b[at]) for a, b in self.levels], self.norm[at])

    @staticmethod
    def joined(parts: list[Side]) -> Side:
        one = lambda f: np.concatenate([f(p) for p in parts])
        levels = [(one(lambda p, k=k: p.levels[k][0]), one(lambda p, k=k: p.levels[k][1])) for k in range(len(LEVELS))]
        return Side(one(lambda p: p.ids), one(lambda p: p.uid), one(lambda p: p.label), one(lambda p: p.v), levels, one(lambda p: p.norm))


class Miner:
    """The anchors of a block, the ranges of scores that each wants, and the best of each range so far."""

    def __init__(self, anchors: Side, owner: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, same: bool):
        """Range k wants the `most` highest scores from low[k] to high[k] of anchor owner[k] (ascending), of its label (same) or others."""
        self.anchors, self.owner, self.low, self.high, self.most, self.same = anchors, owner, low, high, most, same
        self.first = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
        self.bar = low.copy()  # what a score has to reach
        self.best: dict[int, list[np.ndarray]] = {}  # by the first anchor of some: range, score, id
        self.pairs = self.scored = 0

    def meet(self, other: Side) -> None:
        """Takes in a chunk of vectors, block by block."""
        wide = max(1, AT_ONCE // TALL)
        for a in range(0, len(self.anchors.ids), TALL):
            rows = np.arange(a, min(a + TALL, len(self.anchors.ids)))
            rows = rows[self.first[rows + 1] > self.first[rows]]
            for b in range(0, len(other.ids), wide):
                if len(rows):
                    self._block(a, rows, other.rows(slice(b, b + wide)))

    def _block(self, some_of: int, rows: np.ndarray, other: Side) -> None:
        mine = self.anchors.rows(rows)
        ranges = np.concatenate([np.arange(self.first[r], self.first[r + 1]) for r in rows])
        at = np.searchsorted(rows, self.owner[ranges])
        need, top = np.full(len(rows), np.inf), np.full(len(rows), -np.inf)
        np.minimum.at(need, at, self.bar[ranges].astype(np.float64))
        np.maximum.at(top, at, self.high[ranges].astype(np.float64))
        alive = (mine.label[:, None] == other.label[None, :]) == self.same
        alive &= mine.uid[:, None] != other.uid[None, :]
        self.pairs += int(alive.sum())
        size = mine.v.shape[1]
        slack = 1e-7 * mine.norm[:, None] * other.norm[None, :] + 1e-9
        for k, segments in enumerate(LEVELS):
            if segments * 2 > size:
                break  # summaries of so few components cost as much as they do
            (ma, da), (mb, db) = mine.levels[k], other.levels[k]
            middle, give = ma @ mb.T, da @ db.T + slack
            alive &= ~((middle + give < need[:, None]) | (middle - give > top[:, None]))  # what isn't a number rules nothing out
            some = alive.any(0)
            if not some.any():
                return
            if not some.all():
                other, alive, slack = other.rows(some), alive[:, some], slack[:, some]
        self.scored += int(alive.sum())
        i, j = np.nonzero(alive)
        if mine.norm.max(initial=0) * other.norm.max(initial=0) >= EXACT:  # beyond what doubles hold: exact, as whole numbers of any size
            score = [sum(int(x) * int(y) for x, y in zip(mine.v[p], other.v[q], strict=True)) for p, q in zip(i, j, strict=True)]
            score = np.array([max(-LAST, min(LAST, x)) for x in score], np.int64)
        elif alive.mean() < SPARSE:
            score = np.einsum("ij,ij->i", mine.v[i], other.v[j]).astype(np.int64)
        else:
            score = (mine.v @ other.v.T)[i, j].astype(np.int64)
        # each pair with each range of its anchor
        begin, n = self.first[rows[i]], self.first[rows[i] + 1] - self.first[rows[i]]
        for k in range(int(n.max(initial=0))):
            has = n > k
            r = begin[has] + k
            s = score[has]
            fits = (s >= self.bar[r]) & (s <= self.high[r])
            if fits.any():
                self._take(some_of, r[fits], s[fits], other.ids[j[has][fits]])

    def _take(self, some_of: int, *found: np.ndarray) -> None:
        """Of what is known and found, the best of each range stay; once there are enough, the last of them is the bar."""
        known = self.best.get(some_of)
        r, s, i = (np.concatenate(x) for x in zip(known, found, strict=True)) if known else found
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        last = place == self.most - 1
        self.bar[r[last]] = s[last]
        keep = place < self.most
        self.best[some_of] = [r[keep], s[keep], i[keep]]


def _streamed(batches: Iterator[pa.RecordBatch], most: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by GROUP and kind: of each group the anchors come first, then the vectors that meet them.

    Yields (uid, place, score, id): what each range of each anchor has found in the chunks of its block that this task holds."""
    miner, key, waiting = None, None, []

    def opened() -> Miner:
        parts, ranges = [p for p, _ in waiting], [r for _, r in waiting]
        anchors = Side.joined(parts)
        n = np.concatenate([x[0] for x in ranges])
        place = np.arange(len(anchors.ids)).repeat(n)
        return Miner(anchors, place, np.concatenate([x[1] for x in ranges]), np.concatenate([x[2] for x in ranges]), most, same)

    def closed() -> Iterator[pa.RecordBatch]:
        for r, s, i in miner.best.values() if miner else ():
            owner = miner.owner[r]
            columns = [pa.array(miner.anchors.uid[owner]), pa.array((r - miner.first[owner]).astype(np.int32)), pa.array(s), pa.array(i)]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "place", "score", "id"])

    for batch in batches:
        keys = [batch.column(x).to_numpy(zero_copy_only=False) for x in (*GROUP, "kind")]
        change = np.ones(batch.num_rows, bool)
        change[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
        at = np.append(np.flatnonzero(change), batch.num_rows)
        for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            this, kind = tuple(int(x[low]) for x in keys[:-1]), int(keys[-1][low])
            if this != key:
                yield from closed()
                miner, key, waiting = None, this, []
            part = batch.slice(low, high - low)
            side = Side.of(part, this[0])
            if kind == 0:
                wants = part.column("wants")
                n = np.diff(wants.offsets.to_numpy())
                flat = wants.flatten()
                waiting.append((side, (n, flat.field("low").to_numpy(zero_copy_only=False), flat.field("high").to_numpy(zero_copy_only=False))))
            elif waiting:
                if miner is None:
                    miner = opened()
                miner.meet(side)
    yield from closed()


WANTS = "array<struct<low: long, high: long>>"
#: What makes a tile: vectors of one size, of one label if positives are asked for, an anchors' block and a vectors' chunk.
GROUP = ["size", "within", "block", "chunk"]


def _chunks(rows: Column, n: int) -> Column:
    """How many chunks so many rows are dealt out to."""
    return F.greatest(F.ceil(rows / CHUNK), F.least(F.lit(n * SPREAD), F.ceil(rows / LEAST_CHUNK))).cast("int")


def _mined(vectors: DataFrame, anchors: DataFrame, most: int, same: bool) -> DataFrame:
    """uid, place (of the range), score, id: the `most` highest scores in each range of each anchor's wants, of the same label or of others.

    vectors and anchors (with wants): size, id, uid, label, v, mean, dev."""
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["size", "label"] if same else ["size"]
    asked = anchors.groupBy(by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    counts = written(vectors.groupBy(by).agg(F.count("*").alias("n")).join(asked, by).select(*by, _chunks(F.col("n"), n).alias("chunks"), "blocks"))
    own = ["size", "id", "uid", "label", "v", "mean", "dev", (F.col("label") if same else F.lit(0).cast("long")).alias("within")]
    dealt = vectors.join(counts, by).select(*own, F.pmod(F.hash("uid"), "chunks").cast("int").alias("chunk"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    asking = anchors.join(counts, by).select(*own, "wants", F.pmod(F.xxhash64("uid"), "blocks").cast("int").alias("block"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"))
    both = asking.withColumn("kind", F.lit(0)).unionByName(dealt.withColumns({"kind": F.lit(1), "wants": F.lit(None).cast(WANTS)}))
    both = both.repartition(n, *GROUP).sortWithinPartitions(*GROUP, "kind")
    best = map_arrow(both, lambda b: _streamed(b, most, same), "uid long, place int, score long, id long")
    order = Window.partitionBy("uid", "place").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _prepared(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """The vectors as whole numbers, with their finest summaries."""
    for batch in batches:
        sizes = np.diff(batch.column("v").offsets.to_numpy())
        for size in np.unique(sizes).tolist():
            part = batch.take(pa.array(np.flatnonzero(sizes == size)))
            v = np.floor(scale * part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(part.num_rows, size)
            mean, dev = summaries(v)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in (v, mean, dev)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, size, np.int32)), part.column("id"), part.column("label"), *lists], ["size", "id", "label", "v", "mean", "dev"])


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from vectors (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by EVERY. A row without a label or a sound vector takes no part; one without a
    vec_id can be found, as the last among ties, but is no anchor. Rows are told apart, so repeated rows are others to each other and a
    vec_id that stands twice is two anchors. Vectors meet those of their own length only. Scores are exact; those beyond a long
    are taken as its end. An anchor without positives, or a positive without negatives in its range, has no rows; no rows give none.
    Other columns are ignored, whatever their names."""
    v = F.col("embedding")
    sound = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    label = F.col("label").cast("long")
    rows = vectors.where(sound).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"),
        F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        v.alias("v"),
    )
    plain = map_arrow(rows, lambda b: _prepared(b, SCALE), "size int, id long, label long, v array<double>, mean array<double>, dev array<double>")
    one = written(plain.withColumn("uid", F.monotonically_increasing_id()))
    anchors = one.where((F.col("id") % EVERY == 0) & (F.col("id") != LAST))
    everything = F.array(F.struct(F.lit(-LAST).alias("low"), F.lit(LAST).alias("high")))
    positives = written(_mined(one, anchors.withColumn("wants", everything), POSITIVES, True).select("uid", "rank", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")))
    wide = lambda share: F.col("positive_score").cast("decimal(22,0)") * share / 100
    ends = positives.withColumns({"low": F.ceil(wide(LEAST)).cast("decimal(22,0)"), "high": F.floor(wide(MOST)).cast("decimal(22,0)")})
    wants = ends.groupBy("uid").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))), lambda x: F.struct(x["low"].cast("long").alias("low"), x["high"].cast("long").alias("high"))).alias("wants"))
    asking = written(anchors.join(wants, "uid"))
    found = _mined(one, asking, NEGATIVES, False)
    found = found.select("uid", (F.col("place") + 1).alias("at"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select("uid", F.col("id").alias("anchor_id")).join(positives.withColumnRenamed("rank", "at"), "uid")
    back = lambda c: F.when(F.col(c) != LAST, F.col(c)).alias(c)
    return found.join(named, ["uid", "at"]).select("anchor_id", back("positive_id"), "rank", back("negative_id"), "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {RELABEL} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id anchor_id, b.vec_id other, a.label = b.label same, CAST(list_inner_product(a.e, b.e) AS BIGINT) score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, other positive_id, score positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other negative_id, positive_score, score negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
