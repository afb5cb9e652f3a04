"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors u, v with cosine >= c have |u - v|^2 <= 2 - 2c. After one random rotation the coordinates are split
into blocks; at least one block then has no more than its proportional share of that squared distance. Each block is
range-joined: the signs of its leading coordinates, the more the more vectors a label has, make its cells. A vector
lies in one of them and probes those within the block's budget, which holds for all signs together: the squares of the
coordinates that would have to change sign must not exceed it. Of two cells the lower one's vectors probe, so that a pair
meets once. Where they meet, distances over half of the block come first, and only pairs that these don't rule out are
compared further. What is within a block's budget is verified exactly on the whole vectors, and counted in the lowest
block that finds it, so nothing is counted twice.

Exact copies are one vector with a weight. Cells with many vectors are dealt out in chunks, and a task holds one
chunk of homes while probes stream by: it emits sums of links and a spanning forest of them, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import components, map_arrow, read, written

COSINE = 0.93
#: Coordinates to a block, the most of them whose signs make cells, and vectors that a cell is to have.
BLOCK, SIGNS, CELL = 16, 12, 2048
#: Homes to a task at once, and pairs that are compared at once.
CHUNK, AT_ONCE = 2048, 200_000
SEED = 20


def _rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _blocks(size: int) -> list[tuple[int, int]]:
    return [(k, min(k + BLOCK, size)) for k in range(0, size, BLOCK)]


def _usable(vector: Column, label: Column) -> Column:
    """Whether a vector can have links: none of its components null, NaN or infinite, and one of them not 0."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(sound, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _within(squares: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of squares: the sets of its columns, as bits, that add up to the budget at most; as (row, bits), the empty set too."""
    row, bits, total = np.arange(len(squares)), np.zeros(len(squares), np.int64), np.zeros(len(squares))
    for k in range(squares.shape[1]):
        more = total + squares[row, k]
        fits = more <= budget
        row, bits, total = np.concatenate([row, row[fits]]), np.concatenate([bits, bits[fits] | 1 << k]), np.concatenate([total, more[fits]])
    return row, bits


def _cells(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """For each vector and block: its own cell (kind 0), and the cells above that it probes (kind 1)."""
    for batch in batches:
        lengths = np.diff(batch.column("v").offsets.to_numpy())
        for size in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == size)
            v = _matrix(batch.column("v").take(pa.array(rows)), size)
            turned = (v / np.linalg.norm(v, axis=1)[:, None]) @ _rotation(size)
            depth = batch.column("depth").to_numpy(zero_copy_only=False)[rows]
            for k, (low, high) in enumerate(_blocks(size)):
                budget = (2 - 2 * cosine) * (high - low) / size * (1 + 1e-6) + 1e-9
                for d in np.unique(depth).tolist():
                    mine = np.flatnonzero(depth == d)
                    at = turned[mine, low : min(low + d, high)]
                    own = ((at > 0) << np.arange(at.shape[1])).sum(1)
                    row, flips = _within(at**2, budget)
                    cell = own[row] ^ flips
                    up = cell >= own[row]  # the own cell too
                    row, cell = row[up], cell[up]
                    place = pa.array(rows[mine[row]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("label").take(place), pa.array((size * 4096 + k) << 16 | cell), pa.array((cell != own[row]).astype(np.int32)), *(batch.column(x).take(place) for x in ("id", "weight", "v"))],
                        ["label", "cell", "kind", "id", "weight", "v"],
                    )


class _Homes:
    """The homes of a chunk of a cell, and what they and probes have found with them."""

    def __init__(self, label: int, cell: int, cosine: float):
        self.label, self.k, self.size, self.cosine = label, (cell >> 16) % 4096, (cell >> 16) // 4096, cosine
        self.parts: list = []
        self.rotation = _rotation(self.size)
        self.low, self.high = _blocks(self.size)[self.k]
        self.met = self.compared = 0  # pairs that met, and those of which more than half a block was compared

    def add(self, ids: np.ndarray, weight: np.ndarray, v: pa.Array) -> None:
        self.parts.append((ids, weight, *self.turned(v)))

    def turned(self, v: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = _matrix(v, self.size)
        norm = np.linalg.norm(raw, axis=1)
        return raw, norm, np.einsum("ij,jk->ik", raw / norm[:, None], self.rotation)

    def half(self, at: np.ndarray) -> np.ndarray:
        return at[:, (self.low + self.high) // 2 : self.high].astype(np.float32)

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All homes are there; yields what they find among themselves."""
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), *self.turned(pa.array([], pa.list_(pa.float64()))))
        self.ids, self.weight, self.raw, self.norm, self.at = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else empty
        self.found = np.zeros(len(self.ids), np.int64)
        self.top = np.array(self.ids)  # least node known to be linked with each home
        self.near = self.half(self.at)
        yield from self.met_by(self.ids, self.weight, self.raw, self.norm, self.at, True)

    def probe(self, ids: np.ndarray, weight: np.ndarray, v: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        yield from self.met_by(ids, weight, *self.turned(v), False)

    def met_by(self, ids: np.ndarray, weight: np.ndarray, raw: np.ndarray, norm: np.ndarray, at: np.ndarray, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Yields (node, links, linked node): what vectors find among the homes; own: those are the homes, and a pair counts once."""
        near = self.half(at)
        share = (2 - 2 * self.cosine) / self.size
        most = np.float32(share * (self.high - self.low) + 1e-5)
        step = max(1, AT_ONCE // max(1, len(self.ids)))
        squares = (self.near**2).sum(1)
        for k in range(0, len(ids), step):
            x, base = near[k : k + step], k + 1 if own else 0
            d = x @ self.near[base:].T
            d *= -2
            d += squares[base:]
            i, j = np.nonzero(d <= (most - (x**2).sum(1))[:, None])
            i, j = i + k, j + base
            if own:
                i, j = i[j > i], j[j > i]
            self.met += len(x) * (len(self.ids) - base)
            self.compared += len(i)
            apart = (at[i] - self.at[j]) ** 2
            first = np.full(len(i), -1)
            for b, (low, high) in reversed(list(enumerate(_blocks(self.size)))):
                first[apart[:, low:high].sum(1) <= share * (high - low) + 1e-9] = b
            i, j = i[first == self.k], j[first == self.k]
            hit = (raw[i] * self.raw[j]).sum(1) / (norm[i] * self.norm[j]) >= self.cosine
            i, j = i[hit], j[hit]
            if not len(i):
                continue
            np.add.at(self.found, j, weight[i])
            label = np.array(ids)
            while True:  # the least node of each component of these links
                now, then = label.copy(), self.top.copy()
                np.minimum.at(self.top, j, label[i])
                np.minimum.at(label, i, self.top[j])
                if (now == label).all() and (then == self.top).all():
                    break
            rows = np.unique(i)
            yield ids[rows], np.bincount(i, self.weight[j], len(ids))[rows].astype(np.int64), label[rows]
            touched = np.unique(j)
            yield self.ids[touched], np.zeros(len(touched), np.int64), self.top[touched]

    def ended(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.found)
        return self.ids[rows], self.found[rows], self.top[rows]


def _joined(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (label, cell, chunk, kind): homes first, then the probes of each group."""
    homes, key, open_ = None, None, False

    def out(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["id", "links", "linked"])

    def ended() -> Iterator[pa.RecordBatch]:
        if homes is not None:
            if open_:
                yield from map(out, homes.close())
            yield out(homes.ended())

    for batch in batches:
        label, cell, chunk, kind, ids, weight = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("label", "cell", "chunk", "kind", "id", "weight"))
        new = np.ones(len(ids), bool)
        new[1:] = (label[1:] != label[:-1]) | (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])
        at = np.append(np.flatnonzero(new), len(ids))
        for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            this = (int(label[low]), int(cell[low]), int(chunk[low]))
            if this != key:
                yield from ended()
                homes, key, open_ = _Homes(this[0], this[1], cosine), this, True
            v = batch.column("v").slice(low, high - low)
            if not kind[low]:
                homes.add(ids[low:high], weight[low:high], v)
                continue
            if open_:
                yield from map(out, homes.close())
                open_ = False
            if len(homes.ids):
                yield from map(out, homes.probe(ids[low:high], weight[low:high], v))
    yield from ended()


def _dealt(one: DataFrame, cosine: float) -> DataFrame:
    """The vectors by (label, cell, chunk, kind): each in a chunk of its own cell, and as a probe in every chunk that it has to meet."""
    kind = dict(one.dtypes)["v"]
    sizes = one.groupBy("label").agg(F.least(F.lit(SIGNS), F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / CELL)))).cast("int").alias("depth"))
    routed = one.join(sizes, "label").select("label", "depth", "id", "weight", "v")
    cells = map_arrow(routed, lambda b: _cells(b, cosine), f"label long, cell long, kind int, id long, weight long, v {kind}")
    counts = cells.where("kind = 0").groupBy("label", "cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    met = cells.join(counts, ["label", "cell"])  # a probe of a cell without homes goes
    own = F.pmod(F.hash("id"), "chunks").cast("int")
    above = F.expr("transform(sequence(0, chunks - 1), x -> struct(x AS chunk, 1 AS kind))")
    mine = F.filter(above, lambda x: x["chunk"] > own)
    at = F.when(F.col("kind") == 1, above).otherwise(F.concat(F.array(F.struct(own.alias("chunk"), F.lit(0).alias("kind"))), mine))
    return met.withColumn("at", F.explode(at)).select("label", "cell", "at.chunk", "at.kind", "id", "weight", "v")


def embedding_near_dedup(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding, label).

    A row is a vector; repeated rows and copies link with each other, and rows of one vec_id with other vectors are told
    apart. Vectors of other lengths never link. A row without a usable vector or label has no links and is its own
    component. component_id is the least vec_id of the component, negative ones too; a null one counts only if there is
    no other, and then component_id is null and the row is kept. Embeddings of doubles are compared as such. Other columns
    are ignored; no rows give no rows."""
    spark = vectors.sparkSession
    v = F.col("embedding") if dict(vectors.dtypes)["embedding"] == "array<float>" else F.col("embedding").cast("array<double>")
    raw = vectors.select("vec_id", v.alias("v"), F.col("label").cast("long").alias("label"))
    usable = F.coalesce(_usable(F.col("v"), F.col("label")), F.lit(False))
    rows = raw.select("vec_id", usable.alias("usable"), "label", F.when(usable, F.col("v")).alias("v"), F.xxhash64("v").alias("k"), F.xxhash64(F.lit("v"), "v").alias("l"))
    one = rows.where("usable").groupBy("label", "k", "l").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("v").alias("v"))
    one = written(one.withColumn("id", F.monotonically_increasing_id()))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(one, cosine).repartition(n, "label", "cell", "chunk").sortWithinPartitions("label", "cell", "chunk", "kind")
    found = written(map_arrow(dealt, lambda b: _joined(b, cosine), "id long, links long, linked long"))
    classes = written(components(found.where("id <> linked").select(F.col("id").alias("a"), F.col("linked").alias("b")), spark))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    nodes = one.select("label", "k", "l", "id", "weight", "least").join(sums, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left")
    linked = nodes.where("component is not null").select("component", "least")
    least = written(linked.groupBy("component").agg(F.min("least").alias("lowest")))  # the join has a shuffle of its own, which Spark can split
    nodes = nodes.join(least, "component", "left").select(
        "label", "k", "l", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("lowest"), F.lit(True).alias("usable")
    )
    out = rows.select("vec_id", "usable", "label", "k", "l").join(nodes, ["usable", "label", "k", "l"], "left")
    component = F.when(F.col("usable"), F.col("lowest")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(read(spark, sf_dir, "embeddings"))


OP8_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT vec_id node, vec_id seen FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) n_links, c.component_id, e.vec_id = c.component_id kept
FROM embeddings e JOIN (SELECT node, min(seen) component_id FROM reach GROUP BY node) c ON c.node = e.vec_id
"""
