"""What the corpus operators share: reading, cutting lineage, word arrays, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The bytes that separate words: space and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes to a batch between Spark and Python.
BATCH = "4m"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it; where it is unset one of our own in local mode, and a
    ValueError on a cluster, whose machines wouldn't share it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="hoptally-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """The same rows read back from Parquet in the shared folder: lineage ends here and lost executors cost nothing.

    row_group: bytes that are read at once, for rows that are large."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hoptally-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Adds _id (doc_id, a null last) and _h (hash of the text, null as empty).

    Rows that agree in both are one document to the operators that use this key."""
    return df.withColumns(
        {
            "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)),
            "_h": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        }
    )


def fold(id_col: str, parts: int) -> F.Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """df.mapInArrow(run, schema) in batches of at most BATCH bytes: batches of long texts take as much memory outside of the
    heap, on both sides."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) != BATCH:
        conf.set(name, BATCH)
    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of at most `most` bytes of `column`, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            base = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, base + most, "right")))
            yield batch.slice(at, end - at)
            at = end
        pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """The words of some texts, as arrays over all of them."""

    buf: np.ndarray  # bytes of all texts
    text_at: np.ndarray  # where each text starts in buf, and the end
    start: np.ndarray  # of each word, in buf
    end: np.ndarray
    first: np.ndarray  # of each text, its first word; and the number of words
    array: pa.Array  # the words themselves

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of bytes other than space and 0x09-0x0D; lower: A-Z in lower case. A null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = texts.buffers()[2] if n else None
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        buf = _LOWER[buf]
    solid = ~_SPACE[buf]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    if len(buf):
        inner = at[1:-1]
        inner = inner[(inner > 0) & (inner < len(buf))]
        begins[inner] |= solid[inner]
        ends[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    array = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[solid])))
    return Words(buf, at, start, end, np.searchsorted(start, at), array)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that close inputs give unrelated outputs."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _stars(edges: DataFrame) -> bool:
    """Whether of the edges (a, b), a > b, no node is twice an a or both an a and a b."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def nearer_stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, with the same components as those given, which are of that kind, and nearer to stars: a round of large-star and small-star.

    Hubs are joined by (node, salt), so that no task gets all of one."""
    salt = 16
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    spread = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    large = (
        both.where("b > a").withColumn("s", F.pmod(F.hash("b"), F.lit(salt))).join(spread, ["a", "s"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    large = written(large.where("a <> b"))  # an edge of each at most
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    spread = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    small = large.withColumn("s", F.pmod(F.hash("b"), F.lit(salt))).join(spread, ["a", "s"])
    small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return small.where("a <> b").distinct()


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """node, component (the smallest node reachable) of every node of the edges (a, b).

    Alternates large-star and small-star until only stars are left; each round is written to the shared folder, and nothing but
    whether it was the last reaches the driver."""
    cur = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not _stars(cur):
        cur = written(nearer_stars(cur))
    star = cur.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return star.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
