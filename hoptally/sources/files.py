"""Reading and writing lines, tuples and listings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.functions.model import KEY, minute_text, time_range
from hoptally.sources.minutes import registered


def scratch(spark: SparkSession) -> str:
    """A new folder where all executors can write, below spark.checkpoint.dir; where that is unset a temporary one in local mode,
    and a ValueError on a cluster, whose machines wouldn't share it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base or tempfile.mkdtemp(prefix='hoptally-')}/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read back: for sums that a plan would else work out several times."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_lines(spark: SparkSession, path: str | list[str], raw: bool = False) -> DataFrame:
    """value, stream, collector, file and path of text files, gzipped or not; empty files give no rows.

    Files lie below stream=<name>/ and maybe collector=<name>/ (else collector is null), or, if raw, as <stream>/<collector>/<file>."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    at = F.col("_metadata.file_path")
    part = F.split(at, "/")
    named = lambda name: F.nullif(F.regexp_extract(at, f"/{name}=([^/]+)/", 1), F.lit(""))
    stream, collector = (F.element_at(part, -3), F.element_at(part, -2)) if raw else (F.coalesce(named("stream"), F.lit("")), named("collector"))
    return lines.select("value", stream.alias("stream"), collector.alias("collector"), F.element_at(part, -1).alias("file"), at.alias("path"))


def write_minute_partitions(lines: DataFrame, path: str, commit_minute: F.Column, batch: int | None = None) -> None:
    """value as gzipped text under stream/year/month/day/hour/minute of the commit minute (epoch milliseconds).

    With a batch its files lie in a folder batch=<id> of their minute, and replace those of the same batch, so that a
    batch can be written again. Large minutes are split among tasks, small ones share them."""
    parts = {n: minute_text(commit_minute, p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"), ("minute", "mm"))}
    rows = lines.select("value", "stream", *(c.alias(n) for n, c in parts.items()), *([] if batch is None else [F.lit(batch).alias("batch")]))
    by = [c for c in rows.columns if c != "value"]
    out = rows.hint("rebalance", *by).write.partitionBy(*by).option("compression", "gzip")
    (out.mode("append") if batch is None else out.mode("overwrite").option("partitionOverwriteMode", "dynamic")).text(path)


def write_tuples(tuples: DataFrame, path: str) -> None:
    """Tuples as Parquet by day; days that they hold are replaced, all others stay. Large days are split among tasks."""
    day = F.to_date(F.timestamp_millis("timeinterval"))
    rows = tuples.withColumn("day", day).hint("rebalance", "day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_tuples(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Tuples of [start, end), from the folders of those days alone."""
    rows = spark.read.parquet(path)
    if start is not None and end is not None:
        rows = rows.where(F.col("day").between(F.to_date(F.timestamp_millis(F.lit(start))), F.to_date(F.timestamp_millis(F.lit(end))))).where(time_range(start, end))
    return rows.drop("day").select(*KEY, *(c for c in rows.columns if c not in {*KEY, "day"}))


def read_listing(spark: SparkSession, path: str, cluster: str, root: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Files and empty minutes below path as a listing (LISTING) of the minutes [start, end); without both bounds all of them.

    An empty minute is a row with is_dir, its folder's name and path, and no length. Folders are listed by tasks (sources.minutes), those of
    the hours in range alone; contents aren't read."""
    rows = registered(spark).read.format("minute_listing").options(path=path, cluster=cluster, root=root)
    if start is None or end is None:
        return rows.load()
    return rows.options(start=start, end=end).load().where((F.col("minute") >= start) & (F.col("minute") < end))


def collapse_lines(lines: DataFrame) -> DataFrame:
    """The distinct trimmed lines."""
    return lines.select(F.trim("value").alias("value")).distinct()


def _timeline_points(series: DataFrame) -> DataFrame:
    """tier, time and point: the JSON of a moment, with its clusters and their topics."""
    topics = series.where("level = 2").groupBy("tier", "time", "cluster").agg(F.array_sort(F.collect_list(F.struct("topic", "received", "sent"))).alias("topics"))
    clusters = series.where("level = 1").join(topics, ["tier", "time", "cluster"]).groupBy("tier", "time").agg(F.array_sort(F.collect_list(F.struct("cluster", "received", "sent", "topics"))).alias("clusters"))
    return series.where("level = 0").join(clusters, ["tier", "time"]).select("tier", "time", F.to_json(F.struct("time", "received", "sent", "clusters")).alias("point"))


def to_timeline_json(series: DataFrame) -> DataFrame:
    """One document a tier from timeline_grouping_sets: by time its sums, clusters and their topics. A document is a row, so this is for
    series that fit in one; write_timeline_json is for all others."""
    points = _timeline_points(series).groupBy("tier").agg(F.array_sort(F.collect_list(F.struct("time", "point"))).alias("points"))
    head = F.concat(F.lit('{"tier":'), F.regexp_extract(F.to_json(F.struct("tier")), "^.[^:]*:(.*).$", 1), F.lit(',"points":['))
    return points.select("tier", F.concat(head, F.array_join("points.point", ","), F.lit("]}")).alias("json"))


def write_timeline_json(series: DataFrame, path: str) -> None:
    """The documents of to_timeline_json, written in order by tasks, however long they are: path/tier=<tier>/part-*.txt, which one after
    the other are the tier's document, a line a moment. Nothing holds more than a moment of a document."""
    points = settled(_timeline_points(series))
    ends = points.groupBy("tier").agg(F.min("time").alias("first"), F.max("time").alias("last"))
    head = F.concat(F.lit('{"tier":'), F.regexp_extract(F.to_json(F.struct("tier")), "^.[^:]*:(.*).$", 1), F.lit(',"points":['))
    line = F.concat(F.when(F.col("time") == F.col("first"), head).otherwise(","), "point", F.when(F.col("time") == F.col("last"), "]}").otherwise(""))
    rows = points.join(F.broadcast(ends), "tier").select("tier", "time", line.alias("value"))  # a row a tier
    rows.repartitionByRange("tier", "time").sortWithinPartitions("tier", "time").select("tier", "value").write.partitionBy("tier").text(path)


def read_timeline_points(spark: SparkSession, path: str) -> DataFrame:
    """tier and point (JSON) of all moments of the documents, in no order."""
    lines = spark.read.text(path)
    point = F.regexp_replace("value", r'^(\{"tier":.*?,"points":\[|,)(?=\{"time":)', "")
    return lines.select("tier", F.when(F.col("value").endswith("}]}]}]}"), F.regexp_replace(point, r"\]\}$", "")).otherwise(point).alias("point"))


def to_topology_json(nodes: DataFrame) -> DataFrame:
    return nodes.select("name", "cluster", "tier", F.to_json(F.struct(*nodes.columns)).alias("json"))
