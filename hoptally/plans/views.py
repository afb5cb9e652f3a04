"""Counters, packets, lines and file listings derived from the events table, so that queries grow with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.functions.model import KEY, MINUTE, TIERS, bucket_sums, minute_text


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ms, k, topic, cluster, hostname, n, value, ts."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        "event_id", F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("ms"),
        F.regexp_extract("props", r'"k": *([0-9]+)', 1).cast("int").alias("k"), F.col("event_type").alias("topic"),
        F.concat(F.lit("cluster"), (F.col("user_id") % 2).cast("string")).alias("cluster"),
        F.concat(F.lit("host"), F.expr("(user_id div 2) % 3").cast("string")).alias("hostname"),
        (F.floor("value") + 1).cast("long").alias("n"), "value", "ts",
    )


def tuple_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event's counts at each tier that it reached."""
    e = events(spark, sf_dir).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(6)))).where("(event_id * 7 + r) % 101 >= r")
    tier = F.element_at(F.array(*map(F.lit, TIERS)), F.col("r") + 1)
    return e.select(
        "event_id", (F.col("ms") - F.col("ms") % MINUTE).alias("timeinterval"), "hostname", tier.alias("tier"), "topic", "cluster", "n",
        F.expr("(((k * k) div 12) * (r + 1)) div 7").alias("latency_min"), F.when(F.col("r").isin(1, 2), F.col("n")).otherwise(0).alias("sent"),
    )


def summed(source: DataFrame) -> DataFrame:
    from hoptally.functions.model import latency_bucket

    rows = source.withColumn("_edge", latency_bucket(F.col("latency_min") * MINUTE))
    return rows.groupBy(*KEY).agg(F.sum("sent").alias("sent"), *bucket_sums(F.col("_edge"), F.col("n")))


def tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summed(tuple_source(spark, sf_dir))


def day_tuples(spark: SparkSession, sf_dir: str, batch: bool) -> DataFrame:
    """Tuples by day, of odd events (batch) or even ones."""
    source = tuple_source(spark, sf_dir).where(F.col("event_id") % 2 == (1 if batch else 0))
    return summed(source.withColumn("timeinterval", F.col("timeinterval") - F.col("timeinterval") % 86_400_000))


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    start = F.col("ms") - F.col("ms") % MINUTE
    one, two = start - (F.col("k") % 6) * MINUTE, start - (F.col("k") % 4) * MINUTE
    tier = F.element_at(F.array(*map(F.lit, TIERS)), (F.col("event_id") % 3).cast("int") + 1)
    entries = lambda n: F.when(one == two, F.map_from_arrays(F.array(one), F.array(n))).otherwise(F.map_from_arrays(F.array(one, two), F.array(n, F.expr("n div 3"))))
    return e.select(
        "event_id", F.col("ms").alias("timestamp"), F.lit(60).alias("window_size"), tier.alias("tier"), "topic", "hostname", "cluster",
        entries(F.col("n")).alias("received"), entries(F.expr("n div 2")).alias("sent"),
    )


def _listing(e: DataFrame, root: Column, minute: Column, name: Column) -> DataFrame:
    path = F.concat_ws("/", root, F.col("topic"), minute_text(minute), name)
    return e.select(
        "cluster", root.alias("root"), F.col("topic").alias("stream"), minute.alias("minute"), name.alias("name"), path.alias("path"), F.lit(False).alias("is_dir"),
        F.when(F.col("event_id") % 11 == 0, 0).otherwise(F.floor(F.col("value") * 100)).cast("long").alias("length"), (F.col("ms") + F.col("event_id") % 5 * 90_000).alias("mtime"),
        "event_id",
    )


def _name(prefix: str = "") -> Column:
    minute = F.col("ms") - F.col("ms") % MINUTE
    return F.concat(F.lit(prefix), "cluster", F.lit("-"), "topic", F.lit("-"), minute_text(minute, "yyyy-MM-dd-HH-mm"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".gz"))


def listing(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """The files of local, merge (some missing, some twice) or mirror (of merge, some missing, some extra)."""
    e = events(spark, sf_dir)
    minute = F.col("ms") - F.col("ms") % MINUTE
    if side == "local":
        return _listing(e, F.lit("local"), minute, _name())
    merge = _listing(e.where("event_id % 50 <> 7"), F.lit(side), minute, _name()).unionByName(_listing(e.where("event_id % 97 = 3"), F.lit(side), minute + MINUTE, _name()))
    if side == "merge":
        return merge
    return merge.where("event_id % 40 <> 9").unionByName(_listing(e.where("event_id % 89 = 5"), F.lit(side), minute, _name("extra-")))


def stream_source(spark: SparkSession) -> DataFrame:
    rows = [("click", "cluster0", 24, True), ("click", "cluster1", 24, True), ("view", "cluster0", 24, True), ("view", "cluster1", 48, True), ("purchase", "cluster0", 24, True), ("signup", "cluster1", 24, True), ("error", "cluster1", 12, False)]
    return spark.createDataFrame(rows, "stream string, cluster string, retention_h int, enabled boolean")


def stream_dest(spark: SparkSession) -> DataFrame:
    rows = [("click", "cluster0", True, 72), ("view", "cluster1", True, 72), ("purchase", "cluster1", True, 48), ("signup", "cluster0", True, 48), ("click", "cluster1", False, 36), ("view", "cluster0", False, 36)]
    return spark.createDataFrame(rows, "stream string, cluster string, is_primary boolean, retention_h int")
