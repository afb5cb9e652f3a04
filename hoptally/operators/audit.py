"""Counting, packets to tuples, queries over tuples, and keeping the fact table up to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptally.functions.model import BUCKETS, HOUR, KEY, MEASURES, MINUTE, bucket_sums, filter_condition, latency_bucket, lost, parse_group_by, parse_percentiles, percentile_columns, publish_window, received, tier_rank, time_range


def window_counts(lines: DataFrame, publish_time: Column | None = None) -> DataFrame:
    """Messages by stream, file and publish minute; lines without a time (-1 or null) don't count."""
    ms = publish_time if publish_time is not None else F.col("publish_ms")
    return lines.withColumn("window", publish_window(ms)).where(ms >= 0).groupBy("stream", "file", "window").agg(F.count("*").alias("n"))


def parse_counters(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """stream#file#window#count lines as rows. Bad lines go; of a window that a file counts twice (in one value of the columns `by`) the greater count stays."""
    part, by = F.split("value", "#"), by or []
    rows = lines.select(*by, part[0].alias("stream"), F.get(part, F.lit(1)).alias("file"), F.get(part, F.lit(2)).try_cast("long").alias("window"), F.get(part, F.lit(3)).try_cast("long").alias("n"))
    return rows.where("file is not null and `window` is not null and n is not null").groupBy(*by, "stream", "file", "window").agg(F.max("n").alias("n"))


def counters_to_audit(counters: DataFrame, committed: DataFrame) -> DataFrame:
    """One packet for each committed file (stream, file) that has counters: the count by window. Streams named _audit are left out."""
    both = counters.join(committed.select("stream", "file").distinct(), ["stream", "file"]).where("stream <> '_audit'")
    return both.groupBy("stream", "file").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("window", "n")))).alias("received"))


def align_messages(packets: DataFrame) -> DataFrame:
    """Each entry of a packet split over the two windows that its packet's time lies between.

    Columns: those of the packet but its maps, message_time (the boundary), window (the entry's start), received and sent. With t the packet's time, w its
    window and lo = t - t % w: an entry older than a window gives int(float((t - lo) / w) * float(n)) to lo + w, in
    single precision, and the rest to lo; any other gives all to lo + w."""
    w, t = F.col("window_size") * 1000, F.col("timestamp")
    keep = [c for c in packets.columns if c not in {"received", "sent"}]
    entries = lambda name: F.map_entries(F.coalesce(name, F.create_map().cast("map<bigint,bigint>")))
    both = F.concat(
        F.transform(entries("received"), lambda e: F.struct(F.lit(True).alias("got"), e["key"].alias("key"), e["value"].alias("n"))),
        F.transform(entries("sent"), lambda e: F.struct(F.lit(False).alias("got"), e["key"].alias("key"), e["value"].alias("n"))),
    )
    one = packets.select(*keep, F.explode(both).alias("e")).select(*keep, "e.*").withColumn("lo", t - t % w)
    old = F.col("key") + w < t
    share = ((t - F.col("lo")).cast("float") / w.cast("float")).cast("float")
    up = F.when(old, (share * F.col("n").cast("float")).cast("float").cast("long")).otherwise(F.col("n"))
    low = F.struct(F.col("lo").alias("message_time"), (F.col("n") - F.col("up")).alias("n"))
    high = F.struct((F.col("lo") + w).alias("message_time"), F.col("up").alias("n"))
    parts = one.withColumn("up", up).withColumn("p", F.explode(F.when(old, F.array(low, high)).otherwise(F.array(high))))
    got, n = F.col("got"), F.col("p.n")
    return parts.select(*keep, F.col("p.message_time").alias("message_time"), F.col("key").alias("window"), F.when(got, n).otherwise(0).alias("received"), F.when(got, 0).otherwise(n).alias("sent"))


def build_tuples(aligned: DataFrame) -> DataFrame:
    """Tuples of aligned entries: timeinterval is the end of the entry's window, its latency runs from there to the
    message's time. Received of a negative latency is dropped, sent isn't; a key without counts stays."""
    end = F.col("window") + F.col("window_size") * 1000
    latency = F.col("message_time") - end
    n = F.when(latency >= 0, F.col("received")).otherwise(0)
    rows = aligned.withColumns({"timeinterval": end, "_edge": latency_bucket(latency), "_n": n})  # once a row, not once a bucket
    return rows.groupBy(*KEY).agg(F.sum("sent").alias("sent"), *bucket_sums(F.col("_edge"), F.col("_n")))


def audit_query(tuples: DataFrame, start: int | None = None, end: int | None = None, filter: str | None = None, group_by: str | None = None, percentiles: str | None = None) -> DataFrame:
    """sent, received, lost and the buckets by the columns of group_by, and percentile columns; one row without group_by."""
    keys = parse_group_by(group_by)
    rows = tuples.where(filter_condition(filter))
    if start is not None and end is not None:
        rows = rows.where(time_range(start, end))
    out = rows.groupBy(*keys).agg(*(F.sum(F.coalesce(m, F.lit(0))).cast("long").alias(m) for m in MEASURES))
    return out.select(*keys, "sent", received().alias("received"), lost().alias("lost"), *BUCKETS, *percentile_columns(parse_percentiles(percentiles)))


def order_groups(groups: DataFrame) -> DataFrame:
    """By time (as text), cluster, tier in the tiers' own order, topic, host; whichever of them there are."""
    order = {"timeinterval": F.col("timeinterval").cast("string"), "cluster": F.col("cluster"), "tier": tier_rank(F.col("tier")), "topic": F.col("topic"), "hostname": F.col("hostname")}
    return groups.orderBy(*(c for k, c in order.items() if k in groups.columns))


def late_tuple_split(tuples: DataFrame, boundary: int) -> tuple[DataFrame, DataFrame]:
    """Tuples from the boundary on, and the earlier ones, which are too late."""
    return tuples.where(F.col("timeinterval") >= boundary), tuples.where(F.col("timeinterval") < boundary)


def upsert_counters(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored tuples with those of the batch added to them by key."""
    return stored.select(*KEY, *MEASURES).unionByName(batch.select(*KEY, *MEASURES)).groupBy(*KEY).agg(*(F.sum(F.coalesce(m, F.lit(0))).cast("long").alias(m) for m in MEASURES))


def _entries(packets: DataFrame, start: int, end: int, cutoff_h: int) -> DataFrame:
    near = packets.where(F.col("timestamp").between(start - HOUR, end + cutoff_h * HOUR))
    total = lambda name: F.aggregate(F.filter(F.map_entries(F.coalesce(name, F.create_map().cast("map<bigint,bigint>"))), lambda e: e["key"].between(start, end)), F.lit(0).cast("long"), lambda a, e: a + e["value"])
    return near.withColumns({"received": total("received"), "sent": total("sent")})


def packet_stats(packets: DataFrame, start: int, end: int, filter: str | None = None, group_by: str | None = None, cutoff_h: int = 1) -> DataFrame:
    """Sums straight from packets over entries of start <= window <= end. Packets know no cluster: a filter on it matches
    nothing, and grouping by it is ignored. Groups with neither received nor sent are left out."""
    keys = [k for k in parse_group_by(group_by) if k not in {"cluster", "timeinterval"}]
    rows = _entries(packets.drop("cluster").withColumn("cluster", F.lit(None).cast("string")), start, end, cutoff_h).where(filter_condition(filter))
    return rows.groupBy(*keys).agg(F.sum("received").alias("received"), F.sum("sent").alias("sent")).where("received > 0 or sent > 0")


def packet_stats_capped(packets: DataFrame, start: int, end: int, tier: str, most: int, group_by: str | None = None, cutoff_h: int = 1, id_col: str = "event_id", filter: str | None = None) -> DataFrame:
    """packet_stats of the packets up to the one, in order of (timestamp, id), that brings the tier's received to `most`.

    Only packets that pass the filter count; as in packet_stats no cluster is known. The minute in which that happens is found from sums by minute; only its packets are then put in order."""
    keys = [k for k in parse_group_by(group_by) if k not in {"cluster", "timeinterval"}]
    known = packets.drop("cluster").withColumn("cluster", F.lit(None).cast("string"))
    rows = _entries(known, start, end, cutoff_h).where(filter_condition(filter)).withColumn("minute", publish_window(F.col("timestamp"))).withColumn("mine", F.when(F.upper("tier") == tier.upper(), F.col("received")).otherwise(0))
    per_minute = rows.groupBy("minute").agg(F.sum("mine").alias("m"))
    running = per_minute.withColumn("before", F.coalesce(F.sum("m").over(Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    reach = running.where(F.col("before") < most)
    whole = reach.where(F.col("before") + F.col("m") < most).select("minute")
    crossing = reach.where(F.col("before") + F.col("m") >= most).select("minute", "before")
    inside = rows.join(F.broadcast(crossing), "minute")
    inside = inside.withColumn("upto", F.col("before") + F.coalesce(F.sum("mine").over(Window.partitionBy("minute").orderBy("timestamp", id_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("upto") < most)
    picked = rows.join(whole, "minute", "left_semi").select(*keys, "received", "sent").unionByName(inside.select(*keys, "received", "sent"))
    return picked.groupBy(*keys).agg(F.sum("received").alias("received"), F.sum("sent").alias("sent")).where("received > 0 or sent > 0")


def all_tiers_complete(tuples: DataFrame, expected: int | DataFrame, tiers: list[str]) -> DataFrame:
    """One row, complete: whether each of the tiers received exactly what was expected (a number, or the column expected of a one-row table)."""
    per_tier = tuples.where(F.col("tier").isin(tiers)).groupBy("tier").agg(F.sum(received()).alias("received"))
    rows = per_tier.withColumn("expected", F.lit(expected)) if isinstance(expected, int) else per_tier.join(F.broadcast(expected))  # one row
    return rows.agg((F.coalesce(F.sum(F.when(F.col("received") == F.col("expected"), 1).otherwise(0)), F.lit(0)) == len(tiers)).alias("complete"))


def first_last_time(tuples: DataFrame) -> DataFrame:
    return tuples.agg(F.min("timeinterval").alias("first"), F.max("timeinterval").alias("last"))


def stream_cluster_list(tuples: DataFrame) -> DataFrame:
    """kind (stream or cluster), name, place: All first, then by name; _audit isn't listed."""
    names = tuples.select(F.explode(F.array(F.struct(F.lit("stream").alias("kind"), F.col("topic").alias("name")), F.struct(F.lit("cluster").alias("kind"), F.col("cluster").alias("name")))).alias("x")).select("x.*")
    names = names.where("name is not null and name <> '_audit'").distinct()
    firsts = tuples.sparkSession.createDataFrame([("stream", "All"), ("cluster", "All")], "kind string, name string")
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.col("name") != "All", "name"))
    return firsts.unionByName(names.where("name <> 'All'")).withColumn("place", place)
