"""Coarser tuples, which days to roll up, and time series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptally.functions.model import BUCKETS, DAY, HOUR, KEY, MEASURES, MINUTE, filter_condition, lost, parse_group_by, percentile_columns, received, time_range
from hoptally.sources.files import settled

#: The longest range in days of each step of a time series in minutes; beyond, a day.
STEPS = [(3, 60), (7, 120), (14, 240), (21, 360), (30, 480), (60, 720)]


def _sums(measures: list[str] = MEASURES) -> list[Column]:
    return [F.sum(F.coalesce(m, F.lit(0))).cast("long").alias(m) for m in measures]


def rollup_interval(tuples: DataFrame, start: int, end: int, length: int = HOUR) -> DataFrame:
    """Sums by key in intervals from start on; the last interval may reach beyond end."""
    last = start + -(-(end - start) // length) * length
    bucket = F.lit(start) + F.expr(f"((timeinterval - {start}) div {length}) * {length}")
    return tuples.where(time_range(start, last)).withColumn("timeinterval", bucket).groupBy(*KEY).agg(*_sums())


def rollup_sent_only(tuples: DataFrame, start: int, end: int, length: int = HOUR) -> DataFrame:
    """Sums of sent alone; an interval that doesn't end by `end` is left out."""
    bucket = F.lit(start) + F.expr(f"((timeinterval - {start}) div {length}) * {length}")
    return tuples.where(time_range(start, end)).withColumn("timeinterval", bucket).where(F.col("timeinterval") + length <= end).groupBy(*KEY).agg(*_sums(["sent"]))


def timeline_bucket_size(start: int, end: int, configured: int = 60) -> int:
    """Minutes to a step of a time series from start to end."""
    days = (end - start) / DAY
    return max(configured, next((step for most, step in STEPS if days <= most), 1440))


def timeline_step(days: Column, configured: int = 60) -> Column:
    """timeline_bucket_size of a column of days."""
    steps = reduce(lambda w, x: w.when(days <= x[0], x[1]), STEPS[1:], F.when(days <= STEPS[0][0], STEPS[0][1])).otherwise(1440)
    return F.greatest(F.lit(configured), steps)


def timeline(tuples: DataFrame, start: int, end: int, group_by: str = "timeinterval,tier", filter: str | None = None, configured: int = 60) -> DataFrame:
    """audit sums with the time cut to steps."""
    step = timeline_bucket_size(start, end, configured) * MINUTE
    keys = parse_group_by(group_by)
    rows = tuples.where(time_range(start, end)).where(filter_condition(filter)).withColumn("timeinterval", F.col("timeinterval") - F.pmod("timeinterval", F.lit(step)))
    return rows.groupBy(*keys).agg(*_sums()).select(*keys, "sent", received().alias("received"), lost().alias("lost"), *BUCKETS)


def timeline_grouping_sets(tuples: DataFrame, step: int, percentiles: list[float]) -> DataFrame:
    """Sums and percentiles by (time, tier), (time, tier, cluster) and (time, tier, cluster, topic); level 0, 1 and 2 columns deep."""
    bucket = F.col("timeinterval") - F.pmod("timeinterval", F.lit(step))
    finest = tuples.withColumn("time", bucket).groupBy("time", "tier", "cluster", "topic").agg(*_sums())
    one, two, three = ([F.col(c) for c in cols] for cols in (["time", "tier"], ["time", "tier", "cluster"], ["time", "tier", "cluster", "topic"]))
    sets = finest.groupingSets([one, two, three], "time", "tier", "cluster", "topic").agg(*_sums(), (F.lit(2) - F.grouping("cluster") - F.grouping("topic")).cast("int").alias("level"))
    return sets.select("level", "time", "tier", "cluster", "topic", "sent", received().alias("received"), lost().alias("lost"), *percentile_columns(percentiles))


def timeline_selection(series: DataFrame, tier: str = "all", cluster: str = "all", topic: str = "all", latency: str = "p99") -> DataFrame:
    """received and sent by (tier, time) of a selection of timeline_grouping_sets, its latency, and over the selection the
    least and greatest received and the greatest latency. The latency is that of the level that the selection names."""
    level = 2 if topic != "all" else 1 if cluster != "all" else 0
    chosen = [F.col(c) == v for c, v in (("tier", tier), ("cluster", cluster), ("topic", topic)) if v != "all"]
    rows = series.where(F.col("level") == level).where(reduce(lambda a, b: a & b, chosen, F.lit(True)))
    by = rows.groupBy("tier", "time").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"), F.max(latency).alias("latency"))
    by = settled(by)
    span = by.agg(F.min("received").alias("least"), F.max("received").alias("greatest"), F.max("latency").alias("most_latency"))
    return by.join(F.broadcast(span))  # span is one row


def _days(frame: DataFrame, first: int, last: int) -> DataFrame:
    """The days (epoch milliseconds) from first on and before last."""
    n = max(0, (last - first) // DAY)
    return frame.sparkSession.range(0, n).select((F.lit(first) + F.col("id") * DAY).alias("day"))


def data_days(tuples: DataFrame) -> DataFrame:
    return tuples.select((F.col("timeinterval") - F.col("timeinterval") % DAY).alias("day")).distinct()


def rolled_days_start(days: DataFrame, rolled: DataFrame, today: int, till_days: int, checkpoint: int | None = None) -> DataFrame:
    """start: where the next rollup begins. The checkpoint if there is one; else the day after the last rolled one among the
    days with data; else the first day with data; null if that is newer than till_days before today."""
    first, last = F.min("day").alias("first"), F.max("day").alias("last")
    span = days.agg(first, last)
    inside = rolled.join(F.broadcast(span), F.col("day").between(F.col("first"), F.col("last"))).agg(F.max("day").alias("latest"))
    limit = today - today % DAY - till_days * DAY
    start = F.when(F.lit(checkpoint is not None), F.lit(checkpoint).cast("long")).when(F.col("first") > limit, F.lit(None)).otherwise(F.coalesce(F.col("latest") + DAY, F.col("first")))
    return span.join(F.broadcast(inside)).select(start.alias("start"))  # both are one row


def rollup_day_range(rolled: DataFrame, start: int, today: int, till_days: int, daily_till_days: int | None = None, days: int | None = None) -> DataFrame:
    """Days from start to till_days before today that aren't rolled up yet.

    daily_till_days: older days are left to the daily rollup, so the hourly one doesn't start before that. days: on
    demand, so many days from start on; ValueError if start isn't before the last day that may be rolled up."""
    floor = today - today % DAY
    last = floor - till_days * DAY
    if daily_till_days is not None:
        start = max(start, floor - daily_till_days * DAY)
    if days is not None:
        if start >= last:
            raise ValueError("the start is too new to be rolled up")
        last = min(last, start + days * DAY)
    return _days(rolled, start, last).join(rolled, "day", "left_anti")


def rollup_status(rolled: DataFrame, first: int, last: int) -> DataFrame:
    """Days from first on and before last that are missing among the rolled ones."""
    return _days(rolled, first, last).join(rolled, "day", "left_anti")


def rollup_swap(tuples: DataFrame, days: DataFrame, length: int = HOUR) -> DataFrame:
    """The tuples with those of the given days replaced by their rolled rows; the rows of other days are neither shuffled nor summed.
    Doing it twice changes nothing. sources.facts.roll does this to a table."""
    rows = tuples.select(*KEY, *MEASURES).withColumn("day", F.col("timeinterval") - F.col("timeinterval") % DAY)
    bucket = F.col("timeinterval") - F.col("timeinterval") % length
    rolled = rows.join(days.select("day"), "day", "left_semi").withColumn("timeinterval", bucket).groupBy(*KEY).agg(*_sums())
    return rows.join(days.select("day"), "day", "left_anti").drop("day").unionByName(rolled)


def rollup_source(minutes: DataFrame, hours: DataFrame, days: DataFrame) -> DataFrame:
    """What a daily rollup of the given days reads: the hour rows of days that have some, the minute rows of all others."""
    day = F.col("timeinterval") - F.col("timeinterval") % DAY
    coarse = hours.withColumn("day", day).join(days.select("day"), "day", "left_semi")
    fine = minutes.withColumn("day", day).join(days.select("day"), "day", "left_semi").join(data_days(hours), "day", "left_anti")
    return coarse.drop("day").unionByName(fine.drop("day"))
