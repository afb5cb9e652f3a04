"""The fact table's columns, and column expressions over counters, times and paths."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the data model: tiers in order, and the lower edges of the latency buckets in minutes.
TIERS = ["PUBLISHER", "AGENT", "COLLECTOR", "HDFS", "LOCAL", "MERGE", "MIRROR"]
EDGES = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 30, 60, 120, 240, 600]
KEY = ["timeinterval", "hostname", "tier", "topic", "cluster"]
DIMENSIONS = ["tier", "hostname", "topic", "cluster", "timeinterval"]
BUCKETS = [f"c{e}" for e in EDGES]
MEASURES = ["sent", *BUCKETS]
LOST = BUCKETS[-1]
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def parse_filter(text: str | None) -> dict[str, list[str]]:
    """'col=v1|v2,col2=v' as values by column. Terms that are malformed or name no dimension are skipped; of a column
    that stands twice the last counts; quotes around values go."""
    out: dict[str, list[str]] = {}
    for term in (text or "").split(","):
        name, is_, values = term.partition("=")
        name = name.strip().lower()
        if is_ and "=" not in values and values.strip() and name in DIMENSIONS:
            out[name] = [v.strip().strip("'\"") for v in values.split("|")]
    return out


def filter_condition(text: str | None) -> Column:
    conditions = [F.col(name).cast("string").isin(values) for name, values in parse_filter(text).items()]
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def parse_group_by(text: str | None) -> list[str]:
    """'tier,topic' as distinct column names in that order; none for None; ValueError for a name that isn't a dimension."""
    if text is None:
        return []
    names = [x.strip().lower() for x in text.split(",")]
    if unknown := [x for x in names if x not in DIMENSIONS]:
        raise ValueError(f"not a column to group by: {unknown[0]!r}")
    return list(dict.fromkeys(names))


def parse_percentiles(text: str | None) -> list[float]:
    return sorted({float(x) for x in (text or "").split(",") if x.strip()})


def time_range(start: int, end: int) -> Column:
    """[start, end) of timeinterval, in epoch milliseconds."""
    return (F.col("timeinterval") >= start) & (F.col("timeinterval") < end)


def latency_bucket(ms: Column) -> Column:
    """The largest edge (minutes) that the latency reaches; a negative latency falls in the last one."""
    minutes = ms / F.lit(MINUTE)
    out = F.when((ms < 0) | (minutes >= EDGES[-1]), EDGES[-1])
    for edge in reversed(EDGES[:-1]):
        out = out.when(minutes >= edge, edge)
    return out


def received() -> Column:
    return reduce(lambda a, b: a + b, map(_zero, BUCKETS))


def lost() -> Column:
    return _zero(LOST)


def bucket_sums(edge: Column, n: Column) -> list[Column]:
    """Conditional sums of n for all buckets, to be used in agg."""
    return [F.sum(F.when(edge == e, n).otherwise(0)).cast("long").alias(name) for e, name in zip(EDGES, BUCKETS, strict=True)]


def percentile_columns(percentiles: list[float]) -> list[Column]:
    """p<percentile>: the first edge whose running count reaches that share of what was delivered (single precision, as
    counters are compared); 0 if nothing was; null if it is never reached. The last bucket counts as lost."""
    total = (received() - lost()).cast("float")
    counts = list(map(_zero, BUCKETS[:-1]))
    running = F.array(*(reduce(lambda a, b: a + b, counts[: k + 1]).cast("float") for k in range(len(counts))))
    edges = F.array(*map(F.lit, EDGES[:-1]))
    out = []
    for p in percentiles:
        threshold = (F.lit(p).cast("float") * total / F.lit(100).cast("float")).cast("float")
        first = F.size(F.filter(running, _below(threshold)))  # as counts only grow, the first that reaches it
        out.append(F.when(total == 0, 0).otherwise(F.get(edges, first)).alias(f"p{p:g}".replace(".", "_")))
    return out


def _below(limit: Column) -> Callable[[Column], Column]:
    return lambda n: n < limit


def publish_window(ms: Column, width: int = MINUTE) -> Column:
    return ms - ms % F.lit(width)


def day_floor(ms: Column, days: int = 0) -> Column:
    return ms - F.pmod(ms, F.lit(DAY)) + F.lit(days * DAY)


def tier_rank(tier: Column) -> Column:
    return reduce(lambda w, k: w.when(F.upper(tier) == TIERS[k], k), range(1, len(TIERS)), F.when(F.upper(tier) == TIERS[0], 0))


def minute_text(ms: Column, pattern: str = "yyyy/MM/dd/HH/mm") -> Column:
    """A minute (epoch milliseconds) as text, in the session's zone, which is to be UTC."""
    return F.date_format(F.timestamp_millis(ms), pattern)


def path_to_minute(path: Column) -> Column:
    """Epoch milliseconds of the yyyy/MM/dd/HH/mm in a path; null if there is none that is a time."""
    text = F.regexp_extract(path, r"/(\d{4}/\d{2}/\d{2}/\d{2}/\d{2})(/|$)", 1)
    return F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy/MM/dd/HH/mm")))


def minute_to_path(root: Column, stream: Column, ms: Column) -> Column:
    return F.concat_ws("/", root, stream, minute_text(ms))


def file_name_time(name: Column) -> Column:
    """Epoch milliseconds of <stream>-yyyy-MM-dd-HH-mm_<seq>, -1 if the name isn't such a one."""
    text = F.regexp_extract(name, r"-(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})_\d+(\.gz)?$", 1)
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy-MM-dd-HH-mm"))), F.lit(-1))


def path_to_stream(path: Column, root: str) -> Column:
    """The first part of the path below root."""
    return F.element_at(F.split(F.expr(f"substring(path, {len(root.rstrip('/')) + 2})") if path is None else F.substring(path, len(root.rstrip("/")) + 2, 1 << 30), "/"), 1)


def is_live(name: Column) -> Column:
    """Files that are still written to, and the statistics file."""
    return name.endswith("current") | (F.lower(name) == "scribe_stats")


def is_loss(parent: Column, children: Column, percent: int) -> Column:
    """parent < children - int(percent * children) / 100."""
    return parent < children - (F.lit(percent) * children).cast("long") / 100


def health(count: Column, upstream: Column, loss_percent: int, warn_percent: int) -> Column:
    loss, warn = is_loss(count, upstream, loss_percent), is_loss(count, upstream, warn_percent)
    return (
        F.when((count == 0) & (upstream == 0), "NoData").when(count == 0, "NoData").when(count > upstream, "Excess").when(warn & ~loss, "Warn").when(loss, "Unhealthy").otherwise("Healthy")
    )


def latency_health(minutes: Column, sla: Column, margin: int) -> Column:
    return F.when(minutes == -1, "NoData").when(minutes <= sla - margin, "Healthy").when(minutes <= sla, "Warn").otherwise("Unhealthy")


def data_grain(day_ms: Column, today_ms: int, till_days: int, daily_till_days: int) -> Column:
    """Which rows a day holds: day, hour or minute."""
    hour_from, day_from = (today_ms - today_ms % DAY - n * DAY for n in (till_days, daily_till_days))
    return F.when(day_ms < day_from, "day").when(day_ms < hour_from, "hour").otherwise("minute")
