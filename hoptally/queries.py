"""The registered queries: each applies an operator to tables derived from events, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.functions import model as m
from hoptally.operators import audit, listing, movement, rollup, topology
from hoptally.plans import sql as s
from hoptally.plans import views as v
from hoptally.sources import facts, files
from hoptally.streaming import collectors, feed, sliding

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: The range of the events table, and fixed moments in it (epoch milliseconds).
START, END = 1_704_067_200_000, 1_706_659_200_000
MID = START + 15 * m.DAY
NOW = START + 20 * m.DAY + 7 * m.HOUR
PS = [50.0, 90.0, 99.0, 99.9]
_DIMS = "cluster, tier"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


_BUCKETS = ", ".join(m.BUCKETS)
_QSUMS = f"{s.SUM_MEASURES}"


def _audit_sql(keys: str, where: str = "true", ps: list[float] | None = None) -> str:
    pct = ", " + s.percentile_sql(ps) if ps else ""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return _with(s.TUPLES, f"SELECT {lead}sent, {s.RECEIVED} received, c600 lost, {_BUCKETS}{pct} FROM (SELECT {lead}{_QSUMS} FROM t WHERE {where} {group})")


# audit


@_query("audit_query", _audit_sql(_DIMS, ps=PS))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d), group_by="cluster,tier", percentiles="50,90,99,99.9")


@_query("audit_query_total", _audit_sql(""))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d))


@_query("latency_percentiles", _audit_sql("topic, hostname", ps=[70.0, 80.0, 95.0]))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d), group_by="topic,hostname", percentiles="95,70,80,80")


@_query("tier_latency", _audit_sql("tier", ps=[99.0]))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d), group_by="tier", percentiles="99")


@_query("parse_filter", _audit_sql("topic, tier", "topic IN ('click', 'view') AND tier = 'AGENT'"))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d), filter="TOPIC='click'|view,bad,tier=LOCAL,TIER=AGENT,x=y", group_by="topic,tier,topic")


@_query("time_range_filter", _audit_sql("cluster", f"timeinterval >= {MID} AND timeinterval < {MID + m.DAY}"))
def _(spark, d):
    return audit.audit_query(v.tuples(spark, d), MID, MID + m.DAY, group_by="cluster")


@_query("order_groups", _audit_sql("cluster, tier, topic, hostname"))
def _(spark, d):
    return audit.order_groups(audit.audit_query(v.tuples(spark, d), group_by="cluster,tier,topic,hostname"))


@_query("build_view_tuples", _with(s.TUPLES, "SELECT * FROM t"))
def _(spark, d):
    return v.tuples(spark, d)


@_query("received_lost", _with(s.TUPLES, f"SELECT {s.KEYS}, {s.RECEIVED} received, c600 lost FROM t"))
def _(spark, d):
    return v.tuples(spark, d).select(*m.KEY, m.received().alias("received"), m.lost().alias("lost"))


@_query("latency_bucket", _with(s.SOURCE, f"SELECT event_id, tier, {s._BUCKET} bucket FROM src"))
def _(spark, d):
    return v.tuple_source(spark, d).select("event_id", "tier", m.latency_bucket(F.col("latency_min") * m.MINUTE).alias("bucket"))


@_query("publish_window", _with(s.EVENTS, "SELECT event_id, ms - ms % 60000 AS win FROM e"))
def _(spark, d):
    return v.events(spark, d).select("event_id", m.publish_window(F.col("ms")).alias("win"))


@_query("day_floor", _with(s.EVENTS, "SELECT event_id, ms - ms % 86400000 AS d0, ms - ms % 86400000 - 2 * 86400000 AS d2 FROM e"))
def _(spark, d):
    return v.events(spark, d).select("event_id", m.day_floor(F.col("ms")).alias("d0"), m.day_floor(F.col("ms"), -2).alias("d2"))


@_query("align_messages", _with(s.ALIGNED, "SELECT tier, topic, hostname, cluster, message_time, win, sum(received)::BIGINT received, sum(sent)::BIGINT sent, count(*) n FROM al GROUP BY tier, topic, hostname, cluster, message_time, win"))
def _(spark, d):
    al = audit.align_messages(v.packets(spark, d)).withColumnRenamed("window", "win")
    return al.groupBy("tier", "topic", "hostname", "cluster", "message_time", "win").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"), F.count("*").alias("n"))


_BUILT = f"""{s.ALIGNED}, lat AS (SELECT *, win + 60000 AS timeinterval, message_time - (win + 60000) lat FROM al),
bt AS (SELECT {s.KEYS}, sum(sent)::BIGINT sent, {", ".join(f"sum(CASE WHEN b = {e} AND lat >= 0 THEN received ELSE 0 END)::BIGINT c{e}" for e in m.EDGES)}
  FROM (SELECT *, CASE WHEN lat < 0 OR lat >= 36000000 THEN 600 {" ".join(f"WHEN lat >= {e} * 60000 THEN {e}" for e in reversed(m.EDGES[:-1]))} END b FROM lat) GROUP BY {s.KEYS})"""


@_query("build_tuples", _with(_BUILT, "SELECT * FROM bt"))
def _(spark, d):
    return audit.build_tuples(audit.align_messages(v.packets(spark, d)))


@_query("late_tuple_split", _with(_BUILT, f"SELECT timeinterval < {MID} late, count(*) n FROM bt GROUP BY 1"))
def _(spark, d):
    kept, late = audit.late_tuple_split(audit.build_tuples(audit.align_messages(v.packets(spark, d))), MID)
    return kept.select(F.lit(False).alias("late")).unionByName(late.select(F.lit(True).alias("late"))).groupBy("late").agg(F.count("*").alias("n"))


@_query("upsert_counters", _with(s.DAY_TUPLES, "SELECT * FROM d"))
def _(spark, d):
    return audit.upsert_counters(v.day_tuples(spark, d, False), v.day_tuples(spark, d, True))


_PSTAT = f"""{s.PACKETS}, ok AS (SELECT * FROM pe WHERE "timestamp" BETWEEN {MID - m.HOUR} AND {MID + m.DAY + m.HOUR} AND "key" BETWEEN {MID} AND {MID + m.DAY})"""


@_query("packet_stats", _with(_PSTAT, "SELECT tier, topic, sum(CASE WHEN got THEN v ELSE 0 END)::BIGINT received, sum(CASE WHEN got THEN 0 ELSE v END)::BIGINT sent FROM ok GROUP BY tier, topic HAVING sum(v) > 0"))
def _(spark, d):
    return audit.packet_stats(v.packets(spark, d), MID, MID + m.DAY, group_by="tier,topic,cluster")


@_query("packet_stats_capped", _with(s.PACKETS, f"""SELECT tier, sum(r)::BIGINT received, sum(z)::BIGINT sent FROM (
  SELECT *, coalesce(sum(CASE WHEN tier = 'AGENT' THEN r ELSE 0 END) OVER (ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) upto FROM (
    SELECT event_id, "timestamp", tier, sum(CASE WHEN got AND "key" BETWEEN {MID} AND {MID + m.DAY} THEN v ELSE 0 END) r, sum(CASE WHEN NOT got AND "key" BETWEEN {MID} AND {MID + m.DAY} THEN v ELSE 0 END) z
    FROM pe WHERE "timestamp" BETWEEN {MID - m.HOUR} AND {MID + m.DAY + m.HOUR} GROUP BY event_id, "timestamp", tier)) WHERE upto < 2000 GROUP BY tier HAVING sum(r) > 0 OR sum(z) > 0"""))
def _(spark, d):
    return audit.packet_stats_capped(v.packets(spark, d), MID, MID + m.DAY, "AGENT", 2000, group_by="tier")


@_query("packet_stats_capped_filtered", _with(s.PACKETS, f"""SELECT topic, sum(r)::BIGINT received, sum(z)::BIGINT sent FROM (
  SELECT *, coalesce(sum(CASE WHEN tier = 'AGENT' THEN r ELSE 0 END) OVER (ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) upto FROM (
    SELECT event_id, "timestamp", tier, topic, sum(CASE WHEN got AND "key" BETWEEN {MID} AND {MID + m.DAY} THEN v ELSE 0 END) r, sum(CASE WHEN NOT got AND "key" BETWEEN {MID} AND {MID + m.DAY} THEN v ELSE 0 END) z
    FROM pe WHERE "timestamp" BETWEEN {MID - m.HOUR} AND {MID + m.DAY + m.HOUR} AND topic IN ('click', 'view') GROUP BY event_id, "timestamp", tier, topic)) WHERE upto < 1000 GROUP BY topic HAVING sum(r) > 0 OR sum(z) > 0"""))
def _(spark, d):
    return audit.packet_stats_capped(v.packets(spark, d), MID, MID + m.DAY, "AGENT", 1000, group_by="cluster,topic", filter="topic=click|view")


@_query("all_tiers_complete", _with(s.TUPLES, f"SELECT count(*) FILTER (r = (SELECT sum({s.RECEIVED}) FROM t WHERE tier = 'PUBLISHER')) = 2 complete FROM (SELECT tier, sum({s.RECEIVED}) r FROM t WHERE tier IN ('PUBLISHER', 'MIRROR') GROUP BY tier)"))
def _(spark, d):
    t = v.tuples(spark, d)
    expected = t.where("tier = 'PUBLISHER'").agg(F.sum(m.received()).alias("expected"))
    return audit.all_tiers_complete(t, expected, ["PUBLISHER", "MIRROR"])


@_query("first_last_time", _with(s.TUPLES, "SELECT min(timeinterval) AS first, max(timeinterval) AS last FROM t"))
def _(spark, d):
    return audit.first_last_time(v.tuples(spark, d))


@_query("stream_cluster_list", _with(s.TUPLES, """SELECT kind, "name", row_number() OVER (PARTITION BY kind ORDER BY "name" <> 'All', "name")::INT place FROM (
  SELECT DISTINCT 'stream' kind, topic AS "name" FROM t UNION ALL SELECT DISTINCT 'cluster', cluster FROM t UNION ALL SELECT 'stream', 'All' UNION ALL SELECT 'cluster', 'All')"""))
def _(spark, d):
    return audit.stream_cluster_list(v.tuples(spark, d))


@_query("window_counts", "SELECT source AS stream, lang AS file, n_chars * 1000 - (n_chars * 1000) % 60000 AS win, count(*) n FROM (SELECT source, lang, n_chars, unnest(string_split(text, chr(10))) FROM documents) WHERE n_chars >= 0 GROUP BY 1, 2, 3")
def _(spark, d):
    lines = spark.read.parquet(f"{d}/documents.parquet").select(F.col("source").alias("stream"), F.col("lang").alias("file"), (F.col("n_chars") * 1000).alias("publish_ms"), F.explode(F.split("text", "\n")).alias("value"))
    return audit.window_counts(lines).withColumnRenamed("window", "win")


_LINES = """cl AS (SELECT topic || '#' || 'f' || (event_id % 50) || '#' || (CASE WHEN event_id % 13 = 0 THEN 'x' ELSE CAST(ms - ms % 86400000 AS VARCHAR) END) || (CASE WHEN event_id % 17 = 0 THEN '' ELSE '#' || n END) AS line FROM e),
cp AS (SELECT string_split(line, '#') q FROM cl), ct AS (SELECT q[1] stream, q[2] AS file, TRY_CAST(q[3] AS BIGINT) win, max(TRY_CAST(q[4] AS BIGINT)) n FROM cp WHERE TRY_CAST(q[3] AS BIGINT) IS NOT NULL AND TRY_CAST(q[4] AS BIGINT) IS NOT NULL GROUP BY 1, 2, 3)"""


def _counter_lines(spark, d):
    e = v.events(spark, d)
    window = F.when(F.col("event_id") % 13 == 0, "x").otherwise((F.col("ms") - F.col("ms") % m.DAY).cast("string"))
    tail = F.when(F.col("event_id") % 17 == 0, "").otherwise(F.concat(F.lit("#"), F.col("n").cast("string")))
    return e.select(F.concat("topic", F.lit("#f"), (F.col("event_id") % 50).cast("string"), F.lit("#"), window, tail).alias("value"))


@_query("parse_counters", _with(f"{s.EVENTS}, {_LINES}", "SELECT * FROM ct"))
def _(spark, d):
    return audit.parse_counters(_counter_lines(spark, d)).withColumnRenamed("window", "win")


@_query("counters_to_audit", _with(f"{s.EVENTS}, {_LINES}", "SELECT stream, file, count(*) windows, sum(n)::BIGINT total FROM ct WHERE (stream, file) IN (SELECT (topic, 'f' || (event_id % 40)) FROM e) GROUP BY stream, file"))
def _(spark, d):
    committed = v.events(spark, d).select(F.col("topic").alias("stream"), F.concat(F.lit("f"), (F.col("event_id") % 40).cast("string")).alias("file"))
    out = audit.counters_to_audit(audit.parse_counters(_counter_lines(spark, d)), committed)
    return out.select("stream", "file", F.size("received").cast("long").alias("windows"), F.aggregate(F.map_values("received"), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


# scalar functions over listings


@_query("path_to_minute", _with(s.LISTINGS, 'SELECT path, "minute" AS got FROM lm'))
def _(spark, d):
    return v.listing(spark, d, "merge").select("path", m.path_to_minute(F.col("path")).alias("got"))


@_query("minute_to_path", _with(s.LISTINGS, """SELECT path, 'r/' || stream || '/' || strftime(make_timestamp("minute" * 1000), '%Y/%m/%d/%H/%M') AS dir, 'r/' || stream || '/' || strftime(make_timestamp(("minute" + 60000) * 1000), '%Y/%m/%d/%H/%M') AS next FROM ll"""))
def _(spark, d):
    p = lambda x: m.minute_to_path(F.lit("r"), F.col("stream"), x)
    return v.listing(spark, d, "local").select("path", p(F.col("minute")).alias("dir"), p(F.col("minute") + m.MINUTE).alias("next"))


@_query("file_name_time", _with(s.LISTINGS, """SELECT path, CASE WHEN event_id % 9 = 0 THEN -1 ELSE "minute" END t FROM ll"""))
def _(spark, d):
    name = F.when(F.col("event_id") % 9 == 0, "odd-name").otherwise(F.col("name"))
    return v.listing(spark, d, "local").select("path", m.file_name_time(name).alias("t"))


@_query("path_to_stream", _with(s.LISTINGS, "SELECT path, stream AS got FROM lr"))
def _(spark, d):
    return v.listing(spark, d, "mirror").select("path", m.path_to_stream(F.col("path"), "mirror").alias("got"))


def _collector_files(spark, d):
    """Listings of collectors (hosts): some live files, some empty."""
    e = v.events(spark, d)
    name = F.when(F.col("event_id") % 71 == 0, F.concat("topic", F.lit("_current"))).when(F.col("event_id") % 73 == 0, F.lit("Scribe_Stats")).otherwise(
        F.concat("topic", F.lit("-"), m.minute_text(F.col("ms") - F.col("ms") % m.MINUTE, "yyyy-MM-dd-HH-mm"), F.lit("_"), F.lpad(F.col("event_id").cast("string"), 9, "0")))
    return e.select(F.col("topic").alias("stream"), F.concat("cluster", F.lit("-"), "hostname").alias("collector"), name.alias("name"), F.concat_ws("/", F.lit("data"), "topic", "cluster", "hostname", name).alias("path"),
                    F.when(F.col("event_id") % 11 == 0, 0).otherwise(F.floor(F.col("value") * 100)).cast("long").alias("length"), (F.col("ms") + F.col("event_id") % 5 * 90_000).alias("mtime"), "event_id")


_CF = f"""{s.EVENTS}, cf AS (SELECT *, 'data/' || stream || '/' || cl || '/' || h || '/' || "name" AS path FROM (SELECT topic stream, cluster cl, hostname h, cluster || '-' || hostname collector,
  CASE WHEN event_id % 71 = 0 THEN topic || '_current' WHEN event_id % 73 = 0 THEN 'Scribe_Stats' ELSE topic || '-' || strftime(make_timestamp((ms - ms % 60000) * 1000), '%Y-%m-%d-%H-%M') || '_' || lpad(CAST(event_id AS VARCHAR), 9, '0') END AS "name",
  CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS length, ms + event_id % 5 * 90000 mtime, event_id FROM e)),
lf AS (SELECT * FROM cf WHERE NOT ends_with("name", 'current') AND lower("name") <> 'scribe_stats')"""
_CP = f"""cps AS (SELECT stream, collector, max("name") AS checkpoint FROM lf WHERE mtime < {MID} AND collector <> 'cluster0-host0' GROUP BY stream, collector)"""
_BATCH = f"""{_CF}, {_CP}, ag AS (SELECT *, row_number() OVER (PARTITION BY stream, collector ORDER BY mtime DESC, "name" DESC) age FROM lf),
rd AS (SELECT ag.*, coalesce(sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY stream, collector ORDER BY mtime, "name" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) before
  FROM ag LEFT JOIN cps USING (stream, collector) WHERE (age > 1 OR mtime < {NOW - m.HOUR}) AND (checkpoint IS NULL OR "name" > checkpoint)), bat AS (SELECT * FROM rd WHERE before < 10)"""


def _batch(spark, d):
    f = _collector_files(spark, d)
    old = movement.exclude_live_files(f).where((F.col("mtime") < MID) & (F.col("collector") != "cluster0-host0"))
    return movement.collector_batch(f, movement.collector_checkpoint(old), NOW)


@_query("exclude_live_files", _with(_CF, 'SELECT event_id, "name" FROM lf'))
def _(spark, d):
    return movement.exclude_live_files(_collector_files(spark, d)).select("event_id", "name")


@_query("collector_batch", _with(_BATCH, 'SELECT stream, collector, "name", path, length FROM bat'))
def _(spark, d):
    return _batch(spark, d)


@_query("collector_checkpoint", _with(_BATCH, 'SELECT stream, collector, max("name") AS checkpoint FROM bat GROUP BY stream, collector'))
def _(spark, d):
    return movement.collector_checkpoint(_batch(spark, d))


@_query("trash_candidates", _with(_CF, """SELECT stream, collector, "name", collector || '-' || "name" AS target FROM (SELECT *, row_number() OVER (PARTITION BY stream, collector ORDER BY "name" DESC) r FROM lf) WHERE r > 6"""))
def _(spark, d):
    return movement.trash_candidates(movement.exclude_live_files(_collector_files(spark, d)))


@_query("last_processed_time", _with(_BATCH, """SELECT stream, min(t) last_processed FROM (SELECT stream, collector, max((epoch_us(strptime(regexp_extract("name", '-(\\d{4}-\\d{2}-\\d{2}-\\d{2}-\\d{2})_', 1), '%Y-%m-%d-%H-%M'))) // 1000) t FROM bat GROUP BY stream, collector) GROUP BY stream"""))
def _(spark, d):
    return movement.last_processed_time(_batch(spark, d).withColumn("file_time", m.file_name_time(F.col("name"))))


@_query("data_grain", _with(s.EVENTS, f"SELECT event_id, CASE WHEN ms - ms % 86400000 < {START + 5 * m.DAY} THEN 'day' WHEN ms - ms % 86400000 < {START + 18 * m.DAY} THEN 'hour' ELSE 'minute' END grain FROM e"))
def _(spark, d):
    return v.events(spark, d).select("event_id", m.data_grain(F.col("ms") - F.col("ms") % m.DAY, NOW, 2, 15).alias("grain"))


_HEALTH = "CASE WHEN {a} = 0 THEN 'NoData' WHEN {a} > {b} THEN 'Excess' WHEN ({w}) AND NOT ({l}) THEN 'Warn' WHEN {l} THEN 'Unhealthy' ELSE 'Healthy' END"


@_query("health_tests", _with(s.EVENTS, "SELECT event_id, " + _HEALTH.format(a="k", b="n", w=s.loss("k", "n", 10), l=s.loss("k", "n", 40)) + " health FROM e"))
def _(spark, d):
    return v.events(spark, d).select("event_id", m.health(F.col("k"), F.col("n"), 40, 10).alias("health"))


@_query("latency_health", _with(s.EVENTS, "SELECT event_id, CASE WHEN k - 1 = -1 THEN 'NoData' WHEN k - 1 <= n % 30 - 2 THEN 'Healthy' WHEN k - 1 <= n % 30 THEN 'Warn' ELSE 'Unhealthy' END health FROM e"))
def _(spark, d):
    return v.events(spark, d).select("event_id", m.latency_health(F.col("k") - 1, F.col("n") % 30, 2).alias("health"))


# rollup and time series


def _rolled_sql(start: int, length: int, where: str, what: str = s.SUM_MEASURES) -> str:
    return _with(s.TUPLES, f"SELECT {start} + ((timeinterval - {start}) // {length}) * {length} AS timeinterval, hostname, tier, topic, cluster, {what} FROM t WHERE {where} GROUP BY {start} + ((timeinterval - {start}) // {length}) * {length}, hostname, tier, topic, cluster")


_RS, _RE = START + 30 * m.MINUTE, START + 10 * m.DAY


@_query("rollup_interval", _rolled_sql(_RS, m.HOUR, f"timeinterval >= {_RS} AND timeinterval < {_RE + 30 * m.MINUTE}"))
def _(spark, d):
    return rollup.rollup_interval(v.tuples(spark, d), _RS, _RE)


@_query("rollup_interval_day", _rolled_sql(START, m.DAY, f"timeinterval >= {START} AND timeinterval < {_RE}"))
def _(spark, d):
    return rollup.rollup_interval(v.tuples(spark, d), START, _RE, m.DAY)


@_query("rollup_sent_only", _rolled_sql(_RS, m.HOUR, f"timeinterval >= {_RS} AND timeinterval < {_RE - 30 * m.MINUTE}", "sum(sent)::BIGINT sent"))
def _(spark, d):
    return rollup.rollup_sent_only(v.tuples(spark, d), _RS, _RE)


@_query("timeline", _with(s.TUPLES, f"SELECT timeinterval, tier, sent, {s.RECEIVED} received, c600 lost, {_BUCKETS} FROM (SELECT timeinterval - timeinterval % 28800000 AS timeinterval, tier, {_QSUMS} FROM t WHERE timeinterval >= {START} AND timeinterval < {START + 26 * m.DAY} GROUP BY timeinterval - timeinterval % 28800000, tier)"))
def _(spark, d):
    return rollup.timeline(v.tuples(spark, d), START, START + 26 * m.DAY)


@_query("timeline_bucket_size", _with(s.EVENTS, f"SELECT CASE WHEN days <= 3 THEN 60 WHEN days <= 7 THEN 120 WHEN days <= 14 THEN 240 WHEN days <= 21 THEN 360 WHEN days <= 30 THEN 480 WHEN days <= 60 THEN 720 ELSE 1440 END AS minutes, count(*) n FROM (SELECT (ms - {START}) // {m.DAY} + 1 AS days FROM e) GROUP BY 1"))
def _(spark, d):
    days = v.events(spark, d).select((((F.col("ms") - START) / m.DAY).cast("long") + 1).alias("days"))
    return days.groupBy(rollup.timeline_step(F.col("days")).alias("minutes")).agg(F.count("*").alias("n"))


_SETS = f"""{s.TUPLES}, gs AS (SELECT (2 - grouping(cluster) - grouping(topic))::INT AS level, tb AS "time", tier, cluster, topic, {s.SUM_MEASURES}
  FROM (SELECT *, timeinterval - timeinterval % 86400000 tb FROM t) GROUP BY GROUPING SETS ((tb, tier), (tb, tier, cluster), (tb, tier, cluster, topic)))"""
_SERIES = f'SELECT level, "time", tier, cluster, topic, sent, {s.RECEIVED} received, c600 lost, {s.percentile_sql(PS)} FROM gs'


@_query("timeline_grouping_sets", _with(_SETS, _SERIES))
def _(spark, d):
    return rollup.timeline_grouping_sets(v.tuples(spark, d), m.DAY, PS)


@_query("timeline_selection", _with(f"{_SETS}, se AS ({_SERIES}), by_ AS (SELECT tier, \"time\", sum(received)::BIGINT received, sum(sent)::BIGINT sent, max(p99) latency FROM se WHERE level = 2 AND topic = 'click' AND cluster = 'cluster1' GROUP BY tier, \"time\")",
                                    "SELECT *, min(received) OVER () least, max(received) OVER () greatest, max(latency) OVER () most_latency FROM by_"))
def _(spark, d):
    return rollup.timeline_selection(rollup.timeline_grouping_sets(v.tuples(spark, d), m.DAY, PS), cluster="cluster1", topic="click")


_DAYS = f"{s.EVENTS}, dd AS (SELECT DISTINCT ms - ms % 86400000 AS day FROM e), ro AS (SELECT day FROM dd WHERE (day // 86400000) % 5 <> 2 AND day < {START + 12 * m.DAY})"


def _days(spark, d):
    days = v.events(spark, d).select((F.col("ms") - F.col("ms") % m.DAY).alias("day")).distinct()
    return days, days.where(f"(day div 86400000) % 5 <> 2 and day < {START + 12 * m.DAY}")


@_query("rolled_days_start", _with(_DAYS, f"SELECT CASE WHEN (SELECT min(day) FROM dd) > {NOW - NOW % m.DAY - 2 * m.DAY} THEN NULL ELSE coalesce((SELECT max(day) + {m.DAY} FROM ro), (SELECT min(day) FROM dd)) END AS start"))
def _(spark, d):
    return rollup.rolled_days_start(*_days(spark, d), NOW, 2)


@_query("rollup_day_range", _with(_DAYS, f"SELECT x AS day FROM range({START}, {NOW - NOW % m.DAY - 2 * m.DAY}, {m.DAY}) r(x) WHERE x NOT IN (SELECT day FROM ro)"))
def _(spark, d):
    return rollup.rollup_day_range(_days(spark, d)[1], START, NOW, 2)


@_query("rollup_day_range_hourly", _with(_DAYS, f"SELECT x AS day FROM range({NOW - NOW % m.DAY - 9 * m.DAY}, {NOW - NOW % m.DAY - 2 * m.DAY}, {m.DAY}) r(x) WHERE x NOT IN (SELECT day FROM ro)"))
def _(spark, d):
    return rollup.rollup_day_range(_days(spark, d)[1], START, NOW, 2, daily_till_days=9)


@_query("rollup_day_range_on_demand", _with(_DAYS, f"SELECT x AS day FROM range({START + 4 * m.DAY}, {START + 11 * m.DAY}, {m.DAY}) r(x) WHERE x NOT IN (SELECT day FROM ro)"))
def _(spark, d):
    return rollup.rollup_day_range(_days(spark, d)[1], START + 4 * m.DAY, NOW, 2, days=7)


@_query("rollup_status", _with(_DAYS, f"SELECT x AS day FROM range({START}, {END}, {m.DAY}) r(x) WHERE x NOT IN (SELECT day FROM ro)"))
def _(spark, d):
    return rollup.rollup_status(_days(spark, d)[1], START, END)


@_query("rollup_swap", _with(f"{_DAYS}, {s.TUPLES.removeprefix(s.EVENTS + ', ')}", f"SELECT ti AS timeinterval, hostname, tier, topic, cluster, {s.SUM_MEASURES} FROM (SELECT *, CASE WHEN timeinterval - timeinterval % 86400000 IN (SELECT day FROM ro) THEN timeinterval - timeinterval % 3600000 ELSE timeinterval END ti FROM t) GROUP BY ti, hostname, tier, topic, cluster"))
def _(spark, d):
    return rollup.rollup_swap(v.tuples(spark, d), _days(spark, d)[1])


# topology


@_query("topology_nodes", _with(s.TOPICS, f'SELECT "name", cluster, tier, received, sent, topics, {s.percentile_sql([50.0, 99.0])} FROM (SELECT "name", cluster, tier, sum(received)::BIGINT received, sum(sent)::BIGINT sent, count(DISTINCT topic) topics, {", ".join(f"sum({b})::BIGINT {b}" for b in m.BUCKETS)} FROM tc GROUP BY "name", cluster, tier)'))
def _(spark, d):
    return topology.topology_nodes(v.tuples(spark, d), [50.0, 99.0]).drop("stats")


@_query("topic_percentiles", _with(s.TOPICS, f'SELECT "name", cluster, tier, topic, received, sent, {s.percentile_sql([70.0])} FROM (SELECT "name", cluster, tier, topic, sum(received)::BIGINT received, sum(sent)::BIGINT sent, {", ".join(f"sum({b})::BIGINT {b}" for b in m.BUCKETS)} FROM tc GROUP BY "name", cluster, tier, topic)'))
def _(spark, d):
    return topology.topic_percentiles(v.tuples(spark, d), [70.0])


@_query("vip_nodes", _with(s.TOPICS, "SELECT 'VIP' AS \"name\", cluster, 'VIP' tier, sum(received)::BIGINT received, sum(sent)::BIGINT sent, count(DISTINCT lower(topic)) topics FROM tc WHERE tier = 'COLLECTOR' GROUP BY cluster"))
def _(spark, d):
    return topology.vip_nodes(v.tuples(spark, d))


_SEEN = f"""{s.EVENTS}, by_ AS (SELECT topic, cluster, count(*) n, min(event_id) first_ FROM e GROUP BY topic, cluster),
so AS (SELECT topic stream, cluster, n % 5 <> 0 enabled FROM by_), de AS (SELECT topic stream, cluster, row_number() OVER (PARTITION BY topic ORDER BY n DESC, cluster) = 1 is_primary FROM by_)"""


def _seen(spark, d):
    """Sources and destinations as the events show them: a stream's primary cluster is the one with most of its events."""
    from pyspark.sql import Window

    by = v.events(spark, d).groupBy(F.col("topic").alias("stream"), "cluster").agg(F.count("*").alias("n"))
    turn = F.row_number().over(Window.partitionBy("stream").orderBy(F.desc("n"), "cluster"))
    return by.select("stream", "cluster", (F.col("n") % 5 != 0).alias("enabled")), by.select("stream", "cluster", (turn == 1).alias("is_primary"))


@_query("source_clusters", _with(_SEEN, """SELECT DISTINCT 'MERGE' tier, de.cluster, so.cluster source FROM de JOIN so USING (stream) WHERE is_primary AND enabled
UNION SELECT DISTINCT 'MIRROR', de.cluster, p.cluster FROM de JOIN de p USING (stream) WHERE NOT de.is_primary AND p.is_primary"""))
def _(spark, d):
    return topology.source_clusters(*_seen(spark, d))


@_query("tier_links", _with(s.NODES, "SELECT * FROM links"))
def _(spark, d):
    nodes = topology._nodes(v.tuples(spark, d)).select("name", "cluster", "tier").distinct()
    return topology.tier_links(nodes, topology.source_clusters(v.stream_source(spark), v.stream_dest(spark)))


_BELOW = 'bl AS (SELECT tier, cluster, topic, sum(received)::BIGINT n FROM nd GROUP BY tier, cluster, topic)'


@_query("link_health", _with(f"""{s.NODES}, {_BELOW},
fed AS (SELECT x.tier, x.cluster, sum(bl.n)::BIGINT fed FROM tsrc x JOIN bl ON bl.tier = CASE WHEN x.tier = 'MERGE' THEN 'LOCAL' ELSE 'MERGE' END AND bl.cluster = x.source AND bl.topic = x.topic GROUP BY x.tier, x.cluster),
hp AS (SELECT h."name" pn, h.cluster pc, h.hostname ch, sum(h.received)::BIGINT up, sum(c.sent)::BIGINT down FROM nd h JOIN nd c ON c.tier = 'COLLECTOR' AND c."name" = h.hostname AND c.cluster = h.cluster AND c.topic = h.topic WHERE h.tier = 'HDFS' GROUP BY h."name", h.cluster, h.hostname),
j AS (SELECT k.*, a.received ar, b.received br, b.sent bs, sum(b.received) OVER (PARTITION BY parent_name, parent_cluster, parent_tier)::BIGINT plain,
  (SELECT sum(received)::BIGINT FROM nn z WHERE z.tier = 'COLLECTOR' AND z.cluster = k.parent_cluster) ac FROM links k
  JOIN nn a ON a."name" = parent_name AND a.cluster = parent_cluster AND a.tier = parent_tier JOIN nn b ON b."name" = child_name AND b.cluster = child_cluster AND b.tier = child_tier),
ab AS (SELECT j.*, CASE parent_tier WHEN 'COLLECTOR' THEN ac WHEN 'HDFS' THEN coalesce(hp.up, 0) ELSE ar END above,
  CASE WHEN parent_tier IN ('MERGE', 'MIRROR') THEN coalesce(fed.fed, 0) WHEN parent_tier = 'HDFS' THEN coalesce(hp.down, 0) ELSE plain END beneath
  FROM j LEFT JOIN hp ON parent_tier = 'HDFS' AND hp.pn = parent_name AND hp.pc = parent_cluster AND hp.ch = child_name LEFT JOIN fed ON fed.tier = parent_tier AND fed.cluster = parent_cluster)""",
f"""SELECT parent_name, parent_cluster, parent_tier, child_name, child_cluster, child_tier, above, beneath,
CASE WHEN ar = 0 OR br = 0 OR (child_tier IN ('AGENT', 'COLLECTOR') AND bs = 0) THEN 'nofill' WHEN {s.loss('above', 'beneath', 2)} THEN 'loss' ELSE 'healthy' END status FROM ab"""))  # fmt: skip
def _(spark, d):
    return topology.link_health(v.tuples(spark, d), v.stream_source(spark), v.stream_dest(spark), 2)


@_query("streams_losing_data", _with(f"""{s.NODES}, tt AS (SELECT "name", cluster, tier, topic, sum(received)::BIGINT received, sum(sent)::BIGINT sent FROM nd GROUP BY "name", cluster, tier, topic),
up AS (SELECT "name", cluster, tier, topic, hostname AS host, received AS above FROM nd WHERE tier = 'HDFS'
  UNION ALL SELECT n."name", n.cluster, n.tier, c.topic, NULL, c.r FROM nn n JOIN (SELECT cluster, topic, sum(received)::BIGINT r FROM tt WHERE tier = 'COLLECTOR' GROUP BY cluster, topic) c ON c.cluster = n.cluster WHERE n.tier = 'COLLECTOR'
  UNION ALL SELECT "name", cluster, tier, topic, NULL, received FROM tt WHERE tier NOT IN ('HDFS', 'COLLECTOR')),
j AS (SELECT k.*, c.topic, CASE WHEN k.parent_tier = 'HDFS' THEN c.sent ELSE c.received END beneath, up.above,
  EXISTS (SELECT 1 FROM tsrc x WHERE x.tier = k.parent_tier AND x.cluster = k.parent_cluster AND x.topic = c.topic AND x.source = k.child_cluster) fed
  FROM links k JOIN tt c ON c."name" = child_name AND c.cluster = child_cluster AND c.tier = child_tier
  LEFT JOIN up ON up."name" = parent_name AND up.cluster = parent_cluster AND up.tier = parent_tier AND up.topic = c.topic AND up.host IS NOT DISTINCT FROM CASE WHEN k.parent_tier = 'HDFS' THEN child_name END)""",
f"""SELECT DISTINCT parent_name, parent_cluster, parent_tier, child_name, child_cluster, child_tier, topic FROM j
WHERE CASE WHEN parent_tier IN ('MERGE', 'MIRROR') THEN fed AND above IS NOT NULL AND {s.loss('above', 'beneath', 2)} ELSE above IS NULL OR {s.loss('above', 'beneath', 2)} END"""))  # fmt: skip
def _(spark, d):
    return topology.streams_losing_data(v.tuples(spark, d), v.stream_source(spark), v.stream_dest(spark), 2)


_COMP = f"""{s.NODES}, bl AS (SELECT tier, cluster, topic, sum(received)::BIGINT n FROM tc GROUP BY tier, cluster, topic),
cu AS (SELECT k.tier, coalesce((SELECT coalesce(sum(bl.n), 0) FROM tsrc x JOIN bl own ON own.tier = x.tier AND own.cluster = x.cluster AND own.topic = x.topic
  LEFT JOIN bl ON bl.tier = CASE WHEN x.tier = 'MERGE' THEN 'LOCAL' ELSE 'MERGE' END AND bl.cluster = x.source AND bl.topic = x.topic WHERE x.tier = k.tier HAVING count(*) > 0), -1)::BIGINT upstream FROM (VALUES ('MERGE'), ('MIRROR')) k(tier))"""


@_query("comparable_upstream", _with(_COMP, "SELECT * FROM cu"))
def _(spark, d):
    return topology.comparable_upstream(v.tuples(spark, d), v.stream_source(spark), v.stream_dest(spark))


@_query("tier_count_summary", _with(f"""{_COMP}, per AS (SELECT tier, sum({s.RECEIVED})::BIGINT received, sum(sent)::BIGINT sent FROM t GROUP BY tier),
ups AS (SELECT b.tier, CASE WHEN by_sent THEN p.sent ELSE p.received END upstream FROM (VALUES ('AGENT', 'PUBLISHER', false), ('COLLECTOR', 'AGENT', true), ('HDFS', 'COLLECTOR', true), ('LOCAL', 'HDFS', false)) b(tier, before, by_sent) JOIN per p ON p.tier = b.before UNION ALL SELECT * FROM cu)""",
"SELECT per.tier, received, sent, coalesce(upstream, 0) upstream, CASE WHEN per.tier = 'PUBLISHER' THEN CASE WHEN received = 0 THEN 'NoData' ELSE 'Healthy' END ELSE "
+ _HEALTH.format(a="received", b="coalesce(upstream, 0)", w=s.loss("received", "coalesce(upstream, 0)", 1), l=s.loss("received", "coalesce(upstream, 0)", 5)) + " END health FROM per LEFT JOIN ups ON ups.tier = per.tier"))
def _(spark, d):
    return topology.tier_count_summary(v.tuples(spark, d), v.stream_source(spark), v.stream_dest(spark), 5, 1)


@_query("filter_topology", _with(s.TOPICS, f"SELECT \"name\", cluster, tier, received, sent, topics, {s.percentile_sql([99.0])} FROM (SELECT \"name\", cluster, tier, sum(received)::BIGINT received, sum(sent)::BIGINT sent, count(DISTINCT topic) topics, {', '.join(f'sum({b})::BIGINT {b}' for b in m.BUCKETS)} FROM tc WHERE topic IN ('click', 'view') GROUP BY \"name\", cluster, tier)"))
def _(spark, d):
    return topology.filter_topology(v.tuples(spark, d), ["click", "view"])


@_query("filter_topology_scope", _with(f"""{s.TOPICS}, {s.CONFIG}, {s.SOURCES},
own AS (SELECT 'cluster1' cluster UNION SELECT source FROM sc WHERE tier = 'MIRROR' AND cluster = 'cluster1'), scope AS (SELECT cluster FROM own UNION SELECT source FROM sc WHERE tier = 'MERGE' AND cluster IN (SELECT cluster FROM own)),
ft AS (SELECT * FROM tc WHERE topic IN ('view', 'purchase') AND cluster IN (SELECT cluster FROM scope)),
fs AS (SELECT ft."name", ft.cluster, ft.tier, string_agg(DISTINCT source, ',' ORDER BY source) sources FROM ft JOIN tsrc ON tsrc.tier = ft.tier AND tsrc.cluster = ft.cluster AND tsrc.topic = ft.topic GROUP BY ft."name", ft.cluster, ft.tier)""",
f"""SELECT n.*, sources FROM (SELECT "name", cluster, tier, received, sent, topics, {s.percentile_sql([99.0])} FROM (SELECT "name", cluster, tier, sum(received)::BIGINT received, sum(sent)::BIGINT sent, count(DISTINCT topic) topics,
  {', '.join(f'sum({b})::BIGINT {b}' for b in m.BUCKETS)} FROM ft GROUP BY "name", cluster, tier)) n LEFT JOIN fs ON fs."name" = n."name" AND fs.cluster = n.cluster AND fs.tier = n.tier"""))  # fmt: skip
def _(spark, d):
    return topology.filter_topology(v.tuples(spark, d), ["view", "purchase"], "cluster1", v.stream_source(spark), v.stream_dest(spark))


@_query("sent_vs_received", _with(s.TOPICS, 'SELECT *, sent <> received mismatch FROM (SELECT "name", cluster, tier, topic, sum(received)::BIGINT received, sum(sent)::BIGINT sent FROM tc WHERE tier IN (\'AGENT\', \'COLLECTOR\') GROUP BY "name", cluster, tier, topic)'))
def _(spark, d):
    return topology.sent_vs_received(v.tuples(spark, d))


# listings

_L, _MG, _MR = (lambda spark, d, side=side: v.listing(spark, d, side) for side in ("local", "merge", "mirror"))


def _lsql(select: str, more: str = "") -> str:
    return _with(s.LISTINGS + (", " + more if more else ""), select)


_HOLES = """hl AS (SELECT cluster, stream, "minute" + 60000 a, nx - 60000 z FROM (SELECT *, lead("minute") OVER (PARTITION BY cluster, stream ORDER BY "minute") nx FROM (SELECT DISTINCT cluster, stream, "minute" FROM ll)) WHERE nx > "minute" + 60000)"""


@_query("minute_holes", _lsql('SELECT cluster, stream, unnest(range(a, z + 1, 60000)) AS "minute" FROM hl', _HOLES))
def _(spark, d):
    return listing.minute_holes(_L(spark, d))


@_query("minute_hole_ranges", _lsql("SELECT cluster, stream, a AS first, z AS last FROM hl", _HOLES))
def _(spark, d):
    return listing.minute_holes(_L(spark, d), True)


@_query("out_of_order_minutes", _lsql('SELECT cluster, stream, "minute" FROM (SELECT *, lead(mt) OVER (PARTITION BY cluster, stream ORDER BY "minute") nx FROM (SELECT cluster, stream, "minute", max(mtime) mt FROM ll GROUP BY cluster, stream, "minute")) WHERE mt > nx'))
def _(spark, d):
    return listing.out_of_order_minutes(_L(spark, d))


@_query("duplicate_files", _lsql('SELECT stream, "name", path FROM (SELECT *, row_number() OVER (PARTITION BY stream, "name" ORDER BY path) r FROM lm) WHERE r > 1'))
def _(spark, d):
    return listing.duplicate_files(_MG(spark, d))


@_query("missing_in_merge", _lsql('SELECT stream, "name", path FROM ll WHERE NOT EXISTS (SELECT 1 FROM lm WHERE lm.stream = ll.stream AND lm."name" = ll."name")'))
def _(spark, d):
    return listing.missing_in_merge(_L(spark, d), _MG(spark, d))


@_query("missing_extra_in_mirror", _lsql("SELECT coalesce(a.below, b.below) below, CASE WHEN b.below IS NULL THEN 'missing' ELSE 'extra' END finding FROM (SELECT DISTINCT substring(path, 7) below FROM lm) a FULL JOIN (SELECT DISTINCT substring(path, 8) below FROM lr) b ON a.below = b.below WHERE a.below IS NULL OR b.below IS NULL"))
def _(spark, d):
    return listing.missing_extra_in_mirror(_MG(spark, d), _MR(spark, d))


@_query("listing_diff", _lsql("""SELECT coalesce(a.stream, b.stream) stream, coalesce(a."name", b."name") AS "name", CASE WHEN b."name" IS NULL THEN 'left' ELSE 'right' END side FROM (SELECT DISTINCT stream, "name" FROM ll) a FULL JOIN (SELECT DISTINCT stream, "name" FROM lr) b ON a.stream = b.stream AND a."name" = b."name" WHERE a."name" IS NULL OR b."name" IS NULL"""))
def _(spark, d):
    return listing.listing_diff(_L(spark, d), _MR(spark, d), ["stream", "name"])


@_query("local_consistency", _with(_CF, """SELECT coalesce(a.stream, b.stream) stream, coalesce(a."name", b."name") AS "name", CASE WHEN b."name" IS NULL THEN 'left' ELSE 'right' END side FROM
(SELECT stream, collector || '-' || "name" || '.gz' AS "name" FROM lf WHERE event_id % 3 <> 0 UNION SELECT stream, collector || '-' || "name" || '.gz' FROM lf WHERE event_id % 3 = 0 AND event_id % 19 <> 0) a
FULL JOIN (SELECT DISTINCT stream, collector || '-' || "name" || '.gz' AS "name" FROM lf WHERE event_id % 23 <> 0) b ON a.stream = b.stream AND a."name" = b."name" WHERE a."name" IS NULL OR b."name" IS NULL"""))
def _(spark, d):
    f = movement.exclude_live_files(_collector_files(spark, d))
    trash = f.where("event_id % 3 = 0 and event_id % 19 <> 0").select("stream", F.concat("collector", F.lit("-"), "name").alias("name"))
    local = f.where("event_id % 23 <> 0").select("stream", F.concat("collector", F.lit("-"), "name", F.lit(".gz")).alias("name"), F.lit(False).alias("is_dir"))
    return listing.local_consistency(f.where("event_id % 3 <> 0"), trash, local)


@_query("merge_consistency", _lsql("""SELECT coalesce(a.stream, b.stream) stream, coalesce(a."name", b."name") AS "name", CASE WHEN b."name" IS NULL THEN 'missing' ELSE 'replayed' END finding FROM (SELECT DISTINCT stream, "name" FROM ll) a FULL JOIN (SELECT DISTINCT stream, "name" FROM lm) b ON a.stream = b.stream AND a."name" = b."name" WHERE a."name" IS NULL OR b."name" IS NULL
UNION ALL SELECT stream, "name", 'duplicate' FROM lm GROUP BY stream, "name" HAVING count(*) > 1"""))
def _(spark, d):
    return listing.merge_consistency(_L(spark, d), _MG(spark, d))


_MHOLES = """mh AS (SELECT stream, "minute" + 60000 a, nx - 60000 z FROM (SELECT *, lead("minute") OVER (PARTITION BY stream ORDER BY "minute") nx FROM (SELECT DISTINCT stream, "minute" FROM lm)) WHERE nx > "minute" + 60000)"""
_MISS = 'SELECT stream, path FROM ll WHERE NOT EXISTS (SELECT 1 FROM lm WHERE lm.stream = ll.stream AND lm."name" = ll."name")'


@_query("fix_plan", _lsql(f"""SELECT 'copy' AS action, stream, path, NULL::BIGINT AS "minute" FROM ({_MISS}) UNION ALL SELECT 'create', stream, NULL, unnest(range(a, z + 1, 60000)) FROM mh""", _MHOLES))
def _(spark, d):
    return listing.fix_plan(_L(spark, d), _MG(spark, d))


def _wanted(spark, d):
    return v.events(spark, d).select(F.col("topic").alias("stream"), F.explode(F.array(F.lit("merge"), F.lit("mirror"))).alias("mode"), "cluster").distinct()


@_query("validate_streams", _lsql(f"""SELECT 'not configured' finding, stream, cluster, mode AS what FROM wa WHERE NOT ok
UNION ALL SELECT 'missing', x.stream, wa.cluster, x.path FROM ({_MISS}) x JOIN wa ON wa.stream = x.stream AND ok AND mode = 'merge'
UNION ALL SELECT 'duplicate', x.stream, wa.cluster, x.path FROM (SELECT *, row_number() OVER (PARTITION BY stream, "name" ORDER BY path) r FROM lm) x JOIN wa ON wa.stream = x.stream AND ok AND mode = 'merge' WHERE r > 1
UNION ALL SELECT 'hole', x.stream, wa.cluster, CAST(a AS VARCHAR) FROM mh x JOIN wa ON wa.stream = x.stream AND ok AND mode = 'merge'
UNION ALL SELECT finding, wa.stream, wa.cluster, below FROM (SELECT coalesce(a.below, b.below) below, CASE WHEN b.below IS NULL THEN 'missing' ELSE 'extra' END finding FROM (SELECT DISTINCT substring(path, 7) below FROM lm) a FULL JOIN (SELECT DISTINCT substring(path, 8) below FROM lr) b ON a.below = b.below WHERE a.below IS NULL OR b.below IS NULL) x JOIN wa ON wa.stream = string_split(below, '/')[1] AND ok AND mode = 'mirror'""",
f"""{_MHOLES}, {s.CONFIG}, wa AS (SELECT *, EXISTS (SELECT 1 FROM sd WHERE sd.stream = w.stream AND sd.cluster = w.cluster AND is_primary = (w.mode = 'merge')) ok FROM (SELECT DISTINCT topic stream, mode, cluster FROM e, (VALUES ('merge'), ('mirror')) q(mode)) w)"""))
def _(spark, d):
    return listing.validate_streams(_L(spark, d), _MG(spark, d), _MR(spark, d), _wanted(spark, d), v.stream_dest(spark))


@_query("order_listing", _lsql('SELECT "minute", path, length FROM lm'))
def _(spark, d):
    return listing.order_listing(_MG(spark, d)).select("minute", "path", "length")


@_query("read_listing_range", _lsql(f'SELECT path, "minute" FROM lm WHERE "minute" >= {MID} AND "minute" < {MID + m.DAY}'))
def _(spark, d):
    return listing.in_range(_MG(spark, d), MID, MID + m.DAY).select("path", "minute")


# movement


@_query("next_minutes_batch", _lsql("""SELECT stream, "minute" FROM (SELECT a.stream, a."minute", c.cp, row_number() OVER (PARTITION BY a.stream ORDER BY a."minute") r, lead(a."minute") OVER (PARTITION BY a.stream ORDER BY a."minute") nx FROM (SELECT DISTINCT stream, "minute" FROM ll) a JOIN cps c ON c.stream = a.stream WHERE a."minute" > c.cp) WHERE "minute" = cp + r * 60000 AND nx = "minute" + 60000 AND r <= 31""",
'cps AS (SELECT stream, min("minute") cp FROM (SELECT stream, "minute", lead("minute", 2) OVER (PARTITION BY stream ORDER BY "minute") n2 FROM (SELECT DISTINCT stream, "minute" FROM ll)) WHERE n2 = "minute" + 120000 GROUP BY stream)'))
def _(spark, d):
    from pyspark.sql import Window

    minutes = _L(spark, d).select("stream", "minute").distinct()
    two = F.lead("minute", 2).over(Window.partitionBy("stream").orderBy("minute"))
    cps = minutes.withColumn("n2", two).where(F.col("n2") == F.col("minute") + 2 * m.MINUTE).groupBy("stream").agg(F.min("minute").alias("checkpoint"))
    return movement.next_minutes_batch(minutes, cps)


@_query("merge_plan", _lsql(f'SELECT stream, "name", path AS source, {MID}::BIGINT commit_minute FROM (SELECT *, row_number() OVER (PARTITION BY stream, "name" ORDER BY "minute" DESC, path DESC) r FROM lm) WHERE r = 1'))
def _(spark, d):
    return movement.merge_plan(_MG(spark, d), MID)


@_query("mirror_plan", _lsql('SELECT substring(path, 7) below, path, "minute", false is_dir FROM lm WHERE substring(path, 7) NOT IN (SELECT substring(path, 8) FROM lr)'))
def _(spark, d):
    return movement.mirror_plan(_MG(spark, d), _MR(spark, d))


_KN = """kn AS (SELECT a.stream, a."minute" sm, a."name", b.t FROM ll a JOIN (SELECT stream, "name", max("minute") t FROM lm WHERE "minute" < {0} GROUP BY stream, "name") b ON a.stream = b.stream AND a."name" = b."name"),
nw AS (SELECT stream, sm AS last FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY t DESC, "name" DESC) r FROM kn) WHERE r = 1)""".format(MID)


@_query("merge_start", _lsql(f"""SELECT f.stream, coalesce(nw.last + 60000, f.first_) AS start, coalesce(g.missing, 0) missing FROM (SELECT stream, min("minute") first_ FROM ll GROUP BY stream) f LEFT JOIN nw ON nw.stream = f.stream
LEFT JOIN (SELECT ll.stream, count(*) missing FROM ll JOIN nw ON nw.stream = ll.stream AND nw.last = ll."minute" WHERE NOT EXISTS (SELECT 1 FROM lm WHERE "minute" < {MID} AND lm.stream = ll.stream AND lm."name" = ll."name") GROUP BY ll.stream) g ON g.stream = f.stream""", _KN))
def _(spark, d):
    return movement.merge_start(_L(spark, d), _MG(spark, d).where(F.col("minute") < MID))


@_query("mirror_start", _lsql(f"""SELECT f.stream, coalesce(l.last + 60000, f.first_) AS start, coalesce(g.missing, 0) missing FROM (SELECT stream, min("minute") first_ FROM lm GROUP BY stream) f LEFT JOIN la l ON l.stream = f.stream
LEFT JOIN (SELECT lm.stream, count(*) missing FROM lm JOIN la ON la.stream = lm.stream AND la.last = lm."minute" WHERE NOT EXISTS (SELECT 1 FROM lr WHERE "minute" < {MID} AND lr.stream = lm.stream AND lower(lr."name") = lower(lm."name")) GROUP BY lm.stream) g ON g.stream = f.stream""", f'la AS (SELECT stream, max("minute") AS last FROM lr WHERE "minute" < {MID} GROUP BY stream)'))
def _(spark, d):
    return movement.mirror_start(_MG(spark, d), _MR(spark, d).where(F.col("minute") < MID))


@_query("publish_missing_minutes", _lsql(f'SELECT cluster, stream, unnest(range(l + 60000, {MID}, 60000)) AS "minute" FROM (SELECT cluster, stream, max("minute") l FROM ll WHERE "minute" < {MID} GROUP BY cluster, stream) WHERE l + 60000 < {MID}'))
def _(spark, d):
    return movement.publish_missing_minutes(_L(spark, d), MID)


@_query("partitions_to_register", _lsql("""SELECT stream, x AS "minute", 'ALTER TABLE ' || stream || ' ADD IF NOT EXISTS PARTITION (' || strftime(make_timestamp(x * 1000), 'year=''%Y'', month=''%m'', day=''%d'', hour=''%H'', minute=''%M''') || ')' AS statement
FROM (SELECT stream, unnest(range(st, nw, 60000)) x FROM (SELECT stream, coalesce(max("minute") FILTER ("minute" < {0} AND stream <> 'view') + 60000, min("minute")) st, max("minute") nw FROM ll GROUP BY stream))""".format(START + 28 * m.DAY)))
def _(spark, d):
    rows = _L(spark, d)
    done = rows.where((F.col("minute") < START + 28 * m.DAY) & (F.col("stream") != "view")).groupBy("stream").agg(F.max("minute").alias("last"))
    return movement.partitions_to_register(rows, done)


_RET = f"{s.CONFIG}, re AS (SELECT stream, cluster, max(retention_h) AS hours FROM (SELECT stream, cluster, retention_h FROM ss UNION ALL SELECT stream, cluster, retention_h FROM sd) GROUP BY stream, cluster)"


@_query("purge_plan", _lsql(f'SELECT h.stream, h.cluster, h.hour FROM (SELECT DISTINCT stream, cluster, "minute" - "minute" % 3600000 AS hour FROM ll) h LEFT JOIN re ON re.stream = h.stream AND re.cluster = h.cluster WHERE abs({NOW} - h.hour) // 3600000 >= coalesce(hours, 24)', _RET))
def _(spark, d):
    hours = movement.retention(v.stream_source(spark), v.stream_dest(spark), 24)
    return movement.purge_plan(_L(spark, d), hours, NOW)


#: Folders of the days that have local files; every third is there without files of its own, and some months and years are bare.
_FOLDERS = f"""{s.EVENTS}, dy AS (SELECT DISTINCT topic, ms - ms % 86400000 d0 FROM e), fo AS (
  SELECT 'r/' || topic || '/' || strftime(make_timestamp(d0 * 1000), '%Y/%m/%d') AS path FROM dy UNION SELECT 'r/' || topic || '/' || strftime(make_timestamp(d0 * 1000), '%Y/%m') FROM dy
  UNION SELECT 'r/' || topic || '/' || strftime(make_timestamp(d0 * 1000), '%Y') FROM dy UNION SELECT 'r/' || topic || '/' || strftime(make_timestamp(d0 * 1000), '%Y/0%d') FROM dy WHERE strftime(make_timestamp(d0 * 1000), '%d') = '09'
  UNION SELECT 'r/' || topic || '/2019' FROM dy),
fi AS (SELECT DISTINCT 'r/' || topic || '/' || strftime(make_timestamp(ms * 1000), '%Y/%m/%d') || '/x' AS path FROM e WHERE (ms // 86400000) % 3 <> 0),
en AS (SELECT path, true is_dir FROM fo UNION ALL SELECT path, false FROM fi)"""


@_query("purge_childless", _with(_FOLDERS, """SELECT path, CASE len(string_split(path, '/')) WHEN 3 THEN 'year' WHEN 4 THEN 'month' WHEN 5 THEN 'day' END AS level FROM fo
WHERE path NOT IN (SELECT regexp_extract(path, '^(.*)/[^/]+$', 1) FROM en)"""))
def _(spark, d):
    e = v.events(spark, d)
    day = lambda p: F.concat(F.lit("r/"), "topic", F.lit("/"), m.minute_text(F.col("ms"), p))
    dirs = [e.select(day(p).alias("path")) for p in ("yyyy/MM/dd", "yyyy/MM", "yyyy")]
    dirs += [e.where(m.minute_text(F.col("ms"), "dd") == "09").select(day("yyyy/'0'dd").alias("path")), e.select(F.concat(F.lit("r/"), "topic", F.lit("/2019")).alias("path"))]
    folders = dirs[0].unionByName(dirs[1]).unionByName(dirs[2]).unionByName(dirs[3]).unionByName(dirs[4]).distinct().withColumn("is_dir", F.lit(True))
    inside = e.where("(ms div 86400000) % 3 <> 0").select(F.concat(day("yyyy/MM/dd"), F.lit("/x")).alias("path"), F.lit(False).alias("is_dir")).distinct()
    return movement.childless_folders(folders.unionByName(inside).withColumn("root", F.lit("r")))


@_query("retention_guard", _lsql(f'SELECT f.stream, f.cluster, f.st AS "start" FROM (SELECT stream, cluster, max("minute") - (max("minute") - min("minute")) // 2 st FROM ll GROUP BY stream, cluster) f LEFT JOIN re ON re.stream = f.stream AND re.cluster = f.cluster WHERE f.st < {START + 17 * m.DAY} - coalesce(hours, 24) * 3600000', _RET))
def _(spark, d):
    hours = movement.retention(v.stream_source(spark), v.stream_dest(spark), 24)
    starts = _L(spark, d).groupBy("stream", "cluster").agg(F.expr("max(minute) - (max(minute) - min(minute)) div 2").alias("start"))
    return movement.starts_too_old(starts, hours, START + 17 * m.DAY)


def _trash(spark, d):
    hour = F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(F.col("event_id") % 31 == 0, "xx").otherwise(F.date_format(F.timestamp_millis("ms"), "HH"))
    return v.events(spark, d).select(F.date_format(F.timestamp_millis("ms"), "yyyy-MM-dd").alias("date"), hour.alias("hour")).distinct()


@_query("trash_purge_plan", _with(f"""{s.EVENTS}, tr AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'xx' ELSE strftime(ts, '%H') END AS hour FROM e)""",
f"""SELECT date, hour FROM (SELECT *, epoch_us(strptime(date, '%Y-%m-%d')) // 1000 + CASE WHEN hour IS NULL THEN 23 ELSE TRY_CAST(hour AS INT) END * 3600000 a FROM tr) WHERE a IS NULL OR abs({NOW} - a) // 3600000 >= 48"""))
def _(spark, d):
    return movement.trash_purge_plan(_trash(spark, d), NOW, 48)


@_query("checkpoint_at", _lsql('SELECT x.stream, x.mode, x.cluster, k.mn AS "minute" FROM (SELECT stream, \'merge\' AS mode, cluster FROM ss WHERE stream = \'click\' UNION ALL SELECT stream, \'mirror\', cluster FROM sd WHERE stream = \'click\' AND is_primary) x, (SELECT max("minute") mn FROM ll WHERE stream = \'click\') k WHERE EXISTS (SELECT 1 FROM ll WHERE ll.stream = x.stream AND ll.cluster = x.cluster AND ll."minute" = k.mn)', s.CONFIG))
def _(spark, d):
    rows = _L(spark, d)
    last = rows.where("stream = 'click'").agg(F.max("minute").alias("at"))
    return movement.checkpoint_at(rows, v.stream_source(spark), v.stream_dest(spark), "click", last)


def _sync_sides(spark, d):
    mark = F.when(F.col("event_id") % 29 == 0, "new").otherwise("same")
    source = movement.sync_listing(_MG(spark, d)).withColumn("checksum", mark)
    target = movement.sync_listing(_MR(spark, d)).withColumn("checksum", F.lit("same")).withColumn("is_dir", F.col("event_id") % 211 == 0)
    return source, target


_SYNC = """a AS (SELECT substring(path, 7) below, length, CASE WHEN event_id % 29 = 0 THEN 'new' ELSE 'same' END ck FROM lm), b AS (SELECT substring(path, 8) below, length tl, event_id % 211 = 0 td FROM lr),
pl AS (SELECT a.below, a.length, CASE WHEN b.below IS NULL THEN 'copy' WHEN td THEN 'conflict' WHEN a.length <> tl OR ck <> 'same' THEN 'copy' ELSE 'skip' END AS action FROM a LEFT JOIN b ON a.below = b.below)"""


@_query("sync_plan", _lsql("SELECT * FROM pl", _SYNC))
def _(spark, d):
    return movement.sync_plan(*_sync_sides(spark, d), update=True)


@_query("sync_plan_blocks", _lsql("""SELECT a.below, a.length, CASE WHEN b.below IS NULL THEN 'copy' WHEN td THEN 'conflict' WHEN a.length <> tl OR a.length % 3 = 0 THEN 'copy' ELSE 'skip' END AS action
FROM a LEFT JOIN b ON a.below = b.below""", _SYNC))
def _(spark, d):
    """Block sizes are to be the source's, whatever the checksums: those of every third length differ."""
    source, target = _sync_sides(spark, d)
    blocks = F.when(F.col("length") % 3 == 0, 64).otherwise(128)
    return movement.sync_plan(source.withColumn("block_size", blocks), target.withColumn("block_size", F.lit(128)), update=True, preserve_blocks=True, skip_checksums=True)


@_query("copy_summary", _lsql("SELECT action, count(*) paths, sum(length)::BIGINT bytes FROM pl GROUP BY action", _SYNC))
def _(spark, d):
    return movement.copy_summary(movement.sync_plan(*_sync_sides(spark, d), update=True))


@_query("sync_delete_missing", _lsql("SELECT below FROM b WHERE below NOT IN (SELECT below FROM a)", _SYNC))
def _(spark, d):
    return movement.sync_delete_missing(*_sync_sides(spark, d))


@_query("sync_duplicate_check", _lsql("SELECT below, count(*) n FROM (SELECT substring(path, 7) below FROM lm UNION ALL SELECT substring(path, 8) FROM lr) GROUP BY below HAVING count(*) > 1"))
def _(spark, d):
    a, b = _sync_sides(spark, d)
    return movement.sync_duplicates(a.select("below").unionByName(b.select("below")))


@_query("sync_listing", _lsql("SELECT path, substring(path, 7) below FROM lm WHERE stream IN ('click', 'signup')"))
def _(spark, d):
    paths = v.events(spark, d).where("topic in ('click', 'signup')").select(F.concat(F.lit("merge/"), "topic").alias("path")).distinct()
    return movement.sync_listing(_MG(spark, d), paths).select("path", "below")


# files and streams


@_query("collapse_lines", "SELECT DISTINCT trim(x, ' ') AS \"value\" FROM (SELECT unnest(string_split(text, chr(10))) x FROM documents)")
def _(spark, d):
    return files.collapse_lines(spark.read.parquet(f"{d}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("value")))


@_query("write_minute_partitions", _with(s.EVENTS, "SELECT topic AS stream, strftime(ts, '%Y/%m/%d/00/00') AS dir, count(*) n FROM e GROUP BY 1, 2"))
def _(spark, d):
    path = files.scratch(spark)
    lines = v.events(spark, d).select(F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), (F.col("ms") - F.col("ms") % m.DAY).alias("at"))
    files.write_minute_partitions(lines, path, F.col("at"))
    read = files.read_lines(spark, path).withColumn("dir", F.regexp_replace(F.regexp_extract("path", r"year=(.*)/[^/]*$", 1), "(month|day|hour|minute)=", ""))
    return read.groupBy("stream", "dir").agg(F.count("*").alias("n"))


@_query("read_lines", _with(s.EVENTS, "SELECT topic AS stream, cluster || '-' || hostname AS collector, count(*) n, sum(event_id)::BIGINT total FROM e GROUP BY 1, 2"))
def _(spark, d):
    path = files.scratch(spark)
    lines = v.events(spark, d).select(F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), F.concat("cluster", F.lit("-"), "hostname").alias("collector"))
    lines.write.partitionBy("stream", "collector").option("compression", "gzip").text(path)
    return files.read_lines(spark, path).groupBy("stream", "collector").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


def _emptied(spark, d):
    """Minute folders of days; in those of every fifth day no file is left."""
    path = files.scratch(spark)
    lines = v.events(spark, d).select(F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), (F.col("ms") - F.col("ms") % m.DAY).alias("at"))
    files.write_minute_partitions(lines, path, F.col("at"))
    folders = files.read_listing(spark, path, "c", "r").select(F.regexp_extract("path", "^(.*/minute=[^/]+)", 1).alias("at")).distinct()
    for row in folders.where(F.regexp_extract("at", "/day=([0-9]+)/", 1).cast("int") % 5 == 0).collect():
        facts.Folder(spark, row["at"]).delete()
        facts.Folder(spark, row["at"]).make()
    return path


@_query("read_listing", _with(s.EVENTS, f'SELECT DISTINCT topic AS stream, ms - ms % 86400000 AS "minute", extract(day FROM ts) % 5 = 0 is_dir FROM e WHERE ms - ms % 86400000 >= {MID} AND ms - ms % 86400000 < {MID + 9 * m.DAY}'))
def _(spark, d):
    return files.read_listing(spark, _emptied(spark, d), "c", "r", MID, MID + 9 * m.DAY).select("stream", "minute", "is_dir").distinct()


@_query("read_listing_holes", _with(s.EVENTS, """SELECT stream, count(*) missing FROM (SELECT topic stream, lead(d0) OVER (PARTITION BY topic ORDER BY d0) nx, d0 FROM (SELECT DISTINCT topic, ms - ms % 86400000 d0 FROM e)) WHERE nx > d0 + 60000 GROUP BY stream"""))
def _(spark, d):
    rows = files.read_listing(spark, _emptied(spark, d), "c", "r")
    return listing.minute_holes(rows, True).groupBy("stream").agg(F.count("*").alias("missing"))


@_query("read_write_tuples", _with(s.TUPLES, f"SELECT {s.KEYS}, sent, c0, c600 FROM t WHERE timeinterval >= {MID} AND timeinterval < {MID + 2 * m.DAY}"))
def _(spark, d):
    path = files.scratch(spark)
    files.write_tuples(v.tuples(spark, d), path)
    return files.read_tuples(spark, path, MID, MID + 2 * m.DAY).select(*m.KEY, "sent", "c0", "c600")


_TIMELINE = _with(_SETS, f"""SELECT a.tier, a."time", a.{{r}} all_received, b.cluster, b.{{r}} cluster_received, c.topic, c.{{r}} received, c.sent FROM gs_ a JOIN gs_ b ON b.level = 1 AND b.tier = a.tier AND b."time" = a."time"
JOIN gs_ c ON c.level = 2 AND c.tier = b.tier AND c."time" = b."time" AND c.cluster = b.cluster WHERE a.level = 0""".replace("{r}", "received").replace("gs_", f"(SELECT level, \"time\", tier, cluster, topic, sent, {s.RECEIVED} received FROM gs)"))


@_query("to_timeline_json", _TIMELINE)
def _(spark, d):
    """The documents, read again."""
    docs = files.to_timeline_json(rollup.timeline_grouping_sets(v.tuples(spark, d), m.DAY, [99.0]))
    kind = "struct<tier:string,points:array<struct<time:bigint,received:bigint,sent:bigint,clusters:array<struct<cluster:string,received:bigint,sent:bigint,topics:array<struct<topic:string,received:bigint,sent:bigint>>>>>>>"
    points = docs.select(F.from_json("json", kind).alias("j")).select("j.tier", F.explode("j.points").alias("p")).select("tier", "p.time", F.col("p.received").alias("all_received"), F.explode("p.clusters").alias("c"))
    topics = points.select("tier", "time", "all_received", "c.cluster", F.col("c.received").alias("cluster_received"), F.explode("c.topics").alias("t"))
    return topics.select("tier", "time", "all_received", "cluster", "cluster_received", "t.topic", "t.received", "t.sent")


@_query("write_timeline_json", _TIMELINE)
def _(spark, d):
    """The documents as they are written in order, read again moment by moment."""
    path = files.scratch(spark)
    files.write_timeline_json(rollup.timeline_grouping_sets(v.tuples(spark, d), m.DAY, [99.0]), path)
    kind = "struct<time:bigint,received:bigint,sent:bigint,clusters:array<struct<cluster:string,received:bigint,sent:bigint,topics:array<struct<topic:string,received:bigint,sent:bigint>>>>>"
    points = files.read_timeline_points(spark, path).select("tier", F.from_json("point", kind).alias("p")).select("tier", "p.time", F.col("p.received").alias("all_received"), F.explode("p.clusters").alias("c"))
    topics = points.select("tier", "time", "all_received", "c.cluster", F.col("c.received").alias("cluster_received"), F.explode("c.topics").alias("t"))
    return topics.select("tier", "time", "all_received", "cluster", "cluster_received", "t.topic", "t.received", "t.sent")


@_query("to_topology_json", _with(s.TOPICS, f"""SELECT a."name", a.cluster, a.tier, a.received all_received, p99, topic, b.received, b.sent
FROM (SELECT "name", cluster, tier, received, {s.percentile_sql([99.0])} FROM (SELECT "name", cluster, tier, sum(received)::BIGINT received, {", ".join(f"sum({b})::BIGINT {b}" for b in m.BUCKETS)} FROM tc GROUP BY "name", cluster, tier)) a
JOIN (SELECT "name", cluster, tier, topic, sum(received)::BIGINT received, sum(sent)::BIGINT sent FROM tc GROUP BY "name", cluster, tier, topic) b ON b."name" = a."name" AND b.cluster = a.cluster AND b.tier = a.tier"""))
def _(spark, d):
    """The documents, read again."""
    docs = files.to_topology_json(topology.topology_nodes(v.tuples(spark, d), [99.0]))
    kind = "struct<name:string,cluster:string,tier:string,received:bigint,p99:int,stats:array<struct<topic:string,received:bigint,sent:bigint>>>"
    rows = docs.select(F.from_json("json", kind).alias("j")).select("j.name", "j.cluster", "j.tier", F.col("j.received").alias("all_received"), "j.p99", F.explode("j.stats").alias("t"))
    return rows.select("name", "cluster", "tier", "all_received", "p99", "t.topic", "t.received", "t.sent")


def _packet_stream(spark, d, path, where="true", files_=4, at_once=4):
    """Packets that pass, as a stream of some files."""
    packets = v.packets(spark, d).where(where)
    packets.repartition(files_).write.parquet(path)
    return spark.readStream.schema(packets.schema).option("maxFilesPerTrigger", at_once).parquet(path)


@_query("stream_feed", _with(_BUILT, f"SELECT * FROM bt WHERE timeinterval >= {START}"))
def _(spark, d):
    base = files.scratch(spark)
    feed.stream_feed(_packet_stream(spark, d, f"{base}/packets"), f"{base}/table", f"{base}/checkpoint", START).awaitTermination()
    return facts.snapshot(spark, f"{base}/table")


@_query("stream_feed_clusters", _with(_BUILT, "SELECT * FROM bt"))
def _(spark, d):
    """A feed for each cluster, in turns, into one table."""
    base = files.scratch(spark)
    for part in (0, 1):
        for k in (0, 1):
            source = _packet_stream(spark, d, f"{base}/packets{k}/{part}", f"cluster = 'cluster{k}' and event_id % 2 = {part}", 2, 1)
            whole = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{base}/packets{k}")
            feed.stream_feed(whole, f"{base}/table", f"{base}/checkpoint{k}", parts=3).awaitTermination()
    return facts.snapshot(spark, f"{base}/table")


@_query("stream_late_data", _with(_BUILT, f"SELECT count(*) n, sum(sent)::BIGINT sent, sum({s.RECEIVED})::BIGINT received FROM bt WHERE timeinterval < {MID}"))
def _(spark, d):
    base = files.scratch(spark)  # one batch: a key that two batches hold late counts in each
    feed.stream_feed(_packet_stream(spark, d, f"{base}/packets"), f"{base}/table", f"{base}/checkpoint", MID).awaitTermination()
    return feed.late_tuples(spark, f"{base}/table")


def _rolled_between(spark, d):
    """Packets of even events are fed, the days up to MID are rolled up to hours, and then those of odd events come."""
    base = files.scratch(spark)
    for part in (0, 1):
        _packet_stream(spark, d, f"{base}/packets/{part}", f"event_id % 2 = {part}")
        whole = spark.readStream.schema(v.packets(spark, d).schema).option("recursiveFileLookup", True).parquet(f"{base}/packets")
        feed.stream_feed(whole, f"{base}/table", f"{base}/checkpoint").awaitTermination()
        if not part:
            facts.roll(spark, f"{base}/table", list(range(START, MID, m.DAY)))
    return f"{base}/table"


_HALVES = f"""{_BUILT}, halves AS (SELECT event_id % 2 half, {s.KEYS}, sum(sent)::BIGINT sent, {", ".join(f"sum(CASE WHEN b = {e} AND lat >= 0 THEN received ELSE 0 END)::BIGINT c{e}" for e in m.EDGES)}
  FROM (SELECT *, CASE WHEN lat < 0 OR lat >= 36000000 THEN 600 {" ".join(f"WHEN lat >= {e} * 60000 THEN {e}" for e in reversed(m.EDGES[:-1]))} END b FROM lat) GROUP BY ALL)"""


@_query("stream_late_moving", _with(_HALVES, f"SELECT count(*) n, sum(sent)::BIGINT sent, sum({s.RECEIVED})::BIGINT received FROM halves WHERE half = 1 AND timeinterval < {MID}"))
def _(spark, d):
    """What comes after its day was rolled up is too late for a feed that is running."""
    return feed.late_tuples(spark, _rolled_between(spark, d))


@_query("rollup_swap_table", _with(_HALVES, f"""SELECT CASE WHEN timeinterval >= {START} AND timeinterval < {MID} THEN timeinterval - timeinterval % 3600000 ELSE timeinterval END AS timeinterval, hostname, tier, topic, cluster, {s.SUM_MEASURES}
FROM halves WHERE half = 0 OR timeinterval >= {MID} GROUP BY 1, 2, 3, 4, 5"""))
def _(spark, d):
    """Days of a table swapped for their hours, while a feed goes on."""
    return facts.snapshot(spark, _rolled_between(spark, d))


@_query("rollup_daily_mixed", _with(s.TUPLES, f"""SELECT CASE WHEN timeinterval < {START + 20 * m.DAY} THEN timeinterval - timeinterval % 86400000 WHEN timeinterval < {START + 25 * m.DAY} THEN timeinterval - timeinterval % 3600000 ELSE timeinterval END AS timeinterval, hostname, tier, topic, cluster, {s.SUM_MEASURES}
FROM t GROUP BY 1, 2, 3, 4, 5"""))
def _(spark, d):
    """A table of days, hours and minutes: some days are rolled up to hours, and of these and finer ones some to days, each once."""
    table = files.scratch(spark)
    facts.append(v.tuples(spark, d), table, "all", 0)
    facts.roll(spark, table, [START + k * m.DAY for k in range(0, 25) if k % 3 or k >= 20])
    facts.roll(spark, table, [START + k * m.DAY for k in range(0, 20)], m.DAY)
    facts.roll(spark, table, [START + k * m.DAY for k in range(0, 20)])  # these are refused
    return facts.snapshot(spark, table)


@_query("rollup_day_source", _with(f"{_DAYS}, {s.TUPLES.removeprefix(s.EVENTS + ', ')}", f"""SELECT ti AS timeinterval, hostname, tier, topic, cluster, {s.SUM_MEASURES} FROM (SELECT *, CASE WHEN timeinterval - timeinterval % 86400000 IN (SELECT day FROM ro)
THEN timeinterval - timeinterval % 3600000 ELSE timeinterval END ti FROM t WHERE timeinterval < {START + 14 * m.DAY}) GROUP BY ti, hostname, tier, topic, cluster"""))
def _(spark, d):
    """The hours of rolled days and the minutes of others, as the daily rollup reads them."""
    tuples, (days, rolled) = v.tuples(spark, d), _days(spark, d)
    in_hours = tuples.withColumn("day", F.col("timeinterval") - F.col("timeinterval") % m.DAY).join(rolled, "day", "left_semi").drop("day")
    hours = rollup.rollup_interval(in_hours, START - START % m.DAY, END)
    return rollup.rollup_source(tuples, hours, days.where(F.col("day") < START + 14 * m.DAY))


@_query("stream_window_counts", _with(s.EVENTS, 'SELECT topic AS stream, hostname AS file, ms - ms % 60000 AS win, count(*) n FROM e GROUP BY 1, 2, 3'))
def _(spark, d):
    base = files.scratch(spark)
    lines = v.events(spark, d).select(F.col("topic").alias("stream"), F.col("hostname").alias("file"), F.timestamp_millis("ms").alias("publish_time"))
    lines.write.parquet(f"{base}/lines")
    source = spark.readStream.schema(lines.schema).parquet(f"{base}/lines")
    feed.stream_window_table(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return feed.read_window_table(spark, f"{base}/out").withColumnRenamed("window", "win")


def _ingested(spark, d):
    """Events as lines, through the ingest with its counters; its hook appends a digit to each line."""
    base = files.scratch(spark)
    lines = v.events(spark, d).select(
        F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), F.concat("hostname", F.lit(".gz")).alias("file"), F.col("ms").alias("publish_ms"), (F.col("ms") - F.col("ms") % m.DAY).alias("commit_ms")
    )
    lines.repartition(6).write.parquet(f"{base}/lines")
    source = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/lines")
    feed.stream_local_ingest(source, f"{base}/out", f"{base}/checkpoint", lambda x: x.withColumn("value", F.concat("value", F.lit("7"))), counters=f"{base}/counters").awaitTermination()
    return base


@_query("stream_local_ingest", _with(s.EVENTS, 'SELECT topic AS stream, ms - ms % 86400000 AS "minute", count(*) n, sum(event_id * 10 + 7)::BIGINT total FROM e GROUP BY 1, 2'))
def _(spark, d):
    rows = files.read_lines(spark, f"{_ingested(spark, d)}/out").withColumn("minute", m.path_to_minute(F.regexp_replace("path", "(year|month|day|hour|minute)=", "")))
    return rows.groupBy("stream", "minute").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


@_query("stream_local_counters", _with(s.EVENTS, "SELECT topic AS stream, hostname || '.gz' AS file, count(DISTINCT ms - ms % 60000) AS minutes, count(*) n FROM e GROUP BY 1, 2"))
def _(spark, d):
    """The ingest's counters as counters_to_audit gets them; what two batches count for one window adds up."""
    lines = spark.read.text(f"{_ingested(spark, d)}/counters/batch=*")
    counted = audit.parse_counters(lines.select("value", F.regexp_extract(F.col("_metadata.file_path"), "/batch=([0-9]+)/", 1).alias("batch")), by=["batch"]).groupBy("stream", "file", "window").agg(F.sum("n").alias("n"))
    return counted.groupBy("stream", "file").agg(F.count("*").alias("minutes"), F.sum("n").alias("n"))


def _picked(spark, d):
    """What the collectors' state takes and trashes: first all files up to a time, as far as those collectors are known then; after that a batch."""
    base = files.scratch(spark)
    f = _collector_files(spark, d).drop("event_id")
    early = (F.col("mtime") < MID) & (F.col("collector") != "cluster0-host0")
    for part, (rows, most, timeout) in enumerate(((f.where(early), 1 << 40, -(1 << 50)), (f.where(~early), movement.BATCH_FILES, m.HOUR))):
        rows.coalesce(1).write.mode("append").parquet(f"{base}/events")
        events = spark.readStream.schema(rows.schema).parquet(f"{base}/events")
        picked = collectors.pick_files(events, most=most, timeout=timeout, now=NOW)
        writer = picked.writeStream.outputMode("append").foreachBatch(lambda batch, k, part=part: batch.write.mode("overwrite").parquet(f"{base}/out/part={part}/batch={k}"))
        writer.option("checkpointLocation", f"{base}/checkpoint").trigger(once=True).start().awaitTermination()
    return spark.read.schema(collectors.PICKED).option("recursiveFileLookup", True).parquet(f"{base}/out/part=0"), spark.read.schema(collectors.PICKED).option("recursiveFileLookup", True).parquet(f"{base}/out/part=1")


@_query("stream_collector_batch", _with(_BATCH, 'SELECT stream, collector, "name", path, length FROM bat'))
def _(spark, d):
    return _picked(spark, d)[1].where("action = 'take'").select("stream", "collector", "name", "path", "length")


@_query("stream_collector_trash", _with(f"""{_CF}, {_CP}, ag AS (SELECT *, row_number() OVER (PARTITION BY stream, collector ORDER BY mtime DESC, "name" DESC) age, mtime < {MID} AND collector <> 'cluster0-host0' early FROM lf),
sc AS (SELECT ag.*, coalesce(sum(CASE WHEN length > 0 AND (checkpoint IS NULL OR "name" > checkpoint) THEN 1 ELSE 0 END) OVER (PARTITION BY stream, collector ORDER BY mtime, "name" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) before
  FROM ag LEFT JOIN cps USING (stream, collector) WHERE NOT early AND (age > 1 OR mtime < {NOW - m.HOUR})),
ps AS (SELECT stream, collector, "name" FROM ag WHERE early UNION ALL SELECT stream, collector, "name" FROM sc WHERE before < 10)""", 'SELECT stream, collector, "name" FROM ps QUALIFY row_number() OVER (PARTITION BY stream, collector ORDER BY "name" DESC) > 6'))
def _(spark, d):
    one, two = _picked(spark, d)
    return one.unionByName(two).where("action = 'trash'").select("stream", "collector", "name")


def _collected(spark, d):
    """Events as lines of collectors' files, in the order of their ids; all of them are taken, in two triggers."""
    base = files.scratch(spark)
    e = v.events(spark, d)
    name = F.concat("topic", F.lit("-"), m.minute_text(F.col("ms") - F.col("ms") % m.DAY, "yyyy-MM-dd-HH-mm"), F.lit("_0001"))
    lines = e.select(F.concat_ws("/", "topic", F.concat("cluster", F.lit("-"), "hostname"), F.concat(name, F.lit(".gz"))).alias("target"), F.concat_ws(" ", "ms", "event_id").alias("value"), "ms", "event_id")
    for part in (0, 1):
        half = lines.where((F.col("ms") < MID) if part == 0 else (F.col("ms") >= MID))
        half.repartition("target").sortWithinPartitions("target", "event_id").select("target", "value").write.format("named_lines").mode("append").option("path", f"{base}/raw").save()
        collectors.stream_collect(
            collectors.collector_events(spark, f"{base}/raw"), f"{base}/out", f"{base}/counters", f"{base}/trash", f"{base}/checkpoint", publish_time=F.element_at(F.split("value", " "), 1).cast("long"),
            commit_minute=lambda part=part: MID + part * m.MINUTE + 5, trigger={"once": True}, most=1 << 40, timeout=-(1 << 50), now=NOW,
        ).awaitTermination()
    return base


_COLLECTED = f"""{s.EVENTS}, cl AS (SELECT *, cluster || '-' || hostname || '-' || topic || '-' || strftime(make_timestamp((ms - ms % 86400000) * 1000), '%Y-%m-%d-%H-%M') || '_0001.gz' AS "name", CASE WHEN ms < {MID} THEN {MID} ELSE {MID + m.MINUTE} END AS "minute" FROM e)"""


@_query("stream_collect", _with(_COLLECTED, """SELECT topic AS stream, "minute", "name", count(*) n, min(event_id) AS "first", sum(event_id)::BIGINT total FROM cl GROUP BY 1, 2, 3"""))
def _(spark, d):
    """Lines by the names of their files and the minute in which they were committed."""
    base = _collected(files.registered(spark), d)
    rows = files.read_lines(spark, f"{base}/out").withColumn("id", F.element_at(F.split("value", " "), 2).cast("long"))
    by = [F.element_at(F.split("path", "/"), -7).alias("stream"), m.path_to_minute(F.col("path")).alias("minute"), F.col("file").alias("name")]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("id").alias("first"), F.sum("id").alias("total"))


@_query("stream_collect_counters", _with(_COLLECTED, """SELECT topic AS stream, "name" AS file, ms - ms % 60000 AS win, count(*) n FROM cl GROUP BY 1, 2, 3"""))
def _(spark, d):
    base = _collected(files.registered(spark), d)
    return audit.parse_counters(spark.read.text(f"{base}/counters/batch=*")).withColumnRenamed("window", "win")


@_query("stream_merge_lines", _with(s.EVENTS, f'SELECT topic AS stream, {MID}::BIGINT AS "minute", count(*) n, sum(event_id)::BIGINT total FROM e GROUP BY topic'))
def _(spark, d):
    base = files.scratch(spark)
    lines = v.events(spark, d).select(F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), "cluster")
    lines.write.partitionBy("cluster").parquet(f"{base}/roots")
    roots = [spark.readStream.schema("value string, stream string").parquet(f"{base}/roots/cluster=cluster{k}") for k in (0, 1)]
    feed.stream_merge_lines(roots, f"{base}/out", f"{base}/checkpoint", lambda: MID + 7).awaitTermination()
    rows = files.read_lines(spark, f"{base}/out").withColumn("minute", m.path_to_minute(F.regexp_replace("path", "(year|month|day|hour|minute)=", "")))
    return rows.groupBy("stream", "minute").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


@_query("stream_mirror_lines", _with(s.EVENTS, 'SELECT topic AS stream, ms - ms % 86400000 AS "minute", count(*) n, sum(event_id)::BIGINT total FROM e GROUP BY 1, 2'))
def _(spark, d):
    base = files.scratch(spark)
    lines = v.events(spark, d)
    files.write_minute_partitions(lines.select(F.col("event_id").cast("string").alias("value"), F.col("topic").alias("stream"), (F.col("ms") - F.col("ms") % m.DAY).alias("at")), f"{base}/root", F.col("at"))
    source = spark.readStream.format("text").schema("value string").option("recursiveFileLookup", True).load(f"{base}/root").select("value", F.col("_metadata.file_path").alias("path"))
    feed.stream_mirror_lines(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    rows = files.read_lines(spark, f"{base}/out").withColumn("minute", m.path_to_minute(F.regexp_replace("path", "(year|month|day|hour|minute)=", "")))
    return rows.groupBy("stream", "minute").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


def _named_minutes(spark, d, path, at, where="true"):
    """Events as lines of files with names, in 45 minutes from MID on, of which those of %11 = 9 have an empty folder, and the 40th is a gap."""
    k = F.col("event_id") % 45
    e = v.events(spark, d).where(where).withColumn("at", F.lit(MID) + k * m.MINUTE).where((k != 40) if at == 0 else (k == 40))
    name = F.concat("cluster", F.lit("-"), "topic", F.lit("-"), m.minute_text(F.col("at"), "yyyy-MM-dd-HH-mm"), F.lit("_"), (F.col("event_id") % 2).cast("string"), F.lit(".gz"))
    folder = F.concat_ws("/", "topic", m.minute_text(F.col("at")))
    spark = files.registered(spark)
    lines = e.where(k % 11 != 9).select(F.concat_ws("/", folder, name).alias("target"), F.col("event_id").cast("string").alias("value"))
    lines.repartition("target").sortWithinPartitions("target", "value").write.format("named_lines").mode("append").option("path", path).save()
    empty = e.where(k % 11 == 9).select(F.lit("").alias("path"), folder.alias("target"), F.lit(True).alias("is_dir")).distinct()
    empty.write.format("file_copies").mode("append").option("path", path).save()


def _named_sql(select, by):
    """Taken are the minutes of each stream (and root) before which there is no gap and after which there is one more; turn counts them."""
    at = """strftime(make_timestamp("at" * 1000), '%Y"""
    ctes = f"""{s.EVENTS}, kk AS (SELECT event_id, topic, cluster, {MID} + event_id % 45 * 60000 AS "at", event_id % 45 kth FROM e), mn AS (SELECT DISTINCT {by}, "at" FROM kk),
turns AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY "at") turn, min("at") OVER (PARTITION BY {by}) "first", lead("at") OVER (PARTITION BY {by} ORDER BY "at") nx FROM mn),
taken AS (SELECT * FROM turns WHERE "at" = "first" + (turn - 1) * 60000 AND nx = "at" + 60000),
nf AS (SELECT DISTINCT topic, cluster, "at", kth, topic || '/' || {at}/%m/%d/%H/%M') folder, cluster || '-' || topic || '-' || {at}-%m-%d-%H-%M') || '_' || event_id % 2 || '.gz' "name" FROM kk)"""
    return _with(ctes, select)


@_query("stream_mirror", _named_sql("""SELECT DISTINCT CASE WHEN kth % 11 = 9 THEN folder ELSE folder || '/' || "name" END below, kth % 11 = 9 is_dir FROM nf JOIN taken USING (topic, "at")""", "topic"))
def _(spark, d):
    """Files by their paths, and empty minutes; the mirror stops at the gap, and goes on when it is filled."""
    base = files.scratch(spark)
    for at in (0, 0, 1):
        if not facts.Folder(spark, f"{base}/root").names() or at:
            _named_minutes(spark, d, f"{base}/root", at)
        feed.stream_mirror(spark, f"{base}/root", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return files.read_listing(spark, f"{base}/out", "c", "r").select(F.regexp_extract("path", "/out/(.*)$", 1).alias("below"), "is_dir")


@_query("stream_merge", _named_sql(f"""SELECT topic AS stream, "name", {MID + m.DAY} + (turn - 1) // 31 * 60000 AS "minute" FROM nf JOIN taken USING (cluster, topic, "at") WHERE kth % 11 <> 9""", "cluster, topic"))
def _(spark, d):
    """Files of two roots by their names, in the commit minute of the batch that took them: 31 minutes of each stream at a time."""
    base, turn = files.scratch(spark), []
    for k in (0, 1):
        for at in (0, 1):
            _named_minutes(spark, d, f"{base}/root{k}", at, f"cluster = 'cluster{k}'")
    for _ in range(2):
        turn.append(MID + m.DAY + len(turn) * m.MINUTE)
        feed.stream_merge(spark, [f"{base}/root0", f"{base}/root1"], f"{base}/out", f"{base}/checkpoint", lambda: turn[-1] + 7).awaitTermination()
    return files.read_listing(spark, f"{base}/out", "c", "r").select("stream", "name", "minute")


@_query("sliding_metric_sum", _with(s.EVENTS, "SELECT hostname AS service, 'm' AS metric, topic AS stream, st AS start, sum(n)::BIGINT total FROM (SELECT *, unnest(range(ms - ms % 1800000 - 1800000, ms - ms % 1800000 + 1, 1800000)) st FROM e) GROUP BY 1, 3, 4"))
def _(spark, d):
    e = v.events(spark, d).select(F.col("hostname").alias("service"), F.lit("m").alias("metric"), F.col("topic").alias("stream"), F.timestamp_millis("ms").alias("ts"), F.col("n").alias("value"))
    return feed.sliding_metric_sum(e, 3600, 1800).withColumn("start", F.unix_millis("start"))


_SLIDING = _with(s.EVENTS, """SELECT service, metric, stream, "second", sum(v) OVER (PARTITION BY service, metric, stream ORDER BY "second" RANGE BETWEEN 7199 PRECEDING AND CURRENT ROW)::BIGINT total
FROM (SELECT hostname AS service, 'm' AS metric, topic AS stream, ms // 1000 AS "second", sum(n) v FROM e GROUP BY 1, 2, 3, 4)""")


def _metrics(spark, d):
    return v.events(spark, d).select(F.col("hostname").alias("service"), F.lit("m").alias("metric"), F.col("topic").alias("stream"), F.timestamp_millis("ms").alias("ts"), F.col("n").alias("value"))


@_query("sliding_sums", _SLIDING)
def _(spark, d):
    """Of each second with values what the last two hours add up to."""
    return sliding.sliding_sums(_metrics(spark, d), 7200)


@_query("stream_sliding_sums", _SLIDING)
def _(spark, d):
    """The same as a stream that gets ten days at a time."""
    base, metrics = files.scratch(spark), _metrics(spark, d)
    for k in range(3):
        inside = (F.unix_millis("ts") >= START + k * 10 * m.DAY) & (F.unix_millis("ts") < START + (k + 1) * 10 * m.DAY) if k < 2 else F.unix_millis("ts") >= START + 20 * m.DAY
        metrics.where(inside).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(metrics.schema).parquet(f"{base}/in")
        totals = sliding.stream_sliding_sums(source, 7200)
        writer = totals.writeStream.outputMode("update").foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}"))
        writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("service string, metric string, stream string, second bigint, total double, batch int").parquet(f"{base}/out")
    return rows.groupBy("service", "metric", "stream", "second").agg(F.max_by("total", "batch").cast("long").alias("total"))
