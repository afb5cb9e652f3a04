"""The derived tables of plans.views as SQL common table expressions, for the queries' SQL."""

from __future__ import annotations

from hoptally.functions.model import BUCKETS, EDGES, MEASURES, TIERS

_TIERS = "[" + ", ".join(f"'{t}'" for t in TIERS) + "]"
_BUCKET = "CASE " + " ".join(f"WHEN latency_min >= {e} THEN {e}" for e in reversed(EDGES)) + " END"
_SUMS = "sum(sent)::BIGINT sent, " + ", ".join(f"sum(CASE WHEN b = {e} THEN n ELSE 0 END)::BIGINT c{e}" for e in EDGES)
KEYS = "timeinterval, hostname, tier, topic, cluster"
SUM_MEASURES = ", ".join(f"sum({m})::BIGINT {m}" for m in MEASURES)
RECEIVED = "(" + " + ".join(BUCKETS) + ")"

EVENTS = """e AS (SELECT event_id, epoch_us(ts) // 1000 ms, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) k, event_type topic,
  'cluster' || (user_id % 2) cluster, 'host' || ((user_id // 2) % 3) hostname, CAST(floor(value) AS BIGINT) + 1 n, value, ts FROM events)"""
SOURCE = f"""{EVENTS}, src AS (SELECT event_id, ms - ms % 60000 timeinterval, hostname, {_TIERS}[r + 1] tier, topic, cluster, n,
  (((k * k) // 12) * (r + 1)) // 7 latency_min, CASE WHEN r IN (1, 2) THEN n ELSE 0 END sent
  FROM e, range(7) x(r) WHERE (event_id * 7 + r) % 101 >= r)"""
TUPLES = f"{SOURCE}, t AS (SELECT {KEYS}, {_SUMS} FROM (SELECT *, {_BUCKET} b FROM src) GROUP BY {KEYS})"
DAY_TUPLES = f"{SOURCE}, d AS (SELECT timeinterval - timeinterval % 86400000 timeinterval, hostname, tier, topic, cluster, {_SUMS} FROM (SELECT *, {_BUCKET} b FROM src) GROUP BY timeinterval - timeinterval % 86400000, hostname, tier, topic, cluster)"
PACKETS = f"""{EVENTS}, p AS (SELECT event_id, ms AS "timestamp", {_TIERS}[event_id % 3 + 1] tier, topic, hostname, cluster, n,
  ms - ms % 60000 - (k % 6) * 60000 k1, ms - ms % 60000 - (k % 4) * 60000 k2 FROM e),
pe AS (SELECT *, true got, k1 AS "key", n v FROM p UNION ALL SELECT *, true, k2, n // 3 FROM p WHERE k1 <> k2
  UNION ALL SELECT *, false, k1, n // 2 FROM p UNION ALL SELECT *, false, k2, n // 3 FROM p WHERE k1 <> k2)"""
ALIGNED = f"""{PACKETS}, cut AS (SELECT *, "timestamp" - "timestamp" % 60000 lo, "key" + 60000 < "timestamp" old FROM pe),
ups AS (SELECT *, CASE WHEN old THEN CAST(trunc(CAST(CAST("timestamp" - lo AS REAL) / CAST(60000 AS REAL) AS REAL) * CAST(v AS REAL)) AS BIGINT) ELSE v END up FROM cut),
al AS (SELECT event_id, "timestamp", tier, topic, hostname, cluster, lo message_time, "key" AS win, CASE WHEN got THEN v - up ELSE 0 END received, CASE WHEN got THEN 0 ELSE v - up END sent FROM ups WHERE old
  UNION ALL SELECT event_id, "timestamp", tier, topic, hostname, cluster, lo + 60000, "key", CASE WHEN got THEN up ELSE 0 END, CASE WHEN got THEN 0 ELSE up END FROM ups)"""


def _files(root: str, minute: str, where: str, prefix: str = "") -> str:
    name = f"'{prefix}' || cluster || '-' || topic || '-' || strftime(make_timestamp((ms - ms % 60000) * 1000), '%Y-%m-%d-%H-%M') || '_' || event_id || '.gz'"
    return f"""SELECT cluster, '{root}' root, topic stream, {minute} AS "minute", {name} AS "name", '{root}/' || topic || '/' || strftime(make_timestamp(({minute}) * 1000), '%Y/%m/%d/%H/%M') || '/' || {name} AS path,
    CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS length, ms + event_id % 5 * 90000 mtime, event_id FROM e WHERE {where}"""


_M, _M1 = "ms - ms % 60000", "ms - ms % 60000 + 60000"
LISTINGS = f"""{EVENTS}, ll AS ({_files("local", _M, "true")}),
lm AS ({_files("merge", _M, "event_id % 50 <> 7")} UNION ALL {_files("merge", _M1, "event_id % 97 = 3")}),
lr AS ({_files("mirror", _M, "event_id % 50 <> 7 AND event_id % 40 <> 9")} UNION ALL {_files("mirror", _M1, "event_id % 97 = 3 AND event_id % 40 <> 9")} UNION ALL {_files("mirror", _M, "event_id % 89 = 5", "extra-")})"""
CONFIG = """ss(stream, cluster, retention_h, enabled) AS (VALUES ('click', 'cluster0', 24, true), ('click', 'cluster1', 24, true), ('view', 'cluster0', 24, true), ('view', 'cluster1', 48, true), ('purchase', 'cluster0', 24, true), ('signup', 'cluster1', 24, true), ('error', 'cluster1', 12, false)),
sd(stream, cluster, is_primary, retention_h) AS (VALUES ('click', 'cluster0', true, 72), ('view', 'cluster1', true, 72), ('purchase', 'cluster1', true, 48), ('signup', 'cluster0', true, 48), ('click', 'cluster1', false, 36), ('view', 'cluster0', false, 36))"""
_NODE = "CASE WHEN tier IN ('PUBLISHER', 'AGENT', 'COLLECTOR') THEN hostname ELSE cluster END"
TOPICS = f"""{TUPLES}, tc AS (SELECT {_NODE} AS "name", cluster, tier, topic, hostname, sum(sent)::BIGINT sent, {", ".join(f"sum({b})::BIGINT {b}" for b in BUCKETS)}, sum({RECEIVED})::BIGINT received
  FROM t GROUP BY {_NODE}, cluster, tier, topic, hostname)"""
SOURCES = """sc AS (SELECT DISTINCT 'MERGE' tier, d.cluster, s.cluster source FROM sd d JOIN ss s USING (stream) WHERE d.is_primary AND s.enabled
  UNION SELECT DISTINCT 'MIRROR', d.cluster, q.cluster FROM sd d JOIN sd q USING (stream) WHERE NOT d.is_primary AND q.is_primary),
tsrc AS (SELECT DISTINCT o.tier, o.cluster, o.topic, sc.source FROM (SELECT CASE WHEN is_primary THEN 'MERGE' ELSE 'MIRROR' END tier, cluster, stream topic FROM sd) o JOIN sc USING (tier, cluster))"""
NODES = f"""{TOPICS}, {CONFIG}, {SOURCES}, nd AS (SELECT "name", cluster, tier, topic, hostname, received, sent FROM tc
  UNION ALL SELECT 'VIP', cluster, 'VIP', topic, NULL, sum(received)::BIGINT, sum(sent)::BIGINT FROM tc WHERE tier = 'COLLECTOR' GROUP BY cluster, topic),
nn AS (SELECT "name", cluster, tier, sum(received)::BIGINT received, sum(sent)::BIGINT sent FROM nd GROUP BY "name", cluster, tier),
chain(parent_tier, child_tier, how) AS (VALUES ('AGENT', 'PUBLISHER', 'host'), ('VIP', 'AGENT', 'cluster'), ('COLLECTOR', 'VIP', 'cluster'), ('HDFS', 'COLLECTOR', 'cluster'), ('LOCAL', 'HDFS', 'cluster'), ('MERGE', 'LOCAL', 'source'), ('MIRROR', 'MERGE', 'source')),
links AS (SELECT a."name" parent_name, a.cluster parent_cluster, a.tier parent_tier, b."name" child_name, b.cluster child_cluster, b.tier child_tier
  FROM nn a JOIN chain c ON c.parent_tier = a.tier JOIN nn b ON b.tier = c.child_tier
  WHERE (c.how <> 'source' AND a.cluster = b.cluster AND (c.how <> 'host' OR a."name" = b."name"))
    OR (c.how = 'source' AND EXISTS (SELECT 1 FROM sc WHERE sc.tier = a.tier AND sc.cluster = a.cluster AND sc.source = b.cluster)))"""


def percentile_sql(percentiles: list[float]) -> str:
    """Columns like functions.model.percentile_columns."""
    out = []
    for p in percentiles:
        total = f"CAST({RECEIVED} - c600 AS REAL)"
        limit = f"CAST(CAST(CAST({p} AS REAL) * {total} AS REAL) / CAST(100 AS REAL) AS REAL)"
        whens = [f"WHEN {total} = 0 THEN 0"] + [f"WHEN CAST({' + '.join(BUCKETS[: k + 1])} AS REAL) >= {limit} THEN {e}" for k, e in enumerate(EDGES[:-1])]
        out.append(f"CASE {' '.join(whens)} END {f'p{p:g}'.replace('.', '_')}")
    return ", ".join(out)


def loss(up: str, down: str, percent: int) -> str:
    return f"{up} < {down} - ({percent} * {down})::BIGINT / 100"
