"""Numbers of the fixtures."""

import pytest
from pyspark.sql import functions as F

from hoptally.functions import model as m
from hoptally.operators import audit, rollup, topology

MIN = 60_000
SCHEMA = "timeinterval long, hostname string, tier string, topic string, cluster string, sent long, " + ", ".join(f"{b} long" for b in m.BUCKETS)


def tuples(spark, *rows):
    full = [(r[0], r[1], r[2], r[3], r[4], r[5], *(r[6].get(e) for e in m.EDGES)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def stored(spark):
    return tuples(spark, (0, "testhost1", "AGENT", "testTopic", "testCluster", 2000, {0: 1500, 1: 500}), (0, "testhost1", "AGENT", "testTopic1", "testCluster", 1000, {600: 1000}), (0, "testhost2", "AGENT", "testTopic", "testCluster", 2000, {0: 1500, 1: 500}))


def all_rows(spark):
    return audit.upsert_counters(stored(spark), tuples(spark, (0, "testhost1", "AGENT", "testTopic", "testCluster", 2500, {1: 1000, 2: 1000, 3: 500})))


def test_groups(spark):
    rows = {r["hostname"]: r for r in audit.audit_query(all_rows(spark), group_by="HOSTNAME,CLUSTER,TIER").collect()}
    assert [(r["received"], r["sent"], r["lost"]) for r in (rows["testhost1"], rows["testhost2"])] == [(5500, 5500, 1000), (2000, 2000, 0)]
    assert audit.audit_query(all_rows(spark), group_by="hostname,cluster,tier,topic").count() == 3


@pytest.mark.parametrize(("text", "n"), [("HOSTNAME=testhost1", 2), ("HOSTNAME=testhost1,TOPIC=testTopic1", 1), ("TOPIC=testTopic", 2), ("TIER=AGENT", 3), ("HOSTNAME=testhost1|testhost2", 3), ("HOSTNAME=testhost1|testhost2,TOPIC=testTopic", 2), (None, 3), ("nonsense", 3), ("topic='testTopic'", 2)])
def test_filters(spark, text, n):
    assert audit.audit_query(all_rows(spark), filter=text, group_by="hostname,topic").count() == n


def test_percentiles(spark):
    rows = {r["hostname"]: r for r in audit.audit_query(all_rows(spark), group_by="hostname", percentiles="80,90,95,99,99.9").collect()}
    names = ["p80", "p90", "p95", "p99", "p99_9"]
    assert [rows["testhost1"][x] for x in names] == [2, 3, 3, 3, 3]
    assert [rows["testhost2"][x] for x in names] == [1] * 5
    one = audit.audit_query(all_rows(spark), percentiles="70,80,90,95,99,99.9").first()
    assert [one[x] for x in ("p70", *names)] == [1, 2, 2, 3, 3, 3]


def test_group_by_errors():
    assert m.parse_group_by(None) == []
    assert m.parse_group_by("tier,topic,tier") == ["tier", "topic"]
    for bad in ("", "nothing"):
        with pytest.raises(ValueError):
            m.parse_group_by(bad)


def at(h, mi, s=0):
    return ((h * 60 + mi) * 60 + s) * 1000


def packet_rows(spark):
    rows = [(at(0, 10, 20), 60, "tier1", "topic", "host", "c", {at(0, 10): 10, at(0, 9): 15}, {at(0, 9): 12}), (at(0, 11, 20), 60, "tier2", "topic", "host", "c", {at(0, 10): 9}, {at(0, 10): 6})]
    return spark.createDataFrame(rows, "timestamp long, window_size int, tier string, topic string, hostname string, cluster string, received map<long,long>, sent map<long,long>")


def test_align(spark):
    one = packet_rows(spark).where("tier = 'tier1'")
    got = {(r["message_time"], r["window"]): (r["received"], r["sent"]) for r in audit.align_messages(one).groupBy("message_time", "window").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent")).collect()}
    assert got == {(at(0, 10), at(0, 9)): (10, 8), (at(0, 11), at(0, 9)): (5, 4), (at(0, 11), at(0, 10)): (10, 0)}
    nothing = one.withColumns({"received": F.lit(None).cast("map<long,long>"), "sent": F.lit(None).cast("map<long,long>")})
    assert audit.align_messages(nothing).count() == 0


def test_tuples(spark):
    built = audit.build_tuples(audit.align_messages(packet_rows(spark)))
    got = {(r["timeinterval"], r["tier"]): (r["received"], r["sent"], sum(r[b] > 0 for b in m.BUCKETS)) for r in built.withColumn("received", m.received()).collect()}
    assert got == {(at(0, 11), "tier1"): (10, 0, 1), (at(0, 10), "tier1"): (15, 12, 2), (at(0, 11), "tier2"): (9, 6, 2)}
    kept, late = audit.late_tuple_split(built, at(0, 11))
    assert (kept.count(), late.count()) == (2, 1)


def test_rollup(spark):
    key = ("testhost", "agent", "testtopic", "testcluster")
    rows = tuples(spark, (at(1, 5), *key, 3000, {0: 1500, 1: 1500}), (at(1, 10), *key, 3000, {2: 1500, 3: 1500}), (at(2, 10), *key, 3000, {0: 1500, 1: 1500}))
    hourly = sorted((r["timeinterval"], r["sent"]) for r in rollup.rollup_interval(rows, 0, m.DAY).collect())
    assert hourly == [(at(1, 0), 6000), (at(2, 0), 3000)]
    assert [r["sent"] for r in rollup.rollup_interval(rows, 0, m.DAY, m.DAY).collect()] == [9000]
    days = rows.sparkSession.createDataFrame([(0,)], "day long")
    once = rollup.rollup_swap(rows, days)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, rollup.rollup_swap(once, days).collect()))


@pytest.mark.parametrize(("days", "minutes"), [(2, 60), (5, 120), (12, 240), (19, 360), (26, 480), (45, 720), (61, 1440)])
def test_steps(days, minutes):
    assert rollup.timeline_bucket_size(0, days * m.DAY) == minutes


def test_vip(spark):
    rows = [(0, f"testHost{k}", "COLLECTOR", topic, "c", 2500, {0: 1000, 1: 800, 2: 700}) for k, topic in ((1, "testTopic1"), (1, "testTopic"), (2, "TESTTOPIC"))]
    assert tuple(topology.vip_nodes(tuples(spark, *rows)).first()) == ("VIP", "c", "VIP", 7500, 7500, 2)


def test_collector_percentile(spark):
    rows = [(0, "testHost1", "COLLECTOR", "testTopic", "c", 2500, {0: 1000, 1: 800, 2: 700}), (0, "testHost1", "COLLECTOR", "testTopic1", "c", 2500, {5: 1500, 10: 1000})]
    assert topology.topology_nodes(tuples(spark, *rows), [70.0]).first()["p70"] == 5


def test_empty(spark):
    none = stored(spark).limit(0)
    assert audit.audit_query(none, group_by="tier").count() == 0
    assert audit.upsert_counters(none, none).count() == 0
    assert topology.topology_nodes(none, [99.0]).count() == 0
