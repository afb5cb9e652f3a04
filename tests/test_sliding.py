import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from hoptally.functions.model import DAY
from hoptally.operators import rollup
from hoptally.plans import views
from hoptally.sources import files
from hoptally.streaming import sliding

SCHEMA = "service string, metric string, stream string, ts timestamp, value long"


def plain(rows, n):
    seconds = {}
    for *key, ts, value in rows:
        at = seconds.setdefault(tuple(key), {})
        at[ts // 1000] = at.get(ts // 1000, 0) + (value or 0)
    return {(*k, s): sum(v for t, v in at.items() if s - n < t <= s) for k, at in seconds.items() for s in at}


def made(rng, n, span):
    return sorted((("a", "m", rng.choice("xyz"), 1_700_000_000_000 + rng.randrange(span * 1000), rng.choice([1, 5, 10, None])) for _ in range(n)), key=lambda r: r[3])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "ms long")).select("service", "metric", "stream", F.timestamp_millis("ms").alias("ts"), "value")


@pytest.mark.parametrize(("n", "stretch"), [(1, 64), (30, 2), (30, 1), (1000, 64)])
def test_table(spark, monkeypatch, n, stretch):
    monkeypatch.setattr(sliding, "STRETCH", stretch)
    rows = made(random.Random(n), 600, 400)
    got = {tuple(r)[:4]: r["total"] for r in sliding.sliding_sums(frame(spark, rows), n).collect()}
    assert got == plain(rows, n)
    assert sliding.sliding_sums(frame(spark, rows).limit(0), n).count() == 0


def test_stream_is_the_table_and_its_state_stays_small(spark, tmp_path):
    """Out of order within a trigger and by a few seconds between them; what comes too late doesn't count; rings are as long as two windows and the delay."""
    rng, n = random.Random(5), 20
    rows = made(rng, 900, 3000)
    parts = [rows[k : k + 300] for k in (0, 300, 600)]
    parts[0], parts[1] = [*parts[0][:-5], *parts[1][:3]], [*parts[0][-5:], *parts[1][3:]]
    late = ("a", "m", "x", parts[0][0][3], 1000)
    seen, state = {}, []
    for k, part in enumerate(parts):
        rng.shuffle(part)
        frame(spark, [*part, late] if k == 2 else part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")

        def each(batch, _):
            seen.update({tuple(r)[:4]: r["total"] for r in batch.collect()})

        query = sliding.stream_sliding_sums(source, n, 60).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        state.append([p["stateOperators"][0] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]])
    assert seen == {k: float(x) for k, x in plain(rows, n).items()}
    assert max(s["numRowsTotal"] for some in state for s in some) <= 3
    store = spark.read.format("statestore").option("path", f"{tmp_path}/c").load().select(F.to_json("value").alias("v")).collect()
    rings = [json.loads(json.loads(r["v"])["groupState"]["ring"]) for r in store if "groupState" in json.loads(r["v"])]
    assert rings and all(len(x) <= 2 * n + 60 for x in rings)


def ran(spark, path, rows, n, delay):
    """What a trigger that gets the rows gives."""
    rows.write.mode("append").parquet(f"{path}/in")
    out = []
    totals = sliding.stream_sliding_sums(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), n, delay)
    writer = totals.writeStream.outputMode("update").foreachBatch(lambda batch, _: out.append(batch.groupBy().agg(F.count("*").alias("rows"), F.sum("second").alias("seconds"), F.sum("total").alias("total"), F.collect_set(F.when(F.col("second") < 1500, F.col("second") - 1000)).alias("few")).first()))
    query = writer.option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
    done = query.awaitTermination(100)
    query.stop()
    assert done
    return out[0]


def test_a_trigger_of_many_seconds(spark, tmp_path):
    """Takes time in proportion to them, not to their square."""
    many, n = 200_000, 20
    rows = spark.range(many).selectExpr("'a' service", "'m' metric", "'x' stream", "timestamp_millis(id * 1000 + 1000000) ts", "1L value")
    got = ran(spark, tmp_path, rows, n, 10)
    assert got["rows"] == many
    assert got["seconds"] == many * (many - 1) // 2 + 1000 * many
    assert got["total"] == n * many - n * (n - 1) // 2


def test_a_trigger_gives_what_has_changed(spark, tmp_path):
    """However many seconds have new values."""
    rows = lambda *seconds: spark.createDataFrame([("a", "m", "x", (1000 + s) * 1000, 1) for s in seconds], SCHEMA.replace("ts timestamp", "ms long")).select("service", "metric", "stream", F.timestamp_millis("ms").alias("ts"), "value")
    assert sorted(ran(spark, tmp_path, rows(0, 99), 20, 60)["few"]) == [0, 99]
    touched = [*range(41, 80), *range(200, 240)]
    got = ran(spark, tmp_path, rows(*touched), 20, 60)
    assert sorted(got["few"]) == touched  # not 99, whose window begins at 80
    assert got["total"] == 2 * sum(min(k + 1, 20) for k in range(39)) + 20


def test_timeline_documents_in_parts(spark, tmp_path):
    """The parts one after the other are the documents that to_timeline_json makes, also of odd names."""
    tuples = views.tuples(spark, "/root/testdata/sf0.001").withColumn("topic", F.concat("topic", F.lit('",]}:{"time":')))
    series = rollup.timeline_grouping_sets(tuples, DAY // 4, [99.0])
    files.write_timeline_json(series, f"{tmp_path}/o")
    want = {r["tier"]: json.loads(r["json"]) for r in files.to_timeline_json(series).collect()}
    got = {}
    for tier in want:
        parts = sorted(glob.glob(f"{tmp_path}/o/tier={tier}/part-*"))
        got[tier] = json.loads("".join(open(p).read() for p in parts))  # noqa: SIM115
    assert got == want
    points = files.read_timeline_points(spark, f"{tmp_path}/o").collect()
    assert sorted((r["tier"], json.loads(r["point"])["time"]) for r in points) == sorted((t, p["time"]) for t, doc in want.items() for p in doc["points"])
