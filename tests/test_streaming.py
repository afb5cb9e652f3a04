import os

import pytest
from pyspark.sql import functions as F

from hoptally.functions.model import BUCKETS, DAY, HOUR, KEY, MEASURES
from hoptally.operators.audit import align_messages, build_tuples
from hoptally.plans import views
from hoptally.sources import facts
from hoptally.streaming.feed import late_tuples, stream_feed

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r[c] for c in (*KEY, *MEASURES)) for r in df.collect())


def built(packets):
    return rows(build_tuples(align_messages(packets)))


@pytest.fixture
def source(spark, tmp_path):
    packets = views.packets(spark, SF)

    def stream(name, where="true", n=3):
        """More files of a folder of packets, and the folder as a stream of one file a batch."""
        packets.where(where).repartition(n).write.mode("append").parquet(f"{tmp_path}/{name}")
        return spark.readStream.schema(packets.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")

    return stream


def test_several_feeds_lose_nothing(spark, tmp_path, source):
    """In turns, with batches of the same numbers; and a new checkpoint with new data counts it."""
    table = f"{tmp_path}/table"
    for part in (0, 1):
        for k in (0, 1):
            stream_feed(source(f"in{k}", f"cluster = 'cluster{k}' and event_id % 3 = {part}"), table, f"{tmp_path}/c{k}").awaitTermination()
    stream_feed(source("in2", "event_id % 3 = 2"), table, f"{tmp_path}/c2").awaitTermination()
    assert rows(facts.snapshot(spark, table)) == built(views.packets(spark, SF))
    # nothing new: nothing is added
    before = facts.manifest(spark, table)
    stream_feed(spark.readStream.schema(views.packets(spark, SF).schema).parquet(f"{tmp_path}/in2"), table, f"{tmp_path}/c2").awaitTermination()
    assert facts.manifest(spark, table) == before
    assert len(before.feeds) == 3


def test_feed_after_failures(spark, tmp_path, monkeypatch, source):
    """A failure before the manifest's new version and one after it: the batch runs again, and nothing counts twice."""
    calls = []

    def failing(*args, commit=facts.commit):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("before")
        out = commit(*args)
        if len(calls) == 4:
            raise OSError("after")
        return out

    monkeypatch.setattr(facts, "commit", failing)
    packets = source("in", n=4)
    for _ in range(3):
        try:
            stream_feed(packets, f"{tmp_path}/table", f"{tmp_path}/c").awaitTermination()
        except Exception:  # noqa: BLE001, S110
            pass
    assert len(calls) >= 5
    assert rows(facts.snapshot(spark, f"{tmp_path}/table")) == built(views.packets(spark, SF))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_batches_write_no_more_than_they_bring(spark, tmp_path):
    """Ten equal batches into one day: each writes as many bytes, and compaction keeps one part."""
    table = f"{tmp_path}/table"
    day = build_tuples(align_messages(views.packets(spark, SF))).withColumn("timeinterval", F.col("timeinterval") % DAY + 20_000 * DAY)
    day = day.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in MEASURES))
    written = []
    for k in range(10):
        before = size(table)
        facts.append(day, table, "one", k)
        facts.append(day, table, "one", k)  # again: nothing
        written.append(size(table) - before)
    assert max(written) < 1.2 * min(written)
    held = facts.manifest(spark, table)
    assert len(held.of(20_000 * DAY)) == 10 and held.feeds == {"one": 9}
    want = sorted((*r[:5], *(10 * x for x in r[5:])) for r in rows(day))
    assert rows(facts.snapshot(spark, table)) == want
    facts.compact(spark, table)
    assert len(facts.manifest(spark, table).of(20_000 * DAY)) == 1 and rows(facts.snapshot(spark, table)) == want
    assert rows(facts.snapshot(spark, table, version=held.version)) == want  # the older version can still be read
    facts.append(day, table, "one", 9)
    assert rows(facts.snapshot(spark, table)) == want
    assert len(facts.vacuum(spark, table, 1)) == 10 and rows(facts.snapshot(spark, table)) == want


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/table"
    facts.append(views.tuples(spark, SF), path, "all", 0)
    return path


def rolled(tuples, days, length):
    time = F.when((F.col("timeinterval") - F.col("timeinterval") % DAY).isin(days), F.col("timeinterval") - F.col("timeinterval") % length).otherwise(F.col("timeinterval"))
    return rows(tuples.withColumn("timeinterval", time).groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in MEASURES)))


def test_rollup_reads_and_swaps_its_days_alone(spark, table):
    before = facts.manifest(spark, table)
    days = before.days[3:6]
    read = []
    original = facts._read
    try:
        facts._read = lambda s, t, parts: read.append(original(s, t, parts)) or read[-1]
        assert facts.roll(spark, table, [*days, 5 * DAY]) == days  # a day without data is refused
    finally:
        facts._read = original
    files = {f.split("/day=")[1].split("/")[0] for df in read for f in df.inputFiles()}
    assert files == {str(d) for d in days}
    after = facts.manifest(spark, table)
    assert after.version == before.version + 1 and after.boundary == days[-1] + DAY
    assert [p for p in after.parts if p.day not in days] == [p for p in before.parts if p.day not in days]
    assert rows(facts.snapshot(spark, table)) == rolled(views.tuples(spark, SF), days, HOUR)
    assert rows(facts.snapshot(spark, table, version=before.version)) == rows(views.tuples(spark, SF))
    assert facts.roll(spark, table, days) == [] and facts.manifest(spark, table) == after  # not twice
    assert facts.roll(spark, table, days[:2], DAY) == days[:2]
    assert {r["day"]: r["grain"] for r in facts.grains(spark, table).collect() if r["day"] in days} == {days[0]: DAY, days[1]: DAY, days[2]: HOUR}
    some = facts.snapshot(spark, table, days[0], days[0] + DAY)
    assert all(r["timeinterval"] == days[0] for r in some.collect()) and len({f.split("/day=")[1] for f in some.inputFiles()}) >= 1


def test_reader_during_a_swap_sees_one_version(spark, table, monkeypatch):
    old = rows(facts.snapshot(spark, table))
    days = facts.manifest(spark, table).days[:4]
    seen = []

    def watched(s, t, change, commit=facts.commit):
        reading = facts.snapshot(s, t)
        seen.append(rows(reading))
        out = commit(s, t, change)
        seen.append(rows(reading))  # planned before, read after
        seen.append(rows(facts.snapshot(s, t)))
        return out

    monkeypatch.setattr(facts, "commit", watched)
    facts.roll(spark, table, days)
    assert seen == [old, old, rolled(views.tuples(spark, SF), days, HOUR)]


def test_writers_that_meet(spark, table, monkeypatch):
    """A delta that comes while a day is rolled up is rolled up too; one that finds its day rolled meanwhile is too late."""
    one = views.tuples(spark, SF)
    days = facts.manifest(spark, table).days[2:4]
    delta = one.where((F.col("timeinterval") >= days[0]) & (F.col("timeinterval") < days[0] + DAY))
    turns = []

    def between(s, t, change, commit=facts.commit):
        turns.append(1)
        if len(turns) == 1:
            monkeypatch.setattr(facts, "commit", commit)
            facts.append(delta, table, "other", 0)
        return commit(s, t, change)

    monkeypatch.setattr(facts, "commit", between)
    assert facts.roll(spark, table, days) == days
    want = rolled(one.unionByName(delta), days, HOUR)
    assert rows(facts.snapshot(spark, table)) == want

    later = facts.manifest(spark, table).days[4:6]
    turns.clear()

    def rolling(s, t, change, commit=facts.commit):
        turns.append(1)
        if len(turns) == 1:
            monkeypatch.setattr(facts, "commit", commit)
            facts.roll(spark, table, later)
        return commit(s, t, change)

    monkeypatch.setattr(facts, "commit", rolling)
    both = one.where((F.col("timeinterval") >= later[0]) & (F.col("timeinterval") < later[1] + 2 * DAY))
    facts.append(both, table, "other", 1)
    kept = both.where(F.col("timeinterval") >= later[1] + DAY)
    assert rows(facts.snapshot(spark, table)) == rolled(one.unionByName(delta).unionByName(kept), [*days, *later], HOUR)
    late = both.where(F.col("timeinterval") < later[1] + DAY)
    assert tuple(late_tuples(spark, table).first()) == (late.count(), *late.agg(F.sum("sent"), F.sum(sum(F.col(b) for b in BUCKETS))).first())


def test_two_commits_at_once(spark, tmp_path):
    """Whoever is second asks again, and both are in."""
    path, first = f"{tmp_path}/t", []

    def change(now):
        if not first:
            first.append(1)
            facts.commit(spark, path, lambda m: facts.replace(m, feeds=m.feeds | {"b": 1}))
        return facts.replace(now, feeds=now.feeds | {"a": 1})

    assert facts.commit(spark, path, change).feeds == {"a": 1, "b": 1}
    assert facts.manifest(spark, path).version == 2


def test_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    empty = views.tuples(spark, SF).limit(0)
    assert facts.snapshot(spark, path).count() == 0 and facts.roll(spark, path, [0]) == [] and facts.vacuum(spark, path) == []
    facts.append(empty, path, "f", 0)
    assert facts.manifest(spark, path).feeds == {"f": 0} and facts.snapshot(spark, path, 0, DAY).count() == 0
    assert facts.grains(spark, path).count() == 0 and facts.compact(spark, path).version == 1
