"""The ingest that picks, checkpoints and trashes."""

import os
import time

import pytest
from pyspark.sql import functions as F

from hoptally.functions.model import MINUTE
from hoptally.operators import audit
from hoptally.sources.files import read_listing
from hoptally.streaming import collectors

NOW = 1_700_000_040_000


def put(root, stream, collector, k, lines, mtime=None):
    folder = f"{root}/{stream}/{collector}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{stream}-2023-11-14-22-{k:02d}_{k:05d}"
    with open(path, "w") as f:
        f.writelines(f"{x}\n" for x in lines)
    os.utime(path, (mtime or NOW / 1000 - 10_000 + k,) * 2)
    return os.path.basename(path)


@pytest.fixture
def run(spark, tmp_path):
    def start(now=NOW, **more):
        at = [NOW - NOW % MINUTE]
        collectors.stream_collect(
            collectors.collector_events(spark, f"{tmp_path}/raw"), f"{tmp_path}/out", f"{tmp_path}/counters", f"{tmp_path}/trash", f"{tmp_path}/c",
            publish_time=F.element_at(F.split("value", " "), 1).cast("long"), commit_minute=lambda: at[0], trigger={"once": True}, now=now, **more,
        ).awaitTermination()

    return start


def names(spark, tmp_path):
    return {r["name"] for r in read_listing(spark, f"{tmp_path}/out", "c", "r").where("not is_dir").collect()}


def test_triggers(spark, tmp_path, run):
    """Two files a trigger, empty ones along; the newest waits for a newer one; six names stay out of the trash; nothing comes twice."""
    raw = f"{tmp_path}/raw"
    for k in range(12):
        put(raw, "s", "one", k, [] if k in (1, 2) else [f"{NOW} {k}", f"{NOW + MINUTE} {k}"])
    put(raw, "s", "two", 3, [f"{NOW} x"])
    with open(f"{raw}/s/one/s_current", "w") as f:
        f.write("live\n")
    os.utime(f"{raw}/s/one/s_current", (NOW / 1000 - 9000,) * 2)
    gz = lambda *ks: {f"one-s-2023-11-14-22-{k:02d}_{k:05d}.gz" for k in ks}
    run(most=2, timeout=10**12)
    assert names(spark, tmp_path) == gz(0, 3)  # two's only file waits
    seen = []
    for k in range(12, 17):
        put(raw, "s", "one", k, [f"{NOW} {k}"])
        run(most=2, timeout=10**12)
        seen.append(names(spark, tmp_path))
    assert seen[0] == gz(0, 3, 4, 5) and seen[3] == gz(0, *range(3, 12)) and seen[4] == gz(0, *range(3, 14))
    trash = spark.read.parquet(f"{tmp_path}/trash/batch=*")
    assert sorted(r["target"] for r in trash.collect()) == [f"one-s-2023-11-14-22-{k:02d}_{k:05d}" for k in (0, *range(3, 8))]  # the file source leaves out empty files
    lines = spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/out")
    assert sorted(r["value"] for r in lines.collect()) == sorted(x for k in (0, *range(3, 14)) for x in ([f"{NOW} {k}", f"{NOW + MINUTE} {k}"] if k < 12 else [f"{NOW} {k}"]))
    counted = audit.parse_counters(spark.read.text(f"{tmp_path}/counters/batch=*"))
    assert {(r["file"], r["window"]): r["n"] for r in counted.collect()} == {(f, w): 1 for k in (0, *range(3, 14)) for f in gz(k) for w in (NOW, NOW + MINUTE)[: 2 if k < 12 else 1]}


def test_newest_goes_when_it_is_old(spark, tmp_path, run):
    put(f"{tmp_path}/raw", "s", "two", 3, ["1 x"])
    run(timeout=60_000, now=NOW - 10_000_000)
    assert not os.path.isdir(f"{tmp_path}/out")
    put(f"{tmp_path}/raw", "s", "other", 4, ["1 y"])  # else there is nothing to run for
    run(timeout=60_000)
    put(f"{tmp_path}/raw", "s", "two", 2, ["1 z"])
    run(timeout=60_000)
    assert names(spark, tmp_path) == {"two-s-2023-11-14-22-02_00002.gz", "two-s-2023-11-14-22-03_00003.gz", "other-s-2023-11-14-22-04_00004.gz"}


def test_timer(spark, tmp_path):
    """Files that wait are taken by triggers of their own, without new events."""
    for k in range(7):
        put(f"{tmp_path}/raw", "s", "one", k, [f"{NOW} {k}"])
    query = collectors.stream_collect(
        collectors.collector_events(spark, f"{tmp_path}/raw"), f"{tmp_path}/out", f"{tmp_path}/counters", f"{tmp_path}/trash", f"{tmp_path}/c", trigger={"processingTime": "1 second"}, most=2, timeout=10_000
    )
    try:
        until = time.time() + 90
        while time.time() < until and (not os.path.isdir(f"{tmp_path}/out") or len(names(spark, tmp_path)) < 7):
            time.sleep(1)
    finally:
        query.stop()
    assert len(names(spark, tmp_path)) == 7


def test_after_a_failure(spark, tmp_path, run, monkeypatch):
    """A batch that fails after its files were put in place runs again, in the same minute."""
    for k in range(5):
        put(f"{tmp_path}/raw", "s", "one", k, [f"{NOW} {k}"])
    decided, failed = collectors._decided, []

    def failing(*args):
        if len(failed) == 0:
            failed.append(decided(*args))
            raise OSError("midway")
        return decided(*args)

    monkeypatch.setattr(collectors, "_decided", failing)
    with pytest.raises(Exception):  # noqa: B017
        run(timeout=-1)
    run(timeout=-1)
    rows = read_listing(spark, f"{tmp_path}/out", "c", "r").where("not is_dir").collect()
    assert len(rows) == 5 and {r["minute"] for r in rows} == {failed[0]}


def test_hook_and_order_of_lines(spark, tmp_path):
    many = [f"{NOW} {k:06d}" for k in range(5000)]
    put(f"{tmp_path}/raw", "s", "one", 1, many)
    collectors.stream_collect(
        collectors.collector_events(spark, f"{tmp_path}/raw"), f"{tmp_path}/out", f"{tmp_path}/k", f"{tmp_path}/t", f"{tmp_path}/c", transform=lambda df: df.withColumn("value", F.concat("value", F.lit("!"))), timeout=-1, now=NOW, trigger={"once": True}
    ).awaitTermination()
    out = read_listing(spark, f"{tmp_path}/out", "c", "r").where("not is_dir").collect()
    assert [r["value"] for r in spark.read.text(out[0]["path"]).collect()] == [f"{x}!" for x in many]
