"""Listings, streams and copies of minute folders."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from hoptally.functions.model import DAY, HOUR, MINUTE
from hoptally.operators import listing, movement
from hoptally.sources import minutes
from hoptally.sources.files import read_listing
from hoptally.streaming import feed

BASE = 19_000 * DAY


def put(root, stream, k, *names, named=False):
    folder = f"{root}/{stream}/{minutes.folder_of(BASE + k * MINUTE, 5, named)}"
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with gzip.open(f"{folder}/{n}", "wt") as f:
            f.write(f"{stream} {k} {n}\n")


def rows(root):
    """What lies below a root: files and their lines, and folders of minutes without any."""
    out = {}
    for d, folders, names in os.walk(root):
        below = os.path.relpath(d, root)
        if below.startswith("_") or below == ".":
            continue
        if not folders and not names:
            out[below] = None
        for n in names:
            with gzip.open(f"{d}/{n}", "rt") as f:
                out[f"{below}/{n}"] = f.read()
    return out


def test_listing_by_tasks(spark, tmp_path):
    for stream, named in (("a", False), ("stream=b", True), ("_hidden", False)):
        for k in (0, 1, 3, 70, 1500):
            put(tmp_path, stream, k, *([] if k == 3 else [f"f{k}", "_SUCCESS", ".x.crc"]), named=named)
    os.makedirs(tmp_path / "a/2022/13/45/00/00")
    got = {(r["stream"], (r["minute"] - BASE) // MINUTE, r["name"], r["is_dir"]) for r in read_listing(spark, str(tmp_path), "c", "r").collect()}
    want = {(s, k, f"f{k}", False) for s in "ab" for k in (0, 1, 70, 1500)} | {("a", 3, "03", True), ("b", 3, "minute=03", True)}
    assert got == want
    some = read_listing(spark, str(tmp_path), "c", "r", BASE + MINUTE, BASE + HOUR)
    assert {(r["stream"], (r["minute"] - BASE) // MINUTE) for r in some.collect()} == {(s, k) for s in "ab" for k in (1, 3)}
    one = some.where("not is_dir").first()
    assert one["length"] == os.path.getsize(one["path"]) and abs(one["mtime"] - os.path.getmtime(one["path"]) * 1000) < 2
    assert read_listing(spark, f"{tmp_path}/nothing", "c", "r").count() == 0 and read_listing(spark, str(tmp_path), "c", "r", 5, 5).count() == 0
    assert read_listing(spark, f"file://{tmp_path}", "c", "r").first()["path"].startswith("file:///")


def test_partitions_of_a_listing(spark, tmp_path, monkeypatch):
    """A partition for each stream and hour of a range, that filters narrow; without a range for each stream and day that is there."""
    for stream in "abc":
        for k in (0, 70, 1500, 3000):
            put(tmp_path, stream, k, "f")
    assert read_listing(spark, str(tmp_path), "c", "r").rdd.getNumPartitions() == 3 * 3
    assert read_listing(spark, str(tmp_path), "c", "r", BASE, BASE + 5 * HOUR).rdd.getNumPartitions() == 3 * 5
    whole = minutes.registered(spark).read.format("minute_listing").option("path", str(tmp_path)).load()
    some = whole.where((F.col("minute") >= BASE + HOUR) & (F.col("minute") < BASE + 3 * HOUR))
    assert some.rdd.getNumPartitions() == 3 * 2 and {r["minute"] for r in some.collect()} == {BASE + 70 * MINUTE}
    assert whole.where(F.col("minute") == BASE).rdd.getNumPartitions() == 3
    monkeypatch.setattr(minutes, "PARTITIONS", 20)
    reader = minutes._Listing({"path": str(tmp_path), "start": BASE, "end": BASE + 2 * DAY})
    spans = reader.partitions()
    assert len(spans) <= 20 and sum(s.last - s.first for s in spans) == 3 * 2 * DAY
    assert len([r for s in spans for r in s.rows(minutes.Store(str(tmp_path)))]) == 9


def taken(root):
    return {(k.split("/")[0], "/".join(k.split("/")[1:6])) for k in rows(root)}


def test_mirror_stops_at_gaps_and_keeps_paths(spark, tmp_path):
    root, out, checkpoint = f"{tmp_path}/root", f"{tmp_path}/out", f"{tmp_path}/c"
    run = lambda: feed.stream_mirror(spark, root, out, checkpoint, limit=4).awaitTermination()
    os.makedirs(root)
    run()  # nothing there yet
    for k in (0, 1, 2, 4, 5, 6):
        put(root, "a", k, *([] if k == 1 else ["x.gz", "y.gz"]))
    put(root, "b", 10, "z.gz")
    at = lambda *ks: {("a", minutes.folder_of(BASE + k * MINUTE, 5, False)) for k in ks}
    run()
    assert taken(out) == at(0, 1)  # 2 has none after it, b's only one neither
    run()
    assert taken(out) == at(0, 1)
    put(root, "a", 3)
    put(root, "b", 11)
    run()
    assert taken(out) == at(0, 1, 2, 3, 4, 5) | {("b", minutes.folder_of(BASE + 10 * MINUTE, 5, False))}
    for k in range(7, 20):
        put(root, "a", k, "x.gz")
    for n in (10, 15, 18, 18):
        run()  # at most five minutes each
        assert {k for s, k in taken(out) if s == "a"} == {k for _, k in at(*range(n + 1))}
    source, mirror = rows(root), rows(out)
    last = {minutes.folder_of(BASE + k * MINUTE, 5, False) for k in (11, 19)}
    assert {k: x for k, x in source.items() if k[2:18] not in last or k.startswith("a/") and k[2:18] != minutes.folder_of(BASE + 19 * MINUTE, 5, False)} == mirror
    both = [read_listing(spark, p, "c", p) for p in (root, out)]
    assert {r["below"][2:18] for r in listing.missing_extra_in_mirror(*both).collect()} == {minutes.folder_of(BASE + 19 * MINUTE, 5, False)}


def test_batches_are_those_of_the_plan(spark, tmp_path):
    """Minute by minute what next_minutes_batch says of the same minutes and checkpoints, over several triggers."""
    root, checkpoint, limit = f"{tmp_path}/root", f"{tmp_path}/c", 3
    present = {"a": [*range(0, 9), *range(10, 14)], "b": [5, 6, 8], "c": range(2, 20)}
    for s, ks in present.items():
        for k in ks:
            put(root, s, k, "f.gz")
    seen: list[set] = []

    def each(batch, _):
        seen.append({(r["stream"], r["minute"]) for r in batch.select("stream", "minute").collect()})

    at = {s: BASE + (min(ks) - 1) * MINUTE for s, ks in present.items()}
    for turn in range(4):
        if turn == 2:
            put(root, "b", 7, "f.gz")
            present["b"] = [5, 6, 7, 8]
        seen.clear()
        feed.minutes_in_order(spark, root, checkpoint, limit=limit).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        there = spark.createDataFrame([(s, BASE + k * MINUTE) for s, ks in present.items() for k in ks], "stream string, minute long")
        plan = {tuple(r) for r in movement.next_minutes_batch(there, spark.createDataFrame(list(at.items()), "stream string, checkpoint long"), limit).collect()}
        assert (seen[0] if seen else set()) == plan, turn
        for s, m in plan:
            at[s] = max(at[s], m)


@pytest.mark.parametrize("when", ["tasks", "midway", "after"])
def test_mirror_after_a_failure(spark, tmp_path, monkeypatch, when):
    """A batch that fails in its tasks, while its files are put in place, or after: run again it gives the same, and nothing is left aside."""
    root, out, checkpoint = f"{tmp_path}/root", f"{tmp_path}/out", f"{tmp_path}/c"
    for k in range(6):
        put(root, "a", k, *([] if k == 2 else ["x.gz", "y.gz"]))
    blocked = f"{out}/a/{minutes.folder_of(BASE + 3 * MINUTE, 5, False)}"
    if when == "tasks":
        os.makedirs(out)
        with open(f"{out}/_aside", "w"):
            pass  # a file where tasks are to write
    elif when == "midway":
        os.makedirs(os.path.dirname(blocked))
        with open(blocked, "w"):
            pass  # a file where the minute's folder is to be
    else:
        copied = feed._copied

        def failing(*args):
            copied(*args)
            raise OSError("after")

        monkeypatch.setattr(feed, "_copied", failing)
    with pytest.raises(Exception):  # noqa: B017
        feed.stream_mirror(spark, root, out, checkpoint).awaitTermination()
    if when == "tasks":
        assert rows(out) == {}
        os.remove(f"{out}/_aside")
    elif when == "midway":
        os.remove(blocked)
    else:
        monkeypatch.undo()
    feed.stream_mirror(spark, root, out, checkpoint).awaitTermination()
    want = {k: x for k, x in rows(root).items() if k[2:18] != minutes.folder_of(BASE + 5 * MINUTE, 5, False)}
    assert rows(out) == want
    left = os.listdir(f"{out}/_aside") if os.path.isdir(f"{out}/_aside") else []
    assert when == "midway" or left == []


def test_merge_keeps_names_and_its_minute(spark, tmp_path, monkeypatch):
    """Of one name in two roots' minutes the later one stays; a batch that runs again goes to the minute that it had."""
    roots, out, checkpoint = [f"{tmp_path}/r{k}" for k in (0, 1)], f"{tmp_path}/out", f"{tmp_path}/c"
    for k in range(4):
        put(roots[0], "a", k, f"one{k}.gz", "same.gz")
        put(roots[1], "a", k + 1, f"two{k}.gz", *(["same.gz"] if k == 1 else []))
    copied, now = feed._copied, [BASE + DAY + 5]

    def failing(*args):
        copied(*args)
        raise OSError("after")

    monkeypatch.setattr(feed, "_copied", failing)
    run = lambda: feed.stream_merge(spark, roots, out, checkpoint, lambda: now[0]).awaitTermination()
    with pytest.raises(Exception):  # noqa: B017
        run()
    monkeypatch.undo()
    now[0] += 3 * MINUTE
    run()
    at = f"a/{minutes.folder_of(BASE + DAY, 5, False)}"
    got = rows(out)
    assert got == {f"{at}/{n}.gz": x for n, x in got_names(got)} and set(got) == {f"{at}/{n}.gz" for n in ("one0", "one1", "one2", "two0", "two1", "two2", "same")}
    assert got[f"{at}/same.gz"] == "a 2 same.gz\n"


def got_names(got):
    return [(k.rsplit("/", 1)[1].removesuffix(".gz"), x) for k, x in got.items()]


def test_named_lines(spark, tmp_path):
    lines = minutes.registered(spark).createDataFrame([("s/2022/01/01/00/00/f.gz", "é"), ("s/2022/01/01/00/00/f.gz", ""), ("g.gz", None), ("g.gz", "2")], "target string, value string")
    lines.repartition(3, "target").sortWithinPartitions("target", "value").write.format("named_lines").mode("append").option("path", f"{tmp_path}/o").save()
    assert {r["value"] for r in spark.read.text(f"{tmp_path}/o/s/2022/01/01/00/00/f.gz").collect()} == {"é", ""}
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/o/g.gz").orderBy("value").collect()] == ["", "2"]
    lines.limit(0).write.format("named_lines").mode("append").option("path", f"{tmp_path}/o").save()
