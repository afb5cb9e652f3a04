import pytest
from pyspark.sql import functions as F

from hoptally.functions import model as m
from hoptally.operators import listing, movement

MIN = m.MINUTE
COLUMNS = "cluster string, root string, stream string, minute long, name string, path string, is_dir boolean, length long, mtime long"


def files(spark, root, *rows):
    """(minute number, name[, mtime, length])"""
    out = []
    for r in rows:
        minute, name, mtime, length = (*r, r[0] * MIN, 1)[:4] if len(r) == 2 else (*r, 1)[:4]
        out.append(("c", root, "s", minute * MIN, name, f"{root}/s/{minute:03d}/{name}", False, length, mtime))
    return spark.createDataFrame(out, COLUMNS)


def test_merge_findings(spark):
    local = files(spark, "l", (1, "a"), (2, "b"), (4, "d"))
    merged = files(spark, "m", (1, "a"), (2, "a"), (4, "d"))
    assert [r["name"] for r in listing.missing_in_merge(local, merged).collect()] == ["b"]
    assert [r["path"] for r in listing.duplicate_files(merged).collect()] == ["m/s/002/a"]
    assert [r["path"] for r in listing.smaller_duplicates(merged).collect()] == ["m/s/001/a"]
    assert [r["minute"] for r in listing.minute_holes(merged).collect()] == [3 * MIN]
    plan = {(r["action"], r["path"], r["minute"]) for r in listing.fix_plan(local, merged).collect()}
    assert plan == {("copy", "l/s/002/b", None), ("create", None, 3 * MIN)}
    with pytest.raises(ValueError):
        listing.fix_plan(local, merged, refuse_holes=True)


def test_mirror_findings(spark):
    merged, mirror = files(spark, "m", (1, "a"), (2, "b")), files(spark, "r", (1, "a"), (3, "x"))
    got = {(r["below"], r["finding"]) for r in listing.missing_extra_in_mirror(merged, mirror).collect()}
    assert got == {("s/002/b", "missing"), ("s/003/x", "extra")}
    assert [r["below"] for r in movement.mirror_plan(merged, mirror).collect()] == ["s/002/b"]


def test_order(spark):
    rows = files(spark, "l", (1, "a", 500), (2, "b", 400), (3, "c", 900))
    assert [r["minute"] for r in listing.out_of_order_minutes(rows).collect()] == [MIN]


def test_next_minutes(spark):
    minutes = spark.createDataFrame([("s", k * MIN) for k in (1, 2, 3, 4, 6, 7)], "stream string, minute long")
    start = lambda k: spark.createDataFrame([("s", k * MIN)], "stream string, checkpoint long")
    got = lambda k, limit=30: sorted(r["minute"] // MIN for r in movement.next_minutes_batch(minutes, start(k), limit).collect())
    assert got(0) == [1, 2, 3]
    assert got(0, 1) == [1, 2]
    assert got(4) == []


def test_next_minutes_of_long_streams(spark):
    """More minutes after the checkpoint than make up 2^31 milliseconds, and limits of more than that."""
    minutes = spark.range(40_000).select(F.lit("s").alias("stream"), (F.col("id") * MIN).alias("minute"))
    minutes = minutes.unionByName(minutes.where(f"minute % {2 * MIN} = 0").withColumn("stream", F.lit("t"))).where(f"minute <> {39_000 * MIN}")
    at = spark.createDataFrame([("s", 10 * MIN), ("t", 10 * MIN), ("u", 10 * MIN)], "stream string, checkpoint long")
    got = lambda limit: sorted((r["stream"], r["minute"] // MIN) for r in movement.next_minutes_batch(minutes, at, limit).collect())
    assert got(30) == [("s", 11 + k) for k in range(31)]
    assert got(39_500) == [("s", k) for k in range(11, 38_999)]


def test_collector_batch(spark):
    rows = [("s", "c", f"f{k:02d}", "p", 0 if k == 3 else 1, k) for k in range(14)]
    f = spark.createDataFrame(rows, "stream string, collector string, name string, path string, length long, mtime long")
    none = spark.createDataFrame([], "stream string, collector string, checkpoint string")
    batch = movement.collector_batch(f, none, 100)
    assert sorted(r["name"] for r in batch.collect()) == [f"f{k:02d}" for k in range(11)]
    assert movement.collector_checkpoint(batch).first()["checkpoint"] == "f10"
    after = movement.collector_batch(f, movement.collector_checkpoint(batch), 100)
    assert sorted(r["name"] for r in after.collect()) == ["f11", "f12"]
    assert movement.trash_candidates(f).count() == 8


def test_live_files(spark):
    names = spark.createDataFrame([("a_current",), ("Scribe_Stats",), ("a-2024-01-01-00-00_1",)], "name string")
    assert [r["name"] for r in movement.exclude_live_files(names).collect()] == ["a-2024-01-01-00-00_1"]


def test_guards(spark):
    with pytest.raises(ValueError):
        movement.retention_guard(0, 50 * m.HOUR, 24)
    movement.retention_guard(30 * m.HOUR, 50 * m.HOUR, 24)
    twice = spark.createDataFrame([("a",), ("a",)], "below string")
    with pytest.raises(ValueError):
        movement.sync_duplicate_check(twice)


def test_names(spark):
    row = spark.createDataFrame([("r/s/2024/01/02/03/04/f", "s-2024-01-02-03-04_7")], "path string, name string")
    at = row.select(m.path_to_minute(F.col("path")), m.file_name_time(F.col("name")), m.path_to_minute(F.lit("x")), m.file_name_time(F.lit("x")), m.path_to_stream(F.col("path"), "r")).first()
    assert at[0] == at[1] == 1_704_164_640_000 and at[2] is None and at[3] == -1 and at[4] == "s"


def test_empty_minutes_are_listed(spark, tmp_path):
    """Minutes 00, 01 (empty) and 03 of a stream, in folders named plainly and by partition."""
    from hoptally.sources.files import read_listing

    for folder in ("s/2024/01/02/03/00", "s/2024/01/02/03/01", "s/2024/01/02/03/03", "s/2024/01/05/00/00", "stream=t/year=2024/month=01/day=02/hour=03/minute=00"):
        (tmp_path / folder).mkdir(parents=True)
    for at in ("s/2024/01/02/03/00/a", "s/2024/01/02/03/03/b", "s/2024/01/05/00/00/c"):
        (tmp_path / at).write_text("x")
    day = 1_704_153_600_000
    rows = read_listing(spark, str(tmp_path), "c", "r", day, day + m.DAY)
    base = day + 3 * m.HOUR
    got = sorted((r["stream"], (r["minute"] - base) // MIN, r["name"], r["is_dir"], r["length"]) for r in rows.collect())
    assert got == [("s", 0, "a", False, 1), ("s", 1, "01", True, 0), ("s", 3, "b", False, 1), ("t", 0, "minute=00", True, 0)]
    assert [(r["minute"] - base) // MIN for r in listing.minute_holes(rows).collect()] == [2]
    assert read_listing(spark, str(tmp_path), "c", "r").count() == 5
    assert read_listing(spark, str(tmp_path), "c", "r", 0, m.DAY).count() == 0


def test_childless_folders(spark):
    rows = [("r/s/2024", True), ("r/s/2024/01", True), ("r/s/2024/01/02", True), ("r/s/2024/01/03", True), ("r/s/2024/01/03/04", True), ("r/s/2023", True), ("r/s", True), ("r/s/2024/02", True), ("r/s/2024/01/03/05", True)]
    entries = spark.createDataFrame([("r", p, d) for p, d in rows], "root string, path string, is_dir boolean")
    assert sorted(tuple(r) for r in movement.childless_folders(entries).collect()) == [("r/s/2023", "year"), ("r/s/2024/01/02", "day"), ("r/s/2024/02", "month")]


def test_rollup_days(spark):
    from hoptally.operators import rollup

    rolled = spark.createDataFrame([(12 * m.DAY,)], "day long")
    days = lambda **k: sorted(r["day"] // m.DAY for r in rollup.rollup_day_range(rolled, 10 * m.DAY, 20 * m.DAY + 5, 2, **k).collect())
    assert days() == [10, 11, 13, 14, 15, 16, 17] and days(daily_till_days=5) == [15, 16, 17] and days(days=3) == [10, 11] and days(days=99) == days()
    with pytest.raises(ValueError):
        rollup.rollup_day_range(rolled, 18 * m.DAY, 20 * m.DAY, 2, days=1)
