"""What to move, and what to delete: plans over file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptally.functions.model import HOUR, MINUTE, is_live
from hoptally.operators.listing import relative

#: Defaults of a run: non-empty files a collector, names kept out of the trash, minutes of a batch (one more is taken).
BATCH_FILES, KEPT_NAMES, BATCH_MINUTES = 10, 6, 30


def exclude_live_files(listing: DataFrame) -> DataFrame:
    return listing.where(~is_live(F.col("name")))


def collector_batch(files: DataFrame, checkpoints: DataFrame, now: int, timeout: int = HOUR, most: int = BATCH_FILES) -> DataFrame:
    """Files to take of each (stream, collector), oldest first, until `most` non-empty ones are taken; empty ones ride along.

    The newest file is left out, as it may still be written to, unless it is older than timeout; names up to the
    checkpoint (stream, collector, checkpoint) were taken before. Where `most` is reached is found from sums by minute;
    only that minute's files are then put in order."""
    key = ["stream", "collector"]
    files = exclude_live_files(files)
    newest = files.groupBy(*key).agg(F.max(F.struct("mtime", "name")).alias("newest"))
    rows = files.join(newest, key).where((F.struct("mtime", "name") < F.col("newest")) | (F.col("mtime") < now - timeout)).join(checkpoints, key, "left")
    rows = rows.where(F.col("checkpoint").isNull() | (F.col("name") > F.col("checkpoint")))
    rows = rows.withColumns({"full": (F.col("length") > 0).cast("int"), "at": F.col("mtime") - F.col("mtime") % MINUTE})
    preceding = lambda x, w: F.coalesce(F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = rows.groupBy(*key, "at").agg(F.sum("full").alias("n"))
    sums = sums.withColumn("upto", preceding("n", Window.partitionBy(*key).orderBy("at"))).where(F.col("upto") < most)
    rows = rows.join(sums, [*key, "at"])
    crossing = F.col("upto") + F.col("n") >= most
    within = rows.where(crossing).withColumn("before", F.col("upto") + preceding("full", Window.partitionBy(*key).orderBy("mtime", "name"))).where(F.col("before") < most)
    cols = ["stream", "collector", "name", "path", "length"]
    return rows.where(~crossing).select(*cols).unionByName(within.select(*cols))


def collector_checkpoint(batch: DataFrame) -> DataFrame:
    return batch.groupBy("stream", "collector").agg(F.max("name").alias("checkpoint"))


def trash_candidates(files: DataFrame, keep: int = KEPT_NAMES, parts: int = 32) -> DataFrame:
    """All but the `keep` greatest names of each collector, with their name in the trash. A collector's names are put in
    order in so many parts, and then the greatest of these."""
    key = ["stream", "collector"]
    part = F.pmod(F.hash("name", "path"), F.lit(parts))
    some = files.select(*key, "name", "path", part.alias("part")).withColumn("turn", F.row_number().over(Window.partitionBy(*key, "part").orderBy(F.desc("name"), F.desc("path")))).where(F.col("turn") <= keep)
    last = some.withColumn("turn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("name"), F.desc("path")))).where(F.col("turn") == keep)
    rest = files.join(last.select(*key, F.struct("name", "path").alias("last")), key).where(F.struct("name", "path") < F.col("last"))
    return rest.select("stream", "collector", "name", F.concat("collector", F.lit("-"), "name").alias("target"))


def last_processed_time(files: DataFrame) -> DataFrame:
    """Of each stream the least of its collectors' latest file times; -1 isn't a time."""
    per = files.where("file_time <> -1").groupBy("stream", "collector").agg(F.max("file_time").alias("t"))
    return per.groupBy("stream").agg(F.min("t").alias("last_processed"))


def next_minutes_batch(minutes: DataFrame, checkpoints: DataFrame, limit: int = BATCH_MINUTES) -> DataFrame:
    """The minutes right after each stream's checkpoint, without a gap, each only if the one after it exists too; limit + 1 at most.
    Of a stream of any length only the minutes that can be taken, and the next one, are put in order."""
    near = (F.col("minute") > F.col("checkpoint")) & (F.col("minute") <= F.col("checkpoint") + (limit + 2) * MINUTE)
    after = minutes.select("stream", "minute").join(checkpoints, "stream").where(near).distinct()
    by = Window.partitionBy("stream").orderBy("minute")
    rows = after.withColumns({"turn": F.row_number().over(by), "after": F.lead("minute").over(by)})
    return rows.where((F.col("minute") == F.col("checkpoint") + F.col("turn").cast("long") * MINUTE) & (F.col("after") == F.col("minute") + MINUTE) & (F.col("turn") <= limit + 1)).select("stream", "minute")


def merge_plan(files: DataFrame, commit_minute: int) -> DataFrame:
    """One source path for each destination (stream, name): that of the latest minute; committed to one minute."""
    turn = F.row_number().over(Window.partitionBy("stream", "name").orderBy(F.desc("minute"), F.desc("path")))
    return files.where("not is_dir").withColumn("turn", turn).where("turn = 1").select("stream", "name", F.col("path").alias("source"), F.lit(commit_minute).cast("long").alias("commit_minute"))


def mirror_plan(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Files and empty minutes of the source that the mirror doesn't have, at the same path below its root, by minute."""
    have = mirror.select(relative().alias("below")).distinct()
    return source.withColumn("below", relative()).join(have, "below", "left_anti").select("below", "path", "minute", "is_dir").orderBy("minute", "below")


def merge_start(source: DataFrame, merged: DataFrame) -> DataFrame:
    """stream, start and missing of each stream without a checkpoint: the source minute of the newest merged file plus one,
    and how many files of that minute aren't merged; the first source minute if nothing is merged."""
    files = source.where("not is_dir").select("stream", "name", F.col("minute").alias("source_minute"))
    known = files.join(merged.where("not is_dir").groupBy("stream", "name").agg(F.max("minute").alias("to")), ["stream", "name"])
    newest = known.groupBy("stream").agg(F.max_by("source_minute", F.struct("to", "name")).alias("last"))
    gaps = files.join(newest, "stream").where(F.col("source_minute") == F.col("last")).join(merged.select("stream", "name").distinct(), ["stream", "name"], "left_anti")
    gaps = gaps.groupBy("stream").agg(F.count("*").alias("missing"))
    out = files.groupBy("stream").agg(F.min("source_minute").alias("first")).join(newest, "stream", "left").join(gaps, "stream", "left")
    return out.select("stream", F.coalesce(F.col("last") + MINUTE, F.col("first")).alias("start"), F.coalesce("missing", F.lit(0)).alias("missing"))


def mirror_start(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """As merge_start: the mirror's last minute plus one, and the files of that minute that it lacks (names without case)."""
    last = mirror.groupBy("stream").agg(F.max("minute").alias("last"))
    there = mirror.where("not is_dir").select("stream", F.lower("name").alias("lower")).distinct()
    gaps = source.where("not is_dir").join(last, "stream").where("minute = last").withColumn("lower", F.lower("name")).join(there, ["stream", "lower"], "left_anti")
    out = source.groupBy("stream").agg(F.min("minute").alias("first")).join(last, "stream", "left").join(gaps.groupBy("stream").agg(F.count("*").alias("missing")), "stream", "left")
    return out.select("stream", F.coalesce(F.col("last") + MINUTE, F.col("first")).alias("start"), F.coalesce("missing", F.lit(0)).alias("missing"))


def publish_missing_minutes(listing: DataFrame, commit_minute: int) -> DataFrame:
    """Minutes to create empty: after each stream's latest one and before the commit minute. A stream with none before gets none."""
    last = listing.where(F.col("minute") < commit_minute).groupBy("cluster", "stream").agg(F.max("minute").alias("last")).where(F.col("last") + MINUTE < commit_minute)
    made = last.select("cluster", "stream", F.explode(F.sequence(F.col("last") + MINUTE, F.lit(commit_minute - MINUTE), F.lit(MINUTE))).alias("minute"))
    return made.join(listing.select("cluster", "stream", "minute").distinct(), ["cluster", "stream", "minute"], "left_anti")


def partitions_to_register(listing: DataFrame, registered: DataFrame) -> DataFrame:
    """Minutes after the last registered one of a stream, with gaps filled, but for the newest; and the statement for each."""
    span = listing.groupBy("stream").agg(F.min("minute").alias("first"), F.max("minute").alias("newest")).join(registered, "stream", "left")
    start = F.coalesce(F.col("last") + MINUTE, F.col("first"))
    rows = span.where(start < F.col("newest")).select("stream", F.explode(F.sequence(start, F.col("newest") - MINUTE, F.lit(MINUTE))).alias("minute"))
    at = F.timestamp_millis("minute")
    parts = F.concat_ws(", ", *(F.concat(F.lit(f"{n}='"), F.date_format(at, p), F.lit("'")) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"), ("minute", "mm"))))
    return rows.withColumn("statement", F.concat(F.lit("ALTER TABLE "), "stream", F.lit(" ADD IF NOT EXISTS PARTITION ("), parts, F.lit(")")))


def retention(source: DataFrame, dest: DataFrame, default: int) -> DataFrame:
    """stream, cluster, hours: the greatest of the source's and the destination's; default where none is given."""
    both = source.select("stream", "cluster", "retention_h").unionByName(dest.select("stream", "cluster", "retention_h"))
    return both.groupBy("stream", "cluster").agg(F.coalesce(F.max("retention_h"), F.lit(default)).alias("hours"))


def purge_plan(listing: DataFrame, hours: DataFrame, now: int, default: int = 24) -> DataFrame:
    """Hours (stream, cluster, hour) whose age, also of those to come, is at least their retention."""
    have = listing.select("stream", "cluster", (F.col("minute") - F.col("minute") % HOUR).alias("hour")).distinct().join(hours, ["stream", "cluster"], "left")
    return have.where(F.floor(F.abs(F.lit(now) - F.col("hour")) / HOUR) >= F.coalesce("hours", F.lit(default))).select("stream", "cluster", "hour")


def childless_folders(entries: DataFrame) -> DataFrame:
    """Year, month and day folders (path, level) that hold nothing, to delete whatever their age. entries: root and path of all files and folders
    below root/<stream>, is_dir."""
    depth = F.size(F.split(relative(), "/"))
    level = F.when(depth == 2, "year").when(depth == 3, "month").when(depth == 4, "day")
    parents = entries.select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("path")).distinct()
    return entries.where("is_dir").select("path", level.alias("level")).where("level is not null").distinct().join(parents, "path", "left_anti")


def trash_purge_plan(dirs: DataFrame, now: int, hours: int = 24) -> DataFrame:
    """Trash folders (date yyyy-MM-dd, hour HH or null for an empty date) to delete: an empty date counts as its last hour;
    one whose names aren't numbers goes always."""
    day, hour = F.try_to_timestamp("date", F.lit("yyyy-MM-dd")), F.coalesce(F.col("hour").try_cast("int"), F.when(F.col("hour").isNull(), 23))
    at = F.unix_millis(day) + hour * HOUR
    return dirs.where(at.isNull() | (F.floor(F.abs(F.lit(now) - at) / HOUR) >= hours))


def retention_guard(start: int, now: int, hours: int) -> None:
    """ValueError if a check is to start before what is kept."""
    if start < now - hours * HOUR:
        raise ValueError("the start is older than what is kept")


def starts_too_old(starts: DataFrame, hours: DataFrame, now: int, default: int = 24) -> DataFrame:
    """retention_guard over a table: the checks (stream, cluster, start) that would begin before what is kept there."""
    have = starts.join(hours, ["stream", "cluster"], "left")
    return have.where(F.col("start") < F.lit(now) - F.coalesce("hours", F.lit(default)) * HOUR).select("stream", "cluster", "start")


def checkpoint_at(listing: DataFrame, source: DataFrame, dest: DataFrame, stream: str, minute: int | DataFrame) -> DataFrame:
    """stream, mode, cluster, minute: a merge's checkpoint for each cluster that sends the stream, a mirror's for its primary
    one; only where that minute (a number, or the column at of a one-row table) is listed."""
    merge = source.where(F.col("stream") == stream).select("stream", F.lit("merge").alias("mode"), "cluster")
    mirror = dest.where((F.col("stream") == stream) & F.col("is_primary")).select("stream", F.lit("mirror").alias("mode"), "cluster")
    rows = listing.where(F.col("minute") == minute) if isinstance(minute, int) else listing.join(minute, F.col("minute") == F.col("at"))
    return merge.unionByName(mirror).join(rows.select("stream", "cluster", "minute").distinct(), ["stream", "cluster"]).select("stream", "mode", "cluster", "minute")


def sync_listing(listing: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Rows to copy with their path below the source root; of all rows, or those at or below the given paths (path)."""
    rows = listing
    if paths is not None:
        parents = F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda k: F.array_join(F.slice(F.split("path", "/"), 1, k), "/"))
        rows = listing.withColumn("_up", F.explode(parents)).join(paths.select(F.col("path").alias("_up")).distinct(), "_up", "left_semi").drop("_up").distinct()
    return rows.withColumn("below", relative())


def sync_plan(source: DataFrame, target: DataFrame, overwrite: bool = False, update: bool = False, preserve_blocks: bool = False, skip_checksums: bool = False) -> DataFrame:
    """below, length and action (copy, skip or conflict) of every source row (below, is_dir, length, checksum).

    What is there is copied again with overwrite, or with update if it differs in length, in checksum (unless skip_checksums), or, where
    preserve_blocks asks for the source's, in block_size, which both sides then have."""
    more = [F.col("block_size").alias("t_block")] if preserve_blocks else []
    have = target.select("below", F.col("is_dir").alias("t_dir"), F.col("length").alias("t_length"), F.col("checksum").alias("t_sum"), F.lit(True).alias("there"), *more)
    differs = F.col("length") != F.col("t_length")
    if not skip_checksums:
        differs = differs | ~F.col("checksum").eqNullSafe(F.col("t_sum"))
    if preserve_blocks:
        differs = differs | ~F.col("block_size").eqNullSafe(F.col("t_block"))
    again = F.lit(overwrite) | (F.lit(update) & differs)
    action = F.when(F.col("there").isNull(), "copy").when(F.col("is_dir") != F.col("t_dir"), "conflict").when(F.col("is_dir"), "skip").when(again, "copy").otherwise("skip")
    return source.join(have, "below", "left").select("below", "length", action.alias("action"))


def copy_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("paths"), F.sum(F.coalesce("length", F.lit(0))).alias("bytes"))


def sync_delete_missing(source: DataFrame, target: DataFrame) -> DataFrame:
    return target.join(source.select("below").distinct(), "below", "left_anti").select("below")


def sync_duplicates(source: DataFrame) -> DataFrame:
    """Paths below the root that several source rows have."""
    return source.groupBy("below").agg(F.count("*").alias("n")).where("n > 1")


def sync_duplicate_check(source: DataFrame) -> DataFrame:
    """The source, or ValueError if two of its rows would be copied to one place."""
    if bad := sync_duplicates(source).limit(1).collect():
        raise ValueError(f"two sources for {bad[0]['below']}")
    return source
