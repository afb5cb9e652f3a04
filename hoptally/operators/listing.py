"""Checks of file listings (cluster, root, stream, minute, name, path, is_dir, length, mtime) against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptally.functions.model import MINUTE


def in_range(listing: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Rows of the minutes [start, end); all rows if either is None."""
    return listing if start is None or end is None else listing.where((F.col("minute") >= start) & (F.col("minute") < end))


def relative(path: str = "path", root: str = "root") -> F.Column:
    """A path below its root."""
    return F.expr(f"substring({path}, length({root}) + 2)")


def minute_holes(listing: DataFrame, as_ranges: bool = False) -> DataFrame:
    """Minutes missing between the minutes that a stream of a cluster has; as_ranges: one row a hole, which doesn't grow with its length."""
    minutes = listing.select("cluster", "stream", "minute").distinct()
    after = minutes.withColumn("after", F.lead("minute").over(Window.partitionBy("cluster", "stream").orderBy("minute"))).where(F.col("after") > F.col("minute") + MINUTE)
    holes = after.select("cluster", "stream", (F.col("minute") + MINUTE).alias("first"), (F.col("after") - MINUTE).alias("last"))
    return holes if as_ranges else holes.select("cluster", "stream", F.explode(F.sequence("first", "last", F.lit(MINUTE))).alias("minute"))


def out_of_order_minutes(listing: DataFrame) -> DataFrame:
    """Minutes that were changed later than the minute after them."""
    minutes = listing.groupBy("cluster", "stream", "minute").agg(F.max("mtime").alias("mtime"))
    after = F.lead("mtime").over(Window.partitionBy("cluster", "stream").orderBy("minute"))
    return minutes.withColumn("after", after).where("mtime > after").select("cluster", "stream", "minute")


def duplicate_files(merged: DataFrame) -> DataFrame:
    """Files whose name stands under a smaller path too."""
    turn = F.row_number().over(Window.partitionBy("stream", "name").orderBy("path"))
    return merged.where("not is_dir").withColumn("turn", turn).where("turn > 1").select("stream", "name", "path")


def smaller_duplicates(merged: DataFrame) -> DataFrame:
    """The other rule for duplicates: of each pair in path order the smaller path."""
    after = F.lead("path").over(Window.partitionBy("stream", "name").orderBy("path"))
    return merged.where("not is_dir").withColumn("after", after).where("after is not null").select("stream", "name", "path")


def missing_in_merge(local: DataFrame, merged: DataFrame) -> DataFrame:
    """Local files whose name the merged listing doesn't have."""
    return local.where("not is_dir").join(merged.select("stream", "name").distinct(), ["stream", "name"], "left_anti").select("stream", "name", "path")


def missing_extra_in_mirror(merged: DataFrame, mirror: DataFrame) -> DataFrame:
    """below (path below the root) and finding: missing in the mirror, or extra there."""
    side = lambda x, name: x.where("not is_dir").select(relative().alias("below"), F.lit(True).alias(name)).distinct()
    both = side(merged, "m").join(side(mirror, "e"), "below", "full").where("m is null or e is null")
    return both.select("below", F.when(F.col("e").isNull(), "missing").otherwise("extra").alias("finding"))


def listing_diff(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has, and which: left or right."""
    a, b = (x.select(*key).distinct().withColumn(name, F.lit(True)) for x, name in ((left, "_l"), (right, "_r")))
    both = a.join(b, key, "full").where("_l is null or _r is null")
    return both.select(*key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def local_consistency(raw: DataFrame, trash: DataFrame, local: DataFrame) -> DataFrame:
    """Differences by stream and name between what collectors wrote (raw: collector, name; trash: name) and local files."""
    one = raw.select("stream", F.concat("collector", F.lit("-"), "name", F.lit(".gz")).alias("name"))
    return listing_diff(one.unionByName(trash.select("stream", F.concat("name", F.lit(".gz")).alias("name"))), local.where("not is_dir"), ["stream", "name"])


def merge_consistency(locals_: DataFrame, merged: DataFrame) -> DataFrame:
    """Differences by name between all local roots and the merged listing, and names that it has twice."""
    diff = listing_diff(locals_.where("not is_dir"), merged.where("not is_dir"), ["stream", "name"])
    twice = smaller_duplicates(merged).select("stream", "name").distinct()
    return diff.select("stream", "name", F.when(F.col("side") == "left", "missing").otherwise("replayed").alias("finding")).unionByName(twice.withColumn("finding", F.lit("duplicate")))


def fix_plan(local: DataFrame, merged: DataFrame, refuse_holes: bool = False) -> DataFrame:
    """What mends a listing: files to copy and empty minutes to create. refuse_holes: ValueError if the source has holes."""
    if refuse_holes and minute_holes(local, True).limit(1).count():
        raise ValueError("the source has missing minutes; mend it first")
    copies = missing_in_merge(local, merged).select(F.lit("copy").alias("action"), "stream", "path", F.lit(None).cast("long").alias("minute"))
    holes = minute_holes(merged.withColumn("cluster", F.lit("all"))).select(F.lit("create").alias("action"), "stream", F.lit(None).cast("string").alias("path"), "minute")
    return copies.unionByName(holes)


def validate_streams(local: DataFrame, merged: DataFrame, mirror: DataFrame, wanted: DataFrame, dest: DataFrame) -> DataFrame:
    """finding, stream, cluster, what: of the wanted (stream, mode, cluster) those that are configured are checked, all others are errors."""
    modes = dest.select("stream", F.when(F.col("is_primary"), "merge").otherwise("mirror").alias("mode"), "cluster")
    bad = wanted.join(modes, ["stream", "mode", "cluster"], "left_anti").select(F.lit("not configured").alias("finding"), "stream", "cluster", F.col("mode").alias("what"))
    good = wanted.join(modes, ["stream", "mode", "cluster"], "left_semi")
    merges, mirrors = (good.where(F.col("mode") == m).select("stream", F.col("cluster").alias("at")).distinct() for m in ("merge", "mirror"))
    of = lambda found, finding, what, which: found.join(which, "stream").select(F.lit(finding).alias("finding"), "stream", F.col("at").alias("cluster"), what.cast("string").alias("what"))
    both = missing_extra_in_mirror(merged, mirror).withColumn("stream", F.element_at(F.split("below", "/"), 1))
    holes = minute_holes(merged.withColumn("cluster", F.lit("all")), True)
    return (
        bad.unionByName(of(missing_in_merge(local, merged), "missing", F.col("path"), merges))
        .unionByName(of(duplicate_files(merged), "duplicate", F.col("path"), merges))
        .unionByName(of(holes, "hole", F.col("first"), merges))
        .unionByName(of(both.where("finding = 'missing'"), "missing", F.col("below"), mirrors))
        .unionByName(of(both.where("finding = 'extra'"), "extra", F.col("below"), mirrors))
    )


def order_listing(listing: DataFrame) -> DataFrame:
    return listing.orderBy("minute", "path")
