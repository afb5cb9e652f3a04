"""The same jobs as streams."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hoptally.functions.model import MINUTE, minute_text, path_to_minute
from hoptally.operators.audit import align_messages, build_tuples, window_counts
from hoptally.sources import facts
from hoptally.sources.files import write_minute_partitions
from hoptally.sources.minutes import LIMIT, registered


def _own_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the feed that a checkpoint belongs to: made with it, and gone with it."""
    folder = facts.Folder(spark, checkpoint)
    folder.create("feed", uuid.uuid4().hex)
    return folder.read("feed")


def stream_feed(packets: DataFrame, table: str, checkpoint: str, boundary: int = 0, trigger: dict | None = None, parts: int = facts.PARTS) -> StreamingQuery:
    """Packets into the fact table at `table` (sources.facts): align, build, and add as a delta what isn't too late.

    A batch writes its own tuples and a version of the manifest, whatever the table holds; a batch that runs again counts once, as the
    manifest names the last one of each feed. A feed is a checkpoint: several of them fill one table, and one that starts anew
    with a new checkpoint counts all that it is given. Too late is what lies before the boundary, the caller's or the table's own, which
    moves with each rollup. Days that have over `parts` parts are summed into one."""
    spark = packets.sparkSession
    feed = _own_name(spark, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        held = facts.append(build_tuples(align_messages(batch)), table, feed, batch_id, boundary)
        if any(n > parts for n in Counter(p.day for p in held.parts).values()):
            facts.compact(batch.sparkSession, table, parts)

    return packets.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_tuples(spark: SparkSession, table: str) -> DataFrame:
    """n, sent and received of the tuples that stream_feed found too late, over all feeds and batches."""
    return facts.late_tuples(spark, table).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "sent", "received")))


def stream_window_counts(lines: DataFrame, time: str = "publish_time", delay: str = "10 minutes") -> DataFrame:
    """Messages by stream, file and minute; a minute is closed when the watermark has passed it."""
    counted = lines.withWatermark(time, delay).groupBy("stream", "file", F.window(time, "60 seconds").alias("w")).count()
    return counted.select("stream", "file", F.unix_millis("w.start").alias("window"), F.col("count").alias("n"))


def stream_window_table(lines: DataFrame, path: str, checkpoint: str, time: str = "publish_time", delay: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """stream_window_counts into a table, the minutes that are still open too: a batch writes those that it changed, to its own folder."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counted = stream_window_counts(lines, time, delay).writeStream.outputMode("update")
    return counted.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_window_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of each minute of stream_window_table; counts only grow."""
    rows = spark.read.schema("stream string, file string, window long, n long").parquet(f"{path}/batch=*")
    return rows.groupBy("stream", "file", "window").agg(F.max("n").alias("n"))


def stream_local_ingest(lines: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, trigger: dict | None = None, counters: str | None = None) -> StreamingQuery:
    """Lines (value, stream, commit_ms) into minute partitions; transform is the caller's hook on each batch.

    counters: where a batch's counters go, lines stream#file#window#count by publish minute (of lines with file and
    publish_ms), as parse_counters reads them. A batch that is run again replaces its own files."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        write_minute_partitions(rows, path, F.col("commit_ms"), batch_id)
        if counters:
            text = window_counts(rows).select(F.concat_ws("#", "stream", "file", "window", "n").alias("value"))
            text.write.mode("overwrite").text(f"{counters}/batch={batch_id}")

    return lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_merge_lines(sources: list[DataFrame], path: str, checkpoint: str, commit_minute: Callable[[], int] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """New lines (value, stream) of several roots into one, each batch under its commit minute (now, unless given), which grows; for sources
    that aren't files. stream_merge keeps files and their names."""

    def each(batch: DataFrame, batch_id: int) -> None:
        now = commit_minute() if commit_minute else int(time.time() * 1000)
        write_minute_partitions(batch, path, F.lit(now - now % MINUTE), batch_id)

    rows = reduce(lambda a, b: a.unionByName(b), sources)
    return rows.select("value", "stream").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_mirror_lines(source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """New lines of a merged root (value, and path: that of their file) under the stream and minute that they have there; stream_mirror
    keeps files, their names, and empty minutes."""
    plain = F.regexp_replace("path", "/(stream|year|month|day|hour|minute)=", "/")
    rows = source.select("value", F.regexp_extract(plain, r"/([^/]+)/\d{4}/\d{2}/\d{2}/\d{2}/\d{2}/", 1).alias("stream"), path_to_minute(plain).alias("minute"))

    def each(batch: DataFrame, batch_id: int) -> None:
        write_minute_partitions(batch.where("minute is not null"), path, F.col("minute"), batch_id)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def minutes_in_order(spark: SparkSession, root: str, checkpoint: str, cluster: str = "", start: int | None = None, limit: int = LIMIT) -> DataFrame:
    """The listing of a root's minute folders as a stream: each stream's minutes one after the other, a minute only when the next one
    is there too, limit + 1 at most a batch, and no further than a gap until it is filled. start: the first minute to take."""
    rows = registered(spark).readStream.format("minutes_in_order").options(path=root, root=root.rstrip("/"), cluster=cluster, limit=limit)
    rows = rows.option("progress", f"{checkpoint}/minutes/{hashlib.sha256(root.encode()).hexdigest()[:16]}")
    return (rows if start is None else rows.option("start", start)).load()


def _decided(spark: SparkSession, checkpoint: str, batch: int, commit_minute: Callable[[], int] | None) -> int:
    """A batch's commit minute: settled when it first runs, so that it is the same when it runs again."""
    now, folder = commit_minute() if commit_minute else int(time.time() * 1000), facts.Folder(spark, checkpoint)
    folder.create(f"commit_minutes/{batch}", str(now - now % MINUTE))
    return int(folder.read(f"commit_minutes/{batch}"))


def _copied(rows: DataFrame, path: str) -> None:
    registered(rows.sparkSession)
    rows.select("path", "target", "is_dir").write.format("file_copies").mode("append").option("path", path).save()


def stream_merge(
    spark: SparkSession, roots: list[str], path: str, checkpoint: str, commit_minute: Callable[[], int] | None = None, start: int | None = None, limit: int = LIMIT, trigger: dict | None = None
) -> StreamingQuery:
    """Files of several roots into one, with their names: <stream>/<commit minute>/<name>, the commit minute (now, unless given) being one
    for a batch. Of files of one name in a batch that of the latest minute stays. Which minutes a batch takes says minutes_in_order.

    Files are copied aside by tasks and put in place together; a batch that failed midway is put in the same minute again, and what
    is in place stays."""
    rows = reduce(lambda a, b: a.unionByName(b), [minutes_in_order(spark, r, checkpoint, start=start, limit=limit) for r in roots])

    def each(batch: DataFrame, batch_id: int) -> None:
        at = _decided(batch.sparkSession, checkpoint, batch_id, commit_minute)
        one = batch.where("not is_dir").groupBy("stream", "name").agg(F.max_by("path", F.struct("minute", "path")).alias("path"))
        target = F.concat_ws("/", "stream", minute_text(F.lit(at)), "name")
        _copied(one.select("path", target.alias("target"), F.lit(False).alias("is_dir")), path)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_mirror(spark: SparkSession, root: str, path: str, checkpoint: str, start: int | None = None, limit: int = LIMIT, trigger: dict | None = None) -> StreamingQuery:
    """Files and empty minutes of a merged root at the same place below path, minute after minute; put in place as by stream_merge."""
    below = F.expr("substring(path, length(root) + 2)")

    def each(batch: DataFrame, batch_id: int) -> None:
        _copied(batch.withColumn("target", below), path)

    rows = minutes_in_order(spark, root, checkpoint, start=start, limit=limit)
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def sliding_metric_sum(metrics: DataFrame, seconds: int, slide: int, time: str = "ts") -> DataFrame:
    """Sum of value by service, metric and stream over windows of so many seconds; a stream or a table."""
    w = F.window(time, f"{seconds} seconds", f"{slide} seconds")
    return metrics.groupBy("service", "metric", "stream", w.alias("w")).agg(F.sum("value").alias("total")).select("service", "metric", "stream", F.col("w.start").alias("start"), "total")
