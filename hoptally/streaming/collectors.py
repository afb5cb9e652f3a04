"""The ingest of collectors' files: a state for each collector picks what to take, and its files keep their names."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hoptally.functions.model import HOUR, is_live, minute_text
from hoptally.operators.audit import window_counts
from hoptally.operators.movement import BATCH_FILES, KEPT_NAMES
from hoptally.sources.files import read_lines
from hoptally.sources.minutes import registered
from hoptally.streaming.feed import _decided

PICKED = "stream string, collector string, action string, name string, path string, length bigint"


def collector_events(spark: SparkSession, root: str) -> DataFrame:
    """New files of root/<stream>/<collector>/<file> as a stream: stream, collector, name, path, length, mtime. Contents aren't read.

    Spark's file sources leave out empty files, and files that are seven days older than the newest one (maxFileAge)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    part = F.split("path", "/")
    at = lambda k: F.element_at(part, k)
    files = spark.readStream.format("binaryFile").schema(schema).load(f"{root}/*/*")
    return files.select(at(-3).alias("stream"), at(-2).alias("collector"), at(-1).alias("name"), "path", "length", F.unix_millis("modificationTime").alias("mtime"))


def pick_files(events: DataFrame, most: int = BATCH_FILES, keep: int = KEPT_NAMES, timeout: int = HOUR, now: int | None = None) -> DataFrame:
    """What to take and what to trash (PICKED) as files of collectors become known: a stream, with a state for each (stream, collector).

    A trigger takes a collector's known files, oldest first, until `most` non-empty ones are taken; empty ones ride along, and names up to
    the checkpoint, the greatest name of the triggers before, are passed over. The newest file is held back, as it may still be written to,
    until there is a newer one or it is older than timeout. Of the names passed or taken all but the `keep` greatest go to the trash. The
    state holds the checkpoint, the files that wait, and the names that are kept. now: the time (epoch milliseconds), else the
    trigger's own; where files wait, a timer comes back to them without new events."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"checkpoint": None, "newest": None, "waiting": {}, "kept": {}}
        checkpoint, waiting, kept = held["checkpoint"], held["waiting"], held["kept"]
        newest = tuple(held["newest"]) if held["newest"] else None
        for frame in frames:
            for name, path, length, mtime in zip(frame["name"], frame["path"], frame["length"], frame["mtime"], strict=True):
                waiting[name] = [path, int(length), int(mtime)]
                newest = max(newest or (int(mtime), name), (int(mtime), name))
        time = state.getCurrentProcessingTimeMs() if now is None else now
        ready = sorted(((x[2], name) for name, x in waiting.items() if (x[2], name) != newest or x[2] < time - timeout))
        rows, full, passed = [], 0, {}
        for _, name in ready:
            if full >= most:
                break
            path, length, _ = waiting.pop(name)
            passed[name] = path
            if checkpoint is None or name > checkpoint:
                rows.append((*key, "take", name, path, length))
                full += length > 0
        checkpoint = max([x for x in (checkpoint, *passed) if x is not None], default=None)
        kept |= passed
        for name in sorted(kept)[: max(0, len(kept) - keep)]:
            rows.append((*key, "trash", name, kept.pop(name), 0))
        state.update((json.dumps({"checkpoint": checkpoint, "newest": newest, "waiting": waiting, "kept": kept}),))
        if waiting:
            state.setTimeoutDuration(1 if len(passed) < len(ready) else max(1, newest[0] + timeout - time + 1))
        yield pd.DataFrame(rows, columns=["stream", "collector", "action", "name", "path", "length"])

    known = events.where(~is_live(F.col("name"))).select("stream", "collector", "name", "path", "length", "mtime")
    return known.groupBy("stream", "collector").applyInPandasWithState(run, PICKED, "held string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def stream_collect(
    events: DataFrame, path: str, counters: str, trash: str, checkpoint: str, publish_time: Column | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
    commit_minute: Callable[[], int] | None = None, trigger: dict | None = None, **picking: int | None,
) -> StreamingQuery:
    """The files that pick_files takes, as gzipped lines in path/<stream>/<commit minute>/<collector>-<file>.gz.

    transform is the caller's hook on a batch's lines (value, stream, collector, file, path); publish_time gives their time (epoch
    milliseconds), by which counters/batch=<id> holds lines stream#file#window#count as parse_counters reads them. trash/batch=<id> holds
    what may go: stream, collector, name, path, target. A batch that runs again goes to the minute that it had before, and what is in
    place there stays; it may take more then, if time has gone on, but never less. Empty files give no file."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = registered(batch.sparkSession)
        plan = f"{checkpoint}/plans/batch={batch_id}"
        batch.write.mode("overwrite").parquet(plan)
        picked = spark.read.schema(PICKED).parquet(plan)
        gone = picked.where("action = 'trash'").select("stream", "collector", "name", "path", F.concat("collector", F.lit("-"), "name").alias("target"))
        gone.write.mode("overwrite").parquet(f"{trash}/batch={batch_id}")
        paths = [r["path"] for r in picked.where("action = 'take' and length > 0").select("path").collect()]  # so many a collector at most
        if not paths:
            return
        at = _decided(spark, checkpoint, batch_id, commit_minute)
        lines = read_lines(spark, paths, raw=True).withColumn("block", F.col("_metadata.file_block_start"))
        lines = (transform(lines) if transform else lines).withColumn("file", F.concat("collector", F.lit("-"), F.regexp_replace("file", r"\.gz$", ""), F.lit(".gz")))
        if publish_time is not None:
            text = window_counts(lines, publish_time).select(F.concat_ws("#", "stream", "file", "window", "n").alias("value"))
            text.write.mode("overwrite").text(f"{counters}/batch={batch_id}")
        target = F.concat_ws("/", "stream", minute_text(F.lit(at)), "file")
        rows = lines.select(target.alias("target"), "block", F.monotonically_increasing_id().alias("turn"), "value")
        rows = rows.repartition("target").sortWithinPartitions("target", "block", "turn").select("target", "value")
        rows.write.format("named_lines").mode("append").option("path", path).save()

    rows = pick_files(events, **picking)
    return rows.writeStream.outputMode("append").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
