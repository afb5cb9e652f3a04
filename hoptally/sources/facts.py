"""The fact table as base and deltas under a manifest.

Writers only add: a part is a folder of tuples by day that no one changes afterwards. What the table holds is said by its
manifest, a small versioned file that names the live parts of each day and their grain (milliseconds to a row: a minute, an hour, a
day), the last batch of each feed, the boundary before which tuples are too late, and how many were. A change writes its parts
first and then the next version of the manifest, by a rename that doesn't overwrite; whoever comes second reads the new version and
decides again. So readers see one version or the other, a batch that runs twice counts once, several feeds fill one table,
and a rollup swaps days while they go on.

    parts/<name>/late=false/day=<ms>/*.parquet      what was added, by day
    parts/<name>/late=true/day=<ms>/*.parquet       what came too late; in no manifest, kept to be looked at
    _manifest/<version>.json

A manifest has an entry for each part of a day; compact() keeps them few. Parts that no version names any more are deleted by
vacuum() alone, so that readers of older versions can end.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.functions.model import DAY, HOUR, KEY, MEASURES, MINUTE, received, time_range

SCHEMA = ", ".join([f"{k} {'bigint' if k == 'timeinterval' else 'string'}" for k in KEY] + [f"{m} bigint" for m in MEASURES])
#: Parts of a day from which on a feed compacts it.
PARTS = 16


class Moved(Exception):
    """Another writer was first, and what this one has read isn't what the table holds."""


@dataclass(frozen=True)
class Part:
    """Tuples of one day in one folder (below the table), of one grain."""

    day: int
    path: str
    grain: int = MINUTE


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    parts: tuple[Part, ...] = ()
    feeds: dict[str, int] = field(default_factory=dict)  # the last batch of each
    boundary: int = 0
    late: dict[str, list[int]] = field(default_factory=dict)  # n, sent, received by feed

    def of(self, day: int) -> list[Part]:
        return [p for p in self.parts if p.day == day]

    def has(self, feed: str, batch: int) -> bool:
        return self.feeds.get(feed, -1) >= batch

    @property
    def days(self) -> list[int]:
        return sorted({p.day for p in self.parts})

    def text(self) -> str:
        body = {"version": self.version, "boundary": self.boundary, "feeds": self.feeds, "late": self.late, "parts": [[p.day, p.path, p.grain] for p in self.parts]}
        return json.dumps(body, indent=0)

    @classmethod
    def parsed(cls, text: str) -> Manifest:
        body = json.loads(text)
        return cls(body["version"], tuple(Part(*p) for p in body["parts"]), body["feeds"], body["boundary"], body["late"])


class Folder:
    """Files below a path, by the store's own calls."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._fs, self._gateway = path, spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._store = self._fs.Path(path).getFileSystem(self._conf)

    def at(self, name: str = ""):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self.at(name)
        return [s.getPath().getName() for s in self._store.listStatus(at)] if self._store.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._store.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a file whole or not at all; False if there is one of that name."""
        aside, to = self.at(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"), self.at(name)
        stream = self._store.create(aside)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._fs.FileContext.getFileContext(self._store.getUri(), self._conf)
        try:
            context.rename(aside, to, self._gateway.new_array(self._fs.Options.Rename, 0))
            return True
        except Exception as e:
            self._store.delete(aside, False)
            if self._store.exists(to):
                return False
            raise e

    def delete(self, name: str = "") -> None:
        self._store.delete(self.at(name), True)

    def make(self, name: str = "") -> None:
        self._store.mkdirs(self.at(name))


def _versions(folder: Folder) -> list[int]:
    return [int(n.removesuffix(".json")) for n in folder.names("_manifest") if n.endswith(".json") and not n.startswith(".")]


def manifest(spark: SparkSession, table: str, version: int | None = None) -> Manifest:
    """What the table holds: now, or in an earlier version. A table that isn't there holds nothing."""
    folder = Folder(spark, table)
    at = max(_versions(folder), default=None) if version is None else version
    return Manifest() if at is None else Manifest.parsed(folder.read(f"_manifest/{at:012d}.json"))


def commit(spark: SparkSession, table: str, change: Callable[[Manifest], Manifest | None]) -> Manifest:
    """Makes change(what the table holds) its next version. It is asked again if another writer was first; None: nothing to do."""
    folder = Folder(spark, table)
    while True:
        now = manifest(spark, table)
        then = change(now)
        if then is None:
            return now
        then = replace(then, version=now.version + 1)
        if folder.create(f"_manifest/{then.version:012d}.json", then.text()):
            return then


def _write(tuples: DataFrame, table: str, name: str, boundary: int | None = None) -> tuple[list[int], bool]:
    """The tuples as a part; its days, and whether some are too late."""
    day = F.col("timeinterval") - F.pmod("timeinterval", F.lit(DAY))
    late = F.lit(False) if boundary is None else F.col("timeinterval") < boundary
    rows = tuples.select(*KEY, *MEASURES, late.alias("late"), day.alias("day"))
    rows.hint("rebalance", "late", "day").write.partitionBy("late", "day").parquet(f"{table}/parts/{name}")
    folder = Folder(tuples.sparkSession, f"{table}/parts/{name}")
    named = lambda at: [int(n.removeprefix("day=")) for n in folder.names(at) if n.startswith("day=")]
    return named("late=false"), bool(named("late=true"))


def _path(name: str, day: int) -> str:
    return f"parts/{name}/late=false/day={day}"


def _read(spark: SparkSession, table: str, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*(f"{table}/{p.path}" for p in parts))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(*(F.sum(F.coalesce(m, F.lit(0))).cast("long").alias(m) for m in MEASURES))


def append(tuples: DataFrame, table: str, feed: str, batch: int, boundary: int = 0) -> Manifest:
    """Adds a feed's batch (one row a key, as build_tuples gives them) as a delta. Nothing that is stored is read or written again.

    A batch that the manifest has already adds nothing. Tuples before the boundary, the caller's or the table's own if that is
    later, aren't added but counted; if the table's moves meanwhile, they are told apart once more."""
    spark = tuples.sparkSession
    if manifest(spark, table).has(feed, batch):
        return manifest(spark, table)
    while True:
        limit = max(boundary, manifest(spark, table).boundary)
        name = f"{feed}-{batch}-{uuid.uuid4().hex[:8]}"
        days, some_late = _write(tuples, table, name, limit)
        late = [0, 0, 0]
        if some_late:
            rows = spark.read.schema(SCHEMA).parquet(f"{table}/parts/{name}/late=true")
            late = list(rows.agg(F.count("*"), F.coalesce(F.sum("sent"), F.lit(0)), F.coalesce(F.sum(received()), F.lit(0))).first())

        def change(now: Manifest, limit=limit, name=name, days=days, late=late) -> Manifest | None:
            if now.has(feed, batch):
                return None
            if now.boundary > limit:
                raise Moved
            missed = [a + b for a, b in zip(now.late.get(feed, [0, 0, 0]), late, strict=True)]
            return replace(now, parts=(*now.parts, *(Part(d, _path(name, d)) for d in days)), feeds=now.feeds | {feed: batch}, late=now.late | {feed: missed})

        try:
            return commit(spark, table, change)
        except Moved:
            tuples = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{table}/parts/{name}")


def snapshot(spark: SparkSession, table: str, start: int | None = None, end: int | None = None, merged: bool = True, version: int | None = None) -> DataFrame:
    """The tuples of one version, of [start, end) from the parts of those days alone.

    Days of several parts are summed by key; days of one part are read as they are, without a shuffle. merged=False leaves all as they
    are, for queries that sum anyway."""
    held = manifest(spark, table, version)
    ranged = start is not None and end is not None
    parts = [p for p in held.parts if not ranged or (p.day + DAY > start and p.day < end)]
    several = {d for d in {p.day for p in parts} if len(held.of(d)) > 1} if merged else set()
    one, more = [p for p in parts if p.day not in several], [p for p in parts if p.day in several]
    rows = _read(spark, table, one)
    if more:
        both = _summed(_read(spark, table, more))
        rows = rows.unionByName(both) if one else both
    return rows.where(time_range(start, end)) if ranged else rows


def _swapped(spark: SparkSession, table: str, old: list[Part], rows: DataFrame, kind: str, grain: int | None, boundary: int = 0) -> Manifest:
    """Writes rows and puts them in the place of the old parts; Moved if those aren't all that their days hold any more."""
    name = f"{kind}-{uuid.uuid4().hex}"
    days, _ = _write(rows, table, name)
    grains = {p.day: p.grain for p in old}
    gone = set(old)

    def change(now: Manifest) -> Manifest:
        held = {p for p in now.parts if p.day in grains} if grain is not None else gone & set(now.parts)
        if held != gone:
            raise Moved
        made = tuple(Part(d, _path(name, d), grain or grains[d]) for d in days)
        return replace(now, parts=(*(p for p in now.parts if p not in gone), *made), boundary=max(now.boundary, boundary))

    return commit(spark, table, change)


def compact(spark: SparkSession, table: str, most: int = 1) -> Manifest:
    """Sums the parts of each day that has more than `most` into one; other days aren't read. Parts that are added meanwhile stay."""
    while True:
        held = manifest(spark, table)
        old = [p for d in held.days if len(held.of(d)) > most for p in held.of(d)]
        if not old:
            return held
        try:
            return _swapped(spark, table, old, _summed(_read(spark, table, old)), "base", None)
        except Moved:
            continue


def roll(spark: SparkSession, table: str, days: list[int], length: int = HOUR) -> list[int]:
    """Rolls days up to rows of `length` and moves the boundary behind the last of them; gives the days that were rolled.

    Only the parts of these days are read, of whatever grain each day has. A day without data, or whose rows are as coarse already, is
    refused. Parts that came meanwhile are rolled up too."""
    while True:
        held = manifest(spark, table)
        todo = [d for d in sorted(set(days)) if held.of(d) and max(p.grain for p in held.of(d)) < length]
        if not todo:
            return []
        old = [p for d in todo for p in held.of(d)]
        bucket = F.col("timeinterval") - F.pmod("timeinterval", F.lit(length))
        try:
            _swapped(spark, table, old, _summed(_read(spark, table, old).withColumn("timeinterval", bucket)), "rolled", length, todo[-1] + DAY)
            return todo
        except Moved:
            continue


def grains(spark: SparkSession, table: str) -> DataFrame:
    """The catalogue: day, grain (milliseconds to a row) and parts of each day that the table holds."""
    held = manifest(spark, table)
    rows = [(d, max(p.grain for p in held.of(d)), len(held.of(d))) for d in held.days]
    return spark.createDataFrame(rows, "day bigint, grain bigint, parts int")


def late_tuples(spark: SparkSession, table: str) -> DataFrame:
    """feed, n, sent and received of the tuples that came too late."""
    return spark.createDataFrame([(k, *x) for k, x in sorted(manifest(spark, table).late.items())], "feed string, n bigint, sent bigint, received bigint")


def vacuum(spark: SparkSession, table: str, versions: int = 10) -> list[str]:
    """Deletes all but the last versions of the manifest, and the parts that only older ones name, with their late rows. Gives their
    names. Parts that no version ever named stay, as a writer may be about to name them."""
    folder = Folder(spark, table)
    last = manifest(spark, table).version
    known = _versions(folder)
    named = {v: {p.path.split("/")[1] for p in manifest(spark, table, v).parts} for v in known}
    live = {x for v in known if v > last - versions for x in named[v]}
    gone = sorted({x for names in named.values() for x in names} - live)
    for name in gone:
        folder.delete(f"parts/{name}")
    for v in known:
        if v <= last - versions:
            folder.delete(f"_manifest/{v:012d}.json")
    return gone
