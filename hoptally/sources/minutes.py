"""Minute folders (stream/yyyy/MM/dd/HH/mm, plain or as year=... folders) as data sources.

    minute_listing      their files and empty minutes as a table, listed by tasks
    minutes_in_order    the same as a stream, minute by minute and without gaps
    file_copies         files copied to given places, with their names, in two phases
    named_lines         lines written as gzipped files of given names, in two phases

Folders are listed, read and written where tasks run, by pyarrow's file systems: local folders, and those stores that it knows by
their scheme (hdfs, s3, gs and others). The driver lists streams, and of ranges without ends their days.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from hoptally.functions.model import DAY, HOUR, MINUTE

LISTING = "cluster string, root string, stream string, minute bigint, name string, path string, is_dir boolean, length bigint, mtime bigint"
FIELDS = ("year", "month", "day", "hour", "minute")
#: Partitions of a listing, rows to a batch, bytes that are copied at once, and calls to the store at once.
PARTITIONS, ROWS, PIECE, CALLS = 10_000, 8192, 4 << 20, 16
#: Minutes of a batch of the stream; one more is taken.
LIMIT = 30


class Store:
    """A folder of some store; names are relative to it."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")
        if self.uri.startswith("file:/"):
            self.system, self.base = fs.LocalFileSystem(), "/" + self.uri.removeprefix("file:").lstrip("/")
        elif "://" in self.uri:
            self.system, self.base = fs.FileSystem.from_uri(self.uri)
        else:
            self.system, self.base = fs.LocalFileSystem(), self.uri

    def at(self, name: str) -> str:
        return f"{self.base}/{name}" if name else self.base

    def list(self, name: str = "", recursive: bool = False) -> list[fs.FileInfo]:
        """What is below a folder, if it is there; names that start with . or _ are hidden."""
        found = self.system.get_file_info(fs.FileSelector(self.at(name), recursive=recursive, allow_not_found=True))
        return [x for x in found if not any(part[:1] in "._" for part in self.below(x).removeprefix(name).strip("/").split("/"))]

    def below(self, info: fs.FileInfo) -> str:
        return info.path[len(self.base) :].strip("/")

    def folders(self, name: str = "") -> list[str]:
        return sorted(x.base_name for x in self.list(name) if x.type == fs.FileType.Directory)

    def exist(self, names: list[str]) -> list[bool]:
        return [x.type != fs.FileType.NotFound for x in self.system.get_file_info([self.at(n) for n in names])] if names else []


def number(name: str, field: str) -> int | None:
    """The number in a folder's name, 07 or hour=07."""
    plain = name.removeprefix(f"{field}=")
    return int(plain) if plain.isdecimal() else None


def stream_name(folder: str) -> str:
    return folder.removeprefix("stream=")


def minute_of(parts: list[str]) -> int | None:
    """Epoch milliseconds of year, month, day, hour and minute folders; null if they are no such moment."""
    found = [number(p, f) for p, f in zip(parts, FIELDS, strict=True)]
    try:
        return None if None in found else int(datetime(*found, tzinfo=UTC).timestamp() * 1000)
    except ValueError:
        return None


def folder_of(ms: int, depth: int, named: bool) -> str:
    """The first `depth` folders of a moment."""
    t = datetime.fromtimestamp(ms / 1000, UTC)
    texts = (f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}", f"{t.hour:02d}", f"{t.minute:02d}")
    return "/".join(f"{f}={x}" if named else x for f, x in zip(FIELDS[:depth], texts, strict=False))


def listed(store: Store, stream: str, folder: str) -> list[tuple]:
    """(stream, minute, name, path, is_dir, length, mtime) of the files in minutes at or below a folder, and of minutes without any."""
    rows, minutes, full = [], {}, set()
    deep = len(stream.split("/"))
    for x in store.list(f"{stream}/{folder}", recursive=True):
        parts = store.below(x).split("/")[deep:]
        minute = minute_of(parts[:5]) if len(parts) >= 5 else None
        if minute is None:
            continue
        row = (stream_name(stream), minute, x.base_name, f"{store.uri}/{store.below(x)}", x.type == fs.FileType.Directory, x.size or 0, (x.mtime_ns or 0) // 1_000_000)
        if x.type == fs.FileType.File and len(parts) > 5:
            rows.append(row)
            full.add(minute)
        elif len(parts) == 5 and x.type == fs.FileType.Directory:
            minutes[minute] = row
    return rows + [r for m, r in minutes.items() if m not in full]


def _batches(rows: list[tuple], cluster: str, root: str) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
    for k in range(0, len(rows), ROWS):
        some = rows[k : k + ROWS]
        columns = [pa.array(x, t) for x, t in zip(zip(*some, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([cluster] * len(some)), pa.array([root] * len(some)), *columns], [c.split()[0] for c in LISTING.split(", ")])


@dataclass
class Span(InputPartition):
    """The hours of a stream's folder from first on and before last."""

    stream: str
    first: int
    last: int

    def rows(self, store: Store) -> list[tuple]:
        out, at = [], self.first
        while at < self.last:
            whole = at % DAY == 0 and at + DAY <= self.last
            for named in (False, True):
                out += listed(store, self.stream, folder_of(at, 3 if whole else 4, named))
            at += DAY if whole else HOUR
        return out


class _Listing(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.cluster, self.name = options["path"], options.get("cluster", ""), options.get("root", "")
        self.start, self.end = (int(options[k]) if k in options else None for k in ("start", "end"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows the range by what is asked of minute; Spark applies the filters all the same."""
        for f in filters:
            if getattr(f, "attribute", None) == ("minute",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.start = max(f.value, self.start if self.start is not None else f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    end = f.value + (not isinstance(f, LessThan))
                    self.end = min(end, self.end if self.end is not None else end)
            yield f

    def partitions(self) -> list[Span]:
        """By stream and hour (some hours if there are over PARTITIONS) of a range; without both ends by stream and the days that it has."""
        store = Store(self.root)
        streams = store.folders()
        if self.start is not None and self.end is not None:
            first, hours = self.start - self.start % HOUR, max(0, -(-self.end // HOUR) - self.start // HOUR)
            step = max(1, -(-len(streams) * hours // PARTITIONS))
            spans = [Span(s, first + k * HOUR, first + min(k + step, hours) * HOUR) for s in streams for k in range(0, hours, step)]
        else:
            with ThreadPoolExecutor(CALLS) as pool:
                months = [(s, y, m) for s, years in zip(streams, pool.map(store.folders, streams), strict=True) for y in years for m in store.folders(f"{s}/{y}")]
                days = pool.map(lambda x: store.folders("/".join(x)), months)
                found = {(s, t) for (s, y, m), names in zip(months, days, strict=True) for d in names if (t := minute_of([y, m, d, "00", "00"])) is not None}
            inside = lambda t: (self.start is None or t + DAY > self.start) and (self.end is None or t < self.end)
            spans = [Span(s, t, t + DAY) for s, t in sorted(found) if inside(t)]
        return spans or [Span("", 0, 0)]  # Spark wants one

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        yield from _batches(partition.rows(Store(self.root)), self.cluster, self.name)


class MinuteListing(DataSource):
    """Options: path; cluster and root, which are put into the rows; start and end (epoch milliseconds), which narrow what is listed."""

    @classmethod
    def name(cls) -> str:
        return "minute_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema: StructType) -> _Listing:
        return _Listing(self.options)


class _InOrder(DataSourceStreamReader):
    """Offsets are the last minute taken of each stream.

    A minute is taken if it is the one after the last and the one after it exists too, LIMIT + 1 at most; at a gap a stream waits until
    it is filled. What was offered last is written down before Spark gets it: a reader that starts again goes on from there, and
    Spark repeats from its own log what it hadn't finished."""

    def __init__(self, options: dict):
        self.root, self.cluster, self.name = options["path"], options.get("cluster", ""), options.get("root", "")
        self.limit, self.start = int(options.get("limit", LIMIT)), int(options["start"]) if "start" in options else None
        self.notes = Store(options["progress"])
        self.offered = self._noted()

    def _noted(self) -> dict[str, int] | None:
        known = sorted(int(x.base_name.removesuffix(".json")) for x in self.notes.list() if x.base_name.endswith(".json"))
        if not known:
            return None
        with self.notes.system.open_input_stream(self.notes.at(f"{known[-1]:012d}.json"), compression=None) as f:
            return json.loads(f.read())

    def _note(self, offsets: dict[str, int]) -> None:
        known = sorted(int(x.base_name.removesuffix(".json")) for x in self.notes.list() if x.base_name.endswith(".json"))
        self.notes.system.create_dir(self.notes.base, recursive=True)
        number = known[-1] + 1 if known else 0
        aside = self.notes.at(f".{uuid.uuid4().hex}")
        with self.notes.system.open_output_stream(aside, compression=None) as f:
            f.write(json.dumps(offsets).encode())
        self.notes.system.move(aside, self.notes.at(f"{number:012d}.json"))
        for k in known[:-1]:
            self.notes.system.delete_file(self.notes.at(f"{k:012d}.json"))

    def _before_first(self, store: Store, stream: str) -> int | None:
        """The minute before a stream's first one (of those from start on); null if it has none."""
        def walk(folder: str, parts: list[str]) -> int | None:
            if len(parts) == 5:
                found = minute_of(parts)
                return found if found is not None and (self.start is None or found >= self.start) else None
            names = [n for n in store.folders(folder) if number(n, FIELDS[len(parts)]) is not None]
            for n in sorted(names, key=lambda n: number(n, FIELDS[len(parts)])):
                if (found := walk(f"{folder}/{n}", [*parts, n])) is not None:
                    return found
            return None

        first = walk(stream, [])
        return None if first is None else first - MINUTE

    def _next(self, store: Store, stream: str, last: int) -> int:
        """The last minute that may be taken after `last`."""
        after = [last + k * MINUTE for k in range(1, self.limit + 3)]
        plain, named = (store.exist([f"{stream}/{folder_of(t, 5, n)}" for t in after]) for n in (False, True))
        there = [a or b for a, b in zip(plain, named, strict=True)]
        for t, now, then in zip(after[:-1], there[:-1], there[1:], strict=True):
            if not (now and then):
                break
            last = t
        return last

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, offered = Store(self.root), dict(self.offered or {})

        def step(stream: str) -> tuple[str, int | None]:
            last = offered.get(stream)
            last = self._before_first(store, stream) if last is None else last
            return stream, None if last is None else self._next(store, stream, last)

        with ThreadPoolExecutor(CALLS) as pool:
            offered |= {s: t for s, t in pool.map(step, store.folders()) if t is not None}
        if offered != self.offered:
            self._note(offered)
            self.offered = offered
        return offered

    def partitions(self, start: dict, end: dict) -> list[Span]:
        store, out = Store(self.root), []
        for stream, last in sorted(end.items()):
            first = start.get(stream)
            first = self._before_first(store, stream) if first is None else first
            out += [Span(stream, t, t + MINUTE) for t in range((last if first is None else first) + MINUTE, last + MINUTE, MINUTE)]
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        store = Store(self.root)
        rows = [r for named in (False, True) for r in listed(store, partition.stream, folder_of(partition.first, 4, named)) if r[1] == partition.first]
        yield from _batches(rows, self.cluster, self.name)


class MinutesInOrder(DataSource):
    """Options as of minute_listing, but start is the first minute that is taken; progress: a folder for what was offered; limit."""

    @classmethod
    def name(cls) -> str:
        return "minutes_in_order"

    def schema(self) -> str:
        return LISTING

    def streamReader(self, schema: StructType) -> _InOrder:
        return _InOrder(self.options)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written aside, and where it is to go; and folders to make."""

    files: list[tuple[str, str]]
    folders: list[str]


class _Aside(DataSourceArrowWriter):
    """Tasks write aside; commit puts all in place by renaming, abort deletes it. A place that is filled already stays as it is, so
    that a batch which failed midway can be written again."""

    def __init__(self, options: dict):
        self.root, self.aside = options["path"], f"_aside/{uuid.uuid4().hex}"

    def fresh(self, store: Store) -> str:
        store.system.create_dir(store.at(self.aside), recursive=True)
        return f"{self.aside}/{uuid.uuid4().hex}"

    def commit(self, messages: list[Written | None]) -> None:
        store = Store(self.root)
        found = [m for m in messages if m]

        def place(pair: tuple[str, str]) -> None:
            aside, target = pair
            store.system.create_dir(store.at(target.rpartition("/")[0]), recursive=True)
            if not store.exist([target])[0]:
                store.system.move(store.at(aside), store.at(target))

        with ThreadPoolExecutor(CALLS) as pool:
            list(pool.map(place, [p for m in found for p in m.files]))
            list(pool.map(lambda name: store.system.create_dir(store.at(name), recursive=True), [f for m in found for f in m.folders]))
        self.cleared(store)

    def abort(self, messages: list[Written | None]) -> None:
        self.cleared(Store(self.root))

    def cleared(self, store: Store) -> None:
        if store.exist([self.aside])[0]:
            store.system.delete_dir(store.at(self.aside))


class _Copies(_Aside):
    """Rows: path, target (below the root) and is_dir."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, files, folders, sources = Store(self.root), [], [], {}
        for batch in iterator:
            for row in batch.select(["path", "target", "is_dir"]).to_pylist():
                if row["is_dir"]:
                    folders.append(row["target"])
                    continue
                parent, _, name = row["path"].rpartition("/")
                source = sources.setdefault(parent, Store(parent)) if len(sources) < ROWS else Store(parent)
                aside = self.fresh(store)
                with source.system.open_input_stream(source.at(name), compression=None) as f, store.system.open_output_stream(store.at(aside), compression=None) as out:
                    while piece := f.read(PIECE):
                        out.write(piece)
                files.append((aside, row["target"]))
        return Written(files, folders)


class FileCopies(DataSource):
    """Option: path, the folder that targets are below."""

    @classmethod
    def name(cls) -> str:
        return "file_copies"

    def schema(self) -> str:
        return "path string, target string, is_dir boolean"

    def writer(self, schema: StructType, overwrite: bool) -> _Copies:
        return _Copies(self.options)


class _Lines(_Aside):
    """Rows: target and value, all rows of a target in one task, one after the other."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, files, target = Store(self.root), [], None
        with ExitStack() as opened:
            for batch in iterator:
                for name, value in zip(batch.column("target").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    if name != target:
                        opened.close()
                        target, aside = name, self.fresh(store)
                        raw = opened.enter_context(store.system.open_output_stream(store.at(aside), compression=None))
                        out = opened.enter_context(gzip.GzipFile(fileobj=raw, mode="wb", mtime=0))
                        files.append((aside, target))
                    out.write((value or "").encode() + b"\n")
        return Written(files, [])


class NamedLines(DataSource):
    """Option: path, the folder that targets are below."""

    @classmethod
    def name(cls) -> str:
        return "named_lines"

    def schema(self) -> str:
        return "target string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> _Lines:
        return _Lines(self.options)


def registered(spark: SparkSession) -> SparkSession:
    """The session, which knows these sources by their names and hands them filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    for source in (MinuteListing, MinutesInOrder, FileCopies, NamedLines):
        spark.dataSource.register(source)
    return spark
