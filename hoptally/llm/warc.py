"""Not-modified revisits of a crawl: each is resolved to the latest earlier full response of its canonical URL.

An as-of join by canonical URL, by windows in two levels so that one URL may hold any share of the records: the
latest response within a stretch of time of the URL, else the one carried over from its earlier stretches. Then
the validators are compared and the headers that a 304 may update are merged into the response's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read

#: Headers of a not-modified response that replace those of the stored one (RFC 9110, 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that don't tell pages apart, besides those that begin with utm_.
TRACKING = ["ref", "fbclid", "gclid", "sessionid", "session_id"]
#: What every record of a WARC file begins with, before the version's last digit.
BEGINS = b"WARC/1."
#: Seconds to a stretch of time: what one URL has within it is one group.
STRETCH = 3_600


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without a last slash, query without tracking and sorted; no scheme, no fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(bare, "^[^?]*\\?(.*)$", 1), "&")
    name = lambda x: F.lower(F.regexp_extract(x, "^([^=]*)", 1))
    kept = F.array_sort(F.filter(query, lambda x: (x != "") & ~name(x).startswith("utm_") & ~name(x).isin(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


RECORDS = "record_id long, url string, date string, revisit boolean, profile string, etag string, last_modified string, digest string, headers map<string,string>, body binary"


def _fields(lines: bytes) -> dict[str, str]:
    """Named fields by name in lower case; of a repeated one the first."""
    out: dict[str, str] = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon and not name.startswith("HTTP/"):
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _record(about: bytes, block: bytes) -> tuple | None:
    """A row of RECORDS of a response or a revisit; None of other records."""
    own = _fields(about)
    kind = own.get("warc-type", "").lower()
    if kind not in {"response", "revisit"}:
        return None
    http, _, body = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
    headers = _fields(http)
    some = lambda x: x or None
    return (
        xxhash.xxh3_64_intdigest(own.get("warc-record-id", "")) - (1 << 63), some(own.get("warc-target-uri", "").strip("<>")), some(own.get("warc-date")), kind == "revisit",
        some(own.get("warc-profile")), some(headers.get("etag")), some(headers.get("last-modified")), some(own.get("warc-payload-digest")), list(headers.items()), body,
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts records together again: what was cut at the words that begin one goes on until the record has its length."""
    kinds = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("revisit", pa.bool_()), ("profile", pa.string()), ("etag", pa.string()),
                       ("last_modified", pa.string()), ("digest", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary())])
    file, about, block, missing = None, b"", bytearray(), 0

    def out(row: tuple | None) -> Iterator[pa.RecordBatch]:
        if row:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds.types, strict=True)], schema=kinds)

    for batch in batches:
        for path, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if path != file:
                if missing > 0:  # the file ended within it
                    yield from out(_record(about, bytes(block)))
                file, missing = path, 0
            if missing > 0:
                block += BEGINS + value
                missing -= len(BEGINS) + len(value)
            else:
                about, end, rest = value.partition(b"\r\n\r\n")
                length = _fields(about).get("content-length", "")
                if not end or not length.isdigit():
                    continue
                block, missing = bytearray(rest), int(length) - len(rest)
            if missing <= 0:
                yield from out(_record(about, bytes(block[: len(block) + min(missing, 0)])))
    if missing > 0:
        yield from out(_record(about, bytes(block)))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of WARC files (1.0 and 1.1, gzipped or .warc), as resolve_revisits takes them, with body.

    Files are streams of bytes, a task each; a task holds one record at a time, as long as its Content-Length says,
    whatever its payload looks like. record_id is a hash of the record's own id. A record without a target, date, profile or
    HTTP headers has nulls there (no headers: an empty map); one that its file cuts short has what is there; one without
    a length is left out."""
    # the pass-through codec keeps plain files whole: where a part of one begins, nothing tells a record from a payload like one
    codecs = ",".join(f"org.apache.hadoop.io.compress.{x}Codec" for x in ("Gzip", "Passthrough"))
    whole = {f"{x}io.compress.passthrough.extension": ".warc" for x in ("", "org.apache.hadoop.shaded.")}  # as Hadoop names it, and Spark's own copy
    lines = spark.read.options(**{"io.compression.codecs": codecs, "lineSep": BEGINS.decode()}, **whole).text(path)
    rows = map_arrow(lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")), _records, RECORDS)
    return rows.withColumn("ts", F.unix_timestamp(F.try_to_timestamp("date"))).drop("date")


def resolve_revisits(records: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per revisit: record_id, url_key, ts, response_id, status, digest, headers.

    records: record_id long, url string, ts long (seconds), revisit boolean, etag, last_modified, digest string,
    headers map<string,string> (names in lower case). A response counts if its ts is less than the revisit's; of
    several with the latest ts, the one of the greatest record_id. status: resolved; changed, if validators that
    both have differ (ETag before Last-Modified before digest; ETags are compared weakly); unverified, if they have
    none in common; missing, if there is no earlier response. Only a resolved revisit has digest and headers: the
    response's, with PERMITTED ones of the revisit instead, as sorted lines. A null url or ts is missing; null headers are
    none; a null revisit counts as a response; a row that stands twice gives two rows. If there is a column profile, revisits whose
    profile isn't that of not-modified ones (same digest) are no revisits here and no responses either. Other columns are ignored."""
    if "profile" in records.columns:
        records = records.where(~(F.coalesce("revisit", F.lit(False)) & F.coalesce(~F.col("profile").contains("not-modified"), F.lit(False))))
    r = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "ts", F.coalesce("revisit", F.lit(False)).alias("revisit"),
        F.regexp_replace("etag", "^W/", "").alias("etag"), "last_modified", "digest", "headers", F.expr(f"ts div {stretch}").alias("stretch"),
    )
    lines = F.transform(F.map_entries("headers"), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    full = F.when(~F.col("revisit"), F.struct("ts", "record_id", "etag", "last_modified", "digest", lines.alias("headers")))
    usable = r.where("url_key is not null and ts is not null")
    within = usable.withColumn("own", F.max(full).over(Window.partitionBy("url_key", "stretch").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)))
    latest = usable.where("not revisit").groupBy("url_key", "stretch").agg(F.max(full).alias("latest"))
    stretches = usable.where("revisit").select("url_key", "stretch").distinct().join(latest, ["url_key", "stretch"], "full")
    carried = stretches.select("url_key", "stretch", F.max("latest").over(Window.partitionBy("url_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    found = within.where("revisit").join(carried, ["url_key", "stretch"], "left").withColumn("was", F.coalesce("own", "carried"))
    none = r.where("revisit and (url_key is null or ts is null)")
    found = found.unionByName(none, allowMissingColumns=True)

    def differs(name: str) -> Column:
        return F.when(F.col(name).isNotNull() & F.col(f"was.{name}").isNotNull(), F.col(name) != F.col(f"was.{name}"))

    verdict = F.coalesce(differs("etag"), differs("last_modified"), differs("digest"))
    status = F.when(F.col("was").isNull(), "missing").when(verdict.isNull(), "unverified").when(verdict, "changed").otherwise("resolved")
    new = F.coalesce(F.map_filter("headers", lambda k, _: k.isin(PERMITTED)), F.create_map().cast("map<string,string>"))
    old = F.coalesce(F.filter("was.headers", lambda e: ~F.array_contains(F.map_keys(new), e["key"])), F.array().cast("array<struct<key:string,value:string>>"))
    merged = F.array_sort(F.concat(F.transform(old, lambda e: F.concat_ws(": ", e["key"], e["value"])), F.transform(F.map_entries(new), lambda e: F.concat_ws(": ", e["key"], e["value"]))))
    good = F.col("status") == "resolved"
    return found.withColumn("status", status).select(
        "record_id", "url_key", "ts", F.col("was.record_id").alias("response_id"), "status",
        F.when(good, F.col("was.digest")).alias("digest"), F.when(good, F.array_join(merged, "\n")).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """The records of a crawl that fetched every page, asked for it again, and asked for its host's robots.txt each time.

    A page is fetched at 60 s times its page_id and asked for again up to some days later (or, one in 17, said to
    have been asked for before), by another spelling of its URL; one in 11 has a new ETag then, one in 13 none but a
    date. The robots.txt of a host is sent whole for every fifth page and changes every 2000 pages."""
    p = F.col("page_id")
    digest = F.md5(F.coalesce("html", F.lit("")))
    date = lambda x: F.concat(F.lit("day "), F.expr(f"({x}) div 1440").cast("string"))
    base = pages.select("page_id", "url", digest.alias("digest"))
    again = F.when(p % 17 == 5, p * 60 - 30).otherwise(p * 60 + 1 + (p * 7919) % 400_000)
    tag = F.concat(F.lit('"'), "digest", F.lit('"'))
    page = base.select(
        (p * 4).alias("record_id"), "url", (p * 60).alias("ts"), F.lit(False).alias("revisit"), tag.alias("etag"), date("page_id").alias("last_modified"), "digest",
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), date("page_id"), F.lit("etag"), tag, F.lit("server"), F.lit("s")).alias("headers"),
    )
    new = F.when(p % 13 == 4, F.lit(None)).when(p % 11 == 3, F.lit('"new"')).otherwise(F.concat(F.lit("W/"), tag))
    second = base.select(
        (p * 4 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), again.alias("ts"), F.lit(True).alias("revisit"), new.alias("etag"), date("page_id").alias("last_modified"),
        F.lit(None).cast("string").alias("digest"), F.create_map(F.lit("date"), date("page_id + 1"), F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.lit("0")).alias("headers"),
    )
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    version = F.concat(F.lit('"v'), F.expr("page_id div 2000").cast("string"), F.lit('"'))
    robots = base.select(
        (p * 4 + 2).alias("record_id"), F.concat(F.lit("https://"), host, F.lit("/robots.txt")).alias("url"), (p * 60 + 7).alias("ts"), (p % 5 != 0).alias("revisit"), version.alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.md5(F.concat(host, version)).alias("digest"), F.create_map(F.lit("etag"), version, F.lit("date"), date("page_id")).alias("headers"),
    )
    return page.unionByName(second).unionByName(robots)


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_revisits(captures(read(spark, sf_dir, "pages")))


OP6_SQL = """
WITH base AS (SELECT page_id p, url, md5(coalesce(html, '')) digest FROM pages),
rec AS (
  SELECT p * 4 record_id, url, p * 60 ts, false revisit, '"' || digest || '"' etag, 'day ' || (p // 1440) last_modified, digest,
    ['content-type', 'date', 'etag', 'server'] k, ['text/html', 'day ' || (p // 1440), '"' || digest || '"', 's'] v FROM base
  UNION ALL
  SELECT p * 4 + 1, url || '#again', CASE WHEN p % 17 = 5 THEN p * 60 - 30 ELSE p * 60 + 1 + (p * 7919) % 400000 END, true,
    CASE WHEN p % 13 = 4 THEN NULL WHEN p % 11 = 3 THEN '"new"' ELSE 'W/"' || digest || '"' END, 'day ' || (p // 1440), NULL,
    ['date', 'cache-control', 'content-length'], ['day ' || ((p + 1) // 1440), 'max-age=60', '0'] FROM base
  UNION ALL
  SELECT p * 4 + 2, 'https://' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '/robots.txt', p * 60 + 7, p % 5 <> 0,
    '"v' || (p // 2000) || '"', NULL, md5(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '"v' || (p // 2000) || '"'),
    ['etag', 'date'], ['"v' || (p // 2000) || '"', 'day ' || (p // 1440)] FROM base),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') b FROM rec),
keyed AS (
  SELECT * EXCLUDE (url, b, etag), regexp_replace(etag, '^W/', '') etag,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(b, '^[^?]*\\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT starts_with(lower(regexp_extract(x, '^([^=]*)', 1)), 'utm_')
      AND lower(regexp_extract(x, '^([^=]*)', 1)) NOT IN ('ref', 'fbclid', 'gclid', 'sessionid', 'session_id'))) q FROM bare)),
seen AS (SELECT *, max(CASE WHEN NOT revisit THEN {'ts': ts, 'id': record_id} END) OVER (
  PARTITION BY url_key ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) was FROM keyed),
both_ AS (
  SELECT a.record_id, a.url_key, a.ts, w.record_id response_id, w.digest wd, a.k, a.v, w.k wk, w.v wv,
    CASE WHEN w.record_id IS NULL THEN 'missing'
      WHEN a.etag IS NOT NULL AND w.etag IS NOT NULL THEN CASE WHEN a.etag = w.etag THEN 'resolved' ELSE 'changed' END
      WHEN a.last_modified IS NOT NULL AND w.last_modified IS NOT NULL THEN CASE WHEN a.last_modified = w.last_modified THEN 'resolved' ELSE 'changed' END
      WHEN a.digest IS NOT NULL AND w.digest IS NOT NULL THEN CASE WHEN a.digest = w.digest THEN 'resolved' ELSE 'changed' END
      ELSE 'unverified' END status
  FROM seen a LEFT JOIN keyed w ON w.record_id = a.was.id WHERE a.revisit)
SELECT record_id, url_key, ts, response_id, status, CASE WHEN status = 'resolved' THEN wd END digest,
  CASE WHEN status = 'resolved' THEN array_to_string(list_sort(list_concat(
    [wk[i] || ': ' || wv[i] for i in range(1, len(wk) + 1)
      if NOT (list_contains(k, wk[i]) AND wk[i] IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'vary'))],
    [k[i] || ': ' || v[i] for i in range(1, len(k) + 1)
      if k[i] IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'vary')])), chr(10)) END headers
FROM both_
"""
