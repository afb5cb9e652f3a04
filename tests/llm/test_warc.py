import gzip

from pyspark.sql import functions as F

from hoptally.llm.warc import canonical_url, read_warc, resolve_revisits

COLUMNS = "record_id long, url string, ts long, revisit boolean, etag string, last_modified string, digest string, headers map<string,string>, status string"


def test_urls(spark):
    cases = {
        "HTTP://WWW.Example.COM:80/A/b/?utm_source=x&b=2&a=1&ref=y#top": "example.com/A/b?a=1&b=2",
        "https://example.com": "example.com", "https://example.com/?": "example.com", " http://m.example.com/x.html ": "m.example.com/x.html", "": "", None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string").select("u", canonical_url(F.col("u")).alias("c"))
    assert {r["u"]: r["c"] for r in df.collect()} == cases


def record(i, ts, revisit, etag=None, modified=None, digest=None, headers=None, url="http://a/x"):
    return (i, url, ts, revisit, etag, modified, digest, headers, "clash")


def test_revisits(spark):
    day = 86_400
    rows = [
        record(1, 10, False, '"v1"', "m1", "d1", {"etag": '"v1"', "server": "s", "date": "old"}),
        record(2, 10, False, '"v2"', "m2", "d2", {"etag": '"v2"', "date": "old"}),  # a tie: the greater id counts
        record(3, 10, True, '"v2"'),  # not later than any response
        record(4, 11, True, 'W/"v2"', headers={"date": "new", "content-length": "0"}),
        record(5, 5 * day, True, '"v1"'),  # in a later stretch
        record(6, 5 * day + 1, True, None, "m2"),
        record(7, 5 * day + 2, True),
        record(8, None, True, '"v2"'), record(9, 20, True, '"v2"', url=None), record(10, 20, None, digest="d3", url="http://b"), record(11, 30, True, digest="d3", url="https://www.b/#x"),
        record(11, 30, True, digest="d3", url="https://www.b/#x"),
    ]
    out = resolve_revisits(spark.createDataFrame(rows, COLUMNS)).collect()
    got = sorted((r["record_id"], r["response_id"], r["status"], r["digest"]) for r in out if r["response_id"])
    assert got == [(4, 2, "resolved", "d2"), (5, 2, "changed", None), (6, 2, "resolved", "d2"), (7, 2, "unverified", None), (11, 10, "resolved", "d3"), (11, 10, "resolved", "d3")]
    assert sorted(r["record_id"] for r in out if r["status"] == "missing") == [3, 8, 9]
    assert next(r["headers"] for r in out if r["record_id"] == 4) == 'date: new\netag: "v2"'
    assert next(r["headers"] for r in out if r["record_id"] == 11) == ""
    assert resolve_revisits(spark.createDataFrame([], COLUMNS)).count() == 0


def test_odd_revisits(spark):
    """A response without headers, a very long URL, and revisits for the same digest, which aren't not-modified ones."""
    long = "http://a/" + "x" * 50_000
    rows = [
        record(1, 10, False, '"v"', digest="d1"), record(2, 11, True, '"v"', headers={"date": "new", "server": "not permitted"}),
        record(3, 10, False, '"w"', digest="d3", url=long), record(4, 20, True, '"w"', url=long + "#y"),
    ]
    out = {r["record_id"]: r for r in resolve_revisits(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert (out[2]["status"], out[2]["headers"], out[2]["digest"]) == ("resolved", "date: new", "d1")
    assert (out[4]["status"], out[4]["response_id"], out[4]["headers"]) == ("resolved", 3, "")
    profiled = spark.createDataFrame(rows, COLUMNS).withColumn("profile", F.when(F.col("record_id") == 2, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    assert [r["record_id"] for r in resolve_revisits(profiled).collect()] == [4]


def warc(kind, i, date, http, body, version="1.0", more=()):
    block = f"{http}\r\n\r\n".encode() + (body if isinstance(body, bytes) else body.encode())
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{i}>", f"WARC-Date: {date}", "WARC-Target-URI: http://www.a/x?utm_id=1" if i != 3 else "WARC-Target-URI: http://a/x", f"Content-Length: {len(block)}", *more]
    return f"WARC/{version}\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_files(spark, tmp_path):
    records = [
        warc("warcinfo", 0, "2024-01-01T00:00:00Z", "software: x", ""),
        warc("response", 1, "2024-01-01T00:00:01Z", 'HTTP/1.1 200 OK\r\nETag: "v"\r\nServer: s\r\nSet-Cookie: a\r\nSet-Cookie: b', "<p>body: é\r\n\r\nmore</p>"),
        warc("revisit", 3, "2024-01-02T00:00:00Z", 'HTTP/1.1 304 Not Modified\r\nEtag: W/"v"\r\nDate: now', ""),
    ]
    (tmp_path / "a.warc").write_bytes(records[0] + records[1])
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records[2:])))
    got = {r["revisit"]: r for r in read_warc(spark, str(tmp_path)).collect()}
    assert bytes(got[False]["body"]).decode() == "<p>body: é\r\n\r\nmore</p>" and got[False]["headers"] == {"etag": '"v"', "server": "s", "set-cookie": "a"}
    out = resolve_revisits(read_warc(spark, str(tmp_path))).first()
    assert (out["status"], out["response_id"], out["url_key"]) == ("resolved", got[False]["record_id"], "a/x")
    assert out["headers"] == 'date: now\netag: W/"v"\nserver: s\nset-cookie: a'


def test_payloads_like_records(spark, tmp_path):
    """Bytes that aren't UTF-8, and payloads that hold whole records, in files that may be split among tasks or not."""
    inner = warc("response", 9, "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK", "inner")
    bodies = [b"\xff\xfe\x00raw", b"before\r\nWARC/1.0\r\n" + inner + inner + b"WARC/1.1\r\n", b"", inner * 3000]
    whole = b"".join(warc("response", 10 + k, "2024-01-01T00:00:01Z", "HTTP/1.1 200 OK\r\nA: b", x, "1.1") for k, x in enumerate(bodies))
    same = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    whole += warc("revisit", 30, "2024-01-03T00:00:00Z", "HTTP/1.1 200 OK", "", "1.1", [same]) + warc("response", 31, "x", "HTTP/1.1 200 OK", "cut short")[:-8]
    (tmp_path / "one.warc").write_bytes(whole)
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(whole))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_warc(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted(bytes(r["body"]) for r in rows) == sorted(2 * [*bodies, b"", b"cut s"])
    assert [r["revisit"] for r in rows if r["profile"]] == [True, True]
    assert {r["ts"] for r in rows if bytes(r["body"]) == b"cut s"} == {None}
    assert resolve_revisits(read_warc(spark, str(tmp_path))).count() == 0
