import base64
import gzip
import hashlib
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairnspark.llm import warc as W
from cairnspark.llm.common import scratch_path


def brute(rows, least=0):
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    out = Counter()
    for i, _, h in rows:
        n = len((h or "").encode())
        response = n < least or i == top.get(h or "")
        out[i, n, sha(h), "response" if response else "revisit", None if response else top.get(h or "")] += 1
    return out


def run(pages, **kw):
    _, records = W.archive_and_read(pages, scratch_path(pages.sparkSession, "warc-test"), **kw)
    return Counter(tuple(r) for r in records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, "http://Example.com:80/a?b#c", "<p>é</p>", "x"), (5, "http://example.com/a?b", "<p>é</p>", "x"), (5, "http://example.com/a?b", "<p>é</p>", "y"), (None, "http://example.com/", "<p>é</p>", None),
        (2, None, None, None), (3, "no url\r\nInjected: 1", "", ""), (4, "https://u:p@a.b.example.org/x\ty", "WARC/1.1\r\n\r\n" * 3, "z"), (9, "http://big.example.org/", "x" * 3_000_000, "z"),
        (None, "http://n.example.org/", "alone", None), (7, "http://example.com/a?b", "other", "q"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, file string")


def test_round_trip(spark, sf_dir, odd_pages):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    hot = spark.range(900).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "http://hot.example.org/").otherwise(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".example.org/"), "id")).alias("url"), F.when(F.col("id") % 3 == 1, "same").otherwise(F.concat(F.lit("page "), "id")).alias("html"))
    for p in (pages, odd_pages, hot):
        assert run(p) == brute([(r["page_id"], r["url"], r["html"]) for r in p.collect()])
    assert run(odd_pages, min_revisit_bytes=9) == brute([(r["page_id"], r["url"], r["html"]) for r in odd_pages.collect()], 9)
    assert not run(odd_pages.limit(0))


def test_payloads_and_urls(odd_pages):
    _, records = W.archive_and_read(odd_pages, scratch_path(odd_pages.sparkSession, "warc-test"))
    got = records.collect()
    want = {r["page_id"]: (r["html"] or "").encode() for r in odd_pages.where("page_id is not null").collect()}
    assert all(bytes(r["payload"]) == want[r["page_id"]] for r in got if r["payload"] is not None and r["page_id"] is not None)
    assert {r["url"] for r in got if r["page_id"] == 3} == {"no url%0D%0AInjected: 1"} and {r["url"] for r in got if r["page_id"] == 2} == {None}


def test_keys(spark):
    urls = ["http://www.Example.com:8080/A/b?q=1#top", "https://u:p@x.org", "ftp://h.example.net?z", "not a url", None, "http:///path"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", W.url_key(F.col("u")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in rows] == ["com,example,www)/A/b?q=1", "org,x)", "net,example,h)?z", "not a url", "", "http:///path"]


def test_index_lookup(spark):
    base = scratch_path(spark, "warc-test")
    captures = spark.range(1000).select(F.concat(F.lit("com,h)/"), F.when(F.col("id") < 400, 7).otherwise(F.col("id"))).alias("url_key"), (F.col("id") % 300).alias("page_id"), F.lit("f").alias("file"), (F.col("id") * 10).alias("offset"), F.lit(10).cast("long").alias("length"))
    index = W.CaptureIndex.build(captures, base, block_lines=7)
    got = index.lookup(captures.select("url_key", "page_id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, captures.collect()))
    other = spark.createDataFrame([("com,h)/7", 299), ("com,h)/7", 999), ("aaa", 1), ("zzz", 1), ("com,h)/401", 101), ("com,h)/401", 101)], "url_key string, page_id long")
    assert sorted((r["url_key"], r["page_id"]) for r in index.lookup(other).collect()) == [("com,h)/401", 101), ("com,h)/7", 299)]


def test_archives_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", f"page {i % 3}") for i in range(9)], "page_id long, url string, html string")
    W.write_archives(pages.coalesce(1), f"file://{tmp_path}/w", archive_bytes=900).collect()
    kinds = Counter()
    files = sorted((tmp_path / "w").iterdir())
    for path in files:
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            kinds[fields["WARC-Type"]] += 1
            data = rest[n + 4 :]
    assert kinds == {"warcinfo": len(files), "response": 3, "revisit": 6} and len(files) > 1


def test_damage_is_noticed():
    data = W.record(1, "http://a/", b"payload", None, False)
    headers, payload, size = W.parse(data)
    assert (headers["WARC-Type"], payload, size) == ("response", b"payload", 7)
    with pytest.raises(ValueError):
        W.parse(data[:-6])


def test_very_many_equal_rows(spark, monkeypatch):
    """Rows that are equal in everything, with neither identifier nor URL: as many captures, in time that grows with them."""
    base = scratch_path(spark, "warc-test")
    n = 100_000
    captures = spark.range(n).select(F.lit("").alias("url_key"), F.lit(None).cast("long").alias("page_id"), F.lit("f").alias("file"), F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"))
    index = W.CaptureIndex.build(captures, base)
    began = time.time()
    got = index.lookup(captures.select("url_key", "page_id"))
    assert got.select("offset").distinct().count() == n and time.time() - began < 30
    pages = spark.range(3000).select(F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), (F.col("id") % 2).cast("string").alias("html"))
    assert run(pages) == brute([tuple(r) for r in pages.collect()])
