"""WARC archives with a two-level capture index.

*Archives.*  Each task writes its pages as WARC 1.1 records, every record a gzip
member of its own, into archives of about ``archive_bytes`` in the shared
folder, and reports file, offset and length of each.  A file's name carries the
task attempt; what a lost attempt has left behind is in no report.

*Revisits.*  Pages with equal payloads (SHA-1 and SHA-256 of the whole payload)
are one group; digests are grouped, payloads stay where they are.  The page with the largest identifier is a response, the others
are revisit records that refer to it.  Payloads below ``min_revisit_bytes``
are always responses.

*Index.*  Captures are dealt by ranges of (reversed-host URL key, page) and
sorted; each range becomes one file of gzip blocks of ``block_lines`` lines.
First level: for each file, the first line of every block with the block's
place (the sparse directory, kept beside the blocks).  Second level: one row
per file with its first line.  ``lookup`` searches the files' first lines, then
one directory, by bisection, reads one block by its byte range and bisects it;
queries are sorted, so that neighbours share what was read last.  Equal queries
are one, with a number of captures to take; beyond ``EQUAL_QUERIES`` they are
parted, and each part goes straight to its first line, as all blocks but a
file's last have the same number of lines.

*Reading.*  Captures found are sorted by archive and offset and read by byte
range; payload digests are verified.

Defined cases.  Null html is an empty payload, a null URL has the empty key and
no target header.  A null page identifier counts as smaller than any other, and
if it is the group's only one, the page is a response.  Rows that repeat the
response's page identifier and payload are responses each; every input row has
a record of its own.  An empty table gives no archives and an empty result.
Extra columns are never looked at.  Very large pages are one record, held once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, map_arrow, meet, quoted, scratch_path, staged, table, tagged

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
MIN_REVISIT_BYTES = 0
#: So many equal queries are answered in one go.
EQUAL_QUERIES = 10_000

LINE = "url_key string, page_id long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Reversed host, then path and query: ``com,example,www)/a?b=1``.  Scheme, user, port and fragment are left out, the host is lower-cased."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"#.*$", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(host != "", key).otherwise(url), F.lit(""))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers of a record, its payload (empty for a revisit), the payload's full length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return headers, payload, length


def _grouped(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit_bytes: int) -> DataFrame:
    """page_id, url, url_key, html, response_id, revisit."""
    tag = fresh("wc_tag", pages.columns)
    rows = tagged(pages, tag)
    payload = F.coalesce(quoted(html_col), F.lit("")).cast("binary")
    digests = staged(rows.select(quoted(tag).alias("tag"), quoted(id_col).cast("long").alias("page_id"), F.octet_length(payload).alias("bytes"), F.sha1(payload).alias("sha1"), F.sha2(payload, 256).alias("sha2")), "warc-digests")
    groups = staged(digests.groupBy("sha1", "sha2").agg(F.max("page_id").alias("response_id")), "warc-groups")
    revisit = ~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("bytes") >= min_revisit_bytes)
    decided = staged(digests.join(groups, ["sha1", "sha2"]).select("tag", "response_id", revisit.alias("revisit")), "warc-decided")
    own = rows.select(quoted(tag).alias("tag"), quoted(id_col).cast("long").alias("page_id"), quoted(url_col).alias("url"), payload.alias("html"))
    return meet(own, decided, "tag").select("page_id", "url", url_key(F.col("url")).alias("url_key"), "html", "response_id", "revisit")


def write_archives(pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the archives below ``base``.  Returns url_key, page_id, file, offset, length: the captures."""
    rows = _grouped(pages, id_col, url_col, html_col, min_revisit_bytes)
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:page:info>\r\nWARC-Date: " + DATE.encode() + b"\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(base)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, name, at, n = None, "", 0, 0
        try:
            for b in batches:
                done = []
                for page_id, url, key, html, response_id, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{n:04d}.warc.gz"
                        out, at, n = fs.open_output_stream(f"{root}/{name}", compression=None), 0, n + 1
                        at += out.write(gzip.compress(info, 4, mtime=0))
                    size = out.write(gzip.compress(record(page_id, url, html, response_id, revisit), 4, mtime=0))
                    done.append((key, page_id, name, at, size))
                    at += size
                if done:
                    cols = list(zip(*done, strict=True))
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["url_key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return map_arrow(rows, write, LINE)


def _place(key: str, page_id: int | None) -> tuple[bytes, int]:
    """Sort key of a line: as Spark orders strings (by UTF-8) and numbers (null first)."""
    return key.encode("utf-8", "surrogatepass"), -(1 << 63) - 1 if page_id is None else page_id


class CaptureIndex:
    """The two-level index below ``base``; ``files``: one row per index file (file, first_key, first_page, lines)."""

    def __init__(self, spark: SparkSession, base: str, files: DataFrame, block_lines: int = BLOCK_LINES):
        self.spark, self.base, self.block_lines = spark, base, block_lines
        # one row for each partition of the sorted captures, however many lines these hold
        rows = files.collect()
        self.files = sorted((_place(r["first_key"], r["first_page"]), r["file"], r["lines"]) for r in rows)

    @classmethod
    def build(cls, captures: DataFrame, base: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
        spark = captures.sparkSession
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col("url_key").asc(), F.col("page_id").asc_nulls_first(), F.col("file").asc(), F.col("offset").asc()]

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = pafs.FileSystem.from_uri(base)
            fs.create_dir(root, recursive=True)
            task = TaskContext.get()
            name, out, directory, lines, at, n = f"{task.partitionId():06d}-{task.taskAttemptId()}", None, [], [], 0, 0

            def flush() -> None:
                nonlocal out, at, lines, n
                if lines:
                    if out is None:
                        out = fs.open_output_stream(f"{root}/{name}.cdx.gz", compression=None)
                    size = out.write(gzip.compress("\n".join(map(json.dumps, lines)).encode(), 6, mtime=0))
                    directory.append([*lines[0][:2], at, size])
                    at, n, lines = at + size, n + len(lines), []

            for b in batches:
                for line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    lines.append(line)
                    if len(lines) == block_lines:
                        flush()
            flush()
            if out is not None:
                out.close()
                with fs.open_output_stream(f"{root}/{name}.dir", compression=None) as f:
                    f.write(zlib.compress(json.dumps(directory).encode()))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([directory[0][0]], pa.string()), pa.array([directory[0][1]], pa.int64()), pa.array([n], pa.int64())], ["file", "first_key", "first_page", "lines"])

        dealt = captures.repartitionByRange(n, *order).sortWithinPartitions(*order)
        files = staged(map_arrow(dealt, write, "file string, first_key string, first_page long, lines long"), "warc-index-files")
        return cls(spark, base, files, block_lines)

    def lookup(self, queries: DataFrame) -> DataFrame:
        """queries: url_key, page_id.  A row for each query and its capture: url_key, page_id, file, offset, length.  Queries without a capture give no row; the k-th of equal queries takes the k-th of equal captures."""
        base, files, block_lines = self.base, self.spark.sparkContext.broadcast(self.files), self.block_lines

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = pafs.FileSystem.from_uri(base)
            firsts = [f[0] for f in files.value]
            opened: dict = {"file": -1, "block": None, "directory": [], "places": [], "lines": []}

            def open_file(k: int) -> None:
                if opened["file"] != k:
                    with fs.open_input_file(f"{root}/{files.value[k][1]}.dir") as f:
                        directory = json.loads(zlib.decompress(f.read()))
                    opened.update(file=k, block=None, directory=directory, places=[_place(*d[:2]) for d in directory])

            def open_block(k: int, b: int) -> list[tuple[bytes, int]]:
                open_file(k)
                if opened["block"] != b:
                    _, _, at, size = opened["directory"][b]
                    with fs.open_input_file(f"{root}/{files.value[k][1]}.cdx.gz") as f:
                        data = gzip.decompress(f.read_at(size, at))
                    lines = [json.loads(x) for x in data.decode().split("\n")]
                    opened.update(block=b, lines=lines, at=[_place(*x[:2]) for x in lines])
                return opened["at"]

            def first(place: tuple[bytes, int]) -> tuple[int, int] | None:
                """File and line number of the first line with that place."""
                # it may be in the block, and the file, before the one that begins with it
                k = max(0, bisect_left(firsts, place) - 1)
                while k < len(firsts):
                    open_file(k)
                    b = max(0, bisect_left(opened["places"], place) - 1)
                    while b < len(opened["places"]):
                        at = open_block(k, b)
                        i = bisect_left(at, place)
                        if i < len(at):
                            return (k, b * block_lines + i) if at[i] == place else None
                        b += 1
                    k += 1
                return None

            def captures(place: tuple[bytes, int], skip: int, most: int) -> Iterator[list]:
                """Up to ``most`` lines with that place, after the first ``skip`` of them."""
                if (at := first(place)) is None:
                    return
                k, n = at[0], at[1] + skip
                while most and k < len(firsts):
                    if n >= files.value[k][2]:
                        k, n = k + 1, n - files.value[k][2]
                        continue
                    places, i = open_block(k, n // block_lines), n % block_lines
                    z = min(bisect_right(places, place), i + most)
                    if z <= i:
                        return
                    yield from opened["lines"][i:z]
                    n, most = n + z - i, most - (z - i)

            def rows(found: list) -> pa.RecordBatch:
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["url_key", "page_id", "file", "offset", "length"])

            for b in batches if firsts else ():
                found = []
                for key, page_id, skip, most in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for line in captures(_place(key, page_id), skip, most):
                        found.append(line)
                        if len(found) == EQUAL_QUERIES:
                            yield rows(found)
                            found = []
                if found:
                    yield rows(found)

        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        once = queries.groupBy("url_key", "page_id").agg(F.count(F.lit(1)).alias("n"))
        parts = once.withColumn("skip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(EQUAL_QUERIES).cast("long"))))
        parts = parts.select("url_key", "page_id", "skip", F.least(F.col("n") - F.col("skip"), F.lit(EQUAL_QUERIES)).alias("most"))
        order = [F.col("url_key").asc(), F.col("page_id").asc_nulls_first(), F.col("skip").asc()]
        return map_arrow(parts.repartitionByRange(n, *order).sortWithinPartitions(*order), search, LINE)


def read_records(captures: DataFrame, base: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for revisits): by byte ranges, in the order of the archives."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(urn: str | None) -> int | None:
        said = (urn or "<urn:page:null>")[10:-1]
        return None if said == "null" else int(said)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(base)
        name, f = None, None
        for whole in batches:
            for a in range(0, whole.num_rows, 64):
                got = []
                for file, offset, length in zip(*(whole.slice(a, 64).column(c).to_pylist() for c in (0, 1, 2)), strict=True):
                    if file != name:
                        if f is not None:
                            f.close()
                        name, f = file, fs.open_input_file(f"{root}/{file}")
                    headers, payload, size = parse(gzip.decompress(f.read_at(length, offset)))
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
                        raise ValueError(f"{file} at {offset}: the payload is not what its digest says")
                    got.append((number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, number(headers.get("WARC-Refers-To")), size, digest, payload if kind == "response" else None))
                cols = list(zip(*got, strict=True))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
        if f is not None:
            f.close()

    rows = captures.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return map_arrow(rows, read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def archive_and_read(pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **kw) -> tuple[CaptureIndex, DataFrame]:
    """Write archives and index below ``base``; look every page up and read its record."""
    captures = staged(write_archives(pages, f"{base}/archive", id_col, url_col, html_col, **kw), "warc-captures")
    index = CaptureIndex.build(captures, f"{base}/index")
    queries = pages.select(url_key(quoted(url_col)).alias("url_key"), quoted(id_col).cast("long").alias("page_id"))
    return index, read_records(index.lookup(queries), f"{base}/archive")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = archive_and_read(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base 32 of SHA-1: 40 hexadecimal digits are 8 groups of 5, each of 4 characters of 5 bits.
OP9_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS top FROM p GROUP BY html)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (5 * (3 - i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM p JOIN g USING (html)
"""
