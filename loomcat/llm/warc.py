"""Operator 10, WARC archives and an external index merge.

``write_archives`` turns pages into WARC/1.1 records and lets Spark's text writer (with ``\\r\\n`` as
line end, so that each record gets its closing blank lines) write them as gzip archives: any file
system, committed once, safe to retry. Equal payloads of ``MIN_REVISIT`` bytes or more are stored once: the
record with the smallest page id is the response, the others are revisits that name it.

``read_archives`` reads the archives back record by record by Content-Length and checks each payload's
digest; it holds one record at a time beside the compressed archive. ``capture_history`` deals the captures to ranges of (URL
key, timestamp, page id) by Spark's range partitioner, so one URL with a third of all captures splits over many ranges. Within a
range, batches of captures are sorted into local runs, and the runs are merged by a k-way loser tree; the number of
runs depends on the size of a range only. Ranges follow each other, so the result is one globally ordered capture history.

Defined results: a null html is an empty payload; a null url is an empty one; line ends in a url are
percent-encoded; rows that repeat a page id are records of their own (all of them responses if theirs is
the smallest id of its payload); a null page id is kept and never referred to when another has the payload; an empty
table gives archives without records and an empty history; other columns are ignored, whatever their names.
A record must fit in a task's memory, a compressed archive in 2 GB: ``write_archives`` bounds its bytes, not only its records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import new_path, written

MIN_REVISIT = 100
CRLF = "\r\n"
FIRST_CAPTURE = 1_704_067_200  # seconds: pages without a capture time get this plus their id
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_ROWS = 50_000
RUN_ROWS = 5_000
ARCHIVE_BYTES = 256 << 20
ENTRY = pa.schema(
    [("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64())]
)
ENTRY_DDL = "url_key string, captured_at string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long"


def records(pages: DataFrame) -> DataFrame:
    """One WARC record (a string without its closing line ends) for each page."""
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    # only payloads that occur again need a partner: one row each, summed before the shuffle
    again = (
        base.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1").select("digest", "first_id")
    )
    typed = base.join(again, "digest", "left").withColumn("refers_to", F.when((F.col("bytes") >= MIN_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    stamp = F.date_format(F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: "), stamp,
        F.lit(f"{CRLF}WARC-Target-URI: "), url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: "), name(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
    )
    return typed.select(F.concat(head, F.octet_length(block).cast("string"), F.lit(CRLF * 2), block, F.lit(CRLF)).alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_archive: int | None = None) -> None:
    """Writes a record for each row of pages (page_id, url, html) into gzip archives under path. Unless a number of records is
    given, it follows from the mean payload, for about ARCHIVE_BYTES before compression."""
    if records_per_archive is None:
        mean = pages.agg(F.avg(F.octet_length(F.coalesce("html", F.lit(""))))).first()[0] or 0.0
        records_per_archive = max(1, int(ARCHIVE_BYTES / (mean + 600)))
    out = records(pages).write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_archive)
    out.option("zlib.compress.level", "BEST_SPEED").text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and query; scheme, port, www and fragment go."""
    rest = url.split("#", 1)[0].split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].split(":", 1)[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + slash + path


def parse_archive(stream, archive: str) -> Iterator[dict]:
    """The captures of one archive, in order, from a stream of its uncompressed bytes. Fails on a damaged record."""
    at = 0
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"{archive}: no record at byte {at}")
        size, head = len(first), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = head["WARC-Type"]
        if stream.read(4) != b"\r\n\r\n" or (kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest)):
            raise ValueError(f"{archive}: damaged record at byte {at}")
        page = lambda x: int(x) if (x := x[len("<urn:page:") : -1]) else None
        url = head["WARC-Target-URI"]
        yield {
            "url_key": url_key(url), "captured_at": head["WARC-Date"], "page_id": page(head["WARC-Record-ID"]), "url": url, "record_type": kind,
            "payload_bytes": length, "payload_digest": digest, "refers_to": page(head["WARC-Refers-To"]) if kind == "revisit" else None, "archive": archive, "offset": at,
        }
        at += size + 2 + len(block) + 4


def in_batches(rows: Iterator[dict], schema: pa.Schema, most: int = RUN_ROWS) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, most)):
        yield pa.RecordBatch.from_pylist(some, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under path; each archive's payloads stay in its task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 20)
                yield from in_batches(parse_archive(stream, name.as_py().rpartition("/")[2]), ENTRY)

    return files.mapInArrow(run, ENTRY_DDL)


def sort_key(row: dict) -> tuple:
    return row["url_key"], row["captured_at"], -1 if row["page_id"] is None else row["page_id"]


class LoserTree:
    """k-way merge of sorted runs: inner nodes keep the losers of the matches below them, so the next
    winner costs one match for each level."""

    def __init__(self, runs: list[Iterator], key=lambda x: x):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.head = [self._next(i) for i in range(self.k)]
        self.loser = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int):
        x = next(self.runs[i], None)
        return None if x is None else (self.key(x), i, x)

    def _less(self, a: int, b: int) -> bool:
        return self.head[b] is None or (self.head[a] is not None and self.head[a][:2] <= self.head[b][:2])

    def _play(self, i: int) -> None:
        at = (i + self.k) // 2
        while at:
            if self.loser[at] == -1:
                self.loser[at] = i
                return
            if not self._less(i, self.loser[at]):
                i, self.loser[at] = self.loser[at], i
            at //= 2
        self.loser[0] = i

    def __iter__(self):
        while self.k and self.head[self.loser[0]] is not None:
            i = self.loser[0]
            yield self.head[i][2]
            self.head[i] = self._next(i)
            at = (i + self.k) // 2
            while at:
                if not self._less(i, self.loser[at]):
                    i, self.loser[at] = self.loser[at], i
                at //= 2
            self.loser[0] = i


def merge_ranges(captures: DataFrame, ranges: int) -> DataFrame:
    """The captures in global order: (range, at, ...), at: position within the range."""
    placed = pa.schema([("range", pa.int64()), ("at", pa.int64()), *ENTRY])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        runs = []
        for batch in batches:
            for lo in range(0, batch.num_rows, RUN_ROWS):
                runs.append(sorted(batch.slice(lo, RUN_ROWS).to_pylist(), key=sort_key))
        merged = LoserTree(runs, sort_key)
        yield from in_batches(({"range": number, "at": at, **row} for at, row in enumerate(merged)), placed)

    dealt = captures.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
    return dealt.mapInArrow(merge, f"range long, at long, {ENTRY_DDL}")


def capture_history(spark: SparkSession, path: str, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """The globally ordered captures of all archives under path, with their global position."""
    captures = written(read_archives(spark, path), "captures")
    merged = written(merge_ranges(captures, max(1, -(-captures.count() // rows_per_range))), "history")
    # a row a range: how many captures lie in the ranges before it
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = merged.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return merged.join(starts, "range").withColumn("position", F.col("before") + F.col("at")).drop("before", "range", "at")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    history = capture_history(spark, path)
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op10_warc": op10_warc}
ORACLE = {
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM f
"""
}
