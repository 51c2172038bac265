"""WARC archives of pages, and their index by external merge.

Writing: payload digests are aggregated first (one row for each payload that
occurs again), then every page becomes one record in one pass: the page with the
largest id among equal payloads is a ``response``, the others ``revisit`` it and
carry no payload. Each task sorts its captures by URL key and time and writes them
as gzipped WARC text files with Spark's own writer (record end as line end), so a
lost task is simply written again.

Reading: files are read as binary and parsed by their lengths, a megabyte at a
time. Each file gives a run of the index, sorted as the file is. The runs are
dealt out by ranges of (URL key, time, page), and each task merges its part of
every run with a loser tree: the result is ordered over the whole archive, and one
URL with very many captures is still spread over tasks by time.

A null payload is empty; null ids rank below all others, and a null id is written
as ``-``. Rows that repeat an id and a payload are responses all, if that id is
the largest. The capture time is a column if given, else made from the id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.session import materialise, shared_folder

RECORD_END = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
#: Rows of repeated payloads that may be broadcast (about 5 MB); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 40 bits make 8 characters."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _RFC4648)


def url_key(url: Column) -> Column:
    """Host names from the right, then path and query, in lower case: ``com,example)/path``."""
    plain = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\d*\.)?([^/?#:]*)", 1)
    rest = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.when(host == "", plain).otherwise(key)


def _time_of(page_id: Column) -> Column:
    """A time within 30 years of 2000 for an integer id."""
    seconds = F.pmod(F.coalesce(page_id.cast("long"), F.lit(0)), F.lit(946_080_000))
    moment = F.expr("timestamp_ntz'2000-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("Z"))


def _records(pages: DataFrame) -> DataFrame:
    """key, time and record text of pages (page_id, url, html, captured)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    whole = (
        pages.withColumn("digest", base32_sha1(payload))
        .withColumn("size", F.octet_length(F.coalesce("html", F.lit(""))))
        .withColumn("url", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20"))
        .withColumn("key", url_key(F.col("url")))
        .withColumn("time", F.coalesce("captured", _time_of(F.col("page_id"))))
    )
    again = materialise(
        whole.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    whole = whole.join(again, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit("\r\n\r\n")
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), ident, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), "time"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
                F.lit("WARC-Refers-To: <urn:page:"),
                "first",
                F.lit(">"),
            ),
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length),
    ]
    head = F.concat_ws("\r\n", *lines)  # leaves out what is null
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce("html", F.lit("")))
    return whole.select("key", "time", "page_id", F.concat(head, F.lit("\r\n\r\n"), http, body).alias("value"))


def write(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    captured: str | None = None,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record for each page under ``path``, each file sorted by URL key and time."""
    source = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        (F.col(captured) if captured else F.lit(None)).cast("string").alias("captured"),
    )
    (
        _records(source)
        .sortWithinPartitions("key", "time", "page_id")
        .select("value")
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class _Stream:
    """Reads a gzipped archive by delimiter and by length, a megabyte at a time."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.step, self.at = memoryview(data), step, 0
        self.unzip, self.held, self.start = zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        while self.at < len(self.data) or self.unzip.unconsumed_tail:
            part = self.unzip.unconsumed_tail or self.data[self.at : self.at + self.step]
            if not self.unzip.unconsumed_tail:
                self.at += len(part)
            got = self.unzip.decompress(part, 4 * self.step)
            if self.unzip.eof and self.unzip.unused_data:
                self.at -= len(self.unzip.unused_data)
                self.unzip = zlib.decompressobj(31)
            if got:
                self.held += got
                return True
        return False

    def _drop(self, n: int) -> None:
        del self.held[:n]
        self.start += n

    def until(self, end: bytes) -> bytes | None:
        """Up to ``end``, which is passed over; None at the end of the archive."""
        seen = 0
        while (found := self.held.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.held)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.held[:found])
        self._drop(found + len(end))
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        self._drop(n)
        return out


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


_ID = re.compile(r"<urn:page:(.*)>")


def _ident(value: str | None) -> int | None:
    match = _ID.fullmatch(value or "")
    return int(match[1]) if match and match[1] != "-" else None


def parse(data: bytes) -> Iterator[tuple]:
    """Offset, URL, time, page, bytes, digest, type, response and payload of every record."""
    stream = _Stream(data)
    while True:
        offset = stream.start
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        fields = _headers(head)
        http, _, payload = stream.take(int(fields["content-length"])).partition(b"\r\n\r\n")
        size = int(_headers(http)["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response":
            read = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if (len(payload), read) != (size, digest):
                raise ValueError(f"record at {offset}: payload and headers differ")
        yield (
            offset,
            fields["warc-target-uri"],
            fields["warc-date"],
            _ident(fields["warc-record-id"]),
            size,
            digest,
            fields["warc-type"],
            _ident(fields.get("warc-refers-to")),
            payload,
        )
        stream.take(4)


INDEX = (
    "run string, offset bigint, key string, time string, page_id bigint, url string, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """An index row for each record; the rows of one file, a run, come in its order."""
    parsed = T._parse_datatype_string(INDEX.replace("key string, ", ""))
    arrow = to_arrow_schema(parsed)

    def index(batches):
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                run, rows = name.rpartition("/")[2], []
                for offset, url, time, page, size, digest, kind, first, _ in parse(data.as_py()):
                    rows.append((run, offset, time, page, url, size, digest, kind, first))
                    if len(rows) == 5000:
                        yield _batch(rows, arrow)
                        rows = []
                if rows:
                    yield _batch(rows, arrow)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(index, parsed).withColumn("key", url_key(F.col("url")))
    return found.select(*T._parse_datatype_string(INDEX).names)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class LoserTree:
    """Merges sorted runs; each inner node keeps the loser of its match, so a row costs log2(k) matches."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.places = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        k = len(runs)
        self.losers = [-1] * k
        # play the leaves (k .. 2k-1) up; a node keeps the loser and passes the winner on
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def __iter__(self):
        k = len(self.runs)
        while k and self.heads[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.places[run]]
            self.places[run] += 1
            at = self.places[run]
            self.heads[run] = self.key(self.runs[run][at]) if at < len(self.runs[run]) else None
            node, winner = (run + k) // 2, run
            while node:
                if self._beats(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.winner = winner


def merge_runs(runs: DataFrame) -> DataFrame:
    """Capture histories in the order of (key, time, page_id) over all partitions.

    A task holds its range of the index, without payloads, while it merges.
    """
    names = runs.columns
    places = [names.index(c) for c in ("key", "time", "page_id", "offset")]
    run_at = names.index("run")
    arrow = to_arrow_schema(runs.schema)

    def key(row):
        k, t, p, o = (row[i] for i in places)
        return k, t, p is not None, p or 0, o

    def merge(batches):
        parts: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.setdefault(row[run_at], []).append(row)
        rows = []
        for row in LoserTree([parts[r] for r in sorted(parts)], key):
            rows.append(row)
            if len(rows) == 5000:
                yield _batch(rows, arrow)
                rows = []
        yield _batch(rows, arrow)

    # a shuffle may bring a run's part in pieces: they are put in order by file and place
    ranged = runs.repartitionByRange("key", "time", "page_id").sortWithinPartitions("run", "offset")
    return ranged.mapInArrow(merge, runs.schema)


def archive_index(pages: DataFrame, path: str | None = None, **names) -> DataFrame:
    """Write ``pages`` as an archive (in the shared folder by default), read it back, merge its index."""
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, **names)
    return merge_runs(materialise(read_runs(spark, path)))
