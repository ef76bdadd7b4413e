"""WARC archives: pages written as gzip members, and a splittable reader over byte ranges.

Writing. Each page is one record in a gzip member of its own. Of pages with equal payloads (SHA-1)
the one with the smallest (page_id, url) is a ``response``; the others ``revisit`` it and hold no
payload. Payloads below ``revisit_bytes`` are responses throughout. Spark's text sink writes the
members, so archives reach any store that Spark writes to and are committed whole or not at all:
a member ends with the high byte of its length, zero below 16 MiB, and that zero is the line
separator. A longer record is followed by an empty member, whose length is zero as well.

Reading. Files are cut into byte ranges of ``split_bytes``. A task looks through its range for
the gzip magic, inflates the start of each candidate and takes it for a record only if a WARC
version line comes out. It owns the records that start inside its range and reads the last of them
past the range's end; what lies inside an owned record is not searched. A range that begins inside
a record which holds an archive itself, stored uncompressed, finds records of that inner archive;
they start before the end of a record of an earlier range and are dropped for it. Records are
inflated in pieces, so memory does not grow with them. ``payloads`` fetches by offset.

Null html is an empty payload. A null page_id or url leaves out its header; null ids are largest.
Of repeated rows one is the response and the others revisit it. Empty tables give an archive
without records, and no rows. A record that is cut off or does not match its digest has ``whole``
false. Only page_id, url and html are read, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplabel.llm.common import new_path, written
from shiplabel.operators.scale import skew_join

MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = zlib.compress(b"", 6, wbits=31)
SPLIT = 32 << 20
# Bytes of a file held at once by a task, and steps in which a record is inflated.
HELD = 4 << 20
FIRST_STEP, STEP = 8 << 10, 256 << 10
# A WARC or HTTP header above this is no header.
HEADER = 1 << 20
# Copies of one payload above which the join deals them to several tasks, and identical rows made by one task.
HOT_COPIES = 10_000
REPEATS = 10_000
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

INDEX = (
    "path string, start long, offset long, length long, record_type string, "
    "headers map<string,string>, payload_bytes long, payload_digest string, whole boolean"
)


def digest_of(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None, url: str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, repr((page_id, url, digest, copy)))}>"


def member(headers: list[tuple[str, str]], http: bytes, payload: bytes, level: int) -> bytes:
    """One record as a gzip member without its last byte, which is the line separator's zero."""
    lines = [*headers, ("Content-Length", str(len(http) + len(payload)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packed = zlib.compress(b"".join([head.encode(), http, payload, b"\r\n\r\n"]), level, wbits=31)
    return packed[:-1] if packed[-1] == 0 else packed + EMPTY_MEMBER[:-1]


def roles(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest, bytes, copy, first_id, first_url and response for each page."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html")).select(
        "*", F.unhex(F.sha1("html")).alias("digest"), F.octet_length("html").cast("long").alias("bytes")
    )
    key = [F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"]
    equal = rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest", "page_id", "url")
    firsts = (
        equal.agg(F.count("*").alias("copies"), F.max("bytes").alias("bytes"))
        .groupBy("digest")
        .agg(F.sum("copies").alias("n"), F.min(F.struct(*key, "copies", "bytes")).alias("first"))
        .where("n > 1")
        .select("digest", "n", F.struct("first.page_id", "first.url", "first.copies", "first.bytes").alias("first"))
    )
    firsts = written(firsts, "payloads")
    joined = skew_join(
        rows, firsts, ["digest"], "left", ["page_id", "url"], firsts.select("digest", F.col("n").alias("_rows")), HOT_COPIES
    )
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    response = F.col("n").isNull() | is_first
    out = joined.select(
        "page_id",
        "url",
        F.when(response, F.col("html")).alias("html"),
        "digest",
        "bytes",
        F.lit(0).cast("long").alias("copy"),
        F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
        response.alias("response"),
        (is_first & (F.col("first.copies") > 1)).alias("repeated"),
    )
    repeated = firsts.where("first.copies > 1")
    if repeated.isEmpty():
        return out.drop("repeated")
    # Rows that are equal throughout cannot be told apart: one stays, the others are made from their number.
    again = F.expr(f"explode(sequence(1L, first.copies - 1, {REPEATS}L))")
    copies = (
        repeated.select("digest", "first", again.alias("low"))
        .repartition("digest", "low")
        .select(
            F.col("first.page_id").alias("page_id"),
            F.col("first.url").alias("url"),
            F.lit(None).cast("binary").alias("html"),
            "digest",
            F.col("first.bytes").alias("bytes"),
            F.explode(F.sequence("low", F.least(F.col("low") + REPEATS, F.col("first.copies")) - 1)).alias("copy"),
            F.col("first.page_id").alias("first_id"),
            F.col("first.url").alias("first_url"),
            F.lit(False).alias("response"),
        )
    )
    kept = out.where(~F.coalesce("repeated", F.lit(False))).drop("repeated")
    once = out.where("repeated").drop("repeated").dropDuplicates(["digest"])
    return kept.unionByName(once).unionByName(copies)


def write(pages: DataFrame, folder: str, revisit_bytes: int = 0, date: str = DATE, level: int = 6) -> None:
    """Write a record for each page into archives below ``folder``, one for each task."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            members, size = [], 0
            for row in zip(*[batch.column(n) for n in names], strict=True):
                page_id, url, html, sha1, n, copy, first_id, first_url, response = (v.as_py() for v in row)
                digest = digest_of(sha1)
                headers = [
                    ("WARC-Type", "response" if response else "revisit"),
                    ("WARC-Record-ID", record_id(page_id, url, digest, copy)),
                    ("WARC-Date", date),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if url is not None:
                    headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
                if page_id is not None:
                    headers.append(("Page-Id", str(page_id)))
                if not response:
                    refers_to = record_id(first_id, first_url, digest, 0)
                    headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", refers_to), ("Payload-Length", str(n))]
                    if first_id is not None:
                        headers.append(("Refers-To-Page-Id", str(first_id)))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n"
                members.append(member(headers, http.encode(), html if response else b"", level))
                size += len(members[-1])
                if size > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])
                    members, size = [], 0
            if members:
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    names = ["page_id", "url", "html", "digest", "bytes", "copy", "first_id", "first_url", "response"]
    packed = roles(pages, revisit_bytes).select(*names).mapInArrow(batches, "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(folder)


def opened(path: str) -> io.IOBase | pa.NativeFile:
    """A file by its full path, for reading at any place; also in the object stores Arrow knows."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    store, inside = pa.fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


class Bytes:
    """Slices of a file, read through one held block."""

    def __init__(self, file: io.IOBase | pa.NativeFile) -> None:
        self.file, self.base, self.block = file, 0, b""

    def _hold(self, at: int, n: int) -> None:
        if at < self.base or at + n > self.base + len(self.block):
            self.file.seek(at)
            self.base, self.block = at, self.file.read(max(n, HELD))

    def at(self, at: int, n: int) -> bytes:
        self._hold(at, n)
        return self.block[at - self.base : at - self.base + n]

    def magic(self, at: int, stop: int) -> int:
        """The first place from ``at`` and before ``stop`` where a gzip header starts, else ``stop``."""
        while at < stop:
            self._hold(at, len(MAGIC))
            i = self.block.find(MAGIC, at - self.base)
            if i >= 0:
                return min(stop, self.base + i)
            at = max(at + 1, self.base + len(self.block) - len(MAGIC) + 1)
        return stop


@dataclass
class Record:
    """What is read of one record; ``feed`` takes its inflated bytes in order."""

    keep: bool = False
    head: bytes = b""
    headers: dict[str, str] | None = None
    left: int = 0
    http: bytes | None = None
    n: int = 0
    sha1: object = field(default_factory=hashlib.sha1)
    payload: list[bytes] = field(default_factory=list)
    length: int = 0
    ended: bool = False

    @property
    def plausible(self) -> bool:
        return self.head[:5] == b"WARC/"[: len(self.head)] and (self.headers is not None or len(self.head) <= HEADER)

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.head += data
            at = self.head.find(b"\r\n\r\n")
            if at < 0 or not self.plausible:
                return
            data, self.head = self.head[at + 4 :], self.head[:at]
            lines = self.head.decode("utf-8", "replace").split("\r\n")[1:]
            self.headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            size = self.headers.get("Content-Length", "0")
            self.left = int(size) if size.isdigit() else 0
            self.http = b"" if self.headers.get("Content-Type", "").startswith("application/http") else None
        data = data[: self.left]
        self.left -= len(data)
        if self.http is not None:
            self.http += data
            at = self.http.find(b"\r\n\r\n")
            if at < 0 and len(self.http) <= HEADER:
                return
            data, self.http = self.http[at + 4 :] if at >= 0 else self.http, None
        self.n += len(data)
        self.sha1.update(data)
        if self.keep:
            self.payload.append(data)

    def row(self, path: str, start: int, offset: int) -> tuple:
        """The record as a row of the index. A revisit states its payload's length and digest in its headers."""
        headers = self.headers or {}
        kind = headers.get("WARC-Type")
        digest, n = digest_of(self.sha1.digest()), self.n
        stated = headers.get("WARC-Payload-Digest", "")
        whole = self.ended and self.headers is not None and self.left == 0
        if kind == "revisit":
            digest, n = stated.removeprefix("sha1:"), None
        elif stated.startswith("sha1:"):
            whole = whole and stated == f"sha1:{digest}"
        return path, start, offset, self.length, kind, list(headers.items()), n, digest, whole


def read_record(data: Bytes, at: int, keep: bool = False) -> Record | None:
    """The record in the gzip member at ``at``; None if there is no member or none that starts like a record."""
    record, inflate, place, step = Record(keep), zlib.decompressobj(wbits=31), at, FIRST_STEP
    try:
        while not inflate.eof and (raw := data.at(place, step)):
            place, step = place + len(raw), STEP
            record.feed(inflate.decompress(raw))
            if not record.plausible:
                return None
    except zlib.error:
        place = at + len(MAGIC)
    record.ended = inflate.eof
    record.length = place - len(inflate.unused_data) - at if inflate.eof else place - at
    return record if record.head[:5] == b"WARC/" else None


def owned(file: io.IOBase | pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, Record]]:
    """(offset, record) of the records that start in the range."""
    data = Bytes(file)
    at = data.magic(start, stop)
    while at < stop:
        record = read_record(data, at)
        if record is not None:
            yield at, record
        at = data.magic(at + (record.length if record is not None else 1), stop)


def _index_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


INDEX_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("whole", pa.bool_()),
    ]
)


def index(spark: SparkSession, folder: str, split_bytes: int = SPLIT, pattern: str = "*", open_file: Callable = opened) -> DataFrame:
    """One row for each record of the archives below ``folder``: where it is, its headers, its payload's length and digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    ranges = written(
        files.where("length > 0").select(
            "path", F.col("length").alias("size"), F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start")
        ),
        "ranges",
    )

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in found:
            for path, size, start in zip(*[batch.column(n).to_pylist() for n in ("path", "size", "start")], strict=True):
                with open_file(path) as file:
                    for offset, record in owned(file, start, min(size, start + split_bytes)):
                        rows.append(record.row(path, start, offset))
                        if len(rows) >= 4096:
                            yield _index_batch(rows, INDEX_ARROW)
                            rows = []
        if rows:
            yield _index_batch(rows, INDEX_ARROW)

    # Each range is a task's work, however few bytes the table of ranges has.
    spread = ranges.repartition(max(1, min(ranges.count(), 100_000)))
    return outermost(written(spread.mapInArrow(batches, INDEX), "index"))


def outermost(found: DataFrame) -> DataFrame:
    """``found`` without records that start before the end of a record of an earlier range of the file."""
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        found.groupBy("path", "start")
        .agg(F.max(F.col("offset") + F.col("length")).alias("end"))
        .select("path", "start", F.max("end").over(earlier).alias("end"))
        .where("end > start")
    )
    return found.join(covered, ["path", "start"], "left").where(F.coalesce(F.col("offset") >= F.col("end"), F.lit(True))).drop("end")


def payloads(found: DataFrame, open_file: Callable = opened) -> DataFrame:
    """path, offset and payload of the records in an index, each read at its offset."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                with open_file(path) as file:
                    record = read_record(Bytes(file), offset, keep=True)
                columns = [pa.array([path]), pa.array([offset]), pa.array([b"".join(record.payload)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "offset", "payload"])

    return found.select("path", "offset").mapInArrow(batches, "path string, offset long, payload binary")


def page_records(found: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type and refers_to of the pages in an index; damage is an error."""
    header = lambda name: F.try_element_at("headers", F.lit(name))
    whole = F.when(~F.col("whole"), F.raise_error(F.concat(F.lit("damaged record in "), "path", F.lit(" at "), "offset")))
    return found.where(F.col("record_type").isin("response", "revisit")).select(
        header("Page-Id").cast("long").alias("page_id"),
        header("WARC-Target-URI").alias("url"),
        F.coalesce(whole.cast("long"), F.col("payload_bytes"), header("Payload-Length").cast("long")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        header("Refers-To-Page-Id").cast("long").alias("refers_to"),
        "path",
        "offset",
        "length",
    )


def archived(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 0, split_bytes: int = SPLIT) -> DataFrame:
    """Write ``pages`` to archives (below the shared folder, if none is named) and read them back, a row for each page."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    write(pages, folder, revisit_bytes)
    return page_records(index(spark, folder, split_bytes)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
ranked AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex,
         row_number() OVER same AS place, first_value(page_id) OVER same AS first_id
  FROM p WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1
         AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM ranked
"""
