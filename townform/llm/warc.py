"""WARC archives: writer and sequential reader.

An archive is a chain of gzip members, one for each record. Spark's text sink writes the archives,
one file each, to any file system it knows, under its commit protocol; so a lost executor leaves no
half archive behind. (The sink ends a file with one zero byte, which gzip readers take as padding.)

The reader goes through an archive in steps of ``STEP`` bytes: it inflates one member after the
other with a fresh ``zlib`` object, takes the record header up to the empty line, then as many bytes
as ``Content-Length`` says, and compares block and payload with their SHA-1 digests.

Payloads of at least ``REVISIT_BYTES`` that several pages share are written once, in the record of
the page with the largest identifier; the others become ``revisit`` records, which carry the HTTP
header (with the payload's length) and the digest, and refer to the first.

Cases: null html is an empty payload; a null url leaves out the target; a null identifier is written
and read as null and is smaller than any other. Rows repeated with the same identifier and payload
are each a response. Control characters and blanks in urls are percent-encoded. A page larger than
``ARCHIVE_BYTES`` has an archive of its own. Broken framing stops the job; a digest that differs is
reported in ``valid``. Empty tables give an archive folder without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townform.llm.tables import shared_folder, staged

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 4 << 20
STEP = 1 << 16
DATE = "1970-01-01T00:00:00Z"
RECORDS = ("page_id long, uri string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary, valid boolean")


def label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           date: str = DATE) -> bytes:
    """One gzip member with a response or revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {name(refers_to)}"]
    head += [f"WARC-Block-Digest: {label(block)}", f"WARC-Payload-Digest: {label(payload)}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def members(archive: bytes, step: int = STEP) -> Iterator[bytes]:
    """Inflate the members of an archive one after the other, ``step`` bytes at a time."""
    at, view = 0, memoryview(archive)
    while at < len(view):
        if view[at] == 0:  # padding
            at += 1
            continue
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("archive ends inside a member")
            piece = view[at:at + step]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def parse(member: bytes) -> tuple:
    """A row of ``RECORDS`` from one record."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = headers(head)
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("content length does not fit the record")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    said = fields["warc-payload-digest"]
    valid = fields["warc-block-digest"] == label(block) and (revisit or label(payload) == said)
    length = int(headers(http)["content-length"]) if revisit else len(payload)
    return (number("warc-record-id"), fields.get("warc-target-uri"), length, base64.b32decode(said[5:]).hex(), fields["warc-type"],
            number("warc-refers-to"), None if revisit else payload, valid)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for batch in batches:
        for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
            parts.append(record(page_id, url, (html or "").encode(), refers_to, revisit))
            size += len(parts[-1])
            if size >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])
                parts, size = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split(" ")[0] for x in RECORDS.split(",")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    for batch in batches:
        for archive in batch.column(0):
            rows, size = [], 0
            for member in members(memoryview(archive.as_buffer())):
                rows.append(parse(member))
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield out(rows)
                    rows, size = [], 0
            yield out(rows)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per row to archives in ``folder``."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    body = F.coalesce("html", F.lit(""))
    sized = rows.withColumn("sha", F.sha1(body.cast("binary"))).withColumn("bytes", F.octet_length(body).cast("long"))
    first = (staged(sized.select("id", "sha", "bytes"), "payloads").where(F.col("bytes") >= REVISIT_BYTES).groupBy("sha", "bytes")
             .agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n"))
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    (sized.join(first, ["sha", "bytes"], "left")
     .select("id", "url", "html", F.when(revisit, F.col("keep")).alias("refers_to"), revisit.alias("revisit"))
     .mapInArrow(_write, "archive binary")
     .select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(folder))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``."""
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
