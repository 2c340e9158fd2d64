"""WARC archives with repeated payloads written once.

Headers (page id, digest, length) are shuffled by payload digest, pre-aggregated,
to find the original of each group of equal payloads; every page then meets its
original through a salted join, and archives are written in which the original
is a response record and each other page a revisit record with fresh headers
that refer to it. Payloads themselves are moved once.

Files are WARC 1.1, one gzip member for each record, so that records can be sought,
and are closed once they hold file_bytes (compressed): neither the writer nor the
reader holds more than one file and one record. The reader honours Content-Length,
whatever the payloads hold, and takes archives of one member too.

Defined cases: a null html is an empty payload; a null url has no target header;
payloads under min_bytes are never made revisits; rows with a null page_id come
last in a group, and refers_to is null where the original's id is null; where
the original's row is repeated, each of its rows is a response; an empty table
gives an empty archive, which reads as no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, salted_left_join, small_batches

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
#: Compressed bytes after which a file is closed; bytes that the reader inflates at once.
FILE_BYTES, PIECE = 64 << 20, 1 << 14
SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def base32(hex40: Column) -> Column:
    """Base32 of a SHA-1 given in hex: each 20 bits make four letters."""
    parts = [F.lpad(F.conv(F.substring(hex40, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, n, record_type, refers_to and refers_url of each row of pages."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.regexp_replace("url", r"[\r\n]", "").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("n", F.octet_length("payload").cast("long"))
    headers = pages.select("page_id", F.regexp_replace("url", r"[\r\n]", "").alias("url"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= min_bytes)
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    groups = headers.groupBy("digest").agg(F.count("*").alias("rows"), first.alias("first")).where("rows > 1")
    groups = groups.select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"))
    rows = salted_left_join(rows, groups, ["digest"], ["page_id", "url"])
    revisit = (F.col("n") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    of_first = [F.when(revisit, F.col(c)).alias(name) for c, name in (("first", "refers_to"), ("first_url", "refers_url"))]
    return rows.select("page_id", "url", "payload", base32(F.col("digest")).alias("digest"), "n", F.when(revisit, "revisit").otherwise("response").alias("record_type"), *of_first)


def _packed(file_bytes: int):
    """Records (head, block) -> whole archives, each without its last byte.

    An archive ends with an empty member, whose last byte is 0: the text writer
    adds it as the end of its line, so that a line is an archive of any bytes.
    """

    def packed(parts):
        members, size = [], 0
        archive = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join([*members, gzip.compress(b"", mtime=0)])[:-1]], pa.binary())], ["archive"])
        for part in parts:
            for head, block in zip(part.column(0), part.column(1), strict=True):
                members.append(gzip.compress(head.as_py().encode() + block.as_py().encode() + b"\r\n\r\n", 6, mtime=0))
                size += len(members[-1])
                if size >= file_bytes:
                    yield archive()
                    members, size = [], 0
        if members:
            yield archive()

    return packed


def write(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write one record for each row of pages into gzipped archives under path."""
    small_batches(pages.sparkSession)
    rows = resolve(pages, min_bytes)
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    page = F.col("page_id").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("n").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(c, F.lit("")), F.lit(">"))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(page)),
        line("WARC-Date", now),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to").cast("string")))),
        line("WARC-Refers-To-Target-URI", F.col("refers_url")),
        line("WARC-Refers-To-Date", F.when(revisit, now)),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    archives = rows.select(head.alias("head"), block.alias("block")).mapInArrow(_packed(file_bytes), "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _inflated(archive: bytes):
    """The bytes of all gzip members, a piece at a time."""
    at, view = 0, memoryview(archive)
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a member")
            piece = view[at : at + PIECE]
            out = member.decompress(piece)
            at += len(piece) - len(member.unused_data)
            if out:
                yield out


def records(archive: bytes):
    """(headers, block) of each record of an archive, gzipped or not."""
    source = _inflated(archive) if archive[:2] == b"\x1f\x8b" else iter((archive,))
    held = bytearray()
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if (more := next(source, None)) is None:
                if held:
                    raise ValueError("the archive ends inside a record")
                return
            held += more
        lines = bytes(held[:end]).split(b"\r\n")
        if not re.match(rb"WARC/1\.[01]$", lines[0]):
            raise ValueError("no WARC record where one should start")
        headers = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
        n = end + 4 + int(headers["content-length"])
        while len(held) < n + 4:
            if (more := next(source, None)) is None:
                raise ValueError("the archive ends inside a record")
            held += more
        yield headers, bytes(held[end + 4 : n])
        del held[: n + 4]


NAMES = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
KINDS = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())


def _parsed(parts):
    number = lambda urn: int(m[1]) if (m := re.search(rf"{ID}(-?\d+)>", urn)) else None

    def checked(headers, block):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
        if headers["warc-type"] == "response":
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own != digest or size != len(payload):
                raise ValueError(f"damaged record {headers['warc-record-id']}")
        return number(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], size, digest, number(headers.get("warc-refers-to", ""))

    for part in parts:
        for archive in part.column(0):
            found = records(archive.as_py())
            while rows := [checked(*x) for x in islice(found, 5000)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under path; responses are checked against their digests."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(_parsed, SCHEMA)


def archive_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages to fresh archives in the shared folder, and read these back."""
    path = fresh(pages.sparkSession, "archive")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
