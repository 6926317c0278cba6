"""WARC archives: a writer, and a reader that salvages what it can.

Writing.  ``plan_records`` decides for each page whether it is stored whole
(``response``) or refers to a page with the same payload (``revisit``): the
largest ``page_id`` of every payload, keyed by SHA-1, length and a 64-bit
hash, is an ordinary aggregate, and ``hot_keys.left_join`` brings it back to
the pages, so a payload that a third of all pages share is spread over all
tasks.  ``write_archives`` builds the records where the rows are.  Each task
fills archives of about ``archive_bytes`` and Spark's text writer commits
them, one archive a file: an archive is one row of raw bytes, and the line
separator is what ends it - an empty gzip member, as an end mark, or the last
CRLF CRLF of an uncompressed archive.  So archives are written by Spark's own
committer, to whatever file system Spark can write, and a lost task leaves
nothing behind.

Reading.  ``read_archives`` scans each archive from its first byte.  A record
counts only if it passes all checks: its gzip member inflates with the right
CRC and length; version line, header lines and ``Content-Length`` agree with
the bytes there; the block digest and, for a response, the payload digest
agree.  After a failed check the reader searches for the next offset at which
a whole member (gzip magic) or, in uncompressed bytes, a whole record (version
line) is valid, goes on from there, and logs the bytes between as a
quarantined gap.  An archive whose members end without the end mark is logged
as cut off, with a gap of no bytes.  Rows of both kinds come out of one pass:
``kind`` is ``record`` or ``gap``.

In an uncompressed archive whose damaged record quotes a whole valid WARC
record in its payload, that quoted record is salvaged as a record, and damage
to a header line that no digest covers passes unseen; compressed archives have
neither weakness.

Memory.  A task holds one archive (``archive_bytes``, or its largest record)
and the inflated bytes of one member.

Defined results: a null payload is empty; empty payloads are equal payloads
like any other; null page ids count as smaller than any id, and where a
payload has only those, all its records are responses; rows with one id and
one payload are the same capture, so if they hold the largest id each is
written as a response; a null URL has no ``WARC-Target-URI``, and control and
non-ASCII characters of a URL are percent-encoded; an empty table gives an
archive folder without archives and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.llm import hot_keys
from pomelo.llm.common import checkpointed
from pomelo.session import scratch_path

ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
END_MEMBER = bytes.fromhex("1f8b08000000000000ff0300" + "00" * 8)     # an empty gzip member
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_SAFE_IN_URL = "".join(map(chr, range(0x21, 0x7f)))


# -- records --------------------------------------------------------------------

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A whole record, its block digest and length included."""
    lines = [*headers, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    """``data`` as one gzip member (no time stamp, so equal records give equal bytes)."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The response or revisit record of a page; a revisit keeps the HTTP header and leaves the payload out."""
    digest = base32_sha1(payload)
    kind = "revisit" if revisit else "response"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}:{kind}:{digest}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=_SAFE_IN_URL)))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest)]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}:response:{digest}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(headers, http if revisit else http + payload)


def info_record() -> bytes:
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:archive:info>"), ("WARC-Date", DATE),
                   ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


# -- reading with salvage ---------------------------------------------------------

class Damaged(ValueError):
    """A check that failed."""


class Record:
    """A record that passed its checks: headers by lower-case name, block, and where it ends."""

    def __init__(self, headers: dict[str, str], block: bytes, end: int):
        self.headers, self.block, self.end = headers, block, end

    def payload(self) -> bytes | None:
        """The body of an HTTP response block."""
        if self.headers.get("warc-type") != "response":
            return None
        return self.block.partition(END)[2]


def _expect_digest(what: str, stated: str | None, data: bytes) -> None:
    if stated is not None and stated.startswith("sha1:") and stated[5:].upper() != base32_sha1(data):
        raise Damaged(what)


def parse_record(data: bytes, at: int) -> Record:
    """The record that begins at ``data[at]``, or ``Damaged``."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = data.find(END, version.end() - 2)
    if stop < 0:
        raise Damaged("header without end")
    headers: dict[str, str] = {}
    last = None
    for line in data[version.end():stop].split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:                     # a folded line
            headers[last] = (headers[last] + " " + text.strip()).strip()
            continue
        name, colon, value = text.partition(":")
        if not colon or not name.strip():
            raise Damaged("header line")
        last = name.strip().lower()
        headers[last] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or not headers.get("warc-type"):
        raise Damaged("header fields")
    begin = stop + len(END)
    end = begin + int(length)
    if data[end:end + len(END)] != END:
        raise Damaged("length")
    found = Record(headers, data[begin:end], end + len(END))
    _expect_digest("block digest", headers.get("warc-block-digest"), found.block)
    payload = found.payload()
    if payload is not None:
        _expect_digest("payload digest", headers.get("warc-payload-digest"), payload)
    return found


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member that begins at ``data[at]`` and where it ends, or ``Damaged``."""
    z = zlib.decompressobj(31)
    out, pos, step = [], at, 1 << 20
    try:
        while not z.eof:
            if pos >= len(data):
                raise Damaged("member without end")
            out.append(z.decompress(data[pos:pos + step]))
            pos += step
    except zlib.error as e:
        raise Damaged(str(e)) from e
    return b"".join(out), min(pos, len(data)) - len(z.unused_data)


def _plain_records(data: bytes) -> Iterator[tuple[int, int, Record | str]]:
    """``(start, end, record or reason)`` over uncompressed bytes: every byte is in a record or a gap."""
    at = 0
    while at < len(data):
        try:
            found = parse_record(data, at)
            yield at, found.end, found
            at = found.end
        except Damaged as e:
            reason, start = str(e), at
            while True:
                line = _VERSION_LINE.search(data, at + 1)
                at = line.start() if line else len(data)
                try:
                    if line:
                        parse_record(data, at)
                    break
                except Damaged:
                    continue
            yield start, at, reason


def _members(data: bytes) -> Iterator[tuple[int, int, bytes | str]]:
    """``(start, end, content or reason)`` over gzip members: every byte is in a member or a gap."""
    at = 0
    while at < len(data):
        try:
            content, end = inflate(data, at)
            yield at, end, content
            at = end
        except Damaged as e:
            reason, start = str(e), at
            while True:
                at = data.find(MAGIC, at + 1)
                if at < 0:
                    at = len(data)
                    break
                try:
                    content, _ = inflate(data, at)
                    if not content or _VERSION_LINE.match(content):
                        break
                except Damaged:
                    continue
            yield start, at, reason


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | str]]:
    """``(offset, length, record or reason)`` of an archive: what was read, and the gaps quarantined.

    Offsets are of the archive's own bytes; a gap within a member has the member's."""
    if not data:
        return
    first = _VERSION_LINE.search(data)
    magic = data.find(MAGIC)
    if magic < 0 or (first and first.start() < magic):
        for start, end, what in _plain_records(data):
            yield start, end - start, what
        return
    content = None
    for start, end, content in _members(data):
        if isinstance(content, str):
            yield start, end - start, content
            continue
        for _, _, what in _plain_records(content):
            yield start, end - start, what
    if content != b"":
        yield len(data), 0, "no end mark"


# -- Spark ------------------------------------------------------------------------

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, refers_to, revisit)`` of every page."""
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    key = F.concat_ws("-", F.sha1("payload"), F.octet_length("payload"), F.xxhash64("payload"))
    shared = checkpointed(rows.groupBy(key.alias("key")).agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
                          .where("n > 1"))       # a payload of one page needs no other row
    known = hot_keys.left_join(rows.withColumn("key", key), "key", ["page_id", "url"], shared, "n", pages.count())
    revisit = F.coalesce(~F.col("last").eqNullSafe(F.col("page_id")) & F.col("last").isNotNull(), F.lit(False))
    return known.select("page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, path: str, compressed: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``plan_records``' rows as archives of about ``archive_bytes`` under ``path``."""
    head = member(info_record()) if compressed else info_record()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [head], len(head)

        def archive() -> pa.RecordBatch:
            whole = b"".join(parts) if compressed else b"".join(parts)[:-len(END)]     # the writer ends it
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["archive"])

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                one = page_record(*values)
                parts.append(member(one) if compressed else one)
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive()
                    parts, size = [head], len(head)
        if len(parts) > 1:
            yield archive()

    rows = records.select("page_id", "url", "payload", "refers_to", "revisit")
    (rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1)
     .option("encoding", "ISO-8859-1").option("lineSep", (END_MEMBER if compressed else END).decode("latin-1"))
     .text(path))


_READ = ("path string, kind string, offset long, length long, reason string, warc_type string, headers map<string,string>, "
         "block binary, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all archives under ``path``: records that passed every check, and quarantined gaps."""
    schema = pa.schema([("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("reason", pa.string()), ("warc_type", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
                        ("block", pa.binary()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                name, waiting, size = name.as_py(), [], 0
                for offset, length, what in salvage(content.as_py()):
                    row = {"path": name, "offset": offset, "length": length}
                    if isinstance(what, str):
                        row.update(kind="gap", reason=what)
                    else:
                        row.update(kind="record", warc_type=what.headers["warc-type"], headers=list(what.headers.items()),
                                   block=what.block, payload=what.payload())
                        size += len(what.block)
                    waiting.append(row)
                    if len(waiting) >= 1000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(waiting, schema=schema)
                        waiting, size = [], 0
                if waiting:
                    yield pa.RecordBatch.from_pylist(waiting, schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _READ)


def pages_of(archives: DataFrame) -> DataFrame:
    """Per response or revisit record what its page was: id, size and digest of the full payload, kind, reference."""
    def page(header: str):
        return F.regexp_extract(F.col("headers")[header], r"^<urn:page:(-?\d+):", 1).try_cast("long")

    stated = F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "")
    http_length = F.regexp_extract(F.col("block").cast("string"), r"(?i)\r\nContent-Length: *(\d+)\r\n", 1).try_cast("long")
    response = F.col("warc_type") == "response"
    return archives.where(F.col("kind") == "record").where(F.col("warc_type").isin("response", "revisit")).select(
        page("warc-record-id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(http_length).alias("payload_bytes"),
        stated.alias("payload_digest"), F.col("warc_type").alias("record_type"),
        F.when(~response, page("warc-refers-to")).alias("refers_to"))


def report(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives in the shared folder, read them back, and tell what each page became."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(plan_records(pages), path, archive_bytes=archive_bytes)
    return pages_of(read_archives(spark, path))


def oracle() -> str:
    """DuckDB SQL of ``report`` over ``pages``."""
    return """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
        d AS (
            SELECT page_id, html, array_to_string(list_transform(range(0, 32), lambda i:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
                           ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT)
                             >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS INTEGER), 1)), '') AS digest FROM p),
        g AS (
            SELECT page_id, html, digest, max(page_id) OVER (PARTITION BY html) AS last FROM d)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM g
    """
