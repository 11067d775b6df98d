"""Legacy archive converter: ARC (versions 1 and 2) to WARC 1.0.

``parse_arc`` reads the version block, takes the field names of its record
definition, and then walks the records by the length that each header line
declares.  ``convert`` turns ARC images into WARC files, ``convert_arc`` the
ARC files of a path: record identifiers, dates, types and payload digests are
synthesised, since ARC has none of them or keeps them in other forms.  Records
whose payload another record also has become ``revisit`` records.
``write_warc`` writes one gzip member per record and ``read_warc`` reads
archives back record by record.

A writing task renames its files when they are complete, so a task that runs
again leaves the same files.  Archive names, not archives, pass between jobs.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm.common import posix_scratch, ship, shuffle_partitions
from quarry.session import scratch_path

#: Fixed values of the two formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_HEADER = "X-Record-Key"
PAGES_ORIGIN = "quarry-pages"  # origin code of the ARC files that pages are exported to; only these have key headers
SIZE_HEADER = "X-Payload-Bytes"  # WARC header of a revisit: the size of the payload that it leaves out

REVISIT_BYTES = 1000  # smaller payloads are always stored
ARC_RECORDS = 64  # records in one exported ARC image
LINE_BYTES = 1 << 16  # of a header line
HELD_BYTES = 4 << 20  # of records that parsing returns at a time
ROTATE_BYTES = 1 << 30  # size at which a writing task begins another file
BROADCAST_GROUPS = 200_000  # payload groups of about 60 bytes
_HIGH, _NULL = 1 << 64, 1 << 67


def _frame(rows: list[tuple], columns: list[str], nullable: tuple[str, ...]) -> pd.DataFrame:
    """Rows as a frame whose ``nullable`` columns are exact 64-bit integers:
    pandas would take them through float64 as soon as one is null."""
    out = pd.DataFrame(rows, columns=columns, dtype=object)
    for c in nullable:
        out[c] = pd.array(out[c].tolist(), dtype="Int64")
    return out


# --- record identifiers -------------------------------------------------------

def record_id(key: int | None) -> str:
    """A well-formed (version 8) UUID that carries a 64-bit key."""
    if key is None:
        bits = _NULL
    else:
        k = key & 0xFFFFFFFFFFFFFFFF
        bits = (k & ((1 << 62) - 1)) | (k >> 62) * _HIGH
    return f"<urn:uuid:{uuid.UUID(int=bits | 8 << 76 | 2 << 62)}>"


def record_key(rid: str) -> int | None:
    n = uuid.UUID(rid.strip("<>").removeprefix("urn:uuid:")).int
    if n & _NULL:
        return None
    k = n & ((1 << 62) - 1) | ((n >> 64) & 3) << 62
    return k - (1 << 64) if k >> 63 else k


# --- ARC ----------------------------------------------------------------------

def arc_image(name: str, version: int, records: list[tuple[str, str, bytes]], origin: str = "quarry") -> bytes:
    """One ARC file of (url, date, network document) records."""
    definition = " ".join(ARC_FIELDS[version])
    about = f"{version} 0 {origin}\n{definition}\n\n".encode()

    def line(url: str, date: str, mime: str, size: int, code: str) -> bytes:
        extra = [] if version == 1 else [code, "-", "-", "0", name]
        return " ".join([url, "0.0.0.0", date, mime, *extra, str(size)]).encode() + b"\n"

    parts = [line(f"filedesc://{name}", "19960101000000", "text/plain", len(about), "200"), about]
    for url, date, block in records:
        parts += [b"\n", line(url, date, "text/html", len(block), "200"), block]
    return b"".join(parts)


class _Source:
    """A stream that ends where its compressed data break off or go wrong."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.at = stream, 0

    def _take(self, read, n: int) -> bytes:
        try:
            got = read(n)
        except (EOFError, OSError, zlib.error):
            return b""
        self.at += len(got)
        return got

    def line(self) -> bytes:
        return self._take(self.stream.readline, LINE_BYTES)

    def block(self, size: int) -> bytes:
        parts, left = [], size
        while left and (got := self._take(self.stream.read, min(left, 1 << 20))):
            parts.append(got)
            left -= len(got)
        return b"".join(parts)


def open_arc(data: bytes) -> BinaryIO:
    """The content of an ARC file, unpacked while it is read if it is gzip."""
    return gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def parse_arc(data: bytes | BinaryIO) -> Iterator[dict]:
    """Records of one ARC file, read as a stream: one record is held at a time.

    The version block sets version, origin and fields; a header line is read
    from its right end, because old crawlers left blanks in URLs.  A line that
    is no header is skipped, and so is a declared length that is not made of
    the digits 0 to 9.  A version line that begins with no digits, or another
    version than 1 and 2, leaves version 1.  Where the file ends, or its
    compressed data go wrong, within a record, the record is returned with what
    is there and ``truncated`` set, and nothing after it."""
    source = _Source(io.BytesIO(data) if isinstance(data, bytes) else data)
    fields, version, origin = ARC_FIELDS[1], 1, ""
    while True:
        start = source.at
        line = source.line()
        if not line:
            return
        header = line.decode("utf-8", "replace").rstrip("\r\n")
        parts = header.split(" ")
        if len(parts) < 5 or not re.fullmatch("[0-9]{1,18}", parts[-1]):
            continue
        size = int(parts[-1])
        block = source.block(size)
        if header.startswith("filedesc://"):
            lines = [x.rstrip("\r") for x in block.decode("utf-8", "replace").split("\n")]
            told = re.match("([0-9]+)", lines[0])
            version = int(told[1]) if told and told[1] in ("1", "2") else 1
            origin = (lines[0].split(" ") + ["", ""])[2]
            if len(lines) > 1 and lines[1].startswith("URL "):
                fields = lines[1].split(" ")
            continue
        tail = parts[len(parts) - len(fields) + 1:] if len(parts) >= len(fields) else parts[1:]
        names = fields[1:] if len(parts) >= len(fields) else ARC_FIELDS[1][1:]
        named = dict(zip(names, tail))
        yield {"offset": start, "version": version, "origin": origin, "url": " ".join(parts[:len(parts) - len(tail)]),
               "ip": named.get("IP-address", "0.0.0.0"), "date": named.get("Archive-date", ""),
               "mime": named.get("Content-type", "unknown"), "block": block, "truncated": len(block) < size}


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header part (with its blank line) and payload."""
    if block.startswith(b"HTTP/"):
        at = block.find(b"\r\n\r\n")
        if at >= 0:
            return block[:at + 4], block[at + 4:]
    return b"", block


def _http_value(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n"):
        k, _, v = line.partition(b":")
        if k.strip().lower() == name.lower().encode():
            return v.strip().decode()
    return None


def warc_date(arc_date: str) -> str:
    """YYYYMMDDhhmmss (or a leading part of it) as a WARC date."""
    digits = "".join(re.findall("[0-9]", arc_date))[:14]
    d = digits + "19700101000000"[len(digits):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_type(url: str, block: bytes) -> str:
    return "response" if block.startswith(b"HTTP/") or url.startswith("dns:") else "resource"


def _key(name: str, record: dict, head: bytes) -> int | None:
    """The record's key: that of its key header in files that pages were
    exported to, else a hash of file name and offset.  Other pages may well
    have sent such a header themselves."""
    if record["origin"] == PAGES_ORIGIN and (own := _http_value(head, KEY_HEADER)) is not None:
        return None if own == "null" else int(own)
    return int.from_bytes(hashlib.sha1(f"{name} {record['offset']}".encode()).digest()[:8], "big", signed=True)


def arc_records(images: DataFrame, with_block: bool = True) -> DataFrame:
    """Records of ARC files (``arc_name``, ``data``, plain or gzip), unpacked
    and parsed as streams and returned a few megabytes at a time.  ``key`` is
    the exported page's, else a hash of file name and offset.  For malformed
    files see ``parse_arc``; a null file has no records."""
    ship(images.sparkSession)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["arc_name"], pdf["data"]):
                rows, held = [], 0
                for r in parse_arc(open_arc(bytes(data))) if data is not None else ():
                    head, payload = _split_http(r["block"])
                    row = (_key(name, r, head), r["url"], warc_date(r["date"]), warc_type(r["url"], r["block"]),
                           hashlib.sha1(payload).hexdigest(), len(payload))
                    rows.append(row + ((r["ip"], r["truncated"], r["block"]) if with_block else ()))
                    held += 200 + (len(r["block"]) if with_block else 0)
                    if held >= HELD_BYTES:
                        yield _frame(rows, columns, ("key",))
                        rows, held = [], 0
                yield _frame(rows, columns, ("key",))

    schema = "key long, url string, date string, type string, digest string, payload_bytes long"
    schema += ", ip string, truncated boolean, block binary" if with_block else ""
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    return images.select("arc_name", "data").mapInPandas(parse, schema)


def arc_images(spark: SparkSession, path: str) -> DataFrame:
    """The ARC files (plain or gzip) at ``path`` as they are: ``arc_name``, ``data``."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("arc_name"), F.col("content").alias("data"))


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ARC files (plain or gzip) at ``path``."""
    return arc_records(arc_images(spark, path))


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as ARC images of ``ARC_RECORDS`` records, of either version.
    Blanks in a URL stay; line ends in it become blanks; a null URL is ``-``."""
    ship(pages.sparkSession)
    src = pages.select(F.col(id_col).cast("long").cast("string").alias("key"),
                       F.coalesce(F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]", " "), F.lit("-")).alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"))

    def export(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for at in range(0, len(pdf), ARC_RECORDS):
                some = pdf.iloc[at:at + ARC_RECORDS]
                records = []
                for key, url, html in zip(some["key"], some["url"], some["html"]):
                    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n"
                            f"{KEY_HEADER}: {'null' if key is None else key}\r\n\r\n").encode()
                    records.append((url, "20040101000000", head + bytes(html)))
                name, n = f"pages-{part:05d}-{n:05d}.arc", n + 1
                yield pd.DataFrame({"arc_name": [name], "data": [arc_image(name, 1 + n % 2, records, PAGES_ORIGIN)]})

    return src.mapInPandas(export, "arc_name string, data binary")


# --- WARC ---------------------------------------------------------------------

def revisit_targets(records: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """For payloads of at least ``min_bytes`` that several records have: the
    digest and the largest key, which stays.  Counted map-side first, so a
    payload that a third of all records share is one row per task."""
    return (records.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
            .agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def mark_revisits(records: DataFrame, targets: DataFrame, n_targets: int) -> DataFrame:
    """Add ``refers_to``: the key that stays, for the other records with the
    payload (rows that repeat that key all stay)."""
    targets = targets.withColumnRenamed("digest", "_digest")
    if n_targets <= BROADCAST_GROUPS:
        targets = F.broadcast(targets)
    other: Column = F.col("keep").isNotNull() & ~F.col("key").eqNullSafe(F.col("keep"))
    return (records.join(targets, records["digest"] == targets["_digest"], "left")
            .withColumn("refers_to", F.when(other, F.col("keep"))).drop("_digest", "keep"))


def warc_record(r) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    head, payload = _split_http(r.block)
    revisit = not pd.isna(r.refers_to)
    block = head if revisit else r.block
    key = None if pd.isna(r.key) else int(r.key)
    digest = base64.b32encode(bytes.fromhex(r.digest)).decode()
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else r.type}", f"WARC-Record-ID: {record_id(key)}",
             f"WARC-Date: {r.date}", f"WARC-Target-URI: {r.url}", f"WARC-IP-Address: {r.ip}",
             f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(int(r.refers_to))}",
                  f"{SIZE_HEADER}: {int(r.payload_bytes)}"]
    if r.truncated:
        lines.append("WARC-Truncated: unspecified")
    http = head != b""
    lines += [f"Content-Type: {'application/http; msgtype=response' if http else 'application/octet-stream'}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write ``part-<task>-<n>.warc.gz`` files; one row (path, n_records) per
    file, lazily: the files appear when the result is evaluated."""
    # keys as text: a long column with a null reaches pandas as float64
    records = records.withColumn("key", F.col("key").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, out, n, final, temporary = TaskContext.get().partitionId(), 0, None, 0, "", ""
        done = []
        try:
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    if out is None:
                        final = os.path.join(folder, f"part-{part:05d}-{seq:03d}.warc.gz")
                        temporary, n, seq = f"{final}.{uuid.uuid4().hex}.tmp", 0, seq + 1
                        out = open(temporary, "wb")
                    z = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(z.compress(warc_record(r)) + z.flush())
                    n += 1
                    if out.tell() >= ROTATE_BYTES:
                        out.close()
                        out = None
                        os.replace(temporary, final)
                        done.append((final, n))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            os.replace(temporary, final)
            done.append((final, n))
        yield pd.DataFrame(done, columns=["path", "n_records"])

    return records.mapInPandas(write, "path string, n_records long")


def iter_warc(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of a file."""
    with gzip.open(path, "rb") as f:
        while True:
            line = f.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: not a WARC record: {line[:40]!r}")
            headers = {}
            while (line := f.readline().rstrip(b"\r\n")):
                k, _, v = line.decode().partition(":")
                headers[k.strip().lower()] = v.strip()
            block = f.read(int(headers["content-length"]))
            f.read(4)
            yield headers, block


def read_warc(files: DataFrame) -> DataFrame:
    """Records of WARC files (``path``), streamed: ``key``, ``url``, ``type``,
    ``payload_bytes``, ``payload_digest`` and ``refers_to``.  The payloads of
    stored records are hashed again and must agree with their digests."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                rows = []
                for h, block in iter_warc(path):
                    head, payload = _split_http(block)
                    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    revisit = h["warc-type"] == "revisit"
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: payload of {h['warc-record-id']} does not match its digest")
                    size = int(h[SIZE_HEADER.lower()]) if revisit else len(payload)
                    rows.append((record_key(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], size, digest,
                                 record_key(h["warc-refers-to"]) if revisit else None))
                    if len(rows) >= 4096:
                        yield _frame(rows, columns, nullable)
                        rows = []
                yield _frame(rows, columns, nullable)

    schema = "key long, url string, type string, payload_bytes long, payload_digest string, refers_to long"
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    nullable = ("key", "refers_to")
    return files.select("path").mapInPandas(read, schema)


def convert(images: DataFrame, folder: str, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ARC images (``arc_name``, ``data``) as WARC files under ``folder``
    (on a shared mount); one row (path, n_records) per file written.  Jobs: one
    for payload groups, one that writes."""
    spark = images.sparkSession
    path = scratch_path(spark, "warc-targets")
    revisit_targets(arc_records(images, with_block=False), min_bytes).write.parquet(path)
    targets = spark.read.parquet(path)
    manifest = scratch_path(spark, "warc-files")
    write_warc(mark_revisits(arc_records(images), targets, targets.count()), folder).write.parquet(manifest)
    return spark.read.schema("path string, n_records long").parquet(manifest)


def convert_arc(spark: SparkSession, path: str, folder: str | None = None, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``convert`` for the ARC files (plain or gzip) at ``path``."""
    return convert(arc_images(spark, path), folder or posix_scratch(spark, "warc"), min_bytes)


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = REVISIT_BYTES, **cols) -> DataFrame:
    """Export pages as ARC, convert to WARC files under ``folder`` (on a shared
    mount) and read those back.

    Null html is an empty payload; a null page id is kept (and never a revisit
    target); repeated page ids each get a record; an empty table gives no
    record; other columns are ignored.  Jobs: those of ``convert``, and the
    read."""
    spark = pages.sparkSession
    files = convert(pages_to_arc(pages, **cols), folder or posix_scratch(spark, "warc"), min_bytes)
    return read_warc(files.repartition(shuffle_partitions(spark)))


def page_report(pages: DataFrame, **kw) -> DataFrame:
    """One row per page, from the archives read back (see ``archive_pages``):
    size and SHA-1 of the payload, and which page's record a revisit names."""
    return archive_pages(pages, **kw).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest",
                                             F.col("type").alias("record_type"), "refers_to")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM m
"""
