"""Conversion of legacy ARC archives to WARC.

An ARC file opens with a version block whose second line says which header line its records have:
version 1 has five fields, version 2 ten; a URL may hold spaces, so fields are counted from the right. The
declared length, and nothing in the content, says where a record ends. From these the converter makes WARC
records: identifiers from archive and place, ISO timestamps from 14 digits, types from the content
(``warcinfo`` for the version block, ``response`` for an HTTP message, ``resource`` for the rest), and SHA-1 digests of
block and payload. Of HTTP records with equal payloads that with the greatest key stays a
``response``; the others become ``revisit`` records that keep their HTTP header and refer to it.

Archives are written by Spark's text writer, one row to a file, and read as binary files, so they can lie in
any store. An archive holds about ``ARCHIVE_BYTES``, or one longer record, and is what a task holds in
memory. Which records are revisits is found on digests alone; an archive learns of its own revisits only.

Defined cases: a null html is an empty payload; null, blank or unprintable URL characters are percent-encoded and
a null or empty URL is ``about:blank``; a null page id is left out of the record and sorts first; of records that
tie in key the last in order of archive and place is the response; a record cut short by the end of its file keeps what
is there and is marked ``WARC-Truncated``; a date that is not one becomes the epoch; an empty table gives no
archives and an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.session import shared_path, stored

ARCHIVE_BYTES = 16 << 20
# ARC records carry the page id in this HTTP header.
KEY_HEADER = b"X-Page-Id"
EPOCH = "1970-01-01T00:00:00Z"

# Field lines of the two versions of the format.
FIELDS_V1 = "URL IP-address Archive-date Content-type Archive-length"
FIELDS_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


class ArcRecord(NamedTuple):
    number: int
    url: str
    ip: str
    date: str
    kind: str
    block: bytes
    cut: bool


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def inflated(content: bytes) -> bytes:
    """Plain bytes of a file of gzip members, or of a plain file."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records by their declared lengths; the version block comes first."""
    at, number, fields = 0, 0, 5
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].rstrip(b"\r")
        if not line:  # the line break after a block
            at = end + 1
            continue
        head = line.decode("utf-8", "replace")
        if number == 0:
            version = data[end + 1 : end + 2]
            # The version block's own line may have either form; its length is last in both.
            cells = head.split(" ")
            cells = [cells[0], *cells[1:4], cells[-1]]
            fields = 10 if version == b"2" else 5
        else:
            cells = head.rsplit(" ", fields - 1)
        size = int(cells[-1])
        block = data[end + 1 : end + 1 + size]
        yield ArcRecord(number, cells[0], cells[1], cells[2], cells[3], block, len(block) < size)
        at, number = end + 1 + size, number + 1


def read_warc(data: bytes) -> Iterator[WarcRecord]:
    """Records by their ``Content-Length``."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k: v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["Content-Length"])
        yield WarcRecord(headers, data[end + 4 : end + 4 + size])
        at = end + 8 + size


def is_http(record: ArcRecord) -> bool:
    return record.block.startswith(b"HTTP/")


def payload_start(block: bytes) -> int:
    """Place of the payload in an HTTP response."""
    at = block.find(b"\r\n\r\n")
    return at + 4 if at >= 0 else len(block)


def header(block: bytes, name: bytes) -> str | None:
    """Value of a header in the head of an HTTP response."""
    found = re.search(rb"(?mi)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", block[: payload_start(block)])
    return found[1].decode("utf-8", "replace") if found else None


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(digits: str) -> str:
    if not re.fullmatch(r"[0-9]{14}", digits):
        return EPOCH
    d = digits
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def _warc(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def to_warc(archive: str, record: ArcRecord, first: tuple[str, str, str] | None = None) -> bytes:
    """The WARC form of a record; ``first`` is (id, URL, date) of the response it revisits."""
    block, http = record.block, is_http(record)
    kind = "warcinfo" if record.number == 0 else "response" if http else "resource"
    headers = [("WARC-Type", "revisit" if first else kind), ("WARC-Record-ID", record_id(archive, record.number))]
    headers.append(("WARC-Date", iso_date(record.date)))
    if record.number == 0:
        headers += [("WARC-Filename", archive), ("Content-Type", "application/warc-fields")]
        block = f"software: arc conversion\r\nformat: WARC File Format 1.1\r\nisPartOf: {record.url}\r\n".encode()
        return _warc(headers, block)
    headers += [("WARC-Target-URI", record.url), ("WARC-IP-Address", record.ip)]
    if http:
        start = payload_start(block)
        headers.append(("WARC-Payload-Digest", f"sha1:{sha1(block[start:])}"))
        headers.append(("Content-Type", "application/http;msgtype=response"))
        if first:
            headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
            headers += zip(("WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date"), first)
            block = block[:start]
    else:
        headers.append(("Content-Type", record.kind))
    if record.cut:
        headers.append(("WARC-Truncated", "length"))
    headers.append(("WARC-Block-Digest", f"sha1:{sha1(block)}"))
    return _warc(headers, block)


def _written(archives: DataFrame, path: str, end: str) -> None:
    """One gzip file for each row; ``end`` closes it."""
    (
        archives.select(F.col("archive").cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .option("lineSep", end)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


def _gathered(records: Iterator[tuple[bytes, bool]], end: bytes, size: int) -> Iterator[pd.DataFrame]:
    """Archives of about ``size`` bytes; a record with a true mark opens a new one. ``end`` is left to the writer."""
    held, total = [], 0
    for record, opens in records:
        if held and opens:
            yield pd.DataFrame({"archive": [b"".join(held).removesuffix(end)]})
            held, total = [], 0
        held.append(record)
        total += len(record)
    if held:
        yield pd.DataFrame({"archive": [b"".join(held).removesuffix(end)]})


def arc_record(url: str | None, date: str, body: bytes, key: int | None, version: int) -> bytes:
    """An ARC record of a page as an HTTP response."""
    named = KEY_HEADER + b": " + str(key).encode() + b"\r\n" if key is not None else b""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + named
    block = head + f"Content-Length: {len(body)}\r\n\r\n".encode() + body
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    line = f"{safe} 0.0.0.0 {date} text/html "
    line += f"200 {hashlib.md5(body).hexdigest()} - 0 - {len(block)}\n" if version == 2 else f"{len(block)}\n"
    return line.encode() + block + b"\n"


def write_arcs(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "20020101000000",
    size: int = ARCHIVE_BYTES,
) -> str:
    """Pages as legacy archives, versions 1 and 2 in turn; the folder they are in."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, bool]]:
        part, number, total, version = TaskContext.get().partitionId(), 0, size, 1
        for rows in batches:
            for key, address, text in zip(rows["key"].tolist(), rows["url"], rows["html"]):
                if total >= size:
                    version, total = 1 + (part + number) % 2, 0
                    fields = FIELDS_V1 if version == 1 else FIELDS_V2
                    block = f"{version} 0 pages\n{fields}\n".encode()
                    name = f"filedesc://pages-{part:05}-{number:05}.arc 0.0.0.0 {date} text/plain {len(block)}\n"
                    yield name.encode() + block + b"\n", True
                    number += 1
                body = (text or "").encode()
                made = arc_record(address, date, body, int(key) if key else None, version)
                total += len(made)
                yield made, False

    path = shared_path(pages.sparkSession, "arc")
    rows = pages.select(pages[id].cast("string").alias("key"), pages[url].alias("url"), pages[html].alias("html"))
    _written(rows.mapInPandas(lambda b: _gathered(records(b), b"\n", size), "archive binary"), path, "\n")
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``archive`` (file name) and ``content`` of the files of a folder; none if there is no file."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(F.substring_index("path", "/", -1).alias("archive"), "content")
    )


def convert_arcs(spark: SparkSession, source: str) -> str:
    """WARC files of the ARC files in ``source``; the folder they are in."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for archive, content in zip(rows["archive"], rows["content"]):
                out = []
                for record in read_arc(inflated(content)):
                    if is_http(record):
                        key = header(record.block, KEY_HEADER)
                        payload = record.block[payload_start(record.block) :]
                        key = int(key) if key and re.fullmatch("-?[0-9]+", key) else None
                        out.append((archive, record.number, key, sha1(payload), len(payload), record.url, record.date))
                made = pd.DataFrame(out, columns=["archive", "number", "key", "digest", "size", "url", "date"])
                yield made.astype({"key": "Int64"})

    found = stored(
        _files(spark, source).mapInPandas(
            digests, "archive string, number int, key long, digest string, size long, url string, date string"
        ),
        "digests",
    )
    newest = F.struct("key", "archive", "number", "url", "date")
    firsts = found.groupBy("digest", "size").agg(F.max(newest).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = (
        found.select("archive", "number", "digest", "size")
        .join(firsts, ["digest", "size"])
        .where((F.col("archive") != F.col("first.archive")) | (F.col("number") != F.col("first.number")))
    )
    # The revisits of an archive: no more than it has records.
    told = again.groupBy("archive").agg(
        F.collect_list(
            F.struct(
                F.col("number").alias("own"), "first.archive", "first.number", "first.url", "first.date"
            )
        ).alias("revisits")
    )

    def converted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for archive, content, revisits in zip(rows["archive"], rows["content"], rows["revisits"]):
                known = {
                    r["own"]: (record_id(r["archive"], r["number"]), r["url"], iso_date(r["date"]))
                    for r in (revisits if revisits is not None else ())
                }
                records = ((to_warc(archive, r, known.get(r.number)), False) for r in read_arc(inflated(content)))
                yield from _gathered(records, b"\r\n\r\n", 0)

    path = shared_path(spark, "warc")
    joined = _files(spark, source).join(told, "archive", "left")
    _written(joined.mapInPandas(converted, "archive binary"), path, "\r\n\r\n")
    return path


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """What responses and revisits say, and for responses what their payload is."""

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["record_id", "record_type", "key", "payload_bytes", "payload_digest", "refers_to_id", "target_uri", "date"]
        for rows in batches:
            for content in rows["content"]:
                out = []
                for headers, block in read_warc(inflated(content)):
                    kind = headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block[payload_start(block) :]
                    if kind == "response":
                        size, digest = len(payload), sha1(payload)
                    else:
                        size = int(header(block, b"Content-Length") or 0)
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    key = header(block, KEY_HEADER)
                    out.append(
                        (headers["WARC-Record-ID"], kind, int(key) if key else None, size, digest)
                        + (headers.get("WARC-Refers-To"), headers.get("WARC-Target-URI"), headers["WARC-Date"])
                    )
                yield pd.DataFrame(out, columns=columns).astype({"key": "Int64"})

    return _files(spark, path).mapInPandas(
        rows_of,
        "record_id string, record_type string, key long, payload_bytes long, payload_digest string,"
        " refers_to_id string, target_uri string, date string",
    )


def with_responses(records: DataFrame) -> DataFrame:
    """``refers_to``: the key of the response that a revisit names."""
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("key").alias("refers_to")
    )
    return records.join(responses, "refers_to_id", "left")
