"""Operator 2: web archives in WARC form, one Zstandard frame per record.

An archive begins with a skippable frame that holds the compression dictionary;
a frame per record follows. Archives are written by Spark's text sink, whose
line separator is set to an empty skippable frame, so every file is a valid
Zstandard stream, goes to any file system that Spark can write, and is committed
as a whole. The reader loads the dictionary from the leading frame, decodes
frame by frame and validates headers and lengths.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import batches

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"  # skippable frame 0x184D2A50 of length 0
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

#: Documented bounds: rows the dictionary is trained on, its size, and the
#: payload bytes an archive takes before the next one begins.
DICTIONARY_ROWS, DICTIONARY_BYTES = 400, 64 << 10
DATE = "2000-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool, digest: str | None = None) -> bytes:
    """One WARC record. A revisit has the HTTP head, whose length is that of the
    full payload, but no body."""
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest or payload_digest(payload)}"))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    lines = [VERSION, *[f"{k}: {v}" for k, v in fields], "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; checks version, required headers,
    the declared length, the end mark and the digest of a response."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive("no WARC version line or no end of the headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadArchive(f"not a header: {line[:80]!r}")
        headers[name.strip()] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            raise BadArchive(f"{name} is missing")
    if not headers["Content-Length"].isdigit():
        raise BadArchive("Content-Length is not a number")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length is {length}, the record has {len(rest) - 4} bytes")
    return headers, rest[:length]


def payload_of(headers: dict[str, str], block: bytes) -> tuple[bytes | None, int]:
    """Payload of a response (None for a revisit) and the full length."""
    head, found, body = block.partition(b"\r\n\r\n")
    sizes = [line.partition(b":")[2].strip() for line in head.split(b"\r\n")
             if line.lower().startswith(b"content-length:")]
    if not found or len(sizes) != 1 or not sizes[0].isdigit():
        raise BadArchive("the HTTP head has no single Content-Length")
    size = int(sizes[0])
    if headers["WARC-Type"] == "revisit":
        if body:
            raise BadArchive("a revisit has a body")
        return None, size
    if len(body) != size:
        raise BadArchive(f"HTTP Content-Length is {size}, the payload has {len(body)} bytes")
    if headers.get("WARC-Payload-Digest") != f"sha1:{payload_digest(body)}":
        raise BadArchive("the payload digest is wrong")
    return body, size


def frames(data: bytes | memoryview) -> Iterator[tuple[int, bytes]]:
    """Decode an archive: yields ``(offset, record bytes)`` frame by frame."""
    view = memoryview(data)
    if len(view) < 8:
        raise BadArchive("the archive is too short")
    magic, size = struct.unpack_from("<II", view)
    if magic != DICTIONARY_MAGIC or 8 + size > len(view):
        raise BadArchive("no dictionary frame at the start")
    stored = bytes(view[8:8 + size])
    if stored[:4] == struct.pack("<I", FRAME_MAGIC):  # it may be compressed itself
        stored = zstandard.ZstdDecompressor().decompress(stored)
    dictionary = zstandard.ZstdCompressionDict(stored) if stored else None
    at = 8 + size
    while at < len(view):
        if at + 8 > len(view):
            raise BadArchive(f"a cut frame at byte {at}")
        magic, size = struct.unpack_from("<II", view, at)
        if SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
            at += 8 + size
            if at > len(view):
                raise BadArchive("a skippable frame is longer than the archive")
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive(f"no frame at byte {at}")
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        out, begin = [], at
        while not one.eof:
            if at >= len(view):
                raise BadArchive(f"the frame at byte {begin} is cut")
            part = view[at:at + (1 << 16)]
            out.append(one.decompress(part))
            at += len(part) - len(one.unused_data)
        yield begin, b"".join(out)


@lru_cache(maxsize=2)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=True)


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def train(pages: DataFrame, html: str) -> bytes:
    """A dictionary from a bounded sample of payloads (their smallest hashes);
    empty if there is too little to learn from."""
    start = F.substring(html, 1, 4096)
    sample = [r[0].encode() for r in pages.filter(F.length(html) > 0)
              .select(start.alias("h"), F.xxhash64(html).alias("k"))
              .orderBy("k").limit(DICTIONARY_ROWS).select("h").collect()]
    if len(sample) < 50:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # samples that are too small or all alike
        return b""


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least: int = 0) -> None:
    """Write a record per row into archives under ``path``.

    Of records with equal payloads of at least ``least`` bytes, those with the
    smallest id are responses and the others revisits of it. A NULL payload is
    an empty one. A row with a NULL id is a response if no equal payload has
    an id, else a revisit. Rows that repeat the smallest id are all responses.
    """
    body = F.coalesce(F.encode(html, "UTF-8"), F.encode(F.lit(""), "UTF-8"))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"),
                        body.alias("body")).withColumn("digest", F.sha1("body"))
    first = (rows.select("id", "digest").groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first"))
    revisit = (F.octet_length("body") >= least) & F.col("first").isNotNull() & ~F.col(
        "id").eqNullSafe(F.col("first"))
    marked = rows.join(first, "digest", "left").select(
        "id", "url", "body", "digest", F.coalesce(revisit, F.lit(False)).alias("revisit"),
        F.when(revisit, F.col("first")).alias("refers_to"))
    dictionary = train(pages.select(F.col(html).alias("html")), "html")

    def run(it):
        press, opened = _compressor(dictionary), False
        for batch in it:
            for part in batches(batch, "body"):
                out = [] if opened else [dictionary_frame(dictionary)]
                opened = True
                for row in part.to_pylist():
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    out.append(press.compress(record(row["id"], row["url"], row["body"],
                                                     row["refers_to"], row["revisit"], digest)))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    written = marked.mapInArrow(run, "frame binary")
    # the bytes pass through the text sink as they are
    written.select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: ``archive, position, headers,
    payload, payload_bytes, payload_digest, record_type, page_id, refers_to``.

    Raises :class:`BadArchive` on a broken frame, header, length or digest.
    A task holds one archive (its compressed bytes) and one record at a time.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def number(value: str | None) -> int | None:
        tail = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(tail) if tail else None

    def run(it):
        names = ("archive", "position", "headers", "payload", "payload_bytes", "payload_digest",
                 "record_type", "page_id", "refers_to")
        types = (pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(),
                 pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        for batch in it:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                archive, rows, size = name.as_py(), [], 0
                data = content.as_buffer()
                for at, data_of in frames(data) if data.size else ():
                    headers, block = parse(data_of)
                    payload, full = payload_of(headers, block)
                    rows.append((archive, at, list(headers.items()), payload, full,
                                 headers.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                                 headers["WARC-Type"], number(headers["WARC-Record-ID"]),
                                 number(headers.get("WARC-Refers-To"))))
                    size += len(block)
                    if size > 8 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(run, (
        "archive string, position long, headers map<string,string>, payload binary, "
        "payload_bytes long, payload_digest string, record_type string, page_id long, "
        "refers_to long"))


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                       html: str = "html", least: int = 0) -> DataFrame:
    """Write the pages to archives in shared storage and read them back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    No rows: an empty folder is read, no rows. Other columns are not archived.
    """
    path = shared_folder(pages.sparkSession)
    write_archives(pages, path, page_id, url, html, least)
    return read_archives(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
