"""WARC archives compressed record by record with a dictionary of their own.

An archive starts with a skippable frame that embeds a Zstandard dictionary, followed by one frame per record, as the
format's zst variant has it. The dictionary is trained on the archive's first records, then those and all others are
written as they come, so a task holds a bounded sample and one record.

Spark's text writer stores the frames: each row is a frame, and the line separator is an empty skippable frame, which
every reader passes over. So archives go through Spark's commit protocol to any store, and a lost task is just run again.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.staging import staged_path

# fixed values of the formats
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("latin-1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2026-01-01T00:00:00Z"
#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 16 << 20
#: Bytes of records that a dictionary is trained on, and its size.
SAMPLE_BYTES, DICTIONARY_BYTES = 2 << 20, 64 << 10
LEVEL = 6


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Controls and per cent signs as per cent codes, so a value never ends its line."""
    return "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _plain_value(text: str) -> str:
    import urllib.parse

    return urllib.parse.unquote(text)


def build_record(page: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit without; both name the full payload's size and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in headers), "\r\n"]).encode() + block + b"\r\n\r\n"


def read_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("a payload does not match its digest")
    page, refers = (fields.get(k, "<urn:page:>")[len("<urn:page:") : -1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return {
        "page_id": int(page) if page else None, "url": _plain_value(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "payload": payload.decode() if kind == "response" else None, "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": int(refers) if refers else None,
    }


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary, or, where there is too little to train on, the plain bytes of the first records."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:4096]


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def frames(rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["frame"])

    compressor, waiting, size = None, [], 0

    def start() -> zstandard.ZstdCompressor:
        dictionary = build_dictionary(waiting)
        waiting.insert(0, dictionary)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))

    def started() -> list[bytes]:
        dictionary, *records = waiting
        return [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary, *map(compressor.compress, records)]

    for batch in batches:
        for i in range(batch.num_rows):
            page, url, html, refers = (batch.column(c)[i].as_py() for c in range(4))
            record = build_record(page, url, html.encode("utf-8", "surrogatepass"), refers)
            if compressor:
                yield frames([compressor.compress(record)])
                continue
            waiting.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                compressor = start()
                yield frames(started())
                waiting = []
    if waiting:
        compressor = start()
        yield frames(started())


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row of pages (page_id, url, html, further columns ignored) as archives in the folder path.

    Of rows with equal payloads of at least least_bytes bytes, those with the smallest page_id are responses, the others
    revisit it; a null page_id comes first and has no number in its record. A null html is an empty payload; a null url leaves the header out. Rows are dealt
    by a hash of id and digest, so equal payloads do not meet in one archive. An empty table gives an empty folder.
    """
    html = F.coalesce("html", F.lit(""))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = pages.select("page_id", name.alias("name"), "url", html.alias("html"), F.unhex(F.sha2(html, 256)).alias("digest"), F.octet_length(html).alias("bytes"))
    narrow = rows.select("page_id", "name", "digest", "bytes")
    groups = (
        narrow.where(F.col("bytes") >= least_bytes).groupBy("digest")
        .agg(F.min(F.struct("page_id")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    )
    later = (
        narrow.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
        .select("name", "digest", F.coalesce(F.col("first.page_id").cast("string"), F.lit("")).alias("refers_to")).distinct()
    )
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    archives = max(1, math.ceil(total / archive_bytes))
    # both sides are dealt out alike, so payloads travel once; name and digest together are as good as unique
    described = rows.repartition(archives, "name", "digest").join(
        later.repartition(archives, "name", "digest").hint("merge"), ["name", "digest"], "left"
    )
    (
        described.select("name", "url", "html", "refers_to")
        .mapInArrow(_write, "frame binary").select(F.col("frame").cast("string").alias("frame"))
        .write.option("lineSep", EMPTY_FRAME).text(path)
    )


def split_frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one by one."""
    view, at = memoryview(archive), 0
    decompressor = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at) if at + 8 <= len(view) else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise ValueError("the dictionary does not lead the archive")
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])))
            at += 8 + size
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a record")
            piece = view[at : at + 65_536]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(parts)


_RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0):
            rows: list[dict] = []
            for record in split_frames(archive.as_py()):
                rows.append(read_record(record))
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in the folder, payloads checked against their digests."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(
            _read,
            "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
        )
    )


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    path = staged_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path)
