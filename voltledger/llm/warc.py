"""WARC archives of web pages, compressed per record with a dictionary of their own.

Each task writes one archive (WARC records in Zstandard frames; Spark names the files part-*.txt): a skippable frame that holds a Zstandard dictionary
built from the archive's own records, then every record as a frame of its own, so that a reader
needs nothing but the file and can start at any record.

A page whose payload another page holds already is written as a *revisit* without payload: among
records of equal payload (of at least ``min_revisit_bytes``) the smallest page_id is the response.
Only (page_id, digest) pairs are grouped, never the payloads; the pages are then dealt out by
page_id and digest, so copies spread over all tasks.

Spark's text writer does the writing: rows are raw bytes, committed by task like any other table,
and lost executors leave nothing half-written.  It ends each row with one byte; that byte is
the content of a last one-byte skippable frame, which decoders pass over.

Defined results: null html is an empty payload; null url is written without target; a null page_id
comes after all others and names no revisit target; of repeated rows of one page that would be the
response, one is and the others revisit it; an empty table gives no archives; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.session import scratch_path, ship_package, stage

# Fixed values of the formats.
DICT_MAGIC, FILLER_MAGIC = 0x184D2A5D, 0x184D2A50
ZSTD_DICT_MAGIC = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICT_BYTES = 64 << 10
# Records held back until the dictionary is built; more of them follow one by one.
SAMPLE_BYTES = 8 << 20
# Payload bytes of one archive, about.
ARCHIVE_BYTES = 32 << 20
ROW_BYTES = 1 << 20
_FILLER = struct.pack("<II", FILLER_MAGIC, 1)

_INDEX = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _b32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, copy: int, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record.  ``copy`` tells repeated rows of a page apart."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{copy}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{_b32(hashlib.sha1(payload).digest())}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: <urn:page:{refers_to}:0>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary of the records; raw content where too few differ for training."""
    import zstandard

    total = sum(map(len, records))
    try:
        # The trainer wants samples of a size it can hold; long records are cut, none is left out.
        samples = [r[i : i + (128 << 10)] for r in records for i in range(0, len(r), 128 << 10)]
        return zstandard.train_dictionary(min(size, max(1024, total // 4)), samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _loaded(content: bytes):
    import zstandard

    kind = zstandard.DICT_TYPE_FULLDICT if content.startswith(ZSTD_DICT_MAGIC) else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(content, dict_type=kind)


def _write(date: str, level: int, dict_bytes: int, sample_bytes: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        last, copy = None, 0
        for batch in batches:
            for page_id, url, payload, sha1, first in zip(
                    *(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "first")), strict=True):
                # Rows come sorted by page and digest: a repeated row follows its twin.
                copy = copy + 1 if (page_id, sha1) == last else 0
                last = (page_id, sha1)
                revisit = first is not None and (first["page_id"] != page_id or copy > 0)
                yield record(page_id, copy, url, payload, first["page_id"] if revisit else None, revisit, date)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        held: list[bytes] = []
        size, compressor = 0, None
        row: list[bytes] = []

        def start() -> None:
            nonlocal compressor
            content = dictionary(held, dict_bytes)
            compressor = zstandard.ZstdCompressor(level=level, dict_data=_loaded(content), write_checksum=True)
            row.append(struct.pack("<II", DICT_MAGIC, len(content)) + content)
            row.extend(map(compressor.compress, held))
            held.clear()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([b"".join(row) + _FILLER], pa.binary())], names=["value"])
            row.clear()
            return out

        for one in records(batches):
            if compressor is None:
                held.append(one)
                size += len(one)
                if size >= sample_bytes:
                    start()
            else:
                row.append(compressor.compress(one))
            if sum(map(len, row)) >= ROW_BYTES:
                yield flush()
        if held:
            start()
        if row:
            yield flush()

    return run


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   level: int = 9, dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per page below ``path`` (a folder that all executors reach)."""
    ship_package(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # One key for a page and its payload; null pages have one too.
    rows = rows.withColumn("key", F.concat_ws(":", "page_id", "sha1"))

    keys = rows.where(F.length("payload") >= min_revisit_bytes).select("key", "page_id", "sha1")
    shared = keys.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # The records that share a payload, once each: narrow rows, copies spread by page.  Written, so
    # that the join below is planned once, with known sizes, and deals no payload a second time.
    first = stage(keys.join(shared, "sha1").select("key", F.struct(F.col("first").alias("page_id")).alias("first")).distinct(), "first-pages")

    total = rows.agg(F.sum(F.length("payload"))).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    # Both sides dealt alike: the join moves no payload again.
    marked = rows.repartition(archives, "key").join(first.repartition(archives, "key"), "key", "left").sortWithinPartitions("key", "url")
    frames = marked.mapInArrow(_write(date, level, dict_bytes, sample_bytes), "value binary")
    frames.select(F.col("value").cast("string").alias("value")).write.text(path)


def frames_of(content: bytes) -> Iterator[bytes]:
    """The decompressed records of one archive."""
    import zstandard

    if not content:
        return
    magic, size = struct.unpack_from("<II", content)
    if magic != DICT_MAGIC:
        raise ValueError("an archive must start with its dictionary frame")
    expand = zstandard.ZstdDecompressor(dict_data=_loaded(content[8 : 8 + size]))
    at, view = 8 + size, memoryview(content)
    while at < len(content):
        if struct.unpack_from("<I", content, at)[0] & 0xFFFFFFF0 == FILLER_MAGIC:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        one = expand.decompressobj()
        step, parts = at, []
        while not one.eof:
            parts.append(one.decompress(view[step : step + (64 << 10)]))
            step += 64 << 10
        at = min(step, len(content)) - len(one.unused_data)
        yield b"".join(parts)


_PAGE = re.compile(r"<urn:page:(-?\d*):\d+>")


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or _b32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: (lambda m: int(m[1]) if m and m[1] else None)(_PAGE.match(fields.get(name, "")))
    url = fields.get("WARC-Target-URI")
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "url": url and _unline(url),
            "payload": None if revisit else payload}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch.column("content"):
            rows: list[dict] = []
            for raw in frames_of(content.as_py()):
                rows.append(parse(raw))
                rows[-1].pop("payload")
                if len(rows) >= 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index of all records below ``path``; every response is checked against its digest."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, _INDEX)


def archive_and_index(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
