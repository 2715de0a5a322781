"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames. A bundle is a run of frames with a seek table
in a skippable footer frame (the public seekable format), so any Zstandard reader takes a bundle as
one stream of WARC records, and a reader that wants one record loads one frame. Each bundle carries
its map from record id to frame and offset inside the frame, stored beside it as columns: the map of
all bundles is read without touching their content.

Bundles are rows of a Parquet table (name, content, map), so Spark's commit protocol decides which
attempt of a task counts, on any file system. Writing is one pass over the pages without a shuffle;
only payload digests are aggregated, which combines before its shuffle.

Of records with equal payloads of at least `REVISIT_BYTES` the one with the smallest page_id is a
response, others are revisits without payload. Null html is an empty payload. A row without page_id
is never referred to; rows that repeat a page_id with the same payload are the same record and share
its type. Payloads of any length are kept whole, and a long one makes a frame and bundle of its own.
An empty table gives an empty archive. Columns beside page_id, url and html are ignored.
"""

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, stored
from tillroll.sinks.scratch import scratch_folder

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 22
# Records carry no capture time in the input; this one is written and can be set.
CAPTURE_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_BUNDLES = (
    "bundle string, content binary, record_ids array<string>, frames array<int>, "
    "offsets array<bigint>, lengths array<bigint>"
)
_BUNDLES_ARROW = pa.schema(
    [
        ("bundle", pa.string()),
        ("content", pa.binary()),
        ("record_ids", pa.list_(pa.string())),
        ("frames", pa.list_(pa.int32())),
        ("offsets", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)
_RECORDS = (
    "record_id string, page_id bigint, url string, payload binary, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint"
)
_RECORDS_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _header_text(value: str) -> str:
    """Header value without characters that would end or shift the line; they are escaped."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain_text(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def warc_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One WARC record. The HTTP head of a revisit keeps the length of the payload it leaves out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {CAPTURE_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple]:
    """Rows of `_RECORDS` from the bytes of whole WARC records."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        block = data[start : start + int(fields["Content-Length"])]
        at = start + len(block) + 4
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
        url, refers = fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To")
        if kind == "response":
            if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        yield (
            fields["WARC-Record-ID"],
            _page_id(fields["WARC-Record-ID"]),
            None if url is None else _plain_text(url),
            payload if kind == "response" else None,
            size,
            digest,
            kind,
            None if refers is None else _page_id(refers),
        )


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes = frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.done, self.sizes, self.open, self.open_bytes = [], [], [], 0
        self.record_ids, self.frames, self.offsets, self.lengths = [], [], [], []

    def add(self, name: str, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self._close_frame()
        self.record_ids.append(name)
        self.frames.append(len(self.sizes))
        self.offsets.append(self.open_bytes)
        self.lengths.append(len(record))
        self.open.append(record)
        self.open_bytes += len(record)

    def _close_frame(self) -> None:
        raw = b"".join(self.open)
        frame = self.compressor.compress(raw)
        self.done.append(frame)
        self.sizes.append((len(frame), len(raw)))
        self.open, self.open_bytes = [], 0

    @property
    def bytes(self) -> int:
        return sum(size for size, _ in self.sizes) + self.open_bytes

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        head = struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer))
        return b"".join(self.done) + head + table + footer


def frame_spans(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, raw) of every frame, from the footer alone."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    spans, start = [], 0
    for packed, raw in struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]):
        spans.append((start, packed, raw))
        start += packed
    return spans


def read_frame(bundle: bytes, span: tuple[int, int, int]) -> bytes:
    start, packed, raw = span
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], raw)


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and the page a revisit refers to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select(F.col("digest").alias("shared_digest"), "first_id")
    )
    # Stored, so that the join knows its size: without a shuffle when repeats are few, else a
    # sort-merge join whose hot digests adaptive execution splits.
    shared = stored(shared)
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(shared, F.col("digest") == F.col("shared_digest"), "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("first_id").isNotNull() & revisit, F.col("first_id")).alias("refers_to"),
    )


def _bundled(frame_bytes: int, bundle_bytes: int):
    def bundles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, writer = TaskContext.get().partitionId(), 0, BundleWriter(frame_bytes)

        def row() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{made:05d}.warc.zst"
            columns = [name, writer.finish(), writer.record_ids, writer.frames]
            columns += [writer.offsets, writer.lengths]
            return arrow_rows(_BUNDLES_ARROW, [[column] for column in columns])

        for batch in batches:
            for at in range(batch.num_rows):
                page, url, payload, digest, refers = (column[at].as_py() for column in batch.columns)
                writer.add(record_id(page), warc_record(page, url, payload, digest, refers))
                if writer.bytes >= bundle_bytes:
                    yield row()
                    made, writer = made + 1, BundleWriter(frame_bytes)
        if writer.record_ids:
            yield row()

    return bundles


def write_warc(
    pages: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> None:
    """Archive pages (page_id, url, html) below `path`."""
    rows = page_records(pages)
    rows.mapInArrow(_bundled(frame_bytes, bundle_bytes), _BUNDLES).write.mode("overwrite").parquet(
        path
    )


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BUNDLES).parquet(path)


def record_map(spark: SparkSession, path: str) -> DataFrame:
    """record_id, bundle, frame, offset in the frame and length; the content is not read."""
    arrays = ("record_ids", "frames", "offsets", "lengths")
    zipped = F.inline(F.arrays_zip(*arrays))
    return (
        read_bundles(spark, path)
        .select("bundle", zipped)
        .toDF("bundle", "record_id", "frame", "offset", "length")
    )


def _rows(records: list[tuple]) -> pa.RecordBatch:
    return arrow_rows(_RECORDS_ARROW, [list(column) for column in zip(*records)])


def _all_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            bundle = batch.column(0)[at].as_py()
            for span in frame_spans(bundle):
                yield _rows(list(parse_records(read_frame(bundle, span))))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive, frame by frame, payloads checked against their digests."""
    return read_bundles(spark, path).select("content").mapInArrow(_all_records, _RECORDS)


def _wanted_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            bundle, wanted = (column[at].as_py() for column in batch.columns)
            spans, frames = frame_spans(bundle), {}
            for want in wanted:
                frames.setdefault(want["frame"], []).append(want)
            for frame, wants in frames.items():
                raw = read_frame(bundle, spans[frame])
                pieces = (raw[w["offset"] : w["offset"] + w["length"]] for w in wants)
                yield _rows([row for piece in pieces for row in parse_records(piece)])


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Records of the pages named in `wanted.page_id`: their frames are opened and no others."""
    names = wanted.select(
        F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")).alias("want")
    ).distinct()
    places = (
        record_map(spark, path)
        .join(names, F.col("record_id") == F.col("want"), "left_semi")
        .groupBy("bundle")
        .agg(F.collect_list(F.struct("frame", "offset", "length")).alias("wants"))
    )
    found = read_bundles(spark, path).select("bundle", "content").join(places, "bundle")
    return found.select("content", "wants").mapInArrow(_wanted_records, _RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Pages written as WARC and read back: one row per page, without the payloads."""
    spark = pages.sparkSession
    path = scratch_folder(spark)
    write_warc(pages, path)
    return read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
