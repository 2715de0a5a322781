"""Token-id files: documents compressed one by one with a shared Zstandard dictionary.

Texts are encoded with the tokenizers library and an end id is added. The documents, in ascending
doc_id order, are cut into shards; in a shard every document is a Zstandard frame of its own,
compressed with a dictionary that was trained on serialised id arrays, so a short document costs
little and is read without its neighbours. A shard keeps the hash of its dictionary, and reading
with another dictionary is an error.

    shard = MAGIC, id width (u8), dictionary SHA-256 (32 bytes),
            frames,
            doc ids (i64 each), id counts (u32 each), frame ends (u64 each),
            number of documents (u32), MAGIC

A null doc_id is written as the smallest 64-bit integer. Shards are rows of a Parquet table (name,
number, content and totals), so task attempts are told apart by Spark's commit and any file system
will do. The rows are range-partitioned by doc_id, ties by a hash of the text; no task gets more than
its range. Null ids come first, null text is empty and leaves just the end id, long texts are kept
whole, and an empty table gives no shards.

The dictionary is fitted on at most `SAMPLE_DOCS` documents, those with the smallest hash, and of
each on at most `SAMPLE_BYTES` of its array. Everything else covers all documents.
"""

import hashlib
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import pretokens
from tillroll.llm.base import arrow_rows, held, stored, text_or_empty, text_slices
from tillroll.sinks.scratch import scratch_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
SAMPLE_DOCS = 512
SAMPLE_BYTES = 1 << 14
DICTIONARY_BYTES = 1 << 15
SHARD_BYTES = 1 << 22
ENCODED_CHARS = 12_000_000
KNOWN_STRETCHES = 2_000_000
LEVEL = 3
MAGIC = b"TIDS1\0"
NO_ID = -(1 << 63)

_HEAD = struct.Struct("<6sB32s")
_TAIL = struct.Struct("<I6s")
_SHARDS = (
    "shard string, part int, number int, n_docs bigint, n_tokens bigint, content binary"
)
_SHARDS_ARROW = pa.schema(
    [
        ("shard", pa.string()),
        ("part", pa.int32()),
        ("number", pa.int32()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("content", pa.binary()),
    ]
)


# A blank before a visible character always starts a piece of its own, so there texts can be cut.
_CUT = re.compile(r" (?=\S)")
_NO_CUT = ("  ", " \n", " \r", " \t")


class TextEncoder:
    """Ids of whole texts by the library, which sees every distinct stretch between blanks once.

    Stretches are told apart per slice in Arrow. What the library gave for them is kept as two Arrow
    arrays, stretches and their ids, so a million takes some tens of megabytes; when there are more
    than `KNOWN_STRETCHES`, those of the last slice are kept and the others learned anew.
    """

    def __init__(self, path: str):
        self.library, self.path = pretokens.tokenizer(path), path
        self.specials = tuple(pretokens.special_tokens(path))
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.after_blank = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.after_blank[[n for token, n in vocab.items() if token.startswith("Ġ")]] = True
        self.forget()

    def forget(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))

    def _alone(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, stretches: list[str]) -> pa.LargeListArray:
        """Ids of stretches behind a blank.

        Those without a blank inside are encoded some at a time as one text; there the tokens that
        begin with a blank are the ones that begin a stretch.
        """
        found, sizes = [], []
        for at in range(0, len(stretches), 200):
            part = stretches[at : at + 200]
            joined = " " + " ".join(part)
            ids = np.array(self.library.encode(joined, add_special_tokens=False).ids, "<u4")
            starts = np.flatnonzero(self.after_blank[ids])
            if joined.count(" ") != len(part) or len(starts) != len(part) or starts[0]:
                each = [np.frombuffer(self._alone(" " + stretch), "<u4") for stretch in part]
                found += each
                sizes += map(len, each)
            else:
                found.append(ids)
                sizes += np.diff(starts, append=len(ids)).tolist()
        values = np.concatenate(found) if found else np.empty(0, "<u4")
        return pa.LargeListArray.from_arrays(np.cumsum([0, *sizes]), pa.array(values, pa.uint32()))

    def _lists(self, names: pa.Array) -> pa.LargeListArray:
        """Ids of distinct stretches behind a blank."""
        if len(self.names) > KNOWN_STRETCHES:
            self.forget()
        place = pc.index_in(names, value_set=self.names)
        unseen = pc.is_null(place)
        fresh = names.filter(unseen)
        learned = self._learn(fresh.to_numpy(zero_copy_only=False).tolist())
        known = len(self.names)
        self.names = pa.concat_arrays([self.names, fresh])
        self.ids = pa.concat_arrays([self.ids, learned])
        rows = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows[unseen.to_numpy(zero_copy_only=False)] = known + np.arange(len(fresh))
        return self.ids.take(pa.array(rows))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        results: list[bytes] = [b""] * len(texts)
        plain, odd = [], []
        for place, text in enumerate(texts):
            if not pretokens.is_plain(text) or any(name in text for name in self.specials):
                results[place] = self._alone(text)
            elif text:
                blanks = text[-1] == " " or any(pair in text for pair in _NO_CUT)
                (odd if blanks else plain).append(place)
        places = plain + odd
        if not places:
            return results
        kind = pa.list_(pa.large_string())
        cut = pa.concat_arrays(
            [
                pc.split_pattern(pa.array([texts[p] for p in plain], pa.large_string()), " ").cast(kind),
                pa.array([_CUT.split(texts[p]) for p in odd], kind),
            ]
        )
        bounds = cut.offsets.to_numpy()
        firsts, flat = bounds[:-1], cut.flatten().dictionary_encode()
        numbers, names = flat.indices.to_numpy().copy(), flat.dictionary
        # The first stretch of a text has no blank before it.
        opening = [self._alone(names[number].as_py()) for number in numbers[firsts]]
        inner, used = np.ones(len(numbers), bool), np.zeros(len(names), bool)
        inner[firsts] = False
        used[numbers[inner]] = True
        lists = self._lists(names.filter(pa.array(used)))
        ends = np.cumsum([0, *(len(ids) // 4 for ids in opening)])
        first_ids = pa.array(np.frombuffer(b"".join(opening), "<u4"), pa.uint32())
        numbers = (np.cumsum(used) - 1)[numbers]
        numbers[firsts] = len(lists) + np.arange(len(places))
        lists = pa.concat_arrays([lists, pa.LargeListArray.from_arrays(ends, first_ids)])
        taken = lists.take(pa.array(numbers))
        values, ends = taken.flatten().to_numpy(), taken.offsets.to_numpy()
        bounds = ends[bounds] - ends[0]
        for place, start, end in zip(places, bounds, bounds[1:]):
            results[place] = values[start:end].tobytes()
        return results


def encoder(path: str = TOKENIZER) -> TextEncoder:
    return held(("token files", path), lambda: TextEncoder(path))


def id_width(path: str) -> int:
    return 2 if pretokens.tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


class ShardWriter:
    def __init__(self, dictionary: bytes, width: int):
        self.width, shared = width, _dictionary(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        self.hash = hashlib.sha256(dictionary).digest()
        self.start()

    def start(self) -> None:
        self.frames, self.bytes, self.tokens = [], 0, 0
        self.doc_ids, self.counts, self.ends = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(narrow(ids, self.width))
        self.frames.append(frame)
        self.bytes += len(frame)
        self.tokens += len(ids) // 4
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        self.ends.append(self.bytes)

    def finish(self) -> bytes:
        index = (("<i8", self.doc_ids), ("<u4", self.counts), ("<u8", self.ends))
        return b"".join(
            [
                _HEAD.pack(MAGIC, self.width, self.hash),
                *self.frames,
                *(np.array(values, kind).tobytes() for kind, values in index),
                _TAIL.pack(len(self.doc_ids), MAGIC),
            ]
        )


class Shard:
    """A shard's bytes opened by its index; a document is decompressed when asked for."""

    def __init__(self, content: bytes, dictionary: bytes):
        magic, self.width, used = _HEAD.unpack_from(content)
        n, magic_too = _TAIL.unpack_from(content, len(content) - _TAIL.size)
        if magic != MAGIC or magic_too != MAGIC:
            raise ValueError("not a token-id shard")
        if used != hashlib.sha256(dictionary).digest():
            raise ValueError("shard was written with another dictionary")
        at = len(content) - _TAIL.size - 20 * n
        self.content = content
        self.doc_ids = np.frombuffer(content, "<i8", n, at)
        self.counts = np.frombuffer(content, "<u4", n, at + 8 * n)
        self.ends = np.frombuffer(content, "<u8", n, at + 12 * n)
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, place: int) -> np.ndarray:
        start = _HEAD.size + (int(self.ends[place - 1]) if place else 0)
        frame = self.content[start : _HEAD.size + int(self.ends[place])]
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")


def _sample_arrays(path: str):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = encoder(path).encode, id_width(path)
        schema = pa.schema([("ids", pa.binary())])
        for _, texts in text_slices(batches):
            arrays = [narrow(ids[: 4 * SAMPLE_BYTES // width], width) for ids in encode(texts)]
            yield arrow_rows(schema, [arrays])

    return rows


def train_dictionary(docs: DataFrame, path: str = TOKENIZER) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to train on."""
    rows = _documents(docs)
    picked = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    names = [row.doc_id for row in picked.collect() if row.doc_id is not None]
    sample = rows.where(F.col("doc_id").isin(names)).orderBy("doc_id").limit(SAMPLE_DOCS)
    arrays = [bytes(r.ids) for r in sample.mapInArrow(_sample_arrays(path), "ids binary").collect()]
    arrays = [array for array in arrays if len(array) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _sharded(path: str, dictionary, end_id: int, shard_bytes: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        writer = ShardWriter(dictionary, id_width(path))

        def row() -> pa.RecordBatch:
            name = f"tokens-{part:06d}-{number:05d}"
            totals = [len(writer.doc_ids), writer.tokens, writer.finish()]
            return arrow_rows(_SHARDS_ARROW, [[v] for v in (name, part, number, *totals)])

        for slice_, texts in text_slices(batches, chars=ENCODED_CHARS):
            for doc_id, ids in zip(slice_.column(0).to_pylist(), encode(texts)):
                writer.add(doc_id, ids + end)
                if writer.bytes >= shard_bytes:
                    yield row()
                    number += 1
                    writer.start()
        if writer.doc_ids:
            yield row()

    return rows


def write_tokens(
    docs: DataFrame,
    out: str,
    path: str = TOKENIZER,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode documents into `out`/shards and `out`/dictionary."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path)
    hashed = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(hashed, dictionary)], "sha256 string, content binary").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{out}/dictionary")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = _documents(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ordered.mapInArrow(_sharded(path, dictionary, end_id, shard_bytes), _SHARDS)
    shards.write.mode("overwrite").parquet(f"{out}/shards")


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """Shards with `first`, the number of ids in all shards before."""
    shards = spark.read.schema(_SHARDS).parquet(f"{out}/shards")
    # One small row for each shard of some megabytes, summed per writing task and then over tasks.
    totals = shards.select("shard", "part", "number", "n_tokens")
    tasks = totals.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(
        F.col("part").alias("in_part"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        totals.withColumn("upto", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(tasks, F.col("part") == F.col("in_part"))
        .select(F.col("shard").alias("named"), (F.col("base") + F.col("upto")).alias("first"))
    )
    # Stored, so that the join knows its size and need not shuffle the shards.
    firsts = stored(firsts)
    return shards.join(firsts, F.col("shard") == F.col("named")).drop("named")


def read_dictionary(spark: SparkSession, out: str) -> bytes:
    return bytes(spark.read.parquet(f"{out}/dictionary").first().content)


def _number(doc_id) -> int | None:
    return None if doc_id == NO_ID else int(doc_id)


def token_rows(spark: SparkSession, out: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and `ids` of every document, from the files."""
    dictionary = read_dictionary(spark, out)
    fields = [(name, pa.int64()) for name in ("doc_id", "start", "n_tokens", "ids_crc32")]
    schema = pa.schema([*fields, ("ids", pa.list_(pa.int32()))] if with_ids else fields)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard = Shard(batch.column(0)[at].as_py(), dictionary)
                start, found, held = batch.column(1)[at].as_py(), [], 0
                for place, doc_id in enumerate(shard.doc_ids):
                    ids = shard.ids(place).astype("<u4")
                    crc = zlib.crc32(ids.tobytes())
                    row = (_number(doc_id), start, len(ids), crc)
                    found.append((*row, ids.astype("<i4")) if with_ids else row)
                    start, held = start + len(ids), held + len(ids)
                    if held >= 1 << 20:
                        yield arrow_rows(schema, [list(column) for column in zip(*found)])
                        found, held = [], 0
                if found:
                    yield arrow_rows(schema, [list(column) for column in zip(*found)])

    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    shards = read_shards(spark, out).select("content", "first")
    return shards.mapInArrow(rows, f"{columns}, ids array<int>" if with_ids else columns)


def token_digests(docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Documents written to token-id files and read back: place, length and checksum of each."""
    out = scratch_folder(docs.sparkSession)
    write_tokens(docs, out, path, end_id)
    return token_rows(docs.sparkSession, out, with_ids=False)
