"""Helpers the operators share: null-safe text, Arrow batches in small slices, stored tables."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sinks.scratch import scratch_folder

SLICE_CHARS = 2_000_000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def folded(text: Column) -> Column:
    """A-Z lower-cased and nothing else. `lower` is the same for pure ASCII, and much faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    translated = F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    return F.when(ascii_only, F.lower(text)).otherwise(translated)


def stored(df: DataFrame) -> DataFrame:
    """The frame written below the shared checkpoint folder and read back.

    Cuts the lineage with files that outlive any executor; column pruning stays.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict = {}


def held(key, make):
    """What a Python worker keeps from task to task, of one operator at a time.

    Workers are used again by the next stages of a job; what an earlier operator left is let go.
    """
    if key not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[key] = make()
    return _HELD[key]


def batch_slices(
    batches: Iterable[pa.RecordBatch], text: int = 1, chars: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """Rows of Arrow batches in order, cut so that a slice holds about `chars` characters.

    A longer text makes a slice of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > chars:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size + 1
        if start < len(sizes):
            yield batch.slice(start)


def text_slices(
    batches: Iterable[pa.RecordBatch], text: int = 1, chars: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices with their texts; no more than one long text is held as Python text at a time."""
    for part in batch_slices(batches, text, chars):
        yield part, part.column(text).to_pylist()


def arrow_rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, kind.type)
        for column, kind in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
