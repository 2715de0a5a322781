"""Exact duplicates by content sort.

Texts are compared after lower-casing A-Z; null counts as empty. Sampled splitters range-partition
the rows, an external sort puts equal texts next to each other, and each task compares every text in
full with the one before it. Rows stand in the order of their first bytes; below those, of a hash of
the whole text, then of the text, then of the id. Splitters are thus some bytes each, however long
the texts are, and neither a text nor a beginning that a third of all rows hold stays in one task,
which keeps ids of one run, never its texts. What reaches the edge of a task's range may go on in
the next: those rows, and only those, meet by the SHA-256 of the whole text, in an aggregate that
combines before its shuffle.

Of equal texts the row with the largest id stays (`keep="largest"`), or the smallest. Null ids sort
before all others. Of rows that repeat both id and text exactly one stays. An empty table gives an
empty result; columns beside id and text are ignored.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.base import arrow_rows, folded, stored, text_or_empty

_RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("edge", T.BooleanType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()),
    ]
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("last", pa.bool_()),
        ("edge", pa.bool_()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
    ]
)
EMIT_ROWS = 50_000
HEAD_CHARS = 16


class _Run:
    """Equal neighbours: the text once, the ids of all."""

    def __init__(self, text: bytes):
        self.text, self.ids = text, []

    def rows(self, edge: bool) -> pa.RecordBatch:
        ids = pa.chunked_array(self.ids).combine_chunks()
        n = len(ids)
        digest = hashlib.sha256(self.text).digest()
        last = np.zeros(n, bool)
        last[-1] = True
        return arrow_rows(
            _ARROW,
            [
                ids,
                pa.repeat(pa.scalar(digest, pa.binary()), n),
                pa.array(last),
                pa.repeat(pa.scalar(edge), n),
                pa.nulls(n, pa.int64()) if edge else pa.repeat(ids[-1], n),
                pa.repeat(pa.scalar(n, pa.int64()), n),
            ],
        )


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before; the first counts as different."""
    differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
    return np.concatenate([[True], differs.to_numpy(zero_copy_only=False)])


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to rows with the digest and, off the edges, the verdict.

    Runs are held while the hash stays the same. The first and the last hash of a task are its
    edges; on them, texts that share a hash can go on in the next task in any order.
    """
    group, group_hash, first, pending, held = [], None, True, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, hashes, texts = batch.column(0), batch.column(1), batch.column(2).cast(pa.large_binary())
        starts = np.flatnonzero(_changes(texts) | _changes(hashes))
        for start, end in zip(starts, [*starts[1:], len(texts)]):
            text, text_hash = texts[start].as_py(), hashes[start].as_py()
            if group and text_hash != group_hash:
                pending += [run.rows(first) for run in group]
                held += sum(rows.num_rows for rows in pending[-len(group) :])
                group, first = [], False
            group_hash = text_hash
            if not group or group[-1].text != text:
                group.append(_Run(text))
            group[-1].ids.append(ids.slice(start, end - start))
            if held >= EMIT_ROWS:
                yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
                pending, held = [], 0
    pending += [run.rows(True) for run in group]
    if pending:
        yield from pa.Table.from_batches(pending).combine_chunks().to_batches()


def exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep}")
    order = F.asc_nulls_first if keep == "largest" else F.desc_nulls_first
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), folded(text_or_empty()).alias("norm")
    ).withColumns({"head": F.substring("norm", 1, HEAD_CHARS), "hash": F.xxhash64("norm")})
    ordered = rows.repartitionByRange("head", "hash", order("doc_id")).sortWithinPartitions(
        "head", "hash", "norm", order("doc_id")
    )
    runs = stored(ordered.select("doc_id", "hash", "norm").mapInArrow(_runs, _RUNS))
    pick = F.max if keep == "largest" else F.min
    # A row or two for each task, stored so that the join knows and need not shuffle a hot text.
    met = stored(
        runs.where("edge")
        .groupBy("digest")
        .agg(pick("doc_id").alias("met_id"), F.count("*").alias("met_size"))
    )
    edges = (
        runs.where("edge")
        .join(met, "digest")
        .select("doc_id", "digest", "last", "met_id", "met_size")
    )
    inner = runs.where("NOT edge").select("doc_id", "digest", "last", "keep_id", "group_size")
    return (
        inner.union(edges)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("last") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that stay, all columns. Rows that repeat id and text leave one row behind."""
    kept = stored(exact_duplicates(docs, keep).where("kept").select("doc_id", "text_sha256"))
    digest = F.sha2(folded(text_or_empty()), 256)
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__kept_id"))
    # Ids are unique as a rule. Only where one repeats must rows also agree on the text, and only
    # those rows are compared by it.
    repeated = docs.groupBy(F.col("doc_id").cast("long").alias("__twice")).agg(F.count("*").alias("n"))
    repeated = stored(repeated.where("n > 1").select("__twice"))
    twice = F.col("doc_id").cast("long").eqNullSafe(F.col("__twice"))
    once = docs.join(kept, same, "left_semi").join(repeated, twice, "left_anti")
    again = (
        docs.join(repeated, twice, "left_semi")
        .withColumn("__sha", digest)
        .join(kept, same & (F.col("__sha") == F.col("__kept_sha")), "left_semi")
    )
    names = docs.columns
    first = again.groupBy("doc_id", "__sha").agg(
        F.first(F.struct(*(F.col(name) for name in names))).alias("__row")
    )
    return once.unionByName(first.select(*(F.col("__row")[name].alias(name) for name in names)))
