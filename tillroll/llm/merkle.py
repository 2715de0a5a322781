"""Merkle manifest of a dataset: digests are kept every few levels, proofs work out the rest anew.

A document's leaf is a digest over its fields. The leaves of a source, in ascending doc_id order, are
the bottom of a tree in which every `fan` consecutive nodes make one of the next level, until one is
left; the sources' roots, ordered by source, are the bottom of a tree of the same kind, whose root
stands for the dataset.

Of every `stride` levels only one is written. A node `stride` levels up stands on an aligned subtree
of at most `fan ** stride` written nodes, so such subtrees are the unit of work: one is dealt to a
task as a whole, whatever its source holds, and a source with a third of all rows is as many of them
as its size asks for. Building writes the top of each subtree. For proofs, the subtrees are gone
through from the top down: a subtree's own path comes from the one above, its missing inner nodes are
hashed again from the written ones below, each of those gets its siblings, and the inner nodes are
dropped. The number of levels, and of jobs, is the logarithm of the largest source.

Places in a source come from a range partitioning by (source, doc_id), the row numbers inside the
partitions, and running sums over partitions. Texts are hashed where they are read; only digests move.

Null fields are part of the leaf under a mark of their own. A null source is a source and comes first,
as do null ids in a source. Rows that share an id follow the order of their leaves' first 15 digits;
rows that are equal have equal leaves and a place each, so every row has a proof. Empty and long texts are hashed
like others. Columns beside the hashed ones are ignored, whatever their names. An empty table has a
manifest without root and gives no rows.
"""

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, folded, stored
from tillroll.sinks.scratch import scratch_folder

FAN = 16
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# monotonically_increasing_id counts rows below this bit and partitions from it on.
_PART_BIT = 33

_NODES = "tree string, place bigint, total bigint, digest string"
_NODES_ARROW = pa.schema(
    [("tree", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.string())]
)
_PATH = "before array<string>, after array<string>, subroot string"
_PATH_ARROW = [
    ("before", pa.list_(pa.string())),
    ("after", pa.list_(pa.string())),
    ("subroot", pa.string()),
]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """Leaf of a document, of another text in its place if one is given."""
    fields = [F.col(name) for name in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256)


def tampered_leaf(share: int = 5) -> Column:
    """Leaf of a document whose text lost its A-Z if `share` divides the id's checksum, else its own."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % share == 0
    return F.when(chosen, leaf_digest(folded(F.col("text").cast("string")))).otherwise(leaf_digest())


def levels_in(total: int, fan: int, stride: int) -> int:
    """Levels above a row of `total` nodes, at most `stride`."""
    levels = 0
    while total > 1 and levels < stride:
        total, levels = -(-total // fan), levels + 1
    return levels


def layers(digests: list[str], levels: int, fan: int) -> list[list[str]]:
    """The nodes of a subtree level by level, from the given ones to its top."""
    found = [digests]
    for _ in range(levels):
        row = found[-1]
        found.append([digest("".join(row[at : at + fan])) for at in range(0, len(row), fan)])
    return found


def folded_up(leaf: str, before: Iterable[str], after: Iterable[str]) -> str:
    """What a leaf and its siblings make at the top."""
    for left, right in zip(before, after):
        leaf = digest(f"{left}{leaf}{right}")
    return leaf


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` with their place in their tree under `order` and the tree's total."""
    keys = [F.col("tree").asc_nulls_first(), *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", _PART_BIT)
    held = ordered.groupBy("tree", part.alias("part")).agg(
        F.count("*").alias("held"), F.min("at").alias("first")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")
    # A row for each tree in each partition; stored, so that the join knows its size.
    heads = stored(
        held.select(
            F.col("tree").alias("head_tree"),
            F.col("part").alias("head_part"),
            shift.alias("shift"),
            F.sum("held").over(tree).alias("total"),
        )
    )
    same = F.col("tree").eqNullSafe(F.col("head_tree")) & (part == F.col("head_part"))
    return (
        ordered.join(heads, same)
        .withColumn("place", F.col("at") + F.col("shift"))
        .select(*rows.columns, "place", "total")
    )


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _block(fan: int, stride: int) -> Column:
    return F.floor(F.col("place") / F.lit(fan**stride)).cast("long").alias("block")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each subtree; tree and block are the first two columns."""
    rows = (row for b in batches for row in zip(*(column.to_pylist() for column in b.columns)))
    for key, group in groupby(rows, key=lambda row: row[:2]):
        yield key, list(group)


def _tops(fan: int, stride: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for (tree, block), group in _groups(batches):
            total = group[0][3]
            top = layers([row[4] for row in group], levels_in(total, fan, stride), fan)[-1][0]
            found.append((tree, block, -(-total // fan**stride), top))
            if len(found) >= 10_000:
                yield arrow_rows(_NODES_ARROW, [list(column) for column in zip(*found)])
                found = []
        if found:
            yield arrow_rows(_NODES_ARROW, [list(column) for column in zip(*found)])

    return rows


def _raised(spark: SparkSession, path: str, fan: int, stride: int) -> int:
    """Write the kept levels above `path`/0; how many there are then."""
    level = 0
    while True:
        nodes = spark.read.parquet(f"{path}/{level}")
        if (nodes.agg(F.max("total")).first()[0] or 1) <= 1:
            return level + 1
        open_ = nodes.where("total > 1").select("tree", _block(fan, stride), "place", "total", "digest")
        tops = _dealt(open_).mapInArrow(_tops(fan, stride), _NODES)
        level += 1
        tops.write.mode("overwrite").parquet(f"{path}/{level}")


@dataclass(frozen=True)
class Manifest:
    """Where the kept levels lie: `sources`/0 holds the leaves, `top`/0 the sources' roots."""

    path: str
    fan: int
    stride: int
    levels: int
    top_levels: int
    root: str | None

    def nodes(self, spark: SparkSession, level: int, tree: str = "sources") -> DataFrame:
        return spark.read.parquet(f"{self.path}/{tree}/{level}")


def write_manifest(
    docs: DataFrame, path: str, claimed: Column | None = None, fan: int = FAN, stride: int = STRIDE
) -> Manifest:
    """Write the manifest of documents below `path`.

    `claimed` is a leaf that someone else has for the document, kept beside its own to be verified.
    """
    spark = docs.sparkSession
    leaf = leaf_digest()
    rows = stored(
        docs.select(
            F.col("source").cast("string").alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf.alias("digest"),
            (leaf if claimed is None else claimed).alias("claimed"),
            # Equal rows are told apart, so that many of them need not be in one partition.
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    # The first digits of a leaf as a number: sampled keys go to the driver, so they are kept small.
    start = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    order = [F.col("doc_id").asc_nulls_first(), start, F.col("tie")]
    leaves = _placed(rows, order).drop("tie")
    leaves.write.mode("overwrite").parquet(f"{path}/sources/0")
    levels = _raised(spark, f"{path}/sources", fan, stride)
    ended = [
        spark.read.parquet(f"{path}/sources/{level}")
        .where("total = 1")
        .select(F.col("tree").alias("source"), "digest", F.lit(level).alias("ended"))
        for level in range(levels)
    ]
    roots = reduce(DataFrame.union, ended).withColumn("tree", F.lit("").cast("string"))
    _placed(roots, [F.col("source").asc_nulls_first()]).write.mode("overwrite").parquet(f"{path}/top/0")
    top_levels = _raised(spark, f"{path}/top", fan, stride)
    root = spark.read.parquet(f"{path}/top/{top_levels - 1}").where("total = 1").first()
    made = (fan, stride, levels, top_levels, root.digest if root else None)
    spark.createDataFrame(
        [made], "fan int, stride int, levels int, top_levels int, root string"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return Manifest(path, *made)


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    return Manifest(path, *spark.read.parquet(f"{path}/manifest").first())


def _with_heads(nodes: DataFrame, heads: DataFrame, fan: int, stride: int, own: list[str]) -> DataFrame:
    """Nodes by subtree, each subtree behind a row (place -1) with the path of its top."""
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in _PATH.split(", "))]
    below = nodes.select("tree", _block(fan, stride), "place", "total", *own, *empty)
    kinds = {field.name: field.dataType for field in below.schema}
    above = heads.select(
        "tree",
        F.col("place").alias("block"),
        F.lit(-1).cast("long").alias("place"),
        *(F.lit(None).cast(kinds[name]).alias(name) for name in ("total", *own)),
        "before",
        "after",
        "subroot",
    )
    return _dealt(below.union(above))


def _pathed(batches: Iterable[pa.RecordBatch], fan: int, stride: int) -> Iterator[tuple]:
    """(node, path of its siblings from below) of each subtree; nodes as the rows they came in.

    The path is (left siblings, right siblings) level by level, and the root of the source.
    """
    for _, (head, *group) in _groups(batches):
        if not group:
            continue
        *_, above_left, above_right, subroot = head
        found = layers([row[4] for row in group], levels_in(group[0][3], fan, stride), fan)[:-1]
        # From the subtree's top down: the path of each node of a level, from those above it.
        paths = [(above_left, above_right)]
        for layer in reversed(found):
            lower = []
            for at in range(len(layer)):
                first = at // fan * fan
                left, right = paths[at // fan]
                lower.append(
                    (
                        ["".join(layer[first:at]), *left],
                        ["".join(layer[at + 1 : first + fan]), *right],
                    )
                )
            paths = lower
        for row, path in zip(group, paths):
            yield row, *path, subroot


def _in_batches(schema: pa.Schema, found: Iterable[tuple], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for row in found:
        rows.append(row)
        if len(rows) >= size:
            yield arrow_rows(schema, [list(column) for column in zip(*rows)])
            rows = []
    if rows:
        yield arrow_rows(schema, [list(column) for column in zip(*rows)])


def _paths(nodes: DataFrame, heads: DataFrame, fan: int, stride: int) -> DataFrame:
    """tree, place and path of every node, stored."""
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), *_PATH_ARROW])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((row[0], row[2], *path) for row, *path in _pathed(batches, fan, stride))
        return _in_batches(schema, made, 500)

    dealt = _with_heads(nodes, heads, fan, stride, ["digest"])
    return stored(dealt.mapInArrow(rows, f"tree string, place bigint, {_PATH}"))


def _heads(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Paths of the tops of all subtrees of leaves."""
    fan, stride = manifest.fan, manifest.stride
    columns = ["tree", "place", "before", "after", "subroot"]
    empty = F.array().cast("array<string>")
    heads = spark.range(1).select(
        F.lit("").alias("tree"),
        F.lit(0).cast("long").alias("place"),
        empty.alias("before"),
        empty.alias("after"),
        F.lit(None).cast("string").alias("subroot"),
    )
    for level in reversed(range(manifest.top_levels)):
        heads = _paths(manifest.nodes(spark, level, "top"), heads, fan, stride)
    tops = manifest.nodes(spark, 0, "top").select("source", "ended", "digest", F.col("place").alias("at"))
    # One row for each source; the sources' trees end at different levels.
    ends = stored(
        heads.join(tops, F.col("place") == F.col("at")).select(
            F.col("source").alias("tree"),
            F.lit(0).cast("long").alias("place"),
            "before",
            "after",
            F.col("digest").alias("subroot"),
            "ended",
        )
    )
    found = ends.where(F.col("ended") == manifest.levels - 1).select(columns)
    for level in reversed(range(1, manifest.levels)):
        below = _paths(manifest.nodes(spark, level), found, fan, stride)
        found = below.union(ends.where(F.col("ended") == level - 1).select(columns))
    return found


def _leaf_groups(spark: SparkSession, manifest: Manifest) -> DataFrame:
    heads = _heads(spark, manifest)
    own = ["digest", "claimed", "doc_id"]
    return _with_heads(manifest.nodes(spark, 0), heads, manifest.fan, manifest.stride, own)


def proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """source, doc_id, place, leaf, subroot and the siblings of every document, level by level."""
    fan, stride = manifest.fan, manifest.stride
    schema = pa.schema(
        [
            ("source", pa.string()),
            ("doc_id", pa.int64()),
            ("place", pa.int64()),
            ("leaf", pa.string()),
            *_PATH_ARROW,
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (
            (row[0], row[6], row[2], row[4], *path) for row, *path in _pathed(batches, fan, stride)
        )
        return _in_batches(schema, made, 500)

    return _leaf_groups(spark, manifest).mapInArrow(
        rows, f"source string, doc_id bigint, place bigint, leaf string, {_PATH}"
    )


def verified(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Every document's proof as a digest, the root its claimed leaf folds up to, and whether it is it.

    Siblings are used where they are worked out and never leave the task.
    """
    fan, stride, root = manifest.fan, manifest.stride, manifest.root
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema(
        [("doc_id", pa.int64()), *((name, pa.string()) for name in texts), ("verified", pa.bool_())]
    )

    def judged(row: tuple, before: list[str], after: list[str], subroot: str) -> tuple:
        siblings = "".join(text for pair in zip(before, after) for text in pair)
        reached = folded_up(row[5], before, after)
        return row[6], row[4], subroot, root, digest(siblings), reached, reached == root

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(schema, (judged(*found) for found in _pathed(batches, fan, stride)))

    columns = ", ".join(f"{name} string" for name in texts)
    return _leaf_groups(spark, manifest).mapInArrow(rows, f"doc_id bigint, {columns}, verified boolean")


def manifest_digests(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """Documents written to a manifest, and each verified against it with its claimed leaf."""
    spark = docs.sparkSession
    path = scratch_folder(spark)
    write_manifest(docs, path, claimed)
    return verified(spark, read_manifest(spark, path))
