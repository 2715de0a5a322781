"""Near duplicates by DartMinHash signatures, banded joining and exact checks.

Texts are lower-cased words; a text's set holds its stretches of five words (one of all words, if it
has fewer), each with a weight of 1, or of its number of occurrences. Near means that the weighted
Jaccard similarity of two sets is at least the threshold.

Signatures: every element owns regions of the plane (weight, time): the weights from 0 to 1, from 1
to 2, from 2 to 4 and so on. Darts, whose times and places follow from a hash of element and region,
hit a region at the rate of its width; those below the element's weight count. A dart falls to one of
`COORDINATES` coordinates, and each keeps its earliest dart. Darts are thrown up to a time at which
about k ln k + 2k have counted for the whole set, twice as long if a coordinate is still empty. Two
sets agree in a coordinate with a chance equal to their similarity.

Joining: equal sets are one node. Nodes with equal band keys share a bucket. First every node is
compared with one hub per bucket, so a bucket costs as many comparisons as it has nodes, and the
links found join most of a group of copies. Then, where a bucket still holds several components, the
nodes outside the hub's component are compared with the bucket's others in blocks inside a task: pairs
that are not joined yet and were not met in an earlier band by their signatures, those that agree in
enough coordinates by their sets with elements cut to 32 bits, which can only make sets look more
alike. A task gives out what passes for a link, and that is checked on the whole sets. What is missed is what signatures miss: about 3 in 100,000 pairs just at the
threshold share no band, and as many fall short of the agreement asked for; more similar pairs far
fewer.

Classes are the components of the links, named by their smallest doc_id, which is the document that
stays. A null or wordless text is a class of its own. A null doc_id is never the name of a class
unless nobody in it has one. Rows that repeat a doc_id are judged by their texts. An empty table
gives an empty result. Columns beside doc_id and text are ignored.
"""

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tillroll.llm.base import arrow_rows, held, stored, text_or_empty, text_slices
from tillroll.llm.components import components
from tillroll.llm.pretokens import PieceCache

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 4
COORDINATES = 128
BLOCK = 1_000
KNOWN_WORDS = 100_000

_WORD = re.compile(r"\w+")
_U64 = np.uint64
# Multipliers of the splitmix64 mixer.
_MIX1, _MIX2, _STEP = _U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB), _U64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """Splitmix64 of unsigned 64-bit values."""
    values = values + _STEP
    values = (values ^ (values >> _U64(30))) * _MIX1
    values = (values ^ (values >> _U64(27))) * _MIX2
    return values ^ (values >> _U64(31))


def uniform(values: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((values >> _U64(11)).astype(np.float64) + 1) * 2.0**-53


def _word_hashes() -> PieceCache:
    return held("word hashes", lambda: PieceCache(xxhash.xxh3_64_intdigest, KNOWN_WORDS))


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the stretches of words of a text, and how often each stands there."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, found), np.uint64, len(found))
    size = min(words, len(hashes))
    joined = np.full(len(hashes) - size + 1, size, np.uint64)
    for place in range(size):
        joined = joined * _MIX1 + hashes[place : len(hashes) - size + 1 + place]
    return np.unique(mixed(joined), return_counts=True)


def darts(
    elements: np.ndarray, weights: np.ndarray, until: float
) -> tuple[np.ndarray, np.ndarray]:
    """Names and times of the darts that hit below the elements' weights up to a time.

    The darts of an element's region follow each other at exponential gaps. Each gap comes from a
    hash of element, region and number, some numbers at once for all elements still in time.
    """
    names, times = [], []
    low, region = 0.0, 0
    while len(elements):
        high = max(1.0, 2 * low)
        width = high - low
        base = mixed(elements ^ mixed(np.array([region], np.uint64)))
        limits, at, number = weights, np.zeros(len(elements)), 1
        while len(base):
            ahead = max(1, math.ceil((until - at.min()) * width))
            states = mixed(base[:, None] + _STEP * np.arange(number, number + ahead, dtype=np.uint64))
            arrivals = at[:, None] + np.cumsum(-np.log(uniform(states)), axis=1) / width
            inside = arrivals <= until
            hit = inside
            if limits.min() < high:
                places = low + width * (1 - uniform(mixed(states ^ _MIX1)))
                hit = inside & (places < limits[:, None])
            names.append(states[hit])
            times.append(arrivals[hit])
            still = inside[:, -1]
            base, limits, at = base[still], limits[still], arrivals[still, -1]
            number += ahead
        higher = weights > high
        elements, weights, low, region = elements[higher], weights[higher], high, region + 1
    return mixed(np.concatenate(names) ^ _MIX2), np.concatenate(times)


def signature(
    elements: np.ndarray, weights: np.ndarray, coordinates: int = COORDINATES
) -> np.ndarray:
    """The name of the earliest dart in each coordinate."""
    until = coordinates * (math.log(coordinates) + 2) / weights.sum()
    while True:
        names, times = darts(elements, weights, until)
        fallen = (names % _U64(coordinates)).astype(np.int64)
        if np.bincount(fallen, minlength=coordinates).all():
            order = np.argsort(-times)
            kept = np.empty(coordinates, np.uint64)
            kept[fallen[order]] = names[order]
            return kept
        until *= 2


def band_keys(kept: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for row in range(rows):
        keys = mixed(keys ^ kept[row : bands * rows : rows])
    return keys.view(np.int64)


def sketch(kept: np.ndarray) -> bytes:
    """Sixteen bits of every coordinate."""
    return (kept >> _U64(48)).astype("<u2").tobytes()


def node_name(elements: np.ndarray, weights: np.ndarray) -> bytes:
    return hashlib.md5(elements.tobytes() + weights.tobytes()).digest()


@dataclass(frozen=True)
class Measure:
    """What similar means."""

    words: int = WORDS
    threshold: float = THRESHOLD
    counted: bool = False

    def elements(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = shingles(text, self.words)
        return hashes, counts.astype(np.float64) if self.counted else np.ones(len(hashes))

    @property
    def least_agreement(self) -> int:
        """Coordinates that agree at the threshold, less four standard deviations."""
        mean, n = self.threshold, COORDINATES
        return math.floor(n * mean - 4 * math.sqrt(n * mean * (1 - mean)))


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def signatures(docs: DataFrame, measure: Measure) -> DataFrame:
    """doc_id, node, total weight, band keys and sketch; null but for doc_id without words."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("node", pa.binary()),
            ("total", pa.float64()),
            ("keys", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            nodes, totals, keys, sketches = [], [], [], []
            for text in texts:
                elements, weights = measure.elements(text)
                if len(elements):
                    kept = signature(elements, weights)
                    nodes.append(node_name(elements, weights))
                    totals.append(weights.sum())
                    keys.append(band_keys(kept))
                    sketches.append(sketch(kept))
                else:
                    for column in (nodes, totals, keys, sketches):
                        column.append(None)
            yield arrow_rows(schema, [part.column(0), nodes, totals, keys, sketches])

    return _documents(docs).mapInArrow(
        rows, "doc_id bigint, node binary, total double, keys array<bigint>, sketch binary"
    )


def node_sets(docs: DataFrame, measure: Measure) -> DataFrame:
    """node with its elements, one that counts n times being n, and with 32 bits of each, sorted."""
    schema = pa.schema(
        [("node", pa.binary()), ("elements", pa.list_(pa.int64())), ("short", pa.binary())]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            nodes, sets, shorts = [], [], []
            for text in texts:
                elements, weights = measure.elements(text)
                if len(elements):
                    units = _copies(elements, weights)
                    nodes.append(node_name(elements, weights))
                    sets.append(units.view(np.int64))
                    shorts.append(np.sort(units.astype("<u4")).tobytes())
            yield arrow_rows(schema, [nodes, sets, shorts])

    return _documents(docs).mapInArrow(
        rows, "node binary, elements array<bigint>, short binary"
    )


def _copies(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Every element once for each unit of its weight, under names of their own."""
    times = weights.astype(np.int64)
    first = np.repeat(np.cumsum(times) - times, times)
    number = (np.arange(times.sum()) - first).astype(np.uint64)
    return mixed(np.repeat(elements, times) + number * _STEP)


def checked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    elements = sets.select("node", "elements")
    first, second = elements.toDF("a", "a_elements"), elements.toDF("b", "b_elements")
    both = pairs.join(second, "b").join(first, "a")
    shared = F.size(F.array_intersect("a_elements", "b_elements"))
    union = F.size("a_elements") + F.size("b_elements") - shared
    return both.where(shared >= threshold * union).select("a", "b")


def _reachable(a: str, b: str, threshold: float):
    """Whether two total weights allow the similarity; a hair is left for rounding."""
    return F.least(a, b) >= (threshold - 1e-9) * F.greatest(a, b)


def hub_pairs(members: DataFrame, buckets: DataFrame, threshold: float) -> DataFrame:
    """Every node with the hub of each of its buckets."""
    met = members.join(buckets, "key").where(F.col("node") != F.col("hub"))
    near = met.where(_reachable("total", "hub_total", threshold))
    ordered = [F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")]
    return near.select(*ordered).distinct()


def _shared_at_most(elements: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """For each other set an upper bound of the elements shared: equal in 32 bits."""
    flat = np.concatenate(others)
    place = np.minimum(np.searchsorted(elements, flat), len(elements) - 1)
    starts = np.cumsum([0, *(len(other) for other in others[:-1])])
    return np.add.reduceat((elements[place] == flat).astype(np.int64), starts)


def _block_links(measure: Measure):
    """Cells of blocks to compare, sorted, to the pairs in them that pass for links.

    A cell's first rows are the nodes outside the hub's component, its others the bucket's nodes.
    Pairs of one component, pairs met in an earlier band, and pairs whose signatures, and then whose
    shortened sets, put the threshold out of reach are left out.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    least, threshold = measure.least_agreement, measure.threshold

    def links(rows: list[dict]) -> tuple[list[bytes], list[bytes]]:
        asked = [row for row in rows if row["asked"]]
        others = [row for row in rows if not row["asked"]]
        found = ([], [])
        if not asked or not others:
            return found
        sketches = np.stack([np.frombuffer(row["sketch"], "<u2") for row in others])
        keys = np.array([row["keys"] for row in others])
        totals = np.array([row["total"] for row in others])
        shorts = [np.frombuffer(row["short"], "<u4") for row in others]
        for row in asked:
            near = (sketches == np.frombuffer(row["sketch"], "<u2")).sum(1) >= least
            small, large = np.minimum(totals, row["total"]), np.maximum(totals, row["total"])
            near &= small >= (threshold - 1e-9) * large
            near &= ~(keys[:, : row["band"]] == np.array(row["keys"][: row["band"]])).any(1)
            places = [
                place
                for place in np.flatnonzero(near)
                if others[place]["label"] != row["label"]
                and not (others[place]["outside"] and others[place]["node"] <= row["node"])
            ]
            if not places:
                continue
            own = np.frombuffer(row["short"], "<u4")
            shared = _shared_at_most(own, [shorts[place] for place in places])
            for place, count in zip(places, shared):
                if count >= threshold * (len(own) + len(shorts[place]) - count):
                    pair = sorted((row["node"], others[place]["node"]))
                    found[0].append(pair[0])
                    found[1].append(pair[1])
        return found

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                name = (row["key"], row["row_block"], row["column_block"])
                if name != cell:
                    yield arrow_rows(schema, list(links(held)))
                    cell, held = name, []
                held.append(row)
        yield arrow_rows(schema, list(links(held)))

    return cells


def block_links(
    members: DataFrame,
    buckets: DataFrame,
    nodes: DataFrame,
    labels: DataFrame,
    measure: Measure,
    block: int = BLOCK,
) -> DataFrame:
    """Pairs that pass for links in buckets that hold more than one component."""
    label = F.coalesce("label", "node")
    hubs = labels.toDF("hub", "joined")
    placed = (
        members.join(buckets.where("size > 2"), "key")
        .where(F.col("node") != F.col("hub"))
        .join(labels, "node", "left")
        .join(hubs, "hub", "left")
        .select(
            "key",
            "band",
            "node",
            label.alias("label"),
            (label != F.coalesce("joined", "hub")).alias("outside"),
        )
    )
    placed = stored(placed)
    open_buckets = (
        placed.groupBy("key")
        .agg(F.count_if("outside").alias("n_outside"), F.count("*").alias("n"))
        .where("n_outside > 0 AND n > 1")
    )

    def blocks(count: str):
        return F.ceil(F.col(count) / block).cast("int")

    def dealt(count: str):
        return F.pmod(F.xxhash64("node"), blocks(count).cast("long")).cast("int")

    def everywhere(count: str):
        return F.explode(F.sequence(F.lit(0), blocks(count) - 1))

    here = placed.join(open_buckets, "key")
    asked = here.where("outside").select(
        "*", F.lit(True).alias("asked"), dealt("n_outside").alias("row_block")
    )
    asked = asked.select("*", everywhere("n").alias("column_block"))
    others = here.select("*", F.lit(False).alias("asked"), everywhere("n_outside").alias("row_block"))
    others = others.select("*", dealt("n").alias("column_block"))
    cells = asked.unionByName(others).drop("n", "n_outside").join(nodes, "node")
    cell = ["key", "row_block", "column_block"]
    sorted_cells = cells.repartition(*cell).sortWithinPartitions(*cell)
    return sorted_cells.mapInArrow(_block_links(measure), "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, measure: Measure = Measure(), block: int = BLOCK) -> DataFrame:
    """doc_id, class_id and kept (whether it is the document that names its class)."""
    return _judged(docs, measure, block).select("doc_id", "class_id", "kept")


def _judged(docs: DataFrame, measure: Measure, block: int = BLOCK) -> DataFrame:
    """The same with the row's node and its class by the name of a node, which no id is needed for."""
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs, measure))
    nodes = stored(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("total").alias("total"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
        )
    )
    every = nodes.select("node", "total", F.posexplode("keys").alias("band", "key"))
    hub = F.min(F.struct(F.xxhash64("node").alias("order"), "node", "total")).alias("hub")
    buckets = stored(
        every.groupBy("key")
        .agg(hub, F.count("*").alias("size"))
        .where("size > 1")
        .select("key", "size", F.col("hub.node").alias("hub"), F.col("hub.total").alias("hub_total"))
    )
    members = stored(every.join(buckets.select("key"), "key", "left_semi"))
    # The sets of nodes that share a bucket, from the texts of one document each.
    shared = members.select(F.col("node").alias("met")).distinct()
    wanted = nodes.join(shared, F.col("node") == F.col("met"), "left_semi").select("first_id")
    wanted = stored(wanted.where(F.col("first_id").isNotNull()))
    named = docs.join(wanted, F.col("doc_id").cast("long") == F.col("first_id"), "left_semi")
    nameless = docs.where(F.col("doc_id").isNull())
    texts = named.select("doc_id", "text").union(nameless.select("doc_id", "text"))
    sets = stored(node_sets(texts, measure).dropDuplicates(["node"]))
    links = stored(checked(hub_pairs(members, buckets, measure.threshold), sets, measure.threshold))
    labels = components(links)
    measured = nodes.select("node", "total", "keys", "sketch").join(
        sets.select("node", "short"), "node"
    )
    rest = block_links(members, buckets, measured, labels, measure, block)
    more = stored(checked(rest, sets, measure.threshold))
    labels = components(links.union(more))
    class_id = F.min("first_id").alias("class_id")
    named = labels.join(nodes.select("node", "first_id"), "node")
    classes = named.groupBy("label").agg(class_id)
    single = nodes.join(labels, "node", "left_anti").select(
        "node", F.col("first_id").alias("class_id"), F.col("node").alias("label")
    )
    all_nodes = stored(named.join(classes, "label").select("node", "class_id", "label").union(single))
    judged = signed.select("doc_id", "node").join(all_nodes, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return judged.select("doc_id", "node", "label", own.alias("class_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_id"))
    )


def _with_node(docs: DataFrame, measure: Measure) -> DataFrame:
    """Add `__node`, null without words."""
    place = docs.columns.index("text")
    names = [*docs.columns, "__node"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, place):
            nodes = []
            for text in texts:
                elements, weights = measure.elements(text or "")
                nodes.append(node_name(elements, weights) if len(elements) else None)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.binary())], names)

    return docs.mapInArrow(rows, StructType([*docs.schema, StructField("__node", BinaryType())]))


def without_near_copies(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The documents that name their class, all columns, one of each class.

    Where an id repeats or several documents have none, the verdict goes by the text too: of the rows
    of a class that have the id that names it, one stays. Texts without words all stay.
    """
    kept = stored(
        _judged(docs, measure)
        .where("kept")
        .select(F.col("doc_id").alias("__kept"), F.col("node").alias("__named"), F.col("label").alias("__class"))
    )
    doc_id = F.col("doc_id").cast("long")
    same = doc_id.eqNullSafe(F.col("__kept"))
    # Ids are unique as a rule. Only of rows whose id repeats the text is looked at again.
    repeated = docs.groupBy(doc_id.alias("__twice")).agg(F.count("*").alias("n"))
    repeated = stored(repeated.where("n > 1").select("__twice"))
    twice = doc_id.eqNullSafe(F.col("__twice"))
    once = docs.join(kept, same, "left_semi").join(repeated, twice, "left_anti")
    names = docs.columns
    again = stored(_with_node(docs.join(repeated, twice, "left_semi"), measure))
    wordless = again.where(F.col("__node").isNull()).select(*names)
    verdicts = kept.where(F.col("__named").isNotNull()).distinct()
    first = (
        again.join(verdicts, same & (F.col("__node") == F.col("__named")))
        .groupBy("__class")
        .agg(F.min_by(F.struct(*(F.col(name) for name in names)), F.sha2("text", 256)).alias("__row"))
    )
    first = first.select(*(F.col("__row")[name].alias(name) for name in names))
    return once.unionByName(wordless).unionByName(first)
