"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors the graph of nearest neighbours is cut into balanced partitions with
few edges between them, and a small network learns to tell a vector's partition. It files every
vector of the table under its most probable partition and sends a query to its several most probable
ones, where all vectors are compared in double precision. How many partitions a query visits is read
off the sample: as many as it takes for the neighbours known there to be found at the wanted recall.
Vectors lie thinner in the sample than in the table, so neighbours there are harder to find.

A table too large for the partitions of one network gets two levels: every partition is cut again by a
network of its own, fitted in a task of its own on a bounded sample of its vectors, and a query is sent
to several parts of each partition it visits. So up to the square of `MAX_PARTITIONS` the vectors and
queries per partition stay the same while the table grows.

Partitions are cut into blocks of index rows and of queries, sized from counts, and every pair of
blocks is one small group: a partition that holds a third of all vectors, or a vector that does, is
spread over many tasks. Each group returns at most k candidates per query, and the ranking over them
drops rows before its shuffle.

Nearness is Euclidean distance; ties go to the smaller vec_id. Vectors that are null, zero, hold null
or non-finite components, have a null vec_id, or another length than most vectors take no part. Rows
that repeat a vec_id are each a candidate and, if `every` divides it, each a query with ranks of its
own; only a query's own row is no candidate of it. With fewer candidates than k all are returned; an
empty table gives an empty result. Columns beside vec_id and embedding are ignored.
"""

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, stored

SAMPLE = 8_192
VISITORS = 2_048
ROWS_PER_PARTITION = 1_000
FEWEST_PARTITIONS = 8
MAX_PARTITIONS = 128
GRAPH_NEIGHBOURS = 10
TARGET_RECALL = 0.95
HIDDEN = 64
EPOCHS = 40
INDEX_BLOCK = 20_000
QUERY_BLOCK = 1_000
SEED = 7


@dataclass
class Router:
    """A network with one hidden layer that gives a vector's partitions by probability.

    `within` holds the routers of partitions that are cut again; partitions are numbered through both
    levels, `stride` numbers to one of the first.
    """

    center: np.ndarray
    scale: float
    weights: list[np.ndarray]
    partitions: int
    probes: int
    within: dict[int, "Router"] = field(default_factory=dict)
    stride: int = 1

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.partitions == 1:
            return np.zeros((len(vectors), 1))
        first, bias, second, bias2 = self.weights
        hidden = np.maximum((vectors - self.center) / self.scale @ first + bias, 0)
        return hidden @ second + bias2

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(vectors), axis=1, kind="stable")

    def visited(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The partitions of each vector, most probable first, as many as its search visits."""
        first = self.ranked(vectors)[:, : self.probes]
        if not self.within:
            return list(first * self.stride)
        found: list[list] = [[None] * first.shape[1] for _ in vectors]
        for part in np.unique(first):
            rows, places = np.nonzero(first == part)
            inner = self.within.get(int(part))
            codes = inner.visited(vectors[rows]) if inner else np.zeros((len(rows), 1), np.int64)
            for row, place, own in zip(rows, places, codes):
                found[row][place] = part * self.stride + own
        return [np.concatenate(own) for own in found]

    def filed(self, vectors: np.ndarray) -> np.ndarray:
        """The one partition each vector lies in."""
        first = self.scores(vectors).argmax(1)
        codes = first * self.stride
        for part in np.unique(first) if self.within else ():
            inner = self.within.get(int(part))
            if inner:
                rows = first == part
                codes[rows] += inner.filed(vectors[rows])
        return codes


def _graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each vector, by brute force in stretches."""
    norms, found = (vectors * vectors).sum(1), np.empty((len(vectors), k), np.int64)
    for at in range(0, len(vectors), 512):
        part = vectors[at : at + 512]
        distances = norms[at : at + 512, None] + norms - 2 * part @ vectors.T
        distances[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
        found[at : at + 512] = np.argpartition(distances, k - 1, axis=1)[:, :k]
    return found


def _halved(vectors: np.ndarray, rows: np.ndarray, parts: int, rng) -> list[np.ndarray]:
    """Rows cut along main directions into equal parts."""
    if parts == 1:
        return [rows]
    own = vectors[rows] - vectors[rows].mean(0)
    axis = rng.normal(size=own.shape[1])
    for _ in range(8):
        axis = own.T @ (own @ axis)
        axis /= np.linalg.norm(axis) + 1e-300
    order, cut = np.argsort(own @ axis, kind="stable"), len(rows) * (parts // 2) // parts
    return _halved(vectors, rows[order[:cut]], parts // 2, rng) + _halved(
        vectors, rows[order[cut:]], parts - parts // 2, rng
    )


def _balanced_cut(vectors: np.ndarray, graph: np.ndarray, parts: int, rng) -> tuple:
    """Partition of every vertex, and how many neighbours it has in each; sizes differ by a tenth."""
    n, k = graph.shape
    part = np.empty(n, np.int64)
    for number, rows in enumerate(_halved(vectors, np.arange(n), parts, rng)):
        part[rows] = number
    source = np.concatenate([np.repeat(np.arange(n), k), graph.ravel()])
    target = np.concatenate([graph.ravel(), np.repeat(np.arange(n), k)])
    room = math.ceil(1.1 * n / parts)
    for _ in range(15):
        beside = np.zeros((n, parts))
        np.add.at(beside, (source, part[target]), 1)
        sizes, moved = np.bincount(part, minlength=parts), 0
        gain = beside.max(1) - beside[np.arange(n), part]
        for vertex in np.argsort(-gain, kind="stable"):
            if gain[vertex] <= 0:
                break
            for better in np.argsort(-beside[vertex], kind="stable")[:4]:
                if beside[vertex, better] <= beside[vertex, part[vertex]]:
                    break
                if sizes[better] < room:
                    sizes[part[vertex]] -= 1
                    sizes[better] += 1
                    part[vertex], moved = better, moved + 1
                    break
        if not moved:
            break
    beside = np.zeros((n, parts))
    np.add.at(beside, (source, part[target]), 1)
    return part, beside


def _trained(inputs: np.ndarray, wanted: np.ndarray, rng) -> list[np.ndarray]:
    """Weights fitted to the wanted distributions by Adam on cross-entropy."""
    d, parts = inputs.shape[1], wanted.shape[1]
    weights = [
        rng.normal(size=(d, HIDDEN)) / math.sqrt(d),
        np.zeros(HIDDEN),
        rng.normal(size=(HIDDEN, parts)) / math.sqrt(HIDDEN),
        np.zeros(parts),
    ]
    means, squares, step = [0.0] * 4, [0.0] * 4, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for at in range(0, len(inputs), 256):
            x, y = inputs[order[at : at + 256]], wanted[order[at : at + 256]]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            scores = hidden @ weights[2] + weights[3]
            chances = np.exp(scores - scores.max(1, keepdims=True))
            chances /= chances.sum(1, keepdims=True)
            error = (chances - y) / len(x)
            back = error @ weights[2].T * (hidden > 0)
            step += 1
            for i, slope in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                means[i] = 0.9 * means[i] + 0.1 * slope
                squares[i] = 0.999 * squares[i] + 0.001 * slope * slope
                root = np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8
                weights[i] = weights[i] - 3e-3 * means[i] / (1 - 0.9**step) / root
    return weights


def fitted(sample: np.ndarray, partitions: int, target_recall: float = TARGET_RECALL) -> Router:
    """A router from a sample of vectors."""
    rng = np.random.default_rng(SEED)
    center, scale = sample.mean(0), float(sample.std()) + 1e-300
    if partitions == 1:
        return Router(center, scale, [], 1, 1)
    graph = _graph(sample, min(GRAPH_NEIGHBOURS, len(sample) - 1))
    part, beside = _balanced_cut(sample, graph, partitions, rng)
    wanted = beside
    wanted[np.arange(len(sample)), part] += GRAPH_NEIGHBOURS
    wanted /= wanted.sum(1, keepdims=True)
    weights = _trained((sample - center) / scale, wanted, rng)
    router = Router(center, scale, weights, partitions, partitions)
    router.probes = _probes(router, sample, router.filed(sample)[graph], target_recall)
    return router


def _probes(router: Router, asked: np.ndarray, homes: np.ndarray, target_recall: float) -> int:
    """How many partitions reach the target share of the neighbours, which lie in `homes`."""
    ranks = router.ranked(asked)
    place = np.empty_like(ranks)
    np.put_along_axis(place, ranks, np.arange(router.partitions)[None, :], 1)
    reached = np.take_along_axis(place, homes, 1).ravel()
    share = np.cumsum(np.bincount(reached, minlength=router.partitions)) / len(reached)
    return min(router.partitions, int(np.searchsorted(share, target_recall)) + 1)


def fitted_within(
    members: np.ndarray, visitors: np.ndarray, partitions: int, target_recall: float
) -> Router:
    """A router within one partition; queries that lie elsewhere must reach the target share too."""
    router = fitted(members, partitions, target_recall)
    if len(visitors) and router.partitions > 1:
        k = min(GRAPH_NEIGHBOURS, len(members))
        norms = (members * members).sum(1)
        near = np.concatenate(
            [
                np.argpartition(norms - 2 * visitors[at : at + 512] @ members.T, k - 1, axis=1)[:, :k]
                for at in range(0, len(visitors), 512)
            ]
        )
        found = _probes(router, visitors, router.filed(members)[near], target_recall)
        router.probes = max(router.probes, found)
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, with a number for each."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    sound = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", finite)
        & F.exists("embedding", lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    alike = sound.where(F.size("embedding") == (usual.d if usual else -1))
    return alike.withColumn("row", F.monotonically_increasing_id())


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


ROUTED = "row bigint, vec_id bigint, embedding array<double>, part int, visits array<int>"


def _routed(router: Router):
    """Rows with the partition they are filed under and, for queries, the ones to visit."""
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("vec_id", pa.int64()),
            ("embedding", pa.list_(pa.float64())),
            ("part", pa.int32()),
            ("visits", pa.list_(pa.int32())),
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, ids, embeddings, asked = batch.columns
            vectors = _matrix(embeddings)
            asked = asked.to_numpy(zero_copy_only=False).astype(bool)
            visits = iter(router.visited(vectors[asked]) if asked.any() else ())
            listed = [next(visits).astype(np.int32) if ask else None for ask in asked]
            filed = router.filed(vectors).astype(np.int32)
            yield arrow_rows(schema, [numbers, ids, embeddings, filed, listed])

    return rows


def _with_asked(rows: DataFrame, every: int) -> DataFrame:
    return rows.select("row", "vec_id", "embedding", (F.col("vec_id") % every == 0).alias("asked"))


def _counted(frame: DataFrame) -> dict[int, int]:
    """Rows per partition, at most MAX_PARTITIONS squared numbers."""
    return {row.part: row.n for row in frame.groupBy("part").agg(F.count("*").alias("n")).collect()}


def _visits(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("visits").isNotNull()).select(
        F.col("row").alias("query"),
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("asked"),
        F.explode("visits").alias("part"),
    )


def refined(
    router: Router, routed: DataFrame, sample: int, rows_per_partition: int, target_recall: float
) -> Router:
    """The router with one more for each partition of many vectors.

    Each is fitted in a task on about `sample` of the partition's vectors and `VISITORS` of the queries
    that visit it, and comes to the driver as a network, of which there are at most MAX_PARTITIONS.
    """
    spark, visits = routed.sparkSession, _visits(routed)
    members, visitors = _counted(routed), _counted(visits)
    parts = {part: min(MAX_PARTITIONS, n // rows_per_partition) for part, n in members.items()}
    plan = spark.createDataFrame(
        [
            (part, sample / members[part], VISITORS / max(1, visitors.get(part, 0)), wanted)
            for part, wanted in parts.items()
            if wanted > 1
        ],
        "part int, of_members double, of_visitors double, wanted int",
    )

    def drawn(frame: DataFrame, number: str, vector: str, share: str, visitor: bool) -> DataFrame:
        draw = F.pmod(F.xxhash64(number, F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
        picked = frame.join(plan, "part").where(draw < F.col(share))
        vectors = F.col(vector).alias("embedding")
        return picked.select("part", "wanted", vectors, F.lit(visitor).alias("visitor"))

    schema = pa.schema([("part", pa.int32()), ("router", pa.binary())])

    def fit(group: pa.Table) -> pa.Table:
        visitor = group["visitor"].to_numpy()
        vectors = _matrix(group["embedding"])
        # Rows come in any order; a fixed one gives the same network when a task is run again.
        order = np.lexsort(vectors.T)
        vectors, visitor = vectors[order], visitor[order]
        own, others = vectors[~visitor], vectors[visitor]
        wanted = min(group["wanted"][0].as_py(), len(own) // (4 * GRAPH_NEIGHBOURS))
        if wanted < 2:
            return schema.empty_table()
        found = fitted_within(own, others, wanted, target_recall)
        return pa.table([[group["part"][0].as_py()], [pickle.dumps(found)]], schema=schema)

    samples = drawn(routed, "row", "embedding", "of_members", False).unionByName(
        drawn(visits, "query", "asked", "of_visitors", True)
    )
    fits = samples.groupBy("part").applyInArrow(fit, "part int, router binary").collect()
    router.within = {row.part: pickle.loads(row.router) for row in fits}
    router.stride = MAX_PARTITIONS
    return router


def _nearest(k: int):
    """Best k of an index block for each query of a query block, exact distances."""
    schema = pa.schema(
        [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def group(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids, rows, vectors = index["vec_id"].to_numpy(), index["row"].to_numpy(), _matrix(index["embedding"])
        names, asked = queries["query_id"].to_numpy(), _matrix(queries["asked"])
        own = queries["query"].to_numpy()
        norms, found = (vectors * vectors).sum(1), ([], [], [], [])
        for at in range(0, len(names), 64):
            part = asked[at : at + 64]
            rough = norms - 2 * part @ vectors.T
            slack = 1e-9 * (norms.max() + (part * part).sum(1))
            for number, name, query, row, spare in zip(
                own[at : at + 64], names[at : at + 64], part, rough, slack
            ):
                others = rows != number
                count = min(k, int(others.sum()))
                if not count:
                    continue
                row = np.where(others, row, np.inf)
                limit = np.partition(row, count - 1)[count - 1] + spare
                near = np.flatnonzero(row <= limit)
                exact = np.sqrt(((vectors[near] - query) ** 2).sum(1))
                best = np.lexsort((ids[near], exact))[:count]
                found[0].append(np.full(len(best), number))
                found[1].append(np.full(len(best), name))
                found[2].append(ids[near][best])
                found[3].append(exact[best])
        if not found[0]:
            return schema.empty_table()
        return pa.table([np.concatenate(column) for column in found], schema=schema)

    return group


def _in_blocks(frame: DataFrame, sizes: dict[str, tuple[dict[int, int], int]]) -> DataFrame:
    """The frame with the number of blocks of at most about `size` rows, by its partition's counts."""
    parts = sorted({part for counts, _ in sizes.values() for part in counts})
    rows = [
        (part, *(max(1, math.ceil(counts.get(part, 0) / size)) for counts, size in sizes.values()))
        for part in parts
    ]
    schema = ", ".join(["part int", *(f"{name} int" for name in sizes)])
    return frame.join(frame.sparkSession.createDataFrame(rows, schema), "part")


def nearest_neighbours(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    sample: int = SAMPLE,
    rows_per_partition: int = ROWS_PER_PARTITION,
    target_recall: float = TARGET_RECALL,
    fewest: int = FEWEST_PARTITIONS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each vector whose id `every` divides."""
    rows = stored(usable(vectors))
    total = rows.count()
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("embedding").collect()
    known = np.array([row.embedding for row in picked])
    wanted = max(fewest, total // rows_per_partition)
    first = max(1, min(MAX_PARTITIONS, wanted, len(known) // (4 * GRAPH_NEIGHBOURS)))
    two_levels = total // rows_per_partition > MAX_PARTITIONS
    # Both levels have to find a neighbour.
    target = math.sqrt(target_recall) if two_levels else target_recall
    router = fitted(known, first, target) if total else Router(known, 1.0, [], 1, 1)
    routed = stored(_with_asked(rows, every).mapInArrow(_routed(router), ROUTED))
    if two_levels:
        router = refined(router, routed, sample, rows_per_partition, target)
        routed = stored(_with_asked(rows, every).mapInArrow(_routed(router), ROUTED))
    queries = _visits(routed)
    sizes = {
        "index_blocks": (_counted(routed), INDEX_BLOCK),
        "query_blocks": (_counted(queries), QUERY_BLOCK),
    }

    def dealt(name: str, blocks: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(blocks).cast("long")).cast("int")

    def all_of(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    keys = ["part", "index_block", "query_block"]
    index = _in_blocks(routed, sizes).select(
        "row",
        "vec_id",
        "embedding",
        "part",
        dealt("row", "index_blocks").alias("index_block"),
        all_of("query_blocks").alias("query_block"),
    )
    asked = _in_blocks(queries, sizes).select(
        "query",
        "query_id",
        "asked",
        "part",
        all_of("index_blocks").alias("index_block"),
        dealt("query", "query_blocks").alias("query_block"),
    )
    found = (
        index.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInArrow(_nearest(k), "query bigint, query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
