import math
import os

import numpy as np
import pytest

from tillroll.llm import ann
from tillroll.llm.ann import nearest_neighbours

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows],
        SCHEMA,
    ).repartition(3)


def usable(rows, size=8):
    """vec_id and vector of the rows that take part; equal ids stay apart."""
    kept = []
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if any(vector) and len(vector) == size:
            kept.append((vec_id, [float(np.float32(x)) for x in vector]))
    return kept


def brute_force(rows, k=10, every=100, size=8):
    """Per query id the lists of its rows, as a repeated id has several."""
    kept, out = usable(rows, size), {}
    vectors = np.array([v for _, v in kept])
    for place, (query, own) in enumerate(kept):
        if query % every == 0:
            distances = np.sqrt(((vectors - own) ** 2).sum(1))
            others = ((distances[n], vec_id) for n, (vec_id, _) in enumerate(kept) if n != place)
            out.setdefault(query, []).append([vec_id for _, vec_id in sorted(others)[:k]])
    return {query: lists[0] if len(lists) == 1 else lists for query, lists in out.items()}


def found(result):
    got = {}
    for row in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(row.query_id, []).append(row.vec_id)
        assert row.rank == len(got[row.query_id])
    return got


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 8)) * 3
    return [(n, list(centers[n % 40] + rng.normal(size=8))) for n in range(4_000)]


def test_recall_with_many_partitions(frame, clustered):
    expected = brute_force(clustered, every=50)
    got = found(nearest_neighbours(frame(clustered), every=50, sample=2_000, rows_per_partition=200))
    recall = np.mean([len(set(got[q]) & set(ids)) / 10 for q, ids in expected.items()])
    assert recall >= 0.9
    assert set(got) == set(expected) and all(len(ids) == 10 for ids in got.values())


def test_recall_with_two_levels(frame, clustered, monkeypatch):
    monkeypatch.setattr(ann, "MAX_PARTITIONS", 8)
    monkeypatch.setattr(ann, "VISITORS", 40)
    routers = []
    refine = ann.refined
    monkeypatch.setattr(ann, "refined", lambda *args: routers.append(refine(*args)) or routers[0])
    expected = brute_force(clustered, every=50)
    got = found(nearest_neighbours(frame(clustered), every=50, sample=1_000, rows_per_partition=100))
    recall = np.mean([len(set(got[q]) & set(ids)) / 10 for q, ids in expected.items()])
    assert recall >= 0.9 and set(got) == set(expected)
    vectors = np.array([v for _, v in usable(clustered)])
    filed, visits = routers[0].filed(vectors), routers[0].visited(vectors)
    assert len(np.unique(filed)) > 16
    assert all(len(set(own)) == len(own) for own in visits)
    assert all(home == own[0] for home, own in zip(filed, visits))
    compared = sum(np.isin(filed, own).sum() for own in visits[::50]) / 80
    assert compared < 0.6 * len(vectors)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    size = len(rows[0][1])
    expected = brute_force(rows, size=size)
    got = found(nearest_neighbours(table))
    assert set(got) == set(expected) and len(rows) >= 320
    assert np.mean([len(set(got[q]) & set(ids)) / 10 for q, ids in expected.items()]) >= 0.9


def test_few_partitions_are_visited_where_vectors_lie_in_clusters(clustered):
    sample = np.array([v for _, v in clustered[:2_000]])
    router = ann.fitted(sample, 16)
    assert 1 <= router.probes <= 8
    sizes = np.bincount(router.ranked(sample)[:, 0], minlength=16)
    assert sizes.max() <= 3 * sizes.mean()


def test_the_cut_is_balanced_and_better_than_halving(clustered):
    sample = np.array([v for _, v in clustered[:1_000]])
    graph, rng = ann._graph(sample, 10), np.random.default_rng(0)
    part, _ = ann._balanced_cut(sample, graph, 8, rng)
    assert np.bincount(part, minlength=8).max() <= math.ceil(1.1 * 1_000 / 8)
    start = np.empty(1_000, int)
    for number, rows in enumerate(ann._halved(sample, np.arange(1_000), 8, np.random.default_rng(0))):
        start[rows] = number
    assert (part[graph] != part[:, None]).mean() < (start[graph] != start[:, None]).mean()


def test_one_partition_is_exact(frame, clustered):
    rows = clustered[:600]
    assert found(nearest_neighbours(frame(rows), fewest=1)) == brute_force(rows)


def test_blocks_ties_and_a_vector_that_a_third_of_rows_hold(frame, clustered, monkeypatch):
    monkeypatch.setattr(ann, "INDEX_BLOCK", 60)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rows = [(n, [1.0, 2, 3, 4, 5, 6, 7, 8] if n % 3 == 0 else v) for n, v in clustered[:900]]
    got = found(nearest_neighbours(frame(rows), every=30, fewest=1))
    assert got == brute_force(rows, every=30)
    assert got[0] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 30]


def test_scores_are_distances(frame, clustered):
    vectors = dict(usable(clustered[:300]))
    for row in nearest_neighbours(frame(clustered[:300])).collect():
        exact = math.dist(vectors[row.query_id], vectors[row.vec_id])
        assert row.score == pytest.approx(exact, rel=1e-14)


ODD = [
    (0, [1, 0, 0, 0, 0, 0, 0, 0]),
    (100, [0, 1, 0, 0, 0, 0, 0, 0]),
    (100, [0, 1, 0, 0, 0, 0, 0, 0]),
    (200, None),
    (300, [0] * 8),
    (400, [1, None, 0, 0, 0, 0, 0, 0]),
    (500, [math.nan] + [1] * 7),
    (600, [math.inf] + [1] * 7),
    (700, [1, 2, 3]),
    (800, []),
    (None, [2] * 8),
    (7, [-0.0, 1, 0, 0, 0, 0, 0, 0]),
    (8, [3] * 8),
]


def test_vectors_that_take_no_part(frame):
    rows = [row for place, row in enumerate(ODD) if place != 2]
    got = found(nearest_neighbours(frame(rows)))
    assert got == brute_force(rows) and set(got) == {0, 100}
    assert got[100][0] == 7


def test_rows_that_repeat_an_id_are_candidates_and_queries(frame, clustered):
    rows = [*clustered[:250], (100, clustered[17][1]), (17, clustered[17][1]), (17, clustered[18][1])]
    result = nearest_neighbours(frame(rows), fewest=1).collect()
    expected = brute_force(rows)
    pairs = sorted((r.rank, r.vec_id) for r in result if r.query_id == 100)
    both = [(rank, vec_id) for own in expected[100] for rank, vec_id in enumerate(own, 1)]
    assert len(expected[100]) == 2 and pairs == sorted(both)
    own = {q: [r.vec_id for r in sorted(result, key=lambda r: r.rank) if r.query_id == q] for q in (0, 200)}
    assert own == {q: expected[q] for q in own}


def test_empty_table(frame):
    assert nearest_neighbours(frame([])).collect() == []
    assert nearest_neighbours(frame([(0, None)])).collect() == []
    assert nearest_neighbours(frame([(0, [1] * 8)])).collect() == []
