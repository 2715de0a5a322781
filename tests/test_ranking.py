import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.operators.ranking import Order, Wanted, ntile, values_at_ranks
from pyspark.sql import functions as F

SCORES = {"up": Order("v"), "down": Order("w", ascending=False)}


def expected(rows, tiles):
    """Tiles per key by sorting all rows; NULLs last, NaN above every number."""

    def weight(value):
        return (1, 0.0) if math.isnan(value) else (0, value)

    def tile_numbers(ordered):
        size, longer = divmod(len(ordered), tiles)
        numbers = [t for t in range(1, tiles + 1) for _ in range(size + (t <= longer))]
        return dict(zip((row[0] for row in ordered), numbers))

    def up(row):
        return (row[1] is None, weight(row[1]) if row[1] is not None else (0, 0), row[0])

    def down(row):
        if row[2] is None:
            return (True, (0, 0), row[0])
        nan, value = weight(row[2])
        return (False, (-nan, -value), row[0])

    first, second = tile_numbers(sorted(rows, key=up)), tile_numbers(sorted(rows, key=down))
    return {row[0]: (first[row[0]], second[row[0]]) for row in rows}


def check(spark, rows, tiles=4, **options):
    df = spark.createDataFrame(rows, "k double, v int, w double").repartition(3)
    got = ntile(df, "k", SCORES, tiles, **options).collect()
    assert {r.k: (r.up, r.down) for r in got} == expected(rows, tiles)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 8, 1000])
@pytest.mark.parametrize("options", [{}, {"accuracy": 20}])
def test_sizes(spark, n, options):
    rng = random.Random(n)
    rows = [(float(k), rng.randint(0, 20), rng.choice([rng.random(), 0.5])) for k in range(n)]
    check(spark, rows, **options)


@pytest.mark.parametrize("options", [{}, {"accuracy": 10}])
def test_everything_tied(spark, options):
    check(spark, [(float(k), 7, 1.5) for k in range(101)], **options)


@pytest.mark.parametrize("options", [{}, {"accuracy": 10}])
def test_a_third_holds_one_value(spark, options):
    rng = random.Random(3)
    rows = [
        (float(k), 1 if k % 3 == 0 else rng.randint(0, 400), 2.0 if k % 3 == 1 else rng.random())
        for k in range(600)
    ]
    check(spark, rows, **options)


@pytest.mark.parametrize("options", [{}, {"accuracy": 10}])
def test_nulls_and_nan(spark, options):
    rows = [
        (float(k), None if k % 2 else k, [None, float("nan"), 1.0, float("inf"), -0.5][k % 5])
        for k in range(50)
    ]
    check(spark, rows, **options)


def test_all_null(spark):
    check(spark, [(float(k), None, None) for k in range(10)])


@pytest.mark.parametrize("options", [{}, {"accuracy": 10}])
def test_a_null_key_comes_last_among_ties(spark, options):
    df = spark.createDataFrame([(None, 1), (2.0, 1), (3.0, 1), (1.0, 1)], "k double, v int")
    got = {r.k: r.t for r in ntile(df, "k", {"t": Order("v")}, 4, **options).collect()}
    assert got == {1.0: 1, 2.0: 2, 3.0: 3, None: 4}


@pytest.mark.parametrize("tiles", [1, 2, 3, 10])
def test_other_tile_counts(spark, tiles):
    check(spark, [(float(k), k % 4, k / 3) for k in range(23)], tiles)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-3, 3)),
            st.one_of(st.none(), st.floats(allow_nan=False, width=16)),
        ),
        max_size=40,
    ),
)
def test_random_frames(spark, values):
    rows = [(float(k), v, w) for k, (v, w) in enumerate(values)]
    check(spark, rows, accuracy=8)


def test_values_at_ranks_narrow_down_to_every_rank(spark):
    data = sorted(random.Random(5).choices(range(300), k=900))
    df = spark.createDataFrame([(v,) for v in data], "v bigint").repartition(4)
    ranks = [0, 1, 299, 300, 450, 898, 899]
    wanted = {r: Wanted("v", F.lit(True), r, len(data)) for r in ranks}
    got = values_at_ranks(df, wanted, accuracy=10)
    assert got == {r: data[r] for r in ranks}


def test_integers_that_share_a_double(spark):
    base = 2**60
    data = sorted(base + n % 8 for n in range(400))
    df = spark.createDataFrame([(v,) for v in data], "v bigint").repartition(4)
    wanted = {r: Wanted("v", F.lit(True), r, len(data)) for r in (0, 133, 250, 399)}
    got = values_at_ranks(df, wanted, accuracy=100)
    assert got == {r: data[r] for r in wanted}
