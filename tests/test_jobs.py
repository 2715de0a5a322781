import threading

import pytest

from tillroll import queries
from tillroll.plans.jobs import side_by_side


def test_calls_run_together_and_answer_in_order(spark):
    met = threading.Barrier(2, timeout=30)

    def call(number):
        met.wait()
        return spark.range(number).count()

    spark.sparkContext.setLocalProperty("spark.job.description", "both")
    try:
        described = side_by_side(spark, lambda: spark.sparkContext.getLocalProperty("spark.job.description"))
    finally:
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert described == ["both"]
    assert side_by_side(spark, lambda: call(3), lambda: call(5)) == [3, 5]


def test_an_error_comes_once_all_have_ended(spark):
    ended = []

    def fails():
        raise OSError("disk full")

    with pytest.raises(OSError):
        side_by_side(spark, fails, lambda: ended.append(spark.range(4).count()))
    assert ended == [4]


def test_both_generations_are_written_together(spark, tmp_path, monkeypatch):
    met = threading.Barrier(2, timeout=30)
    monkeypatch.setattr(queries.shapes, "old_generation", lambda *_: spark.range(2))
    monkeypatch.setattr(queries.shapes, "new_generation", lambda *_: spark.range(3))
    real = queries.write_csv
    monkeypatch.setattr(queries, "write_csv", lambda *a, **b: met.wait() and False or real(*a, **b))
    folder = queries._raw_files(spark, "", str(tmp_path / "raw"))
    counts = [spark.read.option("header", True).csv(f"{folder}/{part}").count() for part in ("old", "new")]
    assert counts == [2, 3]
