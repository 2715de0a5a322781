import datetime

import pytest

from tillroll.operators import quality
from tillroll.operators.quality import (
    MaxNullRate,
    MinRows,
    MinTotal,
    QualityCheckFailed,
    YearsPresent,
    dead_letter_check,
    enforce,
    run_checks,
)

RULES = (MinRows(3), MaxNullRate(), MinTotal(minimum=1_000.0), YearsPresent())
GOOD = [("1", 1.0, 5_000.25, 2009), ("2", 2.0, 400.0, 2010), ("3", 3.0, 1.0, 2011)]


def frame(spark, rows=GOOD):
    return spark.createDataFrame(
        rows, "Invoice string, CustomerID double, Revenue double, year int"
    )


def results(spark, rows=GOOD, rules=RULES):
    return {r.check: r for r in run_checks(frame(spark, rows), rules).collect()}


def test_defaults_are_the_production_thresholds():
    assert quality.DEFAULT_RULES == (
        MinRows(700_000),
        MaxNullRate(("invoice", "customerid", "revenue"), 0.0),
        MinTotal("revenue", 1_000_000.0),
        YearsPresent(("2009", "2010", "2011")),
    )


def test_all_pass(spark):
    outcome = enforce(run_checks(frame(spark), RULES))
    assert outcome["status"] == "PASSED"
    assert list(outcome["checks"]) == ["row_count", "critical_nulls", "revenue_sanity", "partitions"]
    assert all(check["passed"] for check in outcome["checks"].values())
    assert [check["message"] for check in outcome["checks"].values()] == [
        "Row count 3 OK",
        "Null rates within threshold (max allowed 0.0)",
        "Total revenue 5,401.25 OK",
        "All expected year partitions present: ['2009', '2010', '2011']",
    ]


def test_low_row_count(spark):
    row = results(spark, rules=(MinRows(700_000),))["row_count"]
    assert not row.passed and row.message == "Row count 3 below minimum 700000"
    assert (row.observed, row.threshold) == (3.0, 700_000.0)


def test_missing_year(spark):
    row = results(spark, [*GOOD[:2], ("3", 3.0, 1.0, 2012)])["partitions"]
    assert not row.passed and row.message == "Missing year partitions: ['2011']"


def test_nulls(spark):
    rows = [*GOOD, (None, None, 1.0, 2009)]
    row = results(spark, rows)["critical_nulls"]
    assert not row.passed
    assert row.message == "invoice null rate 0.2500; customerid null rate 0.2500"


def test_null_rate_within_a_looser_limit(spark):
    rows = [*GOOD, (None, 4.0, 1.0, 2009)]
    assert results(spark, rows, (MaxNullRate(maximum=0.25),))["critical_nulls"].passed


def test_low_revenue(spark):
    row = results(spark, rules=(MinTotal(minimum=1_000_000.0),))["revenue_sanity"]
    assert not row.passed
    assert row.message == "Total revenue 5,401.25 below minimum 1,000,000.00"


def test_failures_are_raised_together(spark):
    with pytest.raises(QualityCheckFailed) as failure:
        enforce(run_checks(frame(spark, GOOD[:1]), RULES))
    assert str(failure.value) == (
        "row_count: Row count 1 below minimum 3; "
        "partitions: Missing year partitions: ['2010', '2011']"
    )


def test_empty_table_fails_every_check(spark):
    rows = results(spark, [])
    assert [r.passed for r in rows.values()] == [False] * 4
    assert "no rows" in rows["critical_nulls"].message
    assert rows["partitions"].message == "Missing year partitions: ['2009', '2010', '2011']"


def test_null_year_is_no_year(spark):
    assert results(spark, [*GOOD, ("4", 4.0, 1.0, None)])["partitions"].passed


def test_dead_letters_within_a_window(spark):
    dead = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1),), (datetime.datetime(2024, 1, 3),)],
        "ingested_at timestamp",
    )
    (alert,) = dead_letter_check(dead, datetime.datetime(2024, 1, 2)).collect()
    assert (alert.passed, alert.observed) == (False, 1.0)
    (calm,) = dead_letter_check(dead, datetime.datetime(2024, 1, 4)).collect()
    assert calm.passed
