import datetime

import pytest
from pyspark.sql import functions as F

from shapes import LINES, RAW, line, plan_of, raw_frame
from tillroll.functions.casts import whole_number
from tillroll.operators.clean import backfill_optional, clean_orders
from tillroll.schemas import CURATED_SCHEMA


def cleaned(spark, **changes):
    return clean_orders(raw_frame(spark, [line(**changes)])).collect()


def test_only_good_lines_stay(spark):
    kept = clean_orders(raw_frame(spark)).collect()
    assert sorted(row.Invoice for row in kept) == ["700001", "700002"]


def test_revenue_and_partition_columns(spark):
    (row,) = cleaned(spark)
    assert row.Revenue == pytest.approx(14.0)
    assert (row.year, row.month) == (2014, 7)
    assert row.InvoiceDate == datetime.datetime(2014, 7, 3, 11, 5)


def test_types_and_order_of_columns(spark):
    assert [(f.name, f.dataType) for f in clean_orders(raw_frame(spark)).schema] == [
        (f.name, f.dataType) for f in CURATED_SCHEMA
    ]


def test_missing_optional_column_is_null(spark):
    rows = clean_orders(raw_frame(spark)).collect()
    assert [row.loyalty_tier for row in rows] == [None, None]


@pytest.mark.parametrize("name", ["loyalty_tier", "Loyalty_Tier"])
def test_present_optional_column_is_kept(spark, name):
    raw = raw_frame(spark, [row + ("Gold",) for row in LINES[:2]], [*RAW, name])
    assert {row[name] for row in clean_orders(raw).collect()} == {"Gold"}


def test_backfill_adds_nothing_twice(spark):
    once = backfill_optional(raw_frame(spark))
    assert backfill_optional(once).columns == once.columns


def test_old_names_are_gone(spark):
    columns = clean_orders(raw_frame(spark)).columns
    assert {"CustomerID", "UnitPrice"} <= set(columns)
    assert not {"Customer ID", "Price"} & set(columns)


def test_unknown_columns_pass_through(spark):
    raw = raw_frame(spark, [LINES[0] + ("web",)], [*RAW, "channel"])
    assert clean_orders(raw).first().channel == "web"


def test_duplicates_stay(spark):
    assert clean_orders(raw_frame(spark, [LINES[0]] * 3)).count() == 3


@pytest.mark.parametrize(
    "text, number",
    [
        ("6", 6),
        ("6.0", 6),
        ("6.7", 6),
        ("-0.5", 0),
        ("", None),
        (" 6 ", 6),
        (" 6.5 ", 6),
        ("1e2", None),
        ("99999999999", None),
        ("2147483647", 2147483647),
        ("2147483648", None),
        ("2147483647.9", 2147483647),
        ("NaN", None),
        ("abc", None),
        (None, None),
        ("+6", 6),
        (".5", 0),
        ("6.", 6),
        ("-3", -3),
        ("6,5", None),
    ],
)
def test_whole_number_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(whole_number(F.col("t"), df.schema["t"].dataType)).first()[0] == number


def test_whole_number_of_a_number(spark):
    df = spark.createDataFrame([(6.7,), (1e12,)], "t double")
    got = [r[0] for r in df.select(whole_number(F.col("t"), df.schema["t"].dataType)).collect()]
    assert got == [6, None]


@pytest.mark.parametrize("customer, kept", [("31.0", True), ("x", False), ("", False)])
def test_customer_must_be_a_number(spark, customer, kept):
    rows = cleaned(spark, **{"Customer ID": customer})
    assert bool(rows) == kept
    assert all(row.CustomerID == 31.0 for row in rows)


@pytest.mark.parametrize("invoice, kept", [("c1", True), ("C1", False), (None, False), ("1C", True)])
def test_cancelled_invoices(spark, invoice, kept):
    assert bool(cleaned(spark, Invoice=invoice)) == kept


@pytest.mark.parametrize("price, kept", [("0", False), ("-1", False), ("abc", False), ("NaN", True)])
def test_price_rule(spark, price, kept):
    assert bool(cleaned(spark, Price=price)) == kept


@pytest.mark.parametrize("text", ["7/3/2014 11:05", "", None])
def test_unreadable_date_keeps_the_line(spark, text):
    (row,) = cleaned(spark, InvoiceDate=text)
    assert (row.InvoiceDate, row.year, row.month) == (None, None, None)


@pytest.mark.parametrize("text", ["2014-07-03 11:05", "2014-07-03"])
def test_short_dates_are_read(spark, text):
    assert cleaned(spark, InvoiceDate=text)[0].year == 2014


def test_filters_hold_on_cleaned_lines(spark):
    once = clean_orders(raw_frame(spark))
    assert sorted(clean_orders(once).collect()) == sorted(once.collect())


def test_cleaning_is_narrow(spark, tmp_path):
    raw_frame(spark).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(clean_orders(spark.read.parquet(str(tmp_path / "raw"))))
    assert "Exchange" not in plan and "Python" not in plan
