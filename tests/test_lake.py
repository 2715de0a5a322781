import datetime

import pytest

from shapes import RAW
from test_events import text
from test_sources import csv_line, put
from tillroll.operators.quality import MaxNullRate, MinRows, MinTotal, QualityCheckFailed, YearsPresent
from tillroll.plans.catalog import register_events, temporary_views
from tillroll.operators.warehouse import monthly_revenue
from tillroll.plans.lake import build_warehouse, failed_runs, run_lake, table_checks
from tillroll.sinks.events import ingest_events
from tillroll.sinks.tables import write_curated
from tillroll.sources.orders import read_curated

RULES = (MinRows(3), MaxNullRate(), MinTotal(minimum=10.0), YearsPresent(("2014",)))


@pytest.fixture
def raw(tmp_path):
    rows = [csv_line(n)[:6] + [str(100 + n), "Norway"] for n in range(8)]
    put(tmp_path / "raw/a.csv", RAW, *rows)
    return tmp_path


def run(spark, root, **options):
    return run_lake(
        spark,
        str(root / "raw"),
        str(root / "curated"),
        str(root / "warehouse"),
        str(root / "checkpoint"),
        run_log=str(root / "runs"),
        **{"rules": RULES, **options},
    )


def test_whole_run_with_catalog(spark, raw):
    record = run(spark, raw, database="shop")
    assert record.status == "PASSED"
    assert record.tables == {
        "daily_revenue": 1,
        "customer_rfm": 8,
        "top_products": 1,
        "customer_segments": 8,
    }
    assert spark.sql("SELECT count(*) FROM shop.online_retail WHERE year = 2014").first()[0] == 8
    (trend,) = spark.sql("SELECT * FROM shop.v_revenue_trend").collect()
    assert (trend.year, trend.month, trend.num_customers) == (2014, 7, 8)
    segments = spark.sql("SELECT * FROM shop.v_customer_segments").collect()
    assert sorted(r.m_score for r in segments) == [1, 1, 2, 2, 3, 3, 4, 4]
    (product,) = spark.sql("SELECT * FROM shop.v_top_products").collect()
    assert (product.stockcode, product.revenue_rank) == ("A", 1)

    monthly = spark.table("shop.v_monthly_revenue")
    ours = monthly_revenue(spark.table("shop.online_retail"))
    assert [tuple(r) for r in monthly.collect()] == [tuple(r) for r in ours.collect()]
    checks = table_checks(spark, "shop.online_retail", RULES).collect()
    assert [c.passed for c in checks] == [True] * 4

    put(raw / "raw/b.csv", RAW, csv_line(50)[:4] + ["2014-08-05 10:00:00", "1", "1", "UK"])
    second = run(spark, raw, database="shop")
    assert (second.files, second.tables["customer_rfm"]) == (1, 9)
    assert spark.sql("SELECT count(*) FROM shop.online_retail").first()[0] == 9
    assert spark.sql("SELECT count(*) FROM shop.v_revenue_trend").first()[0] == 2
    assert [r.status for r in spark.read.parquet(str(raw / "runs")).collect()] == ["PASSED"] * 2


def test_a_failed_gate_stops_before_the_warehouse(spark, raw):
    with pytest.raises(QualityCheckFailed, match="row_count: Row count 8 below minimum 100"):
        run(spark, raw, rules=(MinRows(100), *RULES[1:]), database="closed")
    assert not (raw / "warehouse").exists()
    assert not spark.catalog.databaseExists("closed")
    (notice,) = failed_runs(spark, str(raw / "runs")).collect()
    assert notice.message == "row_count: Row count 8 below minimum 100"
    assert (notice.files, notice.clean_rows) == (1, 8)


def test_any_failure_leaves_a_notice(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(Exception):
        run(spark, tmp_path)
    assert failed_runs(spark, str(tmp_path / "runs")).count() == 1


def test_an_empty_curated_zone_builds_empty_tables(spark, raw):
    run(spark, raw)
    empty = read_curated(spark, str(raw / "curated")).where("false")
    write_curated(empty, str(raw / "empty"), "b")
    counts = build_warehouse(spark, str(raw / "empty"), str(raw / "w0"))
    assert set(counts.values()) == {0}


def test_warehouse_path_with_and_without_slash(spark, raw):
    run(spark, raw)
    for root in (f"{raw}/w1", f"{raw}/w2/"):
        build_warehouse(spark, str(raw / "curated"), root, datetime.date(2014, 7, 20))
    for name in ("w1", "w2"):
        rfm = spark.read.parquet(f"{raw}/{name}/customer_rfm")
        assert {r.recency_days for r in rfm.collect()} == {17}


def test_views_for_one_session(spark, raw):
    run(spark, raw)
    tables = [
        spark.read.parquet(f"{raw}/warehouse/{t}")
        for t in ("daily_revenue", "customer_segments", "top_products")
    ]
    temporary_views(*tables)
    for view in ("v_revenue_trend", "v_customer_segments", "v_top_products"):
        assert spark.table(view).count() > 0


def test_accepted_events_as_a_table(spark, raw):
    path = raw / "a.json"
    path.write_text(text())
    out, march = str(raw / "events"), datetime.datetime(2024, 3, 1, 12, tzinfo=datetime.timezone.utc)
    ingest_events(spark, [str(path)], out, arrived_at=march)
    register_events(spark, "shop2", out)
    (row,) = spark.sql("SELECT * FROM shop2.streaming WHERE year = 2024 AND month = 3").collect()
    assert row.value == text()


def test_curated_folder_is_read_without_the_batch_column(spark, raw):
    run(spark, raw)
    assert "ingest_batch" not in read_curated(spark, str(raw / "curated")).columns
