import datetime
import os

import pytest
from pyspark.sql import functions as F

from shapes import line, plan_of, raw_frame
from tillroll.operators.clean import clean_orders
from tillroll.plans import increments
from tillroll.plans.catalog import CURATED_TABLE, WAREHOUSE_TABLES, register_curated
from tillroll.plans.increments import published, published_path, update_warehouse
from tillroll.plans.lake import build_warehouse
from tillroll.sinks import compaction
from tillroll.sinks.compaction import drop_replaced
from tillroll.sinks.tables import write_curated
from tillroll.sources.orders import compact_curated, read_curated

DAYS = ("2014-07-03 11:05:00", "2014-07-04 09:00:00", "2014-08-01 10:00:00", "unknown")


def lines(numbers):
    """Lines whose invoices, customers, products and days come back in other batches."""
    return [
        line(
            Invoice=str(900 + n % 11),
            StockCode=f"P{n % 5}",
            Description=["mug", "lamp", None][n % 3],
            Quantity=str(1 + n % 4),
            InvoiceDate=DAYS[n % 7 % 4],
            Price=f"{1 + n % 9}.25",
            **{"Customer ID": str(30 + n % 6)},
        )
        for n in numbers
    ]


def add(spark, root, batch, numbers):
    write_curated(clean_orders(raw_frame(spark, lines(numbers))), f"{root}/curated", batch)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def scanned(frame):
    return {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}


def same_as_rebuild(spark, root, reference=None):
    build_warehouse(spark, f"{root}/curated", f"{root}/whole", reference)
    for table in WAREHOUSE_TABLES:
        ours = spark.read.parquet(published_path(spark, f"{root}/w", table))
        whole = spark.read.parquet(f"{root}/whole/{table}")
        assert ours.schema == whole.schema and rows(ours) == rows(whole), table


def test_three_increments_equal_a_rebuild(spark, tmp_path):
    for number, numbers in enumerate((range(0, 30), range(20, 50), [60, 61, 95])):
        add(spark, tmp_path, f"b{number}", numbers)
        counts = update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
        same_as_rebuild(spark, tmp_path)
        assert counts["customer_rfm"] == 6
    newest = published(spark, f"{tmp_path}/w")
    assert (newest.sequence, newest.batches) == (3, ["b2"])
    update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w", rebuild=True)
    same_as_rebuild(spark, tmp_path)


def test_nothing_new_and_reference_date(spark, tmp_path):
    add(spark, tmp_path, "b0", range(12))
    day = datetime.date(2014, 9, 1)
    for _ in range(2):
        update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w", reference_date=day)
        same_as_rebuild(spark, tmp_path, day)


def test_an_increment_reads_its_own_batches_and_touched_months(spark, tmp_path, monkeypatch):
    add(spark, tmp_path, "b0", range(40))
    update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    august = line(Invoice="990", InvoiceDate=DAYS[2])
    write_curated(clean_orders(raw_frame(spark, [august])), f"{tmp_path}/curated", "b1")
    read = []
    keyed, in_months = increments._keyed, increments._in_months
    monkeypatch.setattr(increments, "_keyed", lambda o: read.append(scanned(o)) or keyed(o))
    monkeypatch.setattr(
        increments, "_in_months", lambda m: read.append([tuple(at) for at in m]) or in_months(m)
    )
    update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    files, *months = read
    assert files and all("ingest_batch=b1" in name and "month=8" in name for name in files)
    assert months == [[(2014, 8)], [(2014, 8)]]


def exchanges(frame):
    """Shuffles in the plan of a frame that has not run."""
    return str(frame._jdf.queryExecution().executedPlan()).count("Exchange ")


def test_new_pairs_take_one_shuffle_and_no_join(spark):
    schema = "CustomerID double, Invoice string"
    found = spark.createDataFrame([(None, "a"), (None, "a"), (1.0, "a"), (2.0, "b"), (None, "c")], schema)
    known = spark.createDataFrame([(None, "a"), (2.0, "b"), (9.0, "z")], schema)
    new = increments._unknown(found, known)
    assert exchanges(new) == 1 and "Join" not in plan_of(new)
    assert rows(new) == sorted([(None, "c"), (1.0, "a")], key=str)
    assert rows(increments._unknown(found, None)) == rows(found.distinct())


def test_state_takes_one_shuffle(spark, tmp_path):
    add(spark, tmp_path, "b0", range(30))
    lines = increments._keyed(read_curated(spark, f"{tmp_path}/curated"))
    parts = [increments._contributions(lines, increments.PRODUCTS)] * 3
    assert exchanges(increments._merged(parts, increments.PRODUCTS)) == 1
    assert exchanges(increments._descriptions(lines, increments._descriptions(lines, None))) == 2


def test_pairs_carry_the_sums_of_their_lines_in_one_shuffle(spark, tmp_path):
    found = [("a", "A", 1), ("a", "A", 2), ("b", "A", 4), (None, "A", 8), ("c", "B", 16)]
    schema = "Invoice string, StockCode string, Quantity int, Revenue double, InvoiceDate timestamp"
    lines = spark.createDataFrame([(i, s, n, n / 2, None) for i, s, n in found], schema)
    known = spark.createDataFrame([("A", "b"), ("Z", "z")], "StockCode string, Invoice string")
    pairs = increments._with_sums(lines, "product_invoices", known)
    assert exchanges(pairs) == 1 and "Join" not in plan_of(pairs)
    expected = [("A", "a", 1.5, 3, 1), ("A", "b", 2.0, 4, 0), ("A", None, 4.0, 8, 0), ("B", "c", 8.0, 16, 1)]
    assert rows(pairs) == sorted(expected, key=str)


def test_customers_and_products_are_summed_from_pairs(spark, tmp_path, monkeypatch):
    summed, merged = [], increments._merged

    def noted(parts, kind):
        summed.extend((kind, name) for part in parts for name in scanned(part) if "/curated/" in name)
        return merged(parts, kind)

    monkeypatch.setattr(increments, "_merged", noted)
    for number, numbers in enumerate((range(0, 30), range(20, 50))):
        add(spark, tmp_path, f"b{number}", numbers)
        update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    assert summed and {kind for kind, _ in summed} == {increments.DAYS}
    same_as_rebuild(spark, tmp_path)


def test_state_keeps_one_description_a_product(spark, tmp_path):
    for number, numbers in enumerate((range(30, 60), range(0, 40))):
        add(spark, tmp_path, f"b{number}", numbers)
        update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
        version = published(spark, f"{tmp_path}/w").version
        kept = spark.read.parquet(f"{tmp_path}/w/state/{version}/descriptions")
        assert kept.count() == kept.select("StockCode").distinct().count() == 5
        same_as_rebuild(spark, tmp_path)


def test_pairs_of_versions_without_sums_are_known(spark, tmp_path):
    add(spark, tmp_path, "b0", range(0, 30))
    update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    version = published(spark, f"{tmp_path}/w").version
    for kind, key in (("customer_invoices", "CustomerID"), ("product_invoices", "StockCode")):
        path = f"{tmp_path}/w/pairs/{kind}/added={version}"
        bare = spark.read.parquet(path).select(key, "Invoice").collect()
        spark.createDataFrame(bare).write.mode("overwrite").parquet(path)
    add(spark, tmp_path, "b1", range(20, 50))
    update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    same_as_rebuild(spark, tmp_path)


def test_daily_pairs_are_written_a_file_a_month(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for number, numbers in enumerate((range(0, 60), range(50, 120))):
            add(spark, tmp_path, f"b{number}", numbers)
            update_warehouse(spark, f"{tmp_path}/curated", f"{tmp_path}/w")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for kind in ("day_invoices", "day_customers"):
        files = [str(f.parent) for f in (tmp_path / "w/pairs" / kind).rglob("part-*.parquet")]
        assert files and len(files) == len(set(files)), kind
    same_as_rebuild(spark, tmp_path)


def test_a_failure_leaves_the_old_tables_all_four(spark, tmp_path, monkeypatch):
    curated, w = f"{tmp_path}/curated", f"{tmp_path}/w"
    add(spark, tmp_path, "b0", range(30))
    register_curated(spark, "inc", curated)
    update_warehouse(spark, curated, w, "inc")
    before = {t: rows(spark.table(f"inc.{t}")) for t in WAREHOUSE_TABLES}

    add(spark, tmp_path, "b1", range(25, 60))
    register_curated(spark, "inc", curated)
    real, written = increments.write_table, []

    def third_fails(frame, path):
        written.append(path)
        if len(written) == 3:
            raise OSError("disk full")
        return real(frame, path)

    monkeypatch.setattr(increments, "write_table", third_fails)
    with pytest.raises(OSError):
        update_warehouse(spark, curated, w, "inc")
    assert {t: rows(spark.table(f"inc.{t}")) for t in WAREHOUSE_TABLES} == before
    assert published(spark, w).sequence == 1

    monkeypatch.setattr(increments, "write_table", real)
    update_warehouse(spark, curated, w, "inc")
    same_as_rebuild(spark, tmp_path)
    for table in WAREHOUSE_TABLES:
        assert rows(spark.table(f"inc.{table}")) == rows(spark.read.parquet(f"{tmp_path}/whole/{table}"))
    assert spark.sql("SELECT sum(num_orders) FROM inc.v_revenue_trend").first()[0] > 0


# Compaction


def test_many_batches_become_one(spark, tmp_path):
    curated = f"{tmp_path}/curated"
    for number in range(10):
        add(spark, tmp_path, f"b{number}", range(number * 5, number * 5 + 5))
    before = rows(read_curated(spark, curated))
    assert compact_curated(spark, curated, min_batches=50) is None
    name = compact_curated(spark, curated, min_batches=4)
    assert rows(read_curated(spark, curated)) == before
    live = scanned(read_curated(spark, curated))
    assert live and all(f"ingest_batch={name}" in path for path in live)
    # Another round takes in what came since, and the files replaced can go.
    add(spark, tmp_path, "b10", range(60, 70))
    before = rows(read_curated(spark, curated))
    assert compact_curated(spark, curated, min_batches=2) != name
    assert drop_replaced(spark, curated) > 10
    assert rows(read_curated(spark, curated)) == before


def test_a_crash_before_the_log_changes_nothing(spark, tmp_path, monkeypatch):
    curated = f"{tmp_path}/curated"
    for number in range(4):
        add(spark, tmp_path, f"b{number}", range(number * 5, number * 5 + 5))
    before, real = rows(read_curated(spark, curated)), compaction._write_log

    def crash(spark, rows, path):
        if rows:
            raise OSError("lost")
        real(spark, rows, path)

    monkeypatch.setattr(compaction, "_write_log", crash)
    with pytest.raises(OSError):
        compact_curated(spark, curated, min_batches=2)
    assert any("compact-" in folder for folder, *_ in os.walk(curated))
    assert rows(read_curated(spark, curated)) == before
    monkeypatch.setattr(compaction, "_write_log", real)
    compact_curated(spark, curated, min_batches=2)
    assert rows(read_curated(spark, curated)) == before


def test_the_registered_table_and_increments_behind_a_compaction(spark, tmp_path):
    curated, w = f"{tmp_path}/curated", f"{tmp_path}/w"
    for number in range(3):
        add(spark, tmp_path, f"b{number}", range(number * 10, number * 10 + 12))
    register_curated(spark, "packed", curated)
    update_warehouse(spark, curated, w, "packed")
    expected = rows(spark.table(f"packed.{CURATED_TABLE}").drop("ingest_batch"))
    compact_curated(spark, curated, min_batches=2)
    register_curated(spark, "packed", curated)
    table = spark.table(f"packed.{CURATED_TABLE}")
    assert rows(table.drop("ingest_batch")) == expected
    assert table.where(F.col("year").isNull()).select("ingest_batch").distinct().count() == 1
    # What was taken in before stays so.
    add(spark, tmp_path, "b3", range(5, 9))
    register_curated(spark, "packed", curated)
    update_warehouse(spark, curated, w, "packed")
    assert published(spark, w).batches == ["b3"]
    same_as_rebuild(spark, tmp_path)
    # A batch that was compacted before any version took it in makes for a rebuild.
    add(spark, tmp_path, "b4", range(70, 90))
    compact_curated(spark, curated, min_batches=2)
    register_curated(spark, "packed", curated)
    update_warehouse(spark, curated, w, "packed")
    assert published(spark, w).sequence == 3 and len(published(spark, w).batches) > 1
    same_as_rebuild(spark, tmp_path)
    add(spark, tmp_path, "b5", range(80, 99))
    register_curated(spark, "packed", curated)
    update_warehouse(spark, curated, w, "packed")
    assert published(spark, w).batches == ["b5"]
    same_as_rebuild(spark, tmp_path)
