import bz2
import datetime
import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from shapes import LINES, RAW, line, plan_of, raw_frame
from tillroll.operators.clean import clean_orders
from tillroll.plans.catalog import register_curated
from tillroll.sinks.scratch import scratch_folder, stored
from tillroll.sinks.tables import write_csv, write_curated, write_table
from tillroll.sources import files as source_files
from tillroll.sources.files import empty_files, files_in, first_line, header_lines, scanned_header_lines
from tillroll.sources.orders import orders_between, read_curated, read_orders_csv, union_parts

TIERED_LAST = [*RAW, "loyalty_tier"]
TIERED_EARLY = [RAW[0], "loyalty_tier", *RAW[1:]]


def put(path, header, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *(",".join(row) for row in rows)]) + "\n")
    return str(path)


def csv_line(n, tier=None, early=False):
    row = list(line(Invoice=str(n), StockCode="A"))
    if tier:
        row.insert(1 if early else 8, tier)
    return row


@pytest.fixture
def mixed(tmp_path):
    put(tmp_path / "raw/old.csv", RAW, csv_line(1), csv_line(2))
    put(tmp_path / "raw/2012/last.csv", TIERED_LAST, csv_line(3, "Gold"))
    put(tmp_path / "raw/2012/deep/early.csv", TIERED_EARLY, csv_line(4, "Silver", early=True))
    return str(tmp_path / "raw")


def test_columns_bind_by_each_files_header(spark, mixed):
    rows = {r.Invoice: r for r in read_orders_csv(spark, mixed).collect()}
    assert {i: r.loyalty_tier for i, r in rows.items()} == {
        "1": None,
        "2": None,
        "3": "Gold",
        "4": "Silver",
    }
    assert {r.Quantity for r in rows.values()} == {"4"}
    assert {r["Customer ID"] for r in rows.values()} == {"31"}


def test_files_with_one_header_are_one_scan(spark, tmp_path):
    for n in range(5):
        put(tmp_path / f"raw/{n}.csv", RAW, csv_line(n))
    plan = plan_of(read_orders_csv(spark, str(tmp_path / "raw"))).split("== Physical Plan ==")[1]
    assert plan.count("FileScan csv") == 1


def test_several_headers_are_one_scan_too(spark, mixed):
    plan = plan_of(read_orders_csv(spark, mixed)).split("== Physical Plan ==")[1]
    assert plan.count("FileScan csv") == 1


def test_any_name_and_compression(spark, tmp_path):
    put(tmp_path / "raw/a.csv", RAW, csv_line(1))
    put(tmp_path / "raw/C.CSV", RAW, csv_line(2))
    put(tmp_path / "raw/part-0001", TIERED_LAST, csv_line(3, "Gold"))
    text = ",".join(RAW) + "\n" + ",".join(csv_line(4)) + "\n"
    (tmp_path / "raw/b.csv.gz").write_bytes(gzip.compress(text.encode()))
    rows = read_orders_csv(spark, str(tmp_path / "raw")).collect()
    assert sorted(r.Invoice for r in rows) == ["1", "2", "3", "4"]


def test_line_breaks_in_quotes(spark, tmp_path):
    rows = [line(Description='two\n"quoted"\r\nlines, three'), line(Invoice="2")]
    write_csv(raw_frame(spark, rows), str(tmp_path / "out"))
    back = read_orders_csv(spark, str(tmp_path / "out"), multiline=True)
    texts = {r.Invoice: r.Description for r in back.collect()}
    assert {k: v.replace("\r\n", "\n") for k, v in texts.items()} == {
        "700001": 'two\n"quoted"\nlines, three',
        "2": "blue mug",
    }


def test_list_of_files(spark, mixed):
    assert read_orders_csv(spark, [f"{mixed}/old.csv"]).count() == 2


def test_no_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    raw = read_orders_csv(spark, str(tmp_path / "raw"))
    assert raw.columns == RAW and raw.count() == 0


def test_quotes_commas_and_empty_fields(spark, tmp_path):
    put(
        tmp_path / "q.csv",
        RAW,
        ["1", "A", '"SAID ""HI"", TWICE"', "6", "2010-12-01", "1", "", "UK"],
        ["2", "A", '"back\\slash"', "6", "2010-12-01", "1", "2", "UK"],
    )
    first, second = read_orders_csv(spark, [str(tmp_path / "q.csv")]).orderBy("Invoice").collect()
    assert first.Description == 'SAID "HI", TWICE' and first["Customer ID"] is None
    assert second.Description == "back\\slash"


@pytest.mark.parametrize("name", ["odd [1] {a}*.csv", "plus+per%20cent.csv"])
def test_odd_file_names(spark, tmp_path, name):
    put(tmp_path / "raw" / name, TIERED_EARLY, csv_line(4, "Silver", early=True))
    assert read_orders_csv(spark, str(tmp_path / "raw")).first().loyalty_tier == "Silver"


def test_byte_order_mark_and_compression(spark, tmp_path):
    text = "﻿" + ",".join(TIERED_EARLY) + "\n" + ",".join(csv_line(1, "Gold", True)) + "\n"
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(text.encode()))
    row = read_orders_csv(spark, [str(tmp_path / "z.csv.gz")]).first()
    assert (row.Invoice, row.loyalty_tier) == ("1", "Gold")


def headers_of(frame):
    return {row.file.split("/")[-1]: row.header for row in frame.collect()}


def test_headers_equal_those_of_a_scan(spark, tmp_path):
    texts = {
        "plain.csv": b"a,b\n1,2\n",
        "blank.csv": b"\n  \r\n a, b\r\n1,2\r\n",
        "mac.csv": b"a,c\r1,2\r",
        "lonely.csv": "a,ü d".encode(),
        "broken.csv": b"a,\xff\n1,2\n",
        "nothing.csv": b"\n \n",
        "packed.csv.gz": gzip.compress(b"a,e\n1,2\n") + gzip.compress(b"3,4\n"),
        "packed.bz2": bz2.compress(b"\na,f\n1,2\n"),
        "long.csv": b"x" * 300_000 + b"\n1\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    found = headers_of(header_lines(spark, str(tmp_path)))
    assert found == headers_of(scanned_header_lines(spark, str(tmp_path)))
    assert len(found) == 8 and found["blank.csv"] == " a, b" and found["packed.bz2"] == "a,f"


def test_no_more_is_read_than_the_block_of_the_header(monkeypatch):
    sizes = []

    class Counted(io.BytesIO):
        def read1(self, size=-1):
            sizes.append(size)
            return super().read1(size)

    text = b"a,b\n" + b"1,2\n" * 1_000_000
    monkeypatch.setattr(source_files, "_stream", lambda path, stores: Counted(text))
    assert first_line("file:/x.csv", {}) == "a,b"
    assert len(sizes) == 1 and 0 < sizes[0] <= 65_536


def test_what_only_spark_unpacks_is_scanned(spark, tmp_path):
    raw_frame(spark, LINES).write.option("header", True).option("compression", "deflate").csv(
        str(tmp_path / "raw/packed")
    )
    put(tmp_path / "raw/plain.csv", TIERED_EARLY, csv_line(4, "Silver", early=True))
    rows = read_orders_csv(spark, str(tmp_path / "raw")).collect()
    assert len(rows) == len(LINES) + 1
    assert [r.loyalty_tier for r in rows if r.Invoice == "4"] == ["Silver"]


def test_a_store_that_cannot_be_reached_is_asked_once(monkeypatch):
    asked = []

    class Refusing:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            raise OSError("no access")

    monkeypatch.setattr(source_files.pyarrow.fs, "FileSystem", Refusing)
    stores = {}
    for name in ("a b.csv", "c.csv"):
        with pytest.raises(OSError):
            first_line(f"s3a://shop/{name}", stores)
    assert asked == ["s3://shop/a%20b.csv"]


def test_csv_round_trip(spark, tmp_path):
    rows = [*LINES, line(Description='a "quoted", one')]
    write_csv(raw_frame(spark, rows), str(tmp_path / "out"))
    back = read_orders_csv(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, raw_frame(spark, rows).collect()))


def test_union_keeps_duplicates_and_fills_columns(spark):
    a = spark.createDataFrame([("1", "x")], "Invoice string, note string")
    b = spark.createDataFrame([("1",), ("1",)], "Invoice string")
    union = union_parts([a, b, b])
    assert union.columns == ["Invoice", "note"] and union.count() == 5


def test_listing_shows_no_empty_files(spark, tmp_path):
    put(tmp_path / "in/a.csv", ["x"])
    (tmp_path / "in/sub").mkdir()
    (tmp_path / "in/sub/e.csv").touch()
    folder = str(tmp_path / "in")
    (tmp_path / "in/old.csv").touch()
    os.utime(tmp_path / "in/old.csv", (0, 0))
    assert [r.path.split("/")[-1] for r in files_in(spark, folder, "*.csv").collect()] == ["a.csv"]
    names = lambda **only: sorted(p.split("/")[-1] for p in empty_files(spark, folder, **only))
    assert names() == ["e.csv", "old.csv"] and names(pattern="*.txt") == []
    assert names(pattern="*.csv", since="2020-01-01T00:00:00") == ["e.csv"]


@pytest.fixture
def orders(spark):
    rows = [
        line(Invoice=str(n), InvoiceDate=f"20{9 + n % 3:02d}-0{1 + n % 9}-01 10:00:00")
        for n in range(60)
    ]
    return clean_orders(raw_frame(spark, [*rows, line(InvoiceDate="?")]))


def test_curated_round_trip(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(orders, path, "b1")
    back = read_curated(spark, path)
    assert back.schema.names == orders.schema.names
    assert sorted(map(str, back.collect())) == sorted(map(str, orders.collect()))
    assert back.where("year is null").count() == 1


def test_batches_add_up_and_a_rerun_replaces(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    for batch in ("b1", "b2", "b2", "b1"):
        write_curated(orders, path, batch)
    assert read_curated(spark, path).count() == 2 * 61


@pytest.mark.parametrize("rebalance", [True, False])
def test_rebalance_is_the_only_shuffle(spark, orders, tmp_path, rebalance):
    path = tmp_path / "curated"
    write_curated(orders.repartition(8), str(path), "b", rebalance)
    files = len(list(path.rglob("*.parquet")))
    months = len({f.parent for f in path.rglob("*.parquet")})
    assert files == months if rebalance else files > months


def test_no_month_is_left_to_one_task_without_adaptive_execution(spark, orders, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_curated(orders.repartition(8), str(tmp_path / "curated"), "b")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = list((tmp_path / "curated").rglob("*.parquet"))
    assert len(files) > len({f.parent for f in files})


def test_old_files_without_a_column_read_as_null(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    orders.drop("loyalty_tier").withColumn("ingest_batch", F.lit("old")).write.partitionBy(
        "year", "month", "ingest_batch"
    ).parquet(path)
    write_curated(orders.withColumn("loyalty_tier", F.lit("Gold")), path, "new")
    tiers = read_curated(spark, path).groupBy("loyalty_tier").count().collect()
    assert {r.loyalty_tier: r["count"] for r in tiers} == {None: 61, "Gold": 61}


def test_columns_that_only_some_batches_brought(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(orders.withColumn("channel", F.lit("web")), path, "with")
    write_curated(orders, path, "without")
    seen = read_curated(spark, path).groupBy("channel").count().collect()
    assert {r.channel: r["count"] for r in seen} == {"web": 61, None: 61}
    register_curated(spark, "extras", path)
    assert spark.table("extras.online_retail").where("channel = 'web'").count() == 61
    write_curated(orders.withColumn("shop_floor", F.lit("2")), path, "third")
    register_curated(spark, "extras", path)
    assert spark.table("extras.online_retail").where("shop_floor = '2'").count() == 61


def test_months_are_pruned_and_columns_too(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(orders, path, "b")
    query = read_curated(spark, path).where("year = 2010 and month = 2").select("Revenue")
    plan = plan_of(query).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(year" in plan and "year#" in plan
    assert "ReadSchema: struct<Revenue:double>" in plan


@pytest.mark.parametrize(
    "start, end",
    [
        ((2009, 3, 1), (2009, 5, 2)),
        ((2009, 8, 1, 12), (2011, 2, 1, 10)),
        ((2010, 1, 1), (2010, 1, 1)),
        ((2000, 1, 1), (2030, 12, 31)),
    ],
)
def test_period_by_date_and_partition(spark, orders, tmp_path, start, end):
    path = str(tmp_path / "curated")
    write_curated(orders, path, "b")
    start, end = datetime.datetime(*start), datetime.datetime(*end)
    period = orders_between(read_curated(spark, path), start, end)
    assert period.count() == sum(
        r.InvoiceDate is not None and start <= r.InvoiceDate < end for r in orders.collect()
    )
    if start == end:  # Spark sees that nothing can match and reads nothing.
        return
    pruned = plan_of(period).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year#" in pruned and "month#" in pruned


def test_price_filter_reaches_the_scan(spark, orders, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(orders, path, "b")
    plan = plan_of(read_curated(spark, path).where("UnitPrice > 5"))
    assert "GreaterThan(UnitPrice,5.0)" in plan


def test_write_table_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(10), path) == 10
    assert write_table(spark.range(3), path) == 3
    assert write_table(spark.range(3).where("id > 5"), str(tmp_path / "none")) == 0
    assert spark.read.parquet(path).count() == 3


def test_stored_cuts_lineage_below_the_shared_folder(spark):
    frame = stored(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in plan_of(frame) and frame.count() == 5
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or scratch_folder(spark).startswith(shared)
