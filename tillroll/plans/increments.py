"""Warehouse tables kept up by increments, and published together.

A version of the warehouse is built from the version before and the curated batches that are new; the
history of order lines is not read again. What makes that exact:

* Sums, newest dates and first descriptions merge by themselves. They are kept per day, customer and
  product as state, one row each, which a version writes anew.
* Distinct counts do not merge, so the distinct pairs behind them are kept: (day, invoice), (day,
  customer), (customer, invoice), (product, invoice). A version adds the pairs that its batches bring
  and no earlier one had, and counts grow by those. Pairs are stored by the version that added them,
  the daily ones by month too. Of the daily pairs only the touched months are read; of the others
  those whose invoice lies between the batches' smallest and largest, which are found by the
  statistics of the sorted files. Customers and products are many, so their sums are taken per pair,
  by the aggregate that finds the new ones, and state adds up pairs: these are stored with what the
  version's lines add. A pair that was known before is stored again for that, with a count of 0.

Below a warehouse folder:

* `versions/<version>/<table>`: the four tables.
* `state/<version>/…` and `pairs/<kind>/…/added=<version>`.
* `_published`: a row per version with the batches it took in, written last. Only versions named
  there count; what a failed run leaves is never read, and the next run takes the same batches again.

With a catalog, the tables' locations are moved to the new version after that row, one statement each.
One writer at a time; readers of the old version keep its files. A rebuild begins a new chain of
versions, whose pairs and state start from nothing.
"""

import datetime
import uuid
from collections.abc import Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.reports import customer_segments
from tillroll.plans.catalog import CURATED_TABLE, WAREHOUSE_TABLES, move_warehouse, table_path
from tillroll.plans.jobs import side_by_side
from tillroll.sinks.compaction import COMPACTED, replaced_batches
from tillroll.sinks.tables import write_table
from tillroll.sources.files import is_missing
from tillroll.sources.orders import stored_orders

PUBLISHED_SCHEMA = (
    "sequence bigint, version string, chain string, batches array<string>, published_at timestamp"
)

DAYS, CUSTOMERS, PRODUCTS = "days", "customers", "products"

# State by kind: its key, and how each of its other columns merges.
STATE = {
    DAYS: ("order_date", {"revenue": F.sum, "units": F.sum, "orders": F.sum, "customers": F.sum}),
    CUSTOMERS: ("CustomerID", {"revenue": F.sum, "newest": F.max, "orders": F.sum}),
    PRODUCTS: ("StockCode", {"revenue": F.sum, "units": F.sum, "orders": F.sum}),
}
DESCRIPTIONS = "descriptions"
# Pairs by kind: the state they count for, the column of the count and the counted column.
PAIRS = {
    "day_invoices": (DAYS, "orders", "Invoice"),
    "day_customers": (DAYS, "customers", "CustomerID"),
    "customer_invoices": (CUSTOMERS, "orders", "Invoice"),
    "product_invoices": (PRODUCTS, "orders", "Invoice"),
}


def _read(spark: SparkSession, schema: str, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], schema)
        raise


def publications(spark: SparkSession, warehouse: str) -> DataFrame:
    return _read(spark, PUBLISHED_SCHEMA, f"{warehouse.rstrip('/')}/_published")


def published(spark: SparkSession, warehouse: str) -> Row | None:
    """The newest version, None before the first."""
    rows = publications(spark, warehouse)
    return rows.orderBy(F.desc("sequence"), F.desc("published_at")).first()


def published_path(spark: SparkSession, warehouse: str, table: str) -> str:
    """Where a table's newest published version lies."""
    newest = published(spark, warehouse)
    if newest is None:
        raise FileNotFoundError(f"nothing is published in {warehouse}")
    return table_path(f"{warehouse.rstrip('/')}/versions/{newest.version}", table)


def new_batches(
    spark: SparkSession, curated: str, warehouse: str, last: Row | None, database: str | None
) -> list[str] | None:
    """Batches that the last version lacks; None if some of them were compacted in the meantime.

    With a catalog their names come from its partitions, without one from a scan that reads no column.
    """
    if database:
        parts = spark.sql(f"SHOW PARTITIONS {database}.{CURATED_TABLE}")
        names = parts.select(F.regexp_extract("partition", "ingest_batch=([^/]*)", 1).alias("batch"))
    else:
        names = stored_orders(spark, curated).select(F.col("ingest_batch").alias("batch"))
    chain = last.chain if last else None
    taken = publications(spark, warehouse).where(F.col("chain") == chain)
    taken = taken.select(F.explode("batches").alias("batch"))
    lost = replaced_batches(spark, curated).join(taken, "batch", "left_anti")
    if last and not lost.isEmpty():
        return None
    own = names.distinct().where(~F.startswith("batch", F.lit(COMPACTED)))
    return [row.batch for row in own.join(taken, "batch", "left_anti").orderBy("batch").collect()]


def _month(day: Column) -> list[Column]:
    return [F.year(day).alias("year"), F.month(day).alias("month")]


def _keyed(orders: DataFrame) -> DataFrame:
    """Order lines with their day, and the columns that any of the tables needs."""
    day = F.to_date("InvoiceDate").alias("order_date")
    columns = ("Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "CustomerID", "Revenue")
    return orders.select(*columns, day)


def _contributions(lines: DataFrame, kind: str, *others: str) -> DataFrame:
    """What each line adds to the state, distinct counts aside; other columns are kept."""
    found = {
        "revenue": F.col("Revenue"),
        "units": F.col("Quantity"),
        "newest": F.col("InvoiceDate"),
        "orders": F.lit(0).cast("long"),
        "customers": F.lit(0).cast("long"),
    }
    key, columns = STATE[kind]
    return lines.select(key, *others, *(found[name].alias(name) for name in columns))


def _merged(parts: Sequence[DataFrame], kind: str) -> DataFrame:
    """State from lines, new pairs and earlier state in one aggregate, so with one shuffle."""
    key, columns = STATE[kind]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy(key).agg(*(merge(name).alias(name) for name, merge in columns.items()))


def _descriptions(lines: DataFrame, old: DataFrame | None) -> DataFrame:
    """First date of every description of a product."""
    seen = lines.where(F.col("Description").isNotNull()).select(
        "StockCode", "Description", F.col("InvoiceDate").alias("first_seen")
    )
    seen = seen if old is None else seen.unionByName(old)
    return seen.groupBy("StockCode", "Description").agg(F.min("first_seen").alias("first_seen"))


def _first_descriptions(seen: DataFrame) -> DataFrame:
    """The earliest description of a product, then the smallest text, a missing date last.

    No other one can become the first by lines to come, so state needs no more.
    """
    earliest = F.min(F.struct(F.col("first_seen").isNull().alias("undated"), "first_seen", "Description"))
    firsts = seen.groupBy("StockCode").agg(earliest.alias("first"))
    return firsts.select("StockCode", "first.Description", "first.first_seen")


def _unknown(found: DataFrame, known: DataFrame | None) -> DataFrame:
    """The distinct rows of `found` that are not in `known`, NULLs being equal.

    One aggregate over both: an anti-join would shuffle what is found a second time, as its keys that
    may be NULL are not those of the distinct, and sort both sides.
    """
    if known is None:
        return found.distinct()
    rows = found.withColumn("_known", F.lit(False)).unionByName(known.withColumn("_known", F.lit(True)))
    return rows.groupBy(*found.columns).agg(F.max("_known").alias("_known")).where("NOT _known").drop("_known")


def _with_sums(lines: DataFrame, kind: str, known: DataFrame | None) -> DataFrame:
    """The pairs of these lines, each with what its lines add to the state, itself among it if new.

    One aggregate over lines and known pairs, so with one shuffle. A pair without the counted value is
    there for its sums only.
    """
    state, column, counted = PAIRS[kind]
    key, columns = STATE[state]
    rows = _contributions(lines, state, counted).withColumn("_seen", F.lit(1))
    if known is not None:
        rows = rows.unionByName(known.select(key, counted, F.lit(2).alias("_seen")), allowMissingColumns=True)
    sums = (merge(name).alias(name) for name, merge in columns.items())
    # 1 in the lines, 2 known, 3 both.
    pairs = rows.groupBy(key, counted).agg(*sums, F.bit_or("_seen").alias("_seen")).where("_seen != 2")
    new = F.col(counted).isNotNull() & (F.col("_seen") == 1)
    return pairs.withColumn(column, new.cast("long")).drop("_seen")


def _add_pairs(
    lines: DataFrame, kind: str, folder: str, version: str, chain: list[str], bounds: Row | None
) -> DataFrame:
    """Store the pairs of `kind` that these lines bring; what each adds to the state.

    Daily pairs are brought together by month first. Otherwise every task would write a file for each
    month, and readers would open that many.
    """
    spark = lines.sparkSession
    state, column, counted = PAIRS[kind]
    key, path = STATE[state][0], f"{folder}/{kind}"
    daily, known = state == DAYS, None
    months = _month(F.col("order_date")) if daily else ()
    own = lines.select(key, counted, *months) if daily else _with_sums(lines, kind, None)
    schema = own.schema.add("added", "string")
    if chain:
        known = spark.read.schema(schema).parquet(path).where(F.col("added").isin(chain))
        if daily:
            known = known.where(_in_months(bounds.months))
        else:
            # Versions from before pairs had sums hold new pairs only.
            known = known.where(F.coalesce(F.col(column) > 0, F.lit(True)))
        if counted == "Invoice":
            known = known.where(F.col("Invoice").between(bounds.first, bounds.last))
        known = known.select(key, counted)
    if daily:
        found = _unknown(lines.where(F.col(counted).isNotNull()).select(key, counted), known)
        found = found.select("*", *months).hint("rebalance", "year", "month")
    else:
        found = _with_sums(lines, kind, known)
    folders = ["year", "month", "added"] if daily else ["added"]
    (
        found.withColumn("added", F.lit(version))
        .sortWithinPartitions(*folders[:-1], counted)
        .write.mode("append")
        .partitionBy(*folders)
        .parquet(path)
    )
    added = spark.read.schema(schema).parquet(path).where(F.col("added") == version)
    if daily:
        return added.select(key, F.lit(1).cast("long").alias(column))
    return added.select(key, *STATE[state][1])


def _in_months(months: list[Row]) -> Column:
    """The partitions of the given months; one without a date has no year."""
    found = F.lit(False)
    for at in months:
        same = F.col("year").eqNullSafe(F.lit(at.year)) & F.col("month").eqNullSafe(F.lit(at.month))
        found = found | same
    return found


def _bounds(lines: DataFrame) -> Row:
    """Smallest and largest invoice of the lines, and the months they touch."""
    month = F.struct(*_month(F.col("order_date")))
    return lines.agg(
        F.min("Invoice").alias("first"),
        F.max("Invoice").alias("last"),
        F.collect_set(month).alias("months"),
    ).first()


def _daily_revenue(days: DataFrame) -> DataFrame:
    return days.select(
        "order_date",
        F.round("revenue", 2).alias("total_revenue"),
        F.col("orders").alias("num_orders"),
        F.col("customers").alias("num_customers"),
        F.col("units").alias("total_units"),
    ).orderBy("order_date")


def _customer_rfm(customers: DataFrame, reference_date: datetime.date | None) -> DataFrame:
    newest = customers.select(F.max("newest")).scalar()
    reference = newest if reference_date is None else F.lit(reference_date)
    return customers.select(
        "CustomerID",
        F.date_diff(reference, "newest").alias("recency_days"),
        F.col("orders").alias("frequency"),
        F.round("revenue", 2).alias("monetary"),
    )


def _top_products(products: DataFrame, described: DataFrame) -> DataFrame:
    texts = described.select(F.col("StockCode").alias("code"), F.col("Description").alias("description"))
    return (
        products.join(texts, F.col("StockCode").eqNullSafe(F.col("code")), "left")
        .select(
            "StockCode",
            "description",
            F.round("revenue", 2).alias("total_revenue"),
            F.col("units").alias("total_units"),
            F.col("orders").alias("num_orders"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("StockCode"))
    )


def update_warehouse(
    spark: SparkSession,
    curated: str,
    warehouse: str,
    database: str | None = None,
    reference_date: datetime.date | None = None,
    rebuild: bool = False,
) -> dict[str, int]:
    """Take the new batches into the next version, publish it, and return its rows by table.

    With `database` the registered tables are moved to it. `rebuild` reads all batches again, as do
    the first run and one that finds batches compacted before they were taken in.
    """
    warehouse = warehouse.rstrip("/")
    last = published(spark, warehouse)
    batches = None
    if last and not rebuild:
        batches = new_batches(spark, curated, warehouse, last, database)
    fresh = batches is None
    sequence = last.sequence + 1 if last else 1
    version = f"{sequence:06d}-{uuid.uuid4().hex[:8]}"
    chain, earlier = (version, []) if fresh else (last.chain, _versions(spark, warehouse, last.chain))
    orders = spark.table(f"{database}.{CURATED_TABLE}") if database else stored_orders(spark, curated)
    if fresh:
        names = orders.select("ingest_batch").distinct().collect()
        batches = sorted({r.ingest_batch for r in names} | _replaced(spark, curated))
    else:
        orders = orders.where(F.col("ingest_batch").isin(batches))
    lines = _keyed(orders)
    bounds = _bounds(lines) if earlier else None
    state, target = f"{warehouse}/state/{version}", f"{warehouse}/versions/{version}"

    def old(kind: str) -> DataFrame | None:
        return None if fresh else spark.read.parquet(f"{warehouse}/state/{last.version}/{kind}")

    def kept(frame: DataFrame, path: str) -> DataFrame:
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    def new_state(kind: str) -> DataFrame:
        kinds = [pairs for pairs, (counted_for, *_) in PAIRS.items() if counted_for == kind]
        add = partial(_add_pairs, folder=f"{warehouse}/pairs", version=version, chain=earlier, bounds=bounds)
        added = side_by_side(spark, *(partial(add, lines, pairs) for pairs in kinds))
        before = [] if fresh else [old(kind)]
        sums = [_contributions(lines, kind)] if kind == DAYS else []
        return kept(_merged([*before, *sums, *added], kind), f"{state}/{kind}")

    def new_descriptions() -> DataFrame:
        found = _first_descriptions(_descriptions(lines, old(DESCRIPTIONS)))
        return kept(found, f"{state}/{DESCRIPTIONS}")

    def table(name: str, frame: DataFrame) -> dict[str, int]:
        return {name: write_table(frame, table_path(target, name))}

    def customers() -> dict[str, int]:
        rfm = _customer_rfm(new_state(CUSTOMERS), reference_date)
        counts = table("customer_rfm", rfm)
        scored = spark.read.schema(rfm.schema).parquet(table_path(target, "customer_rfm"))
        return counts | table("customer_segments", customer_segments(scored))

    def products() -> dict[str, int]:
        found = side_by_side(spark, partial(new_state, PRODUCTS), new_descriptions)
        return table("top_products", _top_products(*found))

    def days() -> dict[str, int]:
        return table("daily_revenue", _daily_revenue(new_state(DAYS)))

    # Customers first: many short jobs find their quartiles, which then run beside the longer ones.
    counts: dict[str, int] = {}
    for part in side_by_side(spark, customers, days, products):
        counts |= part

    now = datetime.datetime.now(datetime.timezone.utc)
    row = (sequence, version, chain, batches, now)
    spark.createDataFrame([row], PUBLISHED_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{warehouse}/_published"
    )
    if database:
        move_warehouse(spark, database, target)
    return {name: counts[name] for name in WAREHOUSE_TABLES}


def _versions(spark: SparkSession, warehouse: str, chain: str) -> list[str]:
    """Published versions of a chain: one per run since the last rebuild."""
    rows = publications(spark, warehouse).where(F.col("chain") == chain)
    return [row.version for row in rows.select("version").collect()]


def _replaced(spark: SparkSession, curated: str) -> set[str]:
    return {row.batch for row in replaced_batches(spark, curated).collect()}
