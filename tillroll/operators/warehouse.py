"""Warehouse tables over the curated order lines.

The distinct counts are left to Spark, which removes duplicates on a shuffle key that contains the
counted column and combines before it: a day, product or customer that holds much of the data is
spread over all tasks. Summing lines per invoice first was measured and not kept; it gains a tenth
when the lines of an invoice lie together in a file and loses half when they do not.
"""

import datetime

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

# What the tables measure, one definition each.
MEASURES = {
    "revenue": "round(sum(Revenue), 2)",
    "orders": "count(DISTINCT Invoice)",
    "customers": "count(DISTINCT CustomerID)",
    "units": "sum(Quantity)",
}


def measured(groups: GroupedData, *others: Column, **names: str) -> DataFrame:
    """Aggregate groups to `others` and then the measures, given as column name = measure."""
    return groups.agg(
        *others, *(F.expr(MEASURES[measure]).alias(name) for name, measure in names.items())
    )


def daily_revenue(orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue, orders, customers and units per calendar day, in date order.

    Spark keeps a sort below an aggregate of doubles, so leave `ordered` out for further aggregates.
    """
    days = orders.groupBy(F.to_date("InvoiceDate").alias("order_date"))
    daily = measured(
        days,
        total_revenue="revenue",
        num_orders="orders",
        num_customers="customers",
        total_units="units",
    )
    return daily.orderBy("order_date") if ordered else daily


# The monthly report, for the frame and the view.
MONTHLY = {"total_revenue": "revenue", "num_orders": "orders", "num_customers": "customers"}


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """Revenue and distinct orders and customers per month, straight from the order lines."""
    return measured(orders.groupBy("year", "month"), **MONTHLY).orderBy("year", "month")


def customer_rfm(
    orders: DataFrame, reference_date: datetime.date | Column | None = None
) -> DataFrame:
    """Recency, frequency and monetary value per customer.

    Without a reference date the newest order date of the whole frame is used, as a scalar
    subquery over that one column; nothing is fetched by the driver.
    """
    if reference_date is None:
        reference_date = orders.select(F.max("InvoiceDate")).scalar()
    elif not isinstance(reference_date, Column):
        reference_date = F.lit(reference_date)
    recency = F.date_diff(reference_date, F.max("InvoiceDate")).alias("recency_days")
    return measured(
        orders.groupBy("CustomerID"), recency, frequency="orders", monetary="revenue"
    )


def product_descriptions(orders: DataFrame) -> DataFrame:
    """One description per product: the earliest that is not NULL, then the smallest text.

    The first aggregate keeps text in the grouping key and a timestamp in the buffer, so it is a
    hash aggregate with a strong map-side combine; `min_by` runs on what is left of it.
    """
    seen = (
        orders.where(F.col("Description").isNotNull())
        .groupBy("StockCode", "Description")
        .agg(F.min("InvoiceDate").alias("first_seen"))
    )
    earliest = F.struct(F.col("first_seen").isNull(), "first_seen", "Description")
    return seen.groupBy("StockCode").agg(F.min_by("Description", earliest).alias("description"))


def top_products(orders: DataFrame) -> DataFrame:
    """Description, revenue, units and orders per product, highest revenue first.

    Totals and descriptions read different columns, so two pruned scans cost about one; keeping
    text out of the totals keeps them a hash aggregate and their shuffle narrow.
    """
    totals = measured(
        orders.groupBy("StockCode"),
        total_revenue="revenue",
        total_units="units",
        num_orders="orders",
    )
    described = product_descriptions(orders).withColumnRenamed("StockCode", "described_code")
    return (
        totals.join(described, F.col("StockCode").eqNullSafe(F.col("described_code")), "left")
        .select("StockCode", "description", "total_revenue", "total_units", "num_orders")
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("StockCode"))
    )
