"""Reports over the warehouse tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import Order, ntile, top_ranked

RFM_SCORES = {
    "r_score": Order("recency_days"),
    "f_score": Order("frequency", ascending=False),
    "m_score": Order("monetary", ascending=False),
}


# Monthly sums of the daily facts, whole cents; one definition for the frame and the view.
TREND = {
    "year": "year(order_date)",
    "month": "month(order_date)",
    "total_revenue": "round(sum(total_revenue), 2)",
    "num_orders": "sum(num_orders)",
    "num_customers": "sum(num_customers)",
    "total_units": "sum(total_units)",
}


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Monthly sums of the daily facts.

    Customers and orders are sums of daily distinct counts here, so a customer who buys on five
    days counts five times; the monthly report over order lines counts them once.
    """
    columns = {name: F.expr(text).alias(name) for name, text in TREND.items()}
    keys = [columns.pop("year"), columns.pop("month")]
    return daily.groupBy(*keys).agg(*columns.values()).orderBy("year", "month")


def segment_label(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple, first match wins; 1 is the best quartile."""
    return (
        F.when((r == 1) & (f == 1) & (m == 1), "Champions")
        .when((r <= 2) & (f <= 2), "Loyal")
        .when((r == 1) & (f >= 3), "New Customers")
        .when((r == 4) & (f == 4), "Lost")
        .when((r >= 3) & (m <= 2), "At Risk")
        .otherwise("Other")
    )


def customer_segments(rfm: DataFrame) -> DataFrame:
    """Quartile scores and segment per customer; ties go to the smaller customer number first.

    `rfm` is read a few times, so pass a stored table.
    """
    scored = ntile(rfm, "CustomerID", RFM_SCORES)
    return scored.select(
        F.col("CustomerID").alias("customerid"),
        "recency_days",
        "frequency",
        "monetary",
        *RFM_SCORES,
        segment_label(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("segment"),
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and average spend per segment, averaged over whole cents and rounded half up."""
    cents = F.round(F.col("monetary") * 100).cast("decimal(28,0)")
    totals = segments.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.sum(cents).alias("cents"),
        F.nullif(F.count("monetary"), F.lit(0)).alias("n"),
    )
    average_cents = F.expr("(2 * cents + n) div (2 * n)")
    return totals.select(
        "segment", "customers", (average_cents / 100).cast("double").alias("average_spend")
    ).orderBy("segment")


def top_products_ranked(products: DataFrame, limit: int = 50) -> DataFrame:
    """The products with the highest revenue and their rank."""
    named = products.select(
        F.col("StockCode").alias("stockcode"),
        "description",
        "total_revenue",
        "total_units",
        "num_orders",
    )
    return top_ranked(
        named, Order("total_revenue", ascending=False), "stockcode", limit, "revenue_rank"
    )


def loyalty_tier_counts(orders: DataFrame) -> DataFrame:
    """Order lines per loyalty tier; lines from files without the column count as legacy."""
    return orders.groupBy(F.coalesce("loyalty_tier", F.lit("(legacy)")).alias("loyalty_tier")).agg(
        F.count("*").alias("num_rows")
    )
