"""Names for the stored tables, and the views reports are read from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.operators.reports import TREND, revenue_trend, top_products_ranked
from tillroll.operators.warehouse import MEASURES, MONTHLY, monthly_revenue
from tillroll.schemas import CURATED_PARTITIONS, CURATED_SCHEMA
from tillroll.sinks.compaction import live
from tillroll.sinks.events import (
    ACCEPTED,
    BATCHES_SCHEMA,
    LINES_SCHEMA,
    LOG_SCHEMA,
    SUPERSEDED_SCHEMA,
)
from tillroll.sources.orders import extra_columns

CURATED_TABLE = "online_retail"
EVENTS_VIEW = "streaming"
EVENT_LINES_TABLE = "event_lines"
EVENT_LOG_TABLE = "event_ingest_log"
EVENT_BATCHES_TABLE = "event_batches"
EVENT_SUPERSEDED_TABLE = "event_superseded"
WAREHOUSE_TABLES = ("daily_revenue", "customer_rfm", "top_products", "customer_segments")


def _columns(definitions: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in definitions.items())


CURATED_VIEWS = {
    "v_monthly_revenue": f"""
        SELECT year, month, {_columns({name: MEASURES[m] for name, m in MONTHLY.items()})}
        FROM {{database}}.{CURATED_TABLE} GROUP BY year, month ORDER BY year, month""",
}

VIEWS = {
    "v_revenue_trend": f"""
        SELECT {_columns(TREND)} FROM {{database}}.daily_revenue
        GROUP BY {TREND["year"]}, {TREND["month"]} ORDER BY year, month""",
    # Scored when the warehouse is built, because quartiles over the whole table are found there
    # without sorting it; the view reads the finished rows.
    "v_customer_segments": "SELECT * FROM {database}.customer_segments",
    # Rank after the limit: same numbers, and only the limited rows are ranked.
    "v_top_products": """
        SELECT *, rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank
        FROM (SELECT StockCode AS stockcode, description, total_revenue, total_units, num_orders
              FROM {database}.top_products
              ORDER BY total_revenue DESC NULLS LAST, StockCode LIMIT 50)
        ORDER BY total_revenue DESC NULLS LAST, stockcode""",
}

EVENT_VIEWS = {
    EVENTS_VIEW: f"""
        SELECT line AS value, year, month, source
        FROM {{database}}.{EVENT_LINES_TABLE} AS lines
        LEFT SEMI JOIN (
            SELECT ingest_batch AS counted FROM {{database}}.{EVENT_BATCHES_TABLE} LEFT ANTI JOIN (
                SELECT explode(replaces) AS gone FROM {{database}}.{EVENT_BATCHES_TABLE})
              ON ingest_batch = gone)
          ON lines.ingest_batch = counted
        LEFT ANTI JOIN (
            SELECT path AS gone_path, loser FROM {{database}}.{EVENT_SUPERSEDED_TABLE} LEFT SEMI JOIN (
                SELECT ingest_batch AS known FROM {{database}}.{EVENT_BATCHES_TABLE})
              ON winner = known)
          ON lines.path = gone_path AND coalesce(lines.origin, lines.ingest_batch) = loser
        WHERE outcome = '{ACCEPTED}'""",
}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _register(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partitions=()
) -> None:
    """Create the table, or add the columns it lacks, and find its partitions."""
    clause = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet {clause} LOCATION '{path}'"
    )
    known = {column.lower() for column in spark.table(name).columns}
    new = T.StructType([f for f in schema.fields if f.name.lower() not in known])
    if new.fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    if partitions:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _create_views(spark: SparkSession, database: str, views: dict[str, str]) -> None:
    for name, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query.format(database=database)}")


def _parsed(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def register_curated(spark: SparkSession, database: str, curated: str) -> None:
    """Register or refresh the curated table with the partitions found in its folder.

    Partitions that compaction replaced are no part of the table; their files stay.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    schema = T.StructType(
        [
            *CURATED_SCHEMA.fields,
            *extra_columns(spark, curated),
            T.StructField("ingest_batch", T.StringType()),
        ]
    )
    table = f"{database}.{CURATED_TABLE}"
    _register(spark, table, schema, curated, CURATED_PARTITIONS)
    if (seen := live(spark, curated)) is not None:
        hidden = spark.table(table).where(~seen).select(*CURATED_PARTITIONS).distinct()
        for part in hidden.collect():
            values = ((n, "null" if part[n] is None else repr(part[n])) for n in CURATED_PARTITIONS)
            named = ", ".join(f"{name}={value}" for name, value in values)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({named})")
    _create_views(spark, database, CURATED_VIEWS)


def register_events(spark: SparkSession, database: str, out: str) -> None:
    """Register or refresh the event zones and the view of accepted events, a JSON line per row."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = (
        (EVENT_LINES_TABLE, LINES_SCHEMA, "lines", ("outcome", "year", "month", "ingest_batch")),
        (EVENT_LOG_TABLE, LOG_SCHEMA, "ingest_log", ("ingest_date", "ingest_batch")),
        (EVENT_BATCHES_TABLE, BATCHES_SCHEMA, "batches", ("ingest_batch",)),
        (EVENT_SUPERSEDED_TABLE, SUPERSEDED_SCHEMA, "superseded", ("ingest_batch",)),
    )
    for name, schema, folder, partitions in tables:
        _register(spark, f"{database}.{name}", _parsed(schema), f"{out}/{folder}", partitions)
    _create_views(spark, database, EVENT_VIEWS)


def register_warehouse(spark: SparkSession, database: str, warehouse: str) -> None:
    """Register or refresh the warehouse tables and create or replace the views on them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in WAREHOUSE_TABLES:
        path = table_path(warehouse, table)
        _register(spark, f"{database}.{table}", spark.read.parquet(path).schema, path)
    _create_views(spark, database, VIEWS)


def move_warehouse(spark: SparkSession, database: str, warehouse: str) -> None:
    """Point the registered tables to another folder that holds all of them, and refresh the views."""
    register_warehouse(spark, database, warehouse)
    for table in WAREHOUSE_TABLES:
        path = table_path(warehouse, table)
        spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(f"{database}.{table}")


def temporary_views(
    daily: DataFrame, segments: DataFrame, products: DataFrame, orders: DataFrame | None = None
) -> None:
    """The same views for one session, over frames that need no catalog."""
    revenue_trend(daily).createOrReplaceTempView("v_revenue_trend")
    segments.createOrReplaceTempView("v_customer_segments")
    top_products_ranked(products).createOrReplaceTempView("v_top_products")
    if orders is not None:
        monthly_revenue(orders).createOrReplaceTempView("v_monthly_revenue")


def table_path(warehouse: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{table}"
