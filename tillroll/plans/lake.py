"""The whole run: clean what is new, judge the curated table, rebuild the warehouse."""

import datetime
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.quality import (
    DEFAULT_RULES,
    QualityCheckFailed,
    Rule,
    enforce,
    run_checks,
)
from tillroll.operators.reports import customer_segments
from tillroll.operators.warehouse import customer_rfm, daily_revenue, top_products
from tillroll.plans.catalog import register_curated, table_path
from tillroll.plans.increments import update_warehouse
from tillroll.sinks.tables import write_table
from tillroll.sources.orders import read_curated
from tillroll.streaming.orders import run_incremental


@dataclass
class RunRecord:
    """Outcome of a run, one row of the run log."""

    started_at: datetime.datetime
    status: str = "RUNNING"
    message: str = ""
    files: int = 0
    raw_rows: int = 0
    clean_rows: int = 0
    tables: dict[str, int] = field(default_factory=dict)


RECORD_SCHEMA = (
    "started_at timestamp, status string, message string, files bigint, raw_rows bigint, "
    "clean_rows bigint, tables map<string,bigint>"
)


def build_warehouse(
    spark: SparkSession,
    curated: str,
    warehouse: str,
    reference_date: datetime.date | None = None,
) -> dict[str, int]:
    """Rebuild every warehouse table from the curated zone; rows per table.

    Each table is its own column-pruned scan. Scores are taken from the stored customer table.
    """
    orders = read_curated(spark, curated)

    def path(table: str) -> str:
        return table_path(warehouse, table)

    counts = {
        "daily_revenue": write_table(daily_revenue(orders), path("daily_revenue")),
        "customer_rfm": write_table(customer_rfm(orders, reference_date), path("customer_rfm")),
        "top_products": write_table(top_products(orders), path("top_products")),
    }
    segments = customer_segments(spark.read.parquet(path("customer_rfm")))
    counts["customer_segments"] = write_table(segments, path("customer_segments"))
    return counts


def gate(orders: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> dict:
    """Result of the quality rules; raises if one of them fails."""
    return enforce(run_checks(orders, rules))


def table_checks(
    spark: SparkSession, table: str, rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """The quality rules over a table by its catalog name, a row each."""
    return run_checks(spark.table(table), rules)


def run_lake(
    spark: SparkSession,
    raw: str,
    curated: str,
    warehouse: str,
    checkpoint: str,
    database: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    run_log: str | None = None,
    **increment_options,
) -> RunRecord:
    """Clean new files, gate, renew the warehouse, refresh names. A failure stops the run there.

    With `database` the new batches are taken into the next version of the warehouse, whose tables
    take the place of the old ones together; without, the tables are rebuilt in place.

    The gate reads the folder just written, and nothing is registered or rebuilt behind a failed
    gate. With `run_log`, the record of every run is appended to that folder, failed ones too.
    """
    record = RunRecord(datetime.datetime.now(datetime.timezone.utc))
    try:
        increment = run_incremental(spark, raw, curated, checkpoint, **increment_options)
        record.files, record.raw_rows, record.clean_rows = (
            increment.files,
            increment.raw_rows,
            increment.clean_rows,
        )
        gate(read_curated(spark, curated), rules)
        if database:
            register_curated(spark, database, curated)
            record.tables = update_warehouse(spark, curated, warehouse, database)
        else:
            record.tables = build_warehouse(spark, curated, warehouse)
        record.status, record.message = "PASSED", increment.message()
    except QualityCheckFailed as failure:
        record.status, record.message = "FAILED", str(failure)
        raise
    except Exception as failure:
        record.status, record.message = "FAILED", f"{type(failure).__name__}: {failure}"
        raise
    finally:
        if run_log:
            append_record(spark, record, run_log)
    return record


def append_record(spark: SparkSession, record: RunRecord, run_log: str) -> None:
    spark.createDataFrame([asdict(record)], RECORD_SCHEMA).write.mode("append").parquet(run_log)


def failed_runs(spark: SparkSession, run_log: str) -> DataFrame:
    """The notices: failed runs, newest first."""
    runs = spark.read.schema(RECORD_SCHEMA).parquet(run_log)
    return runs.where(F.col("status") == "FAILED").orderBy(F.desc("started_at"))
