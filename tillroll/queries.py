"""The registered queries: every operator over whole tables, as `(spark, sf_dir) -> DataFrame`."""

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import retail_shapes as shapes
from tillroll.operators import events, quality, reports, warehouse
from tillroll.operators.clean import backfill_optional, clean_orders
from tillroll.plans.catalog import CURATED_TABLE, table_path
from tillroll.plans.increments import published_path, update_warehouse
from tillroll.plans.jobs import side_by_side
from tillroll.plans.lake import run_lake, table_checks
from tillroll.schemas import CURATED_SCHEMA
from tillroll.sinks.compaction import drop_replaced
from tillroll.sinks.events import (
    compact_events,
    ingest_logged,
    read_dead_letters,
    read_ingest_log,
    read_rejected,
    read_streaming,
)
from tillroll.sinks.scratch import scratch_folder, stored
from tillroll.sinks.tables import stored_rows, write_csv, write_curated
from tillroll.sources.files import drop_over
from tillroll.sources.orders import compact_curated, read_curated, read_orders_csv, union_parts
from tillroll.streaming.events import run_event_ingest
from tillroll.streaming.orders import run_incremental

# Rules fitted to the derived data, and stricter ones it cannot meet.
YEARS = tuple(str(year) for year in range(1995, 2002))
FITTED_RULES = (
    quality.MinRows(1_000),
    quality.MaxNullRate(),
    quality.MinTotal(),
    quality.YearsPresent(YEARS),
)
UNMET_RULES = (
    quality.MinRows(10**15),
    quality.MaxNullRate(("invoice", "loyalty_tier")),
    quality.MinTotal(minimum=1e18),
    quality.YearsPresent((*YEARS, "2002", "2003")),
)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(shapes.raw_orders(spark, sf_dir))


def _generations(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [shapes.old_generation(spark, sf_dir), shapes.new_generation(spark, sf_dir)]


def _raw_files(spark: SparkSession, sf_dir: str, folder: str | None = None) -> str:
    """Both generations below one folder, one as plain files and one compressed."""
    folder = folder or scratch_folder(spark)
    old, new = _generations(spark, sf_dir)
    side_by_side(
        spark,
        partial(write_csv, old, f"{folder}/old"),
        partial(write_csv, new, f"{folder}/new", compression="gzip"),
    )
    return folder


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_orders_csv(spark, _raw_files(spark, sf_dir), multiline=True)


def curated_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = scratch_folder(spark)
    write_curated(_clean(spark, sf_dir), curated, "first")
    return read_curated(spark, curated)


def passed_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw column the schema does not declare, read back from the curated table."""
    raw = shapes.raw_orders(spark, sf_dir).withColumn("store", F.col("Country"))
    curated = scratch_folder(spark)
    write_curated(clean_orders(raw), curated, "first")
    return read_curated(spark, curated).select("Invoice", "StockCode", "store")


def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the incremental stream, read back curated.

    The first finds only lines that cleaning drops, the second both generations, the third nothing.
    """
    folder = scratch_folder(spark)
    raw, curated = f"{folder}/raw", f"{folder}/curated"
    dropped = shapes.raw_orders(spark, sf_dir).where(F.col("Invoice").startswith("C"))
    write_csv(dropped, f"{raw}/dropped")
    for _ in range(2):
        run_incremental(spark, raw, curated, f"{folder}/checkpoint", multiline=True)
        if not stored_rows(spark, curated, CURATED_SCHEMA):
            _raw_files(spark, sf_dir, raw)
    run_incremental(spark, raw, curated, f"{folder}/checkpoint", multiline=True)
    return read_curated(spark, curated)


def archived_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations cleaned one after the other, their files archived, and all cleaned anew from there."""
    folder = scratch_folder(spark)
    raw, archive = f"{folder}/raw", f"{folder}/archive"
    for name, part in zip(("old", "new"), _generations(spark, sf_dir)):
        write_csv(part, f"{raw}/{name}")
        run_incremental(
            spark, raw, f"{folder}/curated", f"{folder}/checkpoint", multiline=True, archive=archive
        )
    run_incremental(spark, archive, f"{folder}/anew", f"{folder}/checkpoint_anew", multiline=True)
    return read_curated(spark, f"{folder}/anew")


def _lake(spark: SparkSession, sf_dir: str, database: str | None = None) -> str:
    """New files cleaned, judged and rolled up; the folder of the warehouse."""
    folder, raw = scratch_folder(spark), _raw_files(spark, sf_dir)
    run_lake(
        spark,
        raw,
        f"{folder}/curated",
        f"{folder}/warehouse",
        f"{folder}/checkpoint",
        database=database,
        rules=FITTED_RULES,
        multiline=True,
    )
    return f"{folder}/warehouse"


def gated_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend read from a rebuilt warehouse."""
    daily = spark.read.parquet(table_path(_lake(spark, sf_dir), "daily_revenue"))
    return reports.revenue_trend(daily)


def catalog_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a table by name and every view, as (report, name, value)."""
    database = f"shop_{uuid.uuid4().hex}"
    _lake(spark, sf_dir, database)
    month = F.concat_ws("-", *(F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("year", "month")))

    def rows(report: str, frame: DataFrame, name: Column, value: Column) -> DataFrame:
        return frame.select(
            F.lit(report).alias("report"), name.alias("name"), value.cast("double").alias("value")
        )

    checks = table_checks(spark, f"{database}.{CURATED_TABLE}", FITTED_RULES[:1])
    segments = spark.table(f"{database}.v_customer_segments").groupBy("segment").count()
    return union_parts(
        [
            rows("gate", checks, F.col("check"), F.col("observed")),
            rows("monthly", spark.table(f"{database}.v_monthly_revenue"), month, F.col("num_customers")),
            rows("trend", spark.table(f"{database}.v_revenue_trend"), month, F.col("num_customers")),
            rows("segments", segments, F.col("segment"), F.col("count")),
            rows(
                "products",
                spark.table(f"{database}.v_top_products"),
                F.col("stockcode"),
                F.col("revenue_rank"),
            ),
        ]
    )


def _dealt(spark: SparkSession, sf_dir: str, parts: int) -> list[DataFrame]:
    """All order lines, dealt so that invoices, customers, products and days fall apart."""
    lines = stored(_clean(spark, sf_dir).withColumn("_part", F.pmod(F.xxhash64("Invoice", "StockCode"), F.lit(parts))))
    return [lines.where(F.col("_part") == part).drop("_part") for part in range(parts)]


def incremental_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three increments, the batches of the first two compacted before the last: all four tables."""
    folder = scratch_folder(spark)
    curated, target = f"{folder}/curated", f"{folder}/warehouse"
    for number, lines in enumerate(_dealt(spark, sf_dir, 3)):
        if number == 2:
            compact_curated(spark, curated, min_batches=2)
        write_curated(lines, curated, f"part-{number}")
        update_warehouse(spark, curated, target)

    def rows(table: str, key: str, *values: str) -> DataFrame:
        found = spark.read.parquet(published_path(spark, target, table))
        numbered = (F.col(name).cast("double").alias(f"value_{n}") for n, name in enumerate(values))
        name = F.coalesce(F.col(key).cast("string"), F.lit("none")).alias("name")
        return found.select(F.lit(table).alias("report"), name, *numbered)

    return union_parts(
        [
            rows("daily_revenue", "order_date", "total_revenue", "num_orders", "num_customers", "total_units"),
            rows("customer_rfm", "CustomerID", "recency_days", "frequency", "monetary"),
            rows("top_products", "StockCode", "total_revenue", "num_orders", "total_units"),
            rows("customer_segments", "customerid", "r_score", "f_score", "m_score"),
        ]
    )


def product_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of an incrementally kept product table."""
    folder = scratch_folder(spark)
    for number, lines in enumerate(_dealt(spark, sf_dir, 2)):
        write_curated(lines, f"{folder}/curated", f"part-{number}")
        update_warehouse(spark, f"{folder}/curated", f"{folder}/warehouse")
    return spark.read.parquet(published_path(spark, f"{folder}/warehouse", "top_products"))


def compacted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of eight batches, read back from one."""
    curated = scratch_folder(spark)
    for number, lines in enumerate(_dealt(spark, sf_dir, 8)):
        write_curated(lines, curated, f"part-{number}", rebalance=False)
    compact_curated(spark, curated)
    drop_replaced(spark, curated)
    return read_curated(spark, curated)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


def backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_optional(shapes.raw_orders(spark, sf_dir))


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each generation cleaned by itself, both in one table."""
    return union_parts(clean_orders(part) for part in _generations(spark, sf_dir))


def parts_in_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_parts(_generations(spark, sf_dir))


def loyalty_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.loyalty_tier_counts(schema_evolution(spark, sf_dir))


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the day as text: engines hand a missing date over in different ways."""
    daily = warehouse.daily_revenue(_clean(spark, sf_dir))
    return daily.withColumn("order_date", F.col("order_date").cast("string"))


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.monthly_revenue(_clean(spark, sf_dir))


def customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.customer_rfm(_clean(spark, sf_dir))


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.top_products(_clean(spark, sf_dir))


def revenue_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_trend(warehouse.daily_revenue(_clean(spark, sf_dir), ordered=False))


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_segments(stored(customer_rfm(spark, sf_dir)))


def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_summary(customer_segments(spark, sf_dir))


def top_products_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products_ranked(top_products(spark, sf_dir))


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(_clean(spark, sf_dir), FITTED_RULES)


def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(schema_evolution(spark, sf_dir), UNMET_RULES)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_lines(shapes.padded_lines(shapes.order_events(spark, sf_dir)))


def event_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.validate_events(event_lines(spark, sf_dir))


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.valid_events(event_validation(spark, sf_dir))


def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.rejected_events(event_validation(spark, sf_dir))


def event_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = shapes.mixed_source(shapes.order_events(spark, sf_dir))
    return events.file_stats(events.validate_events(mixed))


def dead_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = shapes.order_events(spark, sf_dir).withColumn(
        "source", F.concat(F.lit("orders_"), F.col("source"), F.lit(".json"))
    )
    return events.dead_files(events.file_stats(events.validate_events(named)))


def event_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files through the stream; accepted and rejected lines read back from their zones."""
    folder = scratch_folder(spark)
    lines = shapes.padded_lines(shapes.order_events(spark, sf_dir))
    lines.select("line").write.text(f"{folder}/incoming")
    out = f"{folder}/events"
    run_event_ingest(
        spark, f"{folder}/incoming", out, f"{folder}/checkpoint", pattern="part-*.txt"
    )
    accepted = read_streaming(spark, out).select(
        F.col("value").alias("line"), F.lit(None).cast("string").alias("reason")
    )
    return accepted.unionByName(read_rejected(spark, out).select("line", "reason"))


def event_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, bad and empty files through the stream, all ingested again, and what is then read."""
    folder = scratch_folder(spark)
    incoming, out = f"{folder}/incoming", f"{folder}/events"
    lines = shapes.padded_lines(shapes.order_events(spark, sf_dir))
    good = F.col("event_id") % 10 >= 6
    for name, part in (("good", good), ("bad", ~good)):
        lines.where(part).select("line").write.text(f"{incoming}/{name}")
    lines.where("false").select("line").coalesce(1).write.text(f"{incoming}/empty")
    run_event_ingest(spark, incoming, out, f"{folder}/checkpoint", pattern="part-*.txt")
    ingest_logged(spark, read_ingest_log(spark, out), out)
    accepted = read_streaming(spark, out).select(
        F.lit("accepted").alias("outcome"), F.col("value").alias("line"), F.lit(None).cast("string").alias("reason")
    )
    rejected = read_rejected(spark, out).select(F.lit("rejected").alias("outcome"), "line", "reason")
    dead = (
        read_dead_letters(spark, out)
        .groupBy(F.col("error_type").alias("line"))
        .agg(F.sum("n_lines").cast("string").alias("reason"))
        .select(F.lit("dead").alias("outcome"), "line", "reason")
    )
    return union_parts([accepted, rejected, dead])


def event_redrop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the rejected lines, then files with all lines dropped over them."""
    folder = scratch_folder(spark)
    incoming, out = f"{folder}/incoming", f"{folder}/events"
    lines = shapes.padded_lines(shapes.order_events(spark, sf_dir)).withColumn("part", F.col("event_id") % 8)
    for number, rows in enumerate((lines.where("event_id % 10 < 6"), lines)):
        target = f"{folder}/next" if number else incoming
        rows.repartition(8, "part").select("line").write.text(target)
        if number:
            drop_over(spark, target, incoming)
        run_event_ingest(spark, incoming, out, f"{folder}/checkpoint", pattern="part-*.txt")
    accepted = read_streaming(spark, out).select(
        F.col("value").alias("line"), F.lit(None).cast("string").alias("reason")
    )
    return accepted.unionByName(read_rejected(spark, out).select("line", "reason"))


def event_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files in many batches, a third of them ingested again, then one batch a month."""
    folder = scratch_folder(spark)
    incoming, out = f"{folder}/incoming", f"{folder}/events"
    lines = shapes.padded_lines(shapes.order_events(spark, sf_dir))
    lines.select("line").repartition(12, "line").write.text(incoming)
    run_event_ingest(spark, incoming, out, f"{folder}/checkpoint", pattern="part-*.txt", max_files=4)
    again = read_ingest_log(spark, out).where(F.xxhash64("path") % 3 == 0)
    ingest_logged(spark, again, out)
    compact_events(spark, out, min_batches=2)
    accepted = read_streaming(spark, out).select(
        F.col("value").alias("line"), F.lit(None).cast("string").alias("reason")
    )
    return accepted.unionByName(read_rejected(spark, out).select("line", "reason"))


def notification_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.notification_files(shapes.notifications(spark, sf_dir))


def dead_letter_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.dead_letter_triage(shapes.dead_letter_messages(spark, sf_dir))


QUERIES = {
    "raw_scan": raw_scan,
    "curated_scan": curated_scan,
    "passed_through": passed_through,
    "incremental_clean": incremental_clean,
    "archived_replay": archived_replay,
    "clean_orders": clean,
    "backfill_optional": backfilled,
    "schema_evolution": schema_evolution,
    "union_parts": parts_in_one,
    "loyalty_tier_counts": loyalty_tier_counts,
    "daily_revenue": daily_revenue,
    "customer_rfm": customer_rfm,
    "top_products": top_products,
    "monthly_revenue": monthly_revenue,
    "revenue_trend": revenue_trend,
    "customer_segments": customer_segments,
    "segment_summary": segment_summary,
    "top_products_ranked": top_products_ranked,
    "quality_checks": quality_checks,
    "quality_failures": quality_failures,
    "gated_build": gated_build,
    "catalog_reports": catalog_reports,
    "incremental_warehouse": incremental_warehouse,
    "incremental_products": product_texts,
    "compacted_scan": compacted_scan,
    "event_lines": event_lines,
    "event_validation": event_validation,
    "valid_events": valid_events,
    "rejected_events": rejected_events,
    "event_file_stats": event_file_stats,
    "dead_files": dead_files,
    "event_ingest": event_ingest,
    "event_replay": event_replay,
    "event_redrop": event_redrop,
    "event_compaction": event_compaction,
    "notification_keys": notification_keys,
    "dead_letter_triage": dead_letter_triage,
}
