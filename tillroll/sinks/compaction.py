"""Compaction of the curated table: one batch in place of many.

A compaction rewrites the months that hold many batches under a batch of its own, named by what it
replaces, and then writes the log that says so. Readers leave out logged batches of those months, and
compacted ones that no log names: before the log they see the many, behind it the one, and a crash in
between changes nothing but files that the next try replaces. The log's folder is made first; without
it, nothing is left out. Conditions are on partition columns, so
files left out are not opened. `drop_replaced` deletes them once no reader is left that began before.
"""

import hashlib

from py4j.java_gateway import java_import
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import COMPACTION_LOG, CURATED_PARTITIONS
from tillroll.sources.files import exists, is_missing

COMPACTED = "compact-"
LOG_SCHEMA = "year int, month int, replaced string, ingest_batch string"


def compaction_log(spark: SparkSession, curated: str) -> DataFrame:
    """(year, month, replaced batch, batch in its place) of all compactions."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{curated.rstrip('/')}/{COMPACTION_LOG}")
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], LOG_SCHEMA)
        raise


def replaced_batches(spark: SparkSession, curated: str) -> DataFrame:
    """Names (`batch`) of the batches that raw files were cleaned into and compaction replaced."""
    names = compaction_log(spark, curated).select(F.col("replaced").alias("batch")).distinct()
    return names.where(~F.startswith("batch", F.lit(COMPACTED)))


def _place(year: Column, month: Column, batch: Column) -> Column:
    """A month's batch as one text; lines without a date have no year."""
    return F.concat_ws(
        "/", F.coalesce(year.cast("string"), F.lit("-")), F.coalesce(month.cast("string"), F.lit("-")), batch
    )


def live(spark: SparkSession, curated: str) -> Column | None:
    """Condition on the partition columns for what readers see; None before the first compaction.

    The driver holds a text for every month and batch that was replaced and whose log is kept.
    """
    if not exists(spark, f"{curated.rstrip('/')}/{COMPACTION_LOG}"):
        return None
    log = compaction_log(spark, curated)
    gone = log.select(_place(F.col("year"), F.col("month"), F.col("replaced")).alias("place"))
    places = [row.place for row in gone.distinct().collect()]
    made = [row.ingest_batch for row in log.select("ingest_batch").distinct().collect()]
    own = _place(F.col("year"), F.col("month"), F.col("ingest_batch"))
    # One that is not logged may be under way.
    known = ~F.coalesce(F.startswith("ingest_batch", F.lit(COMPACTED)), F.lit(False))
    return (known | F.col("ingest_batch").isin(made)) & ~own.isin(places)


def compact(
    spark: SparkSession, curated: str, rows: DataFrame, min_batches: int = 8
) -> str | None:
    """Write one batch in place of those of every month that holds at least `min_batches`.

    `rows` are the live rows with all columns. Returns the new batch's name, None if no month is due.
    Run again after a crash it replaces what it wrote. One compaction at a time.
    """
    held = rows.select("year", "month", F.col("ingest_batch").alias("replaced")).distinct()
    months = held.groupBy(F.col("year").alias("due_year"), F.col("month").alias("due_month"))
    due = months.count().where(F.col("count") >= min_batches).drop("count")
    same = F.col("year").eqNullSafe(F.col("due_year")) & F.col("month").eqNullSafe(F.col("due_month"))
    # A row for each month and batch, read off partition values.
    log = sorted(
        (tuple(row) for row in held.join(due, same).select("year", "month", "replaced").collect()),
        key=str,
    )
    if not log:
        return None
    _write_log(spark, [], curated)
    name = COMPACTED + hashlib.md5("\n".join(map(str, log)).encode()).hexdigest()
    place = _place(F.col("year"), F.col("month"), F.col("ingest_batch"))
    chosen = rows.where(place.isin(["/".join("-" if v is None else str(v) for v in row) for row in log]))
    (
        chosen.withColumn("ingest_batch", F.lit(name))
        .hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*CURATED_PARTITIONS)
        .parquet(curated)
    )
    _write_log(spark, [(*row, name) for row in log], curated)
    return name


def _write_log(spark: SparkSession, rows: list[tuple], curated: str) -> None:
    """Rows of one compaction, in one file; none make the folder."""
    (
        spark.createDataFrame(rows, LOG_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_batch")
        .parquet(f"{curated.rstrip('/')}/{COMPACTION_LOG}")
    )


def drop_replaced(spark: SparkSession, curated: str) -> int:
    """Delete the files of replaced batches; returns the folders deleted. Their log stays."""
    jvm = spark._jvm
    java_import(jvm, "org.apache.hadoop.fs.Path")
    default, dropped = "__HIVE_DEFAULT_PARTITION__", 0
    for row in compaction_log(spark, curated).select("year", "month", "replaced").distinct().collect():
        year, month = (default if value is None else value for value in row[:2])
        folder = jvm.Path(f"{curated.rstrip('/')}/year={year}/month={month}/ingest_batch={row.replaced}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        dropped += bool(files.exists(folder) and files.delete(folder, True))
    return dropped
