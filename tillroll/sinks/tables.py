"""Writing curated order lines and warehouse tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import CURATED_PARTITIONS, CURATED_SCHEMA, NOTED_COLUMNS
from tillroll.sources.files import is_missing

# Parts a month is dealt to when a batch is written; adaptive execution splits a large one further.
MONTH_PARTS = 4


def write_curated(clean: DataFrame, path: str, batch: str, rebalance: bool = True) -> None:
    """Add one batch to the curated table, Parquet by year, month and batch.

    A batch written again replaces its own files and no others, so a rerun after a crash adds
    nothing twice. With `rebalance` the rows are shuffled by month and a salt: a month that holds
    much of the data is spread over many tasks, and adaptive execution joins small parts to files of
    the advisory size. Raw files already in date order can go without that shuffle.
    """
    rows = clean.withColumn("ingest_batch", F.lit(batch))
    if rebalance:
        salt = F.pmod(F.xxhash64("Invoice", "StockCode"), F.lit(MONTH_PARTS))
        rows = rows.withColumn("_salt", salt).hint("rebalance", "year", "month", "_salt")
        rows = rows.drop("_salt")
    _note_columns(clean, path, batch)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*CURATED_PARTITIONS)
        .parquet(path)
    )


def _note_columns(clean: DataFrame, path: str, batch: str) -> None:
    """Note the columns of a batch that the curated schema does not declare, once per batch."""
    declared = {name.lower() for name in CURATED_SCHEMA.names}
    extra = [f for f in clean.schema.fields if f.name.lower() not in declared]
    if not extra:
        return
    rows = [(f.name, f.dataType.simpleString(), batch) for f in extra]
    (
        clean.sparkSession.createDataFrame(rows, "name string, kind string, ingest_batch string")
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_batch")
        .parquet(f"{path.rstrip('/')}/{NOTED_COLUMNS}")
    )


def stored_rows(spark: SparkSession, path: str, schema: T.StructType, where: str = "true") -> int:
    """Rows a Parquet table holds, from its footers; none if nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path).where(where).count()
    except AnalysisException as error:
        if is_missing(error):
            return 0
        raise


def write_table(df: DataFrame, path: str) -> int:
    """Replace a table and return the number of rows stored."""
    df.write.mode("overwrite").parquet(path)
    return stored_rows(df.sparkSession, path, df.schema)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Text export with a header and no index column; quotes are doubled.

    Fields with line breaks are quoted; read them back with `multiline`.
    """
    df.write.option("header", True).option("escape", '"').csv(path, compression=compression)
