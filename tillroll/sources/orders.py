"""Reading raw order files, curated order lines and parts of a data set."""

import csv
import datetime
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import CURATED_SCHEMA, NOTED_COLUMNS, RAW_COLUMNS
from tillroll.sinks.compaction import compact, live
from tillroll.sources.files import exists, header_lines, literal_path


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of all parts by column name; a column a part lacks is NULL, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def header_columns(line: str | None) -> tuple[str, ...]:
    """Column names of a header line; a file without one holds no rows either."""
    return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")]), ())) or RAW_COLUMNS


def read_orders_csv(
    spark: SparkSession, paths: str | Iterable[str], multiline: bool = False
) -> DataFrame:
    """Raw order lines as text columns, bound to each file's own header.

    A string names a folder, all files below which are read, whatever their names; a list names
    files. Compression goes by suffix. Spark binds the columns of a CSV by position, so the headers
    are found first, from the first line of each file. Files with one header, the usual case, are then
    read as they are; otherwise one scan reads cells by position and every file's rows are put in order
    by its header.

    `multiline` reads quoted fields with line breaks, at the price of a task per file. A header is a
    single line in any case.
    """
    if not isinstance(paths, str):
        paths = [literal_path(path) for path in paths]
    if not paths:
        return spark.createDataFrame([], _text_schema(RAW_COLUMNS))
    headers = header_lines(spark, paths)
    lines = [row.header for row in headers.groupBy("header").count().orderBy("header").collect()]
    names = sorted({header_columns(line) for line in lines}, key=lambda h: (len(h), h))
    if not names:
        return spark.createDataFrame([], _text_schema(RAW_COLUMNS))

    def scanned(columns: Iterable[str]) -> DataFrame:
        return (
            spark.read.schema(_text_schema(columns))
            .option("header", True)
            .option("escape", '"')
            .option("multiLine", multiline)
            .option("recursiveFileLookup", True)
            .csv(paths)
        )

    if len(names) == 1:
        return scanned(names[0])
    cells = scanned(f"cell_{n}" for n in range(max(map(len, names))))
    cells = cells.select("*", F.col("_metadata.file_path").alias("file"))
    kind = F.lit(None).cast("int")
    for line in lines:
        kind = F.when(F.col("header") == line, names.index(header_columns(line))).otherwise(kind)
    placed = cells.join(headers.select("file", kind.alias("kind")), "file")

    def cell(name: str) -> Column:
        found = F.lit(None).cast("string")
        for number, header in enumerate(names):
            if name in header:
                own = F.col(f"cell_{header.index(name)}")
                found = F.when(F.col("kind") == number, own).otherwise(found)
        return found.alias(name)

    return placed.select(*(cell(name) for name in dict.fromkeys(n for h in names for n in h)))


def _text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def extra_columns(spark: SparkSession, path: str) -> list[T.StructField]:
    """Columns that raw files brought along and some batch of a curated table holds."""
    noted = f"{path.rstrip('/')}/{NOTED_COLUMNS}"
    if not exists(spark, noted):
        return []
    rows = spark.read.schema("name string, kind string").parquet(noted)
    known = rows.groupBy("name").agg(F.min("kind").alias("kind")).orderBy("name").collect()
    return [T.StructField(row.name, T._parse_datatype_string(row.kind)) for row in known]


def stored_orders(spark: SparkSession, path: str) -> DataFrame:
    """Curated order lines with the batch they lie in, without what compaction replaced.

    The schema is declared, the extra part noted by the writer, which spares a scan of all footers
    and gives NULL for columns that older files lack.
    """
    own = [*CURATED_SCHEMA.fields, *extra_columns(spark, path)]
    schema = T.StructType([*own, T.StructField("ingest_batch", T.StringType())])
    rows = spark.read.schema(schema).parquet(path).select(schema.names)
    seen = live(spark, path)
    return rows if seen is None else rows.where(seen)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated order lines: the declared columns, then those that raw files brought along."""
    return stored_orders(spark, path).drop("ingest_batch")


def compact_curated(spark: SparkSession, path: str, min_batches: int = 8) -> str | None:
    """One batch in place of the many of a month; readers see equal rows before, during and after."""
    return compact(spark, path, stored_orders(spark, path), min_batches)


def orders_between(
    orders: DataFrame, start: datetime.datetime, end: datetime.datetime
) -> DataFrame:
    """Order lines from `start` up to, not including, `end`.

    The dates also become conditions on the partition columns, so only the months of the period are
    read; a condition on `InvoiceDate` alone reads them all.
    """

    def from_month(at: datetime.datetime) -> Column:
        later_year = F.col("year") > at.year
        return later_year | ((F.col("year") == at.year) & (F.col("month") >= at.month))

    def to_month(at: datetime.datetime) -> Column:
        earlier_year = F.col("year") < at.year
        return earlier_year | ((F.col("year") == at.year) & (F.col("month") <= at.month))

    in_time = (F.col("InvoiceDate") >= F.lit(start)) & (F.col("InvoiceDate") < F.lit(end))
    return orders.where(from_month(start) & to_month(end) & in_time)
