"""Reading newline-delimited event files."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.paths import decoded_path
from tillroll.sources.files import literal_path


def read_event_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """All lines with the path of their file. A string names a folder of `*.json` files."""
    reader = spark.read
    if isinstance(paths, str):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        files = paths
    else:
        files = [literal_path(path) for path in paths]
    return reader.text(files).select(
        decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line")
    )
