"""Stored intermediate tables, which survive the loss of any executor."""

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=None)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tillroll-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    A session in one process, as in tests, shares its disk with itself and may do without; any other
    one is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        shared = _own_folder()
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return shared.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared one.

    What is stored there is read lazily by the frames returned, so it stays; clean the shared folder
    up when a job is over, or give it a life-time rule.
    """
    return f"{shared_folder(spark)}/tillroll-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written as a table and read back: lineage cut, column pruning kept."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
