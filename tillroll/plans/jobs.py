"""Spark jobs that do not need each other's results, started together."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def side_by_side(spark: SparkSession, *calls: Callable[[], Result]) -> list[Result]:
    """Results of some calls, each in a thread of its own; the first error once all have ended.

    Every call waits for its jobs. Tasks of one job fill the cores that the last tasks of another
    leave idle. Threads take over the caller's job group, tags and scheduler pool.
    """
    with ThreadPoolExecutor(len(calls)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [future.result() for future in running]
