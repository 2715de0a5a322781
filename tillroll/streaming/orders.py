"""Incremental cleaning: every raw file is read once, over any number of runs."""

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.clean import clean_orders
from tillroll.schemas import CURATED_SCHEMA
from tillroll.sinks.tables import stored_rows, write_curated
from tillroll.sources.files import arriving_files, move_files, one_store
from tillroll.sources.orders import read_orders_csv
from tillroll.streaming.files import start_file_batches

MAX_FILES = 10_000

STORED_SCHEMA = T.StructType([*CURATED_SCHEMA.fields, T.StructField("ingest_batch", T.StringType())])

# Names of the same zone, as sessions spell them.
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00")


@dataclass
class IncrementalRun:
    """What one run read and wrote; all zero when no file was new.

    Raw rows are counted on the way by the tasks, so a task repeated after a lost executor may count
    its rows again; clean rows are counted in the table.
    """

    files: int = 0
    raw_rows: int = 0
    clean_rows: int = 0
    columns: list[str] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)

    def message(self) -> str:
        if not self.files:
            return "No new files. Nothing to process."
        return f"{self.files} files, {self.raw_rows} raw rows, {self.clean_rows} clean rows"


def clean_batch(
    spark: SparkSession,
    paths: list[str],
    curated: str,
    batch: str,
    rebalance: bool = True,
    multiline: bool = False,
) -> tuple[list[str], int, int]:
    """Clean some raw files into one curated batch, which may turn out empty.

    Returns the columns found, the rows read, counted on the way, and the rows stored.
    """
    read = Observation()
    lines = read_orders_csv(spark, paths, multiline)
    raw = lines.observe(read, F.count(F.lit(1)).alias("rows"))
    write_curated(clean_orders(raw), curated, batch, rebalance)
    kept = stored_rows(spark, curated, STORED_SCHEMA, f"ingest_batch = '{batch}'")
    # When no row is left to write, adaptive execution drops the stage and the count with it.
    return lines.columns, read.get["rows"] if kept else lines.count(), kept


def start_incremental(
    spark: SparkSession,
    raw: str,
    curated: str,
    checkpoint: str,
    name: str = "orders",
    max_files: int = MAX_FILES,
    rebalance: bool = True,
    report: IncrementalRun | None = None,
    pattern: str | None = None,
    multiline: bool = False,
    archive: str | None = None,
    committed: dict[str, list[str]] | None = None,
) -> StreamingQuery:
    """Stream the files that arrived since the last committed run, then stop.

    The stream carries file names only. Headers differ between files, so each micro-batch is read
    by name as a batch job and written under the micro-batch's own partition value: a micro-batch
    that is run again after a crash replaces what it wrote. All files count, or those whose name
    matches `pattern`.

    With `archive`, a folder outside `raw` on the same file system, files are moved there when their
    micro-batch is committed, into a folder per batch: the next run lists new files and not all history.
    A batch counts as committed when the next one starts; `run_incremental` moves the last one's files.
    (Spark's own `cleanSource` leaves the last batch of every run, with small runs all files.) Files a
    lost driver left behind stay in `raw` and are not read again. To clean everything anew, stream
    the archive with a new checkpoint.
    """
    report = report if report is not None else IncrementalRun()
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        warnings.warn(f"order dates are read in the session's zone {zone}, not UTC", stacklevel=2)

    if archive and not one_store(spark, raw, archive):
        raise ValueError(f"{archive} and {raw} are not two folders side by side on one file system")
    waiting = committed if committed is not None else {}

    def ingest(files: list[Row], batch: str) -> None:
        if archive:
            archive_batches(spark, waiting, archive)
        paths = [row.path for row in files]
        columns, read, kept = clean_batch(spark, paths, curated, batch, rebalance, multiline)
        report.files += len(paths)
        report.raw_rows += read
        report.clean_rows += kept
        report.columns += [column for column in columns if column not in report.columns]
        report.batches.append(batch)
        if archive:
            waiting[batch] = paths

    arrivals = arriving_files(spark, raw, pattern, max_files)
    return start_file_batches(arrivals, checkpoint, name, ingest, availableNow=True)


def archive_batches(spark: SparkSession, batches: dict[str, list[str]], archive: str) -> None:
    """Move the files of committed batches, a micro-batch at most, and forget them."""
    for batch in list(batches):
        move_files(spark, batches.pop(batch), f"{archive.rstrip('/')}/{batch}")


def run_incremental(
    spark: SparkSession,
    raw: str,
    curated: str,
    checkpoint: str,
    archive: str | None = None,
    **options,
) -> IncrementalRun:
    """Process everything new and report it."""
    report, committed = IncrementalRun(), {}
    query = start_incremental(
        spark, raw, curated, checkpoint, report=report, archive=archive, committed=committed, **options
    )
    query.awaitTermination()
    if archive:
        archive_batches(spark, committed, archive)
    return report
