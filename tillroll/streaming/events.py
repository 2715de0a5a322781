"""Event files as they arrive."""

import datetime
import hashlib
from collections import Counter
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.sinks.events import MAX_FILES, NOTHING, ingest_events, read_ingest_log
from tillroll.sources.files import arriving_files, empty_files, modified_files
from tillroll.streaming.files import start_file_batches

# Between two full sweeps a running stream lists what was modified since shortly before the last one.
FULL_SWEEP = datetime.timedelta(days=1)
OVERLAP = datetime.timedelta(days=2)
# Spark's file stream passes over files that are older than this beside the newest it has seen.
MAX_FILE_AGE = datetime.timedelta(days=7)


def start_event_ingest(
    spark: SparkSession,
    incoming: str,
    out: str,
    checkpoint: str,
    name: str = "events",
    max_files: int = MAX_FILES,
    processing_time: str | None = None,
    pattern: str = "*.json",
    totals: Counter | None = None,
) -> StreamingQuery:
    """Ingest new files that match `pattern`, once through or every `processing_time`.

    The arrival time comes from the micro-batch, so a retried batch lands in the same month. The
    stream knows files by path, so a file dropped again is not new to it, and it shows no empty
    files; with `processing_time` every micro-batch looks for both, the first and then one a day among
    all files, the others among those modified since the last sweep.
    """
    full = last = None

    def sweep() -> dict[str, int]:
        nonlocal full, last
        start = datetime.datetime.now(datetime.timezone.utc)
        whole = full is None or start - full >= FULL_SWEEP
        since = None if whole else last - OVERLAP
        result = Counter(sweep_empty_files(spark, incoming, out, pattern, since))
        result.update(sweep_missed_files(spark, incoming, out, pattern, since, start - MAX_FILE_AGE))
        full, last = start if whole else full, start
        return result

    def ingest(files: list[Row], batch: str) -> None:
        paths, arrived_at = [row.path for row in files], files[0].arrived_at.astimezone()
        results = [ingest_events(spark, paths, out, batch=batch, arrived_at=arrived_at)]
        if processing_time:
            results.append(sweep())
        if totals is not None:
            for result in results:
                totals.update(result)

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    arrivals = arriving_files(spark, incoming, pattern, max_files)
    return start_file_batches(arrivals, checkpoint, name, ingest, **trigger)


def sweep_empty_files(
    spark: SparkSession,
    incoming: str,
    out: str,
    pattern: str = "*.json",
    since: datetime.datetime | None = None,
) -> dict[str, int]:
    """Dead-letter zero-length files that are not logged as such, of all files unless `since` is given.

    Among them are files that held lines when they were ingested and were emptied since. A file copied
    with its old modification time shows only when all are listed. The batch is named by its files and
    what was known of them, so a sweep that is run again after a crash replaces what it wrote.
    """
    paths = empty_files(spark, incoming, pattern, _utc_text(since))
    if not paths:
        return {}
    listed = spark.createDataFrame([(path,) for path in paths], "listed string")
    empty = (F.col("n_valid") == 0) & (F.col("n_bad") == 0)
    log = read_ingest_log(spark, out).select(F.col("path").alias("logged"), "ingest_batch", empty.alias("empty"))
    due = listed.join(log, F.col("listed") == F.col("logged"), "left")
    due = due.where(~F.coalesce("empty", F.lit(False)))
    return _ingest_swept(spark, due.select(F.col("listed").alias("path"), F.col("ingest_batch").alias("state")), out)


def sweep_missed_files(
    spark: SparkSession,
    incoming: str,
    out: str,
    pattern: str = "*.json",
    since: datetime.datetime | None = None,
    unseen_before: datetime.datetime | None = None,
) -> dict[str, int]:
    """Ingest what the stream does not show, of all files unless `since` is given.

    That is files modified after they were ingested, dropped again under their old path, and files
    modified before `unseen_before` and never ingested: the stream passes over files much older than
    the newest. The listing stays a table and is joined with the log; only the files due come to the
    driver, in parts. The store's clock and the driver's should agree to less than the time between a
    file's arrival and its ingestion.
    """
    log = read_ingest_log(spark, out).select(F.col("path").alias("logged"), "ingested_at")
    listed = modified_files(spark, incoming, pattern, _utc_text(since))
    again = F.col("modificationTime") > F.col("ingested_at")
    unseen = F.lit(False)
    if unseen_before:
        unseen = F.col("logged").isNull() & (F.col("modificationTime") < F.lit(unseen_before))
    due = listed.join(log, F.col("path") == F.col("logged"), "left").where(again | unseen)
    return _ingest_swept(spark, due.select("path", F.col("modificationTime").cast("string").alias("state")), out)


def _utc_text(at: datetime.datetime | None) -> str | None:
    return at and at.astimezone(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def _ingest_swept(spark: SparkSession, due: DataFrame, out: str) -> dict[str, int]:
    """Ingest the files of `due.path`, part by part; a part's batch is named by its paths and states."""
    rows, totals = due.orderBy("path").toLocalIterator(), Counter()
    while part := [(row.path, row.state) for row in islice(rows, MAX_FILES)]:
        batch = "sweep-" + hashlib.md5(repr(part).encode()).hexdigest()
        totals.update(ingest_events(spark, [path for path, _ in part], out, batch=batch))
    return dict(totals)


def run_event_ingest(
    spark: SparkSession,
    incoming: str,
    out: str,
    checkpoint: str,
    pattern: str = "*.json",
    **options,
) -> dict[str, int]:
    """Ingest everything new that matches `pattern` and return the totals.

    New are files the stream has not seen, also old ones that it passes over, ones dropped again under
    their old path, and empty ones.
    """
    totals: Counter = Counter()
    query = start_event_ingest(
        spark, incoming, out, checkpoint, totals=totals, pattern=pattern, **options
    )
    query.awaitTermination()
    totals.update(sweep_empty_files(spark, incoming, out, pattern))
    now = datetime.datetime.now(datetime.timezone.utc)
    totals.update(sweep_missed_files(spark, incoming, out, pattern, unseen_before=now))
    return {key: totals[key] for key in NOTHING}
