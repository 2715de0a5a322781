"""Ingesting event files: judged lines, dead letters and a log row per file.

Below a folder `out`:

* `lines`: every line that is not blank, with the reason if it is rejected, by outcome, month of
  arrival and batch. One write for both outcomes; nothing shuffles.
* `dead_letter`: one row per file without a valid event, unreadable and missing files too.
* `ingest_log`: one row per file with its counts.
* `superseded`: (path, loser, winner) for files that were ingested before, worked out against the log
  when a batch is written. Of two batches the later one wins, whichever was written first.
* `batches`: one row per batch, written last; batches without one do not count.

All are keyed by batch: the same batch run again replaces its rows. What a file gave before it was
ingested again, accepted, rejected or dead, is no longer read: readers take the lines of counted
batches and leave out what is superseded. Both tables are small, the second holds files ingested again
and nothing else, and the log is not read.

A compaction writes the lines of many batches of a month under one, with the batch they came from as
their `origin`, and then its row in `batches`, which names those it replaces.
"""

import datetime
import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from time import sleep

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.paths import source_key
from tillroll.operators.events import event_lines, notification_files, validate_events
from tillroll.sources.events import read_event_lines
from tillroll.sources.files import exists, plain_path, present_and_missing

RETENTION_DAYS = 14
MAX_FILES = 1_000
ACCEPTED, REJECTED = "accepted", "rejected"
COMPACTED = "compact-"

LINES_SCHEMA = (
    "path string, source string, line string, reason string, ingested_at timestamp, origin string, "
    "outcome string, year int, month int, ingest_batch string"
)
SUPERSEDED_SCHEMA = "path string, loser string, winner string, ingest_batch string"
BATCHES_SCHEMA = "ingested_at timestamp, replaces array<string>, ingest_batch string"
LOG_SCHEMA = (
    "path string, source string, n_valid bigint, n_bad bigint, error_type string, "
    "error_message string, ingested_at timestamp, ingest_date date, ingest_batch string"
)
DEAD_LETTER_TABLE_SCHEMA = (
    "path string, error_type string, error_message string, n_lines bigint, "
    "ingested_at timestamp, ingest_date date, ingest_batch string"
)
# Errors of executors reach the driver as one or the other.
SCAN_ERRORS = (PySparkException, Py4JJavaError)
# Seconds before a file that could not be read is tried a second and a third time.
RETRY_AFTER = (0.5, 2.0)
# Scans that may fail at a file they name before all files left are tried one by one, side by side.
NAMED_FAULTS = 3
FILES_AT_ONCE = 16
NOTHING = {"files": 0, "events_written": 0, "events_rejected": 0, "dead_files": 0}


class NoValidEvents(Exception):
    """A file without a single valid event, in strict mode."""


def ingest_events(
    spark: SparkSession,
    paths: Iterable[str],
    out: str,
    batch: str | None = None,
    arrived_at: datetime.datetime | None = None,
    strict: bool = False,
) -> dict[str, int]:
    """Judge the lines of event files and store the outcome below `out`.

    `paths` is one micro-batch of file names and is the only thing held by the driver. A file that is
    empty, missing or unreadable is a dead letter by itself and keeps no other from being stored.
    """
    arrived_at = arrived_at or datetime.datetime.now(datetime.timezone.utc)
    batch = batch or f"replay-{uuid.uuid4().hex}"
    present, missing = present_and_missing(spark, list(dict.fromkeys(paths)))
    present = list(dict.fromkeys(present))
    if not present and not missing:
        return dict(NOTHING)
    unreadable = _write_lines(spark, present, out, batch, arrived_at)
    faults = [(path, "MissingFile", f"No such file: {path}") for path in missing]
    faults += [(path, "UnreadableFile", f"Cannot read {path}") for path in unreadable]
    sound = [(path, None, None) for path in present if path not in set(unreadable)]
    files = spark.createDataFrame(
        [*sound, *faults], "path string, error_type string, error_message string"
    )
    counts = (
        _batch_lines(spark, out, batch)
        .groupBy(F.col("path").alias("counted"))
        .agg(
            F.count_if(F.col("outcome") == ACCEPTED).alias("n_valid"),
            F.count_if(F.col("outcome") == REJECTED).alias("n_bad"),
        )
    )
    nothing_valid = F.col("n_valid") == 0
    log = (
        files.join(counts, F.col("path") == F.col("counted"), "left")
        .drop("counted")
        .fillna(0, ["n_valid", "n_bad"])
        .withColumns(
            {
                "source": source_key(F.col("path")),
                "error_type": F.coalesce(
                    "error_type", F.when(nothing_valid, F.lit("ValidationError"))
                ),
                "error_message": F.coalesce(
                    "error_message",
                    F.when(nothing_valid, F.concat(F.lit("No valid events in "), F.col("path"))),
                ),
            }
        )
    )
    dead = log.where("error_type IS NOT NULL").select(
        "path", "error_type", "error_message", F.col("n_bad").alias("n_lines")
    )
    _write_batch(dead, f"{out}/dead_letter", batch, arrived_at)
    columns = ["path", "source", "n_valid", "n_bad", "error_type", "error_message"]
    _write_batch(log.select(*columns), f"{out}/ingest_log", batch, arrived_at)
    _write_keyed(_superseded(spark, out, batch), f"{out}/superseded", batch)
    _commit(spark, out, batch, arrived_at)
    logged = _log(spark, out).where(F.col("ingest_batch") == batch)
    total = logged.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("n_valid"), F.lit(0)).alias("events_written"),
        F.coalesce(F.sum("n_bad"), F.lit(0)).alias("events_rejected"),
        F.count_if(F.col("n_valid") == 0).alias("dead_files"),
    ).first()
    if strict and total.dead_files:
        first = logged.where("n_valid = 0").agg(F.min("error_message")).first()[0]
        raise NoValidEvents(first)
    return total.asDict()


def ingest_notified(
    spark: SparkSession,
    notifications: DataFrame,
    out: str,
    location: str = "s3a://{bucket}/{key}",
    max_files: int = MAX_FILES,
    **options,
) -> dict[str, int]:
    """Ingest the event files that arrival notifications name, in batches of `max_files`.

    `notifications` holds one JSON envelope per row in `payload`; a file named twice is read once.
    """
    named = notification_files(notifications).select("bucket", "key").distinct().toLocalIterator()
    paths = (location.format(bucket=row.bucket, key=row.key) for row in named)
    return _ingest_parts(spark, paths, out, max_files, **options)


def ingest_logged(
    spark: SparkSession, files: DataFrame, out: str, max_files: int = MAX_FILES, **options
) -> dict[str, int]:
    """Ingest the files named in `files.path` again, in batches of `max_files`."""
    paths = (row.path for row in files.select("path").distinct().toLocalIterator())
    return _ingest_parts(spark, paths, out, max_files, **options)


def _ingest_parts(
    spark: SparkSession, paths: Iterator[str], out: str, max_files: int, **options
) -> dict[str, int]:
    totals = dict(NOTHING)
    while part := list(islice(paths, max_files)):
        for name, count in ingest_events(spark, part, out, **options).items():
            totals[name] += count
    return totals


def _judged(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = validate_events(event_lines(read_event_lines(spark, paths)))
    return lines.withColumn("source", source_key(F.col("path")))


def _write_lines(
    spark: SparkSession, paths: list[str], out: str, batch: str, arrived_at: datetime.datetime
) -> list[str]:
    """Store the judged lines of the files and return the files that cannot be read.

    A scan that fails names the file, which is tried again by itself; if it stays unreadable, the next
    scan does without it. One bad file thus costs one more scan, and so do any number of them: after
    `NAMED_FAULTS` such scans every file left is tried on its own.
    """
    readable, unreadable, faults = list(paths), [], Counter()
    while readable:
        try:
            _store_lines(_judged(spark, readable), out, batch, arrived_at)
            return unreadable
        except SCAN_ERRORS as error:
            named = failed_file(error)
            faults[named] += 1
            one = named in readable and faults[named] == 1 and faults.total() <= NAMED_FAULTS
            found = _unreadable(spark, [named] if one else readable)
            if not found and (named not in readable or faults.total() > NAMED_FAULTS):
                raise
        unreadable += found
        readable = [path for path in readable if path not in set(found)]
    return unreadable


def failed_file(error: Exception) -> str | None:
    """The file at which a scan failed, by the name Spark gives it in the error."""
    found = re.search(r"\[FAILED_READ_FILE\S* Encountered error while reading file (\S+?)\.\s", f"{error} ")
    return found and plain_path(found[1])


def _unreadable(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files that cannot be read at any of the attempts, each scanned by itself."""

    def fails(path: str) -> bool:
        for wait in (0.0, *RETRY_AFTER):
            sleep(wait)
            try:
                read_event_lines(spark, [path]).agg(F.sum(F.length("line"))).collect()
                return False
            except SCAN_ERRORS:
                continue
        return True

    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        return [path for path, bad in zip(paths, pool.map(fails, paths)) if bad]


def _store_lines(
    judged: DataFrame, out: str, batch: str, arrived_at: datetime.datetime
) -> None:
    utc = arrived_at.astimezone(datetime.timezone.utc)
    outcome = F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)
    (
        judged.select(
            "path",
            "source",
            "line",
            "reason",
            F.lit(arrived_at).alias("ingested_at"),
            F.lit(None).cast("string").alias("origin"),
            outcome.alias("outcome"),
            F.lit(utc.year).alias("year"),
            F.lit(utc.month).alias("month"),
            F.lit(batch).alias("ingest_batch"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("outcome", "year", "month", "ingest_batch")
        .parquet(f"{out}/lines")
    )


def _write_batch(rows: DataFrame, path: str, batch: str, arrived_at: datetime.datetime) -> None:
    """Rows of one batch, a row per file at most, in few files."""
    (
        rows.withColumns(
            {
                "ingested_at": F.lit(arrived_at),
                "ingest_date": F.lit(arrived_at.astimezone(datetime.timezone.utc).date()),
                "ingest_batch": F.lit(batch),
            }
        )
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "ingest_batch")
        .parquet(path)
    )


def _table(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """A table that may not have been written yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _batch_lines(spark: SparkSession, out: str, batch: str) -> DataFrame:
    return _table(spark, LINES_SCHEMA, f"{out}/lines").where(F.col("ingest_batch") == batch)


def _log(spark: SparkSession, out: str) -> DataFrame:
    return _table(spark, LOG_SCHEMA, f"{out}/ingest_log")


def read_ingest_log(spark: SparkSession, out: str) -> DataFrame:
    """The newest outcome of every file in a batch that counts."""
    counted = _batches(spark, out).select(F.col("ingest_batch").alias("counted"))
    log = _log(spark, out).join(counted, F.col("ingest_batch") == F.col("counted"), "left_semi")
    row = F.struct(*(F.col(name) for name in log.columns))
    newest = F.max_by(row, F.struct("ingested_at", "ingest_batch")).alias("row")
    return log.groupBy(F.col("path").alias("of")).agg(newest).select("row.*")


def _superseded(spark: SparkSession, out: str, batch: str) -> DataFrame:
    """(path, loser, winner) between a logged batch and the others that hold some of its files.

    The batch's own log is written first, so of two that run at once one sees the other.
    """
    order = F.struct("ingested_at", "ingest_batch").alias("order")
    log = _log(spark, out).select("path", order)
    ours = log.where(F.col("order.ingest_batch") == batch)
    ours = ours.select(F.col("path").alias("our_path"), F.col("order").alias("our_order"))
    others = log.where(F.col("order.ingest_batch") != batch)
    met = others.join(ours, F.col("path") == F.col("our_path"))
    first, last = F.least("order", "our_order"), F.greatest("order", "our_order")
    return met.select("path", first["ingest_batch"].alias("loser"), last["ingest_batch"].alias("winner"))


def _write_keyed(rows: DataFrame, path: str, batch: str) -> None:
    """Few rows of one batch, in one file."""
    (
        rows.withColumn("ingest_batch", F.lit(batch))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_batch")
        .parquet(path)
    )


def _commit(
    spark: SparkSession, out: str, batch: str, at: datetime.datetime, replaces: Iterable[str] = ()
) -> None:
    row = spark.createDataFrame([(at, list(replaces))], "ingested_at timestamp, replaces array<string>")
    _write_keyed(row, f"{out}/batches", batch)


def _batches(spark: SparkSession, out: str) -> DataFrame:
    return _table(spark, BATCHES_SCHEMA, f"{out}/batches")


def _live(spark: SparkSession, out: str) -> DataFrame:
    """Batches that count and that no compaction replaced."""
    batches = _batches(spark, out)
    replaced = batches.select(F.explode("replaces").alias("gone"))
    return batches.join(replaced, F.col("ingest_batch") == F.col("gone"), "left_anti")


def _current(spark: SparkSession, out: str, rows: DataFrame) -> DataFrame:
    """Rows of counted batches without those of files that a later batch ingested again.

    Lines (with `origin`) are compacted, dead letters are not.
    """
    compacted = "origin" in rows.columns
    counted = _live(spark, out) if compacted else _batches(spark, out)
    counted = counted.select(F.col("ingest_batch").alias("counted"))
    winners = _batches(spark, out).select(F.col("ingest_batch").alias("known"))
    gone = (
        _table(spark, SUPERSEDED_SCHEMA, f"{out}/superseded")
        .join(winners, F.col("winner") == F.col("known"), "left_semi")
        .select(F.col("path").alias("gone_path"), "loser")
    )
    origin = F.coalesce("origin", "ingest_batch") if compacted else F.col("ingest_batch")
    return rows.join(counted, F.col("ingest_batch") == F.col("counted"), "left_semi").join(
        gone, (F.col("path") == F.col("gone_path")) & (origin == F.col("loser")), "left_anti"
    )


def _read_lines(spark: SparkSession, out: str, outcome: str) -> DataFrame:
    rows = _table(spark, LINES_SCHEMA, f"{out}/lines").where(F.col("outcome") == outcome)
    return _current(spark, out, rows).drop("origin")


def read_rejected(spark: SparkSession, out: str) -> DataFrame:
    return _read_lines(spark, out, REJECTED).drop("outcome")


def read_streaming(spark: SparkSession, out: str) -> DataFrame:
    """Accepted events as they came, with the month they arrived in."""
    rows = _read_lines(spark, out, ACCEPTED)
    return rows.select(F.col("line").alias("value"), "year", "month", "source")


def read_dead_letters(
    spark: SparkSession,
    out: str,
    today: datetime.date | None = None,
    retention_days: int = RETENTION_DAYS,
) -> DataFrame:
    """Dead letters still within retention; older days are pruned by partition."""
    today = today or datetime.datetime.now(datetime.timezone.utc).date()
    oldest = today - datetime.timedelta(days=retention_days)
    dead = _table(spark, DEAD_LETTER_TABLE_SCHEMA, f"{out}/dead_letter")
    return _current(spark, out, dead.where(F.col("ingest_date") >= F.lit(oldest)))


def compact_events(spark: SparkSession, out: str, min_batches: int = 8) -> list[str]:
    """Write one batch in place of those of every month that holds at least `min_batches`.

    Readers see equal rows before, during and after; a crash before the last write changes nothing.
    What is superseded is not carried over. Returns the names of the new batches.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    at = F.to_utc_timestamp("ingested_at", zone).alias("at")
    live = _live(spark, out).select("ingest_batch", at)
    # Names of the batches since the last compaction.
    months = live.groupBy(F.year("at").alias("year"), F.month("at").alias("month")).agg(
        F.sort_array(F.collect_list("ingest_batch")).alias("batches")
    )
    made = []
    for due in months.where(F.size("batches") >= min_batches).collect():
        name = COMPACTED + hashlib.md5("\n".join(due.batches).encode()).hexdigest()
        rows = _table(spark, LINES_SCHEMA, f"{out}/lines").where(F.col("ingest_batch").isin(due.batches))
        (
            _current(spark, out, rows)
            .withColumn("origin", F.coalesce("origin", "ingest_batch"))
            .withColumn("ingest_batch", F.lit(name))
            .hint("rebalance", "outcome")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("outcome", "year", "month", "ingest_batch")
            .parquet(f"{out}/lines")
        )
        newest = _batches(spark, out).where(F.col("ingest_batch").isin(due.batches))
        _commit(spark, out, name, newest.agg(F.max("ingested_at")).first()[0].astimezone(), due.batches)
        made.append(name)
    return made
