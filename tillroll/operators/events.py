"""Order events: validation per line and outcome per source file."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.event_json import parsed_event, rejection_reason, stripped
from tillroll.functions.paths import notified_key, source_name
from tillroll.schemas import DEAD_LETTER_SCHEMA, NOTIFICATION_SCHEMA


def event_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lines without surrounding white space; blank ones are left out."""
    return lines.withColumn(column, stripped(F.col(column))).where(F.col(column) != "")


def validate_events(lines: DataFrame, column: str = "line") -> DataFrame:
    """Add `reason`: why the line is rejected, NULL for a valid event.

    A JSON value that is no object counts as a bad line; the file goes on. The parsed line passes
    through a one-item explode, below which Spark pushes no filter on `reason`: the line is parsed
    once, not again for every place a pushed condition mentions it.
    """
    parsed = lines.select("*", F.explode(F.array(parsed_event(F.col(column)))).alias("_parsed"))
    return parsed.withColumn("reason", rejection_reason(F.col(column), F.col("_parsed"))).drop(
        "_parsed"
    )


def valid_events(judged: DataFrame) -> DataFrame:
    """Valid lines as they came, unknown keys included."""
    return judged.where(F.col("reason").isNull()).drop("reason")


def rejected_events(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull())


def file_stats(judged: DataFrame, source: str = "source") -> DataFrame:
    """Valid and bad lines per source; the counts combine before the shuffle."""
    return judged.groupBy(source).agg(
        F.count_if(F.col("reason").isNull()).alias("n_valid"),
        F.count_if(F.col("reason").isNotNull()).alias("n_bad"),
    )


def dead_files(stats: DataFrame, source: str = "source") -> DataFrame:
    """Sources without a single valid event, with the error they are dead-lettered with."""
    return stats.where(F.col("n_valid") == 0).select(
        source,
        F.lit("ValidationError").alias("error_type"),
        F.concat(F.lit("No valid events in "), F.col(source)).alias("error_message"),
        F.col("n_bad").alias("n_lines"),
    )


def notification_files(notifications: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per object named in arrival notifications: bucket, decoded key, source name."""
    record = F.col("record.s3")
    unpacked = notifications.withColumn(
        "record", F.explode(F.from_json(payload, NOTIFICATION_SCHEMA)["Records"])
    )
    return (
        unpacked.withColumn("bucket", record["bucket"]["name"])
        .withColumn("key", notified_key(record["object"]["key"]))
        .withColumn("source_name", source_name(F.col("key")))
        .drop("record", payload)
    )


def _elapsed_seconds(start: Column, end: Column) -> Column:
    return F.unix_micros(end).cast("double") / 1e6 - F.unix_micros(start).cast("double") / 1e6


def dead_letter_triage(messages: DataFrame, message: str = "message") -> DataFrame:
    """One row per object in dead-letter messages, with the error and the time to give up."""
    opened = messages.select(F.from_json(message, DEAD_LETTER_SCHEMA).alias("m"))
    objects = opened.select("m", F.explode("m.requestPayload.Records").alias("record"))
    return objects.select(
        F.col("m.requestContext.requestId").alias("request_id"),
        F.col("m.requestContext.condition").alias("condition"),
        F.col("m.requestContext.approximateInvokeCount").alias("attempts"),
        F.col("record.s3.bucket.name").alias("bucket"),
        notified_key(F.col("record.s3.object.key")).alias("key"),
        F.col("record.s3.object.size").alias("size"),
        F.col("m.responsePayload.errorType").alias("error_type"),
        F.col("m.responsePayload.errorMessage").alias("error_message"),
        F.round(_elapsed_seconds(F.col("record.eventTime"), F.col("m.timestamp")), 3).alias(
            "seconds_to_dead_letter"
        ),
    )
