"""Micro-batches of file names."""

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery


def start_file_batches(
    arrivals: DataFrame,
    checkpoint: str,
    name: str,
    work: Callable[[list[Row], str], None],
    **trigger,
) -> StreamingQuery:
    """Call `work` with the files of each micro-batch and a name for the batch.

    The name is the same when a micro-batch is run again from its checkpoint. It holds the query's
    identity, so a stream begun anew with another checkpoint never takes the names, and with them
    the stored rows, of an earlier one. `work` runs in the driver on file names only, and should use
    the caller's session for jobs, where adaptive execution is on whatever the stream's own says.
    """
    query_id: Future = Future()

    def call(files: DataFrame, batch_id: int) -> None:
        rows = files.collect()
        if rows:
            work(rows, f"{name}-{query_id.result()}-{batch_id}")

    query = (
        arrivals.writeStream.foreachBatch(call)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    query_id.set_result(query.id)
    return query
