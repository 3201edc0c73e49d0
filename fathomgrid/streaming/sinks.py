"""Streaming sinks that can repeat a batch without repeating its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def batch_writer(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
    """`foreachBatch` function: each batch has a folder of its own, replaced when it is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            prepare(batch)
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    output_mode: str = "append",
) -> StreamingQuery:
    """Process everything available, write it below `path`, and stop."""
    query = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(batch_writer(path, prepare))
        .start()
    )
    query.awaitTermination()
    return query


def status_from_stream(
    events: DataFrame, path: str, checkpoint: str, at: str | None = None
) -> StreamingQuery:
    """Status rows of a stream, appended batch by batch; the latest row per file counts at reading.

    They are stamped with the column `at`, or with the clock of their batch.
    """
    stamp = F.current_timestamp() if at is None else F.col(at)
    return run_available(events, path, checkpoint, lambda df: df.withColumn("pipeline_time", stamp))
