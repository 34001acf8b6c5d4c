"""Starting streams: continuously, or over what is there now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyloom.session import released_shuffles

COMMIT_INTERVAL = "10 seconds"


def start(writer: DataStreamWriter, checkpoint: str, every: str = COMMIT_INTERVAL) -> StreamingQuery:
    """Run until stopped, committing at most once per interval."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def drain(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> None:
    """Process everything available in micro-batches, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        if query.isActive:
            query.stop()


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    """``mode`` is ``update`` for a grouped stream: a batch then holds the groups that changed.

    What an action of ``work`` shuffles leaves the disk with the action.
    """

    def released(batch: DataFrame, batch_id: int) -> None:
        with released_shuffles(batch.sparkSession):
            work(batch, batch_id)

    return df.writeStream.outputMode(mode).foreachBatch(released)


def to_files(df: DataFrame, path: str) -> DataStreamWriter:
    """Append to a Parquet table; the sink's own log makes every batch visible exactly once."""
    return df.writeStream.format("parquet").option("path", path).outputMode("append")
