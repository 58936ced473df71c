"""Running streams into tables, and reading the result back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modelkit.sources.config import StreamConfig


def finish(query: StreamingQuery, timeout: int) -> None:
    """Wait for a query that processes what is available; stop it and raise if it takes too long."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream not finished after {timeout} seconds")


def append_available(stream: DataFrame, path: str, checkpoint: str, timeout: int = 3600) -> StreamingQuery:
    """Process all available input and append final rows to Parquet files (exactly once)."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
    return query


def write_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that stores the changed rows of each micro-batch in a folder of its own.

    A repeated batch overwrites its folder, so failures leave no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def update_available(stream: DataFrame, path: str, checkpoint: str, timeout: int = 3600) -> StreamingQuery:
    """Process all available input in update mode, so open windows are included in the result."""
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write_updates(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
    return query


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Current state of a table written by ``write_updates``: the values of the last batch per key."""
    rows = spark.read.option("basePath", path).parquet(path)
    newest = F.max(F.struct(F.col("batch_id").cast("long"), *values)).alias("__v")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in values])


def start_sink(
    stream: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    config: StreamConfig,
    mode: str = "append",
) -> StreamingQuery:
    """Continuous query into a batch writer (JDBC, for example) with the configured trigger."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=config.trigger)
        .start()
    )


def start_sinks(
    sinks: dict[str, tuple[DataFrame, Callable[[DataFrame, int], None]]], checkpoint: str, config: StreamConfig
) -> dict[str, StreamingQuery]:
    """Several queries over one source, each with its own checkpoint."""
    return {
        name: start_sink(stream, writer, f"{checkpoint}/{name}", config) for name, (stream, writer) in sinks.items()
    }


def dropped_rows(query: StreamingQuery) -> int:
    """Rows a query left out as too late, over its recent batches."""
    return sum(
        int(state["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
