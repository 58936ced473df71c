"""JDBC sink for streams, written through ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jdbc_batch_writer(
    url: str, table: str, properties: Mapping[str, str], partitions: int = 8
) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to ``table``, tagged with its batch number.

    ``foreachBatch`` may repeat a batch after a failure. The ``batch_id`` column lets the target tell a
    repeated batch from a new one, and ``partitions`` bounds the number of open connections.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .repartition(partitions)
            .write.mode("append")
            .jdbc(url, table, properties=dict(properties))
        )

    return write
