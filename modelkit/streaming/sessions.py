"""Complete sessions of a stream: closed ones, those still open when the input ends, and the rows that came too late.

Sessions are kept in tables of one folder per micro-batch. A batch sets its late rows aside, makes sessions of the others,
merges these with the sessions left open by the batch before, and writes those that the watermark has passed to
``closed`` and the rest to ``open``. A repeated batch overwrites its own folders from the same inputs, so a failure
leaves nothing twice. At the end of the input the last ``open`` folder holds what is unfinished.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.streaming.windows import SIZE, WATERMARK, sessionize_batch

CLOSED, OPEN, LATE, MARKS = "closed", "open", "late", "marks"


def _batches(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete batch folders of a kind, in order."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getParent().getName().removeprefix("batch_id=")) for s in found or [])


def merge_sessions(sessions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sessions of a key that meet or overlap become one. ``session_end`` is the gap after the last event."""
    order = W.partitionBy(*keys).orderBy("session_start", "session_end")
    reach = F.max("session_end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce((F.col("session_start") > reach).cast("int"), F.lit(1))
    numbered = sessions.withColumn("__opens", opens).withColumn("__s", F.sum("__opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__s").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("num_events").alias("num_events")
    ).select("session_start", "session_end", *keys, "num_events")


def session_writer(
    path: str, keys: Sequence[str] = ("ip", "host"), gap: str = SIZE, delay: str = WATERMARK, ts: str = "event_timestamp"
) -> Callable[[DataFrame, int], None]:
    """Batch writer for ``foreachBatch``. The watermark of a batch is the latest time of the batches before it less ``delay``."""
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [b for b in _batches(spark, path, MARKS) if b < batch_id]
        mark = spark.read.parquet(f"{path}/{MARKS}/batch_id={before[-1]}").first()["latest"] if before else None
        rows = batch.where(F.col(ts).isNotNull())
        allowed = F.lit(mark).cast(batch.schema[ts].dataType) - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(ts) < allowed, F.lit(False))
        rows.where(late).write.mode("overwrite").parquet(f"{path}/{LATE}/batch_id={batch_id}")
        found = sessionize_batch(rows.where(~late), keys, gap, ts)
        if before:
            found = found.unionByName(spark.read.schema(found.schema).parquet(f"{path}/{OPEN}/batch_id={before[-1]}"))
        merged = f"{path}/merged/batch_id={batch_id}"
        merge_sessions(found, keys).write.mode("overwrite").parquet(merged)
        sessions = spark.read.schema(found.schema).parquet(merged)
        latest = rows.agg(F.max(F.greatest(F.col(ts), F.lit(mark).cast(batch.schema[ts].dataType))).alias("latest")).first()["latest"] or mark
        # An event at the very end of a session still belongs to it, and one at the watermark is not late.
        over = F.coalesce(F.col("session_end") < F.lit(latest).cast(batch.schema[ts].dataType) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        sessions.where(over).write.mode("overwrite").parquet(f"{path}/{CLOSED}/batch_id={batch_id}")
        sessions.where(~over).write.mode("overwrite").parquet(f"{path}/{OPEN}/batch_id={batch_id}")
        # The mark comes last: a batch without one is done again.
        marks = spark.createDataFrame([(latest,)], f"latest {batch.schema[ts].dataType.simpleString()}")
        marks.write.mode("overwrite").parquet(f"{path}/{MARKS}/batch_id={batch_id}")

    return write


def _folders(spark: SparkSession, path: str, kind: str, last: bool = False) -> DataFrame:
    numbers = _batches(spark, path, MARKS)
    if not numbers:
        raise FileNotFoundError(f"no finished batch in {path}")
    return spark.read.parquet(*[f"{path}/{kind}/batch_id={b}" for b in (numbers[-1:] if last else numbers)])


def all_sessions(spark: SparkSession, path: str) -> DataFrame:
    """All sessions so far, with ``is_open`` for those that later events may still extend."""
    closed = _folders(spark, path, CLOSED).withColumn("is_open", F.lit(False))
    return closed.unionByName(_folders(spark, path, OPEN, last=True).withColumn("is_open", F.lit(True)))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Events that were set aside because the watermark had passed them."""
    return _folders(spark, path, LATE)
