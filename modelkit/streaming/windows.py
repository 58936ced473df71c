"""Event-time parsing and windowed aggregation. The window functions also run on batch frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.scalars import iso_timestamp
from modelkit.functions.skew import islands

WATERMARK = "15 seconds"
SIZE = "5 minutes"


def parse_events(
    df: DataFrame, text: str = "event_time", ts: str = "event_timestamp", watermark: str | None = WATERMARK
) -> DataFrame:
    """Event time from ISO text, with a watermark. Rows whose time does not parse have no event time and
    are left out of windows."""
    parsed = df.withColumn(ts, iso_timestamp(F.col(text)))
    return parsed.withWatermark(ts, watermark) if watermark else parsed


def tumbling_hits(
    events: DataFrame, dims: Sequence[str], size: str = SIZE, ts: str = "event_timestamp", start: str = "event_hour"
) -> DataFrame:
    """Events per window and ``dims``. Counts are partially aggregated before the shuffle."""
    return (
        events.groupBy(F.window(ts, size).alias("__w"), *dims)
        .agg(F.count(F.lit(1)).alias("num_hits"))
        .select(F.col("__w.start").alias(start), *dims, "num_hits")
    )


def sessionize(
    events: DataFrame, keys: Sequence[str] = ("ip", "host"), gap: str = SIZE, ts: str = "event_timestamp"
) -> DataFrame:
    """Sessions of ``keys`` that end ``gap`` after their last event. For streams; append mode emits a
    session once the watermark has passed its end. Run it under ``stream_conf``.
    """
    return (
        events.groupBy(F.session_window(ts, gap).alias("__w"), *keys)
        .agg(F.count(F.lit(1)).alias("num_events"))
        .select(
            F.col("__w.start").alias("session_start"),
            F.col("__w.end").alias("session_end"),
            *keys,
            "num_events",
        )
    )


def stream_conf() -> dict[str, str]:
    """Session settings for stateful streams, to be set before a query starts.

    State lives in RocksDB, on disk and in the checkpoint, instead of executor memory, so replaying a long
    log does not depend on memory size. Sessions are merged per map task before the shuffle, which keeps a
    busy key small.
    """
    return {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def sessionize_batch(
    events: DataFrame,
    keys: Sequence[str] = ("ip", "host"),
    gap: str = SIZE,
    ts: str = "event_timestamp",
    block: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """The same sessions for a finished table. Keys are cut into hours (or ``block``), so the events of a
    busy key are spread over tasks, and only the sessions at the edges of an hour are joined up. Copies of
    an event are counted before that."""
    length = F.expr(f"INTERVAL {gap}")
    hour = F.date_trunc("hour", F.col(ts)) if block is None else block
    instants = events.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__events"))
    found = islands(instants, keys, [ts], gap=length, block=hour, hot_rows=hot_rows, weight="__events")
    return found.select(
        F.col("start").alias("session_start"),
        (F.col("end") + length).alias("session_end"),
        *keys,
        F.col("n").alias("num_events"),
    )


def session_stats(sessions: DataFrame, host_like: str | None = None, host: str = "host") -> DataFrame:
    """Average events per session and number of sessions per host."""
    rows = sessions if host_like is None else sessions.where(F.col(host).like(host_like))
    return rows.groupBy(host).agg(
        F.avg("num_events").alias("avg_events_per_session"), F.count(F.lit(1)).alias("total_sessions")
    )
