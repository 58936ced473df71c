"""Distinct users as mergeable bitmaps: one pass over the events, then any period, member or trailing window without them.

A bitmap holds the users of 32,768 neighbouring numbers exactly, one bit each, and merges by OR. Users should be numbered
densely (a dictionary key); with scattered ids a bitmap of 4 KB holds few of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(events: DataFrame, dims: Sequence[str] = (), user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """(day, dims, bucket, users): the distinct users per day and member. Rows without user or time are left out.

    Bitmaps are filled before the shuffle, so a frequent user or member moves one bitmap per task.
    """
    rows = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    number = F.col(user).cast("long")
    return rows.groupBy(F.to_date(ts).alias("day"), *dims, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users")
    )


def add_bitmaps(table: DataFrame, more: DataFrame) -> DataFrame:
    """Both tables merged: a day may be added twice or in parts."""
    keys = [c for c in table.columns if c != "users"]
    return table.unionByName(more).groupBy(*keys).agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(bitmaps: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Distinct users per ``by``, any expressions of the day and the members."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("__n"))
    names = [c for c in merged.columns if c not in ("bucket", "__n")]
    return merged.groupBy(*names).agg(F.sum("__n").alias("users"))


def trailing_users(bitmaps: DataFrame, days: int, dims: Sequence[str] = ()) -> DataFrame:
    """(day, dims, users): distinct users of the ``days`` days up to each day between the first and the last of the table.

    Every bitmap takes part in ``days`` windows; the events are not read again.
    """
    last = bitmaps.agg(F.max("day")).scalar()
    ends = F.sequence("day", F.least(F.date_add("day", days - 1), F.col("__last")))
    spread = bitmaps.withColumn("__last", last).withColumn("day", F.explode(ends)).drop("__last")
    return distinct_users(spread, ["day", *dims])
