"""Slowly changing dimensions, type 2: closed ranges of periods with constant tracked values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.scalars import same
from modelkit.functions.skew import HOT_ROWS, islands


def scd2_backfill(
    df: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    period: str,
    as_of: int | None = None,
    start: str = "start_season",
    end: str = "end_season",
    snapshot: str = "current_season",
    block: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Ranges for the whole history. NULLs compare as equal to NULL and different from values.

    ``df`` has one row per key and period. ``block`` (see ``islands``) splits keys whose period is so
    fine-grained that they have more than ``hot_rows`` rows. With ``as_of`` later periods are
    left out and the snapshot column is added.
    """
    seen = df if as_of is None else df.where(F.col(period) <= as_of)
    out = islands(seen, keys, [period], values=tracked, block=block, hot_rows=hot_rows).select(
        *keys, *tracked, F.col("start").alias(start), F.col("end").alias(end)
    )
    return out if as_of is None else out.withColumn(snapshot, F.lit(as_of).cast("int"))


def scd2_step(
    scd: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    prev: int,
    cur: int,
    start: str = "start_season",
    end: str = "end_season",
    snapshot: str = "current_season",
) -> DataFrame:
    """Move the ranges of snapshot ``prev`` to snapshot ``cur`` with one join.

    Closed ranges pass through untouched. An open range (ending at ``prev``) meets this period's row of
    its key: unchanged values extend it, changed ones close it and open a new range, and a key without
    an open range opens one. A key missing from ``current`` keeps its range, which is now closed.
    """
    keys, tracked = list(keys), list(tracked)
    slice_ = scd.where(F.col(snapshot) == prev)
    closed = slice_.where(F.col(end) < prev).select(*keys, *tracked, start, end)
    opened = slice_.where(F.col(end) == prev).select(
        *keys, F.struct(*tracked, start, end).alias("__old")
    )
    types = {c: scd.schema[c].dataType for c in [*tracked, start, end]}
    fresh = [*[F.col(c).cast(types[c]).alias(c) for c in tracked], *[F.lit(cur).cast(types[c]).alias(c) for c in (start, end)]]
    now = current.select(*keys, F.struct(*fresh).alias("__new"))
    both = opened.join(now, keys, "full_outer")
    old, new = F.col("__old"), F.col("__new")
    unchanged = same([old[c] for c in tracked], [new[c] for c in tracked])
    extended = F.struct(*[old[c].alias(c) for c in [*tracked, start]], new[end].alias(end))
    ranges = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull(), F.array(old))
        .when(unchanged, F.array(extended))
        .otherwise(F.array(old, new))
    )
    moved = both.select(*keys, F.inline(ranges))
    return closed.unionByName(moved).withColumn(snapshot, F.lit(cur).cast("int"))
