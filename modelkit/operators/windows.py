"""Rolling contributions, best stretches and streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.functions.skew import HOT_ROWS, islands, ordered_number, sliding_sum
from modelkit.operators.dedupe import dedupe


def contribution(
    df: DataFrame,
    dims: Sequence[str],
    date: str,
    min_total: int = 500,
    previous: tuple[int, int] = (-13, -7),
    calendar: bool = False,
) -> DataFrame:
    """Event counts per ``dims`` and day with running, weekly and period shares.

    Counts are aggregated first, so a window partition holds one row per day. The week before is rows
    -13 to -7 by default; ``calendar=True`` measures both weeks in days instead of rows. The month is
    part of the sort key, so all row-based windows share one shuffle and one sort.
    """
    daily = (
        df.groupBy(*dims, date)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("__month", F.trunc(date, "month"))
        .withColumn("__n", F.datediff(date, F.lit("1970-01-01").cast("date")))
    )
    key = W.partitionBy(*dims)
    by_row = key.orderBy("__month", date)
    whole = (W.unboundedPreceding, W.unboundedFollowing)
    if calendar:
        by_day = key.orderBy("__n")
        week, week_before = by_day.rangeBetween(-6, 0), by_day.rangeBetween(*previous)
    else:
        week, week_before = by_row.rowsBetween(-6, 0), by_row.rowsBetween(*previous)
    total = F.sum("count")
    out = daily.withColumns(
        {
            "month_total": total.over(W.partitionBy(*dims, "__month").orderBy(date).rowsBetween(*whole)),
            "rolling_cumulative_sum": total.over(by_row.rowsBetween(W.unboundedPreceding, 0)),
            "total": total.over(by_row.rowsBetween(*whole)),
            "weekly_rolling_count": total.over(week),
            "previous_weekly_rolling_count": total.over(week_before),
        }
    )
    return out.where(F.col("total") > min_total).select(
        *dims,
        date,
        "count",
        "rolling_cumulative_sum",
        "weekly_rolling_count",
        "previous_weekly_rolling_count",
        (F.col("count") / F.col("month_total")).alias("pct_of_month"),
        (F.col("count") / F.col("total")).alias("pct_of_total"),
    )


def best_stretch(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: str,
    size: int = 90,
    block: Column | None = None,
    chunk: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Highest sum of ``flag`` over any ``size`` consecutive rows of a key.

    ``block`` (see ``ordered_number``) and ``chunk`` (see ``sliding_sum``) spread long keys. ``df`` is
    read for the counts and for the rows, so it should be a stored table rather than a long plan.
    """
    numbered = ordered_number(df.select(*keys, *order, flag), keys, order, block, "__position", hot_rows)
    summed = sliding_sum(numbered, keys, "__position", flag, size, "__sum", chunk)
    return summed.groupBy(*keys).agg(F.max("__sum").alias("best"))


def longest_streak(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column,
    block: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Longest run of rows that meet ``condition`` per key; the earliest of equally long ones.

    ``block`` (see ``islands``) spreads keys with more than ``hot_rows`` rows.
    """
    marked = df.select(*keys, *order, F.coalesce(condition, F.lit(False)).alias("__met"))
    runs = islands(marked, keys, order, values=["__met"], block=block, hot_rows=hot_rows).where(F.col("__met"))
    best = dedupe(runs, keys, [F.col("n").desc(), F.col("start")])
    return best.select(
        *keys,
        F.col("n").alias("games_in_streak"),
        F.col("start").alias("streak_start"),
        F.col("end").alias("streak_end"),
    )
