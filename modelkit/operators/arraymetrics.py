"""Monthly metrics packed into arrays: element i is day i + 1 of the month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def daily_metrics(
    events: DataFrame, keys: Sequence[str], ts: str, metrics: Mapping[str, Column], day: str = "date"
) -> DataFrame:
    """Metrics per entity and day, for example ``{"hits": F.count(F.lit(1))}``. Partially aggregated."""
    return events.groupBy(*keys, F.to_date(ts).alias(day)).agg(*[c.alias(n) for n, c in metrics.items()])


def array_metric_step(
    prev: DataFrame,
    daily: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, str],
    ds: dt.date,
    month: str = "month_start",
    day: str = "date",
    pad: int | None = 0,
    track_first: bool = False,
    snapshot: str | None = None,
) -> DataFrame:
    """Write day ``ds`` into the arrays of its month; ``metrics`` maps array column to daily column.

    The element is addressed by day of month, so skipped days are padded, a late key is padded from the
    first of the month, and applying a day again replaces its element. With ``pad=None`` days without
    data are NULL. ``track_first`` keeps the earliest day each key was seen. ``snapshot`` names a column for
    the day itself, for tables that keep one slice per day; ``prev`` is then the slice of the day before.
    """
    first_of_month = ds.replace(day=1)
    p = prev.where(F.col(month) == F.lit(first_of_month)).select(
        *keys,
        *[F.col(a).alias(f"p_{a}") for a in metrics],
        *([F.col("first_found_date").alias("p_first")] if track_first else []),
    )
    t = daily.where(F.col(day) == F.lit(ds)).select(
        *keys, *[F.col(v).alias(f"t_{a}") for a, v in metrics.items()], F.lit(True).alias("__seen")
    )
    filler = F.lit(pad)

    def put(name: str) -> Column:
        past, value = F.col(f"p_{name}"), F.col(f"t_{name}")
        length = F.greatest(F.lit(ds.day), F.coalesce(F.size(past), F.lit(0)))
        empty = filler.cast(daily.schema[metrics[name]].dataType)
        return F.transform(
            F.sequence(F.lit(0), length - 1),
            lambda i: F.when(i == ds.day - 1, F.coalesce(value, empty)).otherwise(F.coalesce(F.get(past, i), empty)),
        ).alias(name)

    today = F.when(F.col("__seen"), F.lit(ds))
    return p.join(t, list(keys), "full_outer").select(
        *keys,
        F.lit(first_of_month).alias(month),
        *[put(a) for a in metrics],
        *([F.least("p_first", today).alias("first_found_date")] if track_first else []),
        *([F.lit(ds).alias(snapshot)] if snapshot else []),
    )


def array_metric_backfill(
    daily: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, str],
    last: dt.date | None = None,
    month: str = "month_start",
    day: str = "date",
    pad: int | None = 0,
    track_first: bool = False,
) -> DataFrame:
    """Arrays of every month, as long as the month (or up to ``last``, by default the latest day seen).

    A group holds one row per day of one month, so at most 31 elements are collected.
    """
    end = F.lit(last).cast("date") if last is not None else daily.agg(F.max(day)).scalar()
    cells = F.map_from_entries(
        F.collect_list(F.struct(F.dayofmonth(day), F.struct(*[F.col(v).alias(a) for a, v in metrics.items()])))
    )
    grouped = (
        daily.groupBy(*keys, F.to_date(F.trunc(day, "month")).alias(month))
        .agg(cells.alias("__cells"), F.min(day).alias("first_found_date"))
        .withColumn("__end", end)
        .where(F.col(month) <= F.col("__end"))
    )
    length = F.dayofmonth(F.least(F.last_day(month), F.col("__end")))

    def fill(name: str, kind: T.DataType) -> Column:
        empty = F.lit(pad).cast(kind)
        cell = F.sequence(F.lit(1), length)
        return F.transform(cell, lambda i: F.coalesce(F.try_element_at("__cells", i)[name], empty)).alias(name)

    return grouped.select(
        *keys,
        month,
        *[fill(a, daily.schema[v].dataType) for a, v in metrics.items()],
        *(["first_found_date"] if track_first else []),
    )


def array_metric_explode(
    df: DataFrame, array: str, by: Sequence[str] = (), month: str = "month_start", value: str = "value"
) -> DataFrame:
    """Array columns summed over all entities and turned back into (date, value) rows, any length."""
    return (
        df.select(*by, month, F.posexplode(array).alias("__i", "__v"))
        .groupBy(*by, month, "__i")
        .agg(F.sum("__v").alias(value))
        .select(*by, F.date_add(F.col(month), F.col("__i")).alias("date"), value)
    )


def first_days_sum(df: DataFrame, array: str, month: str, names: Sequence[str]) -> DataFrame:
    """Sum of the first elements over all rows of a month; arrays that are too short count as zero."""
    sums = [
        F.sum(F.coalesce(F.get(array, F.lit(i)), F.lit(0))).alias(name) for i, name in enumerate(names)
    ]
    return df.groupBy(month).agg(*sums)


def monthly_user_site_hits(df: DataFrame, ds: str) -> DataFrame:
    """Hits on the first three days of each month for one partition date."""
    names = ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"]
    return first_days_sum(df.where(F.col("date_partition") == ds), "hit_array", "month_start", names)


def array_lengths(df: DataFrame, array: str) -> DataFrame:
    """Row count per array length; one length per month is the invariant."""
    return df.groupBy(F.size(array).alias("length")).agg(F.count(F.lit(1)).alias("num_rows"))
