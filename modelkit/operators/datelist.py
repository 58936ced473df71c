"""Cumulative lists of active dates per entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_days(events: DataFrame, keys: Sequence[str], ts: str, name: str = "days") -> DataFrame:
    """Ascending distinct active days per entity.

    Days are folded into one bit mask per entity and month with map-side aggregation, so the shuffle
    carries one bigint per entity-month however many events there are; an entity then collects one
    element per month.
    """
    day = F.to_date(ts)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth("__day") - 1)
    months = (
        events.where(F.col(ts).isNotNull())
        .where(~_any_null(keys))
        .select(*keys, day.alias("__day"))
        .groupBy(*keys, F.trunc("__day", "month").alias("__month"))
        .agg(F.bit_or(bit).alias("__bits"))
    )
    days = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(30)),
            lambda i: F.when(
                F.call_function("getbit", F.col("__bits"), i) == 1, F.date_add(F.col("__month"), i)
            ),
        ),
        lambda d: d.isNotNull(),
    )
    return (
        months.select(*keys, "__month", days.alias("__days"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("__month", "__days"))).alias("__months"))
        .select(*keys, F.flatten("__months.__days").alias(name))
    )


def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def active_on(events: DataFrame, keys: Sequence[str], ts: str, ds: dt.date, name: str = "date_active") -> DataFrame:
    """Entities active on one day. The filter compares the timestamp with a range, so it is pushed to the scan."""
    low, high = F.lit(ds.isoformat()), F.lit((ds + dt.timedelta(days=1)).isoformat())
    kind = events.schema[ts].dataType
    return (
        events.where((F.col(ts) >= low.cast(kind)) & (F.col(ts) < high.cast(kind)))
        .where(~_any_null(keys))
        .select(*keys)
        .distinct()
        .withColumn(name, F.lit(ds).cast("date"))
    )


def datelist_step(
    prev: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    ds: dt.date,
    order: str = "desc",
    name: str = "dates_active",
    today_name: str = "date_active",
) -> DataFrame:
    """Add day ``ds`` to the lists of the previous slice. Applying a day twice changes nothing."""
    p = prev.select(*keys, F.col(name).alias("__past"))
    t = today.select(*keys, F.col(today_name).cast("date").alias("__today"))
    past = F.coalesce("__past", F.array().cast("array<date>"))
    day = F.when(F.col("__today").isNull(), F.array().cast("array<date>")).otherwise(F.array("__today"))
    joined = F.array_union(past, day) if order == "asc" else F.array_union(day, past)
    return p.join(t, list(keys), "full_outer").select(
        *keys, joined.alias(name), F.lit(ds).cast("date").alias("date")
    )


def datelist_backfill(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    last: dt.date | None = None,
    order: str = "desc",
    name: str = "dates_active",
    snapshot_only: bool = False,
) -> DataFrame:
    """Lists for every day from an entity's first activity to ``last`` (default: latest day seen)."""
    end = F.lit(last).cast("date") if last is not None else events.agg(F.to_date(F.max(ts))).scalar()
    entity = active_days(events, keys, ts, "__days").withColumn("__end", end)
    first = F.try_element_at("__days", F.lit(1))
    started = entity.where(first <= F.col("__end"))
    start = F.col("__end") if snapshot_only else first
    spine = started.withColumn("date", F.explode(F.sequence(start, F.col("__end"))))
    seen = F.filter("__days", lambda d: d <= F.col("date"))
    return spine.select(*keys, (seen if order == "asc" else F.reverse(seen)).alias(name), "date")


def datelist_map(df: DataFrame, keys: Sequence[str], kind: str, name: str) -> DataFrame:
    """One row per entity with a map from ``kind`` (a closed set such as browser types) to its dates."""
    return df.groupBy(*keys, "date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, name)))).alias(name)
    )
