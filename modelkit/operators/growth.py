"""Growth accounting, retention and state changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.functions.scalars import same
from modelkit.operators.datelist import active_days

ACTIVE_STATES = ("New", "Retained", "Resurrected")


def _daily_state(known: Column, today: Column, last: Column, snapshot: Column) -> Column:
    """State of a day. ``last`` is the last activity before it, ``snapshot`` the previous table date."""
    yesterday = F.date_sub(today, 1)
    return (
        F.when(~known, "New")
        .when(last == yesterday, "Retained")
        .when(last < yesterday, "Resurrected")
        .when(today.isNull() & (last == snapshot), "Churned")
        .otherwise("Stale")
    )


def _weekly_state(known: Column, today: Column, last: Column, snapshot: Column) -> Column:
    return (
        F.when(~known, "New")
        .when(last < F.date_sub(today, 7), "Resurrected")
        .when(today.isNull() & (last == F.date_sub(snapshot, 7)), "Churned")
        .when(F.date_add(F.coalesce(today, last), 7) >= snapshot, "Retained")
        .otherwise("Stale")
    )


def growth_step(prev: DataFrame, today: DataFrame, ds: dt.date, key: str = "user_id") -> DataFrame:
    """Add day ``ds`` to yesterday's table. ``today`` has one row (``key``, ``date_active``) per active user."""
    p = prev.select(
        key,
        F.lit(True).alias("__known"),
        *[F.col(c).alias(f"p_{c}") for c in ("first_active_date", "last_active_date", "dates_active", "date")],
    )
    t = today.select(key, F.col("date_active").cast("date").alias("__today"))
    known, day = F.coalesce("__known", F.lit(False)), F.col("__today")
    last, snapshot = F.col("p_last_active_date"), F.col("p_date")
    past = F.coalesce("p_dates_active", F.array().cast("array<date>"))
    return p.join(t, key, "full_outer").select(
        key,
        F.coalesce("p_first_active_date", day).alias("first_active_date"),
        F.coalesce(day, last).alias("last_active_date"),
        _daily_state(known, day, last, snapshot).alias("daily_active_state"),
        _weekly_state(known, day, last, snapshot).alias("weekly_active_state"),
        F.when(day.isNull(), past).otherwise(F.array_union(past, F.array(day))).alias("dates_active"),
        F.lit(ds).alias("date"),
    )


def growth_backfill(events: DataFrame, ts: str, key: str = "user_id", last: dt.date | None = None) -> DataFrame:
    """All days of all users in one plan: active days per user, then one row per day from the first on."""
    end = F.lit(last).cast("date") if last is not None else events.agg(F.to_date(F.max(ts))).scalar()
    users = active_days(events, [key], ts, "__days").withColumn("__end", end)
    first = F.try_element_at("__days", F.lit(1))
    spine = users.where(first <= F.col("__end")).withColumn("date", F.explode(F.sequence(first, F.col("__end"))))
    before = F.filter("__days", lambda d: d < F.col("date"))
    rows = spine.withColumns(
        {
            "__last": F.try_element_at(before, F.lit(-1)),
            "__today": F.when(F.array_contains("__days", F.col("date")), F.col("date")),
            "__snapshot": F.date_sub("date", 1),
        }
    )
    known, day, seen, snapshot = F.col("__last").isNotNull(), F.col("__today"), F.col("__last"), F.col("__snapshot")
    return rows.select(
        key,
        first.alias("first_active_date"),
        F.coalesce(day, seen).alias("last_active_date"),
        _daily_state(known, day, seen, snapshot).alias("daily_active_state"),
        _weekly_state(known, day, seen, snapshot).alias("weekly_active_state"),
        F.filter("__days", lambda d: d <= F.col("date")).alias("dates_active"),
        "date",
    )


def retention(growth: DataFrame) -> DataFrame:
    """Share of users active by days since their first activity."""
    active = F.count_if(F.col("daily_active_state").isin(*ACTIVE_STATES))
    return growth.groupBy(
        F.datediff("date", "first_active_date").cast("long").alias("days_since_first_active")
    ).agg((active / F.count(F.lit(1))).alias("pct_active"), F.count(F.lit(1)).alias("num_rows"))


PLAYING = ("New", "Continued Playing", "Returned from Retirement")


def _next_state(state: Column, active: Column, literal: bool) -> Column:
    """State after ``state``. A player who stayed retired may return, except in the ``literal`` form."""
    resting = ("Retired",) if literal else ("Retired", "Stayed Retired")
    return (
        F.when(state.isNull(), "New")
        .when(~active & state.isin(*PLAYING), "Retired")
        .when(active & state.isin(*PLAYING), "Continued Playing")
        .when(active & state.isin(*resting), "Returned from Retirement")
        .otherwise("Stayed Retired")
    )


def state_change_step(
    prev: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    at: int,
    period: str = "year",
    active: str = "is_active",
    literal: bool = False,
) -> DataFrame:
    """States of period ``at`` from those of the period before. Key columns may be NULL and match as such.

    A key missing from ``current`` counts as inactive; in the ``literal`` form it falls to the last case.
    """
    keys = list(keys)
    p = prev.select(*[F.col(k).alias(f"p_{k}") for k in keys], F.col("state").alias("p_state"))
    t = current.select(*[F.col(k).alias(f"t_{k}") for k in keys], F.col(active).alias("t_active"))
    match = same([F.col(f"p_{k}") for k in keys], [F.col(f"t_{k}") for k in keys])
    now = F.col("t_active") if literal else F.coalesce("t_active", F.lit(False))
    return p.join(t, match, "full_outer").select(
        *[F.coalesce(f"t_{k}", f"p_{k}").alias(k) for k in keys],
        _next_state(F.col("p_state"), now, literal).alias("state"),
        F.lit(at).cast("int").alias(period),
    )


def state_change_backfill(
    df: DataFrame, keys: Sequence[str], period: str, active: str = "is_active", literal: bool = False
) -> DataFrame:
    """States of all periods from a table with one row per key and period since the first appearance.

    A window holds one row per period of a key. The first period is New and counts as playing. In the
    ``literal`` form two idle periods in a row are final, which a running maximum records.
    """
    w = W.partitionBy(*keys).orderBy(period)
    position = F.row_number().over(w)
    played = F.when(position == 2, True).when(position > 2, F.lag(active).over(w))
    out = df.select(*keys, period, active).withColumn("__played", played)
    now, past = F.col(active), F.col("__played")
    idle = F.coalesce(~now & ~past, F.lit(False))
    final = F.max(idle).over(w.rowsBetween(W.unboundedPreceding, 0)) if literal else idle
    state = (
        F.when(past.isNull(), "New")
        .when(final, "Stayed Retired")
        .when(now & past, "Continued Playing")
        .when(now, "Returned from Retirement")
        .otherwise("Retired")
    )
    return out.withColumn("state", state).select(*keys, period, "state")
