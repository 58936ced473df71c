"""Distinct-user series behind dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_members(df: DataFrame, dim: str, user: str = "user_id", top: int = 10) -> DataFrame:
    """The ``top`` members of ``dim`` by distinct users, ties to the smaller member."""
    counts = df.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.count_distinct(user).alias("__users"))
    return counts.orderBy(F.col("__users").desc(), dim).limit(top).select(dim)


def monthly_actives(
    df: DataFrame, dim: str, ts: str = "event_time", user: str = "user_id", top: int = 10, where: Column | None = None
) -> DataFrame:
    """Distinct users per month for the leading members of ``dim``.

    Rows reduce to distinct (month, member, user) once; the ranking and the series both read that
    shuffle. The ranking has ``top`` rows, so it is always small enough to broadcast.
    """
    rows = df.where(F.col(dim).isNotNull())
    if where is not None:
        rows = rows.where(where)
    seen = rows.select(F.to_date(F.trunc(ts, "month")).alias("month"), dim, F.col(user).alias("__user")).distinct()
    leading = F.broadcast(top_members(seen, dim, "__user", top))
    return seen.join(leading, dim).groupBy("month", dim).agg(F.count("__user").alias("users"))


def actives_by(
    df: DataFrame,
    dims: Sequence[str],
    user: str = "user_id",
    where: Column | None = None,
    min_users: int | None = None,
    max_users: int | None = None,
) -> DataFrame:
    """Distinct users per member of each dimension as (dimension, member, users), with row and count filters.

    All dimensions are counted in one pass over the rows; NULL members are excluded.
    """
    rows = df if where is None else df.where(where)
    members = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member")) for d in dims])
    out = (
        rows.select(user, F.inline(members))
        .where(F.col("member").isNotNull())
        .groupBy("dimension", "member")
        .agg(F.count_distinct(user).alias("users"))
    )
    if min_users is not None:
        out = out.where(F.col("users") >= min_users)
    if max_users is not None:
        out = out.where(F.col("users") <= max_users)
    return out
