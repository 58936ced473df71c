"""Funnel conversion: visits followed by a target within a user's day, and ordered steps within a time window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.functions.skew import HOT_ROWS, _with_block, salted_join


def funnel(
    events: DataFrame,
    target: str,
    min_count: int = 100,
    user: str = "user_id",
    url: str = "url",
    ts: str = "event_time",
    include_last: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per url: distinct visits followed by another event of the same user that day, and the share
    followed by ``target``. Only urls that convert and have more than ``min_count`` visits are reported.

    A visit is followed by something exactly when it is earlier than the latest event (or latest target)
    of the user-day. Those two times are one aggregated row per user-day, so no pairs of events are
    built; the visits meet them in a join that splits very busy user-days. ``include_last`` also counts
    visits with nothing after them.
    """
    known = events.where(F.col(user).isNotNull()).select(
        user, F.to_date(ts).alias("__day"), F.col(ts).alias("__ts"), F.col(url).alias("url")
    )
    visits = known.distinct()
    ends = known.groupBy(user, "__day").agg(
        F.max("__ts").alias("__last"),
        F.max(F.when(F.col("url") == target, F.col("__ts"))).alias("__target"),
    )
    joined = salted_join(visits, ends, [user, "__day"], ["__ts", "url"], hot_rows=hot_rows, counted=known)
    counted = joined if include_last else joined.where(F.col("__ts") < F.col("__last"))
    share = F.count_if(F.col("__target") > F.col("__ts")) / F.count(F.lit(1))
    return (
        counted.groupBy("url")
        .agg(F.count(F.lit(1)).alias("visits"), share.alias("conversion"))
        .where((F.col("conversion") > 0) & (F.col("visits") > min_count))
    )


def furthest_steps(
    events: DataFrame,
    steps: Mapping[str, Column],
    within: str,
    user: str = "user_id",
    ts: str = "event_time",
    block: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """(user, step): the number of the furthest of the ordered ``steps`` that each user reached.

    Step k is reached by an event of each of the steps 1 to k, each strictly later than the one before, the last at most
    ``within`` (an interval) after the first. Other events may stand between. Users without a first step are
    left out, as are events without user or time.

    The events of a user are told by a partial state that merges over blocks of time: per step the latest begin of a run
    that got there inside the block, and per pair of steps how early a run that came in at the one gets to the other.
    With ``block`` (a non-decreasing expression of the time) users with more than ``hot_rows`` instants (all if
    None) are cut into blocks, one task's work each; a last fold takes the states of a user in order, as many as it has blocks.
    """
    conditions, n = list(steps.values()), len(steps)
    length, when = F.expr(f"INTERVAL {within}"), F.col("__ts")
    known = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    marked = known.select(user, F.col(ts).alias("__ts"), *[F.coalesce(c, F.lit(False)).alias(f"__is{k}") for k, c in enumerate(conditions, 1)])
    any_step = F.greatest(*[F.col(f"__is{k}") for k in range(1, n + 1)]) if n > 1 else F.col("__is1")
    # Events of one instant do not follow each other, so an instant is one row.
    instants = marked.where(any_step).groupBy(user, "__ts").agg(*[F.max(f"__is{k}").alias(f"__is{k}") for k in range(1, n + 1)])
    rows = instants.withColumn("__block", F.lit(None).cast("string")) if block is None else _with_block(
        instants.withColumnRenamed("__ts", ts), [user], block, hot_rows
    ).withColumnRenamed(ts, "__ts")
    scope = W.partitionBy(user, "__block")
    before = scope.orderBy("__ts").rowsBetween(W.unboundedPreceding, -1)

    # Latest begin of a run inside the block that reached step k with this event.
    rows = rows.withColumn("__run1", F.when(F.col("__is1"), when))
    for k in range(2, n + 1):
        begin = F.max(f"__run{k - 1}").over(before)
        rows = rows.withColumn(f"__begin{k}", begin)
        rows = rows.withColumn(f"__run{k}", F.when(F.col(f"__is{k}") & (F.col(f"__begin{k}") >= when - length), F.col(f"__begin{k}"))).drop(f"__begin{k}")
    # Earliest time at which a run that entered the block after step i reaches step k.
    for i in range(1, n):
        for k in range(i + 1, n + 1):
            fits = F.col(f"__is{k}") if k == i + 1 else F.col(f"__is{k}") & (when > F.col(f"__via{i}_{k - 1}"))
            rows = rows.withColumn(f"__via{i}_{k}", F.min(F.when(fits, when)).over(scope))
    via = {(i, k): f"__via{i}_{k}" for i in range(1, n) for k in range(i + 1, n + 1)}
    states = rows.groupBy(user, "__block").agg(
        *[F.max(f"__run{k}").alias(f"run{k}") for k in range(1, n + 1)], *[F.min(c).alias(f"via{i}_{k}") for (i, k), c in via.items()]
    )
    fields = [f"run{k}" for k in range(1, n + 1)] + [f"via{i}_{k}" for i, k in via]
    state = F.struct(F.col("__block").alias("block"), *fields)
    kind = events.schema[ts].dataType
    start = F.struct(*[F.lit(None).cast(kind).alias(f"run{k}") for k in range(1, n + 1)])

    def merge(have: Column, b: Column) -> Column:
        reached = []
        for k in range(1, n + 1):
            came = [F.when(b[f"via{i}_{k}"] <= have[f"run{i}"] + length, have[f"run{i}"]) for i in range(1, k)]
            reached.append(F.greatest(have[f"run{k}"], b[f"run{k}"], *came).alias(f"run{k}"))
        return F.struct(*reached)

    folded = states.groupBy(user).agg(F.array_sort(F.collect_list(state)).alias("__states")).select(user, F.aggregate("__states", start, merge).alias("__s"))
    step = F.coalesce(*[F.when(F.col(f"__s.run{k}").isNotNull(), F.lit(k)) for k in range(n, 0, -1)])
    return folded.select(user, step.alias("step")).where(F.col("step").isNotNull())


def step_funnel(furthest: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """(step, name, users, share): users that reached each step or a later one, and their share of the first step's."""
    names = F.array(*[F.lit(name) for name in steps])
    counts = furthest.groupBy("step").agg(F.count(F.lit(1)).alias("__users"))
    reached = counts.select(F.explode(F.sequence(F.lit(1), "step")).alias("step"), "__users").groupBy("step").agg(F.sum("__users").alias("users"))
    # One row per step: as many as the funnel has.
    first = F.max(F.when(F.col("step") == 1, F.col("users"))).over(W.partitionBy(F.lit(1)))
    return reached.select("step", F.get(names, F.col("step") - 1).alias("name"), "users", (F.col("users") / first).alias("share"))
