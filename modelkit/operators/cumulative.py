"""Cumulative dimension tables: one row per entity and period, holding the history to date.

``step`` adds one period to yesterday's table; ``backfill`` builds every period in one plan with a
single shuffle on the entity. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.functions.scalars import band, safe_ratio

PLAYER_BANDS = ((20, "star"), (15, "good"), (10, "average"))
FILM_BANDS = ((8, "star"), (7, "good"), (6, "average"))


@dataclass(frozen=True)
class Cumulative:
    """Shape of a cumulative table.

    ``stats`` are the fields of one history element (the period first); ``measure`` is the field that
    decides the class; ``attrs`` are static attributes of the entity.
    """

    keys: tuple[str, ...]
    attrs: tuple[str, ...]
    period: str
    stats: tuple[str, ...]
    measure: str
    bands: tuple[tuple[float, str], ...] = PLAYER_BANDS
    default: str = "bad"
    history: str = "season_stats"
    label: str = "scoring_class"
    current: str = "current_season"
    since: str = "years_since_last_active"

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.attrs, self.history, self.label, self.since, self.current, "is_active"]


def cumulate_step(prev: DataFrame, today: DataFrame, spec: Cumulative, at: int) -> DataFrame:
    """Full outer join of the previous slice with this period's rows, one row per entity on each side.

    Known attributes win over new ones, the class is carried while the entity is absent, and the counter
    of absent periods restarts at zero when it returns.
    """
    p = prev.select(*spec.keys, *[F.col(c).alias(f"p_{c}") for c in spec.columns if c not in spec.keys])
    t = today.where(F.col(spec.period) == at).select(
        *spec.keys,
        *[F.col(c).alias(f"t_{c}") for c in spec.attrs],
        F.struct(*spec.stats).alias("t_stats"),
    )
    present = F.col("t_stats").isNotNull()
    past = F.col(f"p_{spec.history}")
    element = F.array("t_stats")
    history = (
        F.when(past.isNull(), element).when(present, F.concat(past, element)).otherwise(past)
    )
    return p.join(t, list(spec.keys), "full_outer").select(
        *spec.keys,
        *[F.coalesce(f"p_{c}", f"t_{c}").alias(c) for c in spec.attrs],
        history.alias(spec.history),
        F.when(present, band(F.col("t_stats")[spec.measure], spec.bands, spec.default))
        .otherwise(F.col(f"p_{spec.label}"))
        .alias(spec.label),
        F.when(present, 0).otherwise(F.coalesce(f"p_{spec.since}", F.lit(0)) + 1).cast("int").alias(spec.since),
        F.lit(at).cast("int").alias(spec.current),
        present.alias("is_active"),
    )


def cumulate_backfill(src: DataFrame, spec: Cumulative, last: int | None = None, snapshot_only: bool = False) -> DataFrame:
    """Every period from an entity's first appearance to ``last`` (default: latest period in ``src``).

    ``src`` holds one row per entity and period, so a group collects at most as many elements as there
    are periods. History to date is a prefix of that one array: no window, no join with a calendar.
    ``snapshot_only`` keeps only the last period, whose size does not grow with the period count.
    """
    end = F.lit(last).cast("int") if last is not None else src.agg(F.max(spec.period).cast("int")).scalar()
    element = F.struct(F.col(spec.period), *[F.col(c) for c in spec.stats if c != spec.period])
    entity = src.groupBy(*spec.keys).agg(
        *[F.max(c).alias(c) for c in spec.attrs],
        F.array_sort(F.collect_list(element)).alias("__all"),
        F.min(spec.period).cast("int").alias("__first"),
    )
    rows = entity.withColumn("__end", end).where(F.col("__first") <= F.col("__end"))
    start = F.col("__end") if snapshot_only else F.col("__first")
    spine = rows.withColumn(spec.current, F.explode(F.sequence(start, F.col("__end"))))
    current = F.col(spec.current)
    with_history = spine.withColumn("__past", F.filter("__all", lambda s: s[spec.period] <= current))
    newest = F.try_element_at("__past", F.lit(-1))
    shaped = F.transform("__past", lambda s: F.struct(*[s[c].alias(c) for c in spec.stats]))
    return with_history.select(
        *spec.keys,
        *spec.attrs,
        shaped.alias(spec.history),
        band(newest[spec.measure], spec.bands, spec.default).alias(spec.label),
        (current - newest[spec.period]).cast("int").alias(spec.since),
        current,
        (newest[spec.period] == current).alias("is_active"),
    )


def snapshot_at(base: DataFrame | None, changes: DataFrame, spec: Cumulative, at: int) -> DataFrame:
    """The snapshot of period ``at`` from an earlier snapshot and the changes since then.

    ``changes`` holds one row per entity and period in which something happened (the columns of ``src`` of
    ``cumulate_backfill``), so a history stores each element once instead of once per later period. ``base`` is a snapshot
    of any earlier period (its ``spec.current``), or None. Entities without a change since then are carried on.
    """
    if base is None:
        return cumulate_backfill(changes, spec, at, snapshot_only=True)
    since_base = base.agg(F.max(spec.current)).scalar()
    later = changes.withColumn("__base", since_base).where((F.col(spec.period) > F.col("__base")) & (F.col(spec.period) <= at)).drop("__base")
    new = cumulate_backfill(later, spec, at, snapshot_only=True)
    new = new.select(*spec.keys, *[F.col(c).alias(f"t_{c}") for c in spec.columns if c not in spec.keys])
    old = base.select(*spec.keys, *[F.col(c).alias(f"p_{c}") for c in spec.columns if c not in spec.keys])
    changed = F.col(f"t_{spec.current}").isNotNull()
    past, more = F.col(f"p_{spec.history}"), F.col(f"t_{spec.history}")
    carried = F.col(f"p_{spec.since}") + F.lit(at) - F.col(f"p_{spec.current}")
    still = F.col(f"p_{spec.current}") == at
    return old.join(new, list(spec.keys), "full_outer").select(
        *spec.keys,
        *[F.coalesce(f"p_{c}", f"t_{c}").alias(c) for c in spec.attrs],
        F.when(past.isNull(), more).when(changed, F.concat(past, more)).otherwise(past).alias(spec.history),
        F.when(changed, F.col(f"t_{spec.label}")).otherwise(F.col(f"p_{spec.label}")).alias(spec.label),
        F.when(changed, F.col(f"t_{spec.since}")).otherwise(carried).cast("int").alias(spec.since),
        F.lit(at).cast("int").alias(spec.current),
        F.when(changed, F.col("t_is_active")).otherwise(still & F.col("p_is_active")).alias("is_active"),
    )


def gaps(table: DataFrame, src: DataFrame, spec: Cumulative, last: int) -> DataFrame:
    """(keys, __from): entities whose rows in a table of all periods are not complete up to ``last``, and the first period missing."""
    first = src.where(F.col(spec.period) <= last).groupBy(*spec.keys).agg(F.min(spec.period).cast("int").alias("__first"))
    # As many periods as the calendar has.
    have = table.groupBy(*spec.keys).agg(F.collect_set(F.col(spec.current)).alias("__have"))
    none = F.array().cast("array<int>")
    missing = F.array_except(F.sequence("__first", F.lit(last)), F.coalesce("__have", none))
    return first.join(have, list(spec.keys), "left").select(*spec.keys, F.array_min(missing).alias("__from")).where(F.col("__from").isNotNull())


def repair(table: DataFrame, src: DataFrame, spec: Cumulative, last: int) -> DataFrame:
    """A table of all periods with its gaps filled: only entities with a gap are replayed, and only from the first gap on.

    Rows before an entity's first gap are kept as they are, those after it follow from it and are made anew. Without
    gaps nothing is replayed. The result equals a full backfill if the kept rows do.
    """
    broken = gaps(table, src, spec, last)
    keys = list(spec.keys)
    kept = table.join(broken, keys, "left").where(F.col("__from").isNull() | (F.col(spec.current) < F.col("__from"))).drop("__from")
    redone = cumulate_backfill(src.join(broken.select(*keys), keys, "left_semi"), spec, last)
    redone = redone.join(broken, keys).where(F.col(spec.current) >= F.col("__from")).drop("__from")
    return kept.unionByName(redone)


def detail_totals(detail: DataFrame, keys: Sequence[str], attrs: Sequence[str], period: str, measure: str) -> DataFrame:
    """Detail rows reduced to one row per entity and period: attributes, sum and count of ``measure``.

    Combined before the shuffle, so an entity may have any number of detail rows. The rows themselves are the
    history: those of an entity up to a period are ``detail.where(period <= ...)``, and no row has to hold them.
    """
    return detail.groupBy(*keys, period).agg(
        *[F.max(c).alias(c) for c in attrs], F.sum(measure).alias("__sum"), F.count(measure).alias("__n"), F.count(F.lit(1)).alias("__rows")
    )


def cumulate_detail_step(prev: DataFrame, totals: DataFrame, spec: Cumulative, at: int) -> DataFrame:
    """Cumulative step over detail totals: names of today first, class from today's average.

    An entity is active when it has detail rows, and keeps its class while none of them has a ``measure``.
    ``spec.history`` is the number of detail rows to date.
    """
    keys = list(spec.keys)
    today = totals.where(F.col(spec.period) == at).select(
        *keys, F.try_divide("__sum", "__n").alias("__avg"), F.col("__rows"), *[F.col(c).alias(f"t_{c}") for c in spec.attrs]
    )
    before = prev.select(
        *keys, F.col(spec.label).alias("__label"), F.col(spec.history).alias("__before"), *[F.col(c).alias(f"p_{c}") for c in spec.attrs]
    )
    label = F.when(F.col("__avg").isNull() & F.col("__label").isNotNull(), F.col("__label")).otherwise(
        band(F.col("__avg"), spec.bands, spec.default)
    )
    return before.join(today, keys, "full_outer").select(
        *keys,
        *[F.coalesce(f"t_{c}", f"p_{c}").alias(c) for c in spec.attrs],
        (F.coalesce("__before", F.lit(0)) + F.coalesce("__rows", F.lit(0))).alias(spec.history),
        label.alias(spec.label),
        F.lit(at).cast("int").alias(spec.current),
        F.col("__rows").isNotNull().alias("is_active"),
    )


def cumulate_detail_backfill(totals: DataFrame, spec: Cumulative, last: int | None = None) -> DataFrame:
    """All periods of the detail form. An entity collects one element per period, which the calendar bounds."""
    keys = list(spec.keys)
    end = F.lit(last).cast("int") if last is not None else totals.agg(F.max(spec.period).cast("int")).scalar()
    element = F.struct(F.col(spec.period), F.try_divide("__sum", "__n").alias("__avg"), F.col("__rows"), *[F.col(c) for c in spec.attrs])
    spine = (
        totals.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(element)).alias("__all"), F.min(spec.period).cast("int").alias("__first"))
        .withColumn("__end", end)
        .where(F.col("__first") <= F.col("__end"))
        .withColumn(spec.current, F.explode(F.sequence("__first", "__end")))
    )
    current = F.col(spec.current)
    seen = spine.withColumn("__past", F.filter("__all", lambda s: s[spec.period] <= current))
    newest = F.try_element_at("__past", F.lit(-1))
    rated = F.filter("__past", lambda s: s["__avg"].isNotNull())
    return seen.select(
        *keys,
        *[newest[c].alias(c) for c in spec.attrs],
        F.aggregate("__past", F.lit(0).cast("long"), lambda n, s: n + s["__rows"]).alias(spec.history),
        band(F.try_element_at(rated, F.lit(-1))["__avg"], spec.bands, spec.default).alias(spec.label),
        current,
        (newest[spec.period] == current).alias("is_active"),
    )


def history_ratio(df: DataFrame, history: str, field: str, name: str = "growth") -> DataFrame:
    """Newest over oldest value of a field of the history array (a zero start counts as one)."""
    newest = F.try_element_at(history, F.lit(-1))[field]
    oldest = F.try_element_at(history, F.lit(1))[field]
    return df.withColumn(name, safe_ratio(newest, oldest))


def history_rows(df: DataFrame, keep: Sequence[str], history: str, outer: bool = False) -> DataFrame:
    """History back to one row per element. Narrow."""
    call = "inline_outer" if outer else "inline"
    return df.select(*keep, F.expr(f"{call}({history})"))
