"""Variant assignment, exposures and readouts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 10_000
# Cell plans in percent.
EVEN_SPLIT = (("control", 50), ("test", 50))
THREE_WAY = (("control", 33), ("test_a", 33), ("test_b", 33))
HALF_CONTROL = (("control", 50), ("test_a", 25), ("test_b", 25))
LARGER_CONTROL = (("control", 40), ("test_a", 30), ("test_b", 30))


def slot(unit: Column, experiment: str) -> Column:
    """Stable slot in [0, 10000) from the experiment name and the unit's id."""
    digest = F.md5(F.concat(F.lit(f"{experiment}:"), unit.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(SLOTS))


def variant(unit: Column, experiment: str, weights: Sequence[tuple[str, int]]) -> Column:
    """Variant by cumulative weight; weights are relative, so 33/33/33 covers every unit."""
    total, seen, out = sum(w for _, w in weights), 0, None
    position = slot(unit, experiment)
    for name, weight in weights[:-1]:
        seen += weight
        hit = position < (seen * SLOTS) // total
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(weights[-1][0]) if out is None else out.otherwise(weights[-1][0])


def assign_variants(
    df: DataFrame, experiment: str, weights: Sequence[tuple[str, int]], unit: str = "user_id"
) -> DataFrame:
    """Add experiment and variant. A pure function of the id: no state, no shuffle."""
    return df.withColumns(
        {"experiment": F.lit(experiment), "variant": variant(F.col(unit), experiment, weights)}
    )


def first_exposure(df: DataFrame, ts: str, unit: str = "user_id") -> DataFrame:
    """First exposure per unit and experiment. Variants must be a function of the unit, so the earliest
    time and the variant are plain minima."""
    return df.groupBy(unit, "experiment").agg(F.min(ts).alias("first_exposed_at"), F.min("variant").alias("variant"))


def experiment_readout(units: DataFrame, metric: str, control: str = "control") -> DataFrame:
    """Size, mean, variance, lift and z score of a per-unit metric, by variant against ``control``.

    Units reduce to one row per variant before variants are compared.
    """
    stats = units.groupBy("experiment", "variant").agg(
        F.count(metric).alias("units"), F.avg(metric).alias("mean"), F.var_samp(metric).alias("variance")
    )
    variants = W.partitionBy("experiment")
    is_control = F.col("variant") == control
    base_n, base_mean, base_variance = (
        F.max(F.when(is_control, F.col(c))).over(variants) for c in ("units", "mean", "variance")
    )
    error = F.sqrt(F.try_divide("variance", "units") + F.try_divide(base_variance, base_n))
    difference = F.col("mean") - base_mean
    return stats.select(
        "experiment",
        "variant",
        "units",
        "mean",
        "variance",
        F.when(~is_control, F.try_divide(difference, base_mean)).alias("lift"),
        F.when(~is_control, F.try_divide(difference, error)).alias("z_score"),
    )


def retention_readout(
    exposures: DataFrame, activity: DataFrame, ts: str, days: Sequence[int] = (7, 30, 60, 90), unit: str = "user_id"
) -> DataFrame:
    """Share of exposed units active again at least ``d`` days after exposure, by variant.

    Activity reduces to the latest time per unit before the join, so both sides have one row per unit.
    """
    seen = activity.groupBy(unit).agg(F.max(ts).alias("__last"))
    gap = F.datediff("__last", "first_exposed_at")
    kept = [
        (F.count_if(gap >= d) / F.count(F.lit(1))).alias(f"retained_{d}d") for d in days
    ]
    return (
        exposures.join(seen, unit, "left")
        .groupBy("experiment", "variant")
        .agg(F.count(F.lit(1)).alias("units"), *kept)
    )


def poisson_weight(unit: Column, replicate: Column, seed: str) -> Column:
    """How often a unit is drawn in a replicate: Poisson with mean 1, from a hash of both, so reruns and partitions agree."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), replicate.cast("string"), unit.cast("string")))
    uniform = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    weight, seen, term = F.lit(0), 0.0, math.exp(-1)
    for k in range(1, 10):
        seen += term
        weight = weight + (uniform >= int(seen * (1 << 32))).cast("int")
        term /= k
    return weight


def bootstrap_readout(
    units: DataFrame, metric: str, covariate: str, unit: str = "user_id", control: str = "control", replicates: int = 200, seed: str = "bootstrap"
) -> DataFrame:
    """Difference of each variant to ``control`` with an interval, adjusted by a covariate known before the experiment.

    ``units`` has one row per unit and experiment with whole-number ``metric`` and ``covariate`` (counts, cents). The metric is
    freed of what the covariate explains: slope times the difference of its means. In every replicate each unit counts with a hashed
    Poisson weight; sums per variant and replicate are combined before the shuffle, so the units move nowhere. Returns
    experiment, variant, units, difference, adjusted, low, high (the middle 95 per cent of the replicates of ``adjusted``).
    """
    known = units.where(F.col(metric).isNotNull() & F.col(covariate).isNotNull())
    y, x = F.col(metric).cast("decimal(38,0)"), F.col(covariate).cast("decimal(38,0)")
    drawn = known.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    # Replicate 0 is the sample itself.
    weight = F.when(F.col("__r") == 0, F.lit(1)).otherwise(poisson_weight(F.col(unit), F.col("__r"), seed))
    w = weight.cast("decimal(38,0)")
    sums = drawn.groupBy("experiment", "variant", "__r").agg(
        F.sum(w).alias("n"), F.sum(w * y).alias("y"), F.sum(w * x).alias("x"), F.sum(w * x * y).alias("xy"), F.sum(w * x * x).alias("xx")
    )
    values = sums.select("experiment", "variant", "__r", *[F.col(c).cast("double").alias(c) for c in ("n", "y", "x", "xy", "xx")])
    # One slope for all variants, from the sample itself.
    whole = W.partitionBy("experiment")
    own = F.col("__r") == 0
    total = {c: F.sum(F.when(own, F.col(c))).over(whole) for c in ("n", "y", "x", "xy", "xx")}
    slope = F.try_divide(total["xy"] - total["x"] * total["y"] / total["n"], total["xx"] - total["x"] * total["x"] / total["n"])
    means = values.withColumn("slope", F.coalesce(slope, F.lit(0.0))).withColumn("my", F.try_divide("y", "n")).withColumn("mx", F.try_divide("x", "n"))
    base = W.partitionBy("experiment", "__r")
    is_control = F.col("variant") == control
    dy, dx = (F.col(c) - F.max(F.when(is_control, F.col(c))).over(base) for c in ("my", "mx"))
    apart = means.withColumn("difference", dy).withColumn("adjusted", dy - F.col("slope") * dx).where(~is_control)
    resampled = F.when(~own, F.col("adjusted"))
    return apart.groupBy("experiment", "variant").agg(
        F.max(F.when(own, F.col("n"))).cast("long").alias("units"),
        F.max(F.when(own, F.col("difference"))).alias("difference"),
        F.max(F.when(own, F.col("adjusted"))).alias("adjusted"),
        F.percentile(resampled, F.lit(0.025)).alias("low"),
        F.percentile(resampled, F.lit(0.975)).alias("high"),
    )
