"""Data-quality checks. Each returns a small DataFrame; ``assert_*`` raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def freshness(df: DataFrame, ts: str, expected: str, min_rows: int = 1) -> DataFrame:
    """Latest timestamp and row count, flagged when older than ``expected`` or below ``min_rows``."""
    out = df.agg(F.max(ts).alias("latest"), F.count(F.lit(1)).alias("num_rows"))
    due = F.lit(expected).cast(df.schema[ts].dataType)
    return out.select(
        "latest",
        "num_rows",
        F.coalesce(F.col("latest") < due, F.lit(True)).alias("is_late"),
        (F.col("num_rows") < min_rows).alias("is_short"),
    )


# What a text has to look like before a cast to the type can succeed. A failed cast costs an exception per
# value, so texts that cannot pass are told apart by their look first.
LOOKS = {
    T.IntegralType: r"^\s*[+-]?[0-9]+\s*$",
    T.FractionalType: r"^\s*[+-]?([0-9.]|[iI][nN][fF]|[nN][aA][nN])",
    T.DateType: r"^\s*[+-]?[0-9]{4}",
    T.TimestampType: r"^\s*([+-]?[0-9]{4}|T?[0-9]{1,2}:)",
    T.TimestampNTZType: r"^\s*[+-]?[0-9]{4}",
}


def fits(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """Whether a value that is not NULL casts to ``kind``."""
    value = F.col(f"`{name}`")
    cast = value.try_cast(kind).isNotNull()
    look = next((p for k, p in LOOKS.items() if isinstance(kind, k)), None)
    if look is None or not isinstance(df.schema[name].dataType, T.StringType):
        return cast
    return F.when(value.rlike(look), cast).otherwise(False)


def schema_conformance(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema``: NULLs where a value is required, and values that do not cast. One pass."""
    checks = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast("string")
        required = F.lit(0).cast("long") if f.nullable else F.count_if(value.isNull())
        bad = value.isNotNull() & ~fits(df, f.name, f.dataType) if f.name in df.columns else F.lit(False)
        castable = F.count_if(bad)
        checks.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.name in df.columns).alias("present"),
                required.alias("missing_required"),
                castable.alias("bad_values"),
            )
        )
    return df.agg(F.array(*checks).alias("__checks")).select(F.inline("__checks"))


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split rows into (conforming rows cast to ``schema``, quarantined rows as they came)."""
    ok = F.lit(True)
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        good = value.isNull() | fits(df, f.name, f.dataType)
        ok = ok & (good if f.nullable else good & value.isNotNull())
    marked = df.withColumn("__ok", ok)
    casts = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return marked.where("__ok").select(*casts), marked.where(~F.col("__ok")).drop("__ok")


def assert_schema(df: DataFrame, schema: T.StructType) -> None:
    """Raise if any required value is missing or any value does not cast."""
    bad = schema_conformance(df, schema).where(
        ~F.col("present") | (F.col("missing_required") > 0) | (F.col("bad_values") > 0)
    )
    columns = [r["column"] for r in bad.select("column").take(len(schema.fields))]
    if columns:
        raise ValueError(f"columns that violate the schema: {', '.join(columns)}")


def volume_anomaly(
    df: DataFrame, date: str, value: str, keys: Sequence[str] = (), window: int = 7, limit: float = 3.0
) -> DataFrame:
    """Daily values against mean and deviation of the ``window`` rows before. ``df`` is at daily grain."""
    trailing = W.partitionBy(*(keys or [F.lit(1)])).orderBy(date).rowsBetween(-window, -1)
    out = df.withColumns(
        {
            "trailing_mean": F.avg(value).over(trailing),
            "trailing_std": F.stddev_samp(value).over(trailing),
        }
    )
    z = F.try_divide(F.col(value) - F.col("trailing_mean"), F.col("trailing_std"))
    return out.withColumn("z_score", z).withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """Totals that differ between two tables with one row per key; a missing side counts as zero."""
    a = left.select(*keys, F.col(value).alias("left_value"))
    b = right.select(*keys, F.col(value).alias("right_value"))
    difference = F.coalesce("left_value", F.lit(0)) - F.coalesce("right_value", F.lit(0))
    return (
        a.join(b, list(keys), "full_outer")
        .withColumn("difference", difference)
        .where(F.abs("difference") > tolerance)
    )


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows with a NULL in the key, repeated keys and rows beyond the first of their key."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(has_null).alias("__null"))
    total = F.sum("__n")
    return counts.agg(
        F.coalesce(total, F.lit(0)).alias("num_rows"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("__n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    report = check_keys(df, keys).first()
    if report["null_keys"] or report["repeated_keys"]:
        raise ValueError(f"{report['repeated_keys']} repeated keys, {report['null_keys']} rows with NULL keys")


def missing_periods(df: DataFrame, keys: Sequence[str], period: str, step: Column | None = None) -> DataFrame:
    """Periods between the first and last of each key that have no row.

    A key collects its distinct periods, of which there are as many as the calendar holds; the gaps are
    an array difference, so there is no join with a calendar.
    """
    seen = df.select(*keys, period).distinct()
    groups = seen.groupBy(*keys) if keys else seen.groupBy()
    bounds = groups.agg(
        F.min(period).alias("__low"), F.max(period).alias("__high"), F.collect_list(period).alias("__seen")
    ).where(F.col("__low").isNotNull())
    full = F.sequence("__low", "__high") if step is None else F.sequence("__low", "__high", step)
    return bounds.select(*keys, F.explode(F.array_except(full, "__seen")).alias(period))


def bad_labels(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed labels, with their counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("num_rows"))
    )
