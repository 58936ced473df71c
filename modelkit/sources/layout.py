"""Space-filling layout with file skipping: rows in Morton order of several columns, and scans that open the files they need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quantile_ranks(df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Add ``__rank_<column>``: in which of 2**bits about equally full ranges of the column a value lies; NULL is in the first.

    The borders are approximate percentiles of all rows. They decide where a row is stored, never whether it is found.
    """
    shares = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
    number = {c: F.col(c).cast("double") if df.schema[c].dataType.typeName() not in ("date", "timestamp", "timestamp_ntz") else F.unix_seconds(F.col(c).cast("timestamp")).cast("double") for c in columns}
    borders = df.agg(F.struct(*[F.percentile_approx(number[c], shares).alias(c) for c in columns]).alias("b")).scalar()
    out = df.withColumn("__borders", borders)
    for c in columns:
        edge, value = F.col("__borders")[c], F.col(f"__value_{c}")
        out = out.withColumn(f"__value_{c}", number[c])
        rank = F.size(F.filter(edge, lambda e: e <= value))  # noqa: B023
        out = out.withColumn(f"__rank_{c}", F.coalesce(F.when(F.col(f"__value_{c}").isNotNull(), rank), F.lit(0)))
    return out.drop("__borders", *[f"__value_{c}" for c in columns])


def morton(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of all ranks in turn, the highest ones first: rows that are near in every column get near numbers."""
    code = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.call_function("shiftright", rank.cast("long"), F.lit(bit)).bitwiseAND(1)
            code = code.bitwiseOR(F.call_function("shiftleft", one, F.lit(bit * len(ranks) + place)))
    return code


def write_morton(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6) -> None:
    """Write ``df`` in ``files`` ranges of Morton order of numbers, dates or times. Ties are broken by the columns themselves, so equal codes may be split."""
    ranked = quantile_ranks(df, columns, bits).withColumn("__code", morton([F.col(f"__rank_{c}") for c in columns], bits))
    laid = ranked.repartitionByRange(files, "__code", *columns).sortWithinPartitions("__code", *columns)
    laid.drop("__code", *[f"__rank_{c}" for c in columns]).write.parquet(path)


def write_file_ranges(spark: SparkSession, path: str, columns: Sequence[str], target: str) -> None:
    """Write the statistics of a table's files: rows, NULLs, lowest and highest value of each column, one row per file."""
    rows = spark.read.parquet(path)
    parts = [F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("size")]
    for c in columns:
        parts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*parts).write.parquet(target)


def files_for(ranges: DataFrame, bounds: Mapping[str, tuple[object, object]]) -> list[str]:
    """Names of the files that may hold rows with every column within its bounds (inclusive; None is no bound)."""
    fits = F.lit(True)
    for c, (low, high) in bounds.items():
        fits = fits & F.col(f"min_{c}").isNotNull()
        if low is not None:
            fits = fits & (F.col(f"max_{c}") >= F.lit(low))
        if high is not None:
            fits = fits & (F.col(f"min_{c}") <= F.lit(high))
    return sorted(r["file"] for r in ranges.where(fits).select("file").collect())


def read_within(spark: SparkSession, path: str, ranges: DataFrame, bounds: Mapping[str, tuple[object, object]]) -> DataFrame:
    """The rows within the bounds, from the files that may hold some; the others are not opened."""
    files = files_for(ranges, bounds)
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in bounds.items():
        if low is not None:
            rows = rows.where(F.col(c) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(c) <= F.lit(high))
    return rows
