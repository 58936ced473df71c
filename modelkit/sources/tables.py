"""Batch sources and sinks: CSV, Parquet, catalog tables, bucketed tables, upsert, file statistics."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelkit.functions.scalars import same
from modelkit.functions.skew import measured_bytes
from modelkit.session import scratch_dir, settings


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema: one pass, no inference scan. Quotes inside values are doubled."""
    return spark.read.schema(schema).csv(path, header=True, escape='"')


def write_csv(df: DataFrame, path: str) -> None:
    """CSV as ``read_csv`` takes it."""
    df.write.csv(path, header=True, escape='"')


def read_csv_text(spark: SparkSession, path: str, day_of: str | None = None, day: str = "event_date") -> DataFrame:
    """CSV in which every column is text, with a derived day column when ``day_of`` names a timestamp."""
    df = spark.read.option("header", True).csv(path)
    return df if day_of is None else df.withColumn(day, F.to_date(F.col(day_of).try_cast("timestamp")))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def write_period(df: DataFrame, path: str, period: str | Sequence[str]) -> None:
    """Replace only the period partitions present in ``df``, so a re-run of a period is idempotent.

    Rows are clustered by period before the write; AQE splits a period that outgrows one task.
    """
    parts = [period] if isinstance(period, str) else list(period)
    (
        clustered(df, *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Mapping[str, Column] | Sequence[str] | None = None,
    path: str | None = None,
) -> None:
    """Create-as-select (``overwrite``) or append to a catalog table.

    ``partition_by`` may derive its columns, for example ``{"event_year": F.year("event_date")}``.
    """
    parts: list[str] = []
    if isinstance(partition_by, Mapping):
        df, parts = df.withColumns(dict(partition_by)), list(partition_by)
    elif partition_by:
        parts = list(partition_by)
    writer = df.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: later plans scan the files instead of computing ``df`` again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_overwrite(df: DataFrame, name: str) -> None:
    """Overwrite an existing table. ``insertInto`` is positional, so columns are put in table order."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("overwrite").insertInto(name)


def insert_period(df: DataFrame, name: str) -> None:
    """Replace the partitions of an existing partitioned table that occur in ``df``, and no others.

    ``df`` may read other partitions of the same table, as a daily step does.
    """
    spark = df.sparkSession
    columns = spark.table(name).columns
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.select(*columns).write.mode("overwrite").insertInto(name)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace rows of ``base`` with the same (null-safe) key; the rest stay."""
    fresh = updates.select(*[F.col(k).alias(f"__{k}") for k in keys])
    match = same([F.col(f"__{k}") for k in keys], [base[k] for k in keys])
    return updates.unionByName(base.join(fresh, match, "left_anti"))


def bucket_count(*frames: DataFrame, target_bytes: int = 256 << 20, least: int = 16) -> int:
    """Power of two that brings the largest frame's buckets to about ``target_bytes`` by measured size."""
    wanted = max(measured_bytes(df) for df in frames) // target_bytes
    count = least
    while count < wanted:
        count *= 2
    return count


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int | None = None, path: str | None = None, files_per_bucket: int = 1
) -> None:
    """Table bucketed and sorted on ``key``.

    Rows are hashed to buckets before the write, so a bucket is ``files_per_bucket`` files instead of one
    per task; several files of a bucket are written in parallel even if one key fills it. A bucket is the
    unit of work of a bucketed join, so the default number follows the size of ``df``; tables to be joined
    need the same number.
    """
    buckets = buckets or bucket_count(df)
    shard = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
    placed = df.repartition(buckets, key) if files_per_bucket == 1 else df.repartition(
        buckets * files_per_bucket, F.col(key), shard
    )
    writer = placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def file_stats(df: DataFrame) -> DataFrame:
    """Total bytes and file count behind a file-based frame, from the hidden ``_metadata`` column."""
    return (
        df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b"))
        .groupBy("p")
        .agg(F.max("b").alias("b"))
        .agg(F.sum("b").alias("size"), F.count(F.lit(1)).alias("num_files"))
    )


def compare_layouts(
    df: DataFrame, layouts: Mapping[str, Callable[[DataFrame], DataFrame]], path: str | None = None
) -> DataFrame:
    """Write ``df`` under each layout and report bytes, files and seconds per layout."""
    spark = df.sparkSession
    base = path or scratch_dir(spark, "layouts")
    out: DataFrame | None = None
    for name, layout in layouts.items():
        target = f"{base}/{name}"
        begin = time.perf_counter()
        layout(df).write.mode("overwrite").parquet(target)
        seconds = F.lit(time.perf_counter() - begin).alias("seconds")
        written = spark.read.schema(df.schema).parquet(target)
        stats = file_stats(written).select(F.lit(name).alias("layout"), "size", "num_files", seconds)
        out = stats if out is None else out.unionByName(stats)
    if out is None:
        raise ValueError("no layouts given")
    return out


def clustered(df: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """Bring equal ``columns`` together. Without a fixed number of parts AQE merges small partitions and
    splits those of frequent values."""
    return df.repartition(parts, *columns) if parts else df.hint("rebalance", *columns)


def sorted_layout(df: DataFrame, partition: str, *order: str, parts: int | None = None) -> DataFrame:
    """Cluster by ``partition`` and sort inside partitions, which compresses runs without a global sort."""
    return clustered(df, partition, parts=parts).sortWithinPartitions(partition, *order)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep an aggregate that several outputs read, and release it at the end."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
