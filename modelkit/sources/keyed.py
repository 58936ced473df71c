"""A keyed table of Parquet files: upserts rewrite only the files whose key range they touch.

A table is a folder with ``data`` and ``manifest``. Every commit writes one manifest version: a row per file with its
lowest and highest key, and a row per writer with the last batch it has brought in. Files hold disjoint ranges of keys
in order, so an upsert finds the files of its keys by range, rewrites these and carries the others over by name. A
version counts once it is complete, so readers see all of a commit or nothing, and a batch that is repeated after a
failure is known by its number and changes nothing. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelkit.functions.scalars import same

# Rows of a file beyond which it is split when it is rewritten.
FILE_ROWS = 1_000_000


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the table, in order."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/v=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getParent().getName().removeprefix("v=")) for s in found or [])


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(file, place, low, high, rows, writer, batch) of a version (default: the last); low and high are key structs."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no keyed table in {path}")
    return spark.read.parquet(f"{path}/manifest/v={known[-1] if version is None else version}")


def read_keyed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version of the table. The driver handles the names of its files, never their rows."""
    files = [r["file"] for r in manifest(spark, path, version).where("file is not null").select("file").collect()]
    return spark.read.parquet(*files)


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys)


def _with_place(rows: DataFrame, keys: Sequence[str], files: DataFrame, count: int) -> DataFrame:
    """Add ``__place``, the number of the file that a row's key belongs to: the last one that begins at or before it, else the first.

    Rows and the files' lowest keys are sorted together in ranges of the key; within a range the last file begun so far is
    a running maximum, and a range where none has begun yet takes the last one of the ranges before it.
    """
    key = _key(keys)
    marks = files.select(F.col("low").alias("__k"), F.lit(0).alias("__row"), F.col("place").alias("__mark"))
    both = rows.select("*", key.alias("__k"), F.lit(1).alias("__row"), F.lit(None).cast("int").alias("__mark"))
    both = both.unionByName(marks, allowMissingColumns=True)
    parts = max(1, rows.sparkSession.sparkContext.defaultParallelism, -(-count // 1000))
    spread = both.repartitionByRange(parts, "__k").withColumn("__pid", F.spark_partition_id())
    running = W.partitionBy("__pid").orderBy("__k", "__row").rowsBetween(W.unboundedPreceding, W.currentRow)
    spread = spread.withColumn("__last", F.max("__mark").over(running))
    ends = spread.groupBy("__pid").agg(F.max("__mark").alias("__end"))
    carry = ends.select("__pid", F.max("__end").over(W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)).alias("__carry"))
    placed = spread.where(F.col("__row") == 1).join(F.broadcast(carry), "__pid", "left")
    place = F.coalesce(F.col("__last"), F.col("__carry"), F.lit(0)).cast("int")
    return placed.withColumn("__place", place).select(*rows.columns, "__place")


def _commit(spark: SparkSession, path: str, version: int, entries: DataFrame) -> None:
    entries.coalesce(1).write.mode("error").parquet(f"{path}/manifest/v={version}")


def _write_files(rows: DataFrame, path: str, keys: Sequence[str], parts: int) -> DataFrame:
    """Write rows with a ``__place`` in files of one place each, in ranges of the key; (file, low, high, rows) of each file."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    spread = rows.repartitionByRange(parts, "__place", *keys).sortWithinPartitions("__place", *keys)
    spread.write.partitionBy("__place").parquet(folder)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__place"])
    written = rows.sparkSession.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    key = _key(keys)
    return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows")
    )


def _latest(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by all columns, so the choice does not depend on partitions."""
    rest = [c for c in updates.columns if c not in keys]
    pick = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__row")
    chosen = updates.groupBy(*keys).agg(pick)
    return chosen.select(*[F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in updates.columns])


def upsert(
    updates: DataFrame, path: str, keys: Sequence[str], batch: int | None = None, writer: str = "default", order: Sequence[str] = (), file_rows: int = FILE_ROWS
) -> bool:
    """Insert or replace rows by key and commit; False if ``batch`` of this ``writer`` is in the table already.

    The first upsert makes the table. Several rows of one key in ``updates`` count as the greatest by ``order`` (columns
    that are no keys), then by the other columns. NULL is a key value like any other. Columns must be those of the table, in any order; their
    types must be orderable.
    """
    spark, keys = updates.sparkSession, list(keys)
    known = versions(spark, path)
    fresh = _latest(updates, keys, order)
    if not known:
        total = fresh.count()
        files = _write_files(fresh.withColumn("__place", F.lit(0)), path, keys, max(1, -(-total // file_rows)))
        _commit(spark, path, 0, _entries(files, None, writer, batch))
        return True
    current = manifest(spark, path, known[-1])
    if batch is not None and not current.where((F.col("writer") == writer) & (F.col("batch") >= batch)).isEmpty():
        return False
    files = current.where("file is not null")
    count = files.count()
    if count:
        fresh = _with_place(fresh, keys, files, count)
    else:
        fresh = fresh.withColumn("__place", F.lit(0))
    touched = fresh.groupBy("__place").agg(F.count(F.lit(1)).alias("n")).collect()
    places = [r["__place"] for r in touched]
    hit = files.where(F.col("place").isin(places)).select("file", "place", "rows").collect()
    columns = [f for f in updates.columns]
    rows = fresh
    if hit:
        # The place of a stored row is that of its file.
        place = files.where(F.col("place").isin(places)).select(F.col("file").alias("__file"), F.col("place").alias("__place"))
        read = spark.read.parquet(*[r["file"] for r in hit]).withColumn("__file", F.col("_metadata.file_path"))
        old = read.join(F.broadcast(place), "__file").drop("__file")
        mine = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys])
        match = same([F.col(f"__{k}") for k in keys], [old[k] for k in keys])
        rows = fresh.unionByName(old.select(*columns, "__place").join(mine, match, "left_anti"))
    total = sum(r["n"] for r in touched) + sum(r["rows"] for r in hit)
    if places:
        made = _write_files(rows, path, keys, max(len(places), -(-total // file_rows)))
        kept = files.where(~F.col("place").isin(places))
        entries = kept.select("file", "low", "high", "rows").unionByName(made)
    else:
        entries = files.select("file", "low", "high", "rows")
    _commit(spark, path, known[-1] + 1, _entries(entries, current.where("writer is not null"), writer, batch))
    return True


def _entries(files: DataFrame, log: DataFrame | None, writer: str, batch: int | None) -> DataFrame:
    """Manifest rows: files numbered in order of their keys, and the last batch of every writer."""
    # One row per file, numbered over a single sort: a list of names, not of rows of the table.
    numbered = files.withColumn("place", (F.row_number().over(W.orderBy("low", "file")) - 1).cast("int"))
    spark = files.sparkSession
    batches = spark.createDataFrame([(writer, batch)] if batch is not None else [], "writer string, batch long")
    if log is not None:
        batches = batches.unionByName(log.select("writer", "batch"))
    batches = batches.groupBy("writer").agg(F.max("batch").alias("batch"))
    return numbered.unionByName(batches, allowMissingColumns=True)


def keyed_writer(path: str, keys: Sequence[str], writer: str = "stream", order: Sequence[str] = (), file_rows: int = FILE_ROWS) -> Callable[[DataFrame, int], None]:
    """Batch writer for ``foreachBatch``: each micro-batch is one upsert, a repeated one is nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path, keys, batch_id, writer, order, file_rows)

    return write
