"""Bucketed tables that survive a hot key: heavy keys are routed to a salted side table when the tables are written.

A bucket is one task of a bucketed join, so a key with a large share of the rows makes one task as large. Here the keys that
are heavy in any of the tables to be joined go to side tables, dealt over shards; the rest is bucketed as usual. A join takes
the buckets without a shuffle, joins the side tables shard by shard, and unites both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.functions.skew import HOT_KEYS, HOT_ROWS
from modelkit.sources.tables import write_bucketed


def heavy_keys(frames: Mapping[str, DataFrame], key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, shards_<name> for each frame): keys with more than ``hot_rows`` rows in one of the frames.

    At most HOT_KEYS of them, those with the most rows: a bounded table. A key beyond it is bucketed like others. NULL joins
    nothing and is never heavy.
    """
    counts = None
    for name, df in frames.items():
        one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("frame", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    shards = [
        F.coalesce(F.max(F.when(F.col("frame") == name, F.ceil(F.col("n") / F.lit(hot_rows)))), F.lit(1)).cast("int").alias(f"shards_{name}")
        for name in frames
    ]
    found = counts.groupBy(key).agg(*shards, F.max("n").alias("__most"))
    return found.where(F.col("__most") > hot_rows).orderBy(F.col("__most").desc(), key).limit(HOT_KEYS).drop("__most")


def write_split(df: DataFrame, name: str, frame: str, key: str, hot: DataFrame, buckets: int, path: str) -> None:
    """Write ``df`` as the bucketed table ``name`` and its heavy keys as ``name``_heavy, under ``path``.

    ``hot`` is a stored result of ``heavy_keys`` over all tables to be joined, ``frame`` this table's name in it. Heavy rows
    get a shard from a hash of all their columns, so repeated rows alone can be uneven.
    """
    spread = hot.select(F.col(key).alias("__key"), F.col(f"shards_{frame}").alias("__shards"))
    marked = df.join(F.broadcast(spread), F.col(key) == F.col("__key"), "left").drop("__key")
    rest = marked.where(F.col("__shards").isNull()).drop("__shards")
    write_bucketed(rest, name, key, buckets, f"{path}/{name}")
    shard = F.pmod(F.xxhash64(*df.columns), F.col("__shards")).cast("int")
    heavy = marked.where(F.col("__shards").isNotNull()).withColumn("__shard", shard).drop("__shards")
    heavy.repartition(key, "__shard").write.mode("overwrite").option("path", f"{path}/{name}_heavy").saveAsTable(f"{name}_heavy")


def join_split(spark: SparkSession, left: tuple[str, str], right: tuple[str, str], key: str, hot: DataFrame) -> DataFrame:
    """Inner join of two tables of ``write_split``, each given as (table, its frame's name in ``hot``).

    Of heavy keys shard i of one side meets shard j of the other in a task of its own: each side's rows are copied once per
    shard of the other, so a table with few rows per key is copied and the large one is not.
    """
    (a, frame_a), (b, frame_b) = left, right
    rest = spark.table(a).join(spark.table(b), key)
    shards = F.broadcast(hot.select(key, F.col(f"shards_{frame_a}").alias("__a"), F.col(f"shards_{frame_b}").alias("__b")))

    def cells(name: str, own: str, other: str, copies: str) -> DataFrame:
        met = spark.table(f"{name}_heavy").join(shards, key).withColumnRenamed("__shard", own)
        return met.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(copies) - 1))).drop("__a", "__b")

    heavy = cells(a, "__i", "__j", "__b").join(cells(b, "__j", "__i", "__a"), [key, "__i", "__j"]).drop("__i", "__j")
    return rest.unionByName(heavy.select(*rest.columns))
