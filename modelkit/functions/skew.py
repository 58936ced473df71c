"""Building blocks that stay balanced when one key holds a large share of all rows.

The rule throughout: aggregate before the shuffle, split what is still large by a deterministic
expression of the row, and put the pieces together from summaries whose size is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that a single task may hold, and the most keys that are split (the largest ones), which
# bounds every broadcast of a hot-key list. A key beyond that list is left to AQE.
HOT_ROWS, HOT_KEYS = 1_000_000, 50_000
# Size limit for broadcasts, by the measured size of the rows in memory.
BROADCAST_BYTES = 32 << 20
# Bytes that a row and a variable-length value take in memory besides the value itself.
_ROW, _VALUE = 32, 24


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + _VALUE
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 4 + _VALUE
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows take in memory, counted by one aggregation over the frame itself.

    File sizes are no bound: a column that compresses well is many times larger once it is read.
    """
    row = F.lit(_ROW).cast("long")
    for f in df.schema.fields:
        row = row + _bytes_of(df[f"`{f.name}`"], f.dataType)
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the measured size is within ``max_bytes``.

    Above it the frame comes back without a hint and the join stays a shuffled one, in which AQE
    splits skewed partitions.
    """
    return F.broadcast(df) if max_bytes and measured_bytes(df) <= max_bytes else df


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of shards to split each into.

    The count is partially aggregated and reads the key columns only. The result is the HOT_KEYS largest of
    them at most, so it is safe to broadcast; which keys are split never changes a result.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    shards = F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int")
    largest = counts.where(F.col("__n") > hot_rows).orderBy(F.col("__n").desc(), *keys).limit(HOT_KEYS)
    return largest.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], shards.alias("__shards"))


def _mark_hot(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``__shards`` to the rows of hot keys, NULL keys included. Rows are not shuffled."""
    match = F.lit(True)
    for k in keys:
        match = match & rows[k].eqNullSafe(F.col(f"__hot_{k}"))
    return rows.join(F.broadcast(hot), match, "left").drop(*[f"__hot_{k}" for k in keys])


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` to the single ``lookup`` row of their key, spreading hot keys over many tasks.

    A lookup whose measured size is within ``max_bytes`` is broadcast, which no key can unbalance.
    Otherwise hot keys are counted in ``counted`` (default ``rows``; give the raw table if ``rows`` is a
    long plan over it, counting too many keys as hot does no harm). Rows of a hot key are sharded by a hash of ``spread`` and only its lookup row is copied, once per
    shard, so the lookup grows by at most total_rows / hot_rows rows. NULL keys join nothing. All other keys join as usual.
    """
    keys = list(keys)
    lacking = [k for k in keys if counted is not None and k not in counted.columns]
    if lacking:
        raise ValueError(f"hot keys cannot be counted in a frame without {lacking}")
    if max_bytes and measured_bytes(lookup) <= max_bytes:
        return rows.join(F.broadcast(lookup), keys, how)
    hot = hot_keys(rows if counted is None else counted, keys, hot_rows)
    shard = F.pmod(F.xxhash64(*spread), F.col("__shards")).cast("int")
    salted = _mark_hot(rows, hot, keys).withColumn("__salt", F.coalesce(shard, F.lit(0))).drop("__shards")
    last = F.coalesce("__shards", F.lit(1)) - 1
    copies = (
        _mark_hot(lookup, hot, keys).withColumn("__salt", F.explode(F.sequence(F.lit(0), last))).drop("__shards")
    )
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def _with_block(df: DataFrame, keys: Sequence[str], block: Column, hot_rows: int | None) -> DataFrame:
    """Add ``__block``: the block of a row of a hot key, NULL for keys that fit one task."""
    if hot_rows is None:
        return df.withColumn("__block", block)
    marked = _mark_hot(df, hot_keys(df, keys, hot_rows), keys)
    return marked.withColumn("__block", F.when(F.col("__shards").isNotNull(), block)).drop("__shards")


def ordered_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column | None = None,
    name: str = "row_number",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Exact 1-based position of each row within its key.

    ``block`` is a non-decreasing expression of the first order column (the day of a time, a range of
    an id). Keys with more than ``hot_rows`` rows (every key if None) are numbered inside (key, block);
    the rows before a block come from a running sum over the block counts, of which a key has as many as
    there are blocks. ``order`` must be total; a NULL key is a key like any other.
    """
    keys = list(keys)
    if block is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    blocked = _with_block(df, keys, block, hot_rows)
    inside = blocked.withColumn("__pos", F.row_number().over(W.partitionBy(*keys, "__block").orderBy(*order)))
    before = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    carry = (
        blocked.where(F.col("__block").isNotNull())
        .groupBy(*keys, "__block")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(before))
        .drop("__n")
    )
    position = F.col("__pos") + F.coalesce("__before", F.lit(0))
    renamed = carry.select(*[F.col(c).alias(f"__c_{c}") for c in [*keys, "__block"]], "__before")
    match = F.lit(True)
    for c in [*keys, "__block"]:
        match = match & inside[c].eqNullSafe(F.col(f"__c_{c}"))
    return inside.join(renamed, match, "left").withColumn(name, position.cast("long")).select(*df.columns, name)


def sliding_sum(
    df: DataFrame, keys: Sequence[str], position: str, value: str, size: int, name: str, chunk: int | None = None
) -> DataFrame:
    """Sum over the trailing ``size`` rows, with ``position`` the exact row number of the key.

    Rows are partitioned by (key, chunk of positions); the last ``size - 1`` rows of each chunk are
    copied into the next one, so any key is spread over many tasks and each sum is still whole.
    """
    chunk = chunk or max(100_000, 10 * size)
    if chunk < size:
        raise ValueError("chunk must hold at least one window")
    home = F.floor((F.col(position) - 1) / F.lit(chunk)).cast("long")
    tail = F.pmod(F.col(position) - 1, F.lit(chunk)) >= F.lit(chunk - size + 1)
    spread = df.withColumn("__home", home).withColumn(
        "__chunk", F.explode(F.when(tail, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home")))
    )
    frame = W.partitionBy(*keys, "__chunk").orderBy(position).rowsBetween(1 - size, 0)
    return (
        spread.withColumn(name, F.sum(value).over(frame))
        .where(F.col("__chunk") == F.col("__home"))
        .drop("__chunk", "__home")
    )


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str] = (),
    gap: Column | None = None,
    block: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Collapse consecutive rows of a key into islands: one row with first, last and count.

    A row continues the island of its predecessor when all ``values`` are equal (null-safe) and, if
    ``gap`` (an interval) is given, its first order column is at most ``gap`` after the predecessor's.
    Output: keys, values, ``start``, ``end`` (of the first order column) and ``n``, the number of rows or
    the sum of ``weight``.

    With ``block`` (a non-decreasing expression of the first order column) the rows of keys with more
    than ``hot_rows`` rows (of every key if None) are collapsed inside (key, block) first. Only the first
    and last island of a block can touch a neighbour, so the second pass orders at most two rows per key
    and block, however many rows the key has. A NULL key is a key like any other.
    """
    keys, values, lead = list(keys), list(values), F.col(order[0])
    source = df if block is None else _with_block(df, keys, block, hot_rows)
    rows = source.select(
        *keys,
        *values,
        lead.alias("start"),
        lead.alias("end"),
        (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("n"),
        *[F.col(c).alias(f"__order{i}") for i, c in enumerate(order)],
        *(["__block"] if block is not None else []),
    )
    within = [f"__order{i}" for i in range(len(order))]

    def starts(window: W) -> Column:
        new = F.lag(F.lit(1)).over(window).isNull()
        for v in values:
            new = new | ~F.lag(v).over(window).eqNullSafe(F.col(v))
        if gap is not None:
            new = new | (F.col("start") > F.lag("end").over(window) + gap)
        return new

    def collapse(frame: DataFrame, scope: list[str], sequence: list[str], new: Column) -> DataFrame:
        running = W.partitionBy(*scope).orderBy(*sequence).rowsBetween(W.unboundedPreceding, 0)
        return (
            frame.withColumn("__new", new.cast("int"))
            .withColumn("__island", F.sum("__new").over(running))
            .groupBy(*scope, "__island", *values)
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
        )

    result = [*keys, *values, "start", "end", "n"]
    scope = keys if block is None else [*keys, "__block"]
    inner = collapse(rows, scope, within, starts(W.partitionBy(*scope).orderBy(*within)))
    if block is None:
        return inner.select(*result)
    placed = inner.withColumnRenamed("__island", "__place").withColumn(
        "__places", F.max("__place").over(W.partitionBy(*scope))
    )
    touches = (F.col("__place") == 1) | (F.col("__place") == F.col("__places"))
    across = ["__block", "__place"]
    new = F.when(F.col("__place") > 1, True).otherwise(starts(W.partitionBy(*keys).orderBy(*across)))
    edges = collapse(placed.where(touches), keys, across, new)
    return edges.select(*result).unionByName(placed.where(~touches).select(*result))
