"""Point-in-time lookup: facts with the range of their key that was valid at their time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.functions.skew import HOT_ROWS, _with_block


def asof_join(
    facts: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    columns: Sequence[str],
    block: Callable[[Column], Column] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All rows of ``facts`` with the ``columns`` of the range that holds their time, NULL where there is none.

    ``ranges`` are type 2 rows of ``keys``: a key's ranges do not overlap, ``start`` and ``end`` are inclusive and a NULL
    ``end`` is open. Facts and ranges lie on one line of time per key; a running window carries the last range that
    began, and its end decides. No row meets more than one range, however many its key has. With ``block`` (a
    non-decreasing function of the time) keys with more than ``hot_rows`` rows (all if None) are cut into
    blocks, and the last range before a block is carried in from the blocks before it. A NULL key or time matches nothing.
    """
    keys, fact_columns = list(keys), facts.columns
    clash = [c for c in columns if c in fact_columns]
    if clash:
        raise ValueError(f"the facts have columns {clash} of their own")
    time = facts.schema[at].dataType
    matchable = F.col(at).isNotNull()
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    usable = F.col(start).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()

    payload = F.struct(F.col(start).cast(time).alias("s"), F.col(end).isNull().alias("open"), F.col(end).cast(time).alias("e"), *columns)
    began = ranges.where(usable).select(*keys, F.col(start).cast(time).alias("__at"), F.lit(0).alias("__kind"), payload.alias("__range"))
    asked = facts.where(matchable).select(*keys, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct(*fact_columns).alias("__fact"))
    line = began.unionByName(asked, allowMissingColumns=True)
    if block is None:
        line = line.withColumn("__block", F.lit(None).cast("string"))
    else:
        line = _with_block(line, keys, block(F.col("__at")), hot_rows)
    # Of ranges that begin together (there should be none) the one that ends last counts.
    order = ["__at", "__kind", F.col("__range.open"), F.col("__range.e")]
    running = W.partitionBy(*keys, "__block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inside = line.withColumn("__last", F.last("__range", ignorenulls=True).over(running)).where(F.col("__kind") == 1)
    found = F.col("__last")
    if block is not None:
        latest = F.max_by("__range", F.when(F.col("__kind") == 0, F.struct("__at", F.col("__range.open"), F.col("__range.e"))))
        per_block = line.where(F.col("__block").isNotNull()).groupBy(*keys, "__block").agg(latest.alias("__range"))
        earlier = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
        carry = per_block.select(*keys, "__block", F.last("__range", ignorenulls=True).over(earlier).alias("__carry"))
        inside = inside.join(carry, [*keys, "__block"], "left")
        found = F.coalesce("__last", "__carry")
    valid = inside.withColumn("__found", found)
    holds = F.col("__found.open") | (F.col("__at") <= F.col("__found.e"))
    joined = valid.select("__fact.*", *[F.when(holds, F.col("__found")[c]).alias(c) for c in columns])
    kinds = {c: ranges.schema[c].dataType for c in columns}
    unmatched = facts.where(~matchable).select(*fact_columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    return joined.unionByName(unmatched)
