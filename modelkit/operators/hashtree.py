"""Locating the differences of two tables by a hash tree over buckets of their keys.

Leaves are buckets of the key's hash with a count and two digests of their rows; a node is the sum of its leaves. Nodes are
compared from the top, and only buckets below unequal ones are read again. Trees can be stored beside their tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a leaf's number, and of its parent's.
LEAF_BITS, NODE_BITS = 16, 8


def bucket(keys: Sequence[str], bits: int = LEAF_BITS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << bits)).cast("int")


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two sums over independent row hashes. NULLs are hashed as such: a flag per column tells them from a skipped value."""
    flags = [F.col(c).isNull() for c in columns]
    hashes = (F.xxhash64(*columns, *flags), F.xxhash64(F.lit(7), *flags, *reversed(list(columns))))
    return [F.sum(h.cast("decimal(38,0)")).alias(f"digest_{i}") for i, h in enumerate(hashes)]


def leaves(df: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS) -> DataFrame:
    """(leaf, n, digest_0, digest_1): one row per bucket that has rows. Summed before the shuffle, so at most 2**bits rows a task move.

    Rows are compared by all columns, in the order of their names; repeated rows count.
    """
    return df.groupBy(bucket(keys, bits).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *_digests(sorted(df.columns)))


def unequal(left: DataFrame, right: DataFrame, bits: int = LEAF_BITS, node_bits: int = NODE_BITS) -> DataFrame:
    """Leaves that differ between two trees, found below the nodes that differ."""
    shift = bits - node_bits
    values = ("n", "digest_0", "digest_1")

    def nodes(tree: DataFrame) -> DataFrame:
        return tree.groupBy(F.call_function("shiftright", "leaf", F.lit(shift)).alias("node")).agg(*[F.sum(v).alias(v) for v in values])

    def differ(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
        right_ = b.select(F.col(key).alias("__key"), *[F.col(v).alias(f"__{v}") for v in values])
        same = F.lit(True)
        for v in values:
            same = same & F.col(v).eqNullSafe(F.col(f"__{v}"))
        return a.join(right_, F.col(key) == F.col("__key"), "full_outer").where(~same).select(F.coalesce(key, "__key").alias(key))

    wrong = differ(nodes(left), nodes(right), "node")
    below = [t.withColumn("node", F.call_function("shiftright", "leaf", F.lit(shift))).join(wrong, "node", "left_semi") for t in (left, right)]
    return differ(below[0], below[1], "leaf")


def differing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_tree: DataFrame | None = None, right_tree: DataFrame | None = None, bits: int = LEAF_BITS
) -> DataFrame:
    """(keys, kind): every key whose rows differ, as 'left' or 'right' only, or 'changed'.

    Both tables have the same columns. Only rows of unequal leaves are shuffled and compared; there, rows of a key reduce to
    counts and digests first, so a key may have any number of rows. NULL is a key value like any other.
    """
    keys, columns = list(keys), sorted(left.columns)
    if columns != sorted(right.columns):
        raise ValueError("the tables have different columns")
    trees = [t if t is not None else leaves(df, keys, bits) for t, df in ((left_tree, left), (right_tree, right))]
    # At most 2**bits numbers: a bounded table.
    wrong = F.broadcast(unequal(trees[0], trees[1], bits))
    sides = []
    for number, df in enumerate((left, right)):
        rows = df.withColumn("leaf", bucket(keys, bits)).join(wrong, "leaf", "left_semi")
        sides.append(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *_digests(columns)).withColumn("__side", F.lit(number)))
    both = sides[0].unionByName(sides[1])
    a, b = ([F.max(F.when(F.col("__side") == side, F.struct("__n", "digest_0", "digest_1"))) for side in (0, 1)])
    met = both.groupBy(*keys).agg(a.alias("__a"), b.alias("__b"))
    kind = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("changed")
    return met.where(~F.col("__a").eqNullSafe(F.col("__b"))).select(*keys, kind.alias("kind"))
