"""Mixing sources to target weights, in blocks of a fixed number of words.

Each source's documents are laid end to end in a hashed order and cut into blocks. Output shards have a
fixed number of slots; every shard draws its own multinomial counts of sources. The slots a source has drawn
are numbered over all shards and sent through a pseudorandom permutation of the source; what is beyond the
source's target goes to sources that have drawn too few, so targets are met whatever the draw. A slot's
number then gives a pass over the source and, through the pass's own permutation, a block of it. Blocks
are joined by their index. Only one row per source reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.llm.common import WORD, mix, stored

BLOCK_WORDS, SHARD_SLOTS = 128, 8192
# Passes over a source at most, and the weights given to sources in turn.
PASSES, WEIGHTS = 3, (1.0, 2.0, 3.0)
# Documents of a bucket of the packing order, and shards of a group, that one window holds.
BUCKET_ROWS, GROUP_SHARDS = 4096, 1024


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = PASSES) -> dict[str | None, float]:
    """Words each source should give: the sum of all sizes by weight, none above ``most`` times its size.

    Sources are taken in code point order, null last; the excess of capped ones goes to the others by weight.
    """
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = float(sum(sizes.values())), list(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not full:
            found |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            found[s] = float(most * sizes[s])
            left -= found[s]
        open_ = [s for s in open_ if s not in found]
        left = max(left, 0.0)
    return found


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Places of ``index`` in a pseudorandom permutation of 0..size-1: a four-round Feistel network that is walked until it falls inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(key % (1 << 63)) * np.uint64(4))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        x = (left << np.uint64(half)) | right
        out[todo] = x
        todo = todo[x >= size]
    return out.astype(np.int64)


@dataclass
class Source:
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int
    trim: int  # words of the last slot, 0 if it is whole


def plan_sources(sized: DataFrame, block_words: int = BLOCK_WORDS) -> list[Source]:
    """Size, target and slots of every source of ``sized`` (source, size)."""
    sizes = {r["source"]: int(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    want = targets(sizes)
    out = []
    for name in sorted(sizes, key=lambda s: (s is None, s or "")):
        size, target = sizes[name], want[name]
        blocks = -(-size // block_words)
        passes = min(int(target // size), PASSES) if size else 0
        rest = int(target - passes * size) if size and passes < PASSES else 0
        more = min(-(-rest // block_words), blocks)
        whole_last = more == 0 or rest - (more - 1) * block_words >= min(block_words, size)
        out.append(Source(name, size, target, blocks, passes * blocks + more, 0 if whole_last else rest - (more - 1) * block_words))
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, source, size, place), and the text if asked for: ``place`` is a hash that gives the packing order."""
    place = F.xxhash64("doc_id", "text").alias("place")
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place, *(["text"] if texts else []))


def packed(sized: DataFrame, rows: int) -> DataFrame:
    """Add ``start``, the words of the source before the document. Sums run over buckets, then inside them."""
    buckets = max(1, rows // BUCKET_ROWS)
    placed = sized.withColumn("bucket", F.pmod("place", F.lit(buckets)))
    inside = W.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = placed.groupBy("source", "bucket").agg(F.sum("size").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    base = base.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base")
    own = placed.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = own.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.withColumn("start", (F.col("base") + F.col("own")).cast("long")).drop("s", "b", "base", "own", "bucket", "place")


def draw(spark, sources: list[Source], seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Slots (shard, source_no, block, words): ``words`` is null for a whole block, else how many are used.

    Every shard's multinomial draw has its own random stream, so a lost task draws the same again.
    """
    slots = np.array([s.slots for s in sources], np.int64)
    total = int(slots.sum())
    shards = -(-total // shard_slots)
    share = slots / max(total, 1)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                size = min(shard_slots, total - int(shard) * shard_slots)
                drawn = np.random.default_rng([seed, int(shard)]).multinomial(size, share)
                yield pd.DataFrame({"shard": shard, "source_no": np.arange(len(share)), "n": drawn})

    schema = "shard long, source_no long, n long"
    drawn = spark.range(0, shards).mapInPandas(counts, schema).where("n > 0").withColumn("part", F.floor(F.col("shard") / GROUP_SHARDS))
    drawn = stored(drawn, "draws")
    had = {r["source_no"]: int(r["n"]) for r in drawn.groupBy("source_no").agg(F.sum("n").alias("n")).collect()}
    have = np.array([had.get(i, 0) for i in range(len(sources))], np.int64)
    over, under = np.maximum(have - slots, 0), np.maximum(slots - have, 0)
    over_begin, under_end = np.cumsum(over) - over, np.cumsum(under)
    before = W.partitionBy("source_no").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("source_no", "part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    base = drawn.groupBy("source_no", "part").agg(F.sum("n").alias("all")).withColumn("base", F.coalesce(F.sum("all").over(before), F.lit(0)))
    begun = drawn.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(base.drop("all"), ["source_no", "part"])
    numbered = begun.select("shard", "source_no", (F.col("base") + F.col("own")).alias("begin"), "n")
    numbered = numbered.select("shard", "source_no", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("number"))
    plan = [(s.blocks, s.slots, s.trim) for s in sources]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number, source = batch["number"].to_numpy().copy(), batch["source_no"].to_numpy().copy()
            block, words = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            for s in np.unique(source).tolist():
                at = np.flatnonzero(source == s)
                spread = permuted(number[at], int(have[s]), seed * 1_000_003 + 7 * s + 1)
                number[at] = spread
            # What a source drew beyond its target is handed to those that drew too few, in order.
            extra = np.flatnonzero(number >= slots[source])
            handed = over_begin[source[extra]] + number[extra] - slots[source[extra]]
            to = np.searchsorted(under_end, handed, side="right")
            number[extra] = have[to] + handed - (under_end[to] - under[to])
            source[extra] = to
            for s in np.unique(source).tolist():
                blocks, count, trim = plan[s]
                at = np.flatnonzero(source == s)
                passes = number[at] // blocks
                for p in np.unique(passes).tolist():
                    now = at[passes == p]
                    block[now] = permuted(number[now] - p * blocks, blocks, seed * 1_000_003 + 7 * s + 1_009 * (p + 2))
                words[at[number[at] == count - 1]] = trim
            made = pd.DataFrame({"shard": batch["shard"], "source_no": source, "block": block})
            made["words"] = pd.array(np.where(words > 0, words, -1), dtype="Int64").astype("Int64")
            made.loc[made["words"] < 0, "words"] = pd.NA
            yield made

    return numbered.mapInPandas(place, "shard long, source_no long, block long, words long")


def pieces(documents: DataFrame, sources: list[Source], block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and block that it has words in: their place in the block and in the document."""
    spark = documents.sparkSession
    names = spark.createDataFrame([(i, s.name) for i, s in enumerate(sources)], "source_no long, name string")
    some = documents.where("size > 0").join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    cut = some.withColumn("block", F.explode(F.sequence(first, last)))
    edge = F.col("block") * block_words
    begin, end = F.greatest("start", edge) - edge, F.least(F.col("start") + F.col("size"), edge + block_words) - edge
    return cut.withColumn("begin", begin).withColumn("end", end)


@dataclass
class Mix:
    sources: list[Source]
    documents: DataFrame
    slots: DataFrame
    block_words: int

    def taken(self) -> DataFrame:
        """(doc_id, source, size, source_size, target, taken) of every document."""
        spark = self.documents.sparkSession
        whole = F.col("words").isNull()
        uses = self.slots.groupBy("source_no", "block").agg(
            F.sum(whole.cast("long")).alias("whole"), F.sum(F.coalesce("words", F.lit(0))).alias("part")
        )
        cut = pieces(self.documents, self.sources, self.block_words).select("doc_id", "source", "size", "start", "source_no", "block", "begin", "end")
        words = F.col("whole") * (F.col("end") - F.col("begin")) + F.least("end", "part") - F.least("begin", "part")
        sums = cut.join(uses, ["source_no", "block"], "left").groupBy("source", "start", "doc_id", "size").agg(
            F.sum(F.coalesce(words, F.lit(0))).alias("taken")
        )
        rows = sums.select("doc_id", "source", "size", "taken").unionByName(
            self.documents.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
        )
        table = spark.createDataFrame([(s.name, s.size, float(s.target)) for s in self.sources], "name string, source_size long, target double")
        joined = rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")))
        return joined.select("doc_id", "source", "size", "source_size", "target", "taken")

    def shards(self) -> DataFrame:
        """The mixed text: (shard, source_no, block, text), one row per slot. Blocks are joined by index.

        Needs ``documents`` with their texts (``mixed(..., texts=True)``).
        """
        cut = pieces(self.documents, self.sources, self.block_words)
        found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
        begin = F.col("block") * self.block_words + F.col("begin") - F.col("start")
        own = F.slice(found, (begin + 1).cast("int"), (F.col("end") - F.col("begin")).cast("int"))
        blocks = (
            cut.select("source_no", "block", F.struct("begin", own.alias("words")).alias("piece"))
            .groupBy("source_no", "block")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["words"])).alias("found"))
        )
        used = F.coalesce(F.col("words"), F.size("found")).cast("int")
        return self.slots.join(blocks, ["source_no", "block"]).select(
            "shard", "source_no", "block", F.array_join(F.slice("found", 1, used), " ").alias("text")
        )


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 0, texts: bool = False) -> Mix:
    """Plan the mix of all ``docs`` (doc_id, source, text); ``texts`` keeps their texts for ``Mix.shards``.

    A null text has size 0 and a null source is a source of its own. Documents of size 0 are never taken.
    Repeated rows are documents of their own. Reruns with one seed agree. Other columns are ignored; an empty
    table gives an empty mix.
    """
    sized = stored(sized_documents(docs, texts), "sizes")
    sources = plan_sources(sized, block_words)
    documents = packed(sized, sized.count())
    return Mix(sources, documents, draw(docs.sparkSession, sources, seed, shard_slots), block_words)
