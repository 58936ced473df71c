"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items share seeds, windows of five tokens; a rolling (Karp-Rabin) hash and a filter of fixed size tell
candidates, and seeds are joined by their very tokens. What a document and an item share is then tiled: Karp-Rabin runs
over the seeds at growing lengths find the longest length at which both have a match in tokens that no tile has
yet; the matches of that length are marked, and again at the next length, down to one seed. Tiles may stand in any order,
so a passage whose sentences were moved about is still covered. A document is contaminated by an item if its tiles
cover enough of the item's tokens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import NOT_TOKEN, chunks, segment_hashes, stored, window_hashes, words_of

SEED, COVERAGE = 5, 0.8
# A filter of this many bits tells seeds of the benchmark from most others before anything is shuffled.
FILTER_BITS = 1 << 24
# Bytes of seeds of the benchmark that may be broadcast.
BROADCAST_BYTES = 32 << 20


class _Side:
    """The seeds of one text: their places and codes, and which tokens belong to tiles."""

    def __init__(self, place: np.ndarray, code: np.ndarray, seed: int):
        self.place, self.code, self.seed = place, code, seed
        self.taken = np.zeros(int(place[-1]) - int(place[0]) + seed if len(place) else 0, bool)
        self.windows(1)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First seed and hash of every run of ``length`` seeds that follow each other in free tokens."""
        at = np.arange(max(len(self.place) - length + 1, 0))
        at = at[self.place[at + length - 1] - self.place[at] == length - 1] if len(at) else at
        used = np.r_[0, np.cumsum(self.taken)]
        begin = self.place[at] - self.place[0] if len(at) else at
        at = at[used[begin + length + self.seed - 1] == used[begin]] if len(at) else at
        return at, segment_hashes(self.code, at, at + length)

    def free(self, at: int, length: int) -> bool:
        begin = int(self.place[at] - self.place[0])
        return not self.taken[begin : begin + length + self.seed - 1].any()

    def take(self, at: int, length: int) -> int:
        begin = int(self.place[at] - self.place[0])
        self.taken[begin : begin + length + self.seed - 1] = True
        return int(self.place[at])


def tiles_of(place: np.ndarray, code: np.ndarray, item_code: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (document place, item place, tokens), the longest first; of equal ones the first in the item, then in
    the document.

    ``code`` tells the document's seeds at ``place`` apart, in order; ``item_code`` has the same codes for the
    item's seeds at 0, 1, and so on. No list of pairs is made: a length is searched by the hashes of
    both sides, and places are walked once per length.
    """
    doc, item = _Side(np.asarray(place, np.int64), np.asarray(code, np.int64), seed), _Side(np.arange(len(item_code)), np.asarray(item_code, np.int64), seed)
    tiles: list[tuple[int, int, int]] = []

    def shared(length: int) -> bool:
        return bool(length) and len(np.intersect1d(doc.windows(length)[1], item.windows(length)[1])) > 0

    low, high = 0, min(len(doc.code), len(item.code))
    while high and shared(1):
        # The longest length with a match: if there is one of a length, there is one of every shorter length.
        low = 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        (at, hashes), (of_item, item_hashes) = doc.windows(low), item.windows(low)
        keep = np.isin(hashes, item_hashes)
        at, hashes = at[keep], hashes[keep]
        order = np.argsort(hashes, kind="stable")
        at, hashes = at[order], hashes[order]
        # Next place to try of every hash; a place that is taken once stays taken.
        following: dict[int, int] = {}
        for i, h in zip(of_item.tolist(), item_hashes.tolist(), strict=True):
            if not item.free(i, low):
                continue
            spot = following[h] if h in following else int(np.searchsorted(hashes, np.uint64(h)))
            while spot < len(at) and int(hashes[spot]) == h and not doc.free(int(at[spot]), low):
                spot += 1
            following[h] = spot
            if spot < len(at) and int(hashes[spot]) == h and np.array_equal(doc.code[at[spot] : at[spot] + low], item.code[i : i + low]):
                tiles.append((doc.take(int(at[spot]), low), item.take(i, low), low + seed - 1))
        high = low - 1
    return tiles


def tile(pairs: Sequence[tuple[int, int]], seed: int = SEED) -> list[tuple[int, int, int]]:
    """The tiles of a document and an item given by the pairs of places at which their seeds are equal."""
    first: dict[int, int] = {}
    for d, i in pairs:
        first[d] = min(i, first.get(d, i))
    codes = [-1 - i for i in range(1 + max((i for _, i in pairs), default=-1))]
    for d, i in pairs:
        codes[i] = first[d]
    place = np.array(sorted(first), np.int64)
    return tiles_of(place, np.array([first[d] for d in place.tolist()], np.int64), np.array(codes, np.int64), seed)


def _seeds(rows: DataFrame, keys: Sequence[str], seed: int, bits: np.ndarray | None) -> DataFrame:
    """(keys, seed, hash, place, tokens) of every seed of every row; with ``bits`` only those the filter lets through.

    ``seed`` is the tokens themselves, in lower case and joined by a space.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = words_of(batch.column("text"), lower=True, breaks=NOT_TOKEN)
            at, hashes = window_hashes(w.hashes(), w.row, seed)
            spot = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            if bits is not None:
                hit = (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) > 0
                at, spot = at[hit], spot[hit]
            data, starts, ends = w.data.tobytes(), w.starts, w.ends
            words = [b" ".join(data[starts[k] : ends[k]] for k in range(i, i + seed)) for i in at.tolist()]
            row = w.row[at]
            own = [batch.column(k).take(pa.array(row)) for k in keys]
            numbers = [spot, (at - w.first[row]).astype(np.int64), w.counts[row].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(words, pa.binary()).cast(pa.string()), *map(pa.array, numbers)], [*keys, "seed", "spot", "place", "tokens"]
            )

    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    return rows.select(*keys, "text").mapInArrow(find, ", ".join([*kinds, "seed string, spot long, place long, tokens long"]))


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """The filter's bits as 64-bit words, gathered by Spark; at most FILTER_BITS / 64 rows reach the driver."""
    spot = F.col("spot")
    word = F.shiftright(spot, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(63).cast("int"))
    rows = seeds.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    item: str = "item_id",
    seed: int = SEED,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs of a document and an item of which its tiles cover at least ``coverage``.

    Tokens are runs of letters, digits and characters beyond ASCII, in lower case. Returns the document's
    ``keys``, the item, item_tokens, covered, coverage and tiles (document place, item place, tokens). Null and
    empty texts and items of fewer than ``seed`` tokens are in no pair; rows that repeat a document's keys
    and text give its pairs once, as do repeated items; texts that share an item id are judged each by itself. Other columns are
    ignored; empty tables give no pairs.
    """
    # One number per distinct text of an item: repeated items are one, texts that share an id are told apart.
    asked = benchmark.select(F.col(item).alias("item"), "text").dropDuplicates().withColumn("number", F.xxhash64("item", "text"))
    items = stored(_seeds(asked, ["item", "number"], seed, None), "seeds")
    bits = seed_filter(items)
    hits = _seeds(docs, keys, seed, bits).drop("tokens", "spot")
    # A seed's code within an item is the first place there that has it.
    coded = items.groupBy("item", "number", "seed", F.col("tokens").alias("item_tokens")).agg(
        F.min("place").alias("code"), F.count(F.lit(1)).alias("times"), F.collect_list("place").alias("places")
    )
    coded = stored(coded, "codes")
    size = coded.agg(F.coalesce(F.sum(F.octet_length("seed") + 100), F.lit(0))).first()[0]
    spread = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)
    met = hits.join(spread(coded.drop("places")), "seed")
    by_item = ["item", "number", "item_tokens"]
    grouped = met.groupBy(*keys, *by_item).agg(F.collect_set(F.struct("place", "code", "times")).alias("found"))
    # What the seeds can cover at most, before any tiling: five tokens for every place in the item.
    known = F.array_distinct(F.transform("found", lambda f: F.struct(f["code"].alias("code"), f["times"].alias("times"))))
    bound = F.aggregate(known, F.lit(0).cast("long"), lambda n, f: n + f["times"]) * seed
    likely = grouped.where(bound >= coverage * F.col("item_tokens"))
    # The item's codes in order of their places.
    spots = coded.select("number", F.explode("places").alias("at"), "code").groupBy("number").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("codes")
    )
    likely = likely.join(spread(spots), "number")
    shape = pa.list_(pa.struct([("place", pa.int64()), ("item_place", pa.int64()), ("tokens", pa.int64())]))

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows, covered = [], []
                for found, codes in zip(batch.column("found"), batch.column("codes"), strict=True):
                    place, code = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("place", "code"))
                    order = np.argsort(place)
                    tiles = tiles_of(place[order], code[order], codes.values.to_numpy(zero_copy_only=False), seed)
                    rows.append([dict(zip(("place", "item_place", "tokens"), t, strict=True)) for t in tiles])
                    covered.append(sum(t[2] for t in tiles))
                old = [batch.column(c) for c in (*keys, "item", "item_tokens")]
                yield pa.RecordBatch.from_arrays([*old, pa.array(covered, pa.int64()), pa.array(rows, shape)], [*keys, "item", "item_tokens", "covered", "tiles"])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys] + [f"item {benchmark.schema[item].dataType.simpleString()}"]
    schema = ", ".join([*kinds, "item_tokens long, covered long, tiles array<struct<place:long,item_place:long,tokens:long>>"])
    share = F.col("covered") / F.col("item_tokens")
    done = likely.mapInArrow(tiled, schema).withColumn("coverage", share).where(F.col("coverage") >= coverage)
    return done.select(*keys, F.col("item").alias(item), "item_tokens", "covered", "coverage", "tiles")
