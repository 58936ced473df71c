"""Ranked lexical search: a sharded block index, searched by Block-Max MaxScore.

1. Index: every task packs its documents into shards of bounded size and stores, per shard and asked term, the
   postings in compressed blocks, each block with its first and last document, its highest term count and
   its shortest document. No row is moved for this. Documents, terms and document frequencies are summed over shards.
2. Search, per shard and query: the bounds of whole lists tell which lists are essential; a document in none of these
   cannot reach the k best found so far. Candidates come from the essential lists. Block maxima of the other
   lists reject candidates before any of these blocks is decompressed; the rest are completed list by list.
3. Each task keeps one heap per query over all its shards; the heaps are merged to the k best.

Scores are whole numbers and bounds are never below them, so results are exact and do not depend on the sharding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.llm.common import NOT_TOKEN, chunks, segment_hashes, stored, words_of

# Documents and text bytes of a shard (either closes it), and postings of a block.
SHARD_DOCS, SHARD_BYTES, BLOCK = 8192, 16 << 20, 128
# Bytes of query texts that are searched at a time; more queries are searched in several rounds.
QUERY_BYTES = 16 << 20
BLOBS = ("places", "tfs", "firsts", "lasts", "max_tf", "min_len")
INDEX_SCHEMA = (
    "shard long, ids array<long>, lens array<long>, n_docs long, n_terms long, terms array<int>, counts array<int>, tf_bytes int, "
    + ", ".join(f"{b} binary" for b in BLOBS)
)


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and two 64-bit hashes of every term of the texts, and the number of terms per row."""
    w = words_of(column, lower=True, breaks=NOT_TOKEN)
    return w.row, w.hashes(), w.hashes(1), w.counts


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds: grows with its count, falls with the document's length."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def lengths_scaled(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    return 100 - 25 + (25 * n * docs) // max(terms, 1)


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Vocabulary:
    """The terms of a set of queries: their hashes in order, and per query its terms (by place) and their counts."""

    low: np.ndarray
    high: np.ndarray
    queries: list[tuple[np.ndarray, np.ndarray]]

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of each term, -1 for terms that no query asks for."""
        if len(self.low) == 0:
            return np.full(len(low), -1)
        at = np.minimum(np.searchsorted(self.low, low), len(self.low) - 1)
        return np.where((self.low[at] == low) & (self.high[at] == high), at, -1)


def vocabulary(texts: list[str | None]) -> Vocabulary:
    row, low, high, counts = term_hashes(pa.array(texts, pa.string()))
    terms, place = np.unique(low, return_inverse=True)
    second = np.zeros(len(terms), np.uint64)
    second[place] = high
    ends = np.cumsum(counts)
    queries = [np.unique(place[e - c : e], return_counts=True) for c, e in zip(counts, ends, strict=True)]
    return Vocabulary(terms, second, queries)


def _packed(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, lens: np.ndarray) -> dict:
    """The postings of a shard, ordered by term and document, as blocks."""
    new = np.ones(len(term), bool)
    new[1:] = term[1:] != term[:-1]
    lists = np.flatnonzero(new)
    counts = np.diff(np.r_[lists, len(term)])
    inside = np.arange(len(term)) - np.repeat(lists, counts)
    begin = np.flatnonzero(inside % BLOCK == 0)
    sizes = np.diff(np.r_[begin, len(term)])
    width = 1 if not len(tf) or tf.max() < 1 << 8 else 2 if tf.max() < 1 << 16 else 4
    some = len(term) > 0
    return {
        "terms": term[lists].astype(np.int32),
        "counts": counts.astype(np.int32),
        "tf_bytes": width,
        "places": (doc - np.repeat(doc[begin], sizes)).astype(np.uint16).tobytes(),
        "tfs": tf.astype(f"u{width}").tobytes(),
        "firsts": doc[begin].astype(np.int32).tobytes(),
        "lasts": doc[begin + sizes - 1].astype(np.int32).tobytes(),
        "max_tf": (np.maximum.reduceat(tf, begin) if some else tf).astype(np.int64).tobytes(),
        "min_len": (np.minimum.reduceat(lens[doc], begin) if some else tf).astype(np.int64).tobytes(),
    }


def index(docs: DataFrame, words: Vocabulary, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its documents and their lengths, and the blocks of all postings of asked terms."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
            + [("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("tf_bytes", pa.int32())]
            + [(b, pa.binary()) for b in BLOBS]
        )
        ids: list = []
        lens: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            n, key, tf = np.concatenate(lens), np.concatenate(keys), np.concatenate(times)
            order = np.argsort(key, kind="stable")
            key, tf = key[order], tf[order]
            made = {
                "shard": shard, "ids": ids, "lens": n, "n_docs": int((n > 0).sum()), "n_terms": int(n.sum()),
                **_packed(key >> 32, key & 0xFFFFFFFF, tf, n),
            }
            return pa.RecordBatch.from_pylist([made], schema)

        for batch in chunks(batches):
            owner, low, high, counts = term_hashes(batch.column("text"))
            place = words.find(low, high)
            hit = place >= 0
            # Ordered by term, then document; documents of later chunks have higher numbers.
            found, tf = np.unique((place[hit] << 32) + (owner[hit] + len(ids)), return_counts=True)
            ids += batch.column("doc_id").to_pylist()
            lens.append(counts.astype(np.int64))
            keys.append(found)
            times.append(tf.astype(np.int64))
            size += batch.column("text").nbytes
            # A batch adds 10,000 documents at most, so a place within a shard fits 16 bits.
            if len(ids) >= shard_docs or size >= shard_bytes:
                yield row()
                shard, ids, lens, keys, times, size = shard + 1, [], [], [], [], 0
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, INDEX_SCHEMA)


class Shard:
    """A shard opened for search. ``opened`` counts the blocks that were decompressed."""

    def __init__(self, row: dict, docs: int, terms: int):
        self.ids = row["ids"]
        self.m = lengths_scaled(np.asarray(row["lens"], np.int64), docs, terms)
        self.terms, counts = np.asarray(row["terms"], np.int64), np.asarray(row["counts"], np.int64)
        self.places = np.frombuffer(row["places"], np.uint16)
        self.tfs = np.frombuffer(row["tfs"], f"u{row['tf_bytes']}")
        self.firsts, self.lasts = (np.frombuffer(row[c], np.int32) for c in ("firsts", "lasts"))
        max_tf, min_len = (np.frombuffer(row[c], np.int64) for c in ("max_tf", "min_len"))
        self.bounds = impact(max_tf, lengths_scaled(min_len, docs, terms))
        self.begin = np.r_[0, np.cumsum(counts)]
        self.blocks = np.r_[0, np.cumsum(-(-counts // BLOCK))]
        self.bound = np.maximum.reduceat(self.bounds, self.blocks[:-1]) if len(counts) else counts
        self.score = np.zeros(len(self.ids), np.int64)
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.opened = 0

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of those of the terms that the shard has, and which these are."""
        if len(self.terms) == 0:
            return np.zeros(0, np.int64), np.zeros(len(terms), bool)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        have = self.terms[at] == terms
        return at[have], have

    def unpack(self, which: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks (numbered within the list) of a list."""
        self.opened += len(blocks)
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel() + self.begin[which]
        at = at[at < self.begin[which + 1]]
        block = self.blocks[which] + (at - self.begin[which]) // BLOCK
        doc = self.firsts[block] + self.places[at].astype(np.int64)
        return doc, impact(self.tfs[at].astype(np.int64), self.m[doc])

    def unpack_all(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """A whole list. Essential lists recur in many queries, so they stay unpacked as long as the shard is open."""
        if which not in self.whole:
            self.whole[which] = self.unpack(which, np.arange(self.blocks[which + 1] - self.blocks[which]))
        return self.whole[which]

    def candidates(self, lists: np.ndarray, factors: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score ``least`` or more (and above 0) and their exact scores."""
        none = np.zeros(0, np.int64)
        bound = factors * self.bound[lists]
        order = np.argsort(bound, kind="stable")
        lists, factors, bound = lists[order], factors[order], bound[order]
        reach = np.cumsum(bound)
        if len(lists) == 0 or reach[-1] < least:
            return none, none
        # Lists before the split are non-essential: all of them together stay below the least score.
        split = int(np.searchsorted(reach, least))
        for which, factor in zip(lists[split:].tolist(), factors[split:].tolist(), strict=True):
            doc, gain = self.unpack_all(which)
            self.score[doc] += factor * gain
        found = np.flatnonzero(self.score)
        score = self.score[found]
        self.score[found] = 0
        if split:
            near = score + reach[split - 1] >= least
            found, score = found[near], score[near]
            block, limit = np.zeros((split, len(found)), np.int64), np.zeros((split, len(found)), np.int64)
            for i in range(split):
                span = slice(self.blocks[lists[i]], self.blocks[lists[i] + 1])
                at = np.searchsorted(self.lasts[span], found)
                inside = at < len(self.lasts[span])
                at = np.where(inside, at, 0)
                inside &= self.firsts[span][at] <= found
                block[i], limit[i] = at, np.where(inside, factors[i] * self.bounds[span][at], 0)
            upper = score + limit.sum(0)
            for i in range(split - 1, -1, -1):
                near = upper >= least
                found, score, upper, block, limit = found[near], score[near], upper[near], block[:, near], limit[:, near]
                ask = np.flatnonzero(limit[i])
                if len(ask):
                    doc, gain = self.unpack(int(lists[i]), np.unique(block[i, ask]))
                    at = np.minimum(np.searchsorted(doc, found[ask]), len(doc) - 1)
                    exact = np.where(doc[at] == found[ask], factors[i] * gain[at], 0)
                    score[ask] += exact
                    upper[ask] += exact - limit[i, ask]
        good = (score >= least) & (score > 0)
        return found[good], score[good]


class Heap:
    """The k best documents of a query so far; equal scores by id, documents without one last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.k else 0

    def add(self, scores: np.ndarray, ids: list) -> None:
        if len(scores) > self.k:
            # Only documents with the k-th best score of these or a higher one may stay, ties included.
            floor = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = np.flatnonzero(scores >= floor)
            scores, ids = scores[keep], [ids[i] for i in keep.tolist()]
        rows = self.rows + list(zip(scores.tolist(), ids, strict=True))
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.k]


def _search(shards: DataFrame, words: Vocabulary, docs: int, terms: int, weights: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score): the k best of every query in the shards of each task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heap(k) for _ in words.queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], docs, terms)
                for heap, (asked, times) in zip(heaps, words.queries, strict=True):
                    lists, have = shard.lists(asked)
                    found, score = shard.candidates(lists, times[have] * weights[asked[have]], heap.least)
                    if len(found):
                        heap.add(score, [shard.ids[d] for d in found.tolist()])
        rows = [(q, i, s) for q, heap in enumerate(heaps) for s, i in heap.rows]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return shards.mapInArrow(find, "query long, doc_id long, score long")


def _rounds(benchmark: DataFrame, item: str, query_bytes: int) -> Iterator[list[tuple]]:
    """(item, text) of the distinct queries, in rounds of bounded size."""
    asked = benchmark.select(F.col(item).alias("item"), "text").dropDuplicates()
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = total // query_bytes + 1
    for number in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(rounds)) == number).collect()
        yield sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1] or ""))


def top_documents(docs: DataFrame, benchmark: DataFrame, k: int = 20, item: str = "item_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item, rank, doc_id, score): the k documents with the highest scores above 0 for each row of ``benchmark``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z as a-z. Null and empty
    texts have none: such documents are found by no query, such queries find nothing. Equal scores go by doc_id,
    null last. Every row of ``docs`` is a document, repeated ones too; repeated rows of ``benchmark`` are one
    query, and texts that share an item are ranked each by itself. Other columns are ignored; empty tables give no rows. Queries are
    searched in rounds of ``query_bytes`` of text, which bounds what is sent to the tasks.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item].dataType.simpleString()
    out = None
    for queries in _rounds(benchmark, item, query_bytes):
        words = vocabulary([text for _, text in queries])
        shards = stored(index(docs, words), "shards")
        docs_, terms = shards.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_docs", "n_terms"))).first()
        held = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"))
        weights = np.zeros(len(words.low), np.int64)
        for r in held.collect():
            weights[r["terms"]] = term_weight(docs_, r["df"])
        found = _search(shards, words, docs_, terms, weights, k)
        best = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(queries)], f"query long, item {kind}")
        part = ranked.join(F.broadcast(names), "query").select(F.col("item").alias(item), "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out
