"""Words and hashes of many texts at once, and two Spark helpers shared by the operators here.

Inside tasks a batch of texts is handled as one byte array. Words are runs of bytes outside
space and 0x09-0x0D, as the pattern ``[^\\x20\\x09-\\x0D]+`` finds them; a null text has none.
Hashes are 64 bits of a polynomial over bytes (words) or over word hashes (runs of words), finished by
a mixing step; ``seed`` picks independent ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.session import scratch_dir, settings

WORD = r"[^\x20\x09-\x0D]+"
# Text bytes handled at once by a task; a longer text is handled alone.
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Everything but ASCII letters and digits and bytes of longer characters.
NOT_TOKEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
# Odd multipliers of the polynomials, one per seed.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's multiplier and of its inverse, at least n of each."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        size, base = max(n, CHUNK_BYTES * 5 // 4), _BASES[seed]
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        have = (tables[0], tables[1])
        if n <= CHUNK_BYTES * 5 // 4:
            _POWERS[seed] = have
    return have


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal runs of values hash alike wherever they lie."""
    power, inverse = _powers(seed, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, row: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words of one row."""
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[: len(row) - size + 1] == row[size - 1 :])
    return at, segment_hashes(hashes, at, at + size, seed)


@dataclass
class Words:
    """Words of a column of texts: byte positions, the row of each, and where each row's words begin."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return segment_hashes(self.data, self.starts, self.ends, seed)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and the n + 1 places where its texts begin and end."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(column: pa.Array, lower: bool = False, breaks: np.ndarray = _SPACE) -> Words:
    """Find all words; ``lower`` turns A-Z into a-z first, ``breaks`` tells which bytes are in no word."""
    data, bounds = text_bytes(column)
    if lower:
        data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    space = breaks[data]
    begins, stops = ~space, ~space
    begins[1:] &= space[:-1]
    stops[:-1] &= space[1:]
    filled = np.flatnonzero(np.diff(bounds) > 0)
    begins[bounds[:-1][filled]] = ~space[bounds[:-1][filled]]
    stops[bounds[1:][filled] - 1] = ~space[bounds[1:][filled] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, bounds)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(data, bounds, starts, ends, row, first)


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece stay near ``limit`` bytes. Every row comes out once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if end > begin:
                yield batch.slice(begin, end - begin)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    # The shuffles behind a written table are of no more use, so their files go with the job.
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest node of each node's connected component, from distributed star contraction.

    ``links`` has long columns a and b. Returns (node, root) for every node of a link. Each round joins
    nothing: neighbours of a node are regrouped by their smallest one (large star, then small star), so
    the work per round is a grouping of the links and long chains halve. Null ends and loops are left out.
    """
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges, last = stored(edges, "links"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        edges = stored(
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
            .where(F.col("a") != F.col("b"))
            .distinct(),
            "links",
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
