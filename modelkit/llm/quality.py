"""Quality rules: boosted trees over document statistics, with base rules that always reject.

Statistics are exact and per row, so the table is read once and nothing is shuffled. Trees are fitted on
the statistics of a bounded sample of labelled documents and scored inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.llm.boost import Trees, fit
from modelkit.llm.common import chunks, mix, segment_hashes, window_hashes, words_of

# Labelled documents that the trees are fitted on, those with the smallest hash of their id.
SAMPLE = 20_000
# Fewer labels than this, or labels of one kind only, leave the base rules alone to decide.
LEAST_LABELS = 40
# A document is rejected if the trees give it less than this chance of being good.
CUT = 0.5

# Statistics the trees see, and whether the score may only fall (-1) as one grows.
FEATURES = {
    "words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines_share": -1,
    "repeat_share": -1,
    "upper_share": 0,
    "exclaims_per_word": -1,
    "bars_per_word": -1,
    "digits_per_word": 0,
    "distinct_share": 0,
    "words_per_line": 0,
    "stops_per_word": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _flags(codes: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(codes.encode())] = 1
    return table


SYMBOLS, BARS, EXCLAIMS, DIGITS = _flags("#*$%&|<>"), _flags("|"), _flags("!?"), _flags("0123456789")
UPPER, LOWER, STOPS = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz"), _flags(".,;:")


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts and the feature matrix of a column of texts."""
    w = words_of(column)
    n = len(column)

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[w.bounds[1:]] - total[w.bounds[:-1]]

    def per_row(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n)[:n].astype(np.int64)

    hashes, salt = w.hashes(), mix(np.arange(1, n + 1).astype(np.uint64))
    # Words in windows of three that occur twice or more in their text.
    at, windows = window_hashes(hashes, w.row, 3)
    _, which, times = np.unique(windows ^ salt[w.row[at]], return_inverse=True, return_counts=True)
    again = at[times[which] > 1]
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[again + k] = True
    # Lines, cut at \n and at the ends of texts.
    breaks = np.flatnonzero(w.data == 10)
    begins = np.sort(np.concatenate([w.bounds[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, w.bounds[1:]]))
    line_row = np.repeat(np.arange(n), per_text(w.data == 10) + 1)
    line_words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, begins)
    full = line_words > 0
    lines = segment_hashes(w.data, begins[full], ends[full]) ^ salt[line_row[full]]
    _, firsts = np.unique(lines, return_index=True)
    dup = np.ones(len(lines), bool)
    dup[firsts] = False
    n_words = w.counts
    base = {
        "n_words": n_words,
        "word_chars": np.bincount(w.row, _code_points(w), minlength=n)[:n].astype(np.int64),
        "n_symbols": per_text(SYMBOLS[w.data]),
        "n_dup_lines": per_row(line_row[full][dup]),
        "n_repeat_words": per_row(w.row[covered]),
    }
    some = np.maximum(n_words, 1)
    upper, lower = per_text(UPPER[w.data]), per_text(LOWER[w.data])
    _, kinds = np.unique(hashes ^ salt[w.row], return_index=True)
    full_lines = per_row(line_row[full])
    features = np.stack(
        [
            np.minimum(n_words, 2000),
            base["word_chars"] / some,
            base["n_symbols"] / some,
            base["n_dup_lines"] / np.maximum(full_lines, 1),
            base["n_repeat_words"] / some,
            upper / np.maximum(upper + lower, 1),
            per_text(EXCLAIMS[w.data]) / some,
            per_text(BARS[w.data]) / some,
            per_text(DIGITS[w.data]) / some,
            per_row(w.row[kinds]) / some,
            n_words / np.maximum(full_lines, 1),
            per_text(STOPS[w.data]) / some,
        ],
        axis=1,
    ).astype(float)
    return base, features


def _code_points(w) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    return total[w.ends] - total[w.starts]


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Fit the trees on at most ``sample`` labelled documents.

    Labels that are null are left out and a document labelled twice counts by its higher label. Only the
    sample's statistics reach the driver. None if there are too few labels to learn from.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    names = list(FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            _, x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column("good")], [*names, "good"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("text", (F.col("quality") > 0).cast("double").alias("good")).mapInArrow(
        measure, ", ".join(f"{c} double" for c in [*names, "good"])
    )
    table = rows.toPandas().sort_values([*names, "good"])
    x, y = table[names].to_numpy(), table["good"].to_numpy()
    if len(y) < LEAST_LABELS or y.min() == y.max():
        return None
    return fit(x, y, list(FEATURES.values()))


def score(docs: DataFrame, model: Trees | None, cut: float = CUT) -> DataFrame:
    """All columns of ``docs``, then the base counts, ``base_failed``, ``quality_score`` and ``kept``.

    Null and empty texts have no words and fail the base rules. Rows are judged one by one, so repeated
    rows get the same verdict; an empty table stays empty. Columns of ``docs`` that bear one of the new
    names are replaced.
    """
    added = {**dict.fromkeys(BASE, "long"), "base_failed": "boolean", "quality_score": "double", "kept": "boolean"}
    docs = docs.drop(*added)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            base, x = statistics(batch.column("text"))
            failed = base_failed(base)
            good = np.ones(len(failed)) if model is None else model.probability(x)
            new = [*(base[c] for c in BASE), failed, good, ~failed & (good >= cut)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new)], [*batch.schema.names, *added])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"{k} {v}" for k, v in added.items()]
    )
    return docs.mapInArrow(judge, schema)
