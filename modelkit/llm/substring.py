"""Substring dedup by minimizer-dealt paths of token k-mers.

The windows of ``window`` words are the edges of a De Bruijn graph, whose nodes are not built. Edges are dealt
out by their minimizer, the smallest hash among the shorter k-mers of a window, so equal windows meet wherever
they stand. Windows that follow each other in a text and share the minimizer form a path. A join keeps the
minimizers that occur in more than one document, and paths are grouped by their digest: where all documents take
the same way through a minimizer (one digest) one row with its digest and its first document stands for all windows
of it. Where ways differ, one copy of every path is opened into its windows at its source coordinates,
and the windows themselves are joined. Digests have 128 bits of the words at those coordinates, from two
independent hashes of each word. Last,
each document's repeated windows are laid over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import Words, chunks, segment_hashes, signed, stored, window_hashes, words_of

WINDOW, KMER = 50, 16
# Windows of one path; a longer one (a text that repeats itself) goes on as a further path.
PATH_WINDOWS = 4096
NAMES = ("minimizer", "digest_a", "digest_b", "doc_id", "start", "windows")


def paths_of(w: Words, hashes: np.ndarray, window: int, kmer: int) -> dict[str, np.ndarray]:
    """Maximal runs of windows of one text that share a minimizer: row, minimizer, first word, number of windows."""
    empty = np.zeros(0, np.int64)
    at, kmers = window_hashes(hashes, w.row, kmer)
    span = window - kmer + 1  # k-mers of a window
    if len(kmers) < span:
        return {"row": empty, "minimizer": np.zeros(0, np.uint64), "start": empty, "windows": empty}
    # Smallest of each run of ``span`` k-mers, from runs of doubling length.
    least, length = kmers, 1
    while length * 2 <= span:
        least = np.minimum(least[: len(least) - length], least[length:])
        length *= 2
    least = np.minimum(least[: len(kmers) - span + 1], least[span - length : len(kmers) - length + 1])
    row = w.row[at]
    whole = np.flatnonzero(row[: len(row) - span + 1] == row[span - 1 :])
    start, least, row = at[whole], least[whole], row[whole]
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(start)])
    if len(size) and size.max() > PATH_WINDOWS:
        parts = -(-size // PATH_WINDOWS)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(size, parts) - step * PATH_WINDOWS
        begin, size = np.repeat(begin, parts) + step * PATH_WINDOWS, np.minimum(left, PATH_WINDOWS)
    return {"row": row[begin], "minimizer": least[begin], "start": start[begin], "windows": size}


def digests_of(w: Words, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """Both halves of the digests of runs of words; ``hashes`` are those of seed 0. Each half has word hashes of its own."""
    return [pa.array(signed(segment_hashes(h, starts, ends, seed))) for seed, h in enumerate((hashes, w.hashes(1)))]


def _paths(docs: DataFrame, window: int, kmer: int, digests: bool) -> DataFrame:
    """Paths of all documents; only (minimizer, doc_id) without ``digests``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = words_of(batch.column("text"))
            hashes = w.hashes()
            p = paths_of(w, hashes, window, kmer)
            ids = batch.column("doc_id").take(pa.array(p["row"]))
            if not digests:
                yield pa.RecordBatch.from_arrays([pa.array(signed(p["minimizer"])), ids], ["minimizer", "doc_id"])
                continue
            ends = p["start"] + p["windows"] + window - 1
            both = digests_of(w, hashes, p["start"], ends)
            place = [pa.array((p["start"] - w.first[p["row"]]).astype(np.int32)), pa.array(p["windows"].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(signed(p["minimizer"])), *both, ids, *place], list(NAMES))

    schema = f"minimizer long, digest_a long, digest_b long, doc_id {kind}, start int, windows int" if digests else f"minimizer long, doc_id {kind}"
    return docs.mapInArrow(find, schema)


def _windows(paths: DataFrame, window: int) -> DataFrame:
    """Open paths (their columns and the text of their source) into windows: (path, place, window_a, window_b, source)."""

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = words_of(batch.column("text"))
            hashes = w.hashes()
            lists = batch.column("paths")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            start, size = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
            which = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            first = w.first[owner[which]] + start[which] + place
            both = digests_of(w, hashes, first, first + window)
            index = pa.array(which)
            own = [flat.field(c).take(index) for c in ("minimizer", "digest_a", "digest_b")]
            ids = batch.column("doc_id").take(pa.array(owner[which]))
            yield pa.RecordBatch.from_arrays([*own, pa.array(place.astype(np.int32)), *both, ids], ["minimizer", "digest_a", "digest_b", "place", "window_a", "window_b", "first"])

    kind = paths.schema["doc_id"].dataType.simpleString()
    return paths.mapInArrow(open_, f"minimizer long, digest_a long, digest_b long, place int, window_a long, window_b long, first {kind}")


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(doc_id, start, windows, firsts): paths of each document that hold repeated windows.

    ``firsts`` has the smallest doc_id of every window of the path, or is null where all are repeated.
    """
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    shared = (
        _paths(texts, window, kmer, digests=False)
        .groupBy("minimizer")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select("minimizer")
    )
    paths = stored(_paths(texts, window, kmer, digests=True).join(shared, "minimizer", "left_semi"), "paths")
    path = ["minimizer", "digest_a", "digest_b"]
    compact = stored(paths.groupBy(*path, "windows").agg(F.min(F.struct("doc_id", "start")).alias("source")), "compact")
    branching = compact.groupBy("minimizer").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1").select("minimizer")
    opened = compact.join(branching, "minimizer", "left_semi").select(*path, "windows", F.col("source.doc_id").alias("doc_id"), F.col("source.start").alias("start"))
    asked = opened.groupBy("doc_id").agg(F.collect_list(F.struct(*path, "start", "windows")).alias("paths"))
    at_source = asked.join(texts, "doc_id")
    edges = _windows(at_source.select("doc_id", "text", "paths"), window)
    edges = stored(edges, "edges")
    # Windows of more than one source. They are stored, so that the join deals them out anew and a window that
    # very many paths share can be split.
    least = edges.groupBy("window_a", "window_b").agg(F.min("first").alias("least"), F.max("first").alias("most"))
    least = stored(least.where("least < most").drop("most"), "least")
    ways = (
        edges.join(least, ["window_a", "window_b"], "left")
        .withColumn("least", F.coalesce("least", "first"))
        .groupBy(*path)
        .agg(F.array_sort(F.collect_set(F.struct("place", "least"))).alias("firsts"))
        .select(*path, F.col("firsts.least").alias("firsts"))
    )
    known = compact.join(ways, path, "left").select(*path, "windows", F.col("source.doc_id").alias("first"), "firsts")
    # A path is of use to documents after its first one, or after the first one of any of its windows.
    earliest = F.coalesce(F.array_min("firsts"), F.col("first"))
    met = paths.join(known.withColumn("earliest", earliest), [*path, "windows"]).where("doc_id > earliest")
    return met.select("doc_id", "start", "windows", F.when(F.col("first") >= F.col("doc_id"), F.col("firsts")).alias("firsts"))


def dedup(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_removed and kept_text.

    A word is removed if a window of ``window`` words that covers it also starts in a document with a
    smaller doc_id; windows are judged on the input. Kept words are joined by one space. Null texts are
    empty; a row without doc_id loses nothing and repeats nothing for others. A row that is repeated whole
    stands for one document, and all its copies come out. Other columns are ignored; an empty table stays empty.
    """
    spans = repeated_spans(docs, window, kmer)
    marks = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", "firsts")).alias("spans"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(marks, "doc_id", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            spans = batch.column("spans")
            n_words, n_removed, kept = [], [], []
            for i, own in enumerate(ids):
                words = texts[i].as_py().encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for span in spans[i].as_py() or ():
                    start, size = span["start"], span["windows"]
                    if span["firsts"] is None:
                        gone[start] += 1
                        gone[start + size + window - 1] -= 1
                    else:
                        at = start + np.flatnonzero(np.asarray(span["firsts"]) < own)
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + window, -1)
                out = np.cumsum(gone)[:-1] > 0
                n_words.append(len(words))
                n_removed.append(int(out.sum()))
                kept.append(b" ".join(words if not out.any() else [words[k] for k in np.flatnonzero(~out)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return rows.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
