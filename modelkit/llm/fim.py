"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in another order.

Cuts lie between units (words with the white space before them). Work is on bytes, results are in code points. A
sparse exception index converts between both: it records only the characters of more than one byte, where they are and how
many bytes they have in excess. A cut is looked up by binary search; between exceptions it is arithmetic, so
plain ASCII text costs nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import chunks, words_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"


@dataclass(frozen=True)
class Exceptions:
    """The characters of a run of texts that have more than one byte: places in bytes and in code points, and
    the bytes in excess up to each of them, it included. Places count from the beginning of the run."""

    byte_at: np.ndarray
    char_at: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Exceptions:
        byte_at = np.flatnonzero(data >= 0xC0)
        lead = data[byte_at]
        excess = np.r_[0, np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))]
        return cls(byte_at, byte_at - excess[:-1], excess)

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place; places lie between characters."""
        return places - self.excess[np.searchsorted(self.byte_at, places)]

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        """Bytes before each code point place."""
        return places + self.excess[np.searchsorted(self.char_at, places)]


def cut_places(first: np.ndarray, ends: np.ndarray, bounds: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Byte place after so many units of each text: the end of that word, or the end of the text beyond its last word."""
    n_words = np.diff(first)
    word = np.clip(first[:-1] + units - 1, 0, max(len(ends) - 1, 0))
    inside = ends[word] if len(ends) else np.zeros(len(units), np.int64)
    return np.where(units == 0, bounds[:-1], np.where(units <= n_words, inside, bounds[1:]))


def hashes_of(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 drawn from a row's key; a null key is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every row of ``docs``, in its ``text`` column.

    ``rate`` per cent of the texts are cut, ``spm`` per cent of these put the suffix first. The draws depend on the
    seed and the key alone. A text with one of the marks in it stays plain, so outputs can be taken apart
    again, as do null and empty texts (both give an empty output). A null key draws as the empty string; rows are handled one
    by one, so keys may repeat. Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = pc.fill_null(batch.column("text"), "")
            w = words_of(texts)
            size = len(texts)
            # White space after the last word, or all of a text without words, is one more unit.
            last = np.where(w.counts > 0, w.ends[np.clip(w.first[1:] - 1, 0, None)] if len(w.ends) else 0, w.bounds[:-1])
            n = w.counts + (last < w.bounds[1:])
            h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in range(1, 5))
            a, b = h1 % (n + 1), h2 % (n + 1)
            begin, end = (cut_places(w.first, w.ends, w.bounds, u) for u in (np.minimum(a, b), np.maximum(a, b)))
            index = Exceptions.of(w.data)
            zero, x, y = (index.to_chars(p) for p in (w.bounds[:-1], begin, end))
            marked = pc.match_substring_regex(texts, MARKS).to_numpy(zero_copy_only=False)
            plain = marked | (np.diff(w.bounds) == 0) | (h3 % 100 >= rate)
            first_suffix = h4 % 100 < spm
            data, out = memoryview(w.data.tobytes()), []
            for row in range(size):
                s, i, j, e = w.bounds[row], begin[row], end[row], w.bounds[row + 1]
                if plain[row]:
                    parts = [data[s:e]]
                elif first_suffix[row]:
                    parts = [b"<S>", data[j:e], b"<P>", data[s:i], b"<M>", data[i:j]]
                else:
                    parts = [b"<P>", data[s:i], b"<S>", data[j:e], b"<M>", data[i:j]]
                out.append(b"".join(parts))
            form = np.where(plain, "plain", np.where(first_suffix, "spm", "psm"))
            chars = [pa.array(c, pa.int64(), mask=plain) for c in (x - zero, y - x)]
            output = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n.astype(np.int64)), pa.array(form.tolist(), pa.string()), *chars, output], names)

    rows = docs.select(F.col(key).alias("key"), "text", *hashes_of(F.col(key), seed))
    made = rows.mapInArrow(cut, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    parts = F.split(output, MARKS, -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    whole = {name: F.concat(*(F.get(parts, F.lit(i)) for i in places)) for name, places in order.items()}
    return F.when(form == "psm", whole["psm"]).when(form == "spm", whole["spm"]).otherwise(output)
