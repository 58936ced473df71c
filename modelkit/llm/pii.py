"""Personal data: exact base patterns, and a conditional random field over word shapes that adds spans.

The field is trained on a small hand-labelled table of lines (``hand_labelled``; a caller may bring another, or have
``training_table`` label lines of the texts by the base patterns). It adds what the patterns do not know: names, addresses, dates of
birth, spaced and bracketed numbers, spelled-out mail. Each task tags whole batches: sentences are the chains, every word
is reduced to a few shape features and those of its neighbours, and Viterbi runs over all chains of a batch at once. Rows are tagged
one by one, so nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.llm import crf
from modelkit.llm.pii_lines import CUES, LINES
from modelkit.llm.common import Words, chunks, words_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS, "person", "address", "birth")
# Documents with base spans, and lines of them, that the training table is built from at most.
TRAIN_DOCS, TRAIN_LINES, TRAIN_WORDS = 400, 600, 60

# The base patterns.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LOOKS_DIGITAL = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses: from each @ back over its local part and on over its domain, each @ looked at once."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start and then kind."""
    spans = []
    if "@" in text:
        spans += [(s, 0, e) for s, e in emails(text)]
    if LOOKS_DIGITAL.search(text):
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.groups())]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(spans)


# --- word shapes --------------------------------------------------------------------------------------

_CLASS = {name: np.isin(np.arange(256), list(codes)).astype(np.int64) for name, codes in {
    "digit": b"0123456789", "at": b"@", "dot": b".", "hyphen": b"-", "paren": b"()", "plus": b"+",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "stop": b".!?",
}.items()}
# Most that each count is told apart up to, in the order of the shape code.
_STEPS = {"digit": 20, "at": 2, "dot": 5, "hyphen": 3, "paren": 2, "plus": 2, "upper": 2, "lower": 2}


def shapes(w: Words) -> np.ndarray:
    """A number per word that says how many digits, dots, letters and so on it has, up to a limit each, and if long digits pass Luhn."""
    code = np.zeros(len(w.starts), np.int64)
    for name, limit in _STEPS.items():
        total = np.concatenate([[0], np.cumsum(_CLASS[name][w.data])])
        count = np.minimum(total[w.ends] - total[w.starts], limit - 1)
        code = code * limit + count
        if name == "digit":
            many = np.flatnonzero(count >= 14)
    checked = np.zeros(len(code), np.int64)
    for i in many.tolist():
        digits = bytes(c for c in w.data[w.starts[i] : w.ends[i]] if 48 <= c <= 57).decode()
        checked[i] = len(digits) <= 19 and luhn(digits)
    return code * 2 + checked


def shape_features(codes: np.ndarray) -> np.ndarray:
    """One-hot counts, and counts of digits apart for words with and without letters, per shape code."""
    parts, rest, checked = {}, codes // 2, codes % 2
    for name, limit in reversed(_STEPS.items()):
        parts[name], rest = rest % limit, rest // limit
    blocks = [np.eye(limit)[parts[name]] for name, limit in _STEPS.items()]
    letters = (parts["upper"] + parts["lower"]) > 0
    blocks.append(np.eye(20)[parts["digit"]] * ~letters[:, None])
    mixed = [letters & (parts["digit"] > 0), letters & (parts["at"] > 0) & (parts["dot"] > 0), parts["at"] > 0, checked > 0, np.ones(len(codes), bool)]
    return np.concatenate([*blocks, np.stack(mixed, 1).astype(float)], 1)


@cache
def _cue_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all spellings of the cues, in order, and the number of each one's kind."""
    spelled = {}
    for kind, words in enumerate(CUES.values(), 1):
        for word in words.split():
            for form in (word, word.capitalize(), word.upper()):
                for mark in ("", ".", ",", ":", ";", ".:"):
                    spelled.setdefault(form + mark, kind)
    w = words_of(pa.array(list(spelled)))
    order = np.argsort(w.hashes())
    return w.hashes()[order], np.array(list(spelled.values()))[order]


def cues(w: Words) -> np.ndarray:
    """Number of the kind of cue that each word is, 0 for others."""
    known, kind = _cue_hashes()
    hashes = w.hashes()
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, kind[at], 0)


def contexts(w: Words, cue: np.ndarray) -> np.ndarray:
    """A small number per word that says what its neighbours see: cue, digits, and whether it begins with a capital letter."""
    lead, second = w.data[w.starts], w.data[np.minimum(w.starts + 1, max(len(w.data) - 1, 0))] if len(w.starts) else w.data[:0]
    capital = (lead >= 65) & (lead <= 90) | (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    total = np.concatenate([[0], np.cumsum(_CLASS["digit"][w.data])])
    digits = total[w.ends] > total[w.starts]
    return cue * 4 + digits * 2 + capital


# Contexts are below this number; the next one stands for no neighbour in the line.
CONTEXTS = 4 * (len(CUES) + 1)


def neighbours(w: Words, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of the word before and after each word in its line."""
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    before, after = np.full(len(context), CONTEXTS), np.full(len(context), CONTEXTS)
    if len(context) > 1:
        near = (w.row[1:] == w.row[:-1]) & (lines[w.starts[1:]] == lines[w.ends[:-1]])
        before[1:][near], after[:-1][near] = context[:-1][near], context[1:][near]
    return before, after


def context_features() -> np.ndarray:
    """Features of every context, the one for no neighbour last."""
    numbers = np.arange(CONTEXTS)
    out = np.zeros((CONTEXTS + 1, len(CUES) + 4))
    out[numbers, numbers // 4] = 1
    out[numbers, len(CUES) + 1] = numbers // 2 % 2
    out[numbers, len(CUES) + 2] = numbers % 2
    out[CONTEXTS, len(CUES) + 3] = 1
    return out


def sentences(w: Words) -> np.ndarray:
    """Words per chain: a chain ends with its line or text, or after a word that ends in . ! or ? and has letters or no digits."""
    if len(w.starts) == 0:
        return np.zeros(0, np.int64)
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    digits = np.concatenate([[0], np.cumsum(_CLASS["digit"][w.data])])
    stop = (_CLASS["stop"][w.data[w.ends - 1]] > 0) & (digits[w.ends] == digits[w.starts])
    last = np.ones(len(w.starts), bool)
    last[:-1] = (w.row[1:] != w.row[:-1]) | (lines[w.starts[1:]] != lines[w.ends[:-1]]) | stop[:-1]
    return np.diff(np.r_[-1, np.flatnonzero(last)])


def widths() -> list[int]:
    """Features of a word's shape, and of the contexts of itself, the word before and the word after."""
    return [shape_features(np.zeros(1, np.int64)).shape[1], *[context_features().shape[1]] * 3]


def word_features(w: Words) -> np.ndarray:
    context = contexts(w, cues(w))
    of_context = context_features()
    return np.concatenate([shape_features(shapes(w)), *(of_context[c] for c in (context, *neighbours(w, context)))], 1)


def tag(chain: crf.Chain, w: Words) -> np.ndarray:
    """Label number of every word.

    A word that leaves "none" changes two moves at most. Where every word of a chain prefers "none" by more
    than two moves and the start can win, the best labels are all "none" and the chain need not be decoded.
    """
    labels = np.zeros(len(w.starts), np.int8)
    lengths = sentences(w)
    if len(lengths) == 0:
        return labels
    context = contexts(w, cues(w))
    before, after = neighbours(w, context)
    code, which = np.unique(shapes(w), return_inverse=True)
    parts = np.split(chain.emit, np.cumsum(widths())[:-1])
    of_context = context_features()
    scores = (shape_features(code) @ parts[0])[which]
    for part, seen in zip(parts[1:], (context, before, after), strict=True):
        scores += (of_context @ part)[seen]
    margin = scores[:, 0] - scores[:, 1:].max(1)
    gain = 2 * max(0.0, chain.move.max() - chain.move[0, 0]) + max(0.0, chain.start.max() - chain.start[0])
    first = np.cumsum(lengths) - lengths
    open_ = np.logical_or.reduceat(margin <= gain, first)
    at = np.flatnonzero(np.repeat(open_, lengths))
    labels[at] = chain.decode(scores[at], lengths[open_])
    return labels


# --- training -----------------------------------------------------------------------------------------


def labelled_lines(lines: Sequence[str]) -> list[tuple[str, list[int]]]:
    """(line, labels) of lines in which spans are marked as [kind|words]; labels are one number per word."""
    rows = []
    for line in lines:
        words: list[str] = []
        labels: list[int] = []
        for plain, kind, marked in re.findall(r"([^\[]*)(?:\[([a-z]+)\|([^\]]*)\])?", line):
            for part, label in ((plain, 0), (marked, LABELS.index(kind) if kind else 0)):
                words += part.split()
                labels += [label] * len(part.split())
        rows.append((" ".join(words), labels))
    return rows


def hand_labelled(spark: SparkSession) -> DataFrame:
    """The labelled table that comes with the library: (line, labels)."""
    return spark.createDataFrame(labelled_lines(LINES), "line string, labels array<long>")


def training_table(docs: DataFrame, docs_at_most: int = TRAIN_DOCS) -> DataFrame:
    """A small labelled table (line, labels): up to ``docs_at_most`` texts with base spans, cut into lines.

    Labels are one number per word, that of the base span which covers the word. The texts are those with
    the smallest hash, so the table is bounded and the same at every run. Lines with a digit or @ are taken,
    labelled or not, cut to ``TRAIN_WORDS`` words around the first; this bounds training, not tagging.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, labels = [], []
            for text in batch.column("text").to_pylist():
                for line in text.split("\n"):
                    words = list(re.finditer(r"[^\x20\x09-\x0D]+", line))
                    tags = [0] * len(words)
                    begins, ends = [m.start() for m in words], [m.end() for m in words]
                    for s, kind, e in base_spans(line):
                        for i in range(bisect_right(ends, s), bisect_left(begins, e)):
                            tags[i] = kind + 1
                    near = [i for i, m in enumerate(words) if tags[i] or LOOKS_DIGITAL.search(m[0]) or "@" in m[0]]
                    if near:
                        begin = max(0, near[0] - TRAIN_WORDS // 2)
                        part = slice(begin, begin + TRAIN_WORDS)
                        lines.append(" ".join(m[0] for m in words[part]))
                        labels.append(tags[part])
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(labels, pa.list_(pa.int64()))], ["line", "labels"])

    likely = F.col("text").rlike(r"@[A-Za-z0-9-]+\.|[0-9]{4}|\+[0-9]|[0-9]+\.[0-9]+\.[0-9]")
    # The hashes are chosen first, so that texts are not gathered to be put in order.
    rows = docs.where(likely).select("text", F.xxhash64("text").alias("hash"))
    least = rows.select("hash").distinct().orderBy("hash").limit(docs_at_most)
    chosen = rows.join(F.broadcast(least), "hash").select("text").distinct()
    return chosen.mapInArrow(label, "line string, labels array<long>")


def train(table: DataFrame, lines_at_most: int = TRAIN_LINES) -> crf.Chain | None:
    """Fit the field on at most ``lines_at_most`` labelled lines, those with the smallest hash; None if the table has none."""
    usable = table.select("line", "labels").where("line != '' and size(labels) > 0")
    least = usable.orderBy(F.xxhash64("line", "labels"), "line", "labels").limit(lines_at_most)
    rows = sorted((r["line"], tuple(r["labels"])) for r in least.collect())
    if not rows:
        return None
    w = words_of(pa.array([line for line, _ in rows], pa.string()))
    labels = np.concatenate([np.asarray(tags) for _, tags in rows])
    if len(labels) != len(w.starts):
        raise ValueError("a line's labels must be as many as its words")
    lengths = sentences(w)
    return crf.fit(word_features(w), labels, np.repeat(np.arange(len(lengths)), lengths), len(LABELS))


# --- finding ------------------------------------------------------------------------------------------


def plausible(kind: str, piece: str) -> bool:
    """What a span of each kind has at least: runs of repeated words and the like are none."""
    digits, words = sum(c.isdigit() for c in piece), piece.split()
    if kind == "person":
        return len(words) <= 5 and len(set(words)) == len(words) and all(c.isalpha() or c in " .'’-" for c in piece)
    if kind == "email":
        return "@" in piece or {"at", "dot"} <= {w.strip("()[]").lower() for w in words}
    return digits >= {"ip": 4, "card": 12, "phone": 7, "birth": 4, "address": 1}[kind] and len(words) <= 10


def added_spans(text: str, words: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, str, int]]:
    """Spans of tagged words (start byte, end byte, label): neighbours of one label are one span, free of edge marks and of base spans,
    if it has what its kind needs."""
    raw = text.encode()
    runs: list[list[int]] = []
    for start, end, label in words:
        if runs and runs[-1][2] == label and not raw[runs[-1][1] : start].strip(b" "):
            runs[-1][1] = end
        else:
            runs.append([start, end, label])
    # Code points before each byte, and the furthest end of the base spans up to each one.
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    begins = [s for s, _, _ in base]
    reach = np.maximum.accumulate([e for _, _, e in base]).tolist() if base else []
    found = []
    for start, end, label in runs:
        piece = raw[start:end].decode()
        inner = piece.strip(".,;:!?\"'<>[]{}|*#$%&")
        if not inner or not plausible(LABELS[label], inner):
            continue
        s = int(chars[start]) + piece.index(inner)
        e = s + len(inner)
        earlier = bisect_left(begins, e)
        if not (earlier and reach[earlier - 1] > s):
            found.append((s, "crf_" + LABELS[label], e))
    return found


def find(docs: DataFrame, chain: crf.Chain | None, key: str = "doc_id") -> DataFrame:
    """(key, spans) per row: spans is an array of (kind, start, end) in code points by start, base kinds first.

    A null text counts as empty and has no spans. Rows are independent: repeated rows and null keys are
    kept, other columns are ignored, an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            column = batch.column("text")
            texts = [t or "" for t in column.to_pylist()]
            base = [base_spans(t) for t in texts]
            marked: dict[int, list[tuple[int, int, int]]] = {}
            if chain is not None:
                w = words_of(column)
                labels = tag(chain, w)
                for i in np.flatnonzero(labels).tolist():
                    row = int(w.row[i])
                    off = int(w.bounds[row])
                    marked.setdefault(row, []).append((int(w.starts[i]) - off, int(w.ends[i]) - off, int(labels[i])))
            spans = []
            for row, (text, own) in enumerate(zip(texts, base, strict=True)):
                more = added_spans(text, marked[row], own) if row in marked else []
                merged = [(s, i, KINDS[i], e) for s, i, e in own] + [(s, len(KINDS), k, e) for s, k, e in more]
                spans.append([{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(merged)])
            shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(spans, shape)], [key, "spans"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return found.select(key, *map(of, KINDS), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
