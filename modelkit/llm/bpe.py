"""Byte-level BPE by replaying merges over many words at once.

The distinct pre-tokens of the corpus are laid end to end as bytes. An inverted index leads from each token pair, by the
rank of what it merges to, to the places where it stands. Merges are applied in rank order, each to all its places
at once, and only the two pairs beside a merged one are looked up anew. The pre-tokens that make up most of the corpus
are replayed once for all documents, dealt to tasks by hash, and handed on as a table of bounded size; the rest
are replayed the same way in the block of texts where they stand, so no text and no id is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import chunks, stored
from modelkit.llm.tokens import PATTERN, SPACES, cutter

# Units that a task counts or remembers, and the share of pre-tokens that are handed to all tasks.
HELD, COMMON = 200_000, 200_000
# Bytes of texts whose words are replayed together.
REPLAY_BYTES = 4 << 20
# Places of a merge up to which they are handled one by one instead of as arrays.
FEW = 60


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank per line) by rank."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in rows))
    for token, rank in rows:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _distinct(places: np.ndarray) -> np.ndarray:
    """Distinct places in order."""
    places = np.sort(places)
    return places[np.r_[True, places[1:] != places[:-1]]] if len(places) else places


class Merges:
    """The ranks of a vocabulary, ready for replay."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        rank = {t: r for r, t in enumerate(tokens) if t}
        self.rank = rank
        lacking = [b for b in range(256) if bytes([b]) not in rank]
        if lacking:
            raise ValueError(f"no token for the bytes {lacking}")
        self.of_byte = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        # All pairs that merge: first token << 32 | second, in order, and the rank of what they merge to.
        found = {}
        for t, r in rank.items():
            for i in range(1, len(t)):
                a, b = rank.get(t[:i]), rank.get(t[i:])
                if a is not None and b is not None:
                    found[(a << 32) | b] = r
        self.found = found
        self.pairs = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.pairs.tolist()], np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of what each two tokens merge to, -1 if nothing."""
        if len(self.pairs) == 0:
            return np.full(len(a), -1)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words end to end, and how many each has.

        Every word is merged as by itself: always its pair of the lowest rank, the leftmost of equal ones.
        """
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _Replay(self, words).run()


class _Replay:
    """Words end to end. A live place holds a token, its neighbours in the word and the rank of the pair it begins."""

    def __init__(self, merges: Merges, words: list[bytes]):
        self.merges = merges
        data = np.frombuffer(b"".join(words), np.uint8)
        self.starts = np.r_[0, np.cumsum([len(w) for w in words])]
        n = len(data)
        self.token = merges.of_byte[data]
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = self.starts[:-1] < self.starts[1:]
        self.after[self.starts[1:][filled] - 1] = -1
        self.before[self.starts[:-1][filled]] = -1
        self.pair = np.full(n, -1)
        inner = np.flatnonzero(self.after >= 0)
        self.pair[inner] = merges.merged(self.token[inner], self.token[inner + 1])
        # The inverted index: rank of a pair's merge to the places where such a pair was seen, by ones and by arrays.
        self.ones: dict[int, list[int]] = {}
        self.many: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []
        self.post(inner)

    def post(self, places: np.ndarray) -> None:
        """Enter the pairs that begin at these places into the index."""
        rank = self.pair[places]
        places, rank = places[rank >= 0], rank[rank >= 0]
        if len(places) == 0:
            return
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        begin = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
        ends = [*begin[1:].tolist(), len(rank)]
        for value, s, e in zip(rank[begin].tolist(), begin.tolist(), ends, strict=True):
            if value not in self.many and value not in self.ones:
                heapq.heappush(self.heap, value)
            self.many.setdefault(value, []).append(places[s:e])

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        while self.heap:
            rank = heapq.heappop(self.heap)
            ones, many = self.ones.pop(rank, []), self.many.pop(rank, [])
            if len(ones) + sum(map(len, many)) <= FEW:
                self.apply_each(rank, sorted({*ones, *(p for a in many for p in a.tolist())}))
            else:
                self.apply_all(rank, _distinct(np.concatenate([np.array(ones, np.int64), *many])))
        alive = self.token >= 0
        total = np.r_[0, np.cumsum(alive)]
        return self.token[alive], total[self.starts[1:]] - total[self.starts[:-1]]

    def apply_all(self, rank: int, p: np.ndarray) -> None:
        """Apply a merge at all places at once. Words in which it would give a pair of lower rank go step by step."""
        merges, token, after, before, pair = self.merges, self.token, self.after, self.before, self.pair
        p = p[pair[p] == rank]
        q = after[p]
        right, left = after[q], before[p]
        new = np.where(right >= 0, merges.merged(np.full(len(p), rank), token[right]), -1)
        old = np.where(left >= 0, merges.merged(token[left], np.full(len(p), rank)), -1)
        lower = ((new >= 0) & (new < rank)) | ((old >= 0) & (old < rank))
        twice = merges.found.get((rank << 32) | rank, -1)
        if 0 <= twice < rank:
            lower[:] = True
        if lower.any():
            word = np.searchsorted(self.starts, p, side="right")
            slow = np.isin(word, word[lower])
            self.apply_each(rank, p[slow].tolist())
            p, q = p[~slow], q[~slow]
        if len(p) == 0:
            return
        # Of places that follow each other directly every other one is merged, from the left.
        chained = np.r_[False, q[:-1] == p[1:]]
        if chained.any():
            at = np.arange(len(p))
            run = np.maximum.accumulate(np.where(chained, 0, at))
            keep = (at - run) % 2 == 0
            p, q = p[keep], q[keep]
        right = after[q]
        token[p], token[q], pair[q], after[p] = rank, -1, -1, right
        has = right >= 0
        before[right[has]] = p[has]
        pair[p] = -1
        left = before[p]
        first = _distinct(np.r_[p[has], left[left >= 0]])
        pair[first] = merges.merged(token[first], token[after[first]])
        self.post(first)

    def apply_each(self, rank: int, places: list[int]) -> None:
        """Apply a merge place by place, from the left. A word that gets a pair of lower rank takes that one first."""
        token, after, before, pair = map(memoryview, (self.token, self.after, self.before, self.pair))
        found, ones, many = self.merges.found, self.ones, self.many
        waiting: set[int] = set()

        def enter(p: int, value: int) -> None:
            pair[p] = value
            if value >= 0:
                if value not in ones and value not in many:
                    heapq.heappush(self.heap, value)
                ones.setdefault(value, []).append(p)

        for p in places:
            if pair[p] != rank:
                continue
            if waiting and int(np.searchsorted(self.starts, p, side="right")) in waiting:
                enter(p, rank)
                continue
            q, left = after[p], before[p]
            right = after[q]
            token[p], token[q], pair[q], after[p] = rank, -1, -1, right
            new = old = -1
            if right >= 0:
                before[right] = p
                new = found.get((rank << 32) | token[right], -1)
            enter(p, new)
            if left >= 0:
                old = found.get((token[left] << 32) | rank, -1)
                enter(left, old)
            if 0 <= new < rank or 0 <= old < rank:
                waiting.add(int(np.searchsorted(self.starts, p, side="right")))


def unicode_spaces(pattern: str) -> str:
    """The pattern with \\s and \\S as Unicode's white space, which Python takes a little wider."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        pair = pattern[at : at + 2]
        if pair in (r"\s", r"\S"):
            if inside and pair == r"\S":
                raise ValueError(r"\S in a character class is not supported")
            out.append(SPACES if inside else f"[{SPACES}]" if pair == r"\s" else f"[^{SPACES}]")
        else:
            inside = pair[0] == "[" or inside and pair[0] != "]"
            out.append(pair if pair[0] == "\\" else pair[0])
        at += 2 if pair[0] == "\\" else 1
    return "".join(out)


def cutters(pattern: str):
    """Two functions: a text to its first unit and its later ones, which a space precedes, and a unit to its pre-tokens.

    Under the published pattern a single space between words begins a pre-token, so texts are cut there
    first and repeated units are matched once. Under others a text is one unit.
    """
    pattern = unicode_spaces(pattern)
    find = regex.compile(pattern).findall
    if pattern != PATTERN:
        if regex.compile(pattern).groups:
            raise ValueError("the pattern must not capture groups")
        return lambda text: (text, []), find
    cut, _ = cutter([])

    def units(text: str) -> tuple[str, list[str]]:
        later, first, _ = cut(text)
        return first[0], later

    return units, find


def common_words(docs: DataFrame, merges: Merges, pattern: str, common: int) -> DataFrame:
    """(piece, ids) of the pre-tokens with at least 1 / ``common`` of the units, so ``common`` times the pre-tokens of a unit at most.

    A pre-token of that share has it in some stretch of texts as well, so tasks count what has the share in
    the stretch at hand and leave out the long rest. Some that barely have it may be missed; they are replayed
    where they stand.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, find = cutters(pattern)
        firsts, held = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            total, seen = sum(held.values()) + sum(firsts.values()), Counter()
            for lead, counts in ((" ", held), ("", firsts)):
                for unit, n in counts.items():
                    if n * common >= total:
                        for piece in find(lead + unit):
                            seen[piece] += n
                counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.string()), pa.array([total, *seen.values()], pa.int64())], ["piece", "n"])

        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    first, later = units(text)
                    firsts[first] += 1
                    held.update(later)
            if len(held) + len(firsts) >= HELD:
                yield rows()
        yield rows()

    # The row without a piece holds the number of units, of which every one has a pre-token at least, an empty first one aside.
    counted = stored(docs.select("text").mapInArrow(frequent, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    total = counted.where("piece is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                pieces = batch.column("piece").slice(at, HELD)
                ids, counts = merges.replay([p.encode() for p in pieces.to_pylist()])
                ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pieces, pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], ["piece", "ids"])

    often = counted.where(F.col("piece").isNotNull() & (F.col("n") * common >= total)).select("piece").repartition("piece")
    return often.mapInArrow(encode_words, "piece string, ids array<int>")


def gathered(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ids laid end to end, those with these numbers end to end, and how many each has."""
    begin = np.cumsum(sizes) - sizes
    size = sizes[codes]
    at = np.repeat(begin[codes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return ids[at], size


def flat_tokens(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens end to end, where each begins, and how many it has."""
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def decode_runs(flat: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, spans: np.ndarray) -> list[bytes]:
    """The bytes of each of the runs of ids between neighbouring ``spans``, about half a million ids at a time."""
    data, begin, size = flat
    out: list[bytes] = []
    cuts = np.flatnonzero(np.r_[True, np.diff(spans[:-1] >> 19) > 0, True]).tolist() if len(spans) > 1 else []
    for s, e in zip(cuts, cuts[1:], strict=False):
        run = ids[spans[s] : spans[e]]
        sizes = size[run]
        at = np.repeat(begin[run] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        made = data[at].tobytes()
        total = np.r_[0, np.cumsum(sizes)]
        ends = total[spans[s : e + 1] - spans[s]].tolist()
        out += [made[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return out


def encode(
    docs: DataFrame, tokens: list[bytes], pattern: str, key: str = "doc_id", common: int = COMMON, decoded: bool = False
) -> DataFrame:
    """(key, ids): the token ids of the whole text of every row of ``docs``; with ``decoded`` also the bytes that these ids
    stand for, made as ``decode`` does.

    Each match of the pattern is encoded by itself; special tokens do not exist. Null and empty texts have no ids.
    The key may be null or repeated; other columns are ignored; an empty table gives an empty result. What
    ``common`` is changes the work, not the ids.
    """
    merges, flat_bytes = Merges(tokens), flat_tokens(tokens)
    names = ["key", "ids", "decoded"][: 3 if decoded else 2]
    kind = docs.schema[key].dataType.simpleString()
    table = common_words(docs, merges, pattern, common).toArrow()
    pieces = table.column("piece").to_pylist()
    lists = table.column("ids").combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast(
        (merges, pieces, lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, often, often_ids, often_sizes = shared.value
        units, find = cutters(pattern)
        known = {p: i for i, p in enumerate(often)}
        # Later units met so far, and the ids of all units laid end to end.
        code: dict[str, int] = {}
        ids, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

        def learn(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Ids of units from those of their pre-tokens; what is not common is replayed here."""
            found = [find(u) for u in new]
            rare = {p: 0 for f in found for p in f if p not in known}
            rare.update(zip(rare, range(len(often), len(often) + len(rare)), strict=True))
            made, counts = merges.replay([p.encode() for p in rare])
            numbers = np.array([known[p] if p in known else rare[p] for f in found for p in f], np.int64)
            made, counts = gathered(np.r_[often_ids, made.astype(np.int32)], np.r_[often_sizes, counts], numbers)
            total = np.r_[0, np.cumsum(counts)]
            ends = np.cumsum([len(f) for f in found])
            return made, total[ends] - total[np.r_[0, ends[:-1]]]

        for batch in chunks(batches, limit=REPLAY_BYTES):
            firsts: list[str] = []
            flat: list[str] = []
            ends = [0]
            for text in batch.column("text").to_pylist():
                if text:
                    first, later = units(text)
                    firsts.append(first)
                    # A text's first unit stands for itself: its number is filled in below.
                    flat.append("")
                    flat += later
                ends.append(len(flat))
            filled = np.array(ends[:-1], np.int64)[np.diff(ends) > 0]
            found = list(map(code.get, flat))
            found_at = np.array([-1 if c is None else c for c in found], np.int64)
            found_at[filled] = 0
            lacking = np.flatnonzero(found_at < 0).tolist()
            new = list({flat[i] for i in lacking})
            code.update(zip(new, range(len(sizes), len(sizes) + len(new)), strict=True))
            for i in lacking:
                found_at[i] = code[flat[i]]
            found_at[filled] = np.arange(len(sizes) + len(new), len(sizes) + len(new) + len(firsts))
            del found, flat
            more, counts = learn([" " + u for u in new] + firsts)
            all_ids, all_sizes = np.r_[ids, more], np.r_[sizes, counts]
            out, counts = gathered(all_ids, all_sizes, found_at)
            # First units are not remembered.
            sizes = all_sizes[: len(sizes) + len(new)]
            ids = all_ids[: int(sizes.sum())]
            total = np.r_[0, np.cumsum(counts)]
            spans = total[np.array(ends, np.int64)]
            columns = [batch.column("key"), pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), pa.array(out))]
            if decoded:
                columns.append(pa.array(decode_runs(flat_bytes, out, spans), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)
            if len(code) > HELD:
                code = {}
                ids, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    schema = f"key {kind}, ids array<int>" + (", decoded binary" if decoded else "")
    made = docs.select(F.col(key).alias("key"), "text").mapInArrow(run, schema)
    return made.withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokens: list[bytes], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that the token ids stand for; null ids give null. Other columns stay as they are."""
    flat = flat_tokens(tokens)
    rest = [c for c in encoded.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            counts = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            runs = decode_runs(flat, lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(counts)])
            out = [r if ok else None for r, ok in zip(runs, lists.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.binary())], [*rest, name])

    kinds = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in rest]
    return encoded.select(*rest).mapInArrow(run, ", ".join([*kinds, f"`{name}` binary"]))
