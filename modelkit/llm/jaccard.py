"""Exact n-gram Jaccard join with a token-group matrix.

1. Documents with equal shingle sets form one class; a class is compared once.
2. Every set gets keys: its shingles are dealt by hash into so many parts that two sets within the threshold
   must have equal parts, and a key is the digest of a part with enough shingles. A set with too few such parts is
   loose and gets its rarest shingles as keys besides, so many that a linked set has one of them among its own.
   Sets that can only be linked with equal ones get none. Sets without a common key cannot be linked, and a
   common key is a common shingle.
3. Grouping: under each key, sets are compared with the one set there that shares most with others. Links
   found put similar sets into groups, so that thousands of near copies become one group after a comparison each.
4. Matrix: sets that share a key with other groups meet under that key, as rows of bits, one bit per cell of
   shingles. A group's row is the union of its members' rows. Bits of a set that are not in the union of another
   group are shingles that no member has; if they are too many, the group stays closed. In groups that qualify,
   pairs are bounded in the same way by the bits they do not share, and those within the bound are compared.
5. Classes that are linked, directly or through others, are one component.

Bounds never leave out a link, and all comparisons are of whole sets. The threshold is a fraction, so no
rounding decides. Keys of very many sets are cut into blocks that meet in cells of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import Words, chunks, components, mix, segment_hashes, signed, stored, window_hashes, words_of

# Bits of a set's row in the matrix, and sets that one cell compares with as many others.
BITS, BLOCK = 4096, 1500


@dataclass(frozen=True)
class Rule:
    """Shingles of ``size`` words, linked at a Jaccard similarity of at least above / below."""

    size: int = 3
    above: int = 9
    below: int = 10

    def apart(self, a: int, b: int) -> int:
        """Most shingles that two linked sets of a and b can have in one of them only."""
        return (self.below - self.above) * (a + b) // (self.below + self.above)

    @property
    def weak(self) -> int:
        """Parts of fewer shingles are weak ones and make no key; with small parts only empty ones are weak."""
        return 3 if (self.below + self.above) >= 16 * (self.below - self.above) else 1

    def rarest(self, n: Column) -> Column:
        """How many of a set's n shingles, in any fixed order, suffice to share one with every set it is linked with."""
        return n - F.floor((n * self.above + self.below - 1) / self.below).cast("int") + 1

    def largest(self, n: int) -> int:
        """Size of the largest set that one of n can be linked with."""
        return n * self.below // self.above


def size_classes(rule: Rule, most: int) -> np.ndarray:
    """Upper ends of the size classes. Each is wide enough that a linked set is in the same or the next one."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(rule.largest(tops[-1] + 1), tops[-1] * 13 // 10))
    return np.array(tops)


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, by row and hash. A shorter text is one shingle as a whole."""
    hashes = w.hashes()
    at, found = window_hashes(hashes, w.row, size)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    whole = segment_hashes(hashes, w.first[short], w.first[short + 1])
    row, value = np.concatenate([w.row[at], short]), np.concatenate([found, whole])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _keys(rule: Rule, size: np.ndarray, row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key) of all keys, and which rows are loose.

    With m parts and at most h shingles apart, m - h parts of two linked sets are equal. A set with fewer weak
    parts than that has a key among them, whatever the other set is; of two loose sets all of them may be weak.
    """
    loose = np.zeros(len(size), bool)
    if len(row) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), loose
    tops = size_classes(rule, int(rule.largest(int(size.max()))) + 1)
    own = np.searchsorted(tops, size)
    # Sets that may differ from a linked one; others are linked with equal sets only, which are one class anyway.
    differ = (rule.below - rule.above) * (size + size * rule.below // rule.above) >= rule.below + rule.above
    rows, keys = [], []
    for up in (0, 1):
        level = own + up
        level = np.minimum(level, len(tops) - 1)
        use = differ & ((up == 0) | (size * rule.below // rule.above > tops[own]))
        top = tops[level]
        apart = (rule.below - rule.above) * 2 * top // (rule.below + rule.above)
        spare = 3 + apart // (16 if rule.weak > 1 else 10)
        parts = apart + 1 + spare
        mine = use[row]
        r, v = row[mine], value[mine]
        if len(r) == 0:
            continue
        part = (((v >> np.uint64(32)) * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        held = np.diff(np.r_[begin, len(r)])
        total = np.add.reduceat(mix(v), begin)
        r, part = r[begin], part[begin]
        strong = held >= rule.weak
        # Parts without a shingle are weak ones too.
        weak = parts - np.bincount(r[strong], minlength=len(size))
        loose |= use & (weak > spare)
        made = mix(total + mix((level[r].astype(np.uint64) << np.uint64(32)) + part.astype(np.uint64)))
        rows.append(r[strong])
        keys.append(made[strong])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), loose
    return np.concatenate(rows), np.concatenate(keys), loose


def described(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, keys, loose): size, 128-bit digest and keys of every document's set, and all
    shingles of the loose ones."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            n = batch.num_rows
            w = words_of(batch.column("text"), lower=True)
            row, value = shingle_sets(w, rule.size)
            size = np.bincount(row, minlength=n)
            digests = []
            for salt in (1, 2):
                total = np.zeros(n, np.uint64)
                full = np.flatnonzero(size)
                if len(full):
                    total[full] = np.add.reduceat(mix(value ^ mix(np.array([salt], np.uint64))), np.searchsorted(row, full))
                digests.append(pa.array(signed(total)))
            owner, key, loose = _keys(rule, size, row, value)
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(key[order])))
            bare = loose[row]
            ends = np.searchsorted(row[bare], np.arange(n + 1)).astype(np.int32)
            shingles = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(value[bare])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size.astype(np.int64)), *digests, lists, shingles],
                ["doc_id", "n_shingles", "set_a", "set_b", "keys", "loose"],
            )

    schema = f"doc_id {kind}, n_shingles long, set_a long, set_b long, keys array<long>, loose array<long>"
    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def rarest_keys(loose: DataFrame, rule: Rule) -> DataFrame:
    """(key, set_a): the rarest shingles of every loose set (set_a, loose), one row per set.

    Shingles are ordered by how many loose sets have them, then by hash: one order for all sets.
    """
    shingles = loose.select("set_a", F.size("loose").alias("size"), F.explode("loose").alias("shingle"))
    often = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    # A shingle of one set links nothing; it still takes its place in the order.
    ordered = shingles.join(often, "shingle").groupBy("set_a", "size").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("order"))
    first = ordered.select("set_a", F.explode(F.slice("order", F.lit(1), rule.rarest(F.col("size")))).alias("s"))
    return first.where(F.col("s.often") > 1).select(F.xxhash64("s.shingle").alias("key"), "set_a")


def _sets_of(texts: list[str | None], rule: Rule) -> list[np.ndarray]:
    row, value = shingle_sets(words_of(pa.array(texts, pa.string()), lower=True), rule.size)
    return np.split(value, np.searchsorted(row, np.arange(1, len(texts))))


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) of representatives that are linked, by their whole texts (rep, text)."""
    both = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(chunks([whole], "text_a"), "text_b"):
                left, right = (_sets_of(batch.column(c).to_pylist(), rule) for c in ("text_a", "text_b"))
                same = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)])
                union = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)]) - same
                linked = pa.array((rule.below * same >= rule.above * union) & (same > 0))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(linked), batch.column("b").filter(linked)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def _rows(texts: DataFrame, rule: Rule) -> DataFrame:
    """(rep, size, bits): the matrix row of every text, one bit per cell of shingle hashes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, value = shingle_sets(words_of(batch.column("text"), lower=True), rule.size)
            marks = np.zeros((batch.num_rows, BITS), bool)
            marks[row, (value & np.uint64(BITS - 1)).astype(np.int64)] = True
            bits = [r.tobytes() for r in np.packbits(marks, axis=1)]
            size = np.bincount(row, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(size), pa.array(bits, pa.binary())], ["rep", "size", "bits"])

    return texts.select("rep", "text").mapInArrow(find, "rep long, size long, bits binary")


def _cell_pairs(rule: Rule, rep: np.ndarray, group: np.ndarray, size: np.ndarray, bits: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one cell that may be linked and are in different groups. Rows of a cell are of one block, or of two (half 0 and 1)."""
    count = lambda x: np.bitwise_count(x).sum(-1, dtype=np.int64)
    total = rule.below + rule.above
    starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (half[1:] != half[:-1])])
    ends = np.r_[starts[1:], len(group)]
    unions = np.bitwise_or.reduceat(bits, starts, axis=0)
    smallest = np.minimum.reduceat(size, starts)
    left, right = [], []
    two = half[0] != half[-1]
    for q in range(len(rep)):
        # Every pair once: a set asks the groups after it, or those of the other block.
        ask = np.flatnonzero((group[starts] != group[q]) & ((half[starts] > half[q]) if two else (starts > q)))
        if len(ask) == 0:
            continue
        # A member d shares at least above / (above + below) of |q| + |d| with q.
        lacking = count(bits[q] & ~unions[ask])
        allowed = size[q] - -(-rule.above * (size[q] + smallest[ask]) // total)
        for g in ask[lacking <= allowed].tolist():
            members = slice(starts[g], ends[g])
            apart = count(bits[q] ^ bits[members])
            near = np.flatnonzero(total * apart <= (rule.below - rule.above) * (size[q] + size[members])) + starts[g]
            left.append(np.full(len(near), rep[q]))
            right.append(rep[near])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def qualifying(open_: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of different groups that the matrix does not rule out, from (key, rep, group, size, bits)."""
    counts = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = open_.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # Block i meets block j in the cell (i, j) with i <= j; a key of one block has one cell.
    cells = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key",
        F.least("own", "with").alias("i"),
        F.greatest("own", "with").alias("j"),
        (F.col("own") > F.col("with")).cast("int").alias("half"),
        "group",
        "rep",
        "size",
        "bits",
    )
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "half", "group", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            column = {c: table.column(c).to_numpy() for c in ("key", "i", "j", "half", "group", "rep", "size")}
            raw = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
            new = np.r_[True, (np.diff(column["key"]) != 0) | (np.diff(column["i"]) != 0) | (np.diff(column["j"]) != 0)]
            cuts = np.r_[np.flatnonzero(new), len(new)]
            found = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e - s > 1:
                    part = slice(s, e)
                    found.append(_cell_pairs(rule, *(column[c][part] for c in ("rep", "group", "size")), raw[part], column["half"][part]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        def last_cell(batch: pa.RecordBatch) -> int:
            """Where the last cell of a batch begins."""
            same = np.ones(batch.num_rows, bool)
            for c in ("key", "i", "j"):
                values = batch.column(c).to_numpy()
                same &= values == values[-1]
            return int(np.flatnonzero(same)[0])

        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                begin = last_cell(batch)
                joined = bool(held) and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in ("key", "i", "j"))
                if held and not joined:
                    yield from done(pa.Table.from_batches(held))
                    held = []
                if begin:
                    yield from done(pa.Table.from_batches([*held, batch.slice(0, begin)]))
                    held = []
                held.append(batch.slice(begin))
        if held:
            yield from done(pa.Table.from_batches(held))

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def join_groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, the document's own included. Texts
    without words and null texts have no shingles and are linked with nothing; rows without doc_id take part
    through a copy that has one, else their component is null. Rows repeated whole are one document. A-Z counts
    as a-z. Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Keys are many times larger than the rest and are made anew where they are read, instead of being stored.
    sets = stored(described(docs, rule).drop("keys", "loose"), "sets")
    equal = ["n_shingles", "set_a", "set_b"]
    classes = stored(sets.where("n_shingles > 0").groupBy(*equal).agg(F.min("doc_id").alias("rep")), "classes")
    # Keys that more than one class has; a class is told by one half of its digest here, its copies fall together.
    loose = described(docs, rule).where(F.size("loose") > 0).groupBy("set_a").agg(F.first("loose").alias("loose"))
    rare = stored(rarest_keys(stored(loose, "loose"), rule), "rare")
    keyed = described(docs, rule).select(F.explode("keys").alias("key"), "set_a").unionByName(rare)
    common = keyed.groupBy("key").agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).where("low < high").select("key")
    common = stored(common, "common")
    members = keyed.join(common, "key", "left_semi").distinct().join(classes.where("rep is not null").select("set_a", "rep"), "set_a")
    members = stored(members.select("key", "rep"), "members")

    reps = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    texts = stored(docs.withColumnRenamed("doc_id", "rep").join(reps, "rep", "left_semi").dropDuplicates(["rep"]), "texts")

    # Grouping round: one comparison per set and key, with the set there whose keys are the most frequent.
    often = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weight = members.join(often, "key").groupBy("rep").agg(F.sum("n").alias("weight"))
    hubs = (
        members.join(weight, "rep")
        .groupBy("key")
        .agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("best"))
        .select("key", (-F.col("best.minus")).alias("a"))
    )
    first = members.withColumnRenamed("rep", "b").join(hubs, "key").where("a <> b")
    first = stored(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "first")
    links = stored(verified(first, texts, rule), "links")
    grouped = components(links)

    # Matrix round: sets against the groups of others that they share a key with.
    placed = members.join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("root", "rep").alias("group")
    )
    mixed = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    open_ = stored(placed.join(mixed, "key", "left_semi"), "open")
    pairs = stored(qualifying(open_.join(_rows(texts, rule), "rep"), rule), "pairs")
    more = verified(pairs, texts, rule)
    # Groups stand for their links from here on.
    contracted = grouped.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    final = components(contracted).withColumnRenamed("node", "rep")
    named = classes.join(final, "rep", "left").select(*equal, F.coalesce("root", "rep").alias("component"))
    return sets.join(named, equal, "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )
