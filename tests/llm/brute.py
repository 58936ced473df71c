"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substrings(rows, window=50):
    first, found = {}, {}
    for i, text in sorted(rows):
        w = words(text)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, text in rows:
        w, gone = words(text), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        found[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return found


def statistics(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def _luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def personal(text):
    text, spans = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, "phone", m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))


def near(rows, size=3, above=9, below=10):
    """(set size, component) per id, by all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, n in shared.items():
            if below * n >= above * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").translate(LOWER))


def tiling(doc, item, least=5):
    """Tokens of ``item`` that greedy tiles of ``doc`` cover, by looking at all pairs of places."""
    a, b = list(doc), list(item)
    used_a, used_b, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(b)):
            for d in range(len(a)):
                n = 0
                while i + n < len(b) and d + n < len(a) and b[i + n] == a[d + n] and i + n not in used_b and d + n not in used_a:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return covered
        covered += n
        used_b |= set(range(i, i + n))
        used_a |= set(range(d, d + n))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=20):
    """{item: [(rank, doc_id, score)]}; docs are (doc_id, text) rows, each a document of its own."""
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(term for _, c in counts for term in c)
    found = {}
    for item, text in items:
        scores = []
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        for (i, c), n in zip(counts, sizes, strict=True):
            m = 75 + (25 * n * n_docs) // max(total, 1)
            score = 0
            for term, times in asked.items():
                if c[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * weight * ((10**9 * c[term]) // (1000 * c[term] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        found[item] = [(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return found


def middle(i, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = sha(f"42:{'' if i is None else i}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return i, len(units), "plain", None, None, sha(text), sha(text)
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return i, len(units), form, len(p), len(m), sha(out), sha(text)


def _spread(x):
    """One 64-bit number mixed as SplitMix64 does."""
    m = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return x ^ x >> 31


def permute(x, size, key):
    """Place of x in a permutation of range(size): four Feistel rounds, repeated until the result is inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = (1 << half) - 1
    keys = [_spread((i + key % (1 << 63) * 4) % (1 << 64)) for i in range(1, 5)]
    while True:
        left, right = x >> half, x & low
        for k in keys:
            left, right = right, left ^ (_spread((right + k) % (1 << 64)) & low)
        x = left << half | right
        if x < size:
            return x


def mix_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        level = left / max(sum(weight[s] for s in names if s not in capped), 1e-9)
        more = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= more


def mix_taken(rows, buckets, block=128, shard_slots=8192, seed=0):
    """Words taken of each row of (doc_id, source, size, place), in the order of the rows."""
    sizes = {}
    for _, s, n, _ in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = mix_targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    blocks, slots, trim = [], [], []
    for s in names:
        b, n = -(-sizes[s] // block), sizes[s]
        passes = min(int(want[s] // n), 3) if n else 0
        rest = int(want[s] - passes * n) if n and passes < 3 else 0
        more = min(-(-rest // block), b)
        last = rest - (more - 1) * block
        blocks.append(b)
        slots.append(passes * b + more)
        trim.append(0 if more == 0 or last >= min(block, n) else last)
    # Draws, numbered per source over the shards in order.
    total, drawn = sum(slots), []
    have = [0] * len(names)
    for shard in range(-(-total // shard_slots)):
        counts = np.random.default_rng([seed, shard]).multinomial(min(shard_slots, total - shard * shard_slots), np.array(slots) / max(total, 1))
        for s, n in enumerate(counts.tolist()):
            drawn += [(s, have[s] + k) for k in range(n)]
            have[s] += n
    # Draws beyond a source's slots, in order, fill the slots that others lack, in order.
    lacking = [(s, number) for s in range(len(names)) for number in range(have[s], slots[s])]
    surplus = {}
    for s in range(len(names)):
        for number in range(slots[s], have[s]):
            surplus[s, number] = lacking[len(surplus)]
    uses = {}
    for s, number in drawn:
        number = permute(number, have[s], seed * 1_000_003 + 7 * s + 1)
        s, number = surplus.get((s, number), (s, number))
        turn = number // blocks[s]
        spot = permute(number - turn * blocks[s], blocks[s], seed * 1_000_003 + 7 * s + 1_009 * (turn + 2))
        uses.setdefault((s, spot), []).append(trim[s] if trim[s] and number == slots[s] - 1 else block)
    # Documents of a source end to end, by bucket of their hash, hash, id and size.
    taken, at = {}, dict.fromkeys(names, 0)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][3] % buckets, rows[i][3], rows[i][0] is not None, rows[i][0] or 0, rows[i][2])):
        s, n = rows[i][1], rows[i][2]
        words = 0
        for place in range(at[s], at[s] + n):
            words += sum(place % block < used for used in uses.get((names.index(s), place // block), ()))
        taken[i] = words
        at[s] += n
    return [taken[i] for i in range(len(rows))]

