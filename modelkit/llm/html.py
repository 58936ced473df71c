"""Main text of web pages: site templates are element subtrees that recur on many pages of one host.

Each page is read into blocks of text and the element subtrees that hold them, every subtree with the hash of
what it holds. Spark counts, per host, in how many different contents a subtree occurs; blocks below a recurring subtree are
deleted. Text that lies mostly in recurring subtrees is a copy: it makes no template and loses nothing. Elements that are never
main text (navigation, forms, scripts, reader comments and so on) are left out by tag, role and whole names of class or id; an
element that only looks so but wraps the article is none of them. Any block element can be a template; inside an ``article`` or
``main`` element only containers can, and never the whole of it, since articles themselves may be copied. Text beside
such an element is kept unless the counts delete it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import chunks, stored

# A subtree is a template if it is among at least this many different contents of its host.
RECURS = 10
# Fewer are enough on a small host: nine of ten of its different pages, three at least.
SMALL, SHARE = 3, 0.9

# Element names as HTML defines them.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NEVER = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript head template "
    "button select option datalist svg canvas object audio video map".split()
)
# Furniture by name, unless it turns out to be a wrapper of the page.
ASIDE = frozenset("nav header footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
# An opening tag ends an open element of these names, unless one of the second set is in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "a": ({"a"}, BLOCKS),
    "button": ({"button"}, BLOCKS),
}
CONTAINERS = frozenset("div section ul ol table dl figure details center fieldset nav header footer aside form".split())
ROOTS = ("article", "main")
# Elements that tell a page's text from a bare list of links.
TELLING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
# Block elements that may be templates outside of articles.
SUBTREES = BLOCKS - {"html", "body", *ROOTS}
# Words that name furniture, and words that may stand beside them in a class or id (site-header, share-buttons).
SIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert "
    "popup modal overlay comment comments commentlist disqus replies respond sidebar side widget menu menubar nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager header masthead footer related recommended share sharing social newsletter subscribe signup "
    "login search form toolbar skip copyright disclaimer tags".split()
)
BESIDE = frozenset("site page main top bottom left right primary secondary global mobile desktop box bar block list links buttons icons area section".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)
# One attribute: a name, and its value with any quotes around it.
ATTR = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}


def names_furniture(names: str) -> bool:
    """Whether one of the names in a class or id says furniture: each of its words has to, or stand beside one that does."""
    for name in names.lower().split():
        words = set(re.split("[_-]+", name)) - {""}
        if words & SIDE and words <= SIDE | BESIDE:
            return True
    return False


def kind_of(tag: str, attributes: str) -> int:
    """2 for an element that is never main text, 1 for one that is furniture by its name, class, id or role, else 0."""
    if tag in NEVER:
        return 2
    if tag in ASIDE:
        return 1
    if attributes and tag not in ("html", "body", *ROOTS):
        for name, value in ATTR.findall(attributes):
            name = name.lower()
            value = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] else value
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES:
                return 1
            if name in ("class", "id") and names_furniture(value):
                return 1
    return 0


def _spaced(words: Iterable[str]) -> str:
    return " ".join(html.unescape("".join(words)).split())


class Page:
    """The blocks of one page without furniture, and its holders: the subtrees that may be templates.

    Elements are numbered as they open. Per element: name, the element around it, kind, whether it is in a root,
    the holder next to it (itself, if it is one) and whether its end was found.
    """

    def __init__(self, source: str):
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.kind: list[int] = []
        self.root: list[bool] = []
        self.near: list[int] = []
        self.ended: list[bool] = []
        self.open: list[int] = []
        self.open_blocks: list[int] = []
        self.open_never: list[int] = []
        self.count: Counter[str] = Counter()
        # Holders: element, holder around, hash state or value, whether there is text in it.
        self.holder: list[int] = []
        self.outer: list[int] = []
        self.state: list = []
        self.filled: list[bool] = []
        # Pieces of text of the block being read with their elements, and all blocks: pieces, element, holder.
        self.words: list[tuple[str, int]] = []
        self.read: list[tuple[list[tuple[str, int]], int, int]] = []
        self._read(source)
        while self.open:
            self._close_last(False)
        self._flush()
        self.blocks = self._kept()

    def _furniture(self) -> list[bool]:
        """Which elements are furniture or inside of it."""
        n = len(self.tag)
        own = [0] * n
        loose = 0
        for pieces, _, _ in self.read:
            for text, e in pieces:
                if e >= 0:
                    own[e] += len(text.strip())
                else:
                    loose += len(text.strip())
        never, soft = [False] * n, [False] * n
        for e in range(n):
            up = self.parent[e]
            never[e] = self.kind[e] == 2 or up >= 0 and never[up]
            soft[e] = self.kind[e] == 1 or up >= 0 and soft[up]
        in_roots = sum(s for s, r, v in zip(own, self.root, never, strict=True) if r and not v)
        # What decides is the text of the article and main elements, or all text on pages without them.
        weight = [0 if v or in_roots and not r else s for s, r, v in zip(own, self.root, never, strict=True)]
        total = sum(weight) + (0 if in_roots else loose)
        kept = total - sum(s for s, f in zip(weight, soft, strict=True) if f)
        if total and 20 * kept < total and any(soft):
            # Hardly any of it is left: elements that wrap most of it are no furniture.
            below, told = list(weight), [t in TELLING for t in self.tag]
            for e in range(n - 1, -1, -1):
                if self.parent[e] >= 0:
                    below[self.parent[e]] += below[e]
                    told[self.parent[e]] |= told[e]
            # Beside a root a wrapper stays furniture, but for a form; the root in it does not.
            beside = [False] * n
            for e in range(n):
                up = self.parent[e]
                above, wrapped = (soft[up], beside[up]) if up >= 0 else (False, False)
                most = 2 * below[e] > total
                if self.tag[e] in ROOTS and above and wrapped:
                    above = wrapped = False
                if self.kind[e] == 1 and not above:
                    if in_roots and most and not self.root[e]:
                        above = wrapped = self.tag[e] != "form"
                    else:
                        above = not (not in_roots and most and told[e] and (self.tag[e] == "form" or not self.ended[e]))
                elif self.kind[e] == 1 and wrapped and not most:
                    wrapped = False
                soft[e], beside[e] = above, wrapped
        return [a or b for a, b in zip(never, soft, strict=True)]

    def _kept(self) -> list[tuple[str, bool, int]]:
        """(text, whether it is in a root, holder) of the blocks with words that are no furniture."""
        side, blocks = self._furniture(), []
        for pieces, block, holder in self.read:
            text = _spaced(w for w, e in pieces if e < 0 or not side[e])
            if text:
                root = block >= 0 and self.root[block]
                inside = holder >= 0 and self.root[self.holder[holder]] == root
                blocks.append((text, root, holder if inside else -1))
        return blocks

    def _flush(self) -> None:
        if self.words:
            words, self.words = self.words, []
            text = _spaced(w for w, _ in words)
            if text:
                block = self.open_blocks[-1] if self.open_blocks else -1
                holder = self.near[self.open[-1]] if self.open else -1
                if holder >= 0:
                    self.state[holder].update(f"{self.tag[block] if block >= 0 else ''}\n{text}\n")
                    self.filled[holder] = True
                self.read.append((words, block, holder))

    def _open(self, tag: str, kind: int) -> None:
        up = self.open[-1] if self.open else -1
        e, root = len(self.tag), tag in ROOTS or up >= 0 and self.root[up]
        near = self.near[up] if up >= 0 else -1
        # Containers count wherever they are, other elements where they may hold text that is kept.
        if tag in CONTAINERS or tag in SUBTREES and not root and not kind:
            self.holder.append(e)
            self.outer.append(near)
            self.state.append(xxhash.xxh64(tag))
            self.filled.append(False)
            near = len(self.holder) - 1
        self.tag.append(tag)
        self.parent.append(up)
        self.kind.append(kind)
        self.root.append(root)
        self.near.append(near)
        self.ended.append(True)
        self.open.append(e)
        self.count[tag] += 1
        if tag in BLOCKS:
            self.open_blocks.append(e)
        elif tag in NEVER:
            self.open_never.append(e)

    def _close_last(self, ended: bool = True) -> None:
        e = self.open[-1]
        tag = self.tag[e]
        if tag in BLOCKS:
            self._flush()
            self.open_blocks.pop()
        elif tag in NEVER:
            self.open_never.pop()
        self.open.pop()
        self.count[tag] -= 1
        self.ended[e] = ended
        holder = self.near[e]
        if holder >= 0 and self.holder[holder] == e:
            value = self.state[holder].intdigest()
            self.state[holder] = value - (1 << 64) if value >= 1 << 63 else value
            outer = self.outer[holder]
            if outer >= 0 and self.filled[holder]:
                self.state[outer].update(f"<{value}>")
                self.filled[outer] = True

    def _close(self, tag: str) -> None:
        """Close the last open element of this name and all inside it; an end tag without a start is nothing."""
        if self.count[tag] == 0:
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.tag[self.open[i]]
            if name == tag:
                while len(self.open) > i:
                    self._close_last(len(self.open) == i + 1)
                return
            if tag not in BLOCKS and name in BLOCKS:
                return

    def _close_before(self, tag: str) -> None:
        """An opening tag ends what cannot hold it."""
        if tag in BLOCKS:
            self._flush()
            block = self.open_blocks[-1] if self.open_blocks else -1
            if block >= 0 and self.tag[block] == "p" and not (self.open_never and self.open_never[-1] > block):
                self._close("p")
        ends, within = CLOSES.get(tag, ((), ()))
        if any(self.count[t] for t in ends):
            for i in range(len(self.open) - 1, -1, -1):
                name = self.tag[self.open[i]]
                if name in ends:
                    while len(self.open) > i:
                        self._close_last(len(self.open) == i + 1)
                    break
                if name in within:
                    break

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            mark = source.find("<", at)
            here = self.open[-1] if self.open else -1
            if mark < 0:
                self.words.append((source[at:], here))
                break
            if mark > at:
                self.words.append((source[at:mark], here))
            tag = TAG.match(source, mark)
            if tag is None:
                self.words.append(("<", here))
                at = mark + 1
                continue
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            block = name in BLOCKS
            if name == "br":
                self.words.append((" ", here))
            elif tag[1]:
                if block:
                    self._flush()
                self._close(name)
            else:
                self._close_before(name)
                if name in RAW:
                    end = RAW_END[name].search(source, at)
                    at = source.find(">", end.end() - 1) + 1 if end else size
                    at = at or size
                elif name not in VOID:
                    kind = kind_of(name, tag[3])
                    if block or kind or self.count[name]:
                        if name in NEVER and not block:
                            # Buttons, players and the like stand between words.
                            self.words.append((" ", -1))
                        self._open(name, kind)


def page_blocks(source: str | None) -> tuple[list[tuple[str, int]], list[tuple[int, int, bool]], list[bool]]:
    """(text, holder) of each block that may be main text, (hash, holder around, whether in a root) of each holder
    with text in it, and whether each of the blocks is inside an article or main element.

    Blocks inside such an element are held against subtrees inside it only. -1 is no holder.
    """
    page = Page(source or "")
    place = np.cumsum(page.filled) - 1 if page.filled else []
    held = [
        (value, int(place[outer]) if outer >= 0 else -1, page.root[e])
        for value, outer, e, filled in zip(page.state, page.outer, page.holder, page.filled, strict=True)
        if filled
    ]
    return [(t, int(place[h]) if h >= 0 else -1) for t, _, h in page.blocks], held, [r for _, r, _ in page.blocks]


def around_blocks(holders: list[dict], blocks: list[dict]) -> list[bool]:
    """Which holders are around a block that is kept, on its side of the root."""
    used = [False] * len(holders)
    for b in blocks:
        if b["holder"] >= 0:
            used[b["holder"]] = True
    for i in range(len(holders) - 1, -1, -1):
        outer = holders[i]["outer"]
        if used[i] and outer >= 0 and holders[outer]["root"] == holders[i]["root"]:
            used[outer] = True
    return used


def marked_blocks(holders: list[dict], blocks: list[dict], marks: set[int]) -> list[bool]:
    """Which blocks are below a holder whose hash is among ``marks``, on their side of the root."""
    below = []
    for h in holders:
        outer = h["outer"]
        below.append(h["hash"] in marks or outer >= 0 and holders[outer]["root"] == h["root"] and below[outer])
    return [b["holder"] >= 0 and below[b["holder"]] for b in blocks]


def copied(sizes: list[int], roots: list[bool], marked: list[bool]) -> tuple[bool, bool]:
    """Whether the text in the roots, and that beside them, is a copy of other pages and not a page in a template.

    It is if over half of the roots' text, or over two thirds of the page's, lies in ``marked`` blocks.
    """
    inside = sum(n for n, r in zip(sizes, roots, strict=True) if r)
    marked_inside = sum(n for n, r, m in zip(sizes, roots, marked, strict=True) if r and m)
    return 2 * marked_inside > inside, 3 * sum(n for n, m in zip(sizes, marked, strict=True) if m) > 2 * sum(sizes)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and place (roots or beside them): the recurring subtrees, and a digest of the text outside of them. Copies give none."""
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("host", "holders", "blocks", "marks"))
        for host, holders, blocks, marks in zip(*columns, strict=True):
            marks = set(marks)
            marked, roots = marked_blocks(holders, blocks, marks), [b["root"] for b in blocks]
            used = around_blocks(holders, blocks)
            around = {r: {h["hash"] for h, u in zip(holders, used, strict=True) if u and h["root"] == r} for r in (True, False)}
            for root, copy in zip((True, False), copied([b["size"] for b in blocks], roots, marked), strict=True):
                held, other = around[root], around[not root]
                found = marks & held if root else marks - (other - held)
                if found and not copy:
                    text = ",".join(str(b["hash"]) for b, m in zip(blocks, marked, strict=True) if not m and (b["root"] or not root))
                    rows.append({"host": host, "content": xxhash.xxh64(text).intdigest() >> 1, "subtrees": sorted(found)})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("host", pa.string()), ("content", pa.int64()), ("subtrees", pa.list_(pa.int64()))]))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page without its templates; copies stay whole."""
    for batch in batches:
        texts = []
        for holders, blocks, deleted in zip(*(batch.column(c).to_pylist() for c in ("holders", "blocks", "deleted")), strict=True):
            marked, roots = marked_blocks(holders, blocks, set(deleted or ())), [b["root"] for b in blocks]
            beside, inside = (not c for c in reversed(copied([len(b["text"]) for b in blocks], roots, marked)))
            texts.append("\n".join(b["text"] for b, m in zip(blocks, marked, strict=True) if not (m and (inside if b["root"] else beside))))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url")), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, recurs: int = RECURS) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text. Pages without a host share the empty one. Rows are told apart by
    their place in the input, so repeated rows and null ids are kept. A subtree counts once for each different
    text around it, without the subtrees that recur themselves; pages that are mostly such subtrees are copies and
    do not count. Other columns are ignored; an empty table stays empty.
    """
    source = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    id_type = pages.schema["page_id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("text", pa.string()), ("root", pa.bool_()), ("holder", pa.int32())]))
    subtree = pa.list_(pa.struct([("hash", pa.int64()), ("outer", pa.int32()), ("root", pa.bool_())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 40
        for batch in chunks(batches, "html"):
            read = [page_blocks(s) for s in batch.column("html").to_pylist()]
            number = pa.array(range(next_row, next_row + len(read)), pa.int64())
            next_row += len(read)
            digests = [xxhash.xxh64("\n".join(t for t, _ in blocks)).intdigest() >> 1 for blocks, _, _ in read]
            rows = [[{"text": t, "root": r, "holder": h} for (t, h), r in zip(blocks, roots, strict=True)] for blocks, _, roots in read]
            held = [[{"hash": v, "outer": o, "root": r} for v, o, r in holders] for _, holders, _ in read]
            used = [around_blocks(h, b) for h, b in zip(held, rows, strict=True)]
            around = [sorted({h["hash"] for h, u in zip(hs, us, strict=True) if u}) for hs, us in zip(held, used, strict=True)]
            aside = [sorted({h["hash"] for h in hs}.difference(a)) for hs, a in zip(held, around, strict=True)]
            new = [pa.array(digests, pa.int64()), pa.array(rows, shape), pa.array(held, subtree)]
            new += [pa.array(c, pa.list_(pa.int64())) for c in (around, aside)]
            old = [batch.column(c) for c in ("page_id", "url", "host")]
            names = ["row", "page_id", "url", "host", "digest", "blocks", "holders", "around", "aside"]
            yield pa.RecordBatch.from_arrays([number, *old, *new], names)

    block, held = "struct<text:string,root:boolean,holder:int>", "struct<hash:long,outer:int,root:boolean>"
    schema = (
        f"row long, page_id {id_type}, url string, host string, digest long, blocks array<{block}>, holders array<{held}>, "
        "around array<long>, aside array<long>"
    )
    parsed = stored(source.mapInArrow(parse, schema), "pages")
    found = F.concat(
        F.transform("around", lambda s: F.struct(s.alias("subtree"), F.lit(True).alias("kept"))),
        F.transform("aside", lambda s: F.struct(s.alias("subtree"), F.lit(False).alias("kept"))),
    )
    needed = (
        parsed.where(F.size("blocks") > 0)
        .select("host", "digest")
        .distinct()
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("pages"))
        .select("host", F.least(F.lit(recurs), F.greatest(F.lit(SMALL), F.ceil(F.col("pages") * F.lit(SHARE)))).alias("need"))
        .where(F.col("need") < recurs)
    )
    enough = F.col("n") >= F.coalesce("need", F.lit(recurs))
    # Subtrees around kept text that are on enough different pages; then those among enough different contents.
    recurring = (
        parsed.select("host", "digest", F.inline(found))
        .groupBy("host", "subtree", "digest")
        .agg(F.max("kept").alias("kept"))
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
        .where(F.col("kept") & (F.col("n") >= min(recurs, SMALL)))
        .join(needed, "host", "left")
        .where(enough)
        .select("host", "subtree")
    )
    marks = (
        parsed.select("row", "host", F.explode(F.concat("around", "aside")).alias("subtree"))
        .join(recurring, ["host", "subtree"])
        .groupBy("row")
        .agg(F.collect_set("subtree").alias("marks"))
    )
    sizes = F.transform(
        "blocks", lambda b: F.struct(F.length(b["text"]).alias("size"), F.xxhash64(b["text"]).alias("hash"), b["root"].alias("root"), b["holder"].alias("holder"))
    )
    templates = (
        parsed.select("row", "host", "holders", sizes.alias("blocks"))
        .join(marks, "row")
        .select("host", "holders", "blocks", "marks")
        .mapInArrow(_contents, "host string, content long, subtrees array<long>")
        .select("host", "content", F.explode("subtrees").alias("subtree"))
        .distinct()
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(needed, "host", "left")
        .where(enough)
        .select("host", "subtree")
    )
    whole = parsed.where(F.size("around") == 0).select("page_id", "url", F.array_join("blocks.text", "\n").alias("text"))
    doubtful = parsed.where(F.size("around") > 0)
    deleted = (
        doubtful.select("row", "host", F.explode("around").alias("subtree"))
        .join(templates, ["host", "subtree"])
        .groupBy("row")
        .agg(F.collect_set("subtree").alias("deleted"))
    )
    cleaned = (
        doubtful.join(deleted, "row", "left")
        .select("page_id", "url", "holders", "blocks", "deleted")
        .mapInArrow(_without, f"page_id {id_type}, url string, text string")
    )
    return whole.unionByName(cleaned)
