"""Main text of pages by wrapper induction.

Pages of one host share a template.

1. Every distinct page of a host is aligned with two others by simple tree matching: the largest set of node pairs that
   keeps order and ancestry, where pairs have equal tag and names; of equally large ones, that with most equal nodes.
   Nodes with the content of their partner are constant, the others are slots.  The page's main slot is the container
   with most varying text that is neither navigation, header, footer, sidebar, notice, advert, form nor reader
   comments; the host's is the one that most of its distinct pages have.
2. Every node of every distinct page is counted, also one that no alignment pairs because it stands elsewhere in the
   order.  Those on half of the host's distinct pages or more, and on LEAST_PAGES at least, are its template.
3. Every page gives the text of its main slot without the template's nodes, whatever the slot's tag or name.

A node is known by its tags and names from the top and a digest of its content, not by its number among
siblings, so a constant box is found behind any number of paragraphs.  There is one wrapper a host, from counts over all
its distinct pages; these are dealt in parts of about PART_PAGES, so that no task gets a whole large host.  A page whose
tree lacks the main slot's place is read by its own best container.  Null, empty and text-only pages give their own text; a page without url belongs to the host "".
Hosts of fewer than LEAST_PAGES distinct pages have no template; nodes are left out by tag and names there, as
everywhere.  A page of which nothing would be left keeps the text of its slot.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.html_tree import BLOCKS, RAW, Node, parse
from ratelake.llm.shared import small_batches, stored, tidy

#: The least number of distinct pages that show what is constant.
LEAST_PAGES = 3

#: Distinct pages of a host that are aligned in one part, about; another number gives other neighbours, not other counts.
PART_PAGES = 64

#: Counts of nodes that a task holds before it sends them on to be summed.
TOLD_SIGNS = 1 << 16

#: Elements and names that are never main text.
OUTSIDE = frozenset("nav header footer aside form button select menu dialog svg canvas audio video object head search".split()) | RAW
_OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|widget|ads?|advert\w*|sponsor\w*|promo\w*|banner|"
    r"cookies?|consent|notice|newsletter|subscribe|popup|modal|share|social|related|comments?|discussion|replies|disqus|respond|login|search|toolbar|pagination|pager|"
    r"complementary|contentinfo|alert|skip)(?:$|[\s_-])"
)
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:main|article|content|post|entry|story|body|text)(?:$|[\s_-])")

Place = tuple[tuple[str, str, int], ...]

#: Entries of a table of matchings that are held at once even where the square root of its rows would be fewer.
_TABLE = 1 << 16


def outside(node: Node) -> bool:
    """A node that holds no main text whatever it says."""
    if node.tag in ("html", "body", "main", "article"):
        return node.hidden
    return node.hidden or node.tag in OUTSIDE or bool(node.names and _OUTSIDE_NAMES.search(node.names))


def blocks(node: Node, dropped: frozenset[int] = frozenset()) -> list[str]:
    """Texts of the blocks below ``node``; ``dropped`` are ids of nodes left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    # An explicit stack: trees of broken pages can be very deep.
    work: list = [iter(node.children)]
    ends: list[bool] = [False]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            if ends.pop():
                flush()
        elif isinstance(child, str):
            run.append(child)
        elif child.tag == "br":
            run.append(" ")
        elif outside(child) or id(child) in dropped:
            if child.tag in BLOCKS:
                flush()
        else:
            block = child.tag in BLOCKS
            if block:
                flush()
            work.append(iter(child.children))
            ends.append(block)
    flush()
    return out


def sizes(root: Node) -> dict[int, int]:
    """Characters of the blocks below every block node, by id, in one walk: a block's are its own and those of blocks in it."""
    out: dict[int, int] = {}
    run: list[str] = []

    def length() -> int:
        text = " ".join("".join(run).split())
        run.clear()
        return len(text)

    # Nodes that hold no main text count for none above them, but have sizes of their own.
    tops = [root]
    while tops:
        top = tops.pop()
        work, totals = [(top, iter(top.children), True)], [0]
        while work:
            node, children, block = work[-1]
            child = next(children, None)
            if child is None:
                work.pop()
                if block:
                    out[id(node)] = total = totals.pop() + length()
                    if totals:
                        totals[-1] += total
            elif isinstance(child, str):
                run.append(child)
            elif child.tag == "br":
                run.append(" ")
            else:
                block = child.tag in BLOCKS
                if block:
                    totals[-1] += length()
                if not outside(child):
                    work.append((child, iter(child.children), block))
                    if block:
                        totals.append(0)
                elif block:
                    tops.append(child)
    return out


def _post_order(root: Node) -> Iterator[Node]:
    """Nodes below and including ``root``, children first; without recursion, as trees can be very deep."""
    work = [(root, iter(root.nodes()))]
    while work:
        child = next(work[-1][1], None)
        if child is None:
            yield work.pop()[0]
        else:
            work.append((child, iter(child.nodes())))


def _hash(*parts: bytes) -> bytes:
    return blake2b(b"".join([len(part).to_bytes(4, "little") + part for part in parts]), digest_size=8).digest()


def digests(nodes: Iterable[Node]) -> tuple[dict[int, bytes], set[int]]:
    """By id, a digest of the text and the elements below every node, and the nodes with text; white space counts as one space.

    Children come before parents.
    """
    out: dict[int, bytes] = {}
    filled: set[int] = set()
    for node in nodes:
        parts, text = [node.tag.encode(), node.names.encode()], False
        for child in node.children:
            if not isinstance(child, str):
                parts.append(out[id(child)])
                text = text or id(child) in filled
            elif words := child.split():
                parts.append(b"t" + " ".join(words).encode())
                text = True
        out[id(node)] = _hash(*parts)
        if text:
            filled.add(id(node))
    return out, filled


@lru_cache(1 << 14)
def _path(above: bytes, key: tuple[str, str]) -> bytes:
    return _hash(above, *(k.encode() for k in key))


def signs(root: Node, content: dict[int, bytes], filled: set[int], place: Place = ()) -> dict[int, int]:
    """What a block node is known by on other pages: keys from the top, and its content.  Empty nodes have none.

    ``place`` is that of ``root`` on its page.
    """
    out: dict[int, int] = {}
    top = b""
    for *key, _ in place:
        top = _path(top, tuple(key))
    work = [(root, top)]
    while work:
        node, path = work.pop()
        for child in node.children:
            if not isinstance(child, str) and child.tag in BLOCKS:
                here = _path(path, child.key)
                if id(child) in filled:
                    out[id(child)] = int.from_bytes(_hash(here, content[id(child)]), "little", signed=True)
                work.append((child, here))
    return out


class Shapes:
    """Numbers of the shapes of nodes: a node's key and the shapes of the block nodes below."""

    def __init__(self):
        self._numbers: dict[tuple, int] = {}
        self.below: list[tuple[int, ...]] = []
        self.keys: list[tuple[str, str]] = []

    def read(self, root: Node) -> Shaped:
        nodes = list(_post_order(root))
        shape: dict[int, int] = {}
        lists: dict[int, list[Node]] = {}
        for node in nodes:
            below = lists[id(node)] = _matched(node)
            key = (node.key, tuple([shape[id(c)] for c in below]))
            number = shape[id(node)] = self._numbers.setdefault(key, len(self._numbers))
            if number == len(self.below):
                self.below.append(key[1])
                self.keys.append(node.key)
        return Shaped(root, shape, lists, *digests(nodes))


@dataclass
class Shaped:
    """A tree as it is matched; all by id of its nodes."""

    root: Node
    shape: dict[int, int]
    lists: dict[int, list[Node]]
    content: dict[int, bytes]
    filled: set[int]


class TreeMatch:
    """Simple tree matching of two forests, exact for lists of any length and trees of any depth.

    The size of the largest matching of two nodes depends on their shapes only (keys of the block nodes below), so it is
    computed once per pair of different shapes.  A list is matched by rows of the usual table, of which
    every sqrt(n)-th is kept, more of a small one; the way back computes the rows in between again.
    """

    def __init__(self, a: Node | Shaped, b: Node | Shaped, shapes: Shapes | None = None):
        """``shapes``: those that numbered ``a`` and ``b``, if they are read already."""
        shapes = shapes or Shapes()
        self._below, self._keys = shapes.below, shapes.keys
        self._sizes: dict[tuple[int, int], int] = {}
        self._a, self._b = (shapes.read(t) if isinstance(t, Node) else t for t in (a, b))

    def pairs(self) -> list[tuple[Node, Node]]:
        """Matched nodes, ancestors before descendants."""
        out, work = [], [(self._a.root, self._b.root)]
        while work:
            x, y = work.pop()
            found = self._align(self._a.lists[id(x)], self._b.lists[id(y)])
            out += found
            work += found
        return out

    def size(self) -> int:
        """Number of matched nodes below the roots."""
        a, b = (self._below[t.shape[id(t.root)]] for t in (self._a, self._b))
        self._fill([(a, b)])
        return self._best(a, b)

    def same(self, x: Node, y: Node) -> bool:
        return self._a.content[id(x)] == self._b.content[id(y)]

    def _wanted(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[tuple[int, int]]:
        keys = self._keys
        return [(s, t) for s in set(a) for t in set(b) if keys[s] == keys[t] and (s, t) not in self._sizes]

    def _fill(self, lists: list[tuple[tuple[int, ...], tuple[int, ...]]]) -> None:
        """Sizes of all pairs of shapes that the lists' tables need."""
        work = [pair for a, b in lists for pair in self._wanted(a, b)]
        while work:
            s, t = work[-1]
            if (s, t) in self._sizes:
                work.pop()
            elif more := self._wanted(self._below[s], self._below[t]):
                work += more
            else:
                self._sizes[s, t] = 1 + self._best(self._below[s], self._below[t])
                work.pop()

    def _weights(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each of ``a``, sizes by row and place in ``b``)."""
        kinds, others = ({s: i for i, s in enumerate(dict.fromkeys(shapes))} for shapes in (a, b))
        table = np.array([[self._sizes.get((s, t), 0) if self._keys[s] == self._keys[t] else 0 for t in others] for s in kinds], np.int64)
        return np.array([kinds[s] for s in a]), table[:, [others[t] for t in b]]

    def _best(self, a: tuple[int, ...], b: tuple[int, ...]) -> int:
        if not a or not b:
            return 0
        if len(a) == len(b) == 1:
            return self._sizes.get((a[0], b[0]), 0) if self._keys[a[0]] == self._keys[b[0]] else 0
        rows, weights = self._weights(a, b)
        row = np.zeros(len(b) + 1, np.int64)
        for i in rows.tolist():
            row = _next_row(row, weights[i])
        return int(row[-1])

    def _align(self, xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        if not xs or not ys:
            return []
        if len(xs) == len(ys) == 1:
            return [(xs[0], ys[0])] if xs[0].key == ys[0].key else []
        a, b = tuple([self._a.shape[id(n)] for n in xs]), tuple([self._b.shape[id(n)] for n in ys])
        self._fill([(a, b)])
        rows, weights = self._weights(a, b)
        content: dict[bytes, int] = {}
        there = np.array([content.setdefault(self._b.content[id(n)], len(content)) for n in ys])
        here = np.array([content.get(self._a.content[id(n)], -1) for n in xs])
        scale = min(len(xs), len(ys)) + 1
        step = max(isqrt(len(xs)), _TABLE // len(ys)) + 1

        def table(low: int, row: np.ndarray) -> list[np.ndarray]:
            """``row`` and the rows behind it up to the next one that is kept; size counts first, then equal content."""
            sizes = weights[rows[low : low + step]]
            out = [row]
            for weight in sizes * scale + ((there == here[low : low + step, None]) & (sizes > 0)):
                out.append(_next_row(out[-1], weight))
            return out

        lows = range(0, len(xs), step)
        kept = [np.zeros(len(ys) + 1, np.int64)]
        for low in lows[:-1]:
            kept.append(table(low, kept[-1])[-1])
        out, j = [], len(ys)
        for low in reversed(lows):
            found = table(low, kept.pop())
            for i in range(len(found) - 1, 0, -1):
                above, below = found[i - 1], found[i]
                j = int(np.searchsorted(below[: j + 1], below[j]))
                if j and above[j] != below[j]:
                    j -= 1
                    out.append((xs[low + i - 1], ys[j]))
        return out[::-1]


def _next_row(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The table's row behind ``row``: best matchings of one node more with each head of the other list."""
    # Rows never fall, so a weight of 0, for no pair, gives no more than the row has.
    out = np.zeros(len(row), np.int64)
    np.maximum(row[:-1] + weight, row[1:], out=out[1:])
    return np.maximum.accumulate(out, out=out)


def _matched(node: Node) -> list[Node]:
    return [n for n in node.nodes() if n.tag in BLOCKS or n.tag in RAW]


@dataclass
class Wrapper:
    """``main``: place of the main slot; ``template``: signs of nodes that never vary."""

    main: Place | None = None
    template: frozenset[int] = frozenset()


def place_of(root: Node, wanted: Node) -> Place | None:
    """Place of a block node: keys from the top, counted among equal siblings; None for the root."""
    above: dict[int, Node] = {}
    work = [root]
    while work and id(wanted) not in above:
        node = work.pop()
        for child in node.nodes():
            if child.tag in BLOCKS:
                above[id(child)] = node
                work.append(child)
    out, node = [], wanted
    while node is not root:
        equal = [id(n) for n in above[id(node)].nodes() if n.key == node.key]
        out.append((*node.key, equal.index(id(node))))
        node = above[id(node)]
    return tuple(out[::-1]) or None


def node_at(root: Node, place: Place) -> Node | None:
    """The node at a place, if the page has it."""
    node = root
    for tag, names, number in place:
        equal = [n for n in node.nodes() if n.key == (tag, names)]
        if number >= len(equal):
            return None
        node = equal[number]
    return node


def best_container(root: Node, constant: Collection[int] | None = None) -> Node:
    """The node whose own blocks hold most text; that of nodes whose ids are ``constant`` does not count.

    Named or semantic containers come first; without one it is the smallest node with nearly all text.
    """
    candidates, work = [], [root]
    while work:
        node = work.pop()
        for child in node.nodes():
            if not outside(child) and child.tag in BLOCKS:
                work.append(child)
                if child.tag in ("article", "main") or (child.tag in ("div", "section", "td") and (_MAIN_NAMES.search(child.names) or child.names == "main")):
                    candidates.append(child)

    articles = [n for n in candidates if n.tag == "article"] or [n for n in candidates if n.tag == "main"] or candidates
    if len(articles) == 1:
        return articles[0]
    found = sizes(root)

    def measure(node: Node) -> int:
        return 0 if constant and id(node) in constant else found.get(id(node), 0)

    if articles:
        return max(articles, key=measure)
    node = root
    total = max(map(measure, _block_nodes(root)), default=0) if constant is not None else measure(root)
    while True:
        inner = [c for c in node.nodes() if c.tag in BLOCKS and not outside(c)]
        heavy = max(inner, key=measure, default=None)
        if heavy is None or heavy.tag == "p" or measure(heavy) < 0.9 * total:
            return node
        node = heavy


class Tally:
    """What distinct pages of one host say about its wrapper: on how many a node is, for how many a place is the main slot.

    Every page is aligned with the one before and the one behind it, the last one with the first; three trees are held.
    """

    def __init__(self):
        self.pages = 0
        self.signs: Counter[int] = Counter()
        self.slots: Counter[Place | None] = Counter()
        self._shapes = Shapes()
        self._first = self._last = None

    def add(self, tree: Node) -> None:
        shaped = self._shapes.read(tree)
        page = (shaped, set())
        self.pages += 1
        self.signs.update(set(signs(tree, shaped.content, shaped.filled).values()))
        if self._last is None:
            self._first = page
        else:
            self._align(self._last, page)
            if self._last is not self._first:
                self._propose(self._last)
        self._last = page

    def close(self) -> None:
        if self.pages > 2:
            self._align(self._last, self._first)
        if self.pages > 1:
            self._propose(self._first)
            self._propose(self._last)

    def _align(self, one: tuple[Shaped, set[int]], other: tuple[Shaped, set[int]]) -> None:
        """Notes in both pages which nodes have the content of their partner."""
        match = TreeMatch(one[0], other[0], self._shapes)
        for x, y in match.pairs():
            if match.same(x, y):
                one[1].add(id(x))
                other[1].add(id(y))

    def _propose(self, page: tuple[Shaped, set[int]]) -> None:
        tree, constant = page[0].root, page[1]
        # With nothing that varies all text counts.
        varies = any(id(n) not in constant for n in _block_nodes(tree))
        self.slots[place_of(tree, best_container(tree, constant if varies else None))] += 1


def induce(pages: list[Node]) -> Wrapper:
    """The wrapper of a host from all its distinct pages."""
    if len(pages) < LEAST_PAGES:
        return Wrapper()
    tally = Tally()
    for page in pages:
        tally.add(page)
    tally.close()
    main = max(tally.slots, key=lambda p: (tally.slots[p], json.dumps(p)))
    return Wrapper(main, frozenset(s for s, n in tally.signs.items() if n >= LEAST_PAGES and 2 * n >= len(pages)))


def _block_nodes(root: Node) -> Iterator[Node]:
    work = [root]
    while work:
        node = work.pop()
        for child in node.nodes():
            if child.tag in BLOCKS:
                yield child
                work.append(child)


def extract(root: Node, wrapper: Wrapper) -> str:
    """Main text of a page: its main slot without the template's nodes."""
    main = node_at(root, wrapper.main) if wrapper.main is not None else None
    own = best_container(root)
    # An article of the page's own wins over a slot that lies elsewhere.
    if main is None or outside(main) or (own.tag == "article" and main.tag != "article"):
        main = own
    dropped = frozenset()
    if wrapper.template:
        known = signs(main, *digests(_post_order(main)), place_of(root, main) or ())
        dropped = frozenset(i for i, sign in known.items() if sign in wrapper.template)
    return " ".join((dropped and blocks(main, dropped)) or blocks(main))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def host_of(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host``."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))
    return pages.select("page_id", "url", "html", host.alias("host"))


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, main, template): one row a host, of hosts with LEAST_PAGES distinct pages or more; ``main`` is JSON."""
    # One page of each content, by hash.
    rows = rows.select("host", F.xxhash64("host", "html").alias("content"), "html")
    counts = rows.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    counts = stored(counts, "hosts")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies within a batch are sent once, so that a page with very many of them is no task's burden."""
        for batch in batches:
            yield batch.take(pa.array(np.unique(batch.column("content").to_numpy(), return_index=True)[1]))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, tally = None, None, Tally()
        for batch in batches:
            for host, part, content, page in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, part) != at:
                    tally.close()
                    yield from _told(at, tally)
                    at, last, tally = (host, part), None, Tally()
                if content != last:
                    tally.add(parse(page))
                    last = content
                if len(tally.signs) > TOLD_SIGNS:
                    yield from _told(at, tally)
        tally.close()
        yield from _told(at, tally)

    part = F.pmod("content", F.ceil(F.col("pages") / PART_PAGES)).alias("part")
    dealt = rows.join(counts, "host").select("host", part, "content", "html")
    dealt = dealt.mapInArrow(tidy(once), dealt.schema).repartition("host", "part").sortWithinPartitions("host", "part", "content")
    told = dealt.mapInArrow(tidy(tell), "host string, sign long, slot string, n long")
    told = told.groupBy("host", "sign", "slot").agg(F.sum("n").alias("n")).join(counts, "host")
    slot = F.col("slot").isNotNull()
    told = told.where(slot | ((F.col("n") >= LEAST_PAGES) & (2 * F.col("n") >= F.col("pages"))))
    main = F.max(F.struct(F.when(slot, F.col("n")).alias("n"), "slot"))["slot"].alias("main")
    return told.groupBy("host").agg(main, F.collect_list("sign").alias("template"))


def _told(at: tuple[str, int] | None, tally: Tally) -> Iterator[pa.RecordBatch]:
    """Counts of a part since the last time: of its nodes, and of its pages' main slots."""
    found = [(sign, None, n) for sign, n in tally.signs.items()] + [(None, json.dumps(place), n) for place, n in tally.slots.items()]
    if found:
        columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(found)), *columns], names=["host", "sign", "slot", "n"])
        tally.signs.clear()
        tally.slots.clear()


class _Wrappers:
    """The last host's wrapper; pages of one host often come in a row."""

    def __init__(self):
        self._at, self._wrapper = None, Wrapper()

    def of(self, host: str, main: str | None, template: list[int] | None) -> Wrapper:
        if host != self._at:
            place = json.loads(main) if main else None
            self._at, self._wrapper = host, Wrapper(place and tuple(map(tuple, place)), frozenset(template or ()))
        return self._wrapper


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    small_batches(pages)
    rows = host_of(pages)
    known = stored(wrappers(rows), "wrappers")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Wrappers()
        for batch in batches:
            out = []
            for page_id, url, page, host, main, template in zip(*(c.to_pylist() for c in batch.columns)):
                text = extract(parse(page), held.of(host, main, template))
                out.append((page_id, url, text, len(text)))
            if out:
                yield _batch(out)

    met = rows.join(known, "host", "left").select("page_id", "url", "html", "host", "main", "template")
    return met.mapInArrow(tidy(read), "page_id long, url string, text string, n_chars long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)
