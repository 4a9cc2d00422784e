"""Periodic runs of words, by maximal pairs in the LCP-interval tree of each document.

A run with smallest period q that starts at s and has length L is the maximal pair (s, s + q): the
suffixes at both places share L - q words, the words to their left differ and so do the words behind.
The other way round, each maximal pair (i, j) sharing ``l`` words with j - i <= l is a stretch with
period j - i that no neighbour extends; of the pairs with the same stretch the least distance is its
smallest period.  So nothing needs to be extended afterwards.

1. Suffixes are sorted by prefix doubling over word numbers; the ranks of all steps give the lengths
   of common prefixes.  A run of 12 words or more shares at least six words with itself, so documents
   whose six-word windows all differ are done before that.
2. The tree of LCP intervals of six words or more is walked from below.  A node holds its suffixes,
   sorted, once as a whole and once by their left word.  Joining a child looks around each suffix of the
   smaller side, no further than the shared length, for suffixes with another left word: through the
   left-word classes where these are fewer than the suffixes in reach, else through those.

Every document is worked on by itself and whole, so rows are never shuffled.  Memory grows with one
document only: about 20 integers a word.

Null and empty texts have no words and no run.  A null doc_id has no hash, so its words stay as they are.
Repeated rows give repeated results, an empty table none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratelake.llm.shared import small_batches, tidy

#: Least length of a run in words, and in periods.
LEAST_WORDS = 12
LEAST_PERIODS = 2


def word_numbers(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


class Suffixes:
    """Suffix order of a sequence of word numbers and the common prefix of each suffix with the one before."""

    def __init__(self, numbers: np.ndarray):
        self.n = len(numbers)
        self._ranks: list[np.ndarray] = []  # ranks of the first 1, 2, 4, ... words; 0 stands behind the end
        self._add(numbers)

    def _add(self, keys: np.ndarray) -> None:
        distinct, place = np.unique(keys, return_inverse=True)
        self.settled = len(distinct) == self.n
        self._ranks.append(np.append(place + 1, 0).astype(np.int32))

    def double(self) -> None:
        reach = 1 << (len(self._ranks) - 1)
        last = self._ranks[-1].astype(np.int64)
        behind = np.zeros(self.n, np.int64)
        behind[: max(self.n - reach, 0)] = last[reach : self.n]
        self._add(last[: self.n] * (self.n + 1) + behind)

    def repeats(self, words: int) -> bool:
        """Whether any window of ``words`` words occurs twice."""
        while not self.settled and 2 << (len(self._ranks) - 1) <= words:
            self.double()
        count, reach = self.n - words + 1, 1 << (len(self._ranks) - 1)
        if self.settled or count <= 1:
            return False
        last = self._ranks[-1].astype(np.int64)
        keys = last[:count] * (self.n + 1) + last[words - reach : words - reach + count]
        return len(np.unique(keys)) < count

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes in order, words that each shares with the one before it)."""
        while not self.settled:
            self.double()
        order = np.empty(self.n, np.int64)
        order[self._ranks[-1][: self.n] - 1] = np.arange(self.n)
        a, b = order[:-1], order[1:]
        shared = np.zeros(max(self.n - 1, 0), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            shared += (self._ranks[k][a + shared] == self._ranks[k][b + shared]).astype(np.int64) << k
        return order, np.concatenate([[0], shared])


class Node:
    """Suffixes below an LCP interval: sorted, and sorted within each left word."""

    __slots__ = ("all", "by_left")

    def __init__(self, suffix: int, left: int):
        self.all = [suffix]
        self.by_left = {left: [suffix]}

    def apart(self, suffix: int, left: int, reach: int) -> Iterator[int]:
        """Suffixes within ``reach`` of ``suffix`` whose left word is another one."""
        low, high = bisect_left(self.all, suffix - reach), bisect_right(self.all, suffix + reach)
        if high - low > len(self.by_left):
            for other, places in self.by_left.items():
                if other != left:
                    yield from places[bisect_left(places, suffix - reach) : bisect_right(places, suffix + reach)]
        elif low < high:
            same = self.by_left.get(left, ())
            for place in self.all[low:high]:
                at = bisect_left(same, place)
                if at == len(same) or same[at] != place:
                    yield place

    def take(self, other: Node) -> None:
        for suffix in other.all:
            insort(self.all, suffix)
        for left, places in other.by_left.items():
            mine = self.by_left.setdefault(left, [])
            for suffix in places:
                insort(mine, suffix)


def near_maximal_pairs(order: list[int], shared: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, l): maximal pairs that share ``l`` words, at least ``least``, and are at most ``l`` apart."""

    def join(a: Node, b: Node, words: int) -> Iterator[tuple[int, int, int]]:
        small, large = (a, b) if len(a.all) <= len(b.all) else (b, a)
        for word, places in small.by_left.items():
            for x in places:
                for y in large.apart(x, word, words):
                    yield (x, y, words) if x < y else (y, x, words)
        large.take(small)
        return large

    stack: list[tuple[int, Node]] = []
    for at, suffix in enumerate(order):
        node = Node(suffix, left[suffix])
        words = shared[at + 1] if at + 1 < len(order) else 0
        while stack and stack[-1][0] >= words:
            below, held = stack.pop()
            node = yield from join(held, node, below)
        if words >= least:
            stack.append((words, node))


def runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(numbers)
    least = -(-LEAST_WORDS // 2)
    if n < LEAST_WORDS:
        return []
    suffixes = Suffixes(numbers)
    if not suffixes.repeats(least):
        return []
    order, shared = suffixes.order()
    # Only suffixes that share enough words with a neighbour are below an interval of the tree.
    inside = (shared >= least) | np.append(shared[1:] >= least, False)
    order, shared = order[inside], np.where(shared >= least, shared, 0)[inside]
    left = [-1, *numbers[:-1].tolist()]
    found: dict[tuple[int, int], int] = {}
    for i, j, words in near_maximal_pairs(order.tolist(), shared.tolist(), left, least):
        period, key = j - i, (i, j - i + words)
        if period + words >= LEAST_WORDS and period < found.get(key, n):
            found[key] = period
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def with_repetition(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of every tenth document by hash, repeated from a place and with a period that depend on the hash."""
    if doc_id is None or not words:
        return words
    g, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    n = len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // period)
    return words[:a] + (words[a : a + period] * times)[: n - a]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside of what any run repeats after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    table = np.array(found)
    np.add.at(change, table[:, 0] + table[:, 2], 1)
    np.add.at(change, table[:, 0] + table[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_RESULT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def periodic_runs(docs: DataFrame, prepare=with_repetition) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of every row.

    ``prepare`` gives the words to search from (doc_id, words of the text).
    """
    small_batches(docs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = prepare(doc_id, text.as_py().encode().split() if text.is_valid else [])
                found = runs(word_numbers(words))
                longest = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                exponent = 1000 * longest[1] // longest[2] if found else None
                listed = "".join(f"{s},{k},{p}\n" for s, k, p in found)
                rows.append((doc_id, len(found), *longest, exponent, _sha(listed.encode()), _sha(b" ".join(collapsed(words, found)))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RESULT)], schema=_RESULT)

    kinds = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(tidy(search), kinds)
