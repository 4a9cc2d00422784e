"""Near-duplicate components by banded MinHash with sequential Bayesian verification.

A document's set holds its distinct two-word shingles as 64-bit hashes; documents link when
100 * intersection >= 80 * union.

1. Every document gives a digest of its set and a signature of BANDS * ROWS values.  Equal sets are
   folded to their smallest doc_id first, so copies are never candidates of each other.
2. Sets that agree in all values of a band meet in a bucket.  A pair at the threshold shares no bucket
   with probability (1 - 0.8 ** ROWS) ** BANDS = 2.4e-9.
3. Candidates are compared in lots of two bounded sides.  Signatures are looked at batch by batch: after m
   values with k matches the posterior of the similarity (uniform prior) is Beta(k + 1, m - k + 1), and
   the pair is dropped when the chance of 0.8 or more falls below MISS.  What is left is decided by
   the full sets, from the whole texts.
4. First each set is compared with the smallest of its buckets, then with the smallest of each bucket, in both cases
   only while still in different components; a group of near copies mostly collapses here.  Components that
   share a bucket and are still apart are compared last: the nodes of the smaller one against all of the larger one,
   and the nodes of buckets with very many components, block by block.  Only links and the nodes of surviving pairs are
   ever written, never all pairs of a bucket, and one link between two components is enough.
5. Bucket rows and lots are joined by sort and merge (``merged``), so the driver never holds them for a broadcast.

Null and empty texts have an empty set, no links and themselves as component.  A null doc_id gets a null
component and counts as kept.  Rows that repeat a doc_id are one node: it links where any of them links, and each
row reports the size of its own set.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.components import components
from ratelake.llm.jaccard_join import pack_texts, slices, unpack_texts
from ratelake.llm.shared import small_batches, stored, tidy
from ratelake.llm.words import mix64, window_hashes, word_blocks

SHINGLE = 2
PERCENT = 80
BANDS = 50
ROWS = 5
#: Values of a signature that are compared at a time, and the chance of a link at which a pair is dropped.
BATCH = 25
MISS = 1e-9
#: Nodes on a side of a lot, and components in a bucket up to which they are paired.
SIDE = 1024
PAIRED = 32


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of each row."""
    for block in word_blocks(column, lower=True):
        at, hashes = window_hashes(block, SHINGLE)
        cuts = np.searchsorted(at, block.bounds)
        for i in range(len(block.bounds) - 1):
            if cuts[i] < cuts[i + 1]:
                yield np.unique(hashes[cuts[i] : cuts[i + 1]])
            else:
                yield mix64(block.hashes[block.bounds[i] : block.bounds[i + 1]])


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)
    values = mix64(steps * np.uint64(0x9E3779B97F4A7C15))
    return values[::2], values[1::2] | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS * ROWS 16-bit values per set; all sets hold something."""
    flip, factor = _functions()
    every = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]])]).astype(np.int64)
    out = np.empty((len(sets), len(flip)), np.uint16)
    for k in range(len(flip)):
        least = np.minimum.reduceat((every ^ flip[k]) * factor[k], begins)
        out[:, k] = mix64(least) >> np.uint64(48)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per row and band."""
    values = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), values.shape[:2])
    for j in range(ROWS):
        keys = mix64((keys ^ values[:, :, j]) * np.uint64(0x9E3779B97F4A7C15))
    return keys.view(np.int64)


@cache
def fewest_matches() -> tuple[int, ...]:
    """After 1, 2, ... batches: the matches from which on a pair is kept.

    For m values with k matches the chance of a similarity of t or more is P(Beta(k + 1, m - k + 1) >= t),
    which is P(Bin(m + 1, t) <= k).
    """

    def chance(k: int, m: int) -> float:
        t = PERCENT / 100
        return sum(math.comb(m + 1, i) * t**i * (1 - t) ** (m + 1 - i) for i in range(k + 1))

    sizes = range(BATCH, BANDS * ROWS + 1, BATCH)
    return tuple(next(k for k in range(m + 1) if chance(k, m) >= MISS) for m in sizes)


def plausible(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Rows of ``others`` that no batch of signature values rules out as linked with ``query``."""
    alive, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for i, fewest in enumerate(fewest_matches()):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (others[alive, part] == query[part]).sum(axis=1)
        keep = matches >= fewest
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 80 * union of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


_SIGNED = "doc_id long, n long, high long, low long, signature binary"


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest (high, low) and signature of every row; nothing is signed where the set is empty."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column(1)))
            sizes = np.array([len(s) for s in sets], np.int64)
            filled = [s for s in sets if len(s)]
            rows = iter(signatures(filled)) if filled else iter(())
            high = [int(mix64(s).sum(dtype=np.uint64)) for s in sets]
            low = [int(mix64(s ^ np.uint64(0x7FB5D329728EA185)).sum(dtype=np.uint64)) for s in sets]
            as_long = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            signature = pa.array([next(rows).tobytes() if n else None for n in sizes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), as_long(high), as_long(low), signature], names=["doc_id", "n", "high", "low", "signature"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(tidy(sign), _SIGNED)


def merged(many: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``many`` joined with ``other`` by sort and merge.

    Spark's size of rows that explode or mapInArrow multiply is that of the rows they came from, so it would gather
    millions of them in the driver to broadcast them.
    """
    return many.join(other.hint("merge"), key)


def bands(distinct: DataFrame) -> DataFrame:
    """(key, node): the buckets of every set."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column(1).to_pylist()))
                nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], names=["key", "node"])

    return distinct.select("node", "signature").mapInArrow(tidy(deal), "key long, node long")


def _matrix(signatures_: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures_), np.uint16).reshape(len(signatures_), BANDS * ROWS)


class Labels:
    """Components within one lot."""

    def __init__(self):
        self._above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self._above.get(x, x) != x:
            x = self._above[x]
        return x

    def join(self, x: int, y: int) -> None:
        self._above[self.find(x)] = self.find(y)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Consecutive rows (g, lot, ...) of one lot."""
    at, rows = None, []
    for batch in slices(batches):
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if row[:2] != at and rows:
                yield rows
                rows = []
            at = row[:2]
            rows.append(row)
    if rows:
        yield rows


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("g", "lot").sortWithinPartitions("g", "lot", "side", "node")


def links_between(groups: DataFrame, distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between the two sides of lots, at least one for each two components that have any.

    ``groups`` (g, lot, side, node, label); a lot holds at most SIDE nodes of each side.
    """
    keys = "g long, lot long, side int, node long, label long"
    names = ["g", "lot", "side", "node", "label"]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lots(batches):
            sides = [[r for r in rows if r[2] == side] for side in (0, 1)]
            if not all(sides):
                continue
            matrix = _matrix([r[6] for r in sides[1]])
            labels, sizes = (np.array([r[i] for r in sides[1]], np.int64) for i in (4, 5))
            hit, out = np.zeros(len(sides[1]), bool), []
            for row, values in zip(sides[0], _matrix([r[6] for r in sides[0]])):
                fits = np.flatnonzero((labels != row[4]) & (100 * np.minimum(sizes, row[5]) >= PERCENT * np.maximum(sizes, row[5])))
                if len(fits) and len(found := fits[plausible(values, matrix[fits])]):
                    hit[found] = True
                    out.append(row[:5])
            out += [sides[1][i][:5] for i in np.flatnonzero(hit)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(zip(*out))], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pack_texts(batch.column(1)), pa.binary())], names=["node", "packed"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lots(batches):
            sets = list(shingle_sets(unpack_texts(pa.array([r[5] for r in rows], pa.binary()))))
            use = [(r, s) for r, s in zip(rows, sets) if len(s)]
            values = signatures([s for _, s in use]) if use else []
            sides = [[(r[3], r[4], s, v) for (r, s), v in zip(use, values) if r[2] == side] for side in (0, 1)]
            if not all(sides):
                continue
            joined, out = Labels(), []
            matrix = np.array([v for *_, v in sides[1]])
            for node, label, query, signature in sides[0]:
                for i in plausible(signature, matrix).tolist():
                    other, its_label, member, _ = sides[1][i]
                    if joined.find(label) != joined.find(its_label) and linked(query, member):
                        joined.join(label, its_label)
                        out.append((node, other))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    sides = merged(groups, distinct.select("node", "n", "signature"), "node").select(*names, "n", "signature")
    left = stored(_dealt(sides).mapInArrow(tidy(prune), keys), "plausible")
    texts = docs.where("text IS NOT NULL").selectExpr("CAST(doc_id AS BIGINT) AS node", "text")
    texts = texts.join(left.select("node").distinct(), "node", "left_semi").mapInArrow(tidy(pack), "node long, packed binary")
    texts = texts.groupBy("node").agg(F.collect_set("packed").alias("all")).select("node", F.explode("all").alias("packed"))
    return stored(_dealt(merged(texts, left, "node").select(*names, "packed")).mapInArrow(tidy(verify), "a long, b long"), "links")


def relabelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` (node, label) after ``links`` between nodes; labels are the smallest node of a component."""
    of = nodes.select(F.col("node").alias("a"), F.col("label").alias("la"))
    ends = links.join(of, "a").join(of.withColumnsRenamed({"a": "b", "la": "lb"}), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    merged = components(ends.distinct()).select(F.col("node").alias("label"), F.col("label").alias("lower"))
    return stored(nodes.join(merged, "label", "left").select("node", F.coalesce("lower", "label").alias("label")), "labels")


def against(asked: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Lots of ``asked`` (g, node) as side 0 against ``members`` (g, node) as side 1, both in blocks of SIDE nodes."""

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("g").agg(F.ceil(2 * F.count("*") / SIDE).alias(name))

    def block(name: str):
        return F.pmod(F.xxhash64("node"), F.col(name))

    # Blocks are filled by hash to about half, so that none holds more than a side.
    sizes = blocks(asked, "rows").join(blocks(members, "columns"), "g")
    lot = F.col("row") * F.col("columns") + F.col("column")
    every = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))
    side0 = asked.join(sizes, "g").withColumn("row", block("rows")).withColumn("column", every("columns")).select("g", lot.alias("lot"), F.lit(0).alias("side"), "node")
    side1 = members.join(sizes, "g").withColumn("column", block("columns")).withColumn("row", every("rows")).select("g", lot.alias("lot"), F.lit(1).alias("side"), "node")
    return merged(side0.unionByName(side1), nodes, "node")


def star(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Lots for ``pairs`` (node, low): nodes still apart from a leader against that leader."""
    of = nodes.select(F.col("node").alias("low"), F.col("label").alias("there"))
    apart = stored(pairs.join(nodes, "node").join(of, "low").where("label <> there").select(F.col("low").alias("g"), "node"), "apart")
    return against(apart, nodes, apart.select("g").distinct().withColumn("node", F.col("g")))


def rest(cells: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lots of component against component, nodes of buckets with very many components).

    The smaller of two components asks all of the larger one.
    """
    seen = cells.join(nodes, "node").select("key", "label").distinct()
    wide = seen.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    seen = stored(seen.join(wide, "key"), "apart")
    few = seen.where(F.col("c") <= PAIRED).select("key", "label")
    other = few.withColumnRenamed("label", "other")
    pairs = few.join(other, "key").where("label < other").select("label", "other").distinct()
    sizes = nodes.groupBy("label").agg(F.count("*").alias("size"))
    pairs = pairs.join(sizes, "label").join(sizes.withColumnsRenamed({"label": "other", "size": "there"}), "other")
    small = F.when(F.col("size") <= F.col("there"), F.col("label")).otherwise(F.col("other"))
    pairs = stored(pairs.select(small.alias("label"), (F.col("label") + F.col("other") - small).alias("g")), "components")
    asked = pairs.join(nodes, "label").select("g", "node")
    members = pairs.select("g").distinct().join(nodes.withColumnRenamed("label", "g"), "g").select("g", "node")
    crowded = seen.where(F.col("c") > PAIRED).select("label").distinct().join(nodes, "label").select("node")
    return against(asked, nodes, members), stored(crowded, "crowded")


def each_with_each(crowded: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """Lots of all blocks of ``crowded`` nodes against each other."""
    blocks = -(-2 * count // SIDE)
    mine = F.pmod(F.xxhash64("node"), F.lit(blocks))
    dealt = crowded.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    first = dealt.where("mine <= other").select(low.alias("g"), high.alias("lot"), F.lit(0).alias("side"), "node")
    second = dealt.where("mine >= other").select(low.alias("g"), high.alias("lot"), F.lit(1).alias("side"), "node")
    return merged(first.unionByName(second), nodes, "node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of ``docs``."""
    small_batches(docs)
    rows = stored(signed(docs), "signed")
    filled = rows.where("n > 0 AND doc_id IS NOT NULL")
    folded = stored(filled.groupBy("high", "low", "n").agg(F.min("doc_id").alias("node")), "folded")
    distinct = filled.withColumnRenamed("doc_id", "node").join(folded, ["node", "high", "low", "n"], "left_semi").dropDuplicates(["node", "high", "low", "n"])
    distinct = stored(distinct.select("node", "n", "signature"), "distinct")

    every = bands(distinct)
    shared = every.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("most")).where("low < most").select("key", "low")
    cells = stored(merged(every, shared, "key"), "cells")
    nodes = distinct.select("node", F.col("node").alias("label")).distinct()

    pairs = stored(cells.where("node <> low").select("node", "low").distinct(), "pairs")
    nodes = relabelled(nodes, links_between(star(pairs.groupBy("node").agg(F.min("low").alias("low")), nodes), distinct, docs))
    nodes = relabelled(nodes, links_between(star(pairs, nodes), distinct, docs))
    lots, crowded = rest(cells.select("key", "node"), nodes)
    nodes = relabelled(nodes, links_between(lots, distinct, docs))
    count = crowded.count()
    if count:
        nodes = relabelled(nodes, links_between(each_with_each(crowded, nodes, count), distinct, docs))

    # Rows of one doc_id with different sets are one node.
    named = filled.select("doc_id", "high", "low", "n").join(folded, ["high", "low", "n"]).select("doc_id", "node").distinct()
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a < most")
    same = named.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    nodes = relabelled(nodes, stored(same, "same-id"))
    labels = named.join(nodes, "node").groupBy("doc_id").agg(F.min("label").alias("label"))
    out = rows.select("doc_id", "n").join(labels, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
