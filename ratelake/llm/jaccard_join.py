"""Near-duplicate components by an n-gram Jaccard join over a token-group matrix.

A document's set holds its distinct five-word shingles as 64-bit hashes.  The join is exact for
100 * intersection >= 75 * union; only one link per pair of groups is looked for, since the result
is components.

1. Partition: documents with the same MinHash meet in one place, sorted by id, and are compared with
   a few leaders there.  A document joins the first leader it links with; the followers of a leader are a
   group of similar documents.  MinHash values that are frequent in a sample are salted, and the
   leaders of one value are compared once more.
2. Token-group matrix: a set's prefix (in one global order, frequent shingles last) must share a
   shingle with the prefix of every partner.  Its cells are (shingle, group); shingles found in one
   group only are left out.
3. The cells that a query shares with a group bound its overlap with every member; groups below the
   bound are never opened.  The others are first asked through their leader.  Then, for what is still
   apart, groups are opened in blocks of bounded size: a block's union of shingles bounds the overlap
   once more, over whole sets, and only blocks whose bound reaches 75 % of the query are searched.

The global order may be any order of shingles, so the sample behind it changes speed only.
Null and empty texts have an empty set, no links and themselves as component; a null doc_id gets a null
component; rows that repeat a doc_id are one node that links where any of them links, and each reports its own set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.components import components
from ratelake.llm.decontaminate import bit_table, slots
from ratelake.llm.shared import small_batches, stored, tidy
from ratelake.llm.words import mix64, text_buffers, window_hashes, word_blocks, words_of

SHINGLE = 5
PERCENT = 75
LEADERS = 8
BLOCK_MEMBERS = 64
BLOCK_QUERIES = 1024
#: One document in SAMPLE is looked at for frequent shingles and MinHash values.
SAMPLE = 8
SAMPLE_COUNT = 3
FREQUENT = 100_000
BITS = 22
HOT_SAMPLE = 64
HOT_KEYS = 10_000


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of each row."""
    for block in word_blocks(column, lower=True):
        at, hashes = window_hashes(block, SHINGLE)
        cuts = np.searchsorted(at, block.bounds)
        for i in range(len(block.bounds) - 1):
            if cuts[i] < cuts[i + 1]:
                yield np.unique(hashes[cuts[i] : cuts[i + 1]])
            else:
                words = block.hashes[block.bounds[i] : block.bounds[i + 1]]
                yield np.array([_whole(words)], dtype=np.uint64) if len(words) else np.zeros(0, np.uint64)


def _whole(words: np.ndarray) -> int:
    value = len(words)
    for w in words.tolist():
        value = (value * 0xD6E8FEB86659FD93 + w + 1) % (1 << 64)
    return value


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


class Order:
    """Global order of shingles: those marked frequent last, else by hash.  The marks take 2**BITS bits."""

    def __init__(self, frequent: np.ndarray):
        marks = np.zeros(1 << BITS, dtype=bool)
        marks[self._slot(frequent)] = True
        self._marks = np.packbits(marks)

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - BITS)).astype(np.int64)

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        """The part of a set that shares a shingle with the same part of every set it links with."""
        keep = len(shingles) - -(-PERCENT * len(shingles) // 100) + 1
        slot = self._slot(shingles)
        frequent = (self._marks[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1
        return shingles[np.argsort(frequent, kind="stable")][:keep]


def _longs(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _min_hash(shingles: np.ndarray) -> int:
    return int(_longs(mix64(shingles).min(keepdims=True))[0]) if len(shingles) else 0


def sample_counts(docs: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """(frequent shingles, salts of frequent MinHash values), both bounded, from a sample of documents."""
    sample = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(0)) if len(s)]
            keys = np.array([_min_hash(s) for s in sets], np.int64)
            both = np.concatenate([*map(_longs, sets), keys])
            kind = np.repeat(np.array([0, 1], np.int32), [len(both) - len(keys), len(keys)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(both)], names=["kind", "value"])

    counts = sample.select("text").mapInArrow(tidy(values), "kind int, value long").groupBy("kind", "value").agg(F.count("*").alias("n"))
    counts = counts.where(F.col("n") >= SAMPLE_COUNT)
    frequent = counts.where("kind = 0").orderBy(F.col("n").desc(), "value").limit(FREQUENT)
    hot = counts.where((F.col("kind") == 1) & (F.col("n") >= HOT_SAMPLE)).orderBy(F.col("n").desc(), "value").limit(HOT_KEYS)
    rows = stored(frequent.union(hot), "frequent").collect()
    shingles = np.array([r["value"] for r in rows if r["kind"] == 0], dtype=np.int64).view(np.uint64)
    return shingles, {r["value"]: math.ceil(r["n"] / HOT_SAMPLE) for r in rows if r["kind"] == 1}


_PLACED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("salt", pa.int32()), ("packed", pa.binary())])
_GROUPED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("leader", pa.int64()), ("prefix", pa.list_(pa.int64())), ("key", pa.int64()), ("packed", pa.binary())])
#: Rows that a task gathers before it hands them on.
ROWS = 512


def pack_texts(column: pa.Array) -> list[bytes]:
    """Texts travel compressed: less than half of what the shuffle's own codec makes of them."""
    compress = zstandard.ZstdCompressor(level=1).compress
    return [compress(t.as_buffer()) for t in column]


def unpack_texts(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([expand(t.as_buffer()) for t in column], pa.large_binary()).cast(pa.large_string())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def place(docs: DataFrame, salts: dict[int, int]) -> DataFrame:
    """Every non-empty document with its MinHash value and salt."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column(1)))
            keys = np.array([_min_hash(s) for s in sets], np.int64)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            mixed = mix64(ids.astype(np.int64).view(np.uint64))
            salt = [int(m % salts[k]) if k in salts else 0 for m, k in zip(mixed.tolist(), keys.tolist())] if salts else np.zeros(len(ids), np.int32)
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(keys), pa.array(salt, pa.int32()), pa.array(pack_texts(batch.column(1)), pa.binary())], schema=_PLACED)

    usable = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    return usable.select("doc_id", "text").mapInArrow(tidy(keyed), "doc_id long, n long, key long, salt int, packed binary").where("n > 0")


def group(placed: DataFrame, order: Order, salts: dict[int, int]) -> DataFrame:
    """doc_id, n, leader, prefix: one row per document of ``placed``.

    ``prefix`` is null where a leader has the same set.  Leaders of salted values keep key and text.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leaders = None, []
        for batch in slices(batches):
            rows = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, n, key, salt, packed, shingles in zip(*columns, batch.column(4), shingle_sets(unpack_texts(batch.column(4)))):
                if (key, salt) != at:
                    at, leaders = (key, salt), []
                leader = next((i for i, s in leaders if linked(shingles, s)), None)
                same = leader is not None and any(len(s) == n and np.array_equal(s, shingles) for _, s in leaders)
                if leader is None and len(leaders) < LEADERS:
                    leaders.append((doc_id, shingles))
                again = leader is None and key in salts
                prefix = None if same else _longs(order.prefix(shingles))
                rows.append((doc_id, n, doc_id if leader is None else leader, prefix, key if again else None, packed.as_py() if again else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _GROUPED)], schema=_GROUPED)

    dealt = placed.repartition("key", "salt").sortWithinPartitions("key", "salt", "doc_id")
    return dealt.mapInArrow(tidy(follow), "doc_id long, n long, leader long, prefix array<long>, key long, packed binary")


def merge_salts(grouped: DataFrame, order: Order) -> DataFrame:
    """Links (a, b) between leaders of one salted MinHash value."""
    again = grouped.where("key IS NOT NULL").select("doc_id", "n", "key", F.lit(0).alias("salt"), "packed")
    return group(again, order, {}).where("leader <> doc_id").select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))


def open_groups(docs: DataFrame, asked: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) from each (q, g) of ``asked`` to one member of the group, if any member links.

    ``members`` (g, doc_id).  Queries of a group are dealt to tasks in lots of BLOCK_QUERIES.
    """
    lots = asked.groupBy("g").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("lots"))
    wanted = members.join(lots, "g").select("g", "doc_id", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(0).alias("kind"))
    queries = asked.join(lots, "g").select("g", F.col("q").alias("doc_id"), F.pmod(F.xxhash64("q"), F.col("lots")).cast("int").alias("lot"), F.lit(1).alias("kind"))
    rows = stored(wanted.unionByName(queries), "asked")
    ids = rows.select("doc_id").distinct()
    # A bit table of fixed size keeps most texts that are not asked for out of the join.
    table = bit_table(ids.select(F.xxhash64("doc_id").alias("seed")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            slot = slots(batch.column(2).to_numpy().view(np.uint64))
            batch = batch.filter(pa.array((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pack_texts(batch.column(1)), pa.binary())], names=["doc_id", "packed"])

    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("doc_id").alias("seed")).mapInArrow(tidy(pack), "doc_id long, packed binary")
    # Grouped by what the join deals by, so that texts are dealt once.
    texts = texts.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set("packed").alias("all"))
    texts = stored(texts.select("doc_id", F.explode("all").alias("packed")), "texts")
    dealt = rows.join(texts, "doc_id").repartition("g", "lot").sortWithinPartitions("g", "lot", "kind", "doc_id").select("g", "lot", "kind", "doc_id", "packed")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, union = None, [], None
        for batch in slices(batches):
            found = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for g, lot, kind, doc_id, shingles in zip(*columns, shingle_sets(unpack_texts(batch.column(4)))):
                if (g, lot) != at:
                    at, held, union = (g, lot), [], None
                if kind == 0:
                    held.append((doc_id, shingles))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([s for _, s in held]))
                place_ = np.minimum(np.searchsorted(union, shingles), len(union) - 1)
                if 100 * int((union[place_] == shingles).sum()) < PERCENT * len(shingles):
                    continue
                partner = next((m for m, s in held if m != doc_id and linked(shingles, s)), None)
                if partner is not None:
                    found.append((doc_id, partner))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return dealt.mapInArrow(tidy(answer), "a long, b long")


def overlap_needed(a, b):
    """Shingles that sets of sizes ``a`` and ``b`` share in their prefixes at least if they link.

    Linked sets share 3/7 of the sum of their sizes.  Of the set whose prefix ends first, what lies
    behind the prefix can add no more than its length.
    """
    return F.ceil(3 * (a + b) / 7) - F.greatest(F.ceil(0.75 * a), F.ceil(0.75 * b)) + 1


def least_overlap(n, low, high):
    """The smallest ``overlap_needed(n, b)`` of the sizes b from ``low`` to ``high``.

    Up to ``n`` the need never falls as b grows.  Beyond, it falls by 9 every 28 sizes, but the ceilings
    let it rise by one in between, so that the size below ``high`` may need less than ``high``.
    """
    return F.least(*(overlap_needed(n, b) for b in (low, F.greatest(low, high - 1), high)))


def bounded_queries(cells: DataFrame) -> DataFrame:
    """(q, g): documents and groups with a smaller leader that share enough cells for a link.

    ``cells`` (shingle, doc_id, n, leader, g).  The need holds for all sizes between the ends of those
    a group has and that could link with the query at all.
    """
    there = cells.groupBy("shingle", "g").agg(F.first("leader").alias("other"))
    sizes = cells.groupBy("g").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    shared = cells.select("shingle", "doc_id", "n", "leader").join(there, "shingle").where("other < leader")
    counts = shared.groupBy(F.col("doc_id").alias("q"), "n", "g").agg(F.count("*").alias("common"))
    low, high = F.greatest("least", F.ceil(0.75 * F.col("n"))), F.least("most", F.floor(F.col("n") / 0.75))
    need = least_overlap(F.col("n"), low, high)
    return counts.join(sizes, "g").where((low <= high) & (F.col("common") >= need)).select("q", "g").distinct()


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of ``docs``."""
    small_batches(docs)
    frequent, salts = sample_counts(docs)
    order = Order(frequent)
    grouped = stored(group(place(docs, salts), order, salts), "grouped")
    links = merge_salts(grouped, order)
    # Rows of one doc_id may follow several leaders: these are linked, so that any one of them will do.
    several = grouped.groupBy("doc_id").agg(F.min("leader").alias("a"), F.max("leader").alias("most")).where("a < most")
    links = links.union(grouped.join(several, "doc_id").select("a", F.col("leader").alias("b")).where("a <> b").distinct())
    names = grouped.groupBy("doc_id").agg(F.min("leader").alias("leader"))

    def settled(nodes: DataFrame, links: DataFrame) -> DataFrame:
        """Nodes with the label of their leader's component; labels only ever get smaller."""
        labels = components(links).withColumnsRenamed({"node": "leader", "label": "lower"})
        return nodes.join(labels, "leader", "left").select("doc_id", F.coalesce("lower", "leader").alias("leader"))

    nodes = stored(settled(names, stored(links, "salted")), "nodes")
    # Cells of the matrix whose shingle is found in two groups or more.
    cells = grouped.where("prefix IS NOT NULL").select("doc_id", "n", "prefix").join(nodes, "doc_id")
    cells = cells.select(F.explode("prefix").alias("shingle"), "doc_id", "n", "leader")
    shared = cells.groupBy("shingle").agg(F.min("leader").alias("low"), F.max("leader").alias("high")).where("low < high").select("shingle")
    cells = stored(cells.select("shingle", "doc_id", "n").join(shared, "shingle"), "cells")

    def to_leader(links: DataFrame, nodes: DataFrame) -> DataFrame:
        """Links of documents as links of their groups."""
        names = nodes.select("doc_id", "leader")
        a = links.join(names.withColumnsRenamed({"doc_id": "a", "leader": "la"}), "a")
        return a.join(names.withColumnsRenamed({"doc_id": "b", "leader": "lb"}), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()

    placed = cells.join(nodes, "doc_id").withColumn("g", F.col("leader"))
    asked = stored(bounded_queries(placed), "to-leaders")
    leaders = asked.select("g").distinct().select("g", F.col("g").alias("doc_id"))
    links = stored(open_groups(docs, asked, leaders), "leader-links")
    nodes = stored(settled(nodes, to_leader(links, nodes)), "nodes")

    # What is still apart: blocks of bounded size of the groups as they are now.
    blocks = nodes.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("blocks"))
    homes = nodes.join(blocks, "leader").select("doc_id", "leader", F.xxhash64("leader", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))).alias("g"))
    placed = stored(cells.join(homes, "doc_id"), "placed")
    asked = stored(bounded_queries(placed), "to-blocks")
    members = placed.select("g", "doc_id").distinct().join(asked.select("g").distinct(), "g", "left_semi")
    links = stored(open_groups(docs, asked, members), "block-links")
    nodes = stored(settled(nodes, to_leader(links, nodes)), "nodes")

    filled = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col("doc_id").isNotNull()
    rows = grouped.select("doc_id", F.col("n").alias("n_shingles")).unionByName(docs.where(~filled).select("doc_id", F.lit(0).cast("long").alias("n_shingles")))
    labels = nodes.withColumnRenamed("leader", "component_id")
    return rows.join(labels, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every component, with all its columns; null ids stay."""
    kept = similar_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
