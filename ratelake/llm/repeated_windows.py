"""Removal of repeated passages by super-k-mer partitioning.

Every window of 13 words has a minimiser: the smallest hash among its runs of three words.  Windows
in a row that share a minimiser overlap in all but one word each, so they travel as one packed string
(a super-k-mer) to the bucket of that minimiser.  A bucket sorts its windows, finds the smallest
document of each and answers every other occurrence with the words it covers.

Steps:

1. Inside a map task, chunks of documents are sorted window by window first.  A window that also
   starts in a smaller document of the chunk is decided on the spot; only the smallest document's
   occurrence goes on.  A passage that fills a third of all rows so reaches its bucket once a chunk.
2. The remaining windows are packed, grouped by bucket, compressed and shuffled by bucket.
3. Buckets answer with (doc_id, word ranges); ranges meet the documents in one join on doc_id, and
   the covered words are cut out of the whole text.

Equality of windows is decided on the thirteen 64-bit word hashes beside the hash of the window.
Buckets grow in number with the bytes of text, so a bucket's memory doesn't.  Null texts have no
words; documents under 13 words have no window; rows that repeat a doc_id count as one document.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import small_batches, tidy
from ratelake.llm.words import Block, mix64, text_blocks, text_buffers, window_hashes, words_of

WINDOW = 13
MINIMISER = 3
CHUNK_BYTES = 4_000_000
BUCKET_BYTES = 12_000_000
MIN_BUCKETS = 32
#: Compressed bytes of one bucket that are solved at once.
COMPACT_BYTES = 8_000_000
#: Rows of the bucket shuffle: packed super-k-mers, or ranges already decided that only pass through.
_ROWS = "bucket int, packed binary, doc_ids binary, ranges binary"


def minimisers(block: Block, at: np.ndarray) -> np.ndarray:
    """Minimiser of the windows that begin at words ``at``."""
    count = len(block.hashes) - MINIMISER + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    grams = np.zeros(count, dtype=np.uint64)
    for j in range(MINIMISER):
        grams = grams * np.uint64(0x9FB21C651E98DF25) + block.hashes[j : j + count]
    grams = mix64(grams)
    # Smallest of WINDOW - MINIMISER + 1 neighbours by doubling.
    width, need = 1, WINDOW - MINIMISER + 1
    least = grams
    while width * 2 <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = need - width
    return np.minimum(least[: len(least) - rest], least[rest:])[at] if rest else least[at]


def later_occurrences(hashes: np.ndarray, words: np.ndarray, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For windows (hash, first word, document): is there an equal one in a smaller document.

    ``words`` are all word hashes, with which windows of equal hash are compared word by word.
    """
    order = np.lexsort((at, docs, hashes))
    h, a, d = hashes[order], at[order], docs[order]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = h[1:] == h[:-1]
    both = np.flatnonzero(same)
    for j in range(WINDOW):
        both = both[words[a[both] + j] == words[a[both - 1] + j]]
    same[:] = False
    same[both] = True
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    later = np.zeros(len(h), dtype=bool)
    later[order] = d > d[head]
    return later


def runs(values: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of stretches where ``values`` rise by one and all keys stay."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = values[1:] != values[:-1] + 1
    for key in keys:
        breaks |= key[1:] != key[:-1]
    cut = np.flatnonzero(breaks)
    return np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(values) - 1]])


def covered(docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, [first, stop)) of the words covered by windows, windows of one document in order."""
    first, last = runs(at, docs)
    return docs[first], np.column_stack([at[first], at[last] + WINDOW]).astype("<i4")


def ranges_batch(docs: np.ndarray, ranges: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([None], pa.binary()), pa.array([docs.astype("<i8").tobytes()], pa.binary()), pa.array([ranges.astype("<i4").tobytes()], pa.binary())],
        names=["bucket", "packed", "doc_ids", "ranges"],
    )


def pack_chunk(data: np.ndarray, offsets: np.ndarray, doc_ids: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of a chunk of documents by bucket, and the ranges the chunk decides itself."""
    block = words_of(data, offsets, lower=False)
    at, hashes = window_hashes(block, WINDOW)
    if not len(at):
        return
    rows = block.rows[at]
    docs = doc_ids[rows]
    least = minimisers(block, at)
    later = later_occurrences(hashes, block.hashes, at, docs)
    place = at - block.bounds[rows]
    if later.any():
        # Windows stand in order of rows, hence of words within a document.
        yield spread(*covered(docs[later], place[later]), buckets)
    keep = np.flatnonzero(~later)
    begin, last = runs(at[keep], rows[keep], least[keep])
    begin, last = keep[begin], keep[last]
    bucket = (least[begin] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    low, high = block.starts[at[begin]], block.ends[at[last] + WINDOW - 1]
    names, packed = [], []
    for part in np.split(order, cuts) if len(order) else []:
        i = begin[part]
        names.append(int(bucket[part[0]]))
        packed.append(pack_strings(data, docs[i], place[i], low[part], high[part]))
    none = pa.array([None] * len(names), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packed, pa.binary()), none, none], names=["bucket", "packed", "doc_ids", "ranges"])


def spread(docs: np.ndarray, ranges: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Decided ranges, dealt to buckets by document so that no bucket carries them all."""
    batch = ranges_batch(docs, ranges)
    return batch.set_column(0, "bucket", pa.array([int(docs[0] * 2654435761 % buckets)], pa.int32()))


def solve_bucket(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ranges of a bucket's windows that also start in a smaller document, and what else may be first."""
    heads, bodies = [], []
    for blob in packed:
        (count,) = struct.unpack_from("<I", blob)
        body = zstandard.ZstdDecompressor().decompress(memoryview(blob)[4:])
        heads.append(np.frombuffer(body, "<i8", count * 3).reshape(-1, 3))
        bodies.append(memoryview(body)[count * 24 :])
    head = np.concatenate(heads)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(head[:, 2])])
    parts, words, low, high, base = [], [], [], [], 0
    for first, stop in text_blocks(offsets):
        block = words_of(data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first], lower=False)
        begin, values = window_hashes(block, WINDOW)
        rows = block.rows[begin]
        words.append(block.hashes)
        low.append(block.starts[begin] + offsets[first])
        high.append(block.ends[begin + WINDOW - 1] + offsets[first])
        parts.append((values, begin + base, rows + first, head[first:stop, 1][rows] + begin - block.bounds[rows]))
        base += len(block.hashes)
    hashes, at, rows, place = map(np.concatenate, zip(*parts))
    low, high, docs = np.concatenate(low), np.concatenate(high), head[rows, 0]
    later = later_occurrences(hashes, np.concatenate(words), at, docs)
    keep = np.flatnonzero(~later)
    begin, last = runs(at[keep], rows[keep])
    begin, last = keep[begin], keep[last]
    rest = pack_strings(data, docs[begin], place[begin], low[begin], high[last])
    docs, place = docs[later], place[later]
    order = np.lexsort((place, docs))
    return *covered(docs[order], place[order]), rest


def pack_strings(data: np.ndarray, docs: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    """One blob of strings ``data[low:high]`` with their document and first word."""
    view = memoryview(np.ascontiguousarray(data))
    head = np.column_stack([docs, place, high - low]).astype("<i8")
    body = head.tobytes() + b"".join([view[a:b] for a, b in zip(low.tolist(), high.tolist())])
    return struct.pack("<I", len(head)) + zstandard.ZstdCompressor(level=3).compress(body)


def repeated_ranges(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, ranges): pairs of little-endian 32-bit word numbers [first, stop), unordered."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            for first, stop in text_blocks(offsets, CHUNK_BYTES):
                low = offsets[first]
                yield from pack_chunk(data[low : offsets[stop]], offsets[first : stop + 1] - low, ids[first:stop], buckets)

    def answer(docs_: np.ndarray, ranges: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(docs_):
            yield pa.RecordBatch.from_arrays([pa.array(docs_.astype(np.int64)), pa.array(ranges[:, 0].astype(np.int32)), pa.array(ranges[:, 1].astype(np.int32))], names=["doc_id", "first", "stop"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, packed, size, limit = None, [], 0, COMPACT_BYTES
        for batch in batches:
            for name, blob, ids, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
                if ids.is_valid:
                    yield from answer(np.frombuffer(ids.as_py(), "<i8"), np.frombuffer(ranges.as_py(), "<i4").reshape(-1, 2))
                    continue
                full = name == bucket and size > limit
                if packed and (name != bucket or full):
                    found, places, rest = solve_bucket(packed)
                    yield from answer(found, places)
                    # A hot bucket goes on with the first occurrences only.
                    packed = [rest] if full else []
                    size = len(rest) if full else 0
                    limit = max(COMPACT_BYTES, 2 * size)
                bucket = name
                packed.append(blob.as_py())
                size += len(packed[-1])
        if packed:
            yield from answer(*solve_bucket(packed)[:2])

    small_batches(docs)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    dealt = rows.mapInArrow(tidy(pack), _ROWS).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tidy(solve), "doc_id long, first int, stop int")


def cut_words(text: bytes, ranges: np.ndarray) -> tuple[int, int, list[bytes]]:
    """(words, words removed, words kept) of a text; ``ranges`` may overlap."""
    words = text.split()
    if not len(ranges):
        return len(words), 0, words
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    ranges = np.minimum(ranges, len(words))  # rows that share a doc_id may differ in length
    np.add.at(gone, ranges[:, 0], 1)
    np.add.at(gone, ranges[:, 1], -1)
    kept = np.cumsum(gone[:-1]) == 0
    return len(words), int(len(words) - kept.sum()), [w for w, k in zip(words, kept.tolist()) if k]


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the bytes of text at hand (a super-k-mer repeats each word about three times)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(MIN_BUCKETS, math.ceil(3 * size / BUCKET_BYTES))


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row of ``docs``."""
    ranges = repeated_ranges(docs, bucket_count(docs))
    per_doc = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("first", "stop")).alias("ranges"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = rows.join(per_doc.hint("merge"), "doc_id", "left").select("doc_id", "text", "ranges.first", "ranges.stop")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, first, stop in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                ranges = np.column_stack([first, stop]) if first else np.zeros((0, 2), np.int64)
                total, removed, kept = cut_words(text.as_buffer().to_pybytes(), ranges)
                kept = b" ".join(kept)
                out.append((total, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    out = joined.mapInArrow(tidy(cut), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out if with_text else out.drop("kept_text")
