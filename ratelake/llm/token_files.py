"""Token-id output: one concatenated id array with Elias-Fano document boundaries.

Documents are range-partitioned by doc_id; each task encodes its documents in order and cuts them
into segments of bounded size.  A segment is one binary blob::

    b"RLTOKEN1" | bytes per id u8 | documents without id u64 | smallest doc_id i64 | doc_ids less the
    smallest (Elias-Fano) | ends of the documents (Elias-Fano) | token ids, 2 or 4 bytes little-endian

Segments are written through Spark's own Parquet writer (one row per segment), so that they reach any
store Spark reaches and a lost task leaves nothing behind.  Each row also has the segment's place
(``part``, ``segment``) and its counts, from which readers get global starts without opening blobs.

Null texts count as empty (the end id alone); documents without id come first; repeated ids keep
one entry per row, in the order of a hash of their texts; an empty table gives no segment.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ratelake.llm import elias_fano
from ratelake.llm.shared import kept_for_stage, small_batches, tidy
from ratelake.llm.words import span_hashes, text_blocks
from ratelake.session import scratch_path

MAGIC = b"RLTOKEN1"
SEGMENT_IDS = 1 << 20
#: Memory of one worker for pieces and their ids.
CACHE_BYTES = 96 << 20
END_ID = 0
_SPACE_RUN = re.compile(r" \s")
#: Fixed value: how a byte-level vocabulary writes the space.
_SPACE_IN_VOCABULARY = "\u0120"

SEGMENTS = StructType(
    [
        StructField("part", IntegerType()),
        StructField("segment", IntegerType()),
        StructField("documents", LongType()),
        StructField("ids", LongType()),
        StructField("blob", BinaryType()),
    ]
)


def gather(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges that begin at ``offsets``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets - (ends - lengths), lengths)


class PieceTable:
    """Ids of pieces by the 64-bit hash of the piece; bounded in bytes.

    Sorted hashes with the place of each piece's ids in one pool: 14 bytes a piece and its ids.
    """

    def __init__(self, dtype: np.dtype, most_bytes: int):
        self._most = most_bytes
        self._hashes = np.zeros(0, np.uint64)
        self._offsets, self._lengths = np.zeros(0, np.uint32), np.zeros(0, np.uint16)
        self._pool, self._used = np.zeros(1 << 16, dtype), 0

    @property
    def bytes(self) -> int:
        return 14 * len(self._hashes) + self._used * self._pool.itemsize

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each is known, row of those that are)."""
        if not len(self._hashes):
            return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
        rows = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        known = self._hashes[rows] == hashes
        return known, rows[known]

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids in a row)."""
        lengths = self._lengths[rows].astype(np.int64)
        return lengths, self._pool[gather(self._offsets[rows].astype(np.int64), lengths)]

    def add(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Remember sorted new ``hashes``, as far as there is room."""
        sizes = 14 + lengths * self._pool.itemsize
        count = int(np.searchsorted(np.cumsum(sizes), self._most - self.bytes, side="right"))
        if count == 0 or lengths.max() >= 1 << 16:
            return
        hashes, lengths = hashes[:count], lengths[:count]
        ids = ids[: int(lengths.sum())]
        if self._used + len(ids) > len(self._pool):
            self._pool = np.concatenate([self._pool[: self._used], np.zeros(len(ids) + self._used // 2 + 1, self._pool.dtype)])
        self._pool[self._used : self._used + len(ids)] = ids
        at = np.searchsorted(self._hashes, hashes)
        offsets = self._used + np.cumsum(lengths) - lengths
        self._hashes = np.insert(self._hashes, at, hashes)
        self._offsets = np.insert(self._offsets, at, offsets.astype(np.uint32))
        self._lengths = np.insert(self._lengths, at, lengths.astype(np.uint16))
        self._used += len(ids)


class PieceEncoder:
    """Whole texts to ids; pieces between single spaces are encoded once and remembered by hash.

    A byte-level BPE splits a text before every space that stands between characters other than
    white space, so the ids of such a text are those of its pieces, each with the space before it, in a row.
    For the same reason new pieces are encoded in one go; their ids are cut where a token begins with a space.
    Texts with other white space after a space, or with an added token such as <|endoftext|>, are
    handed to the tokenizer whole.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab()
        self._dtype = np.dtype(np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token[0] == _SPACE_IN_VOCABULARY]] = True
        self._table = PieceTable(self._dtype, cache_bytes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian u32 ids of each text."""
        whole = [bool(_SPACE_RUN.search(t)) or any(a in t for a in self._added) for t in texts]
        rest = iter(self._whole([t for t, w in zip(texts, whole) if w]))
        parts = iter(self._pieces([t.encode() for t, w in zip(texts, whole) if not w]))
        return [next(rest).astype("<u4").tobytes() if w else next(parts) for w in whole]

    def _pieces(self, texts: list[bytes]) -> Iterator[bytes]:
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        for first, stop in text_blocks(offsets):
            data = np.frombuffer(b"".join(texts[first:stop]), np.uint8)
            bounds = offsets[first : stop + 1] - offsets[first]
            starts = np.unique(np.concatenate([np.flatnonzero(data == 0x20), bounds[:-1][bounds[:-1] < bounds[1:]]]))
            lengths, ids = self._known(data, starts)
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, bounds)]
            view = memoryview(ids.astype("<u4").tobytes())
            for low, high in zip(ends.tolist(), ends[1:].tolist()):
                yield bytes(view[4 * low : 4 * high])

    def _known(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids in a row)."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, self._dtype)
        hashes, first, place = np.unique(span_hashes(data, starts), return_index=True, return_inverse=True)
        known, rows = self._table.find(hashes)
        ends, text = np.append(starts[1:], len(data)), data.tobytes()
        fresh = [text[starts[i] : ends[i]].decode() for i in first[~known].tolist()]
        encoded = self._new(fresh)
        lengths = np.zeros(len(hashes), np.int64)
        lengths[known], old = self._table.ids(rows)
        lengths[~known] = [len(e) for e in encoded]
        new = np.concatenate(encoded).astype(self._dtype) if encoded else np.zeros(0, self._dtype)
        # Where the ids of each distinct piece are: those known first, then the new ones.
        offsets = np.zeros(len(hashes), np.int64)
        offsets[known] = np.cumsum(lengths[known]) - lengths[known]
        offsets[~known] = len(old) + np.cumsum(lengths[~known]) - lengths[~known]
        if encoded:
            self._table.add(hashes[~known], lengths[~known], new)
        each = lengths[place]
        return each, np.concatenate([old, new])[gather(offsets[place], each)]

    def _new(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece; those that begin with a space are encoded as one text."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        spaced = [i for i, p in enumerate(pieces) if p[0] == " " and len(p) > 1]
        for at in range(0, len(spaced), 4096):
            lot = spaced[at : at + 4096]
            ids = self._whole(["".join(pieces[i] for i in lot)])[0]
            cuts = np.flatnonzero(self._spaced[ids])
            if len(cuts) == len(lot):
                for i, part in zip(lot, np.split(ids, cuts[1:])):
                    out[i] = part
        left = [i for i, o in enumerate(out) if o is None]
        for i, ids in zip(left, self._whole([pieces[i] for i in left])):
            out[i] = ids
        return out

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), 4096):
            encoded = self._tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in encoded]
        return out


def pack(doc_ids: list[int | None], texts: list[bytes]) -> bytes:
    """One segment; ``texts`` are the documents' ids with their end ids, ``doc_ids`` in order, nulls first."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(t) // 4 for t in texts], dtype=np.int64)
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return b"".join(
        [
            MAGIC,
            struct.pack("<BQq", width, len(doc_ids) - len(known), least),
            elias_fano.encode((known - least).astype(np.uint64)),
            elias_fano.encode(ends),
            ids.astype(f"<u{width}").tobytes(),
        ]
    )


class Segment:
    """A read segment: random access by document number."""

    def __init__(self, blob: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a token segment")
        width, self.nulls, self._least = struct.unpack_from("<BQq", blob, 8)
        self._doc_ids = elias_fano.EliasFano(blob, 8 + struct.calcsize("<BQq"))
        self.ends = elias_fano.EliasFano(blob, self._doc_ids.end)
        self._ids = np.frombuffer(blob, f"<u{width}", offset=self.ends.end)

    def __len__(self) -> int:
        return len(self.ends)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self._doc_ids.select_many(np.arange(len(self._doc_ids))) + self._least).tolist()

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self._ids[start:end].astype("<u4")

    def entries(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, start in the segment, length and crc32 of each document."""
        view, start = memoryview(self._ids.astype("<u4").tobytes()), 0
        for doc_id, end in zip(self.doc_ids(), self.ends.select_many(np.arange(len(self))).tolist()):
            yield doc_id, start, end - start, zlib.crc32(view[4 * start : 4 * end])
            start = end


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes every whole text and writes the segments below ``path``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_for_stage(f"pieces of {tokenizer}", lambda: PieceEncoder(tokenizer))
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, texts, size = [], [], 0

        def cut() -> pa.RecordBatch:
            nonlocal doc_ids, texts, size, number
            row = {"part": part, "segment": number, "documents": len(doc_ids), "ids": size, "blob": pack(doc_ids, texts)}
            doc_ids, texts, size, number = [], [], 0, number + 1
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                encoded = encoder.encode([t or "" for t in rows.column(1).to_pylist()])
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoded):
                    doc_ids.append(doc_id)
                    texts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= segment_ids:
                        yield cut()
        if doc_ids:
            yield cut()

    small_batches(docs)
    # Rows of one id, or of none, in the order of their texts' hash: a mass of them is dealt to many tasks.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    ordered.mapInArrow(tidy(segments), SEGMENTS).write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64()), ("blob", pa.binary())])


def read_tokens(segments: DataFrame) -> DataFrame:
    """doc_id, start (over all segments), n_tokens and ids_crc32 of every document, from the blobs."""
    at = Window.orderBy("part")
    within = Window.partitionBy("part").orderBy("segment")
    # Prefix sums in two levels: over a part's segments, then over the parts' totals.
    parts = segments.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    parts = parts.withColumn("part_start", F.sum("part_ids").over(at) - F.col("part_ids")).select("part", "part_start")
    starts = segments.select("part", "segment", "ids").withColumn("inner_start", F.sum("ids").over(within) - F.col("ids"))
    starts = starts.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inner_start")).alias("start"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                rows = list(Segment(blob.as_py()).entries())
                places = [(part, segment)] * len(rows)
                columns = [*zip(*places), *zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRIES)], schema=_ENTRIES)

    read = segments.select("part", "segment", "blob").mapInArrow(tidy(entries), "part int, segment int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "segment"]).select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


_ENTRIES = pa.schema([("part", pa.int32()), ("segment", pa.int32()), *((n, pa.int64()) for n in ("doc_id", "inner", "n_tokens", "ids_crc32"))])


def token_index(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes the segments (to the shared folder unless ``path`` is given) and reads them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(spark.read.schema(SEGMENTS).parquet(path))


def default_tokenizer() -> str:
    """Path of the byte-level BPE file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
