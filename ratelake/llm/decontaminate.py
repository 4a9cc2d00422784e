"""Benchmark decontamination with spaced-seed hashing.

A seed is a fixed mask over consecutive words, ten at most, that leaves some positions out, so a substituted
word at such a position does not change its hash.  The masks are chosen so that every stretch that the
verification accepts holds one of them whole.  Hashes of the benchmark's seeds are joined with those
of the documents.  Around each hit the document and the item are laid on one diagonal.  A stretch of it is good
as long as its running score stays above zero: equal words count +1, substituted ones -PENALTY.  The most
equal words of any good stretch count; ``MIN_WORDS`` of them (or nearly all words of a shorter item) make the
document contaminated.  Items of SHORT to SPAN - 1 words have a mask of their own length and are found where
all their words are equal.

Documents' hashes are first held against a bit table of fixed size made from the benchmark's, so
that only documents with a possible hit are shuffled; the table may let others through, never drops any.

Words are lower-cased (A-Z).  Null and empty texts match nothing, neither do items of fewer than
``SHORT`` words; rows that repeat a doc_id are verified one by one and reported once; repeated items are found once each; a null doc_id is not judged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import small_batches, stored, tidy
from ratelake.llm.words import Block, mix64, text_buffers, word_blocks, words_of

#: Masks over consecutive words; 1 is compared, 0 left out.  Zeros at the end only fill up to SPAN.
#: No accepted stretch lacks all four: its score stays above zero from its first word on (see the tests).
MASKS = ("1110100110", "1110111000", "1111001010", "1110101100")
SPAN = 10
SHORT = 3
MIN_WORDS = 12
PENALTY = 2
BITS = 23
_SEEDS = "seed long, item_id long, place int, length int"


def seeds(block: Block, lengths: Iterable[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word, hash) of every place of every mask inside one text, then of all runs of each of ``lengths``."""
    rows = block.rows
    masks = [m.rstrip("0") for m in MASKS] + ["1" * n for n in lengths]
    for number, mask in enumerate(masks):
        number = number if number < len(MASKS) else 1000 + len(mask)
        count = len(rows) - len(mask) + 1
        if count <= 0:
            continue
        at = np.flatnonzero(rows[:count] == rows[len(mask) - 1 :])
        total = np.full(count, number + 1, dtype=np.uint64)
        for j, compared in enumerate(mask):
            if compared == "1":
                total = total * np.uint64(0x9E6C63D0876A9A35) + block.hashes[j : j + count]
        yield at, mix64(total[at])


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_id, place, length) of every item's text; ``length`` is 0 but for short items."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in word_blocks(batch.column(1), lower=True):
                rows, words = block.rows, np.diff(block.bounds)
                for number, (at, values) in enumerate(seeds(block, range(SHORT, SPAN))):
                    length = number - len(MASKS) + SHORT if number >= len(MASKS) else 0
                    kept = (words == length if length else words >= SPAN)[rows[at]]
                    at, values = at[kept], values[kept]
                    place = (at - block.bounds[rows[at]]).astype(np.int32)
                    lengths = pa.array(np.full(len(at), length, np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(ids[block.first + rows[at]]), pa.array(place), lengths], names=["seed", "item_id", "place", "length"])

    usable = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    return usable.select("item_id", "text").mapInArrow(tidy(hashed), _SEEDS)


def slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - BITS)).astype(np.int64)


def bit_table(marks: DataFrame) -> np.ndarray:
    """2**BITS packed bits, one set per seed; the driver gets the bytes that are not zero."""
    slot = F.shiftrightunsigned("seed", 64 - BITS)
    rows = marks.select(slot.alias("slot")).distinct().select(F.shiftright("slot", 3).alias("byte"), F.pmod("slot", F.lit(8)).alias("bit"))
    rows = rows.groupBy("byte").agg(F.sum(F.pow(F.lit(2), F.col("bit"))).cast("int").alias("bits")).collect()
    table = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for row in rows:
        table[row["byte"]] = row["bits"]
    return table


def possible_hits(docs: DataFrame, table: np.ndarray, lengths: Sequence[int] = ()) -> DataFrame:
    """doc_id, text, seeds, places of documents with a seed in the bit table."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(1), lower=True):
                rows = block.rows
                found = []
                for at, values in seeds(block, lengths):
                    slot = slots(values)
                    hit = (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                    found.append((at[hit], values[hit]))
                if not found:
                    continue
                at, values = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(at, kind="stable")
                at, values = at[order], values[order]
                hit_rows, cuts = np.unique(rows[at], return_index=True)
                place = (at - block.bounds[rows[at]]).astype(np.int32)
                offsets = pa.array(np.append(cuts, len(at)).astype(np.int32))
                taken = batch.take(pa.array(hit_rows + block.first))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0), taken.column(1).cast(pa.string()), pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(place))],
                    names=["doc_id", "text", "seeds", "places"],
                )

    small_batches(docs)
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return usable.select("doc_id", "text").mapInArrow(tidy(look), "doc_id long, text string, seeds array<long>, places array<int>")


def best_stretch(document: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int]:
    """(most equal words of a good stretch, its first word in the document); document[i + shift] faces item[i].

    A stretch inside a good one has no more equal words, so only those count that begin where the score
    is as low as never before.
    """
    low, high = max(0, -shift), min(len(item), len(document) - shift)
    if low >= high:
        return 0, 0
    equal = document[low + shift : high + shift] == item[low:high]
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
    lowest = np.flatnonzero(score == np.minimum.accumulate(score))
    words = np.diff(np.concatenate([[0], np.cumsum(equal)])[np.append(lowest, len(equal))])
    best = int(words.argmax())
    return int(words[best]), low + shift + int(lowest[best])


def words_needed(item_words: int, min_words: int = MIN_WORDS) -> int:
    """Equal words that make a document contaminated with an item of so many words."""
    if item_words < SPAN:
        return max(item_words, SHORT)
    return min(min_words, max(SPAN - 2, item_words - 2))


def contaminated(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, item_id, matched_words, item_words, first_word: contaminated documents with their items."""
    marks = stored(benchmark_seeds(items), "seeds")
    lengths = sorted(r[0] for r in marks.where("length > 0").select("length").distinct().collect())
    suspects = stored(possible_hits(docs, bit_table(marks), lengths), "suspects")
    # Rows that repeat a doc_id are told apart by their texts.
    suspects = suspects.withColumn("copy", F.xxhash64("text"))
    hits = suspects.select("doc_id", "copy", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select("doc_id", "copy", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
    lines = hits.join(marks, "seed").select("doc_id", "copy", "item_id", (F.col("at") - F.col("place")).alias("shift")).distinct()
    # One row per text and item, with the diagonals they share hits on.
    lines = lines.groupBy("doc_id", "copy", "item_id").agg(F.collect_list("shift").alias("shifts"))
    texts = suspects.select("doc_id", "copy", "text").dropDuplicates(["doc_id", "copy"])
    asked = lines.join(texts, ["doc_id", "copy"]).join(items.select("item_id", F.col("text").alias("item")), "item_id").select("doc_id", "item_id", "shifts", "text", "item")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(5))
            for doc_id, item_id, shifts, text, item in zip(*columns):
                document, passage = hashes_of(text), hashes_of(item)
                words, first = max((best_stretch(document, passage, s) for s in shifts), default=(0, 0))
                if words >= words_needed(len(passage), min_words):
                    out.append((doc_id, item_id, words, len(passage), first))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "item_id", "matched_words", "item_words", "first_word"])

    found = asked.mapInArrow(tidy(verify), "doc_id long, item_id long, matched_words long, item_words long, first_word long")
    best = found.groupBy("doc_id", "item_id", "item_words").agg(F.max(F.struct("matched_words", "first_word")).alias("best"))
    return best.select("doc_id", "item_id", "best.matched_words", "item_words", "best.first_word")


def hashes_of(text: str) -> np.ndarray:
    data, offsets = text_buffers(pa.array([text], pa.large_string()))
    return words_of(data, offsets, lower=True).hashes


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a benchmark passage, columns unchanged."""
    return docs.join(contaminated(docs, items).select("doc_id").distinct(), "doc_id", "left_anti")
