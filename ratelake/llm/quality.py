"""Quality classifier with supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, pairs of neighbouring words
(a word followed by itself is one feature of its own) and byte n-grams of three and four.  A softmax
layer over that mean gives the class.  Vectors and output layer are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows.

Because the output layer is linear in the mean, scoring needs one number per feature bucket: the
product of its vector with the difference of the two output rows.  Empty and null texts have no
features and get the score of the bias.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import crc_fold, labelled_texts, small_batches, tidy
from ratelake.llm.words import mix64, text_blocks, text_buffers, words_of

TRAIN_ROWS = 3_000
BUCKETS = 1 << 16
WIDTH = 16
EPOCHS = 6
RATE = 0.5
FOLDS, HELD_FOLD = 5, 0
GRAMS = (3, 4)
_REPEAT = np.uint64(0xA0761D6478BD642F)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, first, stop) per kind of feature: row ``i`` has ``buckets[first[i]:stop[i]]``."""
    mask = np.uint64(BUCKETS - 1)
    block = words_of(data, offsets, lower=False)
    first, stop = block.bounds[:-1], block.bounds[1:]
    yield (block.hashes & mask).astype(np.int64), first, stop
    left, right = block.hashes[:-1], block.hashes[1:]
    pairs = mix64(left * _REPEAT + right)
    pairs = np.where(left == right, _REPEAT, pairs)
    yield (pairs & mask).astype(np.int64), first, np.maximum(first, stop - 1)
    code = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = (code[: len(data) - n + 1] << np.uint64(8)) | data[n - 1 :]
        if n in GRAMS:
            hashed = mix64(code + (np.uint64(n) << np.uint64(40)))
            yield (hashed & mask).astype(np.int64), offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - n + 1)


@dataclass
class QualityModel:
    """``logits``: per bucket, what it adds to the mean log odds of label 1; ``bias``: without features."""

    logits: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_buffers(column)
        out = np.zeros(len(offsets) - 1)
        for first, stop in text_blocks(offsets):
            low = offsets[first]
            part = offsets[first : stop + 1] - low
            total, count = np.zeros(stop - first), np.zeros(stop - first)
            for buckets, begin, end in features(data[low : offsets[stop]], part):
                sums = np.concatenate([[0.0], np.cumsum(self.logits[buckets], dtype=np.float64)])
                begin, end = np.minimum(begin, len(buckets)), np.minimum(end, len(buckets))
                total += sums[end] - sums[begin]
                count += end - begin
            out[first:stop] = total / np.maximum(count, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(out + self.bias, -30, 30)))


def feature_counts(sample: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, buckets, counts) of each sampled row, ordered by id; computed by the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            buckets, counts = [], []
            for i in range(batch.num_rows):
                low, high = offsets[i], offsets[i + 1]
                parts = [b[s[0] : e[0]] for b, s, e in features(data[low:high], np.array([0, high - low]))]
                found, times = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
                buckets.append(found.astype("<u4").tobytes())
                counts.append(times.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(buckets), pa.array(counts)], names=["doc_id", "label", "buckets", "counts"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(tidy(count), "doc_id long, label int, buckets binary, counts binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [(r["label"], np.frombuffer(r["buckets"], "<u4"), np.frombuffer(r["counts"], "<u4")) for r in rows]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent over the sampled documents, one at a time, rate falling to zero."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return QualityModel(np.zeros(BUCKETS, np.float32), 0.0)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1.0 / WIDTH, 1.0 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    output = np.zeros((2, WIDTH), np.float32)
    share = np.mean([r[0] == 1 for r in rows])
    bias = np.log(np.clip([1 - share, share], 1e-3, 1)).astype(np.float32)
    shares = [(c / c.sum()).astype(np.float32) for _, _, c in rows]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            label, buckets, _ = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            picked = vectors[buckets]
            mean = shares[i] @ picked
            z = output @ mean + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[int(label == 1)] -= 1
            step = error @ output
            output -= rate * np.outer(error, mean)
            # Sharing the step by feature alone would hardly move rare ones; lengths up to LEVEL count as one.
            vectors[buckets] = picked - (rate * LEVEL) * shares[i][:, None] * step
    return QualityModel((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


#: Factor on the step of the vectors, which would else be divided by the number of features.
LEVEL = 200.0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    return fit(feature_counts(labelled_texts(docs, labels, "quality", FOLDS, HELD_FOLD, rows)))


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))], names=["doc_id", "score"])

    small_batches(docs)
    scored = docs.select("doc_id", "text").mapInArrow(tidy(score), "doc_id long, score double")
    return scored.select(
        "doc_id",
        (crc_fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
