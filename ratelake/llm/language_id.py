"""Language identification by string kernels.

The kernel is a blended spectrum of byte n-grams (one to three, ASCII lower-cased): the number of
n-grams of a fixed vocabulary present in both texts, divided by the geometric mean of the numbers
present in each.  Landmarks chosen per language give Nystroem features; one ridge regression per
language (against the rest) is solved on them.  A batch is scored by two matrix products:
presence x landmarks, then kernel values x weights.

Texts that are null or without a letter are ``und`` with score 0.  Training rows are a bounded sample
per language; with no training row at all every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import crc_fold, sample_per_group, small_batches, tidy
from ratelake.llm.words import text_blocks, text_buffers

ROWS_PER_LANGUAGE = 400
TRAIN_ROWS = 4_000
LANDMARKS = 160
VOCABULARY = 6_000
ORDERS = (1, 2, 3)
RIDGE = 1e-2
SHARPNESS = 6.0
FOLDS, HELD_FOLD = 3, 1
UNKNOWN = "und"


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.int32)
    table[65:91] += 32
    return table


def gram_codes(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, code of the n-gram at each byte); codes of different n never meet."""
    lowered = _lower_table()[data]
    code = np.zeros(len(data), dtype=np.int32)
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            return
        code = (code[: len(data) - n + 1] << 8) | lowered[n - 1 :]
        if n in ORDERS:
            yield n, code


@dataclass
class LanguageModel:
    vocabulary: dict[int, np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray
    names: list[str]

    @property
    def size(self) -> int:
        return sum(map(len, self.vocabulary.values()))

    def tables(self) -> dict[int, np.ndarray]:
        """Column of each code, per n; the last column takes what is outside the vocabulary."""
        out, at = {}, 0
        for n, codes in self.vocabulary.items():
            out[n] = np.full(1 << (8 * n), self.size, dtype=np.int16)
            out[n][codes] = np.arange(at, at + len(codes))
            at += len(codes)
        return out

    def kernel(self, data: np.ndarray, offsets: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
        return presence(data, offsets, tables, self.size) @ self.landmarks

    def decide(self, column: pa.Array, tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of each row."""
        data, offsets = text_buffers(column)
        best, score = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
        for first, stop in text_blocks(offsets, 1_000_000):
            for low in range(first, stop, 512):
                high = min(low + 512, stop)
                base = offsets[low]
                values = self.kernel(data[base : offsets[high]], offsets[low : high + 1] - base, tables) @ self.weights
                best[low:high] = values.argmax(axis=1)
                e = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
                score[low:high] = 1.0 / e.sum(axis=1)
        return best, score


def presence(data: np.ndarray, offsets: np.ndarray, tables: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Rows of 0 and 1 over the vocabulary, divided by the root of their sums."""
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out = np.zeros((len(lengths), size + 1), dtype=np.float32)
    stops = offsets[1:][rows]
    for n, code in gram_codes(data):
        column = tables[n][code]
        column[np.arange(len(code)) + n > stops[: len(code)]] = size
        out[rows[: len(code)], column] = 1
    out = out[:, :size]
    return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


def training_rows(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, lang): bounded per language and in all, outside the held-out fold."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold("doc_id", FOLDS) != HELD_FOLD))
    chosen = sample_per_group(usable.select("doc_id", "lang"), "lang", "doc_id", per_language)
    chosen = chosen.orderBy("rank", "lang").limit(rows).select("doc_id", F.col("lang").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame) -> LanguageModel:
    rows = sorted(training_rows(docs).collect(), key=lambda r: (r["label"], r["doc_id"]))
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def fit(texts: list[str], labels: list[str]) -> LanguageModel:
    names = sorted(set(labels))
    if not names:
        return LanguageModel({}, np.zeros((0, 1), np.float32), np.zeros((1, 1), np.float32), [])
    counts = {n: np.zeros(1 << (8 * n), dtype=np.uint16) for n in ORDERS}
    for text in texts:
        for n, code in gram_codes(np.frombuffer(text.encode(), np.uint8)):
            counts[n][np.unique(code)] += 1
    # The n-grams found in most of the texts; ties go to the shorter and smaller code.
    order, codes = np.concatenate([[n] * len(np.flatnonzero(c)) for n, c in counts.items()]), np.concatenate([np.flatnonzero(c) for c in counts.values()])
    top = np.argsort(-np.concatenate([c[c > 0] for c in counts.values()]).astype(np.int64), kind="stable")[:VOCABULARY]
    vocabulary = {n: np.sort(codes[top][order[top] == n]) for n in ORDERS}
    model = LanguageModel(vocabulary, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), names)
    tables = model.tables()
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    x = np.concatenate([presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], tables, model.size) for a, b in text_blocks(offsets, 1_000_000)])
    y = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    each = max(1, LANDMARKS // len(names))
    chosen = np.concatenate([np.flatnonzero(np.array(labels) == name)[:each] for name in names])
    model.landmarks = np.ascontiguousarray(x[chosen].T)
    # Nystroem: features K_nm K_mm^(-1/2), then ridge regression against -1 and 1.
    values, basis = np.linalg.eigh((x[chosen] @ x[chosen].T).astype(np.float64))
    root = basis / np.sqrt(np.maximum(values, 1e-6))
    phi = (x @ model.landmarks).astype(np.float64) @ root
    balance = (1.0 / np.array([labels.count(k) for k in labels]))[:, None] * len(labels) / len(names)
    solved = np.linalg.solve(phi.T @ (phi * balance) + RIDGE * np.eye(phi.shape[1]), phi.T @ (y * balance))
    model.weights = (root @ solved).astype(np.float32)
    return model


def languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model.names else {}
        for batch in batches:
            if model.names:
                best, score = model.decide(batch.column(1), tables)
                found = pa.array([model.names[i] for i in best], pa.string())
            else:
                found, score = pa.array([UNKNOWN] * batch.num_rows, pa.string()), np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found, pa.array(score)], names=["doc_id", "lettered", "found", "value"])

    small_batches(docs)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    decided = docs.select("doc_id", "text", lettered.alias("lettered")).mapInArrow(tidy(decide), "doc_id long, lettered boolean, found string, value double")
    return decided.select(
        "doc_id",
        (crc_fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"),
        F.when(F.col("lettered"), F.col("found")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("value")).otherwise(0.0).alias("score"),
    )
