"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters to Latin ones, undoes digit and sign substitutions,
and turns what is left of non-letters into single spaces, so every word begins after a space.

The lexicon is learned from a bounded sample of labelled rows: whole words and word beginnings
that stand in toxic documents far more often than in others, weighted by their log odds.  Of two
patterns that say the same, the shorter is kept.  Two-word phrases around a pattern that are mostly
found in harmless documents become exception phrases: a match inside one does not count.

A document's score is a logistic function of its matched weight, normalised by length as
``weight / (1 + words / LENGTH_SCALE)`` beside the strongest single match, fitted on the same
sample.  A null or empty text matches nothing and gets the score of no evidence.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratelake.llm.shared import crc_fold, labelled_texts, small_batches, tidy

TRAIN_ROWS = 12_000
MIN_PREFIX, MAX_PREFIX = 4, 9
MIN_DOCUMENTS = 3
MIN_LOG_ODDS = 1.5
MIN_SUPPORT = 9.0
MAX_PATTERNS = 20_000
LENGTH_SCALE = 200.0
FOLDS, HELD_FOLD = 5, 0

#: Letters of other alphabets that look like Latin ones, and usual substitutions.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


class _Folds(dict):
    """Character table for str.translate, filled as characters appear."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if unicodedata.category(ch) in ("Cf", "Mn"):
            out = ""  # zero-width signs and loose accents
        else:
            out = "".join(c for c in unicodedata.normalize("NFKD", ch.lower()) if not unicodedata.combining(c))
            out = "".join(LOOK_ALIKES.get(c, c) for c in out)
            out = out if out.isalpha() else SUBSTITUTIONS.get(ch, " ")
        self[code] = out
        return out


_FOLDS = _Folds()


def fold(text: str) -> str:
    """Folded words, each after one space, with a space at the end.

    Signs and digits stand for letters only inside a word that has a letter; at its ends signs go.
    """
    words = []
    for word in text.split():
        if word.isalpha():
            words.append(word.translate(_FOLDS))
            continue
        word = word.strip("!$.,;:?*&%#|\"'()[]{}<>-_")
        if any(map(str.isalpha, word)):
            words.extend(word.translate(_FOLDS).split())
    return " " + " ".join(words) + " "


@dataclass
class Lexicon:
    """``patterns``: folded text beginning with a space -> weight; ``exceptions``: folded phrases."""

    patterns: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), None))
        for pattern, weight in self.patterns.items():
            out.add_word(pattern, (len(pattern), weight))
        if len(out):
            out.make_automaton()
        return out

    def evidence(self, automaton, text: str | None) -> tuple[float, float]:
        """(matched weight normalised by length, strongest match) of a text."""
        if not text or not len(automaton):
            return 0.0, 0.0
        folded = fold(text)
        hits, spared = [], []
        for end, (size, weight) in automaton.iter(folded):
            (spared if weight is None else hits).append((end - size + 1, end, weight))
        if spared:
            hits = [h for h in hits if not any(s <= h[0] and h[1] <= e for s, e, _ in spared)]
        # Patterns that begin at one word count once, by the heaviest.
        best: dict[int, float] = {}
        for start, _, weight in hits:
            best[start] = max(weight, best.get(start, 0.0))
        total = sum(best.values())
        words = folded.count(" ") - 1
        return total / (1.0 + words / LENGTH_SCALE), max(best.values(), default=0.0)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        bias, a, b = self.coefficients
        return 1.0 / (1.0 + np.exp(-np.clip(bias + a * np.log1p(evidence[:, 0]) + b * evidence[:, 1], -30, 30)))


def document_terms(text: str) -> set[str]:
    """Patterns a document offers: its words and their beginnings, each after a space."""
    out = set()
    for word in set(fold(text).split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in range(MIN_PREFIX, min(MAX_PREFIX, len(word)) + 1))
    return out


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """A lexicon from (doc_id, text, label); counts are taken by Spark, the driver sees patterns only."""
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), sum(n for k, n in totals.items() if k != 1)
    if not toxic or not clean:
        return Lexicon({})

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for text, label in zip(texts, labels):
                found = sorted(document_terms(text))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([label] * len(found), pa.int32())], names=["term", "label"])

    counts = (
        sample.select("text", "label")
        .mapInArrow(tidy(terms), "term string, label int")
        .groupBy("term")
        .agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("good"))
    )
    # Log likelihood gained by a rate of its own for the documents that have the term: keeps chance finds out.
    rate, n = toxic / (toxic + clean), F.col("bad") + F.col("good")
    support = F.col("bad") * F.log(F.col("bad") / (n * rate)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (n * (1 - rate)))).otherwise(0.0)
    odds = F.log((F.col("bad") + 0.1) / (toxic + 1.0)) - F.log((F.col("good") + 0.1) / (clean + 1.0))
    chosen = (
        counts.where(F.col("bad") >= MIN_DOCUMENTS)
        .withColumn("weight", odds)
        .where((F.col("weight") >= MIN_LOG_ODDS) & (support >= MIN_SUPPORT))
        .orderBy(F.col("bad").desc(), "term")
        .limit(MAX_PATTERNS)
        .collect()
    )
    by_term = {r["term"]: r for r in chosen}
    # A beginning that one longer pattern accounts for gives way to it, so a word stays a whole word.
    lone = set()
    for term, row in by_term.items():
        for n in range(MIN_PREFIX + 1, len(term)):
            short = by_term.get(term[:n])
            if short is not None and row["bad"] >= 0.95 * short["bad"]:
                lone.add(term[:n])
    patterns = {}
    for term, row in by_term.items():
        shorter = (by_term.get(term[:n]) for n in range(MIN_PREFIX + 1, len(term)) if term[:n] not in lone)
        if term not in lone and not any(s is not None and s["weight"] >= row["weight"] - 0.7 for s in shorter):
            patterns[term] = float(row["weight"])
    return Lexicon(patterns)


def learn_exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around a matched word that are harmless in most documents that have them."""
    if not lexicon.patterns:
        return []

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded, found = fold(text), set()
                for end, (size, _) in automaton.iter(folded):
                    start = end - size + 1
                    stop = folded.find(" ", start + 1)
                    if (after := folded.find(" ", stop + 1)) > 0:
                        found.add(folded[start : after + 1])
                    if start > 0:
                        found.add(folded[folded.rfind(" ", 0, start) : stop + 1])
                rows += [(p, label) for p in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["phrase", "label"])

    found = (
        sample.select("text", "label")
        .mapInArrow(tidy(phrases), "phrase string, label int")
        .groupBy("phrase")
        .agg(F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("good"), F.count("*").alias("n"))
        .where((F.col("good") >= MIN_DOCUMENTS) & (F.col("good") >= 0.8 * F.col("n")))
        .orderBy(F.col("good").desc(), "phrase")
        .limit(MAX_PATTERNS)
    )
    return [r["phrase"] for r in found.collect()]


def fit_scores(evidence: np.ndarray, labels: np.ndarray, steps: int = 600) -> tuple[float, float, float]:
    """Logistic regression on (log evidence, strongest match), by gradient descent with momentum."""
    x = np.column_stack([np.ones(len(labels)), np.log1p(evidence[:, 0]), evidence[:, 1]])
    scale = np.maximum(np.abs(x).max(axis=0), 1.0)
    x, w, v = x / scale, np.zeros(3), np.zeros(3)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) / max(len(labels), 1) + 1e-4 * w
        v = 0.9 * v - 2.0 * gradient
        w = w + v
    return tuple((w / scale).tolist())


def evidence_of(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``__evidence`` and ``__strongest`` of each row's whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            pairs = [lexicon.evidence(automaton, t) for t in batch.column(0).to_pylist()]
            values = np.array(pairs, dtype=float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values[:, 0]), pa.array(values[:, 1])], names=[*keep, "__evidence", "__strongest"])

    small_batches(docs)
    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields, StructField("__evidence", DoubleType()), StructField("__strongest", DoubleType())])
    return docs.select(F.col("text").alias("__body"), *keep).mapInArrow(tidy(measure), schema)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon:
    small_batches(docs)
    sample = labelled_texts(docs, labels, "toxic", FOLDS, HELD_FOLD, rows)
    lexicon = learn_lexicon(sample)
    lexicon.exceptions = learn_exceptions(sample, lexicon)
    fitted = evidence_of(sample, lexicon, ["label"]).toPandas()
    if lexicon.patterns and len(fitted):
        lexicon.coefficients = fit_scores(fitted[["__evidence", "__strongest"]].to_numpy(float), (fitted["label"] == 1).to_numpy(float))
    return lexicon


def toxicity_scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    bias, a, b = lexicon.coefficients
    z = F.lit(bias) + a * F.log1p("__evidence") + b * F.col("__strongest")
    score = 1.0 / (1.0 + F.exp(-z))
    return (
        evidence_of(docs, lexicon, ["doc_id"])
        .select("doc_id", (crc_fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), score.alias("score"))
        .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
    )


def keep_clean(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged."""
    bias, a, b = lexicon.coefficients
    kept = evidence_of(docs, lexicon, docs.columns)
    return kept.where(F.lit(bias) + a * F.log1p("__evidence") + b * F.col("__strongest") < 0).select(*docs.columns)
