"""Mixing to target weights with soft domain membership.

A classifier learned from a labelled table gives every document a posterior over domains.  Each
document gets a rate, the expected number of its copies, so that the expected tokens of every domain
(sum over documents of rate * tokens * posterior) match the targets.  Rates solve a least-squares
problem with a lower bound (zero unless asked otherwise) and a small pull towards one, by accelerated
projected gradient steps.

A step needs one number per domain from all documents.  A document's rate follows from its posterior
and the short list of past domain gradients, so every pass replays that list for its rows in numpy and
adds up; rates are neither stored between passes nor collected.

Null texts have no tokens; they and documents without n-grams get the prior as posterior.  Domains in the
labelled table without a target keep their share; targets of unknown domains are left out, the rest
is scaled to one.  Without any labelled row all rates are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ratelake.llm.shared import sample_per_group, small_batches, stored, tidy
from ratelake.llm.words import mix64, text_blocks, text_buffers, words_of

ROWS_PER_DOMAIN = 500
TRAIN_ROWS = 8_000
BUCKETS = 1 << 14
GRAM = 3
#: Passes in a row that change no total by more than a twentieth of the tolerance end the descent.
STILL = 3
TOLERANCE = 1e-3
PULL = 1e-3


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, first, stop): hashed byte n-grams; row ``i`` has ``buckets[first[i]:stop[i]]``."""
    if len(data) < GRAM:
        none = np.zeros(len(offsets) - 1, np.int64)
        return np.zeros(0, np.int64), none, none
    code = np.zeros(len(data) - GRAM + 1, dtype=np.uint64)
    for j in range(GRAM):
        code = (code << np.uint64(8)) | data[j : len(data) - GRAM + 1 + j]
    stop = np.maximum(offsets[:-1], offsets[1:] - GRAM + 1)
    return (mix64(code) & np.uint64(BUCKETS - 1)).astype(np.int64), np.minimum(offsets[:-1], len(code)), np.minimum(stop, len(code))


@dataclass
class DomainModel:
    """Naive Bayes over n-gram shares: log posterior = prior + sharpness * mean log probability."""

    names: list[str]
    prior: np.ndarray
    logs: np.ndarray
    sharpness: float = 1.0

    def means(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(self.names)))
        for first, stop in text_blocks(offsets):
            low = offsets[first]
            buckets, begin, end = gram_buckets(data[low : offsets[stop]], offsets[first : stop + 1] - low)
            for k in range(len(self.names)):
                sums = np.concatenate([[0.0], np.cumsum(self.logs[k][buckets])])
                out[first:stop, k] = (sums[end] - sums[begin]) / np.maximum(end - begin, 1)
        return out

    def posterior(self, means: np.ndarray) -> np.ndarray:
        z = np.log(self.prior) + self.sharpness * means
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(docs: DataFrame, labelled: DataFrame) -> DomainModel:
    """From ``labelled`` (doc_id, domain); at most ROWS_PER_DOMAIN texts of a domain, TRAIN_ROWS in all."""
    chosen = labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "domain").distinct()
    chosen = sample_per_group(chosen, "domain", "doc_id", ROWS_PER_DOMAIN)
    chosen = chosen.orderBy("rank", "domain").limit(TRAIN_ROWS).select("doc_id", "domain")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull()).dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: (r["domain"], r["doc_id"]))
    names = sorted({r["domain"] for r in rows})
    if not names:
        return DomainModel([], np.zeros(0), np.zeros((0, BUCKETS)))
    counts = np.full((len(names), BUCKETS), 0.1)
    data, offsets = text_buffers(pa.array([r["text"] for r in rows], pa.large_string()))
    label = np.array([names.index(r["domain"]) for r in rows])
    for i, k in enumerate(label):
        buckets, first, stop = gram_buckets(data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i])
        counts[k] += np.bincount(buckets[first[0] : stop[0]], minlength=BUCKETS)
    shares = np.bincount(label, minlength=len(names)) / len(label)
    model = DomainModel(names, np.maximum(shares, 1e-6), np.log(counts / counts.sum(axis=1, keepdims=True)))
    means = model.means(data, offsets)
    # How far a mean log probability should be trusted: the likeliest of a few values.
    fits = []
    for sharpness in (1, 2, 5, 10, 20, 50, 100, 200):
        model.sharpness = float(sharpness)
        fits.append((np.log(np.maximum(model.posterior(means)[np.arange(len(label)), label], 1e-9)).mean(), sharpness))
    model.sharpness = float(max(fits)[1])
    return model


def memberships(docs: DataFrame, model: DomainModel, keep: list[str]) -> DataFrame:
    """``keep`` columns with __tokens and __p0, __p1, ... of every row."""
    names = [f"__p{k}" for k in range(len(model.names))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            tokens = [np.diff(words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], False).bounds) for a, b in text_blocks(offsets)]
            tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            p = model.posterior(model.means(data, offsets)) if model.names else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(tokens.astype(np.int64)), *(pa.array(p[:, k]) for k in range(p.shape[1]))], names=[*keep, "__tokens", *names])

    small_batches(docs)
    schema = StructType([*docs.select(*keep).schema.fields, StructField("__tokens", LongType()), *(StructField(n, DoubleType()) for n in names)])
    return docs.select(F.col("text").alias("__body"), *keep).mapInArrow(tidy(measure), schema)


@dataclass
class Descent:
    """The accelerated projected gradient method as a list of steps (gradient per domain, momentum)."""

    floor: float
    step: float
    steps: list[tuple[np.ndarray, float]]
    #: Tokens by domain, in parts of all present ones: wanted, and reached by the rates.
    goal: np.ndarray | None = None
    reached: np.ndarray | None = None

    @property
    def gap(self) -> float:
        """Largest distance of a domain from its goal, in parts of the largest goal."""
        return 0.0 if self.goal is None else float(np.abs(self.reached - self.goal).max() / self.goal.max())

    def rates(self, p: np.ndarray) -> np.ndarray:
        rate = at = np.full(len(p), max(1.0, self.floor))
        for gradient, momentum in self.steps:
            fresh = np.maximum(self.floor, at - self.step * (p @ gradient + PULL * (at - 1.0)))
            at = fresh + momentum * (fresh - rate)
            rate = fresh
        return rate


def fit_rates(members: DataFrame, model: DomainModel, targets: dict[str, float], floor: float = 0.0, grow: bool = False) -> Descent:
    """Steps whose rates bring the domains' expected tokens to ``targets``.

    The total stays what it is; with ``grow`` it becomes the smallest total at which no domain needs
    a rate under the floor.
    """
    k = len(model.names)
    columns = ["__tokens", *(f"__p{i}" for i in range(k))]
    if not k:
        return Descent(floor, 0.0, [])

    def sums(of) -> np.ndarray:
        """Sum over all rows of what ``of`` gives for (tokens, posteriors)."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]).reshape(-1, k + 1)
                part = of(x[:, 0], x[:, 1:])
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["s"])

        parts = members.select(*columns).mapInArrow(tidy(add), "s array<double>").select(F.posexplode("s").alias("i", "s"))
        rows = parts.groupBy("i").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(max((r["i"] for r in rows), default=-1) + 1)
        for r in rows:
            out[r["i"]] = r["s"]
        return out

    first = sums(lambda w, p: np.concatenate([w @ p, ((p * w[:, None]).T @ p).ravel()]))
    total = first[:k].sum() if len(first) else 0.0
    if not total:
        return Descent(floor, 0.0, [])
    mass, square = first[:k] / total, first[k:].reshape(k, k) / total
    goal = aims(model.names, mass, targets)
    if grow:
        goal = goal * max(1.0, float(np.max(mass * max(floor, 1.0) / np.maximum(goal, 1e-9))))
    weight = 1.0 / np.maximum(mass, 1e-6)
    half = np.sqrt(weight)
    step = 1.0 / (float(np.linalg.eigvalsh(half[:, None] * square * half[None, :]).max()) + PULL)
    descent = Descent(floor, step, [], goal, mass * max(1.0, floor))
    at, t, still = descent.reached, 1.0, 0
    # To the goal, or to where no step changes the totals any more: the least squares' optimum over these rates.
    while descent.gap > TOLERANCE and still < STILL:
        gradient = weight * (at - goal)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, t = (t - 1) / faster, faster
        descent.steps.append((gradient, float(momentum)))
        before, descent.reached = descent.reached, sums(lambda w, p: (w * descent.rates(p)) @ p) / total
        change = descent.reached - before
        at = descent.reached + momentum * change
        still = still + 1 if np.abs(change).max() <= TOLERANCE / 20 * goal.max() else 0
        if (weight * (at - goal)) @ change > 0:
            t = 1.0  # past the optimum: momentum starts anew
    return descent


def aims(names: list[str], mass: np.ndarray, targets: dict[str, float]) -> np.ndarray:
    """Shares to reach: targets scaled to what the domains without a target leave over."""
    wanted = np.array([targets.get(n, np.nan) for n in names], dtype=float)
    free = np.isnan(wanted)
    if free.all() or not np.nansum(wanted):
        return mass.copy()
    return np.where(free, mass, wanted / np.nansum(wanted) * (1.0 - mass[free].sum()))


def with_rates(members: DataFrame, model: DomainModel, descent: Descent, keep: list[str]) -> DataFrame:
    """``keep`` columns with __tokens, __domain, __posterior and __rate."""
    k, m = len(model.names), len(keep)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[m + 1 :]]) if k else np.ones((batch.num_rows, 1))
            names = np.array(model.names or [None], dtype=object)
            best = p.argmax(axis=1)
            added = [pa.array(names[best], pa.string()), pa.array(p.max(axis=1)), pa.array(descent.rates(p))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: m + 1], *added], names=[*keep, "__tokens", "__domain", "__posterior", "__rate"])

    fields = members.select(*keep, "__tokens").schema.fields
    schema = StructType(fields).add("__domain", "string").add("__posterior", "double").add("__rate", "double")
    return members.select(*keep, "__tokens", *(f"__p{i}" for i in range(k))).mapInArrow(tidy(apply), schema)


def copies_of(rate: str, key: str):
    """Whole copies: the rate rounded up or down by a hash of the key, right in expectation."""
    chance = F.pmod(F.xxhash64(F.col(key), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(chance < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int")


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, domain, posterior, rate, copies for every row of ``docs``.

    goal_tokens and reached_tokens tell for the row's domain what was wanted and what the rates give, in
    parts of all present tokens; both are null where nothing was fitted.
    """
    model = train(docs, labelled)
    members = stored(memberships(docs, model, ["doc_id"]), "members")
    descent = fit_rates(members, model, targets)

    def of_domain(values: np.ndarray | None):
        found = F.lit(None).cast("double")
        for name, value in zip(model.names, [] if values is None else values.tolist()):
            found = F.when(F.col("__domain") == name, value).otherwise(found)
        return found

    return with_rates(members, model, descent, ["doc_id"]).select(
        "doc_id",
        F.col("__tokens").alias("n_tokens"),
        F.col("__domain").alias("domain"),
        F.col("__posterior").alias("posterior"),
        F.col("__rate").alias("rate"),
        copies_of("__rate", "doc_id").alias("copies"),
        of_domain(descent.goal).alias("goal_tokens"),
        of_domain(descent.reached).alias("reached_tokens"),
    )


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], floor: float = 1.0) -> DataFrame:
    """``docs`` with each row repeated by its copies; with a floor of one no document is lost."""
    model = train(docs, labelled)
    members = stored(memberships(docs, model, ["doc_id"]), "members")
    descent = fit_rates(members, model, targets, floor, grow=floor >= 1.0)
    # The columns of docs stay on the JVM side of the first pass; texts are measured once more here.
    rated = with_rates(memberships(docs, model, docs.columns), model, descent, docs.columns)
    rated = rated.withColumn("__copies", copies_of("__rate", "doc_id")).where("__copies > 0")
    return rated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
