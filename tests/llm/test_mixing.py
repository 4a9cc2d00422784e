import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import mixing

STEMS = {"x": ["ung", "sch", "der"], "y": ["eau", "ré", "les"], "z": ["ción", "que", "los"]}


@pytest.fixture(scope="module")
def corpus(spark):
    draw, rows = random.Random(5), []
    for i in range(300):
        domain = "xxxxyyz"[i % 7]
        rows.append((i, " ".join("".join(draw.choice(STEMS[domain]) for _ in range(2)) for _ in range(draw.randint(5, 60))), domain))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("rate", F.lit(1)).withColumn("copies", F.lit("c"))
    return docs, spark.createDataFrame([(i, d) for i, _, d in rows if i % 2], "doc_id long, domain string"), {i: d for i, _, d in rows}


def shares(rows):
    total = {}
    for r in rows:
        total[r.domain] = total.get(r.domain, 0) + r.rate * r.n_tokens
    return {k: v / sum(total.values()) for k, v in total.items()}


def test_rates_reach_targets(corpus):
    docs, labelled, truth = corpus
    targets = {"x": 0.2, "y": 0.3, "z": 0.5}
    rows = mixing.document_rates(docs, labelled, targets).collect()
    assert np.mean([r.domain == truth[r.doc_id] for r in rows]) > 0.98
    got = shares(rows)
    assert all(abs(got[k] - v) < 0.02 for k, v in targets.items())
    told = {r.domain: (r.goal_tokens, r.reached_tokens) for r in rows}
    assert all(told[k][0] == pytest.approx(v) == pytest.approx(told[k][1], abs=2e-3) for k, v in targets.items())
    assert sum(r.rate * r.n_tokens for r in rows) == pytest.approx(sum(r.n_tokens for r in rows), rel=0.01)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert sum(r.copies for r in rows) == pytest.approx(sum(r.rate for r in rows), rel=0.1)


def test_descent_equals_a_dense_solution(spark):
    draw = np.random.default_rng(3)
    p = draw.dirichlet([0.4, 0.4, 0.4], 200)
    tokens = draw.integers(1, 100, 200)
    table = spark.createDataFrame([(int(t), *map(float, q)) for t, q in zip(tokens, p)], "__tokens long, __p0 double, __p1 double, __p2 double")
    model = mixing.DomainModel(["a", "b", "c"], np.ones(3) / 3, np.zeros((3, mixing.BUCKETS)))
    descent = mixing.fit_rates(table, model, {"a": 0.5, "b": 0.3, "c": 0.2})
    w = tokens / tokens.sum()
    assert (w * descent.rates(p)) @ p == pytest.approx([0.5, 0.3, 0.2], abs=5e-3)


@pytest.mark.parametrize("floor, grow", [(0.0, False), (1.0, False), (1.0, True)])
def test_descent_equals_a_dense_solution_with_floors(spark, floor, grow):
    """Against plain projected gradient steps over all rows in memory, to a standstill; also where the floor
    puts the targets out of reach, so that only the optimum ends the descent."""
    draw = np.random.default_rng(4)
    p = draw.dirichlet([0.3, 0.2, 0.1], 300)
    tokens = draw.integers(1, 100, 300)
    table = spark.createDataFrame([(int(t), *map(float, q)) for t, q in zip(tokens, p)], "__tokens long, __p0 double, __p1 double, __p2 double")
    model = mixing.DomainModel(["a", "b", "c"], np.ones(3) / 3, np.zeros((3, mixing.BUCKETS)))
    descent = mixing.fit_rates(table, model, {"a": 0.2, "b": 0.3, "c": 0.5}, floor, grow)
    w = tokens / tokens.sum()
    weight = 1 / (w @ p)
    rate = np.full(300, max(1.0, floor))
    for _ in range(40_000):
        rate = np.maximum(floor, rate - descent.step * (p @ (weight * ((w * rate) @ p - descent.goal)) + mixing.PULL * (rate - 1)))
    dense = (w * rate) @ p
    assert descent.reached == pytest.approx((w * descent.rates(p)) @ p)
    assert descent.reached == pytest.approx(dense, abs=5e-3 * descent.goal.max())
    assert descent.gap <= np.abs(dense - descent.goal).max() / descent.goal.max() + 3e-3
    if floor and not grow:
        assert descent.gap > 0.1 and len(descent.steps) < 200


def test_floor_keeps_every_document(corpus):
    docs, labelled, truth = corpus
    got = mixing.mixed(docs, labelled, {"x": 0.4, "y": 0.3, "z": 0.3}, floor=1.0)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} == set(truth)
    tokens = {}
    for r in rows:
        tokens[truth[r.doc_id]] = tokens.get(truth[r.doc_id], 0) + len(r.text.split())
    assert tokens["z"] / sum(tokens.values()) == pytest.approx(0.3, abs=0.06)


def test_unknown_targets_and_gaps(corpus, documents, spark):
    docs, labelled, _ = corpus
    got = shares(mixing.document_rates(docs, labelled, {"x": 0.5, "q": 9.0}).collect())
    assert got["x"] == pytest.approx(4 / 7, abs=0.08)
    odd = documents((1, None), (2, ""), (None, "ung der"), (4, "x" * 1_000_000), (4, "que"))
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert {r.rate for r in mixing.document_rates(odd, none, {"x": 1.0}).collect()} == {1.0}
    labelled = spark.createDataFrame([(4, "x"), (2, None), (None, "y"), (77, "y")], "doc_id long, domain string")
    assert mixing.document_rates(odd, labelled, {"x": 1.0}).count() == 5
    assert mixing.document_rates(odd.limit(0), labelled, {"x": 1.0}).count() == 0
