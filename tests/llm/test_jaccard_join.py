import random

import pytest

from ratelake.llm import jaccard_join as jj
from ratelake.llm.components import components

from .conftest import by_id


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = lower.replace("\x0b", " ").split()
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    sets, label = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed):
    """Clusters of copies with 0 to 8 changed words around the threshold, chains, shared lines and short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 400)}"
    line = " ".join(word() for _ in range(12))
    rows, i = [], 0
    for _ in range(14):
        base = [word() for _ in range(draw.randint(30, 90))]
        for _ in range(draw.randint(1, 9)):
            text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = word()
            if draw.random() < 0.3:
                text += line.split()
            rows.append((i * 7 % 499, " ".join(text).upper() if draw.random() < 0.2 else " ".join(text)))
            i += 1
            base = text if draw.random() < 0.5 else base
    short = [(600, "a b"), (601, "A  b"), (602, "a"), (603, None), (604, ""), (605, " \n"), (606, "a b c d e"), (607, "b a")]
    return rows + short


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(documents, monkeypatch, seed):
    # One leader a key and small blocks send more pairs through the later steps.
    monkeypatch.setattr(jj, "LEADERS", seed)
    monkeypatch.setattr(jj, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(jj, "BLOCK_QUERIES", 3)
    rows = corpus(seed)
    assert by_id(jj.similar_components(documents(*rows)), "n_shingles", "component_id") == brute(rows)


def test_hot_group_is_salted(documents, monkeypatch):
    monkeypatch.setattr(jj, "HOT_SAMPLE", 4)
    monkeypatch.setattr(jj, "SAMPLE", 1)
    rows = [(i, f"one two three four five six seven eight nine ten eleven twelve {'x' * (i % 3)}") for i in range(60)]
    _, salts = jj.sample_counts(documents(*rows))
    assert salts and all(s > 1 for s in salts.values())
    assert {c for _, c in by_id(jj.similar_components(documents(*rows)), "n_shingles", "component_id").values()} == {0}


def test_repeated_rows_null_ids_and_empty_table(documents):
    got = jj.similar_components(documents((4, "a b c"), (4, "a b c"), (None, "a b c"), (9, "A b\tc"))).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (4, 4), (4, 4), (9, 4)]
    assert jj.similar_components(documents().limit(0)).count() == 0
    kept = jj.keep_one(documents((4, "a b c"), (None, "a b c"), (9, "A b\tc"), (10, "")))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 10] and "score" in kept.columns


@pytest.mark.parametrize("seed", [5, 6])
def test_rows_of_one_id_with_different_texts_are_one_node(documents, monkeypatch, seed):
    """Against brute force over rows; the answer may not depend on which row of an id is met first."""
    monkeypatch.setattr(jj, "LEADERS", 2)
    monkeypatch.setattr(jj, "BLOCK_MEMBERS", 3)
    draw = random.Random(seed)
    rows = [(i if draw.random() < 0.8 else draw.randrange(40), t) for i, t in corpus(seed)]
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows += [(1001, a), (1002, a), (1003, b), (1002, b), (1002, None), (1004, "")]
    label = {i: i for i, _ in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)))
                label[y] = x
    for order in (rows, rows[::-1]):
        got = jj.similar_components(documents(*order).repartition(3)).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(s), find(i)) for i, s in sets)


def test_bound_holds_for_inner_sizes(spark):
    from pyspark.sql import functions as F

    def need(a, b):
        return -(-3 * (a + b) // 7) - max(-(-3 * a // 4), -(-3 * b // 4)) + 1

    cases = [(a, low, high) for a in range(1, 130) for low in range(-(-3 * a // 4), 4 * a // 3 + 1) for high in range(low, min(low + 15, 4 * a // 3) + 1)]
    table = spark.createDataFrame(cases, "n long, low long, high long")
    rows = table.select("n", "low", "high", jj.least_overlap(F.col("n"), F.col("low"), F.col("high")).alias("bound")).collect()
    exact = [min(need(r.n, b) for b in range(r.low, r.high + 1)) for r in rows]
    assert len(rows) > 30_000 and [r.bound for r in rows] == exact


def test_group_with_a_member_of_inner_size_is_asked(spark):
    # The member of 99 shingles needs 8 common cells of a query of 92, those of 98 and 100 need 9.
    rows = [(s, m, n, 1, 1) for m, n in ((1, 98), (2, 99), (3, 100)) for s in range(8)] + [(s, 9, 92, 9, 9) for s in range(8)]
    cells = spark.createDataFrame(rows, "shingle long, doc_id long, n long, leader long, g long")
    assert [tuple(r) for r in jj.bounded_queries(cells).collect()] == [(9, 1)]
    assert jj.bounded_queries(cells.where("shingle < 7")).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 99), (101, 99)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99, 101: 99}
