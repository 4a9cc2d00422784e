import random

import numpy as np
import pytest

from ratelake.llm import minhash_dedup as md


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = lower.replace("\x0b", " ").split()
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) >= 2 else {tuple(w)} if w else set()


def brute(rows):
    """Per row; rows of one id are one node."""
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[:k]:
            if sa and 100 * len(sa & sb) >= 80 * len(sa | sb):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def corpus(seed):
    """Clusters around the threshold, chains whose ends are apart, shared lines, short texts, equal sets of unequal texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 500)}"
    line, rows, i = [word() for _ in range(14)], [], 0
    for _ in range(16):
        base = [word() for _ in range(draw.randint(20, 110))]
        for _ in range(draw.randint(1, 9)):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = word()
            text += line if draw.random() < 0.3 else []
            rows.append((i * 7 % 499, " ".join(text).upper() if draw.random() < 0.2 else " ".join(text)))
            i += 1
            base = text if draw.random() < 0.5 else base
    return rows + [(600, "a b"), (601, "A  b"), (602, "a"), (603, None), (604, ""), (605, " \n"), (606, "a b a b"), (607, "b a b"), (608, "A")]


@pytest.mark.parametrize("seed, side, paired", [(1, 1024, 32), (2, 4, 1), (3, 2, 3)])
def test_against_brute_force(documents, monkeypatch, seed, side, paired):
    """Small sides and pairings send more components through the later steps."""
    monkeypatch.setattr(md, "SIDE", side)
    monkeypatch.setattr(md, "PAIRED", paired)
    rows = corpus(seed)
    assert got(md.near_duplicates(documents(*rows))) == brute(rows)


def under(plan, name):
    """The lines of ``plan`` below each node ``name``."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines, found = plan.split("\n"), []
    for i, line in enumerate(lines):
        if line.lstrip(" :+-").startswith(name):
            end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            found.append("\n".join(lines[i:end]))
    return found


def test_rows_that_multiply_are_not_broadcast(spark, documents, monkeypatch, tmp_path):
    """Bucket rows and lots come from small tables and are many; the driver must not hold them, first or replanned."""
    rows, plans, store = corpus(2), [], md.stored

    def stored(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    documents(*rows).write.parquet(f"{tmp_path}/documents")
    monkeypatch.setattr(md, "SIDE", 4)
    monkeypatch.setattr(md, "PAIRED", 1)
    monkeypatch.setattr(md, "stored", stored)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) >= 10 << 20
    assert got(md.near_duplicates(spark.read.parquet(f"{tmp_path}/documents"))) == brute(rows)
    assert sum("Generate explode(" in p for p in plans) >= 4 and sum("MapInArrow" in p for p in plans) >= 9
    sent = [x for p in plans for x in under(p, "BroadcastExchange")]
    assert sent and not [x for x in sent if "Generate" in x or "MapInArrow" in x]


def test_a_third_of_all_rows_in_one_group_of_copies(documents):
    draw = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(f"x{draw.randint(0, 900)}" for _ in range(60))) for i in range(120)]
    for i in range(120, 240):
        text = list(base)
        for _ in range(draw.randint(0, 7)):
            text[draw.randrange(80)] = f"y{draw.randint(0, 9)}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(base)) for i in range(240, 300)]
    assert got(md.near_duplicates(documents(*rows))) == brute(rows)


def test_repeated_ids_null_ids_and_empty_table(documents):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (2, a), (3, b), (2, b), (2, b), (9, "c d"), (9, ""), (9, None), (12, "C\td")]
    assert got(md.near_duplicates(documents(*rows))) == brute(rows)
    null = md.near_duplicates(documents((None, a), (4, a), (None, None))).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in null) == [(0, 0, True), (0, 0, True), (4, 4, True)]
    assert md.near_duplicates(documents().limit(0)).count() == 0


def test_signature_values_agree_as_often_as_sets_do():
    draw = np.random.default_rng(1)
    pool = draw.integers(1, 1 << 63, 3000, dtype=np.uint64)
    for common in (900, 500, 100):
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - common : 2000 - common])
        s = md.signatures([a, b])
        want = common / (2000 - common)
        assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / 250) ** 0.5 + 0.01
        assert (md.band_keys(s)[0] == md.band_keys(s)[1]).tolist() == (s.reshape(2, 50, 5)[0] == s.reshape(2, 50, 5)[1]).all(axis=1).tolist()


def test_bounds_follow_from_the_posterior():
    """The posterior by numeric integration: kept from ``fewest`` matches on, dropped below."""
    t = np.linspace(0, 1, 200_001)
    for batch, fewest in enumerate(md.fewest_matches(), 1):
        m = batch * md.BATCH

        def above(k, m=m):
            log = k * np.log(np.maximum(t, 1e-300)) + (m - k) * np.log(np.maximum(1 - t, 1e-300))
            density = np.exp(log - log.max())
            return density[t >= 0.8].sum() / density.sum()

        assert above(fewest) >= 0.99 * md.MISS
        assert fewest == 0 or above(fewest - 1) < 1.01 * md.MISS
    assert (1 - 0.8**md.ROWS) ** md.BANDS < 3e-9


def test_verification_loses_no_pair_over_the_threshold():
    """Links of 80 % and just above survive every batch; far pairs do not."""
    draw = np.random.default_rng(2)
    for size in (9, 45, 450):
        for _ in range(60):
            pool = draw.integers(1, 1 << 63, 2 * size, dtype=np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[size // 9 : size + size // 9])
            assert md.linked(a, b)
            s = md.signatures([a, b])
            assert md.plausible(s[0], s[1:]).tolist() == [0]
            far = md.signatures([np.sort(pool[size:])])
            assert not len(md.plausible(s[0], far))
