import hashlib
import random
import zlib

import numpy as np
import pytest

from ratelake.llm import periodic_runs as pr

from .conftest import by_id

COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def brute(words):
    """Every stretch equal to itself ``p`` words on, by trying all places and periods."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j - i + p >= 12:
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row(doc_id, text):
    words = (text or "").split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    keep = [w for i, w in enumerate(words) if not any(s + p <= i < s + k for s, k, p in found)]
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *values, sha("".join(f"{s},{k},{p}\n" for s, k, p in found)), sha(" ".join(keep)))


def sequence(draw):
    size, kinds = draw.randint(0, 70), draw.choice([1, 2, 2, 3, 6])
    words = [draw.randrange(kinds) for _ in range(size)]
    for _ in range(draw.randint(0, 3)):
        at, unit = draw.randint(0, size), [draw.randrange(kinds) for _ in range(draw.randint(1, 12))]
        words[at:at] = (unit * 6)[: draw.randint(2, 40)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_places_and_periods(seed):
    draw = random.Random(seed)
    total = 0
    for _ in range(400):
        words = sequence(draw)
        got = pr.runs(np.array(words, np.int64))
        assert got == brute(words)
        total += len(got)
    assert total > 200


def test_long_powers_and_many_far_copies():
    assert pr.runs(np.zeros(60_000, np.int64)) == [(0, 60_000, 1)]
    assert pr.runs(np.arange(70_001) % 7) == [(0, 70_001, 7)]
    line = [i for k in range(3000) for i in (10 + k, 0, 1, 2, 3, 4, 5, 6, 7)]
    assert pr.runs(np.array(line)) == []


def test_rows_equal_brute_force(documents):
    draw = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for x in sequence(draw)) + draw.choice(["", " \n", "\x0b"])) for i in range(150)]
    rows += [(i, " ".join(f"é{draw.randrange(500)}" for _ in range(90))) for i in range(200, 260)]
    got = by_id(pr.periodic_runs(documents(*rows)), *COLUMNS)
    assert got == {i: row(i, t) for i, t in rows}
    assert sum(r[0] > 0 for i, r in got.items() if i >= 200) >= 2


def test_odd_rows(documents):
    same = "a b " * 12
    docs = documents((None, same), (5, None), (6, ""), (7, " \t\n"), (8, same), (8, same), (9, "a\xa0b " * 20))
    got = pr.periodic_runs(docs).collect()
    # A no-break space is part of its word.
    assert [(r.n_runs, r.start, r.length, r.period) for r in got if r.doc_id == 9] == [(1, 0, 20, 1)]
    rest = [(r.doc_id, tuple(r[c] for c in COLUMNS)) for r in got if r.doc_id != 9]
    want = [(i, row(i, t)) for i, t in [(None, same), (5, None), (6, ""), (7, ""), (8, same), (8, same)]]
    assert sorted(rest, key=repr) == sorted(want, key=repr)
    assert pr.periodic_runs(documents().limit(0)).count() == 0
