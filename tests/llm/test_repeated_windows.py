import hashlib
import random
import re

import numpy as np
import pytest

from ratelake.llm import repeated_windows as rw

from .conftest import by_id


def brute(rows):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i, w in sorted(words.items()):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "the"]
    passages = [[draw.choice(vocabulary) for _ in range(draw.randint(10, 40))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 4)):
            parts += draw.choice(passages) if draw.random() < 0.6 else [draw.choice(vocabulary) for _ in range(draw.randint(1, 20))]
        rows.append((i * 3 % 61, draw.choice([" ", "\n", "  "]).join(parts)))
    return rows + [(100, None), (101, ""), (102, "a " * 5000), (103, "a " * 20), (104, "b " * 13)]


@pytest.mark.parametrize("compact", [rw.COMPACT_BYTES, 10])
@pytest.mark.parametrize("chunk", [rw.CHUNK_BYTES, 300])
def test_against_brute_force(documents, monkeypatch, chunk, compact):
    monkeypatch.setattr(rw, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(rw, "COMPACT_BYTES", compact)
    rows = corpus(chunk + compact)
    assert by_id(rw.without_repeats(documents(*rows)), "n_words", "n_removed", "kept_sha256") == brute(rows)


def test_minimisers_are_those_of_the_windows():
    words = " ".join(map(str, np.random.default_rng(3).integers(0, 9, 200))).encode()
    block = rw.words_of(np.frombuffer(words, np.uint8), np.array([0, len(words)]), False)
    at, _ = rw.window_hashes(block, rw.WINDOW)
    every = rw.minimisers(block, np.arange(len(at)))
    for i in (0, 17, len(at) - 1):
        part = rw.words_of(block.data[block.starts[i] : block.ends[i + 12]], np.array([0, block.ends[i + 12] - block.starts[i]]), False)
        assert rw.minimisers(part, np.array([0]))[0] == every[i]


def test_repeated_rows_null_ids_and_empty_table(documents):
    text = " ".join(map(str, range(20)))
    got = rw.without_repeats(documents((1, text), (1, text), (None, text), (2, text)), with_text=True).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept_text == text) for r in got) == [(0, 0, True), (1, 0, True), (1, 0, True), (2, 20, False)]
    assert rw.without_repeats(documents().limit(0)).count() == 0
