import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelake.llm.words import window_hashes, word_blocks

TEXTS = st.lists(st.none() | st.text(alphabet="aAbé \t\n\x0b\x85 .", max_size=30), max_size=8)


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_words_and_windows_as_by_split(texts):
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got, windows, seen = [], [], {}
    for block in word_blocks(pa.array(texts, pa.string()), lower=False):
        data = block.data.tobytes()
        spans = list(zip(block.starts, block.ends, block.hashes))
        for a, b in zip(block.bounds, block.bounds[1:]):
            got.append([data[s:e].decode() for s, e, _ in spans[a:b]])
        for s, e, h in spans:
            assert seen.setdefault(data[s:e], h) == h
        at, hashes = window_hashes(block, 2)
        windows.append(len(at))
    assert got == want
    assert len(set(seen.values())) == len(seen)
    assert sum(windows) == sum(max(0, len(w) - 1) for w in want)


def test_lower_case_is_ascii_only():
    a, b = (next(word_blocks(pa.array([t]), lower=True)).hashes for t in ("ABz É", "abZ É"))
    c = next(word_blocks(pa.array(["abz é"]), lower=True)).hashes
    assert (a == b).all() and a[0] == c[0] and a[1] != c[1]


def test_long_text_and_slices():
    long = "w" * 5_000_000 + " x"
    column = pa.array(["a", long, None, "b c"]).slice(1)
    sizes = [np.diff(b.bounds).tolist() for b in word_blocks(column, lower=True)]
    assert sum(sizes, []) == [2, 0, 2]
