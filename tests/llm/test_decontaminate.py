import random
from itertools import combinations

import numpy as np
import pytest

from ratelake.llm import decontaminate as dc


@pytest.fixture(scope="module")
def items(spark):
    draw = random.Random(8)
    texts = [" ".join(f"b{draw.randint(0, 5000)}" for _ in range(n)) for n in (40, 25, 15, 11)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10, None), (11, ""), (12, "short item"), (13, texts[0]), (None, texts[1])]
    return spark.createDataFrame(rows, "item_id long, text string"), texts


def changed(text, every, start=2):
    words = text.split()
    for i in range(start, len(words), every):
        words[i] = "other"
    return " ".join(words)


def test_finds_whole_parts_and_substituted_passages(documents, items):
    table, texts = items
    filler = " ".join(f"f{i}" for i in range(200))
    rows = [
        (1, f"{filler} {texts[0]} {filler}"),
        (2, changed(texts[1], 8).upper()),
        (3, " ".join(texts[0].split()[5:25])),
        (4, f"{texts[2]} end"),
        (5, texts[3]),
        (6, f"{filler}\n{changed(texts[0], 7, 3)}"),
        (7, f"{texts[1]} {filler * 200} {texts[2]}"),
    ]
    clean = [(20, filler), (21, None), (22, ""), (23, "short item"), (24, " ".join(texts[0].split()[:9])), (25, changed(texts[0], 2)), (26, filler[:900] + " " + " ".join(texts[1].split()[:8]))]
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(documents(*rows, *clean), table).collect()}
    assert got == {(1, 0), (1, 13), (2, 1), (3, 0), (3, 13), (4, 2), (5, 3), (6, 0), (6, 13), (7, 1), (7, 2)}
    kept = dc.keep_clean(documents(*rows, *clean, (None, texts[0])), table)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 20, 21, 22, 23, 24, 25, 26] and kept.columns == documents().columns


def test_masks_survive_any_single_substitution():
    for hole in range(dc.SPAN, 2 * dc.SPAN):
        # A window of 3 spans with one word changed still has an untouched or tolerant seed next to it.
        assert any(mask[hole - start] == "0" for mask in dc.MASKS for start in range(hole - dc.SPAN + 1, hole + 1) if 0 <= hole - start < dc.SPAN)


def seeded(equal):
    """Whether a mask fits between the equal words of a stretch, given as a string of 1 and 0."""
    masks = [m.rstrip("0") for m in dc.MASKS]
    return any(all(m <= e for m, e in zip(mask, equal[i:])) for mask in masks for i in range(len(equal) - len(mask) + 1))


def test_masks_fit_every_accepted_copy_of_a_short_item():
    for size in range(dc.SPAN, 18):
        item = np.arange(size)
        for holes in (h for k in range(5) for h in combinations(range(size), k)):
            document = item.copy()
            document[list(holes)] = -1
            if dc.best_stretch(document, item, 0)[0] >= dc.words_needed(size):
                assert seeded("".join("1" if w >= 0 else "0" for w in document)), (size, holes)


def test_masks_fit_every_accepted_stretch():
    # All stretches up to their twelfth equal word: the score is above zero from the first word on.
    work, ends = [("1", 1)], 0
    while work:
        equal, score = work.pop()
        if equal.count("1") == dc.MIN_WORDS:
            ends += 1
            assert seeded(equal), equal
            continue
        work.append((equal + "1", score + 1))
        if score > dc.PENALTY:
            work.append((equal + "0", score - dc.PENALTY))
    assert ends == 728


def good_stretches(document, item):
    """Most equal words of all stretches of all diagonals whose every head scores above zero, by trying all."""
    best = 0
    for shift in range(-len(item) + 1, len(document)):
        for start in range(len(item)):
            score = equal = 0
            for i in range(start, len(item)):
                if not 0 <= i + shift < len(document):
                    break
                same = document[i + shift] == item[i]
                score += 1 if same else -dc.PENALTY
                if score <= 0:
                    break
                equal += same
                best = max(best, equal)
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_stretches_of_all_diagonals(documents, spark, seed):
    """Random texts with several, partly substituted stretches of several items, short items among them."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(3000)}"
    sizes = [3, 4, 6, 9, 10, 11, 12, 13, 15, 20, 40, 60, 1, 2]
    item_words = {n: [word() for _ in range(size)] for n, size in enumerate(sizes)}
    rows = []
    for doc_id in range(150):
        words = []
        for _ in range(draw.randint(1, 4)):
            words += [word() for _ in range(draw.randint(0, 6))]
            item = draw.choice(list(item_words.values()))
            at = draw.randrange(len(item))
            part = item[at : at + draw.randint(3, 25)] if draw.random() < 0.6 else list(item)
            words += [word() if draw.random() < draw.choice([0, 0.08, 0.2]) else w for w in part]
        rows.append((doc_id, " ".join(words)))
    # The case of a stretch with the better score before one with more equal words.
    forty = item_words[10]
    rows.append((900, " ".join([*forty[:11], "x", "x", "x", "x", "x", "x", *forty[17:23], "x", *forty[24:30]])))
    table = spark.createDataFrame([(n, " ".join(w)) for n, w in item_words.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched_words for r in dc.contaminated(documents(*rows), table).collect()}
    want = {}
    for doc_id, text in rows:
        for n, item in item_words.items():
            found = good_stretches(text.split(), item)
            if len(item) >= dc.SHORT and found >= dc.words_needed(len(item)):
                want[doc_id, n] = found
    assert got == want and len(want) > 60 and (900, 10) in want


def test_neighbouring_substitutions_and_rows_with_one_id(documents, items):
    table, texts = items
    words = texts[2].split()
    words[5:7] = ["other", "words"]
    longer = " ".join(f"f{i}" for i in range(200)) + " " + " ".join(texts[0].split()[:9])
    rows = [(1, " ".join(words)), (2, texts[1]), (2, longer), (3, longer)]
    got = [(r.doc_id, r.item_id, r.matched_words, r.first_word) for r in dc.contaminated(documents(*rows), table).collect()]
    assert sorted(got) == [(1, 2, 13, 0), (2, 1, 25, 0)]


def test_repeated_rows_and_empty_tables(documents, items):
    table, texts = items
    rows = [(1, texts[0]), (1, texts[0]), (1, "nothing")]
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(documents(*rows), table).collect()} == {(1, 0), (1, 13)}
    assert dc.contaminated(documents(*rows).limit(0), table).count() == 0
    assert dc.contaminated(documents(*rows), table.limit(0)).count() == 0
