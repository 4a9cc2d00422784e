import hashlib
import re

from ratelake.llm import exact_dedup

from .conftest import by_id

COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = {}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    best = {k: (min(v)[1], len(v)) for k, v in groups.items()}
    return {i: (*best[norm(t)], best[norm(t)][0] == i, hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows}


def test_against_brute_force(documents):
    rows = [(5, "a b"), (3, "ab"), (4, "a  b"), (2, "a b"), (7, None), (6, ""), (8, " \n"), (9, "x" * 200_000), (1, "y"), (10, "A b")]
    rows += [(100 + i, "hot copy") for i in range(300)]
    assert by_id(exact_dedup.exact_groups(documents(*rows), salts=8), *COLUMNS) == brute(rows)


def test_repeated_rows_and_null_id(documents):
    got = exact_dedup.exact_groups(documents((1, "a"), (1, "a"), (None, "a"), (None, "b"))).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [(0, 0, 1, True), (0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)]


def test_empty_table(documents):
    assert exact_dedup.exact_groups(documents().limit(0)).count() == 0
    assert exact_dedup.keep_first(documents((1, "a"), (2, " a"), (3, "b"))).count() == 2


def test_rows_of_one_id_stay_by_their_own_text(documents):
    docs = documents((5, "aa  bb"), (7, "aa bb"), (7, "other"), (None, "aa bb"), (None, "alone"))
    kept = exact_dedup.keep_first(docs)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "alone"), (5, "aa  bb"), (7, "other")]
    assert kept.columns == docs.columns
