"""Queries with SQL against the second engine; the others return every row of their table."""

import os

import duckdb
import pytest

from ratelake.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    want = duck.sql(oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in want.columns)) for r in df.collect())
    assert got == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", ["op1_mixing", "op3_toxicity", "op6_language_id", "op9_token_files", "op10_quality"])
def test_one_row_per_document(spark, duck, name):
    ids = [r.doc_id for r in queries()[name](spark, SF).collect()]
    assert sorted(ids) == [r[0] for r in duck.sql("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_leaks_as_found_by_word_runs(spark, duck):
    """Every document with 13 words in a row of a benchmark item is found, and no document without five."""
    words = "string_split_regex(trim(lower(text), chr(10) || ' '), '[ \\n]+')"
    runs = lambda n: {
        r[0]
        for r in duck.sql(f"""
        WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT {words} AS w FROM benchmark),
        s AS (SELECT doc_id, array_to_string(w[i:i + {n - 1}], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d)),
        t AS (SELECT array_to_string(w[i:i + {n - 1}], ' ') AS run FROM (SELECT w, unnest(range(1, len(w) - {n - 2})) AS i FROM b))
        SELECT DISTINCT doc_id FROM s SEMI JOIN t USING (run)""").fetchall()
    }
    got = {r.doc_id for r in queries()["op7_decontaminate"](spark, SF).collect()}
    assert runs(13) <= got <= runs(5)


def test_no_page_is_lost(spark, duck):
    rows = queries()["op5_main_text"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == [r[0] for r in duck.sql("SELECT page_id FROM pages ORDER BY 1").fetchall()]
    assert all(r.n_chars == len(r.text) for r in rows)
