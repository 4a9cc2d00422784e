import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratelake.functions import columns as c


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


@pytest.mark.parametrize(
    "value, text",
    [(1.0, "1.0"), (0.92341, "0.9234"), (0.0001, "0.0001"), (12345678.0, "12345678.0"),
     (24.71185, "24.7118"), (9.1e9, "9100000000.0"), (0.00001, "0.0"), (10.5, "10.5")],
)
def test_rate_text_is_plain_notation(spark, value, text):
    assert one(spark, c.rate_text(F.lit(value))) == text


def test_strip_prefix_replaces_every_occurrence(spark):
    quotes = F.create_map(F.lit("USDGBP"), F.lit("0.7"), F.lit("USDUSD"), F.lit("1"))
    assert one(spark, c.strip_prefix(quotes, F.lit("USD"))) == {"GBP": "0.7", "": "1"}


def test_repeated_keys_keep_the_first(spark):
    entries = F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(v).alias("value"))
        for k, v in (("A", 1.0), ("B", 2.0), ("A", 3.0))
    ])
    assert one(spark, c.map_of_entries(entries)) == {"A": 1.0, "B": 2.0}


def test_double_map_turns_text_that_is_no_number_into_null(spark):
    m = F.create_map(F.lit("a"), F.lit("1.5"), F.lit("b"), F.lit("2"), F.lit("c"), F.lit("n/a"))
    assert one(spark, c.double_map(m)) == {"a": 1.5, "b": 2.0, "c": None}


def test_hours_count_boundaries(spark):
    at = [F.lit(f"2024-01-01 {t}").cast("timestamp_ntz") for t in ("10:59:00", "11:01:00")]
    assert one(spark, c.hours_between(*at)) == 1
    assert one(spark, c.hours_between(at[0], at[0])) == 0


rates = st.one_of(st.none(), st.floats(0.001, 1e6))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(rates, rates, rates), min_size=60, max_size=60))
def test_median_of_columns(spark, triples):
    df = spark.createDataFrame(triples, "a double, b double, c double")
    got = df.select("a", "b", "c", c.median_of([F.col(x) for x in "abc"]).alias("m")).collect()
    for r in got:
        present = [v for v in (r.a, r.b, r.c) if v is not None]
        assert r.m == (pytest.approx(statistics.median(present)) if present else None)
