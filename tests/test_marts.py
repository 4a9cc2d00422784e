import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.operators import marts
from ratelake.sources import seeds

from .helpers import day, rows, series, ts


def history(spark, n, target="EUR", start=date(2024, 1, 1), step=1):
    items = [(target, (start + timedelta(days=step * i)).isoformat(), 1.0 + i * i % 7)
             for i in range(n)]
    return items, series(spark, *items)


def test_dimension_codes_are_upper_case(spark):
    dim = marts.dim_countries(seeds.default_seed(spark))
    codes = {r.country_code for r in dim.collect()}
    assert {"DK", "RO", "US"} <= codes and all(c == c.upper() for c in codes)


def test_latest_rates_keeps_all_dates_and_unknown_currencies(spark):
    fact = series(spark, ("EUR", "2024-01-01", 0.9), ("XXX", "2024-01-02", 2.0),
                  ("GBP", "2024-01-02", 0.7)).withColumns(
        {"consensus_variance": F.lit(0.0), "validation_status": F.lit("VALIDATED"),
         "severity": F.lit("OK")})
    dim = marts.dim_countries(seeds.default_seed(spark))
    got = marts.in_order(marts.mart_latest_rates(fact, dim), "mart_latest_rates").collect()
    assert [(r.target_currency, r.region) for r in got] == [
        ("GBP", "Europe"), ("XXX", None), ("EUR", "Europe")]
    newest = marts.hot_latest_slice(fact, dim)
    assert rows(newest, "currency_pair") == [("USD/GBP",), ("USD/XXX",)]
    assert rows(marts.hot_latest_slice(fact, dim, day("2024-01-01")), "target_currency") == [
        ("EUR",)]


def test_moving_average_and_change(spark):
    items, df = history(spark, 12)
    values = [r for _, _, r in items]
    for i, r in enumerate(sorted(marts.rate_analysis(df).collect(), key=lambda r: r.rate_date)):
        assert r.ma_7_day == pytest.approx(statistics.mean(values[max(0, i - 6): i + 1]))
        assert r.daily_change == (None if i == 0 else pytest.approx(values[i] - values[i - 1]))


def test_incremental_rows_equal_the_full_run(spark):
    _, df = history(spark, 40)
    full = rows(marts.rate_analysis(df).where("rate_date >= '2024-02-01'"))
    for mode, args in (("daily", {"newest_loaded": day("2024-02-01")}),
                       ("backfill", {"execution_date": "2024-02-01"})):
        assert rows(marts.rate_analysis_incremental(df, mode, **args)) == full
    assert marts.rate_analysis_incremental(df, "daily").count() == 40


def test_incremental_rows_of_a_sparse_series(spark):
    weeks = [(date(2024, 1, 1) + timedelta(days=7 * i)).isoformat() for i in range(20)]
    df = series(spark, *[("EUR", d, 1.0 + i) for i, d in enumerate(weeks)])
    full = rows(marts.rate_analysis(df).where("rate_date >= '2024-04-01'"))
    got = marts.rate_analysis_incremental(df, "backfill", "2024-04-01")
    assert rows(got) == full and len(full) == 7


def test_cross_rates(spark):
    df = series(spark, ("EUR", "2024-01-02", 0.8), ("GBP", "2024-01-02", 0.5),
                ("SEK", "2024-01-02", 10.0), ("JPY", "2024-01-01", 150.0))
    got = {r.currency_pair: r for r in marts.cross_rates(df).collect()}
    assert set(got) == {"EUR/GBP", "GBP/EUR"}
    pair = got["EUR/GBP"]
    assert pair.exchange_rate == pytest.approx(1.6)
    assert pair.inverse_rate == pair.convert_multiplier == pytest.approx(0.625)


def test_monthly_summary(spark):
    items, df = history(spark, 75)
    months = {r.month: r for r in marts.monthly_summary(df, date(2024, 3, 31), 1).collect()}
    assert sorted(months) == [date(2024, 2, 1), date(2024, 3, 1)]
    values = [r for _, d, r in items if d.startswith("2024-02")]
    feb = months[date(2024, 2, 1)]
    assert (feb.sample_count, feb.year, feb.month_num) == (29, 2024, 2)
    assert (feb.opening_rate, feb.closing_rate) == (values[0], values[-1])
    assert feb.median_rate == statistics.median(values)
    assert feb.stddev_rate == pytest.approx(statistics.stdev(values))
    assert feb.volatility_pct == pytest.approx(
        (max(values) - min(values)) / statistics.mean(values))


@pytest.mark.parametrize("step", [1, 11])
def test_volatility_lead_in_equals_the_full_history(spark, step):
    """Gaps make the 30 rows before the reported days reach far back."""
    _, a = history(spark, 120, "EUR", step=step)
    _, b = history(spark, 35, "GBP", step=step * 3)
    df = a.unionByName(b)
    as_of = df.agg(F.max("rate_date")).first()[0]
    want = marts.volatility_metrics(df).where(
        F.col("rate_date") >= F.lit(as_of - timedelta(days=90)))
    got = marts.rate_volatility(df, as_of).drop("risk_level")
    assert rows(got) == rows(want)
    assert got.count() > 0


def test_risk_levels(spark):
    rates = [1.0, 1.005, 1.02, 1.05, 1.05]
    df = series(spark, *[("EUR", f"2024-01-0{i + 1}", r) for i, r in enumerate(rates)])
    got = marts.rate_volatility(df, date(2024, 1, 9)).orderBy("rate_date").collect()
    assert [r.risk_level for r in got] == [
        "STABLE", "STABLE", "MEDIUM_RISK", "HIGH_RISK", "STABLE"]
    assert got[0].volatility_7d is None


def health_inputs(spark, flagged=0):
    fact = series(spark, ("EUR", "2024-01-01", 0.9), ("EUR", "2024-01-02", 0.9),
                  ("GBP", "2024-01-02", 0.7)).withColumns(
        {"severity": F.lit("OK"),
         "extraction_timestamp": F.lit("2024-01-02 10:59:00").cast("timestamp_ntz")})
    cons = spark.createDataFrame(
        [(day("2024-01-02"), "FLAGGED", 0.01 * i) for i in range(flagged)]
        + [(day("2024-01-01"), "FLAGGED", 0.5)],
        "rate_date date, status string, frank_dev double")
    return fact, cons


@pytest.mark.parametrize(
    "now, flagged, status",
    [("2024-01-02T11:01:00", 0, "HEALTHY"), ("2024-01-02T11:01:00", 6, "DEGRADED"),
     ("2024-01-04T11:01:00", 5, "HEALTHY"), ("2024-01-05T11:01:00", 6, "STALE")])
def test_health(spark, now, flagged, status):
    row = marts.health_metrics(*health_inputs(spark, flagged), ts(now)).collect()
    assert len(row) == 1 and row[0].pipeline_status == status
    assert (row[0].currency_count, row[0].total_records, row[0].validated_count) == (2, 3, 2)
    assert (row[0].ok_rate, row[0].flagged_count) == (1.0, flagged)
    if flagged:
        assert row[0].max_variance == pytest.approx(0.01 * (flagged - 1))
    if now.startswith("2024-01-02"):
        assert row[0].hours_since_extraction == 1


def test_health_of_an_empty_fact(spark):
    fact = spark.createDataFrame([], schemas.FACT)
    _, cons = health_inputs(spark)
    args = (fact, cons, ts("2024-01-02T00:00:00"))
    row = marts.health_metrics(*args).collect()
    assert [r.pipeline_status for r in row] == ["HEALTHY"]
    assert (row[0].total_records, row[0].currency_count, row[0].ok_rate) == (0, 0, None)
    assert marts.health_metrics(*args, no_data_status=True).first().pipeline_status == "NO_DATA"
