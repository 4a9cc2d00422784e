from ratelake import schemas
from ratelake.operators import staging
from ratelake.operators.normalize import flatten_map
from ratelake.operators.silver import rebuild_map

from .helpers import day, quotes, rows, silver_frame, silver_row, ts


def test_unnest_skips_empty_and_missing_maps(spark):
    df = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0, "GBP": 2.0}),
                      silver_row("2024-01-02", {}), silver_row("2024-01-03", None))
    assert rows(staging.unnest_rates(df), "target_currency", "exchange_rate") == [
        ("EUR", 1.0), ("GBP", 2.0)
    ]


def test_flatten_rebuild_unnest_round_trip(spark):
    df = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0, "GBP": 2.0}),
                      silver_row("2024-01-02", {"GBP": 3.0}))
    back = rebuild_map(flatten_map(df))
    assert rows(staging.unnest_rates(back)) == rows(staging.unnest_rates(df))


def test_bad_newest_quote_removes_its_key(spark):
    df = quotes(
        spark,
        ("frankfurter", "EUR", "2024-01-01", "2024-01-01T01:00:00", 0.9),
        ("frankfurter", "EUR", "2024-01-01", "2024-01-01T02:00:00", 0.0),
        ("frankfurter", "GBP", "2024-01-01", "2024-01-01T01:00:00", 0.7),
        ("frankfurter", "GBP", "2024-01-01", "2024-01-01T02:00:00", None),
        ("frankfurter", "JPY", "2024-01-01", "2024-01-01T01:00:00", -1.0),
        ("frankfurter", "JPY", "2024-01-01", "2024-01-01T02:00:00", 149.0),
    )
    staged = staging.stage_quotes(df)
    assert rows(staged, "target_currency", "exchange_rate") == [("JPY", 149.0)]
    assert staged.first().inverse_rate == 1 / 149.0


def test_codes_are_normalised_before_dedup(spark):
    df = quotes(
        spark,
        ("frankfurter", "rates__eur", "2024-01-01", "2024-01-01T01:00:00", 0.9),
        ("frankfurter", "EUR", "2024-01-01", "2024-01-01T02:00:00", 0.8),
    )
    got = staging.stage_quotes(df, as_of=ts("2024-01-05T00:00:00"))
    assert got.schema.simpleString() == schemas.STAGING.simpleString()
    row = got.collect()
    assert len(row) == 1
    assert (row[0].target_currency, row[0].currency_pair) == ("EUR", "USD/EUR")
    assert row[0].exchange_rate == 0.8 and row[0].dbt_loaded_at == ts("2024-01-05T00:00:00")


def test_ties_are_settled_by_id(spark):
    tied = [("frankfurter", "EUR", "2024-01-01", "2024-01-01T01:00:00", r) for r in (1.0, 2.0)]
    df = quotes(spark, *tied).withColumn(
        "extraction_id", staging.F.col("exchange_rate").cast("string")
    )
    for n in (1, 3):
        assert rows(staging.stage_quotes(df.repartition(n)), "exchange_rate") == [(2.0,)]


def test_watermark(spark):
    df = silver_frame(spark, *[silver_row(f"2024-01-0{d}", {"EUR": 1.0}) for d in range(1, 6)])
    assert staging.incremental_watermark(df, "daily", day("2024-01-03")).count() == 2
    assert staging.incremental_watermark(df, "daily", None).count() == 5
    assert staging.incremental_watermark(df, "backfill", day("2024-01-03")).count() == 5


def test_daily_window_reaches_back(spark):
    df = silver_frame(spark, *[silver_row(f"2024-01-0{d}", {"EUR": 1.0}) for d in range(1, 8)])
    assert staging.build_staging(df, "daily", "2024-01-06", lookback_days=3).count() == 5
    assert staging.build_staging(df, "backfill", "2024-01-06", lookback_days=3).count() == 2
    assert staging.build_staging(df, "daily").count() == 7
