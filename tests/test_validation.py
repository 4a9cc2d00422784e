import pytest

from ratelake import schemas
from ratelake.config import EngineConfig
from ratelake.operators import consensus as cons
from ratelake.operators import fact, staging

from .helpers import day, quotes, rows

CFG = EngineConfig()
AT = "2024-01-0{}T06:00:00"


def stg(spark, *items):
    """Rows of (source, target, day of month, rate)."""
    full = [(s, t, f"2024-01-0{d}", AT.format(d), r) for s, t, d, r in items]
    return staging.stage_quotes(quotes(spark, *full), ("source", *staging.STAGING_KEYS))


FR, ER, CL = "frankfurter", "exchangerate", "currencylayer"


def test_three_sources_flag_the_outlier(spark):
    rates = cons.union_sources([stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, 1.0),
                                    (CL, "EUR", 1, 1.01))])
    row = cons.score_consensus(rates).first()
    assert row.consensus_rate == 1.0 and row.source_count == 3 and row.status == "FLAGGED"
    assert row.frank_dev == 0.0 and row.cl_dev == pytest.approx(0.01)
    assert row.variance_pct == row.cl_dev and row.severity == "WARNING"
    assert row.source_breakdown == "currencylayer:1.01, exchangerate:1.0, frankfurter:1.0"


def test_two_sources_meet_at_the_midpoint(spark):
    def status(other):
        rates = cons.union_sources([stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, other))])
        return cons.score_consensus(rates).first().status

    assert status(1.0099) == "OK"
    assert status(1.0103) == "FLAGGED"


def test_one_source_never_flags_and_other_bases_do_not_vote(spark):
    one = stg(spark, (FR, "EUR", 1, 1.0))
    euro = stg(spark, (ER, "EUR", 1, 2.0)).withColumn("base_currency", staging.F.lit("EUR"))
    row = cons.score_consensus(cons.union_sources([one, euro])).first()
    assert (row.source_count, row.status, row.er_dev) == (1, "OK", None)


def test_consensus_keeps_flagged_rows_only(spark):
    rows_ = stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, 1.1), (FR, "GBP", 1, 1.0),
                (ER, "GBP", 1, 1.0))
    got = cons.build_consensus([rows_])
    assert rows(got, "target_currency", "currency_pair") == [("EUR", "USD/EUR")]


def test_consensus_window(spark):
    rates = cons.union_sources([stg(spark, *[(FR, "EUR", d, 1.0) for d in range(1, 8)])])

    def days(*args):
        return [r.rate_date.day for r in cons.consensus_window(rates, *args).collect()]

    assert sorted(days("daily", "2024-01-05")) == [5]
    assert sorted(days("daily", "2024-01-05", 3)) == [2, 3, 4, 5]
    assert sorted(days("daily", "2024-01-05", 3, day("2024-01-07"))) == [4, 5]
    assert sorted(days("backfill", "2024-01-05")) == [5, 6, 7]


def picks(df):
    return {(r.target_currency, r.rate_date.day): (r.source, r.source_tier, r.exchange_rate)
            for r in df.collect()}


def test_priority_with_lineage(spark):
    staged = stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, 1.001), (ER, "GBP", 1, 2.0),
                 (CL, "GBP", 1, 2.001), (CL, "JPY", 1, 3.0))
    assert picks(fact.priority_pick(staged)) == {
        ("EUR", 1): (FR, "primary", 1.0), ("GBP", 1): (ER, "secondary", 2.0),
        ("JPY", 1): (CL, "tertiary", 3.0),
    }
    assert picks(fact.priority_pick(staged, CFG.by_priority("backfill"))) == {
        ("EUR", 1): (FR, "primary", 1.0), ("GBP", 1): (CL, "tertiary", 2.001),
        ("JPY", 1): (CL, "tertiary", 3.0),
    }


def test_flagged_keys_leave_the_fact(spark):
    staged = stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, 1.1), (FR, "EUR", 2, 1.0),
                 (ER, "GBP", 1, 2.0))
    built = fact.build_fact([staged], cons.build_consensus([staged]))
    assert built.schema.simpleString() == schemas.FACT.simpleString()
    assert set(picks(built)) == {("EUR", 2), ("GBP", 1)}
    first = built.first()
    assert (first.validation_status, first.severity, first.consensus_variance) == (
        "VALIDATED", "OK", 0.0)


def test_fused_form_equals_the_two_step_form(spark):
    staged = stg(
        spark, *[(s, t, d, 1.0 + 0.004 * i * (d % 3))
                 for i, s in enumerate((FR, ER, CL)) for t in ("EUR", "GBP") for d in range(1, 8)
                 if (i + d) % 4]
    )
    for used in (CFG.sources, CFG.by_priority("backfill")):
        two = fact.build_fact([staged], cons.build_consensus([staged]), sources=used)
        one = fact.validate_and_pick([staged], used=used)
        drop = ("dbt_loaded_at",)
        assert rows(one.drop(*drop)) == rows(two.drop(*drop))
        assert one.count() > 0


def test_fact_lookback(spark):
    staged = stg(spark, *[(FR, "EUR", d, 1.0) for d in range(1, 8)])
    daily = fact.fact_lookback(staged, "daily", newest_loaded=day("2024-01-06"))
    assert daily.count() == 5
    assert fact.fact_lookback(staged, "daily").count() == 7
    assert fact.fact_lookback(staged, "backfill", "2024-01-06").count() == 2


def test_latest_per_source_ignores_the_base(spark):
    usd = stg(spark, (FR, "EUR", 1, 1.0))
    eur = usd.withColumn("base_currency", staging.F.lit("EUR")).withColumn(
        "extraction_id", staging.F.lit("zzz"))
    both = usd.unionByName(eur)
    assert rows(fact.latest_per_source(both), "base_currency") == [("EUR",)]
    assert fact.key_universe(both).count() == 2
