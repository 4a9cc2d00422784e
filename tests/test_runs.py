from dataclasses import replace
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.config import EngineConfig
from ratelake.operators.normalize import flatten_map
from ratelake.plans.runs import CONSENSUS, FACT, HOT, ChecksFailed, RateJobs
from ratelake.sources import landing
from ratelake.sources.tables import RateTables
from ratelake.streaming.silver_stream import landing_stream, stream_land_to_silver

from .helpers import rows, silver_frame, silver_row, ts

DAYS = [date(2024, 1, 31), date(2024, 2, 1)]
CFG = EngineConfig()
BASE = {"frankfurter": 1.0, "exchangerate": 1.001, "currencylayer": 1.002}


def land(spark, root, days, change=None, only=None):
    """Every source quotes three currencies a day; ``change`` maps (source, day, ccy) to a rate.

    Daily files land on their day, the files of a backfill all on the newest one.
    """
    for source, factor in BASE.items():
        if only and source not in only:
            continue
        for mode in ("daily", "backfill"):
            records = []
            for d in days:
                rates = {c: v * factor for c, v in (("EUR", 0.9), ("GBP", 0.7), ("JPY", 150.0))}
                for c in list(rates):
                    rates[c] = (change or {}).get((source, d, c), rates[c])
                landed = d if mode == "daily" else DAYS[-1]
                records.append(silver_row(d.isoformat(), rates, source,
                                          extracted=f"{landed}T06:00:00"))
            wide = flatten_map(silver_frame(spark, *records), codes=["EUR", "GBP", "JPY"])
            landing.land_append(wide, f"{root}/landing/{source}", mode)


def jobs(spark, root, name="tables", **cfg):
    return RateJobs(spark, RateTables(spark, f"{root}/{name}"), f"{root}/landing",
                    EngineConfig(**cfg), as_of=ts("2024-02-01T12:00:00"))


def fact_rows(j, *columns):
    columns = columns or ("rate_date", "target_currency", "exchange_rate", "source")
    return rows(j.tables.read(FACT, schemas.FACT), *columns)


def test_days_one_by_one_equal_one_backfill(spark, root):
    outlier = {("currencylayer", DAYS[0], "GBP"): 0.9}
    land(spark, root, DAYS, outlier)
    daily = jobs(spark, root, "daily")
    for d in DAYS:
        assert daily.run_daily(d, include_third=True) == list(BASE)
    # A backfill uses the sources with history; let all of them have it here.
    everyone = tuple(replace(s, has_history=True) for s in CFG.sources)
    backfill = jobs(spark, root, "backfill", sources=everyone)
    backfill.participating = lambda *a: list(everyone)
    backfill.run_backfill(DAYS[0], DAYS[-1])
    assert fact_rows(daily) == fact_rows(backfill)
    assert len(fact_rows(daily)) == 5
    for table in (CONSENSUS, "mart_rate_analysis", "mart_latest_rates", "mart_monthly_summary",
                  "mart_rate_volatility", "mart_currency_conversions"):
        drop = "dbt_loaded_at"
        assert rows(daily.tables.read(table).drop(drop)) == rows(
            backfill.tables.read(table).drop(drop)), table

    # Every run synced the newest date of its day; GBP of the first day was flagged.
    assert rows(daily.tables.read(HOT), "rate_date", "target_currency") == [
        (d.isoformat(), c) for d in DAYS for c in ("EUR", "GBP", "JPY")
        if (d, c) != (DAYS[0], "GBP")]
    assert not backfill.tables.exists(HOT)
    health = daily.tables.read("mart_data_quality_metrics").first()
    assert (health.total_records, health.pipeline_status) == (5, "HEALTHY")
    assert all(r.failures == 0 for r in daily.checks().collect())


def test_corrections_reach_the_fact_within_the_lookback(spark, root):
    bad = {("currencylayer", DAYS[0], "GBP"): 0.9}
    land(spark, root, DAYS, bad)
    j = jobs(spark, root)
    j.run_daily(DAYS[0], include_third=True)
    assert ("GBP",) not in fact_rows(j, "target_currency")
    # The next day's file of that source also repeats the earlier day, corrected.
    fixed = silver_frame(spark, silver_row(DAYS[0].isoformat(), {"EUR": 0.9, "GBP": 0.7014,
                                                                 "JPY": 150.3},
                                           "currencylayer", extracted="2024-02-01T05:00:00"))
    landing.land_append(flatten_map(fixed), f"{root}/landing/currencylayer", "daily")
    j.run_daily(DAYS[1], include_third=True)
    assert (DAYS[0], "GBP") in fact_rows(j, "rate_date", "target_currency")
    assert j.tables.read(CONSENSUS).count() == 0


def test_gating_and_missing_sources(spark, root):
    land(spark, root, DAYS, only=("frankfurter", "currencylayer"))
    j = jobs(spark, root)
    used_up = spark.range(60).select(
        F.lit("exchangerate").alias("api_source"),
        F.lit("2024-01-29 00:00:00").cast("timestamp_ntz").alias("called_at"))
    assert [s.name for s in j.participating("daily", used_up, False)] == [
        "frankfurter", "currencylayer"]
    assert [s.name for s in j.participating("daily", None, False)] == [
        "frankfurter", "exchangerate"]
    # The second source has quota but nothing landed.
    assert j.run_daily(DAYS[0]) == ["frankfurter"]
    assert {r[0] for r in fact_rows(j, "source")} == {"frankfurter"}


def test_backfill_keeps_rows_only_a_daily_source_had(spark, root):
    land(spark, root, DAYS[:1])
    extra = silver_frame(spark, silver_row(DAYS[0].isoformat(), {"SEK": 10.0}, "exchangerate",
                                           extracted=f"{DAYS[0]}T07:00:00"))
    both = silver_frame(spark, silver_row(DAYS[0].isoformat(), {"SEK": 10.0, "EUR": 0.9009},
                                          "exchangerate", extracted=f"{DAYS[0]}T08:00:00"))
    for frame in (extra, both):
        landing.land_append(flatten_map(frame), f"{root}/landing/exchangerate", "daily")
    j = jobs(spark, root)
    j.run_daily(DAYS[0], include_third=True)
    before = fact_rows(j)
    assert (DAYS[0], "SEK", 10.0, "exchangerate") in before
    j.run_backfill(DAYS[0], DAYS[0] + timedelta(days=1))
    assert fact_rows(j) == before


def test_stream_and_batch_build_the_same_silver(spark, root):
    land(spark, root, DAYS[:2], only=("frankfurter",))
    tables = RateTables(spark, f"{root}/tables")

    def run():
        stream_land_to_silver(
            landing_stream(spark, f"{root}/landing/frankfurter/daily", files_per_trigger=1),
            tables, "frankfurter_rates", f"{root}/ckpt").awaitTermination()
        return rows(tables.read("frankfurter_rates"), "rate_date", "extraction_timestamp")

    first = run()
    assert [r[0] for r in first] == DAYS[:2]
    # An older extraction arrives late and must not win; a newer one does.
    for at, rate in (("01:00:00", 5.0), ("23:00:00", 0.5)):
        late = silver_frame(spark, silver_row(DAYS[0].isoformat(), {"EUR": rate},
                                              extracted=f"{DAYS[0]}T{at}"))
        landing.land_append(flatten_map(late), f"{root}/landing/frankfurter", "daily")
    run()
    got = {r.rate_date: r.rates for r in tables.read("frankfurter_rates").collect()}
    assert got[DAYS[0]] == {"EUR": 0.5} and len(got[DAYS[1]]) == 3


def test_failing_check_stops_the_run_before_the_marts(spark, root):
    land(spark, root, DAYS[:1], only=("frankfurter",))
    euro = silver_frame(spark, silver_row(DAYS[0].isoformat(), {"USD": 1.1}, base="EUR"))
    landing.land_append(flatten_map(euro), f"{root}/landing/frankfurter", "daily")
    j = jobs(spark, root)
    with pytest.raises(ChecksFailed, match="stg_frankfurter.base_currency accepted_values: 1"):
        j.run_daily(DAYS[0], require_checks=True)
    assert j.tables.exists(FACT) and not j.tables.exists("mart_latest_rates")
    nulls = j.null_rates(CFG.source("frankfurter"), "daily", DAYS[0])
    assert rows(nulls, "currency", "null_rows") == [("EUR", 1), ("GBP", 1), ("JPY", 1), ("USD", 1)]


def test_backfill_over_a_turn_of_the_year(spark, root):
    days = [date(2023, 11, 20), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 31)]
    for d in days:
        record = silver_row(d.isoformat(), {"EUR": 0.9}, extracted=f"{d}T06:00:00")
        landing.land_append(flatten_map(silver_frame(spark, record)),
                            f"{root}/landing/frankfurter", "backfill")
    j = jobs(spark, root)
    assert j.run_backfill(days[1], days[3]) == ["frankfurter"]
    assert [r[0] for r in fact_rows(j, "rate_date")] == days[1:]


def test_responses_land_or_are_kept(spark, root):
    ok = '{"base": "USD", "date": "2024-01-31", "rates": {"EUR": 0.9, "XYZ": null}}'
    bodies = [("frankfurter", ok, 200), ("frankfurter", ok, 429), ("frankfurter", "{", 200),
              ("frankfurter", None, None), ("other", ok, 200), (None, ok, 200),
              ("currencylayer", '{"success": false, "error": {"code": 104}}', 200)]
    responses = spark.createDataFrame(
        [(s, b, c, ts("2024-01-31T06:00:00")) for s, b, c in bodies],
        "source string, body string, http_status_code int, extraction_timestamp timestamp_ntz")
    j = jobs(spark, root)
    for _ in range(2):
        j.land(responses)
    kept = j.tables.read("quarantine_responses")
    assert sorted(r.outcome for r in kept.collect()) == [
        "ERROR", "ERROR", "THROTTLED", "THROTTLED", "UNKNOWN", "UNKNOWN"]
    assert j.run_daily(DAYS[0]) == ["frankfurter"]
    assert fact_rows(j, "target_currency", "exchange_rate") == [("EUR", 0.9)]
    assert j.rejected(CFG.source("frankfurter"), "daily", DAYS[0]).count() == 0


def test_landing_and_quarantine_add_up(spark, root):
    """Equal failures keep their number, a second delivery of the same batch changes nothing, and usable
    backfill responses without any date are kept."""
    at = ts("2024-01-31T06:00:00")
    full = '{"base": "USD", "rates": {"2024-01-30": {"EUR": 0.9}, "2024-01-31": {"EUR": 0.8}}}'
    bodies = [(full, 200)] + [("broken", 500)] * 3 + [('{"base": "USD", "rates": {}}', 200)] * 2 + [('{"base": "USD"}', 200)]
    responses = spark.createDataFrame(
        [("frankfurter", b, c, at) for b, c in bodies],
        "source string, body string, http_status_code int, extraction_timestamp timestamp_ntz")
    j = jobs(spark, root)
    j.land(responses, "backfill")
    j.land(responses.where("http_status_code = 500"), "backfill")
    kept = j.tables.read("quarantine_responses")
    assert sorted((r.outcome, r.responses) for r in kept.collect()) == [("EMPTY", 1), ("EMPTY", 2), ("ERROR", 3)]
    assert j.landed(CFG.source("frankfurter"), "backfill", DAYS[0]).count() == 2


def test_a_run_tells_what_became_of_the_lines(spark, root):
    land(spark, root, DAYS[:2], only=("frankfurter",))
    folder = next(Path(f"{root}/landing/frankfurter/daily").rglob("day=*"))
    lines = ["", "no json", '{"source": "other", "rate_date": "2024-01-31"}', '{"source": "frankfurter", "rate_date": "x"}',
             '{"source": "frankfurter", "rate_date": "2001-01-01", "rates__eur": 1}']
    (folder / "more.jsonl").write_text("\n".join(lines))
    j = jobs(spark, root)
    j.run_daily(DAYS[1])
    told = {r.counted: r["lines"] for r in j.load_report().where("source = 'frankfurter'").collect()}
    assert told == {"lines": 4 + 2, "bad_line": 1, "other_source": 1, "bad_date": 1, "bad_key": 0, "outside_window": 1, "records": 2}
    assert j.load_report().count() == 7
    j.run_daily(DAYS[1])
    assert j.load_report().count() == 7


def test_backfill_without_landing_is_an_empty_run(spark, root):
    j = jobs(spark, root)
    assert j.run_backfill(DAYS[0], DAYS[1]) == []
    assert fact_rows(j) == []
    with pytest.raises(LookupError):
        j.tables.read("mart_rate_volatility")
