import gzip
import json
import os
from datetime import date

import pytest

from ratelake import schemas
from ratelake.operators import silver, staging
from ratelake.operators.normalize import flatten_map
from ratelake.sources import landing, seeds
from ratelake.sources.landing import DATED_FILES, PARTITIONED

from .helpers import rows, silver_frame, silver_row


def put(root, relative, *records):
    path = os.path.join(root, relative)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def record(day="2024-03-05", **rates):
    return {"extraction_id": f"x{day}", "extraction_timestamp": f"{day}T06:00:00.5",
            "source": "frankfurter", "source_tier": "primary", "base_currency": "USD",
            "rate_date": day, "http_status_code": 200, **rates}


def test_daily_reads_its_lookback_days(spark, root):
    for d in ("02", "04", "05", "06"):
        put(root, f"daily/2024/03/2024_03_{d}_a.jsonl.gz", record(f"2024-03-{d}", rates__eur=0.9))
    put(root, "backfill/2024/03/2024_03_05_a.jsonl", record("2024-03-05", rates__eur=9.0))

    def days(lookback):
        scan = landing.resolve_landing(spark, root, "daily", date(2024, 3, 5), DATED_FILES, lookback)
        lines = landing.scan_lines(spark, scan)
        assert all("/daily/" in f for f in lines.inputFiles())
        return [r[0].day for r in rows(silver.records_from_json_lines(lines), "rate_date")]

    assert days(0) == [5] and days(2) == [4, 5] and days(3) == [2, 4, 5]


def test_a_missing_day_is_no_reason_to_read_the_backfill(spark, root):
    put(root, "daily/2024/03/2024_03_06_a.jsonl", record("2024-03-06", rates__eur=0.8))
    put(root, "backfill/2024/03/2024_03_05_a.jsonl", record("2024-03-05", rates__eur=0.8))
    with pytest.raises(landing.NoLandingData):
        landing.resolve_landing(spark, root, "daily", date(2024, 3, 5), DATED_FILES, 3)


@pytest.mark.parametrize("layout, place", [
    (DATED_FILES, "backfill/{y}/{m}/{y}_{m}_{d}_a.jsonl"),
    (PARTITIONED, "backfill/year={y}/month={m}/day={d}/part-0.json.gz")])
def test_backfill_reads_every_month_since_its_start(spark, root, layout, place):
    with pytest.raises(landing.NoLandingData):
        landing.resolve_landing(spark, root, "backfill", date(2023, 12, 5), layout)
    for day in ("2023-11-30", "2023-12-20", "2024-01-10", "2024-02-01", "2024-03-09"):
        y, m, d = day.split("-")
        put(root, place.format(y=y, m=m, d=d), record(day, rates__eur=1))
    scan = landing.resolve_landing(spark, root, "backfill", date(2023, 12, 5), layout)
    found = landing.scan_lines(spark, scan)
    assert len({r[0] for r in rows(found, "filename")}) == 4
    assert found.where("filename LIKE '%11%30%'").count() == 0
    with pytest.raises(ValueError):
        landing.resolve_landing(spark, root, "hourly", date(2024, 1, 1), layout)


def test_rejected_lines_are_counted(spark):
    lines = spark.createDataFrame([
        (json.dumps(record(rates__eur=1)),), ("not json",), ("[1]",), ("",),
        (json.dumps({**record(rates__eur=1), "source": None}),),
        (json.dumps({**record(rates__eur=1), "source": "other"}),),
        (json.dumps({**record(rates__eur=1), "rate_date": "soon"}),),
        (json.dumps(record(rates__=1)),)], "value string")
    got = rows(silver.rejected_lines(lines, "frankfurter"), "reason", "rows")
    assert got == [("bad_date", 1), ("bad_key", 1), ("bad_line", 2), ("other_source", 2)]


def test_recursive_root_reads_all_levels(spark, root):
    put(root, "backfill/2020/07/a.jsonl", record("2020-07-01", rates__eur=1))
    put(root, "backfill/2021/a.jsonl.gz", record("2021-07-01", rates__eur=2))
    put(root, "backfill/2021/notes.txt", record("2022-07-01", rates__eur=3))
    scan = landing.resolve_landing(spark, root, "backfill", date(2020, 7, 1), DATED_FILES)
    records = silver.records_from_json_lines(landing.scan_lines(spark, scan))
    assert rows(records, "rate_date") == [(date(2020, 7, 1),), (date(2021, 7, 1),)]


def test_lines_parse_without_inference(spark):
    lines = spark.createDataFrame(
        [
            (json.dumps(record(rates__eur=1, rates__usd__v_double=1.5, rates__gbp=None,
                               ratesXYjpy=9)),),
            (json.dumps(record(rates={"EUR": 2, "GBP": "0.5", "BAD": "x"})),),
            ("not json",),
            (json.dumps(record(rates__usd=1, rates__usd__v_double=2)),),
        ],
        "value string",
    )
    got = [r.rates for r in silver.records_from_json_lines(lines).collect()]
    assert got == [{"EUR": 1.0, "USD": 1.5}, {"EUR": 2.0, "GBP": 0.5}, {"USD": 1.0}]


def test_null_profile_of_lines(spark):
    lines = spark.createDataFrame(
        [(json.dumps(record(rates__eur=1, rates__usd__v_double=1.5)),),
         (json.dumps(record(rates__eur=None, rates__usd=2, rates__usd__v_double=2)),),
         (json.dumps(record(rates__eur=3, rates__gbp=None)),), ("not json",)], "value string")
    got = rows(silver.null_profile_of_lines(lines), "currency", "null_rows", "total_rows")
    assert got == [("EUR", 1, 3), ("GBP", 3, 3), ("USD", 1, 3)]


def test_land_append_round_trip(spark, root):
    maps = silver_frame(
        spark,
        silver_row("2024-03-05", {"EUR": 0.9, "GBP": 0.7}, extracted="2024-03-05T06:00:00.123456"),
        silver_row("2024-03-06", {"EUR": 0.8}),
    )
    landing.land_append(flatten_map(maps), root, "daily")
    landing.land_append(flatten_map(maps), root, "daily")
    folder = f"{root}/daily/year=2024/month=03/day=05"
    assert all(f.endswith(".json.gz") for f in os.listdir(folder) if not f.startswith((".", "_")))
    scan = landing.resolve_landing(spark, root, "daily", date(2024, 3, 5), PARTITIONED)
    back = silver.records_from_json_lines(landing.scan_lines(spark, scan))
    mine = maps.where("rate_date = '2024-03-05'")
    assert rows(back) == rows(mine.unionByName(mine))
    wide = landing.scan_jsonl_union(spark, f"{root}/daily", recursive=True)
    assert {"rates__eur", "rates__gbp", "filename"} <= set(wide.columns)
    assert wide.count() == 4
    assert staging.unnest_rates(silver.rebuild_map(wide)).count() == 6


def test_scan_or_empty(spark, root):
    schema = "source string, rate_date string"
    assert landing.scan_or_empty(spark, f"{root}/none/*", schema).columns == ["source",
                                                                             "rate_date"]
    put(root, "old/a.jsonl", record(rates__eur=1))
    shaped = landing.scan_or_empty(spark, f"{root}/none/*", schema, history=f"{root}/old/*")
    assert shaped.count() == 0 and "rates__eur" in shaped.columns
    assert landing.scan_or_empty(spark, f"{root}/old/*", schema).collect() == [
        ("frankfurter", "2024-03-05")
    ]


def test_seed(spark, root):
    seed = seeds.default_seed(spark)
    assert seed.count() == 34
    seed.coalesce(1).write.csv(f"{root}/seed", header=True)
    again = seeds.scan_seed_csv(spark, f"{root}/seed")
    assert rows(again) == rows(seed)
    assert again.schema.simpleString() == schemas.DIMENSION.simpleString()


def test_backfills_lie_by_month_and_early_months_are_not_opened(spark, root):
    days = ["2023-11-30", "2024-01-02", "2024-01-31", "2024-02-10"]
    batch = silver_frame(spark, *[silver_row(d, {"EUR": 1.0}, extracted=f"{d}T00:00:00") for d in days])
    landing.land_append(flatten_map(batch), root, "backfill")
    assert len({f.rsplit("/", 1)[0] for f in landing.scan_lines(spark, landing.LandingScan((f"{root}/backfill",), "*.json*")).inputFiles()}) == 3
    scan = landing.resolve_landing(spark, root, "backfill", date(2024, 1, 20))
    assert landing.scan_lines(spark, scan).count() == 3
    assert landing.scan_lines(spark, landing.resolve_landing(spark, root, "backfill", date(2024, 2, 3))).count() == 1
