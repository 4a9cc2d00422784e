import json
from datetime import date

from ratelake import schemas
from ratelake.operators import normalize

from .helpers import ts

AT = ts("2024-02-03T14:30:22.123456")


def responses(spark, *items):
    rows = [
        (source, body if isinstance(body, (str, type(None))) else json.dumps(body), status, AT)
        for source, body, status in items
    ]
    return spark.createDataFrame(rows, schemas.RESPONSE)


def test_snapshot_fields_and_defaults(spark):
    df = normalize.normalize_snapshot(responses(
        spark,
        ("frankfurter", {"base": "USD", "date": "2024-02-02", "rates": {"EUR": 0.92, "JPY": 149}},
         200),
        ("frankfurter", {"date": "2024-02-02"}, 200),
        ("exchangerate", {"rates": {"GBP": 0.79}}, 200),
    ))
    full, bare, other = df.collect()
    assert full.extraction_id == "frankfurter_20240203_143022"
    assert full.rate_date == date(2024, 2, 2)
    assert full.rates == {"EUR": 0.92, "JPY": 149.0}
    assert full.source_tier == "primary" and full.base_currency == "USD"
    assert full.response_size_bytes == len(full.api_response_raw)
    assert bare.base_currency == "EUR" and bare.rates == {}
    assert other.base_currency == "USD" and other.source_tier == "secondary"
    assert other.rate_date == date(2024, 2, 3)
    assert df.schema.simpleString() == schemas.LANDED.simpleString()


def test_prefixed_quotes_and_epoch_date(spark):
    body = {"success": True, "timestamp": 1706832000, "source": "USD",
            "quotes": {"USDGBP": 0.72, "USDUSD": 1}}
    row = normalize.normalize_snapshot(responses(spark, ("currencylayer", body, 200))).first()
    assert row.rates == {"GBP": 0.72, "": 1.0}
    assert row.rate_date == date(2024, 2, 2)
    assert row.extraction_id == "cl_2024-02-02_USD_1706970622"


def test_range_gives_one_record_per_date(spark):
    fr = {"base": "USD", "start_date": "2024-01-01", "end_date": "2024-01-02",
          "rates": {"2024-01-01": {"EUR": 1}, "2024-01-02": {"EUR": 2, "GBP": 0.5}}}
    cl = {"success": True, "source": "USD", "quotes": {"2024-01-01": {"USDEUR": 3}}}
    df = normalize.explode_range(
        responses(spark, ("frankfurter", fr, 200), ("currencylayer", cl, 200))
    )
    got = {(r.source, r.extraction_id): (r.rate_date, r.rates) for r in df.collect()}
    assert got == {
        ("frankfurter", "fr_2024-01-01_USD_1706970622"): (date(2024, 1, 1), {"EUR": 1.0}),
        ("frankfurter", "fr_2024-01-02_USD_1706970622"):
            (date(2024, 1, 2), {"EUR": 2.0, "GBP": 0.5}),
        ("currencylayer", "cl_2024-01-01_USD_1706970622"): (date(2024, 1, 1), {"EUR": 3.0}),
    }


def test_classification(spark):
    df = normalize.classify_response(responses(
        spark,
        ("frankfurter", {"rates": {}}, 200),
        ("frankfurter", {"rates": {}}, 429),
        ("frankfurter", {"rates": {}}, 503),
        ("frankfurter", '{"rates": ', 200),
        ("frankfurter", None, 200),
        ("currencylayer", {"success": False, "error": {"code": 104}}, 200),
        ("currencylayer", {"success": False, "error": {"code": 101}}, 200),
        ("currencylayer", {"quotes": {}}, 200),
        ("currencylayer", {"success": True, "quotes": {}}, 200),
    ))
    assert [r.outcome for r in df.collect()] == [
        "OK", "THROTTLED", "ERROR", "ERROR", "ERROR", "THROTTLED", "ERROR", "ERROR", "OK",
    ]
    good, bad = normalize.split_responses(df.drop("outcome"))
    assert (good.count(), bad.count()) == (2, 7)


def test_flatten_map_needs_no_shuffle_when_codes_are_known(spark):
    df = spark.createDataFrame([("a", {"USD": 1.0, "EUR": 2.0}), ("b", {"EUR": 3.0})],
                               "extraction_id string, rates map<string,double>")
    flat = normalize.flatten_map(df, codes=["EUR", "USD"])
    assert flat.collect() == [("a", 2.0, 1.0), ("b", 3.0, None)]
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    assert normalize.flatten_map(df).columns == flat.columns
