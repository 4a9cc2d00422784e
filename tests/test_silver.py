from ratelake import schemas
from ratelake.operators import silver

from .helpers import rows, silver_frame, silver_row, ts


def test_true_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "rates__usd int, ratesXYeur int, other int")
    assert silver.discover_rate_columns(df) == ["rates__usd"]


def test_null_profile_covers_every_column(spark):
    columns = ", ".join(f"rates__c{i:02d} double" for i in range(30))
    df = spark.createDataFrame([tuple([None] * 30), tuple([1.0] * 29 + [None])], columns)
    got = {r.currency: (r.null_rows, r.total_rows) for r in silver.null_profile(df).collect()}
    assert len(got) == 30
    assert got["C00"] == (1, 2) and got["C29"] == (2, 2)
    assert silver.null_profile(df.select()).count() == 0


def test_rebuild_map_folds_variants_and_drops_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.5, None), ("b", None, 3.5, 7.0)],
        "extraction_id string, rates__usd int, rates__usd__v_double double, rates__eur double",
    )
    assert silver.rebuild_map(df).collect() == [("a", {"USD": 1.0}), ("b", {"USD": 3.5,
                                                                            "EUR": 7.0})]
    none = silver.rebuild_map(df.select("extraction_id"))
    assert [r.rates for r in none.collect()] == [{}, {}]


def test_date_windows(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    df = silver_frame(spark, *[silver_row(d, {"EUR": 1.0}) for d in days])
    daily = silver.date_window(df, "daily", "2024-01-05")
    assert [str(r.rate_date) for r in daily.collect()] == days[1:]
    backfill = silver.date_window(df, "backfill", "2024-01-05", "2024-01-07")
    assert [str(r.rate_date) for r in backfill.collect()] == days[4:7]


def test_bad_keys(spark):
    df = silver_frame(spark, silver_row("2024-01-01", {"": 1.0, "EUR": 2.0}),
                      silver_row("2024-01-02", {"EUR": 2.0}), silver_row("2024-01-03", None))
    assert silver.count_bad_maps(df).first()[0] == 1
    assert [r.rates for r in silver.clean_map_keys(df).collect()] == [{"EUR": 2.0}, {"EUR": 2.0},
                                                                      None]
    assert silver.drop_bad_rows(df).count() == 2


def test_dedup_is_independent_of_row_order(spark):
    items = [
        silver_row("2024-01-01", {"EUR": float(i)}, extracted=f"2024-01-01T0{i % 3}:00:00",
                   eid=f"id{i}")
        for i in range(9)
    ] + [silver_row("2024-01-01", {"EUR": 1.0}, base="EUR", eid="other")]
    forward = silver.dedup_latest(silver_frame(spark, *items))
    backward = silver.dedup_latest(silver_frame(spark, *reversed(items)).repartition(4))
    assert rows(forward) == rows(backward)
    assert rows(forward, "extraction_id") == [("id8",), ("other",)]


def test_missing_timestamps_lose(spark):
    a = silver_row("2024-01-01", {"EUR": 1.0}, eid="z")
    rows_ = [(a[0], None, *a[2:]), silver_row("2024-01-01", {"EUR": 2.0}, eid="a")]
    assert silver.dedup_latest(silver_frame(spark, *rows_)).first().extraction_id == "a"
    only = silver.dedup_latest(silver_frame(spark, rows_[0]))
    assert only.first().extraction_id == "z" and only.first().extraction_timestamp is None


def test_build_silver_types(spark):
    df = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0})).withColumn("extra",
                                                                               silver.F.lit(1))
    built = silver.build_silver(df, "daily", "2024-01-01")
    assert built.columns == [*schemas.SILVER.fieldNames(), "extra"]
    assert built.first().extraction_timestamp == ts("2024-01-01T06:00:00")


def test_evolve_union(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    assert silver.evolve_union(old, new).collect() == [(1, None), (2, "x")]
