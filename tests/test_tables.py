from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratelake.operators.ranking import newest_order
from ratelake.sources import tables
from ratelake.sources.tables import RateTables

from .helpers import day, rows, silver_frame, silver_row

KEYS = ("rate_date", "source", "base_currency")


@pytest.fixture
def store(spark, root):
    return RateTables(spark, root)


def rate(df):
    return {str(r.rate_date): r.rates["EUR"] for r in df.collect()}


def test_upsert_replaces_matched_and_appends(spark, store):
    store.upsert("t", silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}),
                                   silver_row("2024-02-01", {"EUR": 2.0})), KEYS)
    batch = silver_frame(spark, silver_row("2024-02-01", {"EUR": 9.0}),
                         silver_row("2024-03-01", {"EUR": 3.0}))
    store.upsert("t", batch, KEYS)
    want = {"2024-01-01": 1.0, "2024-02-01": 9.0, "2024-03-01": 3.0}
    assert rate(store.read("t")) == want
    store.upsert("t", batch, KEYS)
    assert rate(store.read("t")) == want
    assert store.newest_date("t") == day("2024-03-01")


def parts(root, table):
    """Data files by slice."""
    return {d.name[len("_slice="):]: sorted(f.name for f in d.glob("*.parquet"))
            for d in Path(root, table).glob("_slice=*")}


def test_a_day_rewrites_a_day(spark, store, root):
    store.upsert("t", silver_frame(spark, silver_row("2024-02-01", {"EUR": 1.0}),
                                   silver_row("2024-02-02", {"EUR": 2.0})), KEYS)
    before = parts(root, "t")
    store.upsert("t", silver_frame(spark, silver_row("2024-02-02", {"EUR": 3.0}),
                                   silver_row("2024-02-03", {"EUR": 3.0})), KEYS)
    after = parts(root, "t")
    assert after["2024-02-01"] == before["2024-02-01"]
    assert not set(after["2024-02-02"]) & set(before["2024-02-02"])
    assert rate(store.read("t")) == {"2024-02-01": 1.0, "2024-02-02": 3.0, "2024-02-03": 3.0}


def test_nothing_superseded_is_left(spark, store, root):
    for n in range(4):
        store.upsert("t", silver_frame(spark, silver_row("2024-02-01", {"EUR": float(n)})), KEYS)
        assert len(list(Path(root).rglob("*.parquet"))) == 1
    store.upsert("t", silver_frame(spark), KEYS, replace_from=day("2024-02-01"))
    assert not list(Path(root).rglob("*.parquet"))
    assert sorted(p.name for p in Path(root, "t").iterdir() if p.name[0] not in "._") == []


@pytest.mark.parametrize("grain, slices", [("day", 3), ("month", 2)])
def test_grain_of_slices(spark, store, grain, slices):
    days = ["2024-01-30", "2024-01-31", "2024-02-01"]
    batch = silver_frame(spark, *[silver_row(d, {"EUR": 1.0}) for d in days])
    store.upsert("t", batch, KEYS, grain=grain)
    assert len(store.slices("t")) == slices
    assert rate(store.read("t", since=day("2024-01-31"))) == dict.fromkeys(days[1:], 1.0)


def test_null_keys_are_matched(spark, store):
    row = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0})).withColumn(
        "base_currency", F.lit(None).cast("string"))
    undated = row.withColumn("rate_date", F.lit(None).cast("date"))
    for _ in range(3):
        store.upsert("t", row.unionByName(undated), KEYS)
    assert store.read("t").count() == 2


def test_refused_batches(spark, store):
    one = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}))
    with pytest.raises(ValueError, match="twice"):
        store.upsert("t", one.unionByName(one), KEYS)
    with pytest.raises(ValueError, match="rate_date"):
        store.upsert("t", one, ("source", "base_currency"))
    assert not store.exists("t")


def test_a_batch_may_come_from_the_table_itself(spark, store):
    store.upsert("t", silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}),
                                   silver_row("2024-01-02", {"EUR": 2.0})), KEYS, grain="month")
    again = store.read("t").where("rate_date = DATE '2024-01-01'")
    store.upsert("t", again, KEYS, grain="month")
    store.overwrite("t", store.read("t"), "rate_date")
    assert rate(store.read("t")) == {"2024-01-01": 1.0, "2024-01-02": 2.0}


def test_failed_write_changes_nothing(spark, store):
    store.upsert("t", silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0})), KEYS)
    broken = silver_frame(spark, silver_row("2024-01-01", {"EUR": 5.0})).withColumn(
        "source", F.when(F.col("http_status_code") == 200, F.raise_error("lost")).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        store.upsert("t", broken, KEYS)
    assert rate(store.read("t")) == {"2024-01-01": 1.0}


def test_new_columns_are_added(spark, store):
    first = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}),
                         silver_row("2024-02-01", {"EUR": 1.0}))
    store.upsert("t", first, KEYS)
    wider = silver_frame(spark, silver_row("2024-02-02", {"EUR": 1.0})).withColumn("note",
                                                                                 F.lit("n"))
    store.upsert("t", wider, KEYS)
    got = {str(r.rate_date): r.note for r in store.read("t").collect()}
    assert got == {"2024-01-01": None, "2024-02-01": None, "2024-02-02": "n"}
    narrow = silver_frame(spark, silver_row("2024-02-03", {"EUR": 1.0}))
    store.upsert("t", narrow, KEYS)
    assert store.read("t").columns[-1] == "note" and store.read("t").count() == 4


def test_replace_range_removes_rows_the_batch_lacks(spark, store):
    days = ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]
    store.upsert("t", silver_frame(spark, *[silver_row(d, {"EUR": 1.0}) for d in days]), KEYS)
    store.upsert("t", silver_frame(spark, silver_row("2024-01-31", {"EUR": 7.0})), KEYS,
                 replace_from=day("2024-01-31"), replace_until=day("2024-02-01"))
    assert rate(store.read("t")) == {"2024-01-30": 1.0, "2024-01-31": 7.0, "2024-02-02": 1.0}
    store.upsert("t", silver_frame(spark), KEYS, replace_from=day("2024-01-01"))
    assert store.read("t").count() == 0 and store.newest_date("t") is None


def test_order_makes_arrival_irrelevant(spark, store):
    late = silver_frame(spark, silver_row("2024-01-01", {"EUR": 2.0},
                                          extracted="2024-01-01T09:00:00"))
    early = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0},
                                           extracted="2024-01-01T03:00:00"))
    store.upsert("t", late, KEYS, order=newest_order())
    store.upsert("t", early, KEYS, order=newest_order())
    assert rate(store.read("t")) == {"2024-01-01": 2.0}


def test_empty_first_batch_creates_the_table(spark, store):
    with pytest.raises(LookupError):
        store.read("t")
    store.upsert("t", silver_frame(spark), KEYS)
    assert store.exists("t") and store.read("t").count() == 0
    store.upsert("t", silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0})), KEYS)
    assert rate(store.read("t")) == {"2024-01-01": 1.0}


def test_reads_open_only_the_months_in_range(spark, store):
    days = ["2023-12-31", "2024-01-15", "2024-02-01"]
    store.upsert("t", silver_frame(spark, *[silver_row(d, {"EUR": 1.0}) for d in days]), KEYS)
    january = store.read("t", since=day("2024-01-02"), until=day("2024-01-31"))
    assert rate(january) == {"2024-01-15": 1.0}
    assert all("2024-01" in f for f in january.inputFiles())


def test_overwrite_drops_old_slices(spark, store):
    store.overwrite("t", silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}),
                                      silver_row("2024-02-01", {"EUR": 1.0})), "rate_date")
    store.overwrite("t", silver_frame(spark, silver_row("2024-02-01", {"EUR": 4.0})), "rate_date")
    assert rate(store.read("t")) == {"2024-02-01": 4.0}


def test_overwrite_with_nothing_empties_the_table(spark, store):
    frame = silver_frame(spark, silver_row("2024-01-01", {"EUR": 1.0}))
    for date_col in ("rate_date", None):
        store.overwrite("t", frame, date_col)
        store.overwrite("t", frame.limit(0), date_col)
        assert store.read("t").count() == 0 and store.exists("t")


def test_the_batch_is_computed_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = silver_frame(spark, *[silver_row(f"2024-01-{d:02d}", {"EUR": 1.0}) for d in range(1, 9)])
    store.upsert("t", batch, KEYS)
    store.upsert("t", batch.mapInArrow(count, batch.schema), KEYS)
    assert seen.value == 8 and store.read("t").count() == 8
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_edge_months_keep_their_other_days(spark, store):
    days = ["2024-01-30", "2024-02-10", "2024-03-01", "2024-03-02"]
    store.upsert("t", silver_frame(spark, *[silver_row(d, {"EUR": 1.0}) for d in days]), KEYS,
                 grain="month")
    store.upsert("t", silver_frame(spark, silver_row("2024-01-31", {"EUR": 5.0})), KEYS, grain="month",
                 replace_from=day("2024-01-31"), replace_until=day("2024-03-01"))
    assert rate(store.read("t")) == {"2024-01-30": 1.0, "2024-01-31": 5.0, "2024-03-02": 1.0}
    assert store.slices("t") == ["2024-01", "2024-03"]


@pytest.mark.parametrize("name, since, until, all_inside", [
    ("2024-02", "2024-02-01", "2024-02-29", True), ("2024-02", "2024-02-01", "2024-02-28", False),
    ("2024-02", "2024-02-02", None, False), ("2024-02-03", "2024-02-03", None, True),
    ("none", "2024-01-01", None, False), ("all", "2024-01-01", None, False),
])
def test_covered(name, since, until, all_inside):
    assert tables.covered(name, day(since), until and day(until)) is all_inside
