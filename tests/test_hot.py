from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratelake.operators import hot
from ratelake.sources.hot_table import HotTable
from ratelake.sources.tables import RateTables

from .helpers import rows, series, ts

AS_OF = ts("2024-01-05T00:00:00")


@pytest.fixture
def items(spark):
    fact = series(spark, *[("EUR", f"2024-01-0{d}", 0.1 * d) for d in range(1, 7)],
                  ("GBP", "2024-01-01", 0.7)).withColumns(
        {"consensus_variance": F.lit(0.0),
         "currency_pair": F.concat_ws("/", "base_currency", "target_currency")})
    return hot.to_hot_items(fact, AS_OF)


def test_item_types(items):
    row = items.where("currency_pair = 'USD/GBP'").first()
    assert row.rate_date == "2024-01-01" and row.synced_at == AS_OF
    assert row.exchange_rate == Decimal("0.7") and row.consensus_variance == Decimal(0)
    assert "ttl" not in items.columns


def test_ttl_is_optional(spark, items):
    with_ttl = hot.to_hot_items(items, AS_OF, ttl_days=2)
    assert with_ttl.first().ttl == 1704412800 + 2 * 86_400


def test_last_write_wins(spark, root, items):
    store = RateTables(spark, root)
    store.upsert("hot", items, hot.HOT_KEYS, sort=hot.HOT_KEYS)
    again = items.where("rate_date = '2024-01-02'").withColumn(
        "exchange_rate", F.lit("9").cast("decimal(38,18)"))
    store.upsert("hot", again, hot.HOT_KEYS, sort=hot.HOT_KEYS)
    back = store.read("hot")
    assert back.count() == 7
    assert hot.hot_get(back, "USD/EUR", "2024-01-02").first().exchange_rate == Decimal(9)


def test_range_lookups(items):
    def days(*args, **kw):
        return [r.rate_date[-1] for r in hot.hot_query(items, *args, **kw).collect()]

    assert days("currency_pair", "USD/EUR", limit=2) == ["1", "2"]
    assert days("currency_pair", "USD/EUR", ascending=False, limit=2) == ["6", "5"]
    assert days("target_currency", "EUR", since="2024-01-03", until="2024-01-04") == ["3", "4"]
    with pytest.raises(ValueError):
        hot.hot_query(items, "region", "Europe")


def test_preview(items):
    assert [r.rate_date for r in hot.preview(items, 1, "rate_date").collect()] == ["2024-01-06"]
    assert len(rows(hot.preview(items, 3))) == 3


def test_lookups_open_the_slices_of_their_dates(spark, root):
    """A point get opens one slice, however often the same items were synced."""
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    items = spark.createDataFrame(
        [(f"USD/C{i:02d}", f"C{i:02d}", d, float(i)) for d in days for i in range(30)],
        "currency_pair string, target_currency string, rate_date string, exchange_rate double")
    table = HotTable(RateTables(spark, root), "items")
    for _ in range(2):
        table.sync(items)
    found = table.get("USD/C07", date(2024, 1, 3))
    assert [tuple(r) for r in found.collect()] == [("USD/C07", "C07", "2024-01-03", 7.0)]
    assert {f.split("_slice=")[1][:10] for f in found.inputFiles()} == {"2024-01-03"}
    some = table.lookup("target_currency", "C03", date(2024, 1, 2), date(2024, 1, 4))
    assert [r.rate_date for r in some.collect()] == days[1:4] and len(some.inputFiles()) == 3
    assert [r.rate_date for r in table.lookup("currency_pair", "USD/C01", ascending=False, limit=2).collect()] == days[:-3:-1]
