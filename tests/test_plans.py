"""The physical plans: what reaches the scan, what is reduced before a shuffle, what never runs."""

import pytest
from pyspark.sql import functions as F

from ratelake.operators import consensus as cons
from ratelake.operators import fact, quota, ranking, staging
from ratelake.plans import catalog, views
from ratelake.sources.tables import RateTables

from .conftest import SF
from .helpers import day, silver_frame, silver_row


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchange(text, node):
    """True if ``node`` occurs beneath the first shuffle."""
    return node in text.split("Exchange", 1)[1]


@pytest.fixture
def quotes(spark):
    return views.fx_quotes(spark, SF)


def test_dedup_reduces_before_the_shuffle(quotes):
    text = plan(staging.dedup_pair(quotes))
    assert text.count("Exchange") == 1 and below_exchange(text, "partial_max_by")


def test_first_per_key_limits_before_the_shuffle(quotes):
    text = plan(ranking.first_per_key(quotes, ["source"], ranking.newest_order(), 30))
    assert text.count("Exchange") == 1 and below_exchange(text, "WindowGroupLimit")


def test_hot_key_leaves_a_row_per_task(spark):
    """A third of the rows share one key; the reducer still gets one row per map task."""
    n, tasks = 60_000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    reduced = ranking.newest_per_key(df, ["k"], "ts", "v")
    assert reduced.where("k = 'hot'").first().v == n - 3
    shuffle = reduced._jdf.queryExecution().executedPlan()
    reduced.collect()
    hot = df.groupBy(F.spark_partition_id(), "k").count().where("k = 'hot'")
    assert hot.count() == tasks
    assert "partial_max_by" in shuffle.toString()


def test_consensus_is_one_hash_aggregation(spark, quotes):
    rates = cons.union_sources([staging.project_staging(staging.positive_rates(quotes))])
    text = plan(cons.build_consensus([staging.project_staging(staging.positive_rates(quotes))]))
    assert text.count("Exchange") == 1 and "HashAggregate" in text
    assert "SortAggregate" not in text and "Join" not in text
    assert below_exchange(plan(cons.pivot_rates(rates)), "partial_max")


def test_fused_fact_reads_staging_once(quotes):
    staged = staging.project_staging(staging.positive_rates(quotes))
    text = plan(fact.validate_and_pick([staged]))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange") == 1


def test_windows_share_one_shuffle_and_sort(spark):
    series = spark.range(10).selectExpr("date_add(date'2024-01-01', cast(id as int)) rate_date",
                                        "'EUR' target_currency", "1.0D + id exchange_rate")
    from ratelake.operators.marts import volatility_metrics
    text = plan(volatility_metrics(series))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_date_filter_reaches_the_files(spark, root):
    store = RateTables(spark, root)
    store.upsert("t", silver_frame(spark, silver_row("2023-12-31", {"EUR": 1.0}),
                                   silver_row("2024-02-01", {"EUR": 1.0})),
                 ("rate_date", "source", "base_currency"))
    df = store.read("t", since=day("2024-01-15")).select("rate_date")
    text = plan(df)
    assert "GreaterThanOrEqual(rate_date,2024-01-15)" in text
    assert "ReadSchema: struct<rate_date:date>" in text
    assert all("2024-02" in f for f in df.inputFiles())


def test_busy_seconds_reduce_to_bitmaps_before_the_shuffle(spark):
    text = plan(quota.busy_seconds(quota.per_second(views.fx_calls(spark, SF))))
    assert below_exchange(text, "Exchange") and "partial_bitmap_construct_agg" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


@pytest.mark.parametrize("name", [
    "mart_cross_rates", "mart_health", "mart_latest_rates", "mart_risk_level", "fact_full",
    "fact_fused", "hot_latest_slice", "dq_declared_suites", "source_gating", "quota_usage"])
def test_no_cross_join(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_hot_lookups_reach_the_scan(spark):
    for name, key in (("hot_get", "USD/C07"), ("hot_lookup_by_target", "C03")):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
        assert any(f",{key})" in line for line in pushed), name


def test_declared_checks_read_each_table_once(spark, quotes):
    from ratelake.config import DEFAULT_SOURCES
    from ratelake.operators import dq

    rows = staging.stage_quotes(quotes, ("source", "base_currency", "target_currency", "rate_date"))
    text = plan(dq.staging_suites(rows.withColumn("table", F.col("source")), DEFAULT_SOURCES))
    assert text.count("FileScan") == 1
