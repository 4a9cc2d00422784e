"""Dimension and marts over the validated fact.

The fact holds one row per (date, base, target).  A window partition below is one currency's
history and so at most 366 rows a year, whatever the volume of quotes behind it; partitions grow
in number with the currencies, not in size.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.config import TOP_CURRENCIES
from ratelake.functions.columns import hours_between
from ratelake.operators.ranking import first_per_key

PAIR = ("base_currency", "target_currency")
LONGEST_WINDOW = 30


# Presentation order of each mart: (column, descending).  Stored marts are left unsorted; a
# global sort is a range shuffle that only a reader of the whole table benefits from.
ORDERS = {
    "mart_latest_rates": (("rate_date", True), ("region", False), ("target_currency", False)),
    "mart_rate_analysis": (
        ("base_currency", False), ("target_currency", False), ("rate_date", True),
    ),
    "mart_currency_conversions": (("from_currency", False), ("to_currency", False)),
    "mart_monthly_summary": (("month", True), ("target_currency", False)),
    "mart_rate_volatility": (("rate_date", True), ("target_currency", False)),
}


def in_order(df: DataFrame, mart: str) -> DataFrame:
    """A mart in its presentation order, NULLs last."""
    return df.orderBy(
        *[
            F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last()
            for c, down in ORDERS[mart]
        ]
    )


def newest_date(fact: DataFrame) -> Column:
    """The newest fact date as an uncorrelated scalar subquery."""
    return fact.agg(F.max("rate_date")).scalar()


def _date_or_newest(fact: DataFrame, day: Column | date | None) -> Column:
    if day is None:
        return newest_date(fact)
    return day if isinstance(day, Column) else F.lit(day)


def dim_countries(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.upper("country_code").alias("country_code"),
        "country_name",
        F.upper("currency_code").alias("currency_code"),
        "region",
    )


def with_country(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Country columns on the currency code.

    The dimension is tiny and Spark broadcasts it after checking its size; no hint forces it.
    """
    d = dim.select(F.col("currency_code").alias("target_currency"), "country_name", "region")
    return fact.join(d, "target_currency", "left")


def mart_latest_rates(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """All dates with country context.  Row-local, so it can be refreshed by date slice."""
    return with_country(fact, dim).select(
        "rate_date", "base_currency", "target_currency", "country_name", "region",
        "exchange_rate", "inverse_rate", "consensus_variance", "validation_status", "severity",
    )


def hot_latest_slice(
    fact: DataFrame, dim: DataFrame, newest: Column | date | None = None
) -> DataFrame:
    """Rows of the newest date with country columns and the pair.

    A caller that knows the newest date passes it and saves the subquery that looks it up.
    """
    newest = fact.where(F.col("rate_date") == _date_or_newest(fact, newest))
    return with_country(newest, dim).select(
        "rate_date", "base_currency", "target_currency", "country_name", "region",
        "exchange_rate", "inverse_rate", "consensus_variance", "validation_status",
        F.concat_ws("/", "base_currency", "target_currency").alias("currency_pair"),
    )


def rate_analysis(fact: DataFrame, window_rows: int = 7) -> DataFrame:
    """Trailing mean over ``window_rows`` rows and change against the previous row, per pair."""
    history = Window.partitionBy(*PAIR).orderBy("rate_date")
    return fact.select(
        "rate_date",
        *PAIR,
        "exchange_rate",
        F.avg("exchange_rate").over(history.rowsBetween(1 - window_rows, 0)).alias("ma_7_day"),
        (F.col("exchange_rate") - F.lag("exchange_rate").over(history)).alias("daily_change"),
    )


def rate_analysis_incremental(
    fact: DataFrame,
    mode: str,
    execution_date: str | date | None = None,
    newest_loaded: date | None = None,
    window_rows: int = 7,
) -> DataFrame:
    """Rows from the mart's newest date (daily) or the execution date (backfill) on.

    The windows count rows, so each pair is led in by the rows it had last before that date, however
    far back they lie.  They are picked by a ranked limit that runs ahead of the shuffle.
    """
    since = newest_loaded if mode == "daily" else (execution_date or "1970-01-01")
    if since is None:
        return rate_analysis(fact, window_rows)
    start = F.lit(since).cast("date")
    slim = fact.select("rate_date", *PAIR, "exchange_rate")
    lead_in = first_per_key(
        slim.where(F.col("rate_date") < start),
        PAIR,
        [F.col("rate_date").desc()],
        max(1, window_rows - 1),
    )
    recent = slim.where(F.col("rate_date") >= start).unionByName(lead_in)
    return rate_analysis(recent, window_rows).where(F.col("rate_date") >= start)


def cross_rates(
    fact: DataFrame,
    currencies: Sequence[str] = TOP_CURRENCIES,
    as_of: datetime | None = None,
    newest: Column | date | None = None,
) -> DataFrame:
    """Conversion matrix of a fixed currency list on the newest date.

    One aggregation folds the date into a row with a column per listed currency; two explodes of
    that row give the ordered pairs.  The size is set by the list, and nothing is joined.
    ``exchange_rate`` is from/to as quoted in the fact (units of FROM per unit of TO);
    ``convert_multiplier`` turns an amount in FROM into TO.
    """
    listed = fact.where(
        (F.col("rate_date") == _date_or_newest(fact, newest))
        & F.col("target_currency").isin(*currencies)
    )
    one_row = listed.groupBy("rate_date").agg(
        *[
            F.max(F.when(F.col("target_currency") == c, F.col("exchange_rate"))).alias(f"c{i}")
            for i, c in enumerate(currencies)
        ]
    )
    quoted = F.filter(
        F.array(
            *[
                F.struct(F.lit(c).alias("code"), F.col(f"c{i}").alias("rate"))
                for i, c in enumerate(currencies)
            ]
        ),
        lambda q: q["rate"].isNotNull(),
    )
    pairs = (
        one_row.select("rate_date", quoted.alias("q"))
        .select("rate_date", "q", F.explode("q").alias("f"))
        .select("rate_date", "f", F.explode("q").alias("t"))
        .where(F.col("f.code") != F.col("t.code"))
    )
    loaded = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return pairs.select(
        "rate_date",
        F.col("f.code").alias("from_currency"),
        F.col("t.code").alias("to_currency"),
        F.concat_ws("/", "f.code", "t.code").alias("currency_pair"),
        F.try_divide(F.col("f.rate"), F.col("t.rate")).alias("exchange_rate"),
        F.try_divide(F.col("t.rate"), F.col("f.rate")).alias("inverse_rate"),
        F.try_divide(F.col("t.rate"), F.col("f.rate")).alias("convert_multiplier"),
        loaded.cast("timestamp").alias("dbt_loaded_at"),
    )


def monthly_summary(
    fact: DataFrame, as_of: Column | date | None = None, months: int = 24
) -> DataFrame:
    """Monthly statistics per currency, opening and closing rate included, in one aggregation."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    first = F.trunc(F.add_months(as_of.cast("date"), -months), "month")
    rate = F.col("exchange_rate")
    grouped = (
        fact.where(F.col("rate_date") >= first)
        .groupBy(F.trunc("rate_date", "month").alias("month"), "target_currency")
        .agg(
            F.count(F.lit(1)).alias("sample_count"),
            F.min(rate).alias("min_rate"),
            F.max(rate).alias("max_rate"),
            F.avg(rate).alias("avg_rate"),
            F.median(rate).alias("median_rate"),
            F.stddev_samp(rate).alias("stddev_rate"),
            F.min_by(rate, "rate_date").alias("opening_rate"),
            F.max_by(rate, "rate_date").alias("closing_rate"),
        )
    )
    return grouped.select(
        "month",
        F.year("month").alias("year"),
        F.month("month").alias("month_num"),
        "target_currency",
        "sample_count",
        "min_rate",
        "max_rate",
        "avg_rate",
        "median_rate",
        "stddev_rate",
        F.try_divide(F.col("max_rate") - F.col("min_rate"), F.col("avg_rate")).alias(
            "volatility_pct"
        ),
        "opening_rate",
        "closing_rate",
    )


def volatility_metrics(fact: DataFrame) -> DataFrame:
    """Relative change against 1, 7 and 30 rows back, rolling deviation over 7 and 30 rows.

    All expressions share one partitioning and order, hence one shuffle and one sort.
    """
    history = Window.partitionBy("target_currency").orderBy("rate_date")
    rate = F.col("exchange_rate")

    def change(rows: int) -> Column:
        before = F.lag("exchange_rate", rows).over(history)
        return F.try_divide(rate - before, before)

    return fact.select(
        "rate_date",
        "target_currency",
        "exchange_rate",
        change(1).alias("daily_change_pct"),
        change(7).alias("change_7d_pct"),
        change(30).alias("change_30d_pct"),
        F.stddev_samp(rate).over(history.rowsBetween(-6, 0)).alias("volatility_7d"),
        F.stddev_samp(rate).over(history.rowsBetween(-29, 0)).alias("volatility_30d"),
    )


def risk_level() -> Column:
    day, week = F.abs("daily_change_pct"), F.abs("change_7d_pct")
    return (
        F.when((day > 0.02) | (week > 0.05), "HIGH_RISK")
        .when((day > 0.01) | (week > 0.03), "MEDIUM_RISK")
        .otherwise("STABLE")
    )


def rate_volatility(
    fact: DataFrame, as_of: Column | date | None = None, days: int = 90
) -> DataFrame:
    """Metrics and risk level of the last ``days`` days.

    The windows look at most ``LONGEST_WINDOW`` rows back, so besides the reported days only that
    many earlier rows per currency are needed.  They are picked by a ranked limit that runs ahead
    of the shuffle; the rest of the history is scanned (three columns) but never moved.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    since = F.date_sub(as_of.cast("date"), days)
    slim = fact.select("rate_date", "target_currency", "exchange_rate")
    lead_in = first_per_key(
        slim.where(F.col("rate_date") < since),
        ["target_currency"],
        [F.col("rate_date").desc()],
        LONGEST_WINDOW,
    )
    recent = slim.where(F.col("rate_date") >= since)
    return (
        volatility_metrics(recent.unionByName(lead_in))
        .where(F.col("rate_date") >= since)
        .withColumn("risk_level", risk_level())
    )


def health_metrics(
    fact: DataFrame,
    consensus: DataFrame,
    as_of: Column | datetime,
    first_dev: str = "frank_dev",
    no_data_status: bool = False,
) -> DataFrame:
    """One row on freshness, volume, validation and flagged share of the newest date.

    The fact is read once: it is reduced to (date, currency), then grouped by date and by currency
    in one pass.  The flagged statistics are one row per date and meet the summary on the date.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    per_key = fact.groupBy("rate_date", "target_currency").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("severity") == "OK").alias("ok"),
        F.count_if(F.col("severity") == "WARNING").alias("warn"),
        F.max("extraction_timestamp").alias("ts"),
    )
    by_date_and_currency = per_key.groupingSets(
        [["rate_date"], ["target_currency"]], "rate_date", "target_currency"
    ).agg(
        F.sum("n").alias("n"), F.sum("ok").alias("ok"), F.sum("warn").alias("warn"),
        F.max("ts").alias("ts"), F.grouping("rate_date").alias("is_currency"),
    )
    is_date = F.col("is_currency") == 0

    def on_newest(column: str) -> Column:
        return F.coalesce(F.max_by(F.when(is_date, F.col(column)), "rate_date"), F.lit(0))

    summary = by_date_and_currency.agg(
        F.max("ts").alias("last_extraction"),
        F.max("rate_date").alias("last_rate_date"),
        F.count_if(~is_date & F.col("target_currency").isNotNull()).alias("currency_count"),
        F.coalesce(F.sum(F.when(is_date, F.col("n"))), F.lit(0)).alias("total_records"),
        on_newest("n").alias("validated_count"),
        on_newest("ok").alias("ok_count"),
        on_newest("warn").alias("warning_count"),
    )
    flagged = (
        consensus.where(F.col("status") == "FLAGGED")
        .groupBy(F.col("rate_date").alias("last_rate_date"))
        .agg(
            F.count(F.lit(1)).alias("flagged_count"),
            F.avg(first_dev).alias("avg_variance"),
            F.max(first_dev).alias("max_variance"),
        )
    )
    days = F.datediff(now.cast("date"), F.col("last_rate_date")).cast("bigint")
    flags = F.coalesce(F.col("flagged_count"), F.lit(0))
    status = (
        F.when(days > 2, "STALE")
        .when(flags > 5, "DEGRADED")
        .when(F.col("warning_count") > 10, "WARNING")
        .otherwise("HEALTHY")
    )
    if no_data_status:
        status = F.when(F.col("total_records") == 0, "NO_DATA").otherwise(status)
    return summary.join(flagged, "last_rate_date", "left").select(
        "last_extraction",
        "last_rate_date",
        hours_between(F.col("last_extraction"), now).alias("hours_since_extraction"),
        days.alias("days_since_rate"),
        "currency_count",
        "total_records",
        "validated_count",
        "ok_count",
        "warning_count",
        F.round(
            F.try_divide(F.col("ok_count").cast("double"), F.col("validated_count")), 4
        ).alias("ok_rate"),
        flags.alias("flagged_count"),
        "avg_variance",
        "max_variance",
        status.alias("pipeline_status"),
    )
