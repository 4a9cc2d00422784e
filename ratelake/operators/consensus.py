"""Cross-source validation: median per (date, currency) and deviation of every source from it.

Staging holds at most one rate per source and key, so one hash aggregation with a conditional
maximum per source carries everything the layer needs (the sources' rates, their count and,
derived from them, the exact median).  Its buffers are doubles: partial aggregation runs inside
whole-stage codegen and one shuffle of reduced rows follows, without self-joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.config import DEFAULT_SOURCES, SourceSpec
from ratelake.functions.columns import median_of, rate_text, relative_gap

CONSENSUS_KEYS = ("rate_date", "target_currency")


def union_sources(stagings: Sequence[DataFrame], base: str = "USD") -> DataFrame:
    """All sources' rows in the common base: (rate_date, target_currency, rate, source)."""
    parts = [
        s.where(F.col("base_currency") == base).select(
            "rate_date", "target_currency", F.col("exchange_rate").alias("rate"), "source"
        )
        for s in stagings
    ]
    return reduce(DataFrame.unionByName, parts)


def pivot_rates(
    rates: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> DataFrame:
    """One row per (date, currency) with each source's rate beside the count and the median."""
    per_source = [
        F.max(F.when(F.col("source") == s.name, F.col("rate"))).alias(s.rate_alias)
        for s in sources
    ]
    wide = rates.groupBy(*CONSENSUS_KEYS).agg(
        F.count(F.lit(1)).alias("source_count"), *per_source
    )
    return with_median(wide, sources)


def with_median(wide: DataFrame, sources: Sequence[SourceSpec]) -> DataFrame:
    return wide.withColumn("consensus_rate", median_of([F.col(s.rate_alias) for s in sources]))


def source_breakdown(sources: Sequence[SourceSpec] = DEFAULT_SOURCES) -> Column:
    """``source:rate`` with four decimals, sorted by source name."""
    parts = [
        F.concat(F.lit(s.name + ":"), rate_text(F.col(s.rate_alias)))
        for s in sorted(sources, key=lambda s: s.name)
    ]
    return F.concat_ws(", ", *parts)


def add_deviations(
    wide: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES
) -> DataFrame:
    """Relative deviation per source, and the largest of them as a fraction."""
    devs = {
        s.dev_alias: relative_gap(F.col(s.rate_alias), F.col("consensus_rate")) for s in sources
    }
    largest = [F.coalesce(F.col(s.dev_alias), F.lit(0.0)) for s in sources]
    widest = F.greatest(*largest) if len(largest) > 1 else largest[0]
    return wide.withColumns(devs).withColumn("variance_pct", widest)


def add_flags(df: DataFrame, threshold: float = 0.005) -> DataFrame:
    """Strictly above the threshold is flagged; a missing source never flags."""
    off = F.col("variance_pct") > threshold
    return df.withColumn("status", F.when(off, "FLAGGED").otherwise("OK")).withColumn(
        "severity", F.when(off, "WARNING").otherwise("OK")
    )


def flagged_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("consensus_rate").isNotNull() & (F.col("status") == "FLAGGED"))


def consensus_window(
    df: DataFrame,
    mode: str,
    execution_date: str | date | None = None,
    lookback_days: int = 0,
    newest_loaded: date | None = None,
    target_lookback_days: int = 3,
) -> DataFrame:
    """Dates a run covers.

    daily: ``lookback_days`` up to the execution date (0 gives exactly that date), and not older
    than ``target_lookback_days`` before the newest loaded date if one is given.  backfill: from
    the execution date on.
    """
    day = F.col("rate_date")
    run_day = F.lit(execution_date or "1970-01-01").cast("date")
    if mode != "daily":
        return df.where(day >= run_day)
    out = df.where(day.between(F.date_sub(run_day, lookback_days), run_day))
    if newest_loaded is not None:
        out = out.where(day >= F.date_sub(F.lit(newest_loaded), target_lookback_days))
    return out


def score_consensus(
    rates: DataFrame,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    threshold: float = 0.005,
) -> DataFrame:
    """Every (date, currency) with median, deviations and flags, flagged or not."""
    wide = pivot_rates(rates, sources).withColumn("source_breakdown", source_breakdown(sources))
    return add_flags(add_deviations(wide, sources), threshold)


def build_consensus(
    stagings: Sequence[DataFrame],
    mode: str = "backfill",
    execution_date: str | date | None = None,
    lookback_days: int = 0,
    newest_loaded: date | None = None,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    base: str = "USD",
    threshold: float = 0.005,
    as_of: datetime | None = None,
) -> DataFrame:
    """The consensus table: flagged (date, currency) rows only.

    The date window is applied to the staging rows, ahead of the shuffle.
    """
    rates = consensus_window(
        union_sources(stagings, base), mode, execution_date, lookback_days, newest_loaded
    )
    loaded = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return flagged_only(score_consensus(rates, sources, threshold)).select(
        "rate_date",
        "target_currency",
        F.concat(F.lit(base + "/"), F.col("target_currency")).alias("currency_pair"),
        "consensus_rate",
        "source_count",
        "source_breakdown",
        *[s.rate_alias for s in sources],
        *[s.dev_alias for s in sources],
        "variance_pct",
        "status",
        "severity",
        loaded.cast("timestamp").alias("dbt_loaded_at"),
    )
