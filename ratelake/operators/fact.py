"""The validated fact: one rate per (date, target, base), chosen by source priority."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.config import DEFAULT_SOURCES, SourceSpec
from ratelake.operators import consensus as cons
from ratelake.operators.ranking import first_per_key, newest_order, newest_per_key

FACT_KEYS = ("rate_date", "target_currency", "base_currency")
MODEL_NAME = "fact_rates_validated"


def latest_per_source(staged: DataFrame) -> DataFrame:
    """Newest row per (target, date) within each source; the base is not part of the key."""
    return newest_per_key(staged, ("source", "target_currency", "rate_date"))


def key_universe(staged: DataFrame) -> DataFrame:
    return staged.select(*FACT_KEYS).distinct()


def _by_source(sources: Sequence[SourceSpec], value) -> Column:
    out = F.lit(None)
    for s in sources:
        out = F.when(F.col("source") == s.name, F.lit(value(s))).otherwise(out)
    return out


def priority_pick(
    staged: DataFrame,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    keys: Sequence[str] = FACT_KEYS,
) -> DataFrame:
    """The first source by priority that has a rate wins the key, with its whole lineage.

    One ranked pass over the union of any number of sources; within a source the newest row
    counts.  ``source_tier`` becomes the tier of the winner.
    """
    usable = staged.where(
        F.col("source").isin([s.name for s in sources]) & F.col("exchange_rate").isNotNull()
    )
    ranked = usable.withColumn("_priority", _by_source(sources, lambda s: s.priority))
    won = first_per_key(ranked, keys, [F.col("_priority").asc(), *newest_order()])
    return won.withColumn("source_tier", _by_source(sources, lambda s: s.fact_tier)).drop(
        "_priority"
    )


def exclude_anomalies(rates: DataFrame, consensus: DataFrame) -> DataFrame:
    """Drop (target, date) pairs the consensus flagged.

    No broadcast hint: Spark broadcasts the flagged keys when their measured size allows it and
    joins on the shuffled key otherwise.
    """
    flagged = consensus.where(F.col("status") == "FLAGGED").select("target_currency", "rate_date")
    return rates.where(F.col("extraction_id").isNotNull()).join(
        flagged, ["target_currency", "rate_date"], "left_anti"
    )


def fact_lookback(
    df: DataFrame,
    mode: str,
    execution_date: str | date | None = None,
    newest_loaded: date | None = None,
    lookback_days: int = 3,
) -> DataFrame:
    """daily: from ``lookback_days`` before the newest loaded date on (all, if none is loaded);
    backfill: from the execution date on."""
    if mode != "daily":
        return df.where(F.col("rate_date") >= F.lit(execution_date or "1970-01-01").cast("date"))
    if newest_loaded is None:
        return df
    return df.where(F.col("rate_date") >= F.date_sub(F.lit(newest_loaded), lookback_days))


def project_fact(rates: DataFrame, as_of: datetime | None = None) -> DataFrame:
    loaded = F.lit(as_of) if as_of is not None else F.current_timestamp()
    full = rates.withColumns(
        {
            "validation_status": F.lit("VALIDATED"),
            "severity": F.lit("OK"),
            "consensus_variance": F.lit(0.0),
            "dbt_loaded_at": loaded,
            "model_name": F.lit(MODEL_NAME),
        }
    )
    return full.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FACT.fields]
    )


def build_fact(
    stagings: Sequence[DataFrame],
    consensus: DataFrame,
    mode: str = "daily",
    execution_date: str | date | None = None,
    newest_loaded: date | None = None,
    lookback_days: int = 3,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    base: str = "USD",
    as_of: datetime | None = None,
) -> DataFrame:
    """Priority pick over the sources of the mode, minus flagged keys, in the fact's contract.

    A backfill leaves out sources without history.  Date and base filters sit next to the scans.
    """
    used = [s for s in sources if mode == "daily" or s.has_history]
    staged = reduce(DataFrame.unionByName, stagings).where(F.col("base_currency") == base)
    windowed = fact_lookback(staged, mode, execution_date, newest_loaded, lookback_days)
    return project_fact(exclude_anomalies(priority_pick(windowed, used), consensus), as_of)


def validate_and_pick(
    stagings: Sequence[DataFrame],
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    used: Sequence[SourceSpec] | None = None,
    base: str = "USD",
    threshold: float = 0.005,
    as_of: datetime | None = None,
) -> DataFrame:
    """Consensus and fact in one pass over the staging rows, for when no consensus table is kept.

    Both are functions of the same (date, currency) group, which holds at most one row per source,
    so a single aggregation yields the rates side by side and the winner, and the flag is tested
    on its result.  Nothing is joined and staging is read once.  ``used`` limits the sources that
    may win, not those that vote.
    """
    used = sources if used is None else used
    rows = reduce(DataFrame.unionByName, stagings).where(F.col("base_currency") == base)
    priority = _by_source(used, lambda s: -s.priority)
    usable = priority.isNotNull() & F.col("exchange_rate").isNotNull()
    lineage = [c for c in rows.columns if c not in cons.CONSENSUS_KEYS]
    grouped = rows.groupBy(*cons.CONSENSUS_KEYS).agg(
        *[
            F.max(F.when(F.col("source") == s.name, F.col("exchange_rate"))).alias(s.rate_alias)
            for s in sources
        ],
        F.max_by(
            F.struct(*lineage),
            F.when(usable, F.struct(priority, "extraction_timestamp", "extraction_id")),
        ).alias("_won"),
    )
    scored = cons.add_flags(
        cons.add_deviations(cons.with_median(grouped, sources), sources), threshold
    )
    passed = scored.where((F.col("status") == "OK") & F.col("_won.extraction_id").isNotNull())
    won = passed.select(*cons.CONSENSUS_KEYS, "_won.*")
    return project_fact(
        won.withColumn("source_tier", _by_source(used, lambda s: s.fact_tier)), as_of
    )
