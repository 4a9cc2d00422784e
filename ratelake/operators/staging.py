"""Map rows to long rate rows: window, explode, deduplicate, project, keep positive rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.functions.columns import currency_code
from ratelake.operators.ranking import newest_per_key

STAGING_KEYS = ("base_currency", "target_currency", "rate_date")
QUOTE_COLUMNS = (
    "extraction_id", "extraction_timestamp", "source", "source_tier", "base_currency",
    "target_currency", "exchange_rate", "rate_date",
)
EPOCH = "1970-01-01"


def filter_execution_date(
    df: DataFrame, execution_date: str | date | None = None, lookback_days: int = 0
) -> DataFrame:
    """``rate_date >= execution_date - lookback_days``; a literal bound, so it prunes the scan."""
    start = F.date_sub(F.lit(execution_date or EPOCH).cast("date"), lookback_days)
    return df.where(F.col("rate_date") >= start)


def incremental_watermark(df: DataFrame, mode: str, newest_loaded: date | None) -> DataFrame:
    """daily: only dates after the newest loaded one; backfill: everything.

    An empty target has no newest date and lets every row in.
    """
    if mode != "daily" or newest_loaded is None:
        return df
    return df.where(F.col("rate_date") > F.lit(newest_loaded))


def unnest_rates(df: DataFrame, map_col: str = "rates") -> DataFrame:
    """One row per map entry; empty and NULL maps yield none.  A map-side operation."""
    keep = [c for c in df.columns if c != map_col]
    return df.select(*keep, F.explode(map_col).alias("target_currency", "exchange_rate"))


def normalize_codes(df: DataFrame) -> DataFrame:
    return df.withColumn("target_currency", currency_code("target_currency"))


def dedup_pair(df: DataFrame, keys: Sequence[str] = STAGING_KEYS) -> DataFrame:
    """Newest quote per key.  Codes are normalised first, so ``eur`` and ``EUR`` are one key."""
    return newest_per_key(normalize_codes(df), keys)


def positive_rates(df: DataFrame) -> DataFrame:
    """Applied after deduplication: a bad newest quote removes its key."""
    return df.where(F.col("exchange_rate") > 0)


def project_staging(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The eleven staging columns; expects positive rates."""
    loaded = F.lit(as_of) if as_of is not None else F.current_timestamp()
    derived = df.select(
        "extraction_id",
        "extraction_timestamp",
        "source",
        "source_tier",
        "base_currency",
        currency_code("target_currency").alias("target_currency"),
        F.col("exchange_rate").cast("double").alias("exchange_rate"),
        F.col("rate_date").cast("date").alias("rate_date"),
    )
    full = derived.withColumns(
        {
            "currency_pair": F.concat_ws("/", "base_currency", "target_currency"),
            "inverse_rate": F.try_divide(F.lit(1.0), F.col("exchange_rate")),
            "dbt_loaded_at": loaded,
        }
    )
    return full.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STAGING.fields]
    )


def stage_quotes(
    quotes: DataFrame, keys: Sequence[str] = STAGING_KEYS, as_of: datetime | None = None
) -> DataFrame:
    """Deduplicate and project rows that are already long (several sources may be mixed)."""
    slim = quotes.select(*QUOTE_COLUMNS)
    return project_staging(positive_rates(dedup_pair(slim, keys)), as_of)


def build_staging(
    silver: DataFrame,
    mode: str,
    execution_date: str | date | None = None,
    lookback_days: int = 0,
    newest_loaded: date | None = None,
    as_of: datetime | None = None,
    keys: Sequence[str] = STAGING_KEYS,
) -> DataFrame:
    """Silver maps to staging rows.

    The daily window reaches ``lookback_days`` back, the same distance in every layer.  Passing
    ``newest_loaded`` adds the strict watermark on top.
    """
    back = lookback_days if mode == "daily" else 0
    windowed = filter_execution_date(silver, execution_date, back)
    fresh = incremental_watermark(windowed, mode, newest_loaded)
    return stage_quotes(unnest_rates(fresh), keys, as_of)
