"""Hot tier: items keyed by (currency_pair, rate_date), point and range lookups, previews."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = ("currency_pair", "rate_date")
NUMERIC = ("exchange_rate", "inverse_rate", "consensus_variance")


def to_hot_items(
    latest: DataFrame, as_of: datetime | None = None, ttl_days: int | None = None
) -> DataFrame:
    """Dates to ISO text, doubles to decimals through their text, plus the sync time."""
    synced = (F.lit(as_of) if as_of is not None else F.current_timestamp()).cast("timestamp")
    decimals = {c: F.col(c).cast("string").cast("decimal(38,18)") for c in NUMERIC}
    items = latest.withColumns(
        {**decimals, "rate_date": F.col("rate_date").cast("string"), "synced_at": synced}
    )
    if ttl_days is not None:
        items = items.withColumn("ttl", F.unix_timestamp("synced_at") + ttl_days * 86_400)
    return items


def hot_get(items: DataFrame, pair: str, rate_date: str) -> DataFrame:
    """Point lookup; both predicates reach the scan."""
    return items.where((F.col("currency_pair") == pair) & (F.col("rate_date") == rate_date))


def hot_query(
    items: DataFrame,
    key: str,
    value: str,
    since: str | None = None,
    until: str | None = None,
    ascending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Range lookup by pair or by target currency, ordered by date, optionally the first few."""
    if key not in ("currency_pair", "target_currency"):
        raise ValueError(f"no index on {key}")
    out = items.where(F.col(key) == value)
    if since is not None:
        out = out.where(F.col("rate_date") >= since)
    if until is not None:
        out = out.where(F.col("rate_date") <= until)
    day = F.col("rate_date")
    out = out.orderBy(day.asc() if ascending else day.desc())
    return out if limit is None else out.limit(limit)


def preview(df: DataFrame, n: int = 10, order_by: str | None = None) -> DataFrame:
    """The first ``n`` rows, newest key first if an order is given."""
    return (df.orderBy(F.col(order_by).desc()) if order_by else df).limit(n)
