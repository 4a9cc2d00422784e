"""First rows of each key under an order: the building block of every deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """Keep the first ``n`` rows per key.

    Spark pushes the rank test below the shuffle as a partial group limit, so every map task
    sends at most ``n`` rows per key.  A key that holds a third of all rows therefore reaches its
    reducer as a few rows per map task, not as a third of the data.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def newest_order(ts: str = "extraction_timestamp", tie: str = "extraction_id") -> list[Column]:
    """Newest first; ties are settled by id so that the result does not depend on row order."""
    return [F.col(ts).desc_nulls_last(), F.col(tie).desc_nulls_last()]


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "extraction_timestamp",
    tie: str = "extraction_id",
) -> DataFrame:
    """The newest row per key as an aggregation with a map-side part.

    The same rows as ``first_per_key`` with ``newest_order``, but the sort only covers the keys:
    about a fifth faster on raw quotes.  A map task sends one row per key here as well.  All columns
    travel with the row, so select the needed ones first.

    The keys' hash leads the grouping: as the first sort column it settles most comparisons in the
    sort prefix, where codes like ``USD`` would tie.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(ts, tie))
    grouped = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)
    picked = grouped.agg(newest.alias("_newest")).select(*keys, "_newest.*")
    return picked.select(*df.columns)
