"""The stored hot table: slices by date, sorted by pair, with Bloom filters on both lookup keys.

A lookup opens the slices of its dates only.  Inside a file the row groups are told apart by the pair's
order and by what the writer keeps of both keys: their dictionary, or a Bloom filter where that grew too large.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from ratelake.operators import hot
from ratelake.sources.tables import RateTables

INDEXED = ("currency_pair", "target_currency")


class HotTable:
    """Lookups by key and date over one table of ``tables``; ``grain`` is that of its slices."""

    def __init__(self, tables: RateTables, table: str, grain: str = "day"):
        self.tables, self.table, self.grain = tables, table, grain

    def sync(self, items: DataFrame) -> None:
        """Upsert items; those of other keys stay."""
        self.tables.upsert(self.table, items, hot.HOT_KEYS, sort=hot.HOT_KEYS, grain=self.grain, indexed=INDEXED)

    def get(self, pair: str, day: date) -> DataFrame:
        """Point lookup: one slice is opened."""
        return hot.hot_get(self.tables.read(self.table, since=day, until=day), pair, day.isoformat())

    def lookup(
        self,
        key: str,
        value: str,
        since: date | None = None,
        until: date | None = None,
        ascending: bool = True,
        limit: int | None = None,
    ) -> DataFrame:
        """Range lookup by pair or target currency over the slices of its dates."""
        items = self.tables.read(self.table, since=since, until=until)
        bounds = (d.isoformat() if d else None for d in (since, until))
        return hot.hot_query(items, key, value, *bounds, ascending, limit)
