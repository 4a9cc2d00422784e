"""Parquet tables with keyed upserts on Spark's own partitions.

A table is a folder of Parquet files partitioned by a slice of its dates (days, or months where a table is
small).  An upsert computes the slices it touches and writes them in one job with dynamic partition
overwrite: Spark stages the files in the table's own folder, so in the shared store, and moves whole
partitions in when all tasks are done.

* a job that fails before that leaves the table as it was and can simply be run again;
* a run of one day rewrites that day, and no superseded file stays behind;
* partitions are replaced one after the other, so a reader that starts meanwhile may see some of them new.
  A table format with a MERGE of its own would replace this module where one is at hand.

The columns are kept in a small file beside the data, so that reads need no inference and slices
that predate a column show NULL.
"""

from __future__ import annotations

import calendar
import json
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.operators.ranking import first_per_key
from ratelake.sources import files

WHOLE = "all"
UNDATED = "none"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
SLICE = "_slice"


def within(name: str, since: date | None, until: date | None) -> bool:
    """Whether a slice may hold dates of a range; slices are named by the start of their dates."""
    if name == WHOLE:
        return True
    low = f"{since}"[: len(name)] if since else ""
    high = f"{until}"[: len(name)] if until else "~"
    return low <= name <= high


def covered(name: str, since: date, until: date | None) -> bool:
    """Whether all dates of a slice lie in a range."""
    if name in (WHOLE, UNDATED):
        return False
    year, month, *day = map(int, name.split("-"))
    last = day[0] if day else calendar.monthrange(year, month)[1]
    return since <= date(year, month, day[0] if day else 1) and (until is None or date(year, month, last) <= until)


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, and all rows of the batch; NULL equals NULL."""
    names = [f"_k{i}" for i in range(len(keys))]
    new = batch.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    kept = target.join(new, reduce(Column.__and__, same), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(
        *dict.fromkeys([*target.columns, *batch.columns])
    )


def _merged_columns(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The old columns followed by those that are new."""
    if old is None:
        return new
    known = set(old.fieldNames())
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


class RateTables:
    """The tables below one root folder.  One writer per table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def slices(self, table: str) -> list[str]:
        """Names of the slices that have rows, in order."""
        prefix = f"{SLICE}="
        return [n[len(prefix):] for n in files.children(self.spark, self.folder(table)) if n.startswith(prefix)]

    # -- columns ----------------------------------------------------------------------------

    def _columns_path(self, table: str) -> str:
        return f"{self.root}/_columns/{table}.json"

    def columns(self, table: str) -> T.StructType | None:
        path = self._columns_path(table)
        if not files.exists(self.spark, path):
            return None
        return T.StructType.fromJson(json.loads(files.read_text(self.spark, path)))

    def exists(self, table: str) -> bool:
        return files.exists(self.spark, self._columns_path(table))

    # -- reading ----------------------------------------------------------------------------

    def _load(self, table: str, slices: Sequence[str], columns: T.StructType) -> DataFrame:
        """Explicit columns: no inference, and NULL where a slice predates a column."""
        if not slices:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*[f"{self.folder(table)}/{SLICE}={s}" for s in slices])

    def read(
        self,
        table: str,
        schema: T.StructType | None = None,
        since: date | None = None,
        until: date | None = None,
    ) -> DataFrame:
        """Current rows; with date bounds only the slices they cover are opened.

        ``schema`` shapes the empty result of a table that does not exist yet.
        """
        columns = self.columns(table) or schema
        if columns is None:
            raise LookupError(f"table {table} does not exist and no schema was given")
        df = self._load(table, [s for s in self.slices(table) if within(s, since, until)], columns)
        if since is not None:
            df = df.where(F.col("rate_date") >= F.lit(since))
        if until is not None:
            df = df.where(F.col("rate_date") <= F.lit(until))
        return df

    def newest_date(self, table: str, column: str = "rate_date") -> date | None:
        """Newest date, looked up in the newest slice that has rows."""
        columns = self.columns(table)
        for name in reversed(self.slices(table)):
            found = self._load(table, [name], columns).agg(F.max(column)).first()[0]
            if found is not None:
                return found
        return None

    # -- writing ----------------------------------------------------------------------------

    def _slice_of(self, date_col: str | None, grain: str) -> Column:
        if date_col is None:
            return F.lit(WHOLE)
        start = F.date_format(F.col(date_col).cast("date"), GRAINS[grain])
        return F.coalesce(start, F.lit(UNDATED))

    def _replace(
        self, table: str, df: DataFrame, reopened: Iterable[str], sort: Sequence[str], indexed: Sequence[str] = ()
    ) -> None:
        """Write ``df``, which has its slice as a column, over the slices it has rows for.

        ``reopened`` slices that got no file have no rows any more and go.  The rebalance hint sizes the
        output files and splits slices that are too large for a task.
        """
        folders = [f"{self.folder(table)}/{SLICE}={s}" for s in set(reopened) & set(self.slices(table))]
        before = {f: files.children(self.spark, f) for f in folders}
        by_slice = df.hint("rebalance", SLICE)
        if sort:
            by_slice = by_slice.sortWithinPartitions(SLICE, *sort)
        writer = by_slice.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        for column in indexed:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.partitionBy(SLICE).parquet(self.folder(table))
        for folder, names in before.items():
            if files.children(self.spark, folder) == names:
                files.delete(self.spark, folder)

    def _keep_columns(self, table: str, old: T.StructType | None, new: T.StructType) -> None:
        if old != new:
            files.write_text(self.spark, self._columns_path(table), json.dumps(new.jsonValue()))

    def overwrite(
        self,
        table: str,
        df: DataFrame,
        date_col: str | None = None,
        sort: Sequence[str] = (),
        grain: str = "month",
    ) -> None:
        """Replace the whole table."""
        sliced = df.withColumn(SLICE, self._slice_of(date_col, grain))
        self._replace(table, sliced, self.slices(table), sort)
        self._keep_columns(table, self.columns(table), df.schema)

    def replace_slices(self, table: str, df: DataFrame, slice_col: str) -> None:
        """Replace the slices that ``df`` has rows for, a slice being one value of ``slice_col``."""
        self._replace(table, df.withColumn(SLICE, F.col(slice_col)), (), ())
        self._keep_columns(table, self.columns(table), df.schema)

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        date_col: str | None = "rate_date",
        replace_from: date | None = None,
        replace_until: date | None = None,
        order: Sequence[Column] | None = None,
        sort: Sequence[str] = (),
        grain: str = "day",
        indexed: Sequence[str] = (),
    ) -> None:
        """Replace rows whose key is in the batch and append the batch; running it twice changes
        nothing.  The first upsert creates the table, an empty batch included.

        A NULL in a key equals NULL.  The date must be one of the keys, or a key could be in two
        slices; a batch that has a key twice is refused unless ``order`` settles which row wins.

        With ``order`` the first row per key under that order wins, whether it is stored or new,
        so batches may arrive in any sequence.

        With ``replace_from`` / ``replace_until`` all rows dated in that range are replaced, so
        rows the batch no longer contains disappear as well.

        ``indexed`` columns get Bloom filters.  The batch is computed once, for the question which slices it has, and written once.
        """
        if date_col is not None and date_col not in keys:
            raise ValueError(f"{date_col} decides the slice, so it has to be one of the keys")
        old = self.columns(table)
        columns = _merged_columns(old, batch.schema)
        fresh = batch.withColumn(SLICE, self._slice_of(date_col, grain)).persist()
        try:
            per_key = fresh.groupBy(SLICE, *keys).agg(F.count(F.lit(1)).alias("rows"))
            most = {r[0]: r[1] for r in per_key.groupBy(SLICE).agg(F.max("rows")).toLocalIterator()}
            if order is None and any(n > 1 for n in most.values()):
                raise ValueError(f"the batch for {table} has a key twice")
            reopened, replaced = set(most), set()
            if replace_from is not None:
                inside = {s for s in self.slices(table) if s != UNDATED and within(s, replace_from, replace_until)}
                reopened |= inside
                replaced = {s for s in inside if covered(s, replace_from, replace_until)}
            merged, touched = fresh, sorted((reopened - replaced) & set(self.slices(table)))
            if touched:
                target = self._load(table, touched, columns)
                if replace_from is not None:
                    dated = F.col(date_col) >= F.lit(replace_from)
                    if replace_until is not None:
                        dated = dated & (F.col(date_col) <= F.lit(replace_until))
                    target = target.where(~F.coalesce(dated, F.lit(False)))
                target = target.withColumn(SLICE, self._slice_of(date_col, grain))
                if order is None:
                    merged = merge_by_key(target, fresh, keys)
                else:
                    merged = first_per_key(target.unionByName(fresh, allowMissingColumns=True), keys, order)
            elif order is not None:
                merged = first_per_key(fresh, keys, order)
            if reopened:
                self._replace(table, merged, reopened, sort, indexed)
            self._keep_columns(table, old, columns)
        finally:
            fresh.unpersist()
