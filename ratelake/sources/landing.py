"""Landing area: append-only gzip JSON lines below ``<base>/<mode>/…``.

Daily files lie in a folder per extraction day, backfills in one per month: the history of years would
otherwise be thousands of folders of one small file each, all to be listed by every later run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.sources import files


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class NoLandingData(ValueError):
    """No landed file can hold rows of the range."""


@dataclass(frozen=True)
class LandingLayout:
    """How landed files lie below {base}/{mode}: by the day of their extraction.

    ``day_glob`` finds the files of one day, ``name_glob`` all files by name; ``day_in_path`` picks
    year, month and, where it is there, day out of a file's path.
    """

    day_glob: str
    name_glob: str
    day_in_path: str


# What ``land_append`` writes.
PARTITIONED = LandingLayout(
    day_glob="year={year}/month={month}/day={day}/*.json*",
    name_glob="*.json*",
    day_in_path=r"/year=(\d{4})/month=(\d{2})(?:/day=(\d{2}))?/[^/]*$",
)

# Year and month folders with the date in the file name.
DATED_FILES = LandingLayout(
    day_glob="{year}/{month}/{year}_{month}_{day}*.jsonl*",
    name_glob="*.jsonl*",
    day_in_path=r"/(\d{4})_(\d{2})_(\d{2})[^/]*$",
)


@dataclass(frozen=True)
class LandingScan:
    """What to read: globs, or one folder walked recursively for a file name pattern.

    ``since`` leaves out files whose path names an earlier extraction day; a path without a day is
    always read.
    """

    paths: tuple[str, ...]
    name_glob: str | None = None
    since: date | None = None
    day_in_path: str | None = None


def resolve_landing(
    spark: SparkSession,
    base: str,
    mode: str,
    start: date,
    layout: LandingLayout = PARTITIONED,
    lookback_days: int = 0,
) -> LandingScan:
    """All files that may hold rows of a run from ``start`` on; extraction days date the files.

    daily: the files extracted on ``start`` and the ``lookback_days`` before it; a day without files
    adds nothing.  backfill: everything extracted since ``start`` (a day of slack covers time zones),
    as history of a date is fetched on that date or later.
    """
    if mode == "daily":
        days = [start - timedelta(days=n) for n in range(lookback_days, -1, -1)]
        globs = [f"{base}/daily/" + layout.day_glob.format(year=f"{d:%Y}", month=f"{d:%m}", day=f"{d:%d}") for d in days]
        found = tuple(g for g in globs if files.matches(spark, g))
        if found:
            return LandingScan(found)
    elif mode == "backfill":
        root = f"{base}/backfill"
        if files.exists(spark, root):
            return LandingScan((root,), layout.name_glob, start - timedelta(days=1), layout.day_in_path)
    else:
        raise ValueError(f"unknown mode {mode}")
    raise NoLandingData(f"no landing data for mode {mode} below {base}")


def scan_lines(spark: SparkSession, scan: LandingScan) -> DataFrame:
    """Raw JSON lines with their file name.

    The engine parses these with ``records_from_json_lines``: one pass, no inference.  The test of
    the extraction day is on file metadata, so files that are too old are never opened.
    """
    reader = spark.read
    if scan.name_glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", scan.name_glob)
    path = F.col("_metadata.file_path")
    lines = reader.text(list(scan.paths))
    if scan.since is not None:
        year, month, day = (F.regexp_extract(path, scan.day_in_path, i) for i in (1, 2, 3))
        last = F.concat_ws("-", year, month, F.when(day == "", "31").otherwise(day))
        lines = lines.where((year == "") | (last >= F.lit(scan.since.isoformat())))
    return lines.select("value", path.alias("filename"))


def scan_jsonl_union(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """JSON lines with the union of all columns by name and the file name.

    Inference reads the input once more; pass ``schema`` where the columns are known.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if schema is not None:
        reader = reader.schema(schema)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.json(paths).withColumn("filename", F.col("_metadata.file_path"))


def scan_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    history: str | None = None,
) -> DataFrame:
    """JSON lines at ``path``; otherwise no rows, shaped like ``history`` or like ``schema``."""
    if files.matches(spark, path):
        return spark.read.schema(schema).json(path)
    if history is not None and files.matches(spark, history):
        return spark.createDataFrame([], spark.read.json(history).schema)
    return spark.createDataFrame([], schema)


def land_append(
    records: DataFrame, base: str, mode: str, day_column: str = "extraction_timestamp"
) -> None:
    """Append records as gzip JSON lines below mode/year/month, daily ones by day; nothing is ever replaced.

    Timestamps keep their microseconds; the newest extraction is picked by them later on.  NULL
    fields are written, so that a currency without any rate can still be told from an unknown one.
    Rebalancing by folder gives one task's worth of rows per file and splits a folder that is too large
    for one task.
    """
    day = F.col(day_column).cast("date")
    dated = records.withColumns(
        {
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
            "day": F.date_format(day, "dd"),
        }
    )
    folders = ("year", "month", "day") if mode == "daily" else ("year", "month")
    dated = dated if mode == "daily" else dated.drop("day")
    write_lines(dated.hint("rebalance", *folders), f"{base}/{mode}", folders)


def write_lines(records: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Append records as gzip JSON lines with all microseconds and NULL fields."""
    (
        records.write.mode("append")
        .partitionBy(*partitions)
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", MICROS)
        .option("timestampNTZFormat", MICROS)
        .json(path)
    )
