"""Landed records to one typed map row per (date, source, base)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.functions.columns import (
    RATE_PREFIX,
    VARIANT_SUFFIX,
    double_map,
    has_bad_key,
    map_of_entries,
    valid_rate_keys,
)
from ratelake.operators.ranking import newest_per_key

SILVER_KEYS = ("rate_date", "source", "base_currency")


def discover_rate_columns(df: DataFrame, prefix: str = RATE_PREFIX) -> list[str]:
    """Columns holding rates, told by a true prefix (``_`` is no wildcard here)."""
    return [c for c in df.columns if c.startswith(prefix)]


def _code(column: str, prefix: str) -> str:
    return column[len(prefix):].removesuffix(VARIANT_SUFFIX).upper()


def null_profile(df: DataFrame, prefix: str = RATE_PREFIX) -> DataFrame:
    """NULL count of every rate column, taken in one pass, as (currency, null_rows, total_rows)."""
    columns = discover_rate_columns(df, prefix)
    if not columns:
        empty = "currency string, null_rows bigint, total_rows bigint"
        return df.sparkSession.createDataFrame([], empty)
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    one_row = df.agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    entries = F.array(
        *[
            F.struct(F.lit(_code(c, prefix)).alias("currency"), F.col(f"n{i}").alias("null_rows"))
            for i, c in enumerate(columns)
        ]
    )
    return one_row.select(F.explode(entries).alias("e"), "total_rows").select(
        "e.currency", "e.null_rows", "total_rows"
    )


def null_profile_of_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same profile straight from landed JSON lines, for every code the lines name.

    A record that lacks a currency counts as NULL for it, as it would after a union by name; a code
    that is NULL in all records is reported too.  Every record also emits one entry without a code,
    whose count is the number of records; spreading it over the result is a window over one row per
    currency.
    """
    entries = F.filter(
        F.map_entries(F.from_json(F.col(column), "map<string,string>")),
        lambda e: e["key"].startswith(RATE_PREFIX),
    )

    def codes(of: Column) -> Column:
        return F.array_distinct(F.transform(of, lambda e: _text_code(e["key"])))

    present = F.filter("entries", lambda e: e["value"].isNotNull())
    named = F.transform("named", lambda c: F.struct(c.alias("currency"), F.array_contains("present", c).alias("there")))
    total = F.array(F.struct(F.lit("").alias("currency"), F.lit(True).alias("there")))
    seen = (
        lines.where(F.try_parse_json(column).isNotNull())
        .select(entries.alias("entries"))
        .select(codes(F.col("entries")).alias("named"), codes(present).alias("present"))
        .select(F.inline(F.concat(total, named)))
    )
    counts = seen.groupBy("currency").agg(F.count_if("there").alias("n"))
    total_rows = F.max(F.when(F.col("currency") == "", F.col("n"))).over(Window.partitionBy())
    return (
        counts.withColumn("total_rows", total_rows)
        .where(F.col("currency") != "")
        .select("currency", (F.col("total_rows") - F.col("n")).alias("null_rows"), "total_rows")
    )


def _text_code(key: Column) -> Column:
    """Currency of a landed key held in a column."""
    bare = F.substring(key, F.lit(len(RATE_PREFIX) + 1), F.length(key))
    return F.upper(F.regexp_replace(bare, VARIANT_SUFFIX + "$", ""))


def rebuild_map(df: DataFrame, prefix: str = RATE_PREFIX, out: str = "rates") -> DataFrame:
    """Fold the rate columns back into a map, NULL rates left out.

    Type variants of a column (``…__v_double``) count towards the plain column's currency.
    """
    columns = sorted(discover_rate_columns(df, prefix), key=lambda c: c.endswith(VARIANT_SUFFIX))
    columns = [c for c in columns if _code(c, prefix)]
    others = [F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)]
    by_code: dict[str, list[str]] = {}
    for c in columns:
        by_code.setdefault(_code(c, prefix), []).append(c)
    if not by_code:
        rates = F.expr("cast(map() as map<string,double>)")
    else:
        values = [
            F.coalesce(*[F.col(f"`{c}`").cast("double") for c in group])
            for group in by_code.values()
        ]
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in by_code]), F.array(*values))
        rates = F.map_filter(pairs, lambda _, v: v.isNotNull())
    return df.select(*others, rates.alias(out))


def records_from_json_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Landed JSON text to silver-shaped rows in one pass, without schema inference.

    Each line is read as ``map<string,string>``; keys with the rate prefix (or a nested ``rates``
    object) become the rate map.  New currencies need no schema change and no extra scan.
    """
    line = F.from_json(F.col(column), "map<string,string>")
    flat = F.transform(
        F.array_sort(
            F.filter(F.map_entries(F.col("_m")), lambda e: e["key"].startswith(RATE_PREFIX)),
        ),
        lambda e: F.struct(
            _text_code(e["key"]).alias("key"),
            e["value"].try_cast("double").alias("value"),
        ),
    )
    flat_rates = map_of_entries(F.filter(flat, lambda e: e["value"].isNotNull()))
    nested_rates = F.map_filter(
        double_map(F.from_json(_field("rates"), "map<string,string>")),
        lambda _, v: v.isNotNull(),
    )
    return (
        lines.select(line.alias("_m"))
        .where(F.col("_m").isNotNull())
        .select(
            _field("extraction_id").alias("extraction_id"),
            _field("extraction_timestamp").try_cast("timestamp_ntz").alias("extraction_timestamp"),
            _field("source").alias("source"),
            _field("source_tier").alias("source_tier"),
            _field("base_currency").alias("base_currency"),
            _field("rate_date").try_cast("date").alias("rate_date"),
            F.coalesce(nested_rates, flat_rates).alias("rates"),
            _field("http_status_code").try_cast("int").alias("http_status_code"),
        )
    )


def _reason(source: str | None) -> Column:
    """Why the line parsed to ``_m`` is left out or shortened by a load; NULL where nothing is."""
    keys = F.map_keys(F.col("_m"))
    bad_key = F.exists(keys, lambda k: k.startswith(RATE_PREFIX) & (_text_code(k) == ""))
    other = F.lit(False) if source is None else ~_field("source").eqNullSafe(F.lit(source))
    return (
        F.when(F.col("_m").isNull(), "bad_line")
        .when(other, "other_source")
        .when(_field("rate_date").try_cast("date").isNull(), "bad_date")
        .when(bad_key, "bad_key")
    )


def _parsed_lines(lines: DataFrame, column: str) -> DataFrame:
    line = F.from_json(F.col(column), "map<string,string>")
    return lines.where(F.trim(column) != "").withColumn("_m", line)


def rejected_lines(
    lines: DataFrame, source: str | None = None, column: str = "value"
) -> DataFrame:
    """(reason, rows) of the landed lines a load leaves out, one reason per line.

    ``bad_line`` is no JSON object, ``other_source`` carries another label or none, ``bad_date`` has
    no date, ``bad_key`` has a rate without a code (only that entry is dropped).
    """
    found = _parsed_lines(lines, column).select(_reason(source).alias("reason"))
    return found.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("rows"))


def counted_lines(
    lines: DataFrame,
    counts: Observation,
    source: str,
    mode: str,
    start_date: str,
    end_date: str | None = None,
    lookback_days: int = 3,
    column: str = "value",
) -> DataFrame:
    """The lines, counted by what becomes of them while a load reads them; no pass of its own.

    ``lines`` = ``bad_line`` + ``other_source`` + ``bad_date`` + ``outside_window`` + ``records``.
    ``bad_key`` lines are among the records, without the entries that have no code.
    """
    day = _field("rate_date").try_cast("date")
    tagged = _parsed_lines(lines, column).select(*lines.columns, _reason(source).alias("_reason"), day.alias("rate_date"))
    kept = F.coalesce(F.col("_reason"), F.lit("")).isin("", "bad_key")
    inside = F.coalesce(in_window(mode, start_date, end_date, lookback_days), F.lit(False))
    named = [F.count_if(F.col("_reason") == r).alias(r) for r in ("bad_line", "other_source", "bad_date", "bad_key")]
    return tagged.observe(
        counts,
        F.count(F.lit(1)).alias("lines"),
        *named,
        F.count_if(kept & ~inside).alias("outside_window"),
        F.count_if(kept & inside).alias("records"),
    ).select(*lines.columns)


def _field(name: str) -> Column:
    return F.try_element_at(F.col("_m"), F.lit(name))


def in_window(
    mode: str, start_date: str, end_date: str | None = None, lookback_days: int = 3
) -> Column:
    """daily: from ``lookback_days`` before the start on; backfill: inclusive range."""
    day = F.col("rate_date").cast("date")
    start = F.lit(start_date).cast("date")
    if mode == "daily":
        return day >= F.date_sub(start, lookback_days)
    return day.between(start, F.lit(end_date or start_date).cast("date"))


def date_window(
    df: DataFrame,
    mode: str,
    start_date: str,
    end_date: str | None = None,
    lookback_days: int = 3,
) -> DataFrame:
    """Rows of the dates a load covers, see ``in_window``."""
    return df.where(in_window(mode, start_date, end_date, lookback_days))


def clean_map_keys(df: DataFrame, map_col: str = "rates") -> DataFrame:
    """Remove entries without a code; count them first with ``count_bad_maps`` if needed."""
    return df.withColumn(map_col, valid_rate_keys(F.col(map_col)))


def count_bad_maps(df: DataFrame, map_col: str = "rates") -> DataFrame:
    return df.agg(F.count_if(has_bad_key(F.col(map_col))).alias("invalid_rows"))


def drop_bad_rows(df: DataFrame, map_col: str = "rates") -> DataFrame:
    """Drop whole rows that still carry an empty key (a NULL map carries none and stays)."""
    return df.where(~F.coalesce(has_bad_key(F.col(map_col)), F.lit(False)))


def dedup_latest(df: DataFrame, keys: Sequence[str] = SILVER_KEYS) -> DataFrame:
    return newest_per_key(df, keys)


def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Additive evolution: columns new on either side are NULL on the other."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def build_silver(
    records: DataFrame,
    mode: str,
    start_date: str,
    end_date: str | None = None,
    lookback_days: int = 3,
    keys: Sequence[str] = SILVER_KEYS,
) -> DataFrame:
    """Window, key cleaning and deduplication over records that already carry a rate map."""
    windowed = date_window(records, mode, start_date, end_date, lookback_days)
    newest = dedup_latest(clean_map_keys(windowed), keys)
    fields = schemas.SILVER.fieldNames()
    extra = [c for c in newest.columns if c not in fields]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SILVER.fields]
    return newest.select(*typed, *extra)
