"""Scalar and map expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE_PREFIX = "rates__"
VARIANT_SUFFIX = "__v_double"

EMPTY_RATES = "map_from_arrays(array(), array())"


def empty_rates() -> Column:
    return F.expr(f"cast({EMPTY_RATES} as map<string,double>)")


def currency_code(c: Column | str) -> Column:
    """Landing key or raw code to an upper-case currency code."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.replace(c, F.lit(RATE_PREFIX), F.lit("")))


def rate_text(c: Column, places: int = 4) -> Column:
    """A double rounded and written in plain notation, at least one decimal, no trailing zeros.

    Rounding is done on the scaled double, not on its decimal text, so 24.71185 (stored slightly
    below) becomes 24.7118.
    """
    scale = float(10**places)
    fixed = (F.round(c * scale) / scale).cast(f"decimal(38,{places})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def map_of_entries(entries: Column) -> Column:
    """array<struct<key,value>> to a map; of entries with the same key the first one counts.

    Repeated keys are rare, so the quadratic filter only runs on arrays that have some.
    """
    keys = F.transform(entries, lambda e: e["key"])
    first_of_key = F.filter(
        entries, lambda e, i: F.array_position(keys, e["key"]) == (i + 1).cast("bigint")
    )
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.map_from_entries(F.when(unique, entries).otherwise(first_of_key))


def double_map(m: Column) -> Column:
    """Every value of a map as double; text that is no number becomes NULL."""
    return F.transform_values(m, lambda _, v: v.try_cast("double"))


def strip_prefix(m: Column, prefix: Column) -> Column:
    """Remove every occurrence of ``prefix`` from the keys (USDGBP -> GBP, USDUSD -> empty)."""
    entries = F.transform(
        F.map_entries(m),
        lambda e: F.struct(
            F.replace(e["key"], prefix, F.lit("")).alias("key"), e["value"].alias("value")
        ),
    )
    return map_of_entries(entries)


def valid_rate_keys(m: Column) -> Column:
    """Drop entries without a currency code."""
    return F.map_filter(m, lambda k, _: F.length(k) > 0)


def has_bad_key(m: Column) -> Column:
    return F.exists(F.map_keys(m), lambda k: F.length(k) == 0)


def median_of(values: Sequence[Column]) -> Column:
    """Exact interpolated median of a handful of columns, NULLs ignored, NULL if none is left."""
    present = F.array_sort(F.filter(F.array(*values), lambda v: v.isNotNull()))
    n = F.size(present)
    low = F.get(present, F.floor((n - 1) / 2).cast("int"))
    high = F.get(present, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / F.lit(2.0))


def relative_gap(value: Column, reference: Column) -> Column:
    return F.try_divide(F.abs(value - reference), reference)


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone (the session is pinned to UTC)."""
    return F.unix_timestamp(F.date_trunc("second", ts.cast("timestamp")))


def second_to_ntz(sec: Column) -> Column:
    return F.timestamp_seconds(sec).cast("timestamp_ntz")


def hours_between(earlier: Column, later: Column) -> Column:
    """Number of hour boundaries crossed, so 10:59 to 11:01 counts as one."""
    def hour(c: Column) -> Column:
        return F.unix_timestamp(F.date_trunc("hour", c.cast("timestamp")))

    return ((hour(later) - hour(earlier)) / 3600).cast("bigint")
