"""API-usage metering over a call log: quota cycles, usage, status, failover and gating.

A cycle starts with the first call after the previous one expired and lasts a fixed number of
seconds, so cycle starts depend on each other and tumbling windows would be wrong.  The log is not
gathered per source, though.  Cycles expire on whole seconds, so all that the chain of starts needs
is which seconds had a call: a bitmap of 32,768 bits (4 KB) per source and nine hours, aggregated
map-side with Spark's bitmap functions.  A year of any call volume is 4 MB per source.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.config import DEFAULT_SOURCES, SourceSpec
from ratelake.functions.columns import epoch_second, second_to_ntz

BITS = 32_768
WARN_PCT = 90.0
UNMETERED_LIMIT = 1_000_000


def per_second(calls: DataFrame) -> DataFrame:
    """(api_source, sec, n, t): calls and throttle mark of each second, reduced map-side."""
    return (
        calls.select("api_source", epoch_second(F.col("called_at")).alias("sec"), _throttle(calls).alias("t"))
        .groupBy("api_source", "sec")
        .agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t"))
    )


def busy_seconds(seconds: DataFrame) -> DataFrame:
    """(api_source, bucket, bits): the seconds with at least one call."""
    return seconds.groupBy("api_source", F.floor(F.col("sec") / BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod(F.col("sec"), F.lit(BITS))).alias("bits")
    )


def chain_starts(
    buckets: np.ndarray, bitmaps: Sequence[bytes], length: int, not_before: int | None = None
) -> list[int]:
    """Cycle starts from sorted bitmaps: the first busy second at or after each expiry."""
    starts: list[int] = []
    threshold = int(buckets[0]) * BITS if not_before is None else not_before
    at = 0
    while True:
        at = max(at, int(np.searchsorted(buckets, threshold // BITS)))
        if at >= len(buckets):
            return starts
        origin = int(buckets[at]) * BITS
        busy = np.flatnonzero(
            np.unpackbits(np.frombuffer(bitmaps[at], dtype=np.uint8), bitorder="little")
        )
        hit = int(np.searchsorted(busy, max(0, threshold - origin)))
        if hit == len(busy):
            at += 1
            threshold = max(threshold, (int(buckets[at - 1]) + 1) * BITS)
            continue
        starts.append(origin + int(busy[hit]))
        threshold = starts[-1] + length


def cycle_starts(seconds: DataFrame, length_seconds: int) -> DataFrame:
    """One row per source with the sorted array of its cycle starts (epoch seconds)."""

    def chain(busy: pd.DataFrame) -> pd.DataFrame:
        busy = busy.sort_values("bucket")
        starts = chain_starts(busy["bucket"].to_numpy(), list(busy["bits"]), length_seconds)
        return pd.DataFrame({"api_source": [busy["api_source"].iloc[0]], "starts": [starts]})

    by_source = busy_seconds(seconds).groupBy("api_source")
    return by_source.applyInPandas(chain, "api_source string, starts array<bigint>")


def count_calls(seconds: DataFrame, length_seconds: int) -> DataFrame:
    """Calls per (api_source, start_sec) from reduced seconds.

    One lazy plan: the seconds, at most one row per source and second however many calls there
    were, are used for the chain of starts and joined with it.
    """
    joined = seconds.join(cycle_starts(seconds, length_seconds), "api_source")
    start = F.array_max(F.filter("starts", lambda s: s <= F.col("sec")))
    return joined.groupBy("api_source", start.alias("start_sec")).agg(
        F.sum("n").cast("bigint").alias("request_count"), F.max("t").alias("throttled")
    )


def assign_cycles(calls: DataFrame, length_seconds: int) -> DataFrame:
    """Requests per (api_source, cycle_start); every call counts, failed ones too."""
    counted = count_calls(per_second(calls), length_seconds)
    return counted.select(
        "api_source",
        second_to_ntz(F.col("start_sec")).alias("cycle_start"),
        second_to_ntz(F.col("start_sec") + length_seconds).alias("cycle_end"),
        "request_count",
        "throttled",
    )


def _throttle(calls: DataFrame) -> Column:
    """A log may carry ``throttled`` marks (HTTP 429); they count for the cycle of the call."""
    return F.col("throttled") if "throttled" in calls.columns else F.lit(False)


def source_table(calls: DataFrame, sources: Sequence[SourceSpec] = DEFAULT_SOURCES) -> DataFrame:
    """The configured sources as a table."""
    rows = [(s.name, s.quota_limit, s.failover_to, s.priority) for s in sources]
    return calls.sparkSession.createDataFrame(
        rows, "api_source string, quota bigint, failover_to string, priority int"
    )


def quota_usage(
    cycles: DataFrame,
    as_of: Column | datetime,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
    cycle_seconds: int = 30 * 86_400,
) -> DataFrame:
    """Current cycle of every configured source.

    A source without a running cycle at ``as_of`` starts a fresh one with no requests.
    """
    now = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")
    current = (
        cycles.where(F.col("cycle_start") <= now)
        .groupBy("api_source")
        .agg(
            F.max("cycle_start").alias("cycle_start"),
            F.max_by("cycle_end", "cycle_start").alias("cycle_end"),
            F.max_by("request_count", "cycle_start").alias("request_count"),
            F.max_by("throttled", "cycle_start").alias("throttled"),
        )
        .where(F.col("cycle_end") > now)
    )
    joined = source_table(cycles, sources).join(current, "api_source", "left")
    requests = F.coalesce(F.col("request_count"), F.lit(0).cast("bigint"))
    used = F.try_divide(requests * 100.0, F.col("quota").cast("double"))
    seconds_left = F.coalesce(
        F.unix_timestamp(F.col("cycle_end").cast("timestamp"))
        - F.unix_timestamp(now.cast("timestamp")),
        F.lit(cycle_seconds),
    )
    return joined.select(
        "api_source",
        F.coalesce(F.col("cycle_start"), now).cast("date").alias("cycle_start"),
        requests.alias("requests"),
        "quota",
        F.round(F.coalesce(used, F.lit(0.0)), 1).alias("usage_pct"),
        F.greatest(F.col("quota") - requests, F.lit(0)).cast("bigint").alias("remaining"),
        F.round(F.greatest(seconds_left / 86_400.0, F.lit(0.0)), 1).alias("ttl_days_left"),
        F.when(
            (requests >= F.col("quota")) | F.coalesce(F.col("throttled"), F.lit(False)),
            "throttled",
        ).otherwise("active").alias("status"),
        (
            (F.coalesce(used, F.lit(0.0)) >= WARN_PCT) & (F.col("quota") < UNMETERED_LIMIT)
        ).alias("quota_warning"),
        "failover_to",
        "priority",
    )


def quota_status(usage: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(api_source, available).  A source nobody meters counts as available."""
    known = usage.select(
        "api_source",
        ((F.col("status") == "active") & (F.col("remaining") > 0)).alias("_ok"),
    )
    names = known.select("api_source") if wanted is None else wanted.select("api_source")
    return names.distinct().join(known, "api_source", "left").select(
        "api_source", F.coalesce(F.col("_ok"), F.lit(True)).alias("available")
    )


def quota_failover(usage: DataFrame) -> DataFrame:
    """Throttled sources with their failover target and whether that one is available."""
    targets = usage.select(
        F.col("api_source").alias("failover_to"),
        ((F.col("status") == "active") & (F.col("remaining") > 0)).alias("failover_available"),
    )
    return (
        usage.where(F.col("status") == "throttled")
        .select("api_source", "priority", "failover_to")
        .join(targets, "failover_to", "left")
        .select("priority", "api_source", "failover_to", "failover_available")
        .orderBy("priority")
    )


def source_gating(
    status: DataFrame,
    mode: str = "daily",
    include_third: bool = False,
    sources: Sequence[SourceSpec] = DEFAULT_SOURCES,
) -> DataFrame:
    """(api_source, participates) of any number of sources, by each source's own rule.

    ``always`` takes part in every run.  ``quota`` takes part while it has quota, ``request`` does so
    in a backfill.  In a daily run, ``request`` sources take part on request or when a source that
    they stand in for (``failover_to``) is out.  A source without history sits out a backfill.
    """
    rules = [(s.name, s.gate, s.has_history, [o.name for o in sources if o.failover_to == s.name]) for s in sources]
    table = status.sparkSession.createDataFrame(
        rules, "api_source string, gate string, has_history boolean, stands_for array<string>"
    )
    flags = quota_status_defaults(status, table.select("api_source"))
    out = flags.where(~F.col("available")).select(F.col("api_source").alias("missing"))
    needed = (
        table.select("api_source", F.explode("stands_for").alias("missing"))
        .join(out, "missing")
        .select("api_source", F.lit(True).alias("needed"))
        .distinct()
    )
    known = table.join(flags, "api_source").join(needed, "api_source", "left")
    gate, ok = F.col("gate"), F.col("available")
    if mode == "daily":
        asked = F.lit(include_third) | F.coalesce("needed", F.lit(False))
        takes = F.when(gate == "always", True).when(gate == "quota", ok).otherwise(asked)
    else:
        takes = F.col("has_history") & ((gate == "always") | ok)
    return known.select("api_source", takes.alias("participates"))


def quota_status_defaults(status: DataFrame, names: DataFrame) -> DataFrame:
    """Status of the named sources, absent ones available."""
    return names.join(status, "api_source", "left").select(
        "api_source", F.coalesce(F.col("available"), F.lit(True)).alias("available")
    )
