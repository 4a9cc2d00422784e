import random
import time
from dataclasses import replace
from datetime import timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelake.config import EngineConfig
from ratelake.operators import quota
from ratelake.streaming.quota_stream import QuotaMeter, apply_changes, late_rows, reduced, stream_quota_meter
from ratelake.sources.tables import RateTables

from .helpers import rows, ts

CFG = EngineConfig()
DAY = 86_400


def brute(seconds, length, resume=None):
    starts, expiry = [], resume if resume is not None else -1
    for s in sorted(seconds):
        if s >= expiry:
            starts.append(s)
            expiry = s + length
    return starts


def as_bitmaps(seconds):
    by_bucket = {}
    for s in seconds:
        bits = by_bucket.setdefault(s // quota.BITS, np.zeros(quota.BITS, dtype=np.uint8))
        bits[s % quota.BITS] = 1
    buckets = np.array(sorted(by_bucket))
    packed = [np.packbits(by_bucket[b], bitorder="little").tobytes() for b in buckets]
    return buckets, packed


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 300_000), min_size=1, max_size=60), st.integers(1, 150_000),
       st.one_of(st.none(), st.integers(0, 320_000)))
def test_chain_matches_a_sequential_scan(seconds, length, resume):
    assert quota.chain_starts(*as_bitmaps(seconds), length, resume) == brute(
        seconds, length, resume)


def calls(spark, *items):
    return spark.createDataFrame([(s, ts(t)) for s, t in items],
                                 "api_source string, called_at timestamp_ntz")


def test_cycles_are_anchored_at_calls(spark):
    df = calls(
        spark,
        ("a", "2024-01-01T10:00:00.900"), ("a", "2024-01-01T23:00:00"),
        ("a", "2024-01-31T09:59:59.999"),  # last second of the first cycle
        ("a", "2024-01-31T10:00:00.100"),  # starts the second one
        ("a", "2024-05-01T00:00:00"), ("b", "2024-02-01T00:00:00"),
    )
    got = quota.assign_cycles(df, CFG.quota_cycle_seconds)
    assert rows(got, "api_source", "cycle_start", "request_count") == [
        ("a", ts("2024-01-01T10:00:00"), 3), ("a", ts("2024-01-31T10:00:00"), 1),
        ("a", ts("2024-05-01T00:00:00"), 1), ("b", ts("2024-02-01T00:00:00"), 1)]


def test_building_the_query_starts_no_job(spark):
    df = calls(spark, *[(f"s{i % 5}", f"2024-01-{1 + i:02d}T00:00:00") for i in range(25)])
    spark.sparkContext.setJobGroup("lazy", "lazy")
    quota.assign_cycles(df, 7 * DAY)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def usage(spark, n, source="exchangerate", at="2024-01-10T12:00:00", throttled=False):
    df = calls(spark, *[(source, f"2024-01-01T00:00:{i % 60:02d}") for i in range(n)])
    if throttled:
        df = df.withColumn("throttled", quota.F.lit(True))
    return quota.quota_usage(quota.assign_cycles(df, CFG.quota_cycle_seconds), ts(at))


def by_source(df):
    return {r.api_source: r for r in df.collect()}


def test_usage_of_the_running_cycle(spark):
    got = by_source(usage(spark, 45))
    er = got["exchangerate"]
    assert (er.requests, er.quota, er.usage_pct, er.remaining) == (45, 50, 90.0, 5)
    assert (er.status, er.quota_warning, er.ttl_days_left) == ("active", True, 20.5)
    idle = got["currencylayer"]
    assert (idle.requests, idle.remaining, idle.ttl_days_left, idle.status) == (
        0, 100, 30.0, "active")


def test_expired_cycle_starts_afresh(spark):
    er = by_source(usage(spark, 50, at="2024-02-15T00:00:00"))["exchangerate"]
    assert (er.requests, er.status, er.remaining) == (0, "active", 50)


def test_exhausted_source_fails_over(spark):
    u = usage(spark, 50)
    assert by_source(u)["exchangerate"].status == "throttled"
    assert rows(quota.quota_failover(u), "api_source", "failover_to", "failover_available") == [
        ("exchangerate", "currencylayer", True)]


def test_throttle_mark_counts_for_its_cycle(spark):
    assert by_source(usage(spark, 1, throttled=True))["exchangerate"].status == "throttled"
    later = usage(spark, 1, throttled=True, at="2024-03-15T00:00:00")
    assert by_source(later)["exchangerate"].status == "active"


def test_unknown_sources_are_available(spark):
    wanted = spark.createDataFrame([("exchangerate",), ("other",)], "api_source string")
    assert rows(quota.quota_status(usage(spark, 50), wanted)) == [
        ("exchangerate", False), ("other", True)]


@pytest.mark.parametrize("second, third, mode, ask, taken", [
    (True, True, "daily", False, [1, 2]), (True, True, "daily", True, [1, 2, 3]),
    (False, True, "daily", False, [1, 3]), (False, False, "daily", False, [1, 3]),
    (True, True, "backfill", False, [1, 3]), (True, False, "backfill", True, [1])])
def test_gating(spark, second, third, mode, ask, taken):
    status = spark.createDataFrame([("exchangerate", second), ("currencylayer", third)],
                                   "api_source string, available boolean")
    names = ["frankfurter", "exchangerate", "currencylayer"]
    got = quota.source_gating(status, mode, ask).where("participates").collect()
    assert [r.api_source for r in got] == [names[i - 1] for i in taken]


@pytest.mark.parametrize("n", [2, 4])
def test_gating_of_any_number_of_sources(spark, n):
    sources = [replace(CFG.sources[0], name="s0"),
               replace(CFG.sources[1], name="s1", failover_to=f"s{n - 1}" if n > 2 else None),
               replace(CFG.sources[1], name="s2", failover_to=None),
               replace(CFG.sources[2], name="s3")][:n]
    status = spark.createDataFrame([("s1", False)], "api_source string, available boolean")

    def taken(mode, ask=False):
        got = quota.source_gating(status, mode, ask, sources).where("participates").collect()
        return sorted(r.api_source for r in got)

    assert taken("daily") == (["s0"] if n == 2 else ["s0", "s2", "s3"])
    assert taken("backfill") == (["s0"] if n == 2 else ["s0", "s3"])


def metered(spark, root, batches, days, delay="3 days"):
    """The stream over one file a micro-batch, run to its end; rows of the cycle table."""
    tables = RateTables(spark, f"{root}/tables")
    for batch in batches:
        calls(spark, *batch).coalesce(1).write.mode("append").parquet(f"{root}/calls")
        time.sleep(0.02)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(
        "api_source string, called_at timestamp_ntz").parquet(f"{root}/calls")
    query = stream_quota_meter(stream, tables, f"{root}/ckpt", days * DAY, delay=delay)
    query.awaitTermination()
    return tables, query


COLUMNS = ("api_source", "cycle_start", "request_count")


@pytest.mark.parametrize("seed, delay", [(1, "90 days"), (2, "10 days")])
def test_shuffled_micro_batches_equal_the_batch_result(spark, root, seed, delay):
    """Five batches; the second case settles and closes cycles on the way, within the delay of ten days."""
    draw = random.Random(seed)
    items = [("a" if i % 3 else "b", f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}T{i % 24:02d}:00:00")
             for i in range(84)] + [("c", "2024-02-03T00:00:00")] * 5
    whole = quota.assign_cycles(calls(spark, *items), 5 * DAY)
    if seed == 1:
        draw.shuffle(items)
    else:
        items.sort(key=lambda c: ts(c[1]) + timedelta(days=draw.random() * 9))
    size = -(-len(items) // 5)
    tables, query = metered(spark, root, [items[i:i + size] for i in range(0, len(items), size)], 5, delay)
    assert rows(tables.read("quota_cycles"), *COLUMNS) == rows(whole, *COLUMNS)
    assert late_rows(query) == 0 and sum(p.numInputRows > 0 for p in query.recentProgress) == 5
    closed = {r.cycle_start for r in tables.read("quota_cycles").where("closed").collect()}
    assert (len(closed) > 5) == (seed == 2)
    kept = query.recentProgress[-1].stateOperators[0].numRowsTotal
    if seed == 2:  # parts and cycle of at most the last ten days for a and b, nothing for c
        assert kept <= 2 * (10 + 2)


def test_late_calls_are_dropped_and_counted(spark, root):
    early = [("a", f"2024-01-{d:02d}T00:00:00") for d in range(1, 20)]
    batches = [early, [("a", "2024-01-19T12:00:00")], [("a", "2024-01-02T10:00:00"), ("a", "2024-01-18T13:00:00")]]
    tables, query = metered(spark, root, batches, 7, "2 days")
    assert late_rows(query) == 1
    assert rows(tables.read("quota_cycles"), *COLUMNS) == rows(
        quota.assign_cycles(calls(spark, *early, *batches[1], batches[2][1]), 7 * DAY), *COLUMNS)


def test_restart_goes_on_from_the_checkpoint(spark, root):
    first = [("a", f"2024-01-{d:02d}T00:00:00") for d in range(1, 8)]
    second = [("a", f"2024-01-{d:02d}T00:00:00") for d in range(8, 20)]

    def run(*batches):
        return rows(metered(spark, root, batches, 7)[0].read("quota_cycles"), "cycle_start", "request_count")

    assert run(first) == [(ts("2024-01-01T00:00:00"), 7)]
    want = [(ts("2024-01-01T00:00:00"), 7), (ts("2024-01-08T00:00:00"), 7),
            (ts("2024-01-15T00:00:00"), 5)]
    assert sorted(run(second)) == want
    assert sorted(run()) == want


def test_replayed_batch_is_not_counted_twice(spark, root):
    """The table was written but the stream died before it noted the batch as done."""
    tables = RateTables(spark, root)
    schema = QuotaMeter.OUT
    first = [("a", 0, 0, 5, False, False), ("a", 0, 700, 2, False, False), ("b", 9, 9, 1, True, False)]
    # A late call moves the second cycle of a; b is only reported closed.
    second = [("a", 0, 0, 6, False, False), ("a", 0, 650, 3, False, False), ("b", None, 9, 1, True, True)]
    for batch_id, changes in ((0, first), (0, first), (1, second), (1, second)):
        apply_changes(tables, "cycles", spark.createDataFrame(changes, schema), batch_id, 600)
    got = rows(tables.read("cycles"), "api_source", "cycle_start", "request_count", "throttled", "closed")
    start = ts("1970-01-01T00:00:00")
    assert sorted(got) == [
        ("a", start, 6, False, False), ("a", start + timedelta(seconds=650), 3, False, False),
        ("b", start + timedelta(seconds=9), 1, True, True)]


def test_calls_are_reduced_before_they_are_dealt(spark):
    df = calls(spark, *[("a", "2024-01-01T00:00:00")] * 500, *[("a", "2024-01-01T00:00:01")] * 500, (None, "2024-01-01T00:00:00"))
    got = reduced(df.coalesce(1)).collect()
    assert sorted((r.api_source, r.n, r.t) for r in got) == [("a", 500, False), ("a", 500, False)]
