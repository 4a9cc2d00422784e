"""Quota cycles over a stream of API calls, kept as keyed state.

Calls are first reduced to one row per source and second within each Arrow batch, so a source that makes
most of the calls sends few rows.  ``QuotaMeter`` then keeps, per source, the cycle that was running at the
watermark and the busy seconds behind it, packed by part of the day.  A call may arrive in any order within the
delay: the chain of cycles is made anew from the settled one over the packed seconds.  Event-time timers
settle a part once the watermark has passed it, and close a cycle once it has expired, so the state of a source
is bounded by the delay, not by its calls or its history.

Calls older than the watermark are dropped by Spark and counted in the query's progress
(``late_rows``).  The sink replaces the cycles of a source from the first one that may have changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ratelake.functions.columns import epoch_second, second_to_ntz
from ratelake.schemas import CYCLES
from ratelake.sources.tables import RateTables

#: Seconds of one part of the day in the state.
PART = 3 * 3600
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Cycle = tuple[int, int, bool]


def chain(settled: Cycle | None, seconds: np.ndarray, counts: np.ndarray, marks: np.ndarray, length: int) -> list[Cycle]:
    """Cycles (start, calls, throttled) from the settled one on; ``seconds`` are sorted and distinct."""
    cycles = [] if settled is None else [settled]
    at = 0
    while at < len(seconds):
        if not cycles or seconds[at] >= cycles[-1][0] + length:
            cycles.append((int(seconds[at]), 0, False))
        start, calls, throttled = cycles[-1]
        end = int(np.searchsorted(seconds, start + length))
        cycles[-1] = (start, calls + int(counts[at:end].sum()), throttled or bool(marks[at:end].any()))
        at = end
    return cycles


def merge_seconds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seconds, counts, marks) of both, sorted, each second once."""
    seconds, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts, marks = np.zeros(len(seconds), np.int64), np.zeros(len(seconds), bool)
    np.add.at(counts, place, np.concatenate([a[1], b[1]]))
    np.logical_or.at(marks, place, np.concatenate([a[2], b[2]]))
    return seconds, counts, marks


class QuotaMeter(StatefulProcessor):
    """Cycles of one source.

    Rows out: (api_source, restart, start_sec, request_count, throttled, closed).  ``restart`` is null
    where a cycle is only reported closed; else the source's cycles from there on are those given.
    """

    OUT = "api_source string, restart long, start_sec long, request_count long, throttled boolean, closed boolean"

    def __init__(self, length_seconds: int):
        self._length = length_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._settled = handle.getValueState("settled", "start long, calls long, throttled boolean")
        self._parts = handle.getMapState("parts", "part long", "seconds binary, counts binary, marks binary")

    def close(self) -> None:
        pass

    # -- state ------------------------------------------------------------------------------

    def _running(self) -> Cycle | None:
        return tuple(self._settled.get()) if self._settled.exists() else None

    @staticmethod
    def _unpack(value) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.frombuffer(bytes(v), t) for v, t in zip(value, (np.int64, np.int64, bool)))

    def _between(self, parts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = [self._unpack(self._parts.getValue((p,))) for p in sorted(parts)]
        if not columns:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(c) for c in zip(*columns))

    def _rows(self, source: str, cycles: list[Cycle], restart: int | None, closed: bool) -> pd.DataFrame:
        rows = [(source, restart, s, n, t, closed) for s, n, t in cycles]
        frame = pd.DataFrame(rows, columns=["api_source", "restart", "start_sec", "request_count", "throttled", "closed"])
        return frame.astype({"restart": "Int64"})

    # -- events -----------------------------------------------------------------------------

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows))
        part = fresh["sec"].to_numpy(np.int64) // PART
        for p in np.unique(part).tolist():
            here = fresh[part == p]
            new = (here["sec"].to_numpy(np.int64), here["n"].to_numpy(np.int64), here["t"].to_numpy(bool))
            known = self._parts.containsKey((p,))
            old = self._unpack(self._parts.getValue((p,))) if known else tuple(c[:0] for c in new)
            self._parts.updateValue((p,), tuple(c.tobytes() for c in merge_seconds(old, new)))
            if not known:
                self._handle.registerTimer((p + 1) * PART * 1000)
        cycles = chain(self._running(), *self._between([k[0] for k in self._parts.keys()]), self._length)
        yield self._rows(key[0], cycles, cycles[0][0], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Settle the parts that the watermark has passed; report cycles that can't change any more."""
        now = timerValues.getCurrentWatermarkInMs() // 1000
        done = [k[0] for k in self._parts.keys() if (k[0] + 1) * PART <= now]
        cycles = chain(self._running(), *self._between(done), self._length)
        for p in done:
            self._parts.removeKey((p,))
        closed = [c for c in cycles[:-1]]
        if cycles and cycles[-1][0] + self._length <= now and not self._open_before(cycles[-1][0] + self._length):
            closed.append(cycles[-1])
            self._settled.clear()
        elif cycles:
            self._settled.update(cycles[-1])
            self._handle.registerTimer(max((cycles[-1][0] + self._length) * 1000, timerValues.getCurrentWatermarkInMs() + 1))
        yield self._rows(key[0], closed, None, True)

    def _open_before(self, second: int) -> bool:
        """Whether a part that is still open may hold calls before ``second``."""
        return any(k[0] * PART < second for k in self._parts.keys())


def reduced(calls: DataFrame) -> DataFrame:
    """(api_source, sec, n, t): one row per source and second of each Arrow batch."""
    marks = F.col("throttled") if "throttled" in calls.columns else F.lit(False)
    rows = calls.where("api_source IS NOT NULL AND called_at IS NOT NULL").select(
        "api_source", epoch_second(F.col("called_at")).alias("sec"), F.coalesce(marks, F.lit(False)).alias("t")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(["api_source", "sec"], use_threads=False)
            found = table.aggregate([("sec", "count"), ("t", "max")]).rename_columns(["api_source", "sec", "n", "t"])
            yield from found.to_batches()

    return rows.mapInArrow(count, "api_source string, sec long, n long, t boolean")


def metered(calls: DataFrame, length_seconds: int, delay: str = "3 days") -> DataFrame:
    """Changes of cycles, see ``QuotaMeter``; calls up to ``delay`` behind the newest one count."""
    timed = reduced(calls).withColumn("at", F.timestamp_seconds("sec")).withWatermark("at", delay)
    return timed.groupBy("api_source").transformWithStateInPandas(
        statefulProcessor=QuotaMeter(length_seconds), outputStructType=QuotaMeter.OUT, outputMode="Update", timeMode="EventTime"
    )


def apply_changes(tables: RateTables, table: str, changes: DataFrame, batch_id: int, length_seconds: int) -> None:
    """Bring the cycle table, one slice a source, to the state the changes tell; twice is as good as once."""
    changes = changes.persist()
    try:
        new = changes.groupBy("api_source", "start_sec").agg(
            F.max("request_count").alias("request_count"), F.max("throttled").alias("throttled"), F.max("closed").alias("closed")
        )
        fresh = new.select(
            "api_source",
            second_to_ntz(F.col("start_sec")).alias("cycle_start"),
            second_to_ntz(F.col("start_sec") + length_seconds).alias("cycle_end"),
            "request_count",
            "throttled",
            "closed",
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        restarts = changes.groupBy("api_source").agg(F.min("restart").alias("restart"))
        stored = tables.read(table, CYCLES)
        kept = stored.join(restarts, "api_source").where(
            F.col("restart").isNull() | (epoch_second(F.col("cycle_start")) < F.col("restart"))
        )
        kept = kept.join(fresh.select("api_source", "cycle_start"), ["api_source", "cycle_start"], "left_anti")
        tables.replace_slices(table, kept.select(fresh.columns).unionByName(fresh), "api_source")
    finally:
        changes.unpersist()


def late_rows(query: StreamingQuery) -> int:
    """Rows, one a source and second at most, that came after the delay in the query's recent progress."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def stream_quota_meter(
    calls: DataFrame,
    tables: RateTables,
    checkpoint: str,
    length_seconds: int,
    table: str = "quota_cycles",
    available_now: bool = True,
    delay: str = "3 days",
) -> StreamingQuery:
    """Keep ``table`` at the request count of every cycle, the running ones included.

    A batch that is replayed after a failure gives the same changes from the same state.
    """
    spark = calls.sparkSession
    if spark.conf.get(STATE_STORE, "").rsplit(".", 1)[-1] != "RocksDBStateStoreProvider":
        spark.conf.set(STATE_STORE, ROCKSDB)

    def store(batch: DataFrame, batch_id: int) -> None:
        apply_changes(tables, table, batch, batch_id, length_seconds)

    changes = metered(calls, length_seconds, delay)
    writer = changes.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
