"""Landing files to silver tables as a stream, with a bound on lateness.

A record that is delivered again while its first delivery is less than ``delay`` ago is dropped by keyed state
(``dropDuplicatesWithinWatermark`` over the time of arrival), whatever file it comes in.  What arrives for the first
time is upserted; the newest extraction per key wins in any order of arrival.

A record whose extraction lies more than ``late_days`` behind the newest one of all earlier batches is too late: it goes
whole to the side table ``<table>_late`` and its date is not opened again.  ``<table>_batches`` tells per batch
what came: rows, too late, and the newest extraction so far.  A replayed batch finds the same
bound there and writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelake.operators.ranking import newest_order
from ratelake.operators.silver import (
    SILVER_KEYS,
    clean_map_keys,
    dedup_latest,
    records_from_json_lines,
)
from ratelake.sources.tables import RateTables

#: What makes two deliveries the same record.
RECORD = ("extraction_id", "extraction_timestamp", "source", "base_currency", "rate_date")
BATCHES = "batch_id long, rows long, late long, newest timestamp_ntz"


def landing_stream(
    spark: SparkSession, path: str, name_glob: str = "*.json*", files_per_trigger: int = 1000
) -> DataFrame:
    """New landing files as records."""
    lines = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .schema("value string")
        .text(path)
    )
    return records_from_json_lines(lines)


def first_deliveries(records: DataFrame, delay: str) -> DataFrame:
    """Records without those delivered before within ``delay``; state is kept for that long."""
    arrived = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(list(RECORD)).drop("_arrived")


def apply_batch(
    tables: RateTables, table: str, batch: DataFrame, batch_id: int, keys: Sequence[str], late_days: int
) -> None:
    """One micro-batch into silver, side table and batch table."""
    spark = tables.spark
    told = tables.read(f"{table}_batches", spark.createDataFrame([], BATCHES).schema)
    before = told.where(F.col("batch_id") < batch_id)
    newest = before.agg(F.max("newest")).first()[0]
    bound = F.lit(newest) - F.make_interval(days=F.lit(late_days))
    late = F.coalesce(F.col("extraction_timestamp") < bound, F.lit(False)) if newest is not None else F.lit(False)
    batch = batch.withColumn("_late", late).persist()
    try:
        if batch.isEmpty():
            return
        in_time = clean_map_keys(batch.where("NOT _late").drop("_late"))
        tables.upsert(table, dedup_latest(in_time, keys), keys, order=newest_order())
        too_late = batch.where("_late").drop("_late")
        tables.upsert(f"{table}_late", too_late.dropDuplicates(list(RECORD)), RECORD)
        counts = batch.agg(
            F.lit(batch_id).cast("long").alias("batch_id"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_late").alias("late"),
            F.greatest(F.max("extraction_timestamp"), F.lit(newest).cast("timestamp_ntz")).alias("newest"),
        )
        tables.upsert(f"{table}_batches", counts, ("batch_id",), date_col=None)
    finally:
        batch.unpersist()


def stream_land_to_silver(
    records: DataFrame,
    tables: RateTables,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = SILVER_KEYS,
    available_now: bool = True,
    late_days: int = 3,
) -> StreamingQuery:
    """Upsert each micro-batch; a batch rewrites only the dates it has rows for."""

    def load(batch: DataFrame, batch_id: int) -> None:
        apply_batch(tables, table, batch, batch_id, keys, late_days)

    fresh = first_deliveries(records, f"{late_days} days")
    writer = fresh.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
