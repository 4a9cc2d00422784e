"""Small helpers of the text operators: tables, folds, stored steps, bounded samples."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.session import scratch_path

#: Fixed value: space and 0x09-0x0D, the white space of every contract.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> None:
    """Arrow batches of a few MB, unless the session has a setting of its own.

    Texts differ in length by four powers of ten, so batches are bounded by bytes, not by rows.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, "8m")


_kept: dict[str, tuple[int, Any]] = {}


def kept_for_stage(name: str, build: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps for its tasks of one stage; other stages let it go."""
    stage = TaskContext.get().stageId()
    if name not in _kept or _kept[name][0] != stage:
        _kept[name] = (stage, build())
    return _kept[name][1]


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` for mapInArrow, in a worker that hands memory back between tasks.

    Workers live through many stages; without this each keeps the most that any stage needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_other_stages()
        try:
            yield from function(batches)
        finally:
            return_memory()

    return run


def forget_other_stages() -> None:
    stage = TaskContext.get().stageId()
    for name in [n for n, (s, _) in _kept.items() if s != stage]:
        del _kept[name]


def return_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id gets fold 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(folds)), F.lit(0)).cast("int")


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of the key: the same rows on every run."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(rows)


def sample_per_group(df: DataFrame, group: str, key: str, rows: int, salts: int = 256) -> DataFrame:
    """At most ``rows`` rows of each group, chosen by hash of the key: the same rows on every run.

    Groups are ranked in salted parts first, so that a large group meets in no single task.
    """
    part = F.pmod(F.xxhash64(key), F.lit(salts))
    order = [F.xxhash64(F.col(key), F.lit("order")), F.col(key)]
    each = -(-4 * rows // salts)
    few = df.withColumn("__part", part).withColumn("__rank", F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)))
    few = few.where(F.col("__rank") <= each)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return few.where(F.col("rank") <= rows).drop("__part", "__rank")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the labelled rows outside the held-out fold.

    The ids are chosen before texts move, so only the sampled texts are sent anywhere.  Null labels
    and null ids are no training rows; repeated rows of an id count once.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold("doc_id", folds) != held))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    chosen = bounded_sample(chosen, "doc_id", rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
