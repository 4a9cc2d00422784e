"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical without white space.  Copies are combined in three steps,
each of which compares whole contents (the content is a grouping key beside its digest): inside a
map task, then per (digest, salt), then per digest.  Only the winners of one step go to the next, so
a group with a third of all rows reaches its last task as one row per salt.

Null texts count as empty and form one group.  Equal rows (same id, same text) are counted and
answered one by one.  Ties go to the smaller doc_id; a null doc_id loses every tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import SPACES

SALTS = 64


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``."""
    keyed = docs.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("length"),
        normalised(F.col("text")).alias("content"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    ).withColumns({"digest": F.unhex(F.sha2("content", 256)), "check": F.xxhash64("content")})
    identity = ["digest", "check"]
    rank = F.struct("length", (-F.col("doc_id")).alias("minus_id"))
    salted = keyed.groupBy(*identity, "salt", "content").agg(F.max(rank).alias("best"), F.count("*").alias("n"))
    winners = salted.repartition(*identity).groupBy(*identity, "content").agg(
        F.max("best").alias("best"), F.sum("n").alias("n"), F.collect_set("salt").alias("salts")
    )
    # Rows are answered by digest and a second hash; contents that differ in spite of both stop the job.
    groups = winners.groupBy(*identity).agg(
        F.count("*").alias("contents"), F.max(-F.col("best.minus_id")).alias("keep_id"), F.sum("n").alias("group_size"), F.first("salts").alias("salts")
    )
    keep_id = F.when(F.col("contents") == 1, F.col("keep_id")).otherwise(F.raise_error(F.lit("different texts share a digest")))
    # The answers go back by the salts that a group has rows in, so a large group's rows stay spread.
    answers = groups.select(*identity, keep_id.alias("keep_id"), "group_size", F.explode("salts").alias("salt"))
    joined = keyed.select("doc_id", *identity, "salt").join(answers.hint("merge"), [*identity, "salt"])
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns; of equal rows with one id, each stays.

    A row stays for its own text: rows that share an id but not the text are told apart by it.
    """
    kept = exact_groups(docs, salts).where("kept").select("doc_id", "text_sha256").distinct()
    kept = kept.withColumnsRenamed({"doc_id": "__id", "text_sha256": "__sha"})
    own = F.sha2(normalised(F.col("text")), 256)
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (own == F.col("__sha")), "left_semi")
