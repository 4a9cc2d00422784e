"""A corpus pipeline: toxic documents and near-duplicates go, benchmark passages go, domains are mixed, ids are written.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.  ``run`` writes each stage's result as Parquet to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratelake.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from ratelake.llm.queries import TARGETS, domain_labels
from ratelake.llm.shared import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the lexicon doesn't reject; it is learned from the labelled rows still here."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate component."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rates; every document keeps one copy at least."""
    return mixing.mixed(docs, domain_labels(docs, table(spark, sf_dir, "labels")), TARGETS)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, read back from the written segments."""
    return token_files.token_index(docs, token_files.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_domains),
    ("token_ids", write_token_ids),
]

#: Learned scores, fitted rates and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
