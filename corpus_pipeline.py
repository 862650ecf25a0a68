"""A training corpus from raw documents: five stages, each written as Parquet and reread as the next one's documents.

Every stage works on all rows that the one before it kept.  Defined results: an empty table passes through all stages;
null and empty texts are neither toxic nor copies nor leaks and are kept by the first three stages; equal rows meet the
same fate, but for the second stage, which keeps one of them; columns that the stages don't name travel along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import op1_toxicity, op4_near_dedup, op5_mixing, op8_decontaminate, op9_sharding
from tidegrid.llm.common import fold, materialise, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores 0.5 or more go; it learns from the labelled rows outside fold 0."""
    model = op1_toxicity.fit(op1_toxicity.labelled_train(docs, table(spark, sf_dir, "labels"), "toxic"))
    return op1_toxicity.reject(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id; rows with a null id stay if no other has their text's shingles."""
    return op4_near_dedup.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op8_decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).where("n_items = 0").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken at the rates that bring the domains' tokens to the operator's target weights."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    return op5_mixing.mixed(docs, labels)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row written to its shard; the result is read back from there, with ``shard_no`` and ``slot`` beside the row.

    Where the documents have columns of these names, the new ones get underscores in front.
    """
    name = lambda c: c if c not in docs.columns else name(f"_{c}")
    return op9_sharding.shard(docs).select("row.*", F.col("shard").alias(name("shard_no")), F.col("slot").alias(name("slot")))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mixing", mixing), ("sharding", sharding)]

#: The grammar's learned weights and the forest are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
