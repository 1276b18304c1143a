"""Training-data pipeline over ``documents``: five stages, each on what the last kept.

Toxic documents go; lines that repeat earlier ones are cut; one document of each
near-duplicate group stays; documents that hold a benchmark item go; the rest is
encoded. Stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadbed.llm import bpe, decontam, line_dedup, simhash, toxicity
from roadbed.llm.common import on_workers
from roadbed.session import stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: learned models, edit distances and BPE are beyond SQL; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
