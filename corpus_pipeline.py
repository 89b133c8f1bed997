"""The corpus pipeline: stages over the documents table, each written and read again before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import decontaminate, mixing, secrets, simhash, toxicity
from fieldloom.llm.common import table
from fieldloom.session import checkpoint_root


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_first(docs, words=3, max_bits=3, seed=42)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secrets.masked(docs, secrets.ledger_path(spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to target weights: one row for each copy of a document, numbered by ``copy``."""
    return mixing.mix(docs, weights=(5, 2, 1), max_repeats=3, seed=42)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_near_copies),
    ("decontamination", without_test_items),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

#: SQL can express neither the trained classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = table(spark, sf_dir, "documents"), f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{number}-{name}")
        docs = spark.read.parquet(f"{root}/{number}-{name}")
    return docs
