"""A training corpus in five stages: toxicity, exact and near duplicates, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import exact, minhash, pack, pii, toxicity
from parcelflow.llm.common import materialize, temporary

def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near(docs, words=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).drop("ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("minhash_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Models and signatures have no SQL form; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again.

    An empty table gives no pieces.  Every stage decides row by row, so rows that repeat an id or have none
    are documents like others.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary() as keep:  # the working tables of a stage go once its result is written
            docs = keep(materialize(stage(spark, docs, sf_dir), name))
    return docs
