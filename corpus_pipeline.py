"""Documents to packed training sequences: five stages over the operators of textloom.llm.

Each stage takes all rows its predecessor kept and returns them with the columns of documents,
but for the last, which returns the packed pieces. Null texts count as empty, an empty table
passes through, and columns beside doc_id and text are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import packing, pii, rule_ensemble, simhash, toxicity
from textloom.session import materialise


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return rule_ensemble.accepted(docs, _labels(spark, sf_dir))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return toxicity.accepted(docs, _labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, width=3, reach=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in as few sequences as possible: their pieces with ids, sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxic),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", pack),
]

#: The fitted models and the fingerprints cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
