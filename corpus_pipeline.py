"""The training-data pipeline: five stages, each over all that the one before it kept.

All stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridlark.llm import mixing, pieces, rules, simhash, toxicity
from gridlark.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, "doc_id", "text", "doc_id", "toxic")
    return toxicity.filtered(docs, "text", model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.filtered(docs, "text", rules.POLICIES["v1"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(docs, "doc_id", "source", "text")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# SQL has neither the training of stage one nor the rounding of stage four.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each reading what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
