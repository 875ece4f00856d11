"""A training-data pipeline over `documents`: score, deduplicate, decontaminate, pseudonymise, encode.

Each stage takes what its predecessor kept, and all but the last return the columns of
`documents`. Documents that the toxicity model rejects go; of near duplicates (word
5-grams, similarity 0.8) one stays; documents in which a window of the benchmark stands
go; personal data is replaced; and what is left is encoded and decoded.
"""

from __future__ import annotations

import public_tokenizers
from gaugeflow.llm.bpe import encoded_documents
from gaugeflow.llm.decontamination import without_contaminated
from gaugeflow.llm.minhash_forest import one_per_class
from gaugeflow.llm.names import free_name
from gaugeflow.llm.pii import application_key, pseudonymise
from gaugeflow.llm.toxicity import train
from gaugeflow.session import materialize
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scores from here on are rejected.
TOXIC = 0.5
#: The public tokenizer's ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: The scores come from trained models and the encoding from a vocabulary, which SQL cannot express.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones, does not reject."""
    model = train(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                  spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name("toxicity", docs.columns)
    return model.scored(docs, score).where(F.col(score) < TOXIC).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return pseudonymise(docs, application_key(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens and digests of the documents that are left."""
    return encoded_documents(docs, RANKS)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
