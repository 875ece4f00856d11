"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm.bpe import encoded_documents
from gaugeflow.llm.collocations import collocations
from gaugeflow.llm.decontamination import contamination
from gaugeflow.llm.exact_dedup import mark_duplicates
from gaugeflow.llm.minhash_forest import jaccard_join
from gaugeflow.llm.mtree import top_k
from gaugeflow.llm.pii import application_key, pseudonymise
from gaugeflow.llm.prefix_trie import conversation_trie
from gaugeflow.llm.quality import quality_scores
from gaugeflow.llm.suffix_index import remove_repeats
from gaugeflow.llm.token_attribution import line_tokens
from gaugeflow.llm.toxicity import toxicity_scores
from gaugeflow.llm.warc import archive_round_trip

#: The public tokenizer's ranks; a parameter of the operators.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with the calibrated trees."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the bytes of every 100-byte string that also starts earlier."""
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, copies and links of every document at a similarity of 0.8 over word 5-grams."""
    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and the number of mentions."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(documents, application_key(spark), count="n_mentions")


@query
def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of the ids and of the decoded bytes."""
    return encoded_documents(table(spark, sf_dir, "documents"), RANKS)


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with the factorisation machine."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    return top_k(table(spark, sf_dir, "embeddings"))


@query
def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives, read them back, and describe the records."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


@query
def op9_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of whole documents, given to their lines."""
    return line_tokens(table(spark, sf_dir, "documents"), RANKS)


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a shared window, and the items found."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group size, the row that stays and the digest of every document."""
    return mark_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words per language."""
    return collocations(table(spark, sf_dir, "documents"))
