"""Documents to training tokens: quality rules, near-duplicates, secrets, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, ngram_join, pareto, rules, secrets
from tidemark.llm.common import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules stay, unchanged."""
    return rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return ngram_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced and ``n_chars`` follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times."""
    return pareto.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document, ids as little-endian unsigned 32-bit integers."""
    coded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", secret_scan),
    ("mix of sources", source_mix),
    ("BPE", encode),
]

#: Secrets and codes have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
