"""The operators of this folder as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    cotrain,
    crf_html,
    mih,
    near_dedup,
    near_dedup_sql,
    ngram_join,
    ngram_join_sql,
    pareto,
    pareto_sql,
    prefix_trie,
    prefix_trie_sql,
    pst,
    repair,
    rules,
    rules_sql,
    secrets,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_table(spark, sf_dir, "documents"))
    return judged.withColumn("failed_rules", F.array_join("failed_rules", ","))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])

    def number(kind: int) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long")

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kinds"]), s["starts"], s["ends"])), ","
        )

    spans = F.arrays_zip("kinds", "starts", "ends")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(written(F.filter(spans, lambda s: s["kinds"] < 3)).cast("binary"), 256).alias("base_sha256"),
        written(spans).alias("spans"),
        number(3).alias("n_guess"),
        F.col("top_log10"),
    )


def op2_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score_texts(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(_table(spark, sf_dir, "embeddings"))


def op5_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return cotrain.score_texts(docs, cotrain.fit(docs, _table(spark, sf_dir, "labels")))


def op6_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.mix(_table(spark, sf_dir, "documents"))


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode_texts(_table(spark, sf_dir, "documents"), path, decoded=True)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return crf_html.extract(pages, crf_html.fit(pages))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"), rebuild=True)
    return nodes.drop("node", "parent")


def op12_bottom_k_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.audit(repair.damage(conversations), conversations)


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_suffix_tree_scores": op2_suffix_tree_scores,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_multi_index_hashing": op4_multi_index_hashing,
    "op5_cotraining_quality": op5_cotraining_quality,
    "op6_weak_supervision_toxicity": op6_weak_supervision_toxicity,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_bpe_automaton": op8_bpe_automaton,
    "op9_quality_rules": op9_quality_rules,
    "op10_crf_main_text": op10_crf_main_text,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bottom_k_dedup": op12_bottom_k_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": ngram_join_sql.SQL,
    "op7_pareto_mix": pareto_sql.mix_sql(),
    "op9_quality_rules": rules_sql.SQL,
    "op11_prefix_trie": prefix_trie_sql.SQL,
    "op12_bottom_k_dedup": near_dedup_sql.SQL,
}
