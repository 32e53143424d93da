"""The registered queries of this package over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm.best_fit_packing import best_fit_packing
from wellspring.llm.jaccard_join import near_duplicates
from wellspring.llm.lsh_forest import forest_near_duplicates
from wellspring.llm.pii import find_personal_data
from wellspring.llm.prefix_trie import conversation_trie
from wellspring.llm.quality_rules import quality_rules
from wellspring.llm.secret_scan import find_secrets
from wellspring.llm.source_mix import mix_sources
from wellspring.llm.substring_dedup import repeated_passages
from wellspring.llm.suffix_tree_lm import suffix_tree_scores
from wellspring.llm.topk_search import topk_search
from wellspring.llm.toxicity import toxicity_scores
from wellspring.llm.whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_documents(spark, sf_dir))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(_documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_documents(spark, sf_dir))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_near_duplicates(_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_source_mix": op6_source_mix,
    "op7_suffix_tree_lm": op7_suffix_tree_lm,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_topk_search": op10_topk_search,
    "op11_whitening": op11_whitening,
    "op12_lsh_forest": op12_lsh_forest,
    "op13_prefix_trie": op13_prefix_trie,
}
