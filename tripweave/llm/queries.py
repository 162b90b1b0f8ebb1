"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import chunk_dedup, decontaminate, html_text, ngram_join, packing, prefix_trie, quality_net, quality_rules, quotes, suffix_dedup, token_counts, treap_search, winnow
from tripweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.op1_chunk_dedup(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op2_suffix_dedup(table(spark, sf_dir, "documents"))


def op3_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.op3_quality_net(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op4_quality_rules(table(spark, sf_dir, "documents"))


def op5_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.op5_quote_links(table(spark, sf_dir, "conversations"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op6_decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op7_html_text(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8_packing(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op9_token_counts(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op10_ngram_join(table(spark, sf_dir, "documents"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.op11_winnowing(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.op12_prefix_trie(table(spark, sf_dir, "conversations"))


def op13_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.op13_treap_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registered() -> dict[str, Query]:
    found = (
        op1_chunk_dedup,
        op2_suffix_dedup,
        op3_quality_net,
        op4_quality_rules,
        op5_quote_links,
        op6_decontaminate,
        op7_html_text,
        op8_packing,
        op9_token_counts,
        op10_ngram_join,
        op11_winnowing,
        op12_prefix_trie,
        op13_treap_search,
    )
    return {f.__name__: f for f in found}
