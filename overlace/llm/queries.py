"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from overlace.llm import decontaminate, exactdup, trie, urls
from overlace.llm.common import table


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.lines import line_report

    return line_report(table(spark, sf_dir, "documents"))


def op3_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.lm import score

    return score(table(spark, sf_dir, "documents"))


def op4_token_indexed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.pii import pseudonyms

    return pseudonyms(table(spark, sf_dir, "documents"), key="public test key")  # a real key is a secret of the caller


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_fuse_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.exactdup import table_duplicates

    return table_duplicates(table(spark, sf_dir, "documents"))


def op8_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op9_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_shared_dictionary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.idfiles import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.trie import prefix_trie, rebuilt

    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from overlace.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_winnowing, op2_fuzzy_lines, op3_context_tree_weighting, op4_token_indexed_urls, op5_feistel_pseudonyms, op6_minmax_near_dedup, op7_fuse_exact_dedup, op8_certified_packing, op9_factorisation_machine, op10_subword_toxicity, op11_shared_dictionary_ids, op12_prefix_trie, op13_block_whitening)}

SQL: dict[str, str] = {"op1_winnowing": decontaminate.SQL, "op4_token_indexed_urls": urls.SQL, "op7_fuse_exact_dedup": exactdup.SQL, "op12_prefix_trie": trie.SQL}
