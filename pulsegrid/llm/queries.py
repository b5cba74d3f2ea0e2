"""The subpackage's queries, one for each operator over its whole table, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import decontaminate, fillmiddle, fingerprints, htmltext, lexical, minhash, mixing, pitman_yor, repeats, sharding, simhash, toolcalls, toxicity
from pulsegrid.llm.common import table


def op1_linked_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.report(table(spark, sf_dir, "conversations"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_report(table(spark, sf_dir, "documents"))


def op3_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixture_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op6_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op7_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.report(table(spark, sf_dir, "pages"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


def op10_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.shared_passages(table(spark, sf_dir, "documents"))


def op11_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillmiddle.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_linked_tool_calls, op2_document_fingerprints, op3_pitman_yor_scores, op4_toxicity, op5_mixture_sample, op6_stratified_shards, op7_visible_text, op8_benchmark_decontamination, op9_simhash_near_duplicates, op10_shared_passages, op11_minhash_near_duplicates, op12_ranked_search, op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_linked_tool_calls": toolcalls.ORACLE, "op5_mixture_sample": mixing.ORACLE, "op6_stratified_shards": sharding.ORACLE, "op8_benchmark_decontamination": decontaminate.ORACLE, "op12_ranked_search": lexical.ORACLE, "op13_fill_in_middle": fillmiddle.ORACLE}
