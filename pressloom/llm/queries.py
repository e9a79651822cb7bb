"""The queries of this subpackage and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressloom.llm import codebooks, decontaminate, hmm, langid, mixing, neardup, oracles, periodic, pii, quality, secrets, spans, toxicity, warc
from pressloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


@query("op2_benchmark_decontamination", oracles.DECONTAMINATION)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_source_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op6_minhash_near_dedup", oracles.NEAR_GROUPS)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"), size=4)


@query("op8_quality_rules", oracles.QUALITY)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(table(spark, sf_dir, "documents"))


@query("op9_hidden_markov_lm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.held_out_report(table(spark, sf_dir, "documents"))


@query("op10_ppm_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_report(table(spark, sf_dir, "documents"))


@query("op7_markov_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op5_pii_boosted_candidates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op1_sentence_span_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(table(spark, sf_dir, "documents"))


@query("op3_warc_chunk_records", oracles.ARCHIVES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


@query("op12_dual_tree_codes", oracles.CODEBOOKS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.report(table(spark, sf_dir, "embeddings"))


@query("op13_crf_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
