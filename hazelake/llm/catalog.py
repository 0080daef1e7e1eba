"""Registered queries of the subpackage: opN_<name> for every operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazelake.llm import ann, bpe, decontam, langid, lm, neardup, periodic, pii, quality, rankfold, repeats, resample, suffixes
from hazelake.llm.arrays import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digests(table(spark, sf_dir, "documents"))


def op6_learned_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digests(table(spark, sf_dir, "documents"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


def op13_rank_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankfold.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_quality_fm, op3_decontaminate, op4_minmax_neardup, op5_kneser_ney, op6_learned_ann, op7_seed_extend, op8_bpe, op9_language, op10_pii_surrogates, op11_importance_resample, op12_periodic_runs, op13_rank_fold)}


def oracle_sql() -> dict[str, str]:
    return {"op11_importance_resample": resample.ORACLE_SQL}
