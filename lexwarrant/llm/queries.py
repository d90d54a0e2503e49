"""One query for each operator of this subpackage, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fim, fingerprints, jaccard_join, language_id, line_templates, media, mixing, near_dedup, oracles, packing, secret_scan, token_counts, toxicity, whitening


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_report(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), width=4)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(documents(spark, sf_dir))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(documents(spark, sf_dir))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(documents(spark, sf_dir))


QUERIES = (
    op1_pack, op2_token_counts, op3_line_templates, op4_toxicity, op5_language,
    op6_near_duplicates, op7_fingerprints, op8_secrets, op9_media, op10_mix,
    op11_jaccard_join, op12_whiten, op13_fill_in_middle,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_near_duplicates": oracles.NEAR_DUPLICATES, "op10_mix": oracles.MIX, "op11_jaccard_join": oracles.JACCARD_JOIN, "op13_fill_in_middle": oracles.FILL_IN_MIDDLE}
