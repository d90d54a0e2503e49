"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and gives what it keeps to the next one, through a table in the
shared folder. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexwarrant.llm import language_id, line_templates, mixing, near_dedup, packing
from lexwarrant.storage import write_table

#: Below this a text's language is too uncertain; half means that another is as likely.
LEAST_LANGUAGE_SCORE = 0.5
#: Languages that go on; None lets all of them through.
WANTED_LANGUAGES: frozenset[str] | None = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on, with the language found as their ``lang``; those without
    letters or without a clear language don't."""
    return language_id.with_known_language(docs, LEAST_LANGUAGE_SCORE, WANTED_LANGUAGES)


def drop_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, and documents that were nothing else."""
    return line_templates.cleaned_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [("language_id", identify), ("line_dedup", drop_templates), ("near_dedup", deduplicate), ("mixing", mix), ("packing", pack)]

#: No SQL: language scores and MinHash values aren't expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
