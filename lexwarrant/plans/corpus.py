"""The supplied tables as a corpus: collections, candidates and a source dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.registry import checkability
from ..functions.text import keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("source", F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("locator"), "text")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.explode(keys(F.col("text"))).alias("word")).distinct()


def number(source: Column) -> Column:
    return F.substring(source, 4, 9).cast("int")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty sources in seven families; some don't rank, some say in which year they looked."""
    ids = table(spark, sf_dir, "documents").select(F.col("source").alias("id")).distinct()
    n = number(F.col("id"))
    rows = ids.select(
        "id", F.concat(F.lit("f"), (n % 7).cast("string")).alias("family"), F.when(n % 3 == 0, "url").otherwise("template").alias("locator_kind"),
        F.when(n % 3 != 0, F.concat(F.lit("https://example.org/"), "id", F.lit("/{id}/text{id}.txt"))).alias("template"),
        (n % 5 != 4).alias("ranks"), F.when(n % 6 == 5, "2020").alias("as_of"),
    )
    return rows.withColumn("checkability", checkability(F.col("id"), F.col("family"), F.col("as_of")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").alias("seq"), F.col("url").alias("locator"), "html")
