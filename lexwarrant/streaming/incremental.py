"""Incremental use: documents as they arrive, evidence by source, harvests that resume.

Counting streams: files of documents come in, and (source, word) counts are kept up to date. Evidence is
a table partitioned by source, of which a run replaces the partitions of the sources it scanned.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import keys
from ..operators.scan import Scan
from . import commits

#: How late a fetched page may come and still be known as one fetched before.
REMEMBERED = "30 days"


def document_stream(spark: SparkSession, path: str, schema: str = "source string, seq long, locator string, text string", files: int = 1000) -> DataFrame:
    """Documents from Parquet files as they are added to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source, word, n) over a stream, updated as documents come. ``candidates`` is a plain frame."""
    words = docs.select("source", F.explode(keys(F.col("text"))).alias("word"))
    return words.join(candidates.select("word").distinct(), "word", "left_semi").groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"))


def stream_totals(docs: DataFrame) -> DataFrame:
    """(source, tokens) over a stream."""
    return docs.select("source", F.size(keys(F.col("text"))).cast("long").alias("n")).groupBy("source").agg(F.sum("n").alias("tokens"))


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a counting stream over what has arrived, each state written whole as Parquet under ``path``."""

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def record(scan: Scan, path: str) -> None:
    """Replace the evidence of the sources scanned; that of others stays as it was recorded."""
    for name, frame in (("hits", scan.hits), ("totals", scan.totals)):
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(f"{path}/{name}")


def recorded(spark: SparkSession, path: str) -> Scan:
    """The evidence recorded so far."""
    hits = spark.read.schema("word string, count long, locators array<string>, source string").parquet(f"{path}/hits")
    totals = spark.read.schema("tokens long, source string").parquet(f"{path}/totals")
    return Scan(totals.select("source", "tokens"), hits.select("source", "word", "count", "locators"))


def new_pages(found: DataFrame, harvested: DataFrame) -> DataFrame:
    """Addresses not harvested before, each once."""
    return found.dropDuplicates(["url"]).join(harvested.select("url"), "url", "left_anti")


#: A harvested page: its address, domain and candidate words with their counts, by word.
HARVESTED = "url string, domain string, words array<struct<word:string,n:bigint>>"


def append_harvest(pages: DataFrame, candidates: DataFrame, path: str, lost: threading.Event | None = None) -> None:
    """Append (url, domain, words) of pages(url, domain, text) to the harvest; a run commits whole or not at all."""
    # a null stands for the page itself, which may have no known word; other words leave before rows are counted
    of_page = F.concat(F.coalesce(keys(F.col("text")), F.array().cast("array<string>")), F.array(F.lit(None).cast("string")))
    words = pages.select("url", "domain", F.explode(of_page).alias("word"))
    known = candidates.select("word").where("word IS NOT NULL").distinct().withColumn("_in", F.lit(1))
    counted = words.join(known, "word", "left").where("_in = 1 OR word IS NULL").groupBy("url", "domain", "word").agg(F.count("_in").alias("n"))
    pairs = F.filter(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("word", "n")))), lambda x: x.isNotNull())
    commits.append(counted.groupBy("url", "domain").agg(pairs.alias("words")), path, lost)


def harvested(spark: SparkSession, path: str) -> DataFrame:
    """The pages harvested so far."""
    return commits.read(spark, path, HARVESTED)


def deduplicated_stream(pages: DataFrame, time: str = "fetched") -> DataFrame:
    """A stream of pages with each address once; addresses are remembered for a time, so state is bounded."""
    return pages.withWatermark(time, REMEMBERED).dropDuplicatesWithinWatermark(["url"])
