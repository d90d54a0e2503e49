"""The keep rule, rates and ranks, trusted spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import nfc, nfd
from ..storage import write_table

#: Independent families a word needs.
MINIMUM = 3
PER = 1_000_000
#: Distinct words that must use a character before spellings with it are trusted.
TRUSTED_WORDS = 50


def with_family(attestations: DataFrame, sources: DataFrame) -> DataFrame:
    """(…, family, ranks): a source without a row is its own family and ranks."""
    known = sources.select(F.col("id").alias("_id"), F.col("family").alias("_family"), F.col("ranks").alias("_ranks"))
    joined = attestations.join(known, F.col("source") == F.col("_id"), "left")
    return joined.withColumn("family", F.coalesce("_family", "source")).withColumn("ranks", F.coalesce("_ranks", F.lit(True))).drop("_id", "_family", "_ranks")


def independence(candidates: DataFrame, attestations: DataFrame) -> DataFrame:
    """(word, families): exact count of distinct families of every candidate, 0 for those never seen."""
    seen = attestations.select("word", "family").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("families"))
    return candidates.select("word").distinct().join(seen, "word", "left").select("word", F.coalesce("families", F.lit(0)).cast("long").alias("families"))


def partition(independent: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(word, families, kept)."""
    return independent.withColumn("kept", F.col("families") >= minimum)


def rates(words: DataFrame, attestations: DataFrame, totals: DataFrame) -> DataFrame:
    """(word, rate): mean rate per million over all ranking sources, a miss counting as 0.

    ``totals`` has source, tokens and ranks. A source without tokens counts in the divisor only.
    """
    ranking = totals.where("ranks").select("source", "tokens")
    number = ranking.agg(F.count(F.lit(1)).alias("n"))
    each = attestations.join(ranking, "source").where("tokens > 0").groupBy("word").agg(F.sum(F.col("count") * F.lit(float(PER)) / F.col("tokens")).alias("sum"))
    joined = words.select("word").join(each, "word", "left").crossJoin(F.broadcast(number))  # one row
    return joined.select("word", F.when(F.col("n") > 0, F.coalesce("sum", F.lit(0.0)) / F.col("n")).otherwise(F.lit(0.0)).alias("rate"))


def collated(word: str | Column) -> Column:
    """Dictionary order: root collation, so that accented letters stand by their base letters."""
    return F.collate(F.col(word) if isinstance(word, str) else word, "UNICODE")


def by_letters(word: str, *marks: str) -> list[Column]:
    """An order without a collation: base letters by code, apostrophes of both kinds alike; then, letter by letter, none
    of ``marks`` (letters of one mark each) before the first of them and so on; then the word by code."""
    base = F.translate(F.regexp_replace(nfd(F.col(word)), r"\p{M}+", ""), "’", "'")
    places = F.translate(word, "".join(marks), "".join(str(i) * len(m) for i, m in enumerate(marks, 1)))
    return [base, *([F.regexp_replace(places, f"[^1-{len(marks)}]", "0")] if marks else []), F.col(word)]


def numbered(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``rows`` with ``name``: each row's place, from 1, in the order of all.

    Rows are dealt into ranges of the order, sorted and written; a range's rows are numbered where they lie, from
    what the ranges before it hold. The driver gets one count a range. Rows equal in ``order`` get places of their
    own, in any order, which doesn't change once they are given.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges are drawn from the rows first, which are made only once so
    ordered = write_table(rows, "unordered").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    held = write_table(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # the number's upper part is the range, the lower one the row's place within it
    part, before = F.shiftright("_at", 33), 0
    begins = []
    for r in sorted(held.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):  # a row a range
        begins.append((r["part"], before + 1))
        before += r["count"]
    starts = spark.createDataFrame(begins, "_part long, _begin long")
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.join(F.broadcast(starts), part == F.col("_part")).withColumn(name, F.col("_begin") + local).select(*rows.columns, name)


def ranked(rated: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """``rated`` with rank by rate, best first, then ``by`` what tells words apart; by default their dictionary order."""
    return numbered(rated, [F.col("rate").desc(), *(by or [collated("word"), "word"])], "rank")


def with_places(rated: DataFrame) -> DataFrame:
    """``rated`` with place: one more than the words of a better rate, so that ties share one."""
    rated = write_table(rated, "rated")
    first = numbered(rated.select("rate"), [F.col("rate").desc()], "place").groupBy("rate").agg(F.min("place").alias("place"))
    return rated.join(first, "rate").select(*rated.columns, "place")


def trusted_characters(spellings: DataFrame, tiles: list[str], at_least: int = TRUSTED_WORDS) -> DataFrame:
    """(ch): tiles, and characters that enough distinct words use; in lower case."""
    chars = spellings.select("word", F.explode(F.array_distinct(F.split(F.lower(nfc(F.col("written"))), ""))).alias("ch")).where("ch <> ''").distinct()
    used = chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least).select("ch")
    given = spellings.sparkSession.createDataFrame([(t.lower(),) for t in sorted(set(tiles))], "ch string")
    return used.union(given).distinct()


def trusted_spellings(spellings: DataFrame, tiles: list[str], at_least: int = TRUSTED_WORDS) -> DataFrame:
    """(word, written): spellings all of whose characters are trusted, in composed form."""
    rows = spellings.select("word", nfc(F.col("written")).alias("written"))
    chars = rows.select("word", "written", F.explode(F.array_distinct(F.split(F.lower("written"), ""))).alias("ch")).where("ch <> ''")
    # at most as many rows as there are characters
    doubtful = chars.join(F.broadcast(trusted_characters(spellings, tiles, at_least)), "ch", "left_anti").select("word", "written").distinct()
    return rows.join(doubtful, ["word", "written"], "left_anti")
