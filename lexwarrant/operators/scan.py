"""Counting candidate words in documents, per source, with places to look.

Input documents have source, seq, locator and text; seq orders the documents of a source. Everything
follows from rows (source, seq, locator, word, n): totals and hits from their sums by source, for which no row of a
document is shuffled, locators from a second look at those that can be first, and what is judged by document from a
table of its counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import PLAIN, keys
from ..functions.urls import domain_of
from ..storage import write_table

#: Locators kept per word and source.
SAMPLES = 2
#: Shares of locators, by their hash, whose first places bound where those to keep can stand.
SHARES = 2 * SAMPLES
#: Pairs of source and word whose bounds are broadcast to where the words are cut.
BROADCAST_BOUNDS = 500_000
#: Candidate lists up to this many words are broadcast; larger ones are joined by shuffle.
BROADCAST_WORDS = 2_000_000
#: Bits of a filter for each word of a larger list, and 64-bit blocks of the largest filter that is broadcast.
FILTER_BITS, FILTER_BLOCKS = 16, 1 << 24


@dataclass
class Scan:
    """totals(source, tokens), hits(source, word, count, locators)."""

    totals: DataFrame
    hits: DataFrame


def _keys(fold: Column | str) -> Column:
    return keys(F.col("text"), fold) if isinstance(fold, str) else fold


def spread(docs: DataFrame) -> DataFrame:
    """``docs`` in at least as many partitions as there are cores; a table of many splits stays as it is.

    A small file is one split, which one core alone would cut into words.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() * 2 <= cores else docs


def word_counts(docs: DataFrame, fold: Column | str = PLAIN, by: tuple[str, ...] = ("source", "seq", "locator")) -> DataFrame:
    """(source, seq, locator, word, n): how often each long enough word stands in each document, or in what is named by
    fewer columns ``by``; by none, in all of them.

    ``fold`` is a language, whose words fold in its own way, or an expression of ``text`` that gives the
    array of its keys.
    """
    words = spread(docs).select(*by, F.explode(_keys(fold)).alias("word"))
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def _marks(word: str) -> tuple[Column, Column]:
    """The block of a word by one hash, and four bits of it by another."""
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64(1, {word}), {6 * i}) & 63 AS int))") for i in range(4)]
    return F.xxhash64(word), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def word_filter(words: DataFrame, blocks: int) -> DataFrame:
    """(block, held): a Bloom filter of words (word), its bits in blocks of 64; each word's four lie in one block."""
    block, bits = _marks("word")
    return words.select(F.pmod(block, F.lit(blocks)).alias("block"), bits.alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("held"))


def in_filter(tokens: DataFrame, held: DataFrame, blocks: int) -> DataFrame:
    """``tokens`` (token, ...) with word: the token, if the filter may hold it; nothing is shuffled."""
    block, bits = _marks("token")
    marked = tokens.withColumns({"_block": F.pmod(block, F.lit(blocks)), "_bits": bits}).join(F.broadcast(held), F.col("_block") == F.col("block"), "left")
    maybe = F.col("held").bitwiseAND(F.col("_bits")) == F.col("_bits")
    return marked.withColumn("word", F.when(maybe, F.col("token"))).drop("_block", "_bits", "block", "held")


def maybe_in(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``tokens`` (token, ...) with word: the token if it may be one of ``words`` (word, distinct), null if it can't be.

    Of words beyond the largest filter, all may be.
    """
    blocks = 1 << max(0, words.count() * FILTER_BITS // 64 - 1).bit_length()
    return in_filter(tokens, word_filter(words, blocks), blocks) if blocks <= FILTER_BLOCKS else tokens.withColumn("word", F.col("token"))


def is_short(candidates: DataFrame, most: int = BROADCAST_WORDS) -> bool:
    """Whether a list of candidates is small enough to be broadcast."""
    return candidates.select("word").distinct().limit(most + 1).count() <= most


def found_words(docs: DataFrame, candidates: DataFrame, fold: Column | str = PLAIN) -> DataFrame:
    """(source, seq, locator, word, n): each word of the documents as they are cut, n being 1; of no candidate, a null word.

    The list is broadcast, nothing is shuffled or written.
    """
    words = spread(docs).select("source", "seq", "locator", F.explode(_keys(fold)).alias("token"))
    known = F.broadcast(candidates.select("word").distinct())
    return words.join(known, F.col("token") == F.col("word"), "left").select("source", "seq", "locator", "word", F.lit(1).cast("long").alias("n"))


def counted(docs: DataFrame, candidates: DataFrame, fold: Column | str = PLAIN, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(source, seq, locator, word, n) for candidates; a document's other words are one row with a null word.

    The text is read once for all that a scan gives. Small candidate lists are joined with the words as
    they are read. Of a larger list a Bloom filter is broadcast, sized by the number of words; only what
    passes it is shuffled, to be joined exactly. Beyond the largest filter all words are, counted per document.
    """
    known = candidates.select("word").distinct()
    document = ["source", "seq", "locator"]
    if is_short(known, broadcast_words):
        return found_words(docs, known, fold).groupBy(*document, "word").agg(F.count(F.lit(1)).alias("n"))
    words = spread(docs).select(*document, F.explode(_keys(fold)).alias("token"))
    passed = maybe_in(words, known)
    # rows without a word, one a document, stay out of the join, where all would meet
    counts = write_table(passed.groupBy(*document, F.col("word").alias("token")).agg(F.count(F.lit(1)).alias("n")), "passed")
    exact = counts.where("token is not null").join(known, F.col("token") == F.col("word"), "left").select(*document, "word", "n")
    rest = counts.where("token is null").select(*document, F.lit(None).cast("string").alias("word"), "n")
    return exact.union(rest).groupBy(*document, "word").agg(F.sum("n").alias("n"))


def known_share(counts: DataFrame) -> DataFrame:
    """(source, seq, tokens, known): words of a document, and those that are candidates."""
    return counts.groupBy("source", "seq").agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("word").isNotNull(), F.col("n")).otherwise(0)).alias("known"))


def legible(counts: DataFrame, floor: float) -> DataFrame:
    """``counts`` without documents whose share of candidates is below ``floor``; 0 keeps all."""
    if floor <= 0:
        return counts
    bad = known_share(counts).where(F.col("known") / F.col("tokens") < floor).select("source", "seq")
    return counts.join(bad, ["source", "seq"], "left_anti")


def first_located(hits: DataFrame) -> DataFrame:
    """(source, word, locator, seq, place): the first ``SAMPLES`` distinct locators in document order.

    The rank is bounded, so each task keeps only its own first ones before rows are shuffled.
    """
    first = hits.groupBy("source", "word", "locator").agg(F.min("seq").alias("seq"))
    order = W.partitionBy("source", "word").orderBy("seq", "locator")
    return first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLES)


def sample_locators(hits: DataFrame) -> DataFrame:
    """(source, word, locators): the first ``SAMPLES`` distinct locators in document order."""
    listed = F.array_sort(F.collect_list(F.struct("place", "locator")))
    return first_located(hits).groupBy("source", "word").agg(F.transform(listed, lambda x: x["locator"]).alias("locators"))


def summed(counts: DataFrame) -> DataFrame:
    """(source, word, n, until): counts by source, other words as a row with a null word, in sums of numbers alone.

    The first ``SAMPLES`` distinct locators of a word have ``seq`` up to ``until``; null if that can't be told. Equal
    locators are in one share, so that as many shares as are kept, by their first ``seq``, hold as many locators.
    """
    share = F.pmod(F.xxhash64("locator"), F.lit(SHARES))
    firsts = [F.min(F.when(F.col("word").isNotNull() & (share == i), F.col("seq"))).alias(f"_{i}") for i in range(SHARES)]
    sums = counts.groupBy("source", "word").agg(F.sum("n").alias("n"), F.count_if(F.col("seq").isNull()).alias("_unplaced"), *firsts)
    until = F.get(F.array_sort(F.array(*(f"_{i}" for i in range(SHARES)))), F.lit(SAMPLES - 1))  # nulls last
    return sums.select("source", "word", "n", F.when(F.col("_unplaced") == 0, until).alias("until"))


def totals_of(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, tokens) for every source given; one without any word has 0."""
    found = counts.groupBy("source").agg(F.sum("n").alias("tokens"))
    return sources.select("source").distinct().join(found, "source", "left").select("source", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def early(counts: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows of ``counts`` that can be a first place, by the bounds ``until`` of ``hits`` (source, word, until)."""
    found, bounds = counts.where(F.col("word").isNotNull()), hits.select("source", "word", "until")
    if bounds.limit(BROADCAST_BOUNDS + 1).count() <= BROADCAST_BOUNDS:
        found = found.join(F.broadcast(bounds), ["source", "word"]).where(F.col("until").isNull() | (F.col("seq") <= F.col("until")))
    return found


def scan_of(counts: DataFrame, sources: DataFrame, floor: float = 0.0) -> Scan:
    """Totals, hits and locators from counts (as ``counted`` or ``found_words`` give them).

    Sums by source are written, and all but locators follow from them; ``counts`` is read again only by who asks for
    locators, and of it only what can be a first place is grouped.
    """
    good = legible(counts, floor)
    sums = write_table(summed(good), "sums")
    hits = sums.where(F.col("source").isNotNull() & F.col("word").isNotNull())
    # a left join by keys that are unique, which Spark leaves out where no locators are asked for
    found = hits.select("source", "word", F.col("n").alias("count")).join(sample_locators(early(good, hits)), ["source", "word"], "left")
    return Scan(totals_of(sums, sources), found)


def scan(docs: DataFrame, candidates: DataFrame, floor: float = 0.0, sources: DataFrame | None = None, fold: Column | str = PLAIN) -> Scan:
    """Count candidates in documents. ``sources`` lists sources that must have a total even if empty.

    Without a floor, words are summed by source as they are cut, and cut again for locators. With one, or with a list too
    large to broadcast, the counts of documents are written to the shared folder, and all is read from there.
    """
    direct = floor <= 0 and is_short(candidates)
    counts = found_words(docs, candidates, fold) if direct else write_table(counted(docs, candidates, fold), "counts")
    return scan_of(counts, docs if sources is None else sources, floor)


def scan_by_domain(pages: DataFrame, candidates: DataFrame, fold: Column | str = PLAIN) -> Scan:
    """Pages (seq, locator = address, text) grouped by registrable domain, one source ``web:`` each."""
    return scan(pages.withColumn("source", F.concat(F.lit("web:"), domain_of(F.col("locator")))), candidates, fold=fold)


def merge(*scans: Scan) -> tuple[DataFrame, DataFrame]:
    """(totals, evidence): the last total of a source counts; attestations of a word are sorted by source."""
    totals = scans[0].totals.withColumn("_at", F.lit(0))
    hits = scans[0].hits
    for i, s in enumerate(scans[1:], 1):
        totals = totals.unionByName(s.totals.withColumn("_at", F.lit(i)))
        hits = hits.unionByName(s.hits)
    return totals.groupBy("source").agg(F.max_by("tokens", "_at").alias("tokens")), evidence_of(hits)


def evidence_of(hits: DataFrame) -> DataFrame:
    """(word, attestations): a word has as many attestations as sources, which is few."""
    return hits.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("source", "count", "locators"))).alias("attestations"))


def take(docs: DataFrame, count: int) -> DataFrame:
    """The first documents in order."""
    return docs.orderBy("seq").limit(count)


def weeded(docs: DataFrame, candidates: DataFrame, floor: float = 0.35, chars: int = 400_000, fold: Column | str = PLAIN) -> DataFrame:
    """(source, seq, locator, share) of documents to remove from a collection.

    Unlike ``legible``, this judges the first ``chars`` characters only, as a book's opening tells its
    language, and a document without a single word has share 0.
    """
    opened = docs.withColumn("text", F.substring("text", 1, chars))
    shares = known_share(counted(opened, candidates, fold)).select("source", "seq", (F.col("known") / F.col("tokens")).alias("share"))
    judged = docs.select("source", "seq", "locator").join(shares, ["source", "seq"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return judged.where(F.col("share") < floor)
