"""Conformance, verification of citations, dump checks and the retirement gate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.registry import archive_url, expand_locator
from ..functions.text import keys
from ..storage import write_table
from .rule import MINIMUM
from .scan import maybe_in

#: Words named in a failure before the rest is counted.
REPORTED = 5


def sample_text(words: Column) -> Column:
    """The first few words, then how many more there are."""
    first, more = F.array_join(F.slice(words, 1, REPORTED), ", "), F.size(words) - REPORTED
    return F.when(more <= 0, first).otherwise(F.concat(first, F.lit(", and "), more.cast("string"), F.lit(" more")))


def _rule(rows: DataFrame, column: str, check: str, prefix: Column) -> DataFrame:
    """One row on what breaks a rule: only the first few words are gathered, the rest are counted."""
    few = rows.orderBy("_order").limit(REPORTED).agg(F.array_sort(F.collect_list(F.struct("_order", F.col(column).alias("w")))).alias("f"))
    counted = rows.agg(F.count(F.lit(1)).alias("n"))
    words = F.array_join(F.transform("f", lambda x: x["w"]), ", ")
    return few.crossJoin(counted).select(F.lit(check).alias("check"), "n", prefix.alias("prefix"), words.alias("words"))  # one row each


def rules(shipped: DataFrame, attestations: DataFrame, evidence_words: DataFrame, sources: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(check, n, prefix, words) of every rule, broken or not: how many break it, what is said of them, the first few.

    shipped(word[, place]), attestations(word, source, locators), evidence_words(word), sources(id, family).
    """
    listed = shipped.select("word", F.col("place").alias("_order") if "place" in shipped.columns else F.col("word").alias("_order"))
    known = sources.select(F.col("id").alias("source"), "family")
    unknown = attestations.select("source").distinct().join(known, "source", "left_anti").withColumn("_order", F.col("source"))
    missing = listed.join(evidence_words.select("word"), "word", "left_anti")
    families = attestations.join(known, "source", "left").select("word", F.coalesce("family", "source").alias("family")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("families"))
    counted = evidence_words.select("word").join(families, "word", "left").select("word", F.coalesce("families", F.lit(0)).alias("families"))
    thin = listed.join(counted, "word").where(F.col("families") < minimum)
    silent = attestations.where(F.coalesce(F.size("locators"), F.lit(0)) <= 0).select("word").distinct().withColumn("_order", F.col("word"))
    n = lambda text: F.concat(F.col("n").cast("string"), F.lit(text))
    return (
        _rule(unknown, "source", "every source is registered", F.lit("unknown: "))
        .unionByName(_rule(missing, "word", "every shipped word has evidence", n(" without any: ")))
        .unionByName(_rule(thin, "word", f"every shipped word has {minimum} independent sources", n(" short: ")))
        .unionByName(_rule(silent, "word", "every attestation says where to look", n(" with a source and no locator: ")))
    )


def conform(shipped: DataFrame, attestations: DataFrame, evidence_words: DataFrame, sources: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(check, detail) of every rule that is broken, of tables as ``rules`` takes them."""
    more = F.when(F.col("n") > REPORTED, F.concat(F.lit(", and "), (F.col("n") - REPORTED).cast("string"), F.lit(" more"))).otherwise("")
    broken = rules(shipped, attestations, evidence_words, sources, minimum).where("n > 0")
    return broken.select("check", F.concat("prefix", "words", more).alias("detail"))


def citations(attestations: DataFrame, sources: DataFrame) -> DataFrame:
    """(word, source, family, locator, as_of, url): one row per locator; url is null where the source isn't registered."""
    known = sources.select(F.col("id").alias("_id"), F.col("family").alias("_family"), "locator_kind", "template", "as_of")
    rows = attestations.select("word", "source", F.explode("locators").alias("locator")).join(known, F.col("source") == F.col("_id"), "left")
    return rows.select("word", "source", F.coalesce("_family", "source").alias("family"), "locator", "as_of", F.when(F.col("_id").isNotNull(), expand_locator(F.col("locator_kind"), F.col("template"), F.col("locator"))).alias("url"))


def _pair(url: str, word: str) -> Column:
    return F.concat_ws("\n", url, word)  # neither holds a line end


def seen_on(pages: DataFrame, asked: DataFrame, fold: Callable[[Column], Column] = keys) -> DataFrame:
    """(url, word): which of the pairs ``asked`` (url, word) pages(url, text) bear out.

    A page's words are tested against a filter of what is asked where they are read; what passes is shuffled
    as pairs and joined exactly.
    """
    pairs = write_table(asked.select(_pair("url", "word").alias("word")).distinct(), "asked")
    words = pages.select(F.col("url").alias("_url"), F.explode(F.array_distinct(fold(F.col("text")))).alias("_word")).select(_pair("_url", "_word").alias("token"))
    passed = maybe_in(words, pairs).where(F.col("word").isNotNull()).select("word").distinct()
    found = F.split(F.col("word"), "\n")
    return passed.join(pairs, "word", "left_semi").select(found[0].alias("url"), found[1].alias("word"))


def outcomes(cited: DataFrame, pages: DataFrame, fold: Callable[[Column], Column] = keys) -> DataFrame:
    """(word, source, family, locator, url, outcome) from what pages(url, text) could be read.

    A source that says when it looked is checked against the archive of that year first, the live page
    second, and can't be called absent; any other is checked live first, then in the archive. A citation meets
    the addresses that were read, and pairs of address and word that were seen, never a page's words.
    """
    copy = archive_url(F.col("url"), F.col("as_of"))
    first = F.when(F.col("as_of").isNotNull(), copy).otherwise(F.col("url"))
    second = F.when(F.col("as_of").isNotNull(), F.col("url")).otherwise(copy)
    # read twice: for what is asked, and with the answers
    rows = write_table(cited.withColumn("_first", first).withColumn("_second", second), "cited")
    held = pages.where(F.col("text").isNotNull())
    asked = rows.select(F.explode(F.array("_first", "_second")).alias("url"), "word").where(F.col("url").isNotNull())
    read, seen = held.select("url").distinct(), write_table(seen_on(held, asked, fold), "seen")
    for k in ("first", "second"):
        was_read = read.select(F.col("url").alias(f"_{k}"), F.lit(True).alias(f"_read_{k}"))
        on_page = seen.select(F.col("url").alias(f"_{k}"), "word", F.lit(True).alias(f"_on_{k}"))
        rows = rows.join(was_read, f"_{k}", "left").join(on_page, [f"_{k}", "word"], "left")
    is_true = lambda name: F.coalesce(F.col(name), F.lit(False))
    dated = F.col("as_of").isNotNull()
    missing = F.when(dated, "unreachable").otherwise("absent")
    outcome = (
        F.when(F.col("url").isNull(), "unresolvable")
        .when(is_true("_read_first"), F.when(is_true("_on_first"), F.when(dated, "archived").otherwise("found")).otherwise(missing))
        .when(is_true("_read_second"), F.when(is_true("_on_second"), F.when(dated, "found").otherwise("archived")).otherwise(missing))
        .otherwise("unreachable")
    )
    return rows.select("word", "source", "family", "locator", F.coalesce("url", F.lit("")).alias("url"), outcome.alias("outcome"))


def proofs(checked: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(word, families, holds): distinct families whose citation was seen, and whether they are enough."""
    seen = F.when(F.col("outcome").isin("found", "archived"), F.col("family"))
    return checked.groupBy("word").agg(F.count_distinct(seen).alias("families")).withColumn("holds", F.col("families") >= minimum)


def tally(checked: DataFrame) -> DataFrame:
    return checked.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def read_pages(urls: DataFrame, get: Callable[[str], str | None]) -> DataFrame:
    """(url, text) of what a reader gives; null where it gives nothing. Each address is read once."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"url": batch["url"], "text": [get(u) for u in batch["url"]]})

    return urls.select("url").distinct().mapInPandas(read, "url string, text string")


def prove(attestations: DataFrame, sources: DataFrame, get: Callable[[str], str | None], minimum: int = MINIMUM) -> tuple[DataFrame, DataFrame]:
    """(checked, proofs) of the citations of some words."""
    cited = citations(attestations, sources)
    urls = cited.where("url is not null").select("url").union(cited.where("url is not null").select(archive_url(F.col("url"), F.col("as_of")).alias("url")))
    checked = outcomes(cited, read_pages(urls, get))
    return checked, proofs(checked, minimum)


def sample_words(words: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """``n`` words at random; the same for the same seed and words."""
    return words.select("word").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "word").cast("binary")), "word").limit(n)


def dump_url(name: Column) -> Column:
    """Where a dump of that name comes from; null if the name isn't one of theirs."""
    wiki = F.regexp_extract(name, r"^([a-z-]+(?:wikisource|wiki))\.xml\.bz2$", 1)
    return F.when(wiki != "", F.concat(F.lit("https://dumps.wikimedia.org/"), wiki, F.lit("/latest/"), wiki, F.lit("-latest-pages-articles.xml.bz2")))


def extension(name: Column) -> Column:
    """Everything from the first dot."""
    return F.regexp_extract(name, r"\..*$", 0)


def dump_verdicts(files: DataFrame) -> DataFrame:
    """(…, verdict) of files(name, have, expect, from): ``from`` is the address it came from, if known.

    A file unpacked from another, or with no address, is no dump; a server that gave no size decides nothing.
    """
    url = F.coalesce("from", dump_url(F.col("name")))
    # the address of a packed file says nothing of the size unpacked
    same = F.endswith(url, extension(F.col("name")))
    verdict = (
        F.when(url.isNull() | ~same, "not a dump")
        .when(F.col("expect").isNull(), "unknown")
        .when(F.col("have") == F.col("expect"), "ok")
        .otherwise("truncated")
    )
    return files.withColumn("verdict", verdict)


def retirement(declared: DataFrame, totals: DataFrame) -> DataFrame:
    """(source): declared sources without a recorded total, which bar a collection from being let go."""
    return declared.where(~F.startswith("source", F.lit("archive-"))).join(totals.where("tokens is not null"), "source", "left_anti").select("source").distinct()
