"""From scans and recorded evidence to word list, drop list and evidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from . import rule
from .scan import Scan


@dataclass
class Built:
    """What a build gives; all lazy frames.

    totals(source, tokens, ranks), attestations(word, source, count, locators, family),
    verdicts(word, families, kept), kept(word, families, rate), dropped(word, families, attestations).
    """

    totals: DataFrame
    attestations: DataFrame
    verdicts: DataFrame
    kept: DataFrame
    dropped: DataFrame
    reused: DataFrame


class EmptyScan(ValueError):
    """A source that has a record was scanned and gave nothing."""


def empty_scans(fresh: DataFrame, recorded: DataFrame) -> DataFrame:
    """(source): scans without a token that would replace a record with some."""
    return fresh.where("tokens = 0").join(recorded.where("tokens > 0"), "source", "left_semi").select("source")


def refuse_empty_scans(fresh: DataFrame, recorded: DataFrame) -> None:
    """Raises if there are ``empty_scans``."""
    bad = [r["source"] for r in empty_scans(fresh, recorded).orderBy("source").collect()]  # sources are few
    if bad:
        raise EmptyScan(f"scanned without a single word, though recorded before: {', '.join(bad)}")


def reuse(fresh_totals: DataFrame, fresh_hits: DataFrame, totals: DataFrame, hits: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, hits): fresh ones, and recorded ones of sources not scanned now, for words still candidates."""
    scanned = fresh_totals.select("source")
    kept_totals = totals.join(scanned, "source", "left_anti")
    kept_hits = hits.join(scanned, "source", "left_anti").join(candidates.select("word").distinct(), "word", "left_semi")
    return fresh_totals.unionByName(kept_totals), fresh_hits.unionByName(kept_hits)


def build(candidates: DataFrame, scan: Scan, sources: DataFrame, recorded: Scan | None = None, minimum: int = rule.MINIMUM) -> Built:
    """Partition and rank candidates. ``sources`` has id, family and ranks; absent ones stand for themselves."""
    totals, hits = scan.totals, scan.hits
    reused = totals.limit(0)
    if recorded:
        refuse_empty_scans(totals, recorded.totals)
        reused = recorded.totals.join(totals.select("source"), "source", "left_anti")
        totals, hits = reuse(totals, hits, recorded.totals, recorded.hits, candidates)
    totals = rule.with_family(totals, sources).drop("family")
    attested = rule.with_family(hits, sources).drop("ranks")
    verdicts = rule.partition(rule.independence(candidates, attested), minimum)
    good = verdicts.where("kept")
    kept = good.join(rule.rates(good, attested, totals), "word").select("word", "families", "rate")
    listed = attested.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("source", "count", "locators"))).alias("attestations"))
    dropped = verdicts.where(~F.col("kept")).join(listed, "word", "left").select("word", "families", "attestations")
    return Built(totals, attested, verdicts, kept, dropped, reused)


def evidence(candidates: DataFrame, attestations: DataFrame) -> DataFrame:
    """(word, attestations): every candidate; an empty list is a finding too."""
    kind = "array<struct<source:string,count:bigint,locators:array<string>>>"
    listed = attestations.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("source", F.col("count").cast("long").alias("count"), "locators"))).cast(kind).alias("attestations"))
    return candidates.select("word").distinct().join(listed, "word", "left").select("word", F.coalesce("attestations", F.array().cast(kind)).alias("attestations"))


def same_as_output(candidates: DataFrame, shipped: DataFrame) -> bool:
    """Whether the candidates are the words shipped: a list can't be evidence for itself."""
    a, b = candidates.select("word").distinct(), shipped.select("word").distinct()
    return a.count() == b.count() and a.join(b, "word", "left_anti").isEmpty()


def word_list_lines(kept: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """(rank, line): key, and the written form where there is one that differs."""
    ranked = rule.ranked(kept)
    if written is None:
        return ranked.select("rank", F.col("word").alias("line"))
    forms = written.select("word", "written").dropDuplicates(["word"])
    return ranked.join(forms, "word", "left").select("rank", F.when(F.col("written").isNotNull(), F.concat_ws("\t", "word", "written")).otherwise(F.col("word")).alias("line"))


def in_drop_order(dropped: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """``dropped`` with place: nearest to being kept first, then ``by`` what tells words apart; by default their dictionary order."""
    return rule.numbered(dropped, [F.col("families").desc(), *(by or [rule.collated("word"), "word"])], "place")


def drop_list_lines(dropped: DataFrame) -> DataFrame:
    """(word, families, line) and place if it is known: word, families, sources and counts, by tabs and commas."""
    a = F.coalesce("attestations", F.array().cast("array<struct<source:string,count:bigint,locators:array<string>>>"))
    listed = F.array_sort(a)
    line = F.concat_ws(
        "\t", "word", F.col("families").cast("string"),
        F.array_join(F.transform(listed, lambda x: x["source"]), ","), F.array_join(F.transform(listed, lambda x: x["count"].cast("string")), ","),
    )
    return dropped.select("word", "families", line.alias("line"), *(["place"] if "place" in dropped.columns else []))


def common_tier(kept: DataFrame, cut: int, by: list[Column] | None = None) -> DataFrame:
    """The first ``cut`` words by rank; of equal rates ``by`` what tells words apart."""
    return kept.orderBy(F.col("rate").desc(), *(by or [rule.collated("word"), "word"])).limit(cut)
