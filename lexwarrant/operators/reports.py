"""Reports over builds: near misses, overlaps, collections, caches and the roll-up of languages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F


def near_misses(dropped: DataFrame, attestations: DataFrame, families: int = 2, examples: int = 5) -> DataFrame:
    """(combo, words, examples): combinations of families of words that are short, most words first by name.

    The examples are the first words by order; only that many a combination are gathered.
    """
    short = dropped.where(F.col("families") == families).select("word")
    combos = attestations.join(short, "word", "left_semi").groupBy("word").agg(F.array_join(F.array_sort(F.collect_set("family")), " + ").alias("combo"))
    counted = combos.groupBy("combo").agg(F.count(F.lit(1)).alias("words"))
    from pyspark.sql import Window as W

    few = combos.withColumn("place", F.row_number().over(W.partitionBy("combo").orderBy("word"))).where(F.col("place") <= examples)
    shown = few.groupBy("combo").agg(F.array_join(F.array_sort(F.collect_list("word")), ", ").alias("examples"))
    return counted.join(shown, "combo")


def top_combos(combos: DataFrame, n: int = 8) -> DataFrame:
    return combos.orderBy(F.col("words").desc(), "combo").limit(n)


def publisher_overlap(hits: DataFrame, other: DataFrame) -> DataFrame:
    """(source, words, shared, share): distinct words of each source, and those also in another list."""
    seen = hits.select("source", "word").distinct()
    known = other.select("word").distinct().withColumn("_in", F.lit(1))
    both = seen.join(known, "word", "left")
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("words"), F.count("_in").alias("shared")).withColumn("share", F.col("shared") / F.col("words"))


def shared_words(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("word").intersect(b.select("word"))


def family_checkability(attestations: DataFrame, checkabilities: DataFrame) -> DataFrame:
    """(family, checkable): whether any source of the family can be looked up again. Sources and families are few."""
    used = attestations.select("source", "family").distinct().join(checkabilities, "source", "left")
    return used.groupBy("family").agg(F.max(F.coalesce(F.col("checkability") != "crawled", F.lit(True))).alias("checkable"))


def collections(totals: DataFrame, origins: DataFrame) -> DataFrame:
    """(source, tokens, origin), most tokens first."""
    return totals.join(origins, "source", "left").select("source", "tokens", "origin").orderBy(F.col("tokens").desc(), "source")


def coverage_by_minimum(verdicts: DataFrame, most: int) -> DataFrame:
    """(minimum, kept): words that would be kept under each minimum."""
    each = verdicts.withColumn("minimum", F.explode(F.sequence(F.lit(1), F.lit(most))))
    return each.groupBy("minimum").agg(F.count_if(F.col("families") >= F.col("minimum")).alias("kept"))


def cache_claims(files: DataFrame, claims: DataFrame) -> DataFrame:
    """(file, bytes, languages): who claims a cached file; unclaimed ones have an empty list."""
    by_file = claims.groupBy("file").agg(F.array_sort(F.collect_set("language")).alias("languages"))
    return files.join(by_file, "file", "left").select("file", "bytes", F.coalesce("languages", F.array().cast("array<string>")).alias("languages"))


def cache_totals(claimed: DataFrame) -> DataFrame:
    """(claimed, loose): bytes somebody claims, and bytes nobody does."""
    loose = F.size("languages") == 0
    return claimed.agg(F.coalesce(F.sum(F.when(~loose, F.col("bytes"))), F.lit(0)).alias("claimed"), F.coalesce(F.sum(F.when(loose, F.col("bytes"))), F.lit(0)).alias("loose"))


def strict_exit(claimed: DataFrame, strict: bool = True) -> int:
    """1 if ``strict`` and a file is claimed by nobody, else 0."""
    return int(strict and not claimed.where(F.size("languages") == 0).isEmpty())


def exclusively(claimed: DataFrame, language: str) -> DataFrame:
    """Files that this language alone claims."""
    return claimed.where(F.col("languages") == F.array(F.lit(language))).select("file", "bytes")


def held_or_new(found: DataFrame, held: DataFrame, rejected: DataFrame) -> DataFrame:
    """Items found that are neither held nor rejected, most downloaded first."""
    return found.join(held.select("id"), "id", "left_anti").join(rejected.select("id"), "id", "left_anti").orderBy(F.col("downloads").desc(), "id")


def pages_by_domain(pages: DataFrame) -> DataFrame:
    return pages.groupBy("domain").agg(F.count(F.lit(1)).alias("pages")).orderBy(F.col("pages").desc(), "domain")


STATUS = "language string, built string, candidates long, shipped long, ships string, decided string, why string, license string, conforms boolean, families int, checkable int, knee int, steps array<struct<families:int,added:string,kept:bigint,share:double,gained:bigint>>"


def status(language: str, built: str, verdicts: DataFrame, steps: DataFrame, checkable: DataFrame, knees: DataFrame, conforms: bool, before: dict | None = None) -> dict:
    """One language's state. A decision taken before stays; anything but yes or held is pending."""
    counted = verdicts.agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")).first()
    before = before or {}
    ships = {True: "yes", False: "held"}.get(before.get("ships"), before.get("ships"))
    knee = knees.where(F.col("language") == language).first()
    families = checkable.agg(F.count(F.lit(1)).alias("n"), F.count_if("checkable").alias("c")).first()
    return {
        "language": language, "built": built, "candidates": counted["n"], "shipped": counted["k"],
        "ships": ships if ships in ("yes", "held") else "pending", "decided": before.get("decided"), "why": before.get("why"), "license": before.get("license"),
        "conforms": conforms, "families": families["n"], "checkable": families["c"], "knee": knee["knee"] if knee else None,
        "steps": [r.asDict() for r in steps.drop("language").orderBy("families").collect()],
    }


def saturation_markdown(state: dict) -> str:
    head = f"# {state['language']}: what each family added\n\n{state['shipped']:,} of {state['candidates']:,} candidates, {state['families']} families, {state['checkable']} checkable; {state['ships']}.\n\n"
    rows = "".join(f"| {s['families']} | {s['added']} | {s['kept']:,} | {s['share']:.1%} | {s['gained']:,} |\n" for s in state["steps"])
    return head + "| families | added | kept | share | gained |\n| ---: | --- | ---: | ---: | ---: |\n" + rows


def collections_markdown(rows: DataFrame) -> str:
    lines = "".join(f"| {r['source']} | {r['tokens']:,} | {r['origin'] or ''} |\n" for r in rows.collect())  # sources are few
    return "| source | tokens | origin |\n| --- | ---: | --- |\n" + lines


def roll_up(live: DataFrame, known: DataFrame) -> DataFrame:
    """Rows by language: fresh ones, and known ones of languages that could not be reached."""
    return live.unionByName(known.join(live.select("language"), "language", "left_anti"))


def languages_markdown(rolled: DataFrame) -> str:
    out = "| language | candidates | proved | coverage | families | checkable | knee | ships |\n| --- | ---: | ---: | ---: | ---: | ---: | ---: | --- |\n"
    for r in rolled.orderBy("language").collect():  # languages are few
        share = r["shipped"] / r["candidates"] if r["candidates"] else 0
        out += f"| {r['language']} | {r['candidates']:,} | {r['shipped']:,} | {share:.1%} | {r['families']} | {r['checkable']} | {r['knee'] if r['knee'] is not None else 'still paying'} | {r['ships']} |\n"
    return out


def languages_json(rolled: DataFrame, generated: str) -> str:
    rows = [r.asDict(recursive=True) for r in rolled.orderBy("language").collect()]
    return json.dumps({"generated": generated, "languages": rows}, ensure_ascii=False, indent=2) + "\n"
