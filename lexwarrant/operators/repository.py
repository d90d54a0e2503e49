"""A language's folder: evidence, list and status files, and the roll-up over several folders."""

from __future__ import annotations

import contextlib
import json
import subprocess
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.registry import sources_table
from ..functions.urls import domain_of
from ..sources import evidence_files as E, readers, web
from ..storage import exists, read_text, write_table, write_text
from ..streaming import commits, incremental
from . import build as B, checks, curve, evidence_store as T, reports, rule

LIST, DROPS, STATUS, COLLECTIONS = "words.txt", "dropped.tsv", "status.json", "COLLECTIONS.md"
RUNNING, HARVEST = "harvest.running", "harvest"


class HarvestRunning(RuntimeError):
    """A harvest still writes what a build would read."""


def at(root: str | Path, name: str = "") -> str:
    """The address of a folder, or of a file in it: a path of this machine, or one that Spark reads anywhere."""
    root = str(root) if ":/" in str(root) else str(Path(root).absolute())
    return f"{root.rstrip('/')}/{name}".rstrip("/")


def refuse_running_harvest(spark: SparkSession, root: str | Path) -> None:
    """Raises while a harvest, on whatever machine, holds its lease of a folder; one that has died lets it run out."""
    if held := commits.holder(spark, at(root, RUNNING)):
        raise HarvestRunning(f"{held} is harvesting into {root}")


@contextlib.contextmanager
def harvesting(spark: SparkSession, root: str | Path, holds: float = commits.HOLDS):
    """Holds a folder while a harvest adds to it; only one at a time. Gives an event that is set if the hold is lost."""
    owner = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    try:
        with commits.lease(spark, at(root, RUNNING), owner, holds) as lost:
            yield lost
    except commits.Held as error:
        raise HarvestRunning(str(error)) from error


def uncommitted(root: str | Path) -> list[str]:
    """What stands in the way of calling a folder's repository clean; nothing where there is no repository."""
    run = lambda *a: subprocess.run(["git", "-C", str(root), *a], capture_output=True, text=True)
    if run("rev-parse", "--is-inside-work-tree").stdout.strip() != "true":
        return []
    return [f"not committed: {line[3:]}" for line in run("status", "--porcelain", "--", ".").stdout.splitlines()]


def save(root: str | Path, language: str, built_on: str, built: B.Built, candidates: DataFrame, cut: int, written: DataFrame | None = None, most: int = E.SHARD_BYTES) -> None:
    """Write evidence, word list and drop list of one build. These are one language's words."""
    spark = candidates.sparkSession
    refuse_running_harvest(spark, root)
    T.write_evidence(at(root), language, built_on, B.evidence(candidates, built.attestations), built.totals.select("source", "tokens"), most)
    lines = [r["line"] for r in B.word_list_lines(built.kept, written).orderBy("rank").toLocalIterator()]
    write_text(spark, at(root, LIST), E.word_list(language, lines, cut))
    ordered = B.drop_list_lines(B.in_drop_order(built.dropped)).orderBy("place")
    write_text(spark, at(root, DROPS), E.drop_list([r["line"] for r in ordered.toLocalIterator()]))


def load(spark: SparkSession, root: str | Path) -> tuple[T.Tables, DataFrame, DataFrame, DataFrame]:
    """(evidence, attestations, its words, sources)."""
    found = T.read_evidence(spark, at(root))
    named = [r["source"] for r in found.attestations.select("source").distinct().orderBy("source").collect()]  # sources are few
    return found, found.attestations, found.words, sources_table(spark, named)


def shipped(spark: SparkSession, root: str | Path) -> DataFrame:
    """(word, place) of the list."""
    lines = spark.createDataFrame(list(enumerate(read_text(spark, at(root, LIST)).split("\n"))), "n long, line string")
    part = F.split("line", "\t")
    return lines.where((F.col("n") > 0) & (F.col("line") != "")).select(part[0].alias("word"), F.col("n").alias("place"))


def conform(spark: SparkSession, root: str | Path) -> list[tuple[str, str]]:
    """Every rule that a folder breaks. Evidence that doesn't parse is the only failure told then."""
    try:
        _, attested, words, sources = load(spark, root)
    except E.Malformed as error:
        return [("evidence parses", str(error))]
    return [tuple(r) for r in checks.conform(shipped(spark, root), attested, words, sources).collect()]


def measure(spark: SparkSession, root: str | Path) -> dict:
    """A folder's status, measured anew; what was decided about it before stays."""
    before = json.loads(read_text(spark, at(root, STATUS))) if exists(spark, at(root, STATUS)) else {}
    found, attested, words, sources = load(spark, root)
    familied = rule.with_family(attested, sources)
    steps = curve.saturation(familied, words.count(), language=found.language)
    verdicts = words.join(shipped(spark, root).select("word").withColumn("kept", F.lit(True)), "word", "left").select("word", F.coalesce("kept", F.lit(False)).alias("kept"))
    checkable = reports.family_checkability(familied, sources.select(F.col("id").alias("source"), "checkability"))
    return reports.status(found.language, found.built, verdicts, steps, checkable, curve.knee(steps), not conform(spark, root), before)


def save_status(spark: SparkSession, root: str | Path, origins: DataFrame | None = None) -> dict:
    """Measure a folder and write its status, the table of what each family added, and its collections."""
    state = measure(spark, root)
    write_text(spark, at(root, STATUS), json.dumps(state, ensure_ascii=False, indent=2) + "\n")
    write_text(spark, at(root, "SATURATION.md"), reports.saturation_markdown(state))
    totals = T.read_evidence(spark, at(root)).totals
    origins = origins if origins is not None else totals.select("source", F.lit("").alias("origin"))
    write_text(spark, at(root, COLLECTIONS), reports.collections_markdown(reports.collections(totals, origins)))
    return state


def roll_up(spark: SparkSession, roots: list[str | Path], known: list[dict] = ()) -> DataFrame:
    """Statuses of folders, and known ones of languages without a folder here."""
    live = spark.createDataFrame([measure(spark, r) for r in roots], reports.STATUS)
    return reports.roll_up(live, spark.createDataFrame([{k: row.get(k) for k in live.columns} for row in known], reports.STATUS))


def verify(spark: SparkSession, root: str | Path, words: int, get, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(checked, proofs) of the citations of some of a folder's shipped words, drawn by a seed."""
    _, attested, _, sources = load(spark, root)
    drawn = checks.sample_words(shipped(spark, root), words, seed)
    checked, _ = checks.prove(attested.join(drawn, "word", "left_semi"), sources, get)
    checked = write_table(checked, "checked")
    return checked, checks.proofs(checked)


def harvest(spark: SparkSession, root: str | Path, domains: list[str], candidates: DataFrame, get, limit: int = web.MOST_PAGES, delay: float = web.DELAY) -> int:
    """Read sites into a folder's harvest and give the number of pages added; those held already aren't read again."""
    path = at(root, HARVEST)
    with harvesting(spark, root) as lost:
        found = web.discover(spark.createDataFrame([(d,) for d in domains], "domain string"), get, limit, delay)
        fresh = write_table(incremental.new_pages(found, incremental.harvested(spark, path)), "fresh-pages")
        read = write_table(web.fetched(fresh.select("domain", "pos", "url"), get, delay).where("body IS NOT NULL").withColumnRenamed("body", "html"), "harvest")
        pages = web.admissible(read).withColumn("domain", domain_of(F.col("url"))).select("url", "domain", "text")
        incremental.append_harvest(pages, candidates, path, lost)
        return pages.count()


def may_retire(spark: SparkSession, root: str | Path, declared: list[str]) -> list[str]:
    """What bars the collections of a language from being let go; nothing if nothing does."""
    bars = [] if exists(spark, at(root, COLLECTIONS)) else [f"{COLLECTIONS} is missing"]
    bars += uncommitted(root)
    totals = T.read_evidence(spark, at(root)).totals
    if totals.isEmpty():
        bars.append("no totals are recorded")
    named = spark.createDataFrame([(s,) for s in declared], "source string")
    return bars + [f"{r['source']} has no recorded total" for r in checks.retirement(named, totals).orderBy("source").collect()]


def candidates(spark: SparkSession, path: str | Path) -> DataFrame:
    """(word, written) of a candidate list file."""
    return readers.candidate_list(readers.numbered_lines(spark, str(path)))
