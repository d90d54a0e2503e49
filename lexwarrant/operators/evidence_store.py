"""Evidence files of any size: written in shards and read back by tasks, never as a list on the driver.

The layout and the format are those of ``sources.evidence_files``. A shard is what one task writes: its words in
order, their number, their sources and the digest, which follows from its lines one after the other. Where to cut
is told by sums of costs over blocks of words; only blocks in which a cut falls are looked at word by word. A write
goes into a folder of its own and is renamed when it is whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.evidence_files import NAME, SAMPLES, SHARD_BYTES, VERSION, Evidence, Malformed, digest_of, format_evidence
from ..storage import file_system, write_table
from .rule import numbered

#: Words of a block whose costs are summed.
BLOCK = 4096
SINGLE, FOLDER = "ATTESTATIONS.tsv", "attestations"
_HEADER, _TOKENS = r"^#[^/\s]+/attestations/[12]\b", "^#tokens(?: |$)"
_ATTESTATIONS = "array<struct<source:string,count:bigint,locators:array<string>>>"


@dataclass
class Tables:
    """What a folder holds: attestations(word, source, count, locators), words(word), totals(source, tokens)."""

    language: str
    built: str
    digest: str
    attestations: DataFrame
    words: DataFrame
    totals: DataFrame


# Writing


def lines(evidence: DataFrame) -> DataFrame:
    """(word, line, sources) of evidence(word, attestations): sources in order, counts in step, up to two locators each."""
    a = F.array_sort(F.col("attestations").cast(_ATTESTATIONS))
    join = lambda f, sep: F.array_join(F.transform(a, f), sep)
    cites = F.flatten(F.transform(a, lambda x: F.transform(F.slice(F.coalesce(x["locators"], F.array().cast("array<string>")), 1, SAMPLES), lambda at: F.concat(x["source"], F.lit(":"), at))))
    # a space parts locators, so one that has a space can't be read again
    spaced = F.filter(F.flatten(F.transform(a, lambda x: F.coalesce(x["locators"], F.array().cast("array<string>")))), lambda at: F.contains(at, F.lit(" ")))
    said = F.concat("word", F.lit(": a locator has a space: "), F.get(spaced, F.lit(0)))
    line = F.concat_ws("\t", "word", join(lambda x: x["source"], ","), join(lambda x: x["count"].cast("string"), ","), F.array_join(cites, " "))
    return evidence.select("word", F.when(F.size(spaced) > 0, F.raise_error(said).cast("string")).otherwise(line).alias("line"), F.array_distinct(F.transform(a, lambda x: x["source"])).alias("sources"))


def _around(language: str, built: str, totals: dict[str, int], name: str) -> tuple[str, int]:
    """The line of totals, and the bytes of a file without words."""
    empty = format_evidence(Evidence(language, built, [], totals), name)
    return "".join(x + "\n" for x in empty.split("\n")[1:] if x), len(empty.encode())


def shard_starts(costs: DataFrame, most: int) -> list[int]:
    """Places (from 1) at which shards begin, by costs(place, cost): a shard takes words while their costs fit.

    One sum a block comes to the driver, and the costs of blocks in which the sum goes over the limit.
    """
    block = F.floor((F.col("place") - 1) / BLOCK)
    starts, held = [1], 0
    for row in costs.groupBy(block.alias("block")).agg(F.sum("cost").alias("cost")).orderBy("block").collect():  # a row for each 4,096 words
        if held + row["cost"] <= most:
            held += row["cost"]
            continue
        for place, cost in costs.where(F.col("place").between(row["block"] * BLOCK + 1, (row["block"] + 1) * BLOCK)).select("place", "cost").orderBy("place").collect():  # one block
            if held and held + cost > most:
                starts.append(place)
                held = 0
            held += cost
    return starts


def with_shards(rows: DataFrame, starts: list[int]) -> DataFrame:
    """``rows`` (place, ...) with shard, by the places at which shards begin."""
    spark, by_block = rows.sparkSession, {}
    for place in starts[1:]:
        by_block.setdefault((place - 1) // BLOCK, []).append(place)
    # a row for each block with a cut, and the number of cuts before it; blocks between have those of the last
    listed, before = [], 0
    for block, places in sorted(by_block.items()):
        listed.append((block, before, places))
        before += len(places)
    cuts = F.broadcast(spark.createDataFrame(listed, "_block long, _before int, _cuts array<long>"))
    ends = F.array(*(F.lit(b) for b, _, _ in listed)).cast("array<bigint>")
    counts = F.array(*(F.lit(n) for n in [0, *(n + len(p) for _, n, p in listed)])).cast("array<int>")
    block = F.floor((F.col("place") - 1) / BLOCK)
    joined = rows.withColumn("_at", block).join(cuts, F.col("_at") == F.col("_block"), "left")
    inside = F.col("_before") + F.size(F.filter("_cuts", lambda c: c <= F.col("place")))
    outside = F.get(counts, F.size(F.filter(ends, lambda b: b < F.col("_at"))))
    return joined.withColumn("shard", F.when(F.col("_block").isNotNull(), inside).otherwise(outside)).drop("_at", "_block", "_before", "_cuts")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, to = file_system(spark, target)
    files.delete(to, True)
    if not files.rename(file_system(spark, source)[1], to):
        raise OSError(f"{source} can't be renamed to {target}")


def write_evidence(root: str, language: str, built: str, evidence: DataFrame, totals: DataFrame, most: int = SHARD_BYTES, name: str = NAME) -> DataFrame:
    """Write evidence(word, attestations) and totals(source, tokens); gives (shard, words, sources, bytes, digest).

    One file if all of it is at most ``most`` bytes, else shards cut between words, each no larger than that unless one
    word is; the other layout goes. Words are in code point order. Without words there is one file with none. ``root``
    is an address that all tasks and the driver reach; on one machine, a path.
    """
    spark, root = evidence.sparkSession, str(root).rstrip("/")
    held = {r["source"]: r["tokens"] for r in totals.collect()}  # a row a source
    tokens, around = _around(language, built, held, name)
    rows = numbered(lines(evidence), ["word"], "place")
    bytes_of = F.octet_length("line") + 1
    # a word costs what a file with it alone has
    cost = (F.lit(around - 1) + F.length(F.size("sources").cast("string")) + bytes_of).cast("long")
    rows = write_table(rows.withColumn("cost", cost), "evidence-lines")
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(bytes_of), F.lit(0)).alias("bytes")).first()
    sources = rows.select(F.explode("sources")).distinct().count()
    size = around + whole["bytes"] + len(str(whole["n"])) + len(str(sources)) - 2
    starts = [1] if size <= most else shard_starts(rows, most)
    staging, width = f"{root}/_writing-{uuid.uuid4().hex}", max(3, len(str(len(starts) - 1)))
    kinds = [("shard", pa.int32()), ("words", pa.int64()), ("sources", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())]

    def shard_file(shard: int, found: list[tuple[str, list[str]]]) -> tuple:
        body = "".join(line + "\n" for line, _ in found)
        named, digest = {s for _, of in found for s in of}, digest_of(body)
        text = f"#{name}/attestations/{VERSION} language={language} words={len(found)} sources={len(named)} built={built} digest={digest}\n{tokens}{body}".encode()
        system, inside = fs.FileSystem.from_uri(staging) if re.match("[a-z0-9]+:", staging) else (fs.LocalFileSystem(), staging)
        system.create_dir(inside, recursive=True)
        # the same words give the same file, so a task that runs again changes nothing
        with system.open_output_stream(f"{inside}/{shard:0{width}d}.tsv") as out:
            out.write(text)
        return shard, len(found), len(named), len(text), digest

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        row = shard_file(table.column("shard")[0].as_py(), list(zip(table.column("line").to_pylist(), table.column("sources").to_pylist())))
        return pa.table([pa.array([v], kind) for v, (_, kind) in zip(row, kinds)], names=[n for n, _ in kinds])

    dealt = with_shards(rows, starts).select("shard", "place", "line", "sources")
    made = dealt.groupBy("shard").applyInArrow(write, "shard int, words long, sources long, bytes long, digest string")
    if not whole["n"]:
        made = spark.createDataFrame([shard_file(0, [])], "shard int, words long, sources long, bytes long, digest string")
    made = write_table(made, "shards")
    if len(starts) == 1:
        _rename(spark, f"{staging}/{0:0{width}d}.tsv", f"{root}/{SINGLE}")
        for path in (staging, f"{root}/{FOLDER}"):
            files, at = file_system(spark, path)
            files.delete(at, True)
    else:
        _rename(spark, staging, f"{root}/{FOLDER}")
        files, at = file_system(spark, f"{root}/{SINGLE}")
        files.delete(at, True)
    return made


def digests(rows: DataFrame) -> DataFrame:
    """(id, digest) of rows(id, text), each a body as a file has it; a null text is an empty one."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([digest_of(t or "") for t in batch.column("text").to_pylist()], pa.string())], names=["id", "digest"])

    return rows.select("id", "text").mapInArrow(digest, f"id {rows.schema['id'].dataType.simpleString()}, digest string")


# Reading


def layout(spark: SparkSession, root: str) -> list[str]:
    """The one file, or the shards by name; both or neither is an error."""
    root = str(root).rstrip("/")
    files, single = file_system(spark, f"{root}/{SINGLE}")
    folder = file_system(spark, f"{root}/{FOLDER}")[1]
    if files.exists(single) and files.exists(folder):
        raise Malformed(f"{root} has its evidence twice, as a file and in shards")
    if files.exists(single):
        return [f"{root}/{SINGLE}"]
    shards = sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []
    shards = [f"{root}/{FOLDER}/{n}" for n in shards if n.endswith(".tsv")]
    if not shards:
        raise FileNotFoundError(f"{root} has no evidence")
    return shards


def owner_of(cite: Column, sources: Column) -> Column:
    """The source that a locator belongs to: an id may hold colons, so the longest that fits is meant; null for none."""
    fits = F.filter(sources, lambda s: F.startswith(cite, F.concat(s, F.lit(":"))))
    return F.array_max(F.transform(fits, lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))["s"]


def _listed(text: Column, by: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), by), lambda x: x != "")


def parsed(rows: DataFrame) -> DataFrame:
    """(file, kind, word, sources, counts, cites, ...) of rows(file, line): ``header``, ``tokens`` or ``entry``; empty lines go."""
    part = F.split("line", "\t")
    kind = F.when(F.col("line").rlike(_HEADER), "header").when(F.col("line").rlike(_TOKENS), "tokens").otherwise("entry")
    # an empty column has no items, but a comma in one parts empty ones
    items = lambda i: F.when(F.coalesce(F.get(part, F.lit(i)), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.get(part, F.lit(i)), ","))
    return rows.where("line <> ''").select("file", "line", kind.alias("kind"), F.size(part).alias("columns"), part[0].alias("word"), items(1).alias("sources"), items(2).alias("counts"), _listed(F.get(part, F.lit(3)), " ").alias("cites"))


def problems(rows: DataFrame) -> DataFrame:
    """(file, problem) of lines(file, line) of evidence files: headers, totals, entries and their number."""
    found = parsed(rows)
    entries, bad = found.where("kind = 'entry'"), lambda c: F.filter(c, lambda n: ~n.rlike("^[0-9]+$"))
    stray = F.filter("cites", lambda c: owner_of(c, F.col("sources")).isNull())
    entry = (
        F.when(F.col("columns") < 3, F.concat(F.lit("a line has "), F.col("columns").cast("string"), F.lit(" columns")))
        .when(F.size("sources") != F.size("counts"), F.concat("word", F.lit(": "), F.size("sources").cast("string"), F.lit(" sources and "), F.size("counts").cast("string"), F.lit(" counts")))
        .when(F.size(bad(F.col("counts"))) > 0, F.concat("word", F.lit(": no count: "), F.get(bad(F.col("counts")), F.lit(0))))
        .when(F.size(stray) > 0, F.concat("word", F.lit(": belongs to no source: "), F.get(stray, F.lit(0))))
    )
    pairs = F.filter(F.split("line", " "), lambda p: p != "#tokens")
    wrong = F.filter(pairs, lambda p: ~p.rlike("^.+=[0-9]+$"))
    totals = found.where("kind = 'tokens'").where(F.size(wrong) > 0).select("file", F.concat(F.lit("a token total is malformed: "), F.get(wrong, F.lit(0))).alias("problem"))
    said = F.regexp_extract("line", r" words=(\S*)", 1)
    heads = found.where("kind = 'header'").groupBy("file").agg(F.count(F.lit(1)).alias("heads"), F.min(said).alias("words"))
    counted = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_rows")).join(entries.groupBy("file").agg(F.count(F.lit(1)).alias("entries")), "file", "left").join(heads, "file", "left")
    number = F.coalesce("entries", F.lit(0))
    whole = (
        F.when(F.col("heads").isNull(), "not an evidence file")
        .when(~F.col("words").rlike("^[0-9]+$"), F.concat(F.lit("the number of words is no count: "), "words"))
        .when(F.col("words").cast("decimal(38,0)") != number, F.concat(F.lit("the header says "), "words", F.lit(" words, the file has "), number.cast("string")))
    )
    each = entries.select("file", entry.alias("problem")).union(totals).union(counted.select("file", whole.alias("problem")))
    return each.where("problem IS NOT NULL")


def entries(rows: DataFrame) -> DataFrame:
    """(word, attestations) of lines(file, line) that have no problem."""
    found = parsed(rows).where("kind = 'entry'")
    owned = F.transform("cites", lambda c: F.struct(owner_of(c, F.col("sources")).alias("owner"), c.alias("cite")))
    mine = lambda s: F.transform(F.filter(owned, lambda x: x["owner"] == s), lambda x: F.substring(x["cite"], F.length(s) + 2, F.length(x["cite"])))
    each = F.zip_with("sources", "counts", lambda s, n: F.struct(s.alias("source"), n.cast("long").alias("count"), mine(s).alias("locators")))
    return found.select("word", each.cast(_ATTESTATIONS).alias("attestations"))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths, lineSep="\n").select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def wrong_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file) whose lines don't give the digest of its header; a task reads a whole file, which is a shard at most."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for file, text in zip(batch.column("file").to_pylist(), batch.column("text").to_pylist()):
                head, *rest = text.split("\n")
                body = "".join(x + "\n" for x in rest if x and not x.startswith("#tokens"))
                if f"digest={digest_of(body)}" not in head.split(" "):
                    bad.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["file"])

    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return texts.repartition(len(paths)).mapInArrow(check, "file string")


def read_evidence(spark: SparkSession, root: str, verify: bool = False) -> Tables:
    """The evidence of a folder; raises what is wrong with it. ``verify`` also compares digests."""
    paths = layout(spark, root)
    rows = read_lines(spark, paths)
    wrong = problems(rows).orderBy("file", "problem").limit(5).collect()
    if verify and not wrong:
        wrong = [{"file": r["file"], "problem": "the digest is another one"} for r in wrong_digests(spark, paths).orderBy("file").limit(5).collect()]
    if wrong:
        raise Malformed("; ".join(f"{r['file']}: {r['problem']}" for r in wrong))
    heads = parsed(rows).where("kind <> 'entry'").select("file", "kind", "line").orderBy("file").collect()  # two lines a shard
    field = lambda line, key: (re.search(rf" {key}=(\S*)", line) or ["", ""])[1]
    first = [r["line"] for r in heads if r["kind"] == "header"]
    totals = {}
    for r in heads:
        if r["kind"] == "tokens":
            totals |= {s: int(n) for s, _, n in (p.rpartition("=") for p in r["line"].split(" ")[1:] if p)}
    found = entries(rows)
    each = found.select("word", F.explode("attestations").alias("a")).select("word", "a.source", "a.count", "a.locators")
    return Tables(field(first[0], "language"), field(first[0], "built"), "+".join(field(x, "digest") for x in first), each, found.select("word"), spark.createDataFrame(sorted(totals.items()), "source string, tokens long"))
