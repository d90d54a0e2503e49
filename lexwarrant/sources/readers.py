"""Readers: files of many shapes to documents(source, seq, locator, text).

Line formats are read with Spark's text source. Line numbers come from the order of a file's lines, so
a format whose lines depend on each other is cut into records by its separator instead where it has one.
"""

from __future__ import annotations

import bz2
import gzip
import os
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import gutenberg_body, strip_wikitext
from ..operators.rule import numbered
from ..storage import file_system

#: Line numbers of one block, in which the runs of verses are numbered by one task.
LINES_A_BLOCK = 1 << 16
#: Files whose names and ranks are broadcast; more are joined by shuffle.
BROADCAST_FILES = 500_000
#: Files, and bytes of them, that one task reads whole, and bytes that it holds at once beside a file.
TASK_FILES, TASK_BYTES, _HELD = 4096, 32 << 20, 4 << 20
#: File systems on which tasks list and open files themselves; on others Spark's own reader does.
_TASKS_OPEN = ("file:", "hdfs:", "s3:", "gs:", "abfs:", "abfss:")
_UNPACK: dict[str, Callable[[bytes], bytes]] = {
    ".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress, ".zst": lambda x: pa.CompressedInputStream(pa.BufferReader(x), "zstd").read(),
}
DOCUMENT = "source string, seq long, locator string, text string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line): lines of one text file in order, compressed or not."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))


def tatoeba_rows(lines: DataFrame, source: str = "tat") -> DataFrame:
    """Sentence rows id, language, text by tabs; rows of fewer columns are skipped, further ones ignored."""
    part = F.split("line", "\t")
    return lines.where(F.size(part) >= 3).select(F.lit(source).alias("source"), F.col("n").alias("seq"), part[0].alias("locator"), part[2].alias("text"))


def tatoeba_documents(spark: SparkSession, path: str, source: str = "tat") -> DataFrame:
    return tatoeba_rows(numbered_lines(spark, path), source)


def wiki_pages(pages: DataFrame, source: str) -> DataFrame:
    """Pages (n, page: what stands before a closing page tag) to articles, by the page's own first id."""
    # what stands before the last opening tag belongs to no page
    body = F.regexp_extract("page", r"(?s).*<page>(.*)", 1)
    # the text's own tags and digits must not be taken for the page's
    head = F.regexp_extract(body, r"(?s)^(.*?)(?:<text\b|$)", 1)
    rows = pages.where(F.contains("page", F.lit("<page>"))).select("n", head.alias("head"), body.alias("body"))
    locator, ns = F.regexp_extract("head", r"<id>(\d+)</id>", 1), F.regexp_extract("head", r"(?s).*<ns>(-?\d+)</ns>", 1)
    text = F.regexp_extract("body", r"(?s)<text\b[^>]*>(.*?)</text>", 1)
    whole = F.col("body").rlike(r"(?s)<text\b[^>]*>.*?</text>")
    return rows.where((ns == "0") & (locator != "") & whole).select(F.lit(source).alias("source"), F.col("n").alias("seq"), locator.alias("locator"), strip_wikitext(text).alias("text"))


def wiki_documents(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A pages-articles dump, plain or bzip2; each record ends at a closing page tag, so a dump is read in splits."""
    pages = spark.read.option("lineSep", "</page>").text(path)
    return wiki_pages(pages.select(F.monotonically_increasing_id().alias("n"), F.col("value").alias("page")), source)


def file_names(files: DataFrame) -> list[str]:
    """The addresses of the files of a frame, from the JVM in one call; ``inputFiles`` of PySpark makes one call a name.

    Addresses are percent-encoded, so none has a line end.
    """
    joined = files.sparkSession.sparkContext._jvm.scala.Predef.genericWrapArray(files._jdf.inputFiles()).mkString("\n")
    return joined.split("\n") if joined else []


def file_ranks(files: DataFrame) -> DataFrame:
    """(file, rank) of the files of a frame by name, from the list the driver holds of them anyway."""
    plain = lambda f: re.sub("^([a-z0-9]+):/+", r"\1:/", f)
    found = sorted(set(map(plain, file_names(files))), key=lambda f: (unquote(f.rsplit("/", 1)[-1]), f))
    ranks = files.sparkSession.createDataFrame([(f, k) for k, f in enumerate(found)], "file string, rank long")
    return F.broadcast(ranks) if len(found) <= BROADCAST_FILES else ranks


def in_file_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seq``: the order of files by name, and of rows within a file.

    Only numbers are added, nothing is sorted: ``at`` is a row's place in its file ``file``.
    """
    named = rows.withColumn("file", F.regexp_replace("file", "^([a-z0-9]+):/+", "$1:/"))
    return named.join(file_ranks(rows), "file").withColumn("seq", F.shiftleft(F.col("rank"), 40) + F.col("at")).drop("rank", "file", "at")


def decoded_name() -> Column:
    """The name of a row's file, which the reader gives percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _opened(path: str) -> tuple[fs.FileSystem | None, str]:
    """(file system, path) of an address; none for a machine's own or mounted files."""
    return (None, re.sub("^file:/+", "/", path)) if path.startswith("file:") else fs.FileSystem.from_uri(path)


def _files_in(path: str) -> Iterator[tuple[str, str, int]]:
    """(path, name, bytes) of the files of a folder, or of the file itself; names with a leading dot or underscore aren't data."""
    system, inside = _opened(path)
    if system is None:  # one after the other, however many there are
        if os.path.isfile(inside):
            yield path, os.path.basename(inside), os.path.getsize(inside)
            return
        with os.scandir(inside) as found:
            for x in found:
                if x.name[0] not in "._" and x.is_file():
                    yield f"{path}/{x.name}", x.name, x.stat().st_size
        return
    info, root = system.get_file_info(inside), path.removesuffix(inside)
    for x in [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inside)):
        if x.type == fs.FileType.File and x.base_name[0] not in "._":
            yield root + x.path, x.base_name, x.size


def _content(path: str) -> bytes:
    """A file's bytes, unpacked by its ending as Spark's text reader does."""
    system, inside = _opened(path)
    with open(inside, "rb") if system is None else system.open_input_stream(inside, compression=None) as file:
        raw = file.read()
    ending = os.path.splitext(inside)[1]
    if ending in (".lz4", ".snappy"):
        raise ValueError(f"{path}: packed in a way that isn't read here")
    return _UNPACK.get(ending, bytes)(raw)


def listed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, name, bytes) of the files of folders, each folder listed by a task; the driver holds none of them."""
    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("bytes", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str, int]] = []
        for folder in (x for batch in batches for x in batch.column(0).to_pylist()):
            for file in _files_in(folder):
                held.append(file)
                if len(held) == TASK_FILES:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)

    folders = spark.createDataFrame(spark.sparkContext.parallelize([(p,) for p in paths], max(1, len(paths))), "folder string")
    return folders.mapInArrow(listed, "path string, name string, bytes long")


def whole_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, seq, value): a row for each file of folders, empty ones too, with its place by name and its text.

    Tasks list the folders, names are ranked over ranges of their order, and tasks open what is in their ranges.
    """
    files = numbered(listed_files(spark, paths), ["name", "path"], "rank")
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-n // TASK_FILES), -(-size // TASK_BYTES))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, values = 0, 0, []
            for i, path in enumerate(batch.column("path").to_pylist()):
                values.append(_content(path))
                held += len(values[-1])
                if held >= _HELD or i == batch.num_rows - 1:
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([part.column("name"), part.column("rank"), pa.array(values, pa.binary())], names=["name", "rank", "value"])
                    first, held, values = i + 1, 0, []

    rows = files.select("path", "name", "rank").repartitionByRange(tasks, "rank").mapInArrow(read, "name string, rank long, value binary")
    return rows.select("name", F.shiftleft(F.col("rank") - 1, 40).alias("seq"), F.col("value").cast("string").alias("value"))


def file_documents(spark: SparkSession, path: str | list[str], source: str, body: Callable[[Column], Column] = lambda t: t, locator: Column | None = None) -> DataFrame:
    """One document per file of a directory, or of several, ordered by name; the locator is the name without its ending,
    or an expression of ``name``.

    Where only Spark's own reader opens the files, and for patterns, the driver holds their names and empty files are left out.
    """
    paths = [path] if isinstance(path, str) else path
    full = [files.makeQualified(where).toString() for files, where in (file_system(spark, p) for p in paths)]
    if all(p.startswith(_TASKS_OPEN) and not re.search(r"[*?\[{]", p) for p in full):
        rows = whole_files(spark, full)
    else:
        rows = in_file_order(spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.lit(0).alias("at"), decoded_name().alias("name"), "value"))
    found = locator if locator is not None else F.regexp_replace("name", r"\.[^.]*$", "")
    return rows.select(F.lit(source).alias("source"), "seq", found.alias("locator"), body(F.col("value")).alias("text"))


def gutenberg_documents(spark: SparkSession, path: str, shortest: int = 2_000) -> DataFrame:
    """Books without their licence; shorter ones are left out. ``pg123.txt`` is book 123."""
    docs = file_documents(spark, path, "gut", gutenberg_body, F.regexp_extract("name", r"(\d+)", 1))
    return docs.where(F.length("text") >= shortest)


def archive_documents(spark: SparkSession, path: str | list[str], manifest: DataFrame, shortest: int = 20_000) -> DataFrame:
    """Scanned books; ``manifest`` (id, name) gives the file of an item, which the locator cites."""
    docs = file_documents(spark, path, "ia").withColumnRenamed("locator", "id")
    cited = docs.join(manifest.select("id", "name"), "id", "left")
    return cited.where(F.length("text") >= shortest).select("source", "seq", F.when(F.col("name").isNotNull(), F.concat_ws("/", "id", "name")).otherwise(F.col("id")).alias("locator"), "text")


def leipzig_locators(links: DataFrame, addresses: DataFrame) -> DataFrame:
    """(sentence, url) from lines of both maps; the last line of a sentence or of an address counts."""
    pair = lambda lines, a, b: lines.where(F.size(F.split("line", "\t")) >= 2).select("n", F.split("line", "\t")[0].alias(a), F.split("line", "\t")[1].alias(b))
    urls = pair(addresses, "id", "url").groupBy("id").agg(F.max_by("url", "n").alias("url"))
    last = pair(links, "id", "sentence").join(urls, "id").groupBy("sentence").agg(F.max_by("url", "n").alias("url"))
    return last


def leipzig_sentences(sentences: DataFrame, locators: DataFrame, source: str) -> DataFrame:
    """Sentences with an address; others are left out."""
    at = F.instr("line", "\t")
    rows = sentences.where(at > 1).select(F.col("n").alias("seq"), F.substring("line", F.lit(1), at - 1).alias("sentence"), F.substring("line", at + 1, F.length("line")).alias("text"))
    return rows.join(locators, "sentence").select(F.lit(source).alias("source"), "seq", F.col("url").alias("locator"), "text")


def crawl_rows(rows: DataFrame, source: str = "fw2") -> DataFrame:
    """Rows (seq, text, url) with neither text nor address missing or empty, in the order they came."""
    good = rows.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("text", F.lit("")) != ""))
    return good.select(F.lit(source).alias("source"), "seq", F.col("url").alias("locator"), "text")


def crawl_documents(spark: SparkSession, path: str, source: str = "fw2") -> DataFrame:
    """Crawl Parquet; two columns are read, and the places of rows in their files."""
    rows = spark.read.parquet(path).select("text", "url", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return crawl_rows(in_file_order(rows), source)


def verses_by_chapter(lines: DataFrame, source: str) -> DataFrame:
    """Verse lines ``GEN 1:1 text`` to a document per run of one chapter. A chapter that comes again is another document."""
    pattern = r"^([A-Z0-9]{3}) (\d+):(\d+) (.*)$"
    rows = lines.where(F.col("line").rlike(pattern)).select(
        "n", F.floor(F.col("n") / LINES_A_BLOCK).alias("block"),
        F.concat(F.regexp_extract("line", pattern, 1), F.lpad(F.regexp_extract("line", pattern, 2), 2, "0")).alias("chapter"), F.regexp_extract("line", pattern, 4).alias("verse"),
    )
    # a run is numbered within its block of lines, and blocks are numbered by a table of one row each
    order = W.partitionBy("block").orderBy("n")
    begins = F.coalesce(F.col("chapter") != F.lag("chapter").over(order), F.lit(False)).cast("long")
    marked = rows.withColumn("begins", begins).withColumn("local", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
    blocks = marked.groupBy("block").agg(F.min_by("chapter", "n").alias("first"), F.max_by("chapter", "n").alias("last"), F.sum("begins").alias("inside"))
    along = W.orderBy("block")
    new = (F.coalesce(F.col("first") != F.lag("last").over(along), F.lit(True))).cast("long")
    offsets = blocks.withColumn("new", new).withColumn("offset", F.sum(F.col("new")).over(along) + F.coalesce(F.sum("inside").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    runs = marked.join(offsets.select("block", "offset"), "block").withColumn("run", F.col("offset") + F.col("local"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "verse"))), lambda x: x["verse"]), " ")
    return runs.groupBy("run", "chapter").agg(joined.alias("text")).select(F.lit(source).alias("source"), F.col("run").cast("long").alias("seq"), F.col("chapter").alias("locator"), "text")


def verse_documents(spark: SparkSession, path: str, source: str) -> DataFrame:
    return verses_by_chapter(numbered_lines(spark, path), source)


def harvested_counts(lines: DataFrame) -> DataFrame:
    """(n, url, word, times) from log lines ``url<tab>WORD:3 OTHER:1``; a pair without a positive whole number is skipped."""
    part = F.split("line", "\t")
    pairs = lines.where(F.size(part) >= 2).select("n", part[0].alias("url"), F.explode(F.split(part[1], " ")).alias("pair"))
    pattern = r"^(.+):(\d+)$"
    return pairs.where(F.col("pair").rlike(pattern)).select("n", "url", F.regexp_extract("pair", pattern, 1).alias("word"), F.regexp_extract("pair", pattern, 2).cast("long").alias("times")).where("times >= 1")


def harvested_pages(lines: DataFrame) -> DataFrame:
    """(n, url, text): each word as often as the log counts it; pages with nothing are skipped."""
    repeated = F.array_repeat("word", F.col("times").cast("int"))
    listed = harvested_counts(lines).groupBy("n", "url").agg(F.flatten(F.collect_list(repeated)).alias("words"))
    return listed.select("n", "url", F.array_join("words", " ").alias("text"))


def harvest_documents(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a harvest log as documents of their domains."""
    from ..functions.urls import domain_of

    return harvested_pages(numbered_lines(spark, path)).select(F.concat(F.lit("web:"), domain_of(F.col("url"))).alias("source"), F.col("n").alias("seq"), F.col("url").alias("locator"), "text")


def candidate_list(lines: DataFrame) -> DataFrame:
    """(word, written): a header line, then key and written form if there is one."""
    part = F.split("line", "\t")
    first = lines.agg(F.min("n")).first()[0]
    return lines.where((F.col("n") > F.lit(first)) & (F.col("line") != "")).select(part[0].alias("word"), F.when(F.size(part) > 1, part[1]).alias("written"))


def shipped_words(lines: DataFrame) -> DataFrame:
    return candidate_list(lines).select("word")


def catalogue(spark: SparkSession, path: str, language: str, kind: str = "Text") -> DataFrame:
    """Rows of a CSV catalogue of one kind and exactly one language."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.where((F.col("Type") == kind) & (F.col("Language") == language))


def with_readings(docs: DataFrame, analyser: Callable[[], Callable[[str], str]]) -> DataFrame:
    """Texts passed through an analyser, which each worker makes once; documents left without text go.

    White space within a text counts as one space. An analyser that raises fails the job.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        analyse = analyser()
        for batch in batches:
            batch["text"] = [analyse(" ".join(t.replace("\t", " ").split("\n"))) if t else "" for t in batch["text"]]
            yield batch[batch["text"].astype(bool)]

    return docs.select("source", "seq", "locator", "text").mapInPandas(read, DOCUMENT)


def reading_chunks(text: str, most: int = 20_000) -> list[str]:
    """A text in parts of at most ``most`` bytes, as an analyser takes them: cut at the last space of a part's second
    half, or where it must be if there is none, as in scripts that write without spaces."""
    raw, parts, at = text.encode(), [], 0
    while len(raw) - at > most:
        # a space just behind the part ends it too
        stop = raw.rfind(b" ", at + most // 2, at + most + 1)
        if stop < 0:
            stop = at + most
            while raw[stop] & 0xC0 == 0x80:  # not within a character
                stop -= 1
        parts.append(raw[at:stop])
        at = stop + (raw[stop : stop + 1] == b" ")
    return [p for p in (x.decode() for x in [*parts, raw[at:]]) if p]


#: Parts of speech that are no words of their own.
_SKIPPED = {"助詞", "助動詞", "補助記号", "記号", "空白"}


def sudachi_analyser() -> Callable[[str], str]:
    """Readings of content words by the Sudachi analyser, if it is installed."""
    from sudachipy import Dictionary, SplitMode

    tokenizer = Dictionary().create()

    def analyse(text: str) -> str:
        return " ".join(m.reading_form() for part in reading_chunks(text) for m in tokenizer.tokenize(part, SplitMode.C) if m.part_of_speech()[0] not in _SKIPPED and m.reading_form())

    return analyse
