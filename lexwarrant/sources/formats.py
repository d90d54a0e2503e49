"""Data sources for line formats whose records don't end with their lines, or that Spark has no reader for.

``register(spark)`` makes them known to ``spark.read.format(name)``:

- ``harvest_log``: url, word and times of each count of a harvest log;
- ``leipzig``: kind, key and value of the lines of a sentence collection's three files, or of one ``kind`` of them;
- ``verse_chapters``: locator and text of each run of verses of one chapter.

Each row has ``seq``, its place in the order of files by name and of lines. Files are cut into ranges of
``splitBytes``, or of more where these were more than ``MOST_RANGES``, each read by a task of its own. A record belongs to the range in which it begins; the task
reads on past the range's end, into further files if need be, and passes over what began before. Only
columns of the schema asked for (``.schema("url string, times long")``) are made. Packed files aren't cut.
Lines end with a line feed, before which a carriage return counts as part of the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StructType

SPLIT_BYTES = 64 << 20
#: Ranges beyond which they are made larger, up to ``SPLIT_BYTES``: each costs a task and reads ahead by a block.
MOST_RANGES = 1024
_BLOCK, _ROWS = 1 << 20, 4096
_PACKED = (".bz2", ".gz", ".zst")
#: Places of a file's bytes in ``seq``, under the number of the file.
_PLACES = 40


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of file ``file`` of ``files`` (path, size); a packed file's range is all of it."""

    files: list[tuple[str, int]]
    file: int
    start: int
    end: int


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match("[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of a folder's files by name; names with a leading dot or underscore aren't data."""
    system, inside = _place(path)
    info = system.get_file_info(inside)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(inside, recursive=True)) if x.type == fs.FileType.File and x.base_name[0] not in "._"]
    scheme = path[: path.index(inside)] if inside in path else ""
    return [(scheme + x.path, x.size) for x in sorted(found, key=lambda x: (x.base_name, x.path))]


def _lines_of(path: str, start: int) -> Iterator[tuple[int, str]]:
    """(offset, line) of the lines that begin at ``start`` or later."""
    system, inside = _place(path)
    packed = inside.endswith(_PACKED)
    with system.open_input_stream(inside) if packed else system.open_input_file(inside) as file:
        at, first = 0, start > 0
        if start and not packed:
            file.seek(start - 1)  # if a line ends just there, the next one begins at ``start``
            at = start - 1
        parts: list[bytes] = []
        while block := file.read(_BLOCK):
            whole, end, rest = block.rpartition(b"\n")
            if end:
                for line in b"".join([*parts, whole]).split(b"\n"):
                    if not first:
                        yield at, line.decode("utf-8", "replace").removesuffix("\r")
                    first = False
                    at += len(line) + 1
                parts = []
            parts.append(rest)
        if (line := b"".join(parts)) and not first:
            yield at, line.decode("utf-8", "replace").removesuffix("\r")


def _lines_before(path: str, end: int) -> Iterator[str]:
    """Whole lines that end at ``end``, the last one first."""
    system, inside = _place(path)
    if inside.endswith(_PACKED):
        yield from reversed([line for _, line in _lines_of(path, 0)])
        return
    with system.open_input_file(inside) as file:
        held = b""
        while end:
            start = max(0, end - _BLOCK)
            held = file.read_at(end - start, start) + held
            end = start
            first, feed, rest = held.partition(b"\n")
            if end and not rest:  # the first line isn't known to be whole yet
                continue
            for line in reversed((rest if end else held).removesuffix(b"\n").split(b"\n")):
                yield line.decode("utf-8", "replace").removesuffix("\r")
            held = first + feed if end else b""


def _lines(part: Range) -> Iterator[tuple[int, int, str]]:
    """(file, offset, line) of a range's lines and of all after them."""
    for k in range(part.file, len(part.files)):
        for at, line in _lines_of(part.files[k][0], part.start if k == part.file else 0):
            yield k, at, line


def _inside(part: Range, file: int, at: int) -> bool:
    return file == part.file and at < part.end


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict, rows):
        self.names, self.options, self.rows = schema.names, options, rows
        self.kinds = [pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in schema.fields]

    def partitions(self) -> list[Range]:
        files, most = _files(self.options["path"]), int(self.options.get("splitbytes", SPLIT_BYTES))
        if most < 1:
            raise ValueError("splitBytes must be positive")
        kept = [self.kept(path) for path, _ in files]
        most = max(most, min(SPLIT_BYTES, sum(size for (_, size), wanted in zip(files, kept) if wanted) // MOST_RANGES))
        starts = [(k, 0 if path.endswith(_PACKED) else at, size, path) for k, (path, size) in enumerate(files) if kept[k] for at in (range(1) if path.endswith(_PACKED) else range(0, size, most))]
        return [Range(files, k, at, 1 << 62 if path.endswith(_PACKED) else min(at + most, size)) for k, at, size, path in starts] or [Range([], 0, 0, 0)]

    def kept(self, path: str) -> bool:
        """Whether the file holds what is asked for; the others keep their places in the order."""
        return "kind" not in self.options or leipzig_kind(path) == self.options["kind"]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in self.rows(part) if part.files else ():
            held.append(row)
            if len(held) >= _ROWS:
                yield self.batch(held)
                held = []
        if held:
            yield self.batch(held)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(self.names, self.kinds)], names=self.names)


def _seq(file: int, at: int) -> int:
    return (file << _PLACES) + at


def harvest_rows(part: Range) -> Iterator[dict]:
    for k, at, line in _lines(part):
        if not _inside(part, k, at):
            return
        url, tab, pairs = line.partition("\t")
        for pair in pairs.split("\t")[0].split(" ") if tab else ():
            if found := re.fullmatch(r"(.+):([0-9]+)", pair):
                if (times := int(found[2])) >= 1:
                    yield {"seq": _seq(k, at), "url": url, "word": found[1], "times": times}


#: Endings of the names of a collection's files.
LEIPZIG_KINDS = {"sentences": "sentences.txt", "links": "inv_so.txt", "addresses": "sources.txt"}


def leipzig_kind(name: str) -> str | None:
    return next((kind for kind, ending in LEIPZIG_KINDS.items() if ending in name.rpartition("/")[2] or f"/{ending}/" in name), None)


def leipzig_rows(part: Range) -> Iterator[dict]:
    """A sentence's value is the rest of its line, that of a map its second column; lines without one are left out."""
    kind = leipzig_kind(part.files[part.file][0])
    for k, at, line in _lines(part) if kind else ():
        if not _inside(part, k, at):
            return
        key, tab, value = line.partition("\t")
        if tab and (key or kind != "sentences"):
            yield {"kind": kind, "seq": _seq(k, at), "key": key, "value": value if kind == "sentences" else value.partition("\t")[0]}


_VERSE = re.compile(r"([A-Z0-9]{3}) ([0-9]+):([0-9]+) (.*)")


def _chapter_before(part: Range, start: int) -> str | None:
    """The chapter of the last verse before a place of a file."""
    for k in range(part.file, -1, -1):
        for line in _lines_before(part.files[k][0], start if k == part.file else part.files[k][1]):
            if found := _VERSE.fullmatch(line):
                return found[1] + found[2].rjust(2, "0")
    return None


def verse_rows(part: Range) -> Iterator[dict]:
    """Runs of verses of one chapter that begin in the range."""
    run, verses, begun = None, [], 0
    skipped = first = None
    for k, at, line in _lines(part):
        inside = _inside(part, k, at)
        if not inside and run is None:
            return
        if not (found := _VERSE.fullmatch(line)):
            continue
        chapter = found[1] + found[2].rjust(2, "0")
        if first is None:
            first, skipped = True, _chapter_before(part, at if k == part.file else part.files[part.file][1])
        if run is None and chapter == skipped:
            continue  # goes on with a run that began before
        skipped = None
        if chapter != run:
            if run is not None:
                yield {"seq": begun, "locator": run, "text": " ".join(verses)}
            if not inside:
                return
            run, verses, begun = chapter, [], _seq(k, at)
        verses.append(found[4])
    if run is not None:
        yield {"seq": begun, "locator": run, "text": " ".join(verses)}


class _Source(DataSource):
    columns, rows = "", staticmethod(lambda part: ())

    def schema(self) -> str:
        return self.columns

    def reader(self, schema: StructType) -> DataSourceReader:
        known = {c.split(" ")[0] for c in self.columns.split(", ")}
        if unknown := set(schema.names) - known:
            raise ValueError(f"{self.name()} has no column {', '.join(sorted(unknown))}")
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()}, type(self).rows)


class HarvestLog(_Source):
    columns, rows = "seq bigint, url string, word string, times bigint", staticmethod(harvest_rows)

    @classmethod
    def name(cls) -> str:
        return "harvest_log"


class Leipzig(_Source):
    columns, rows = "kind string, seq bigint, key string, value string", staticmethod(leipzig_rows)

    @classmethod
    def name(cls) -> str:
        return "leipzig"


class VerseChapters(_Source):
    columns, rows = "seq bigint, locator string, text string", staticmethod(verse_rows)

    @classmethod
    def name(cls) -> str:
        return "verse_chapters"


def register(spark: SparkSession) -> SparkSession:
    for kind in (HarvestLog, Leipzig, VerseChapters):
        spark.dataSource.register(kind)
    return spark


def leipzig_documents(spark: SparkSession, path: str, source: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Sentences of a collection's folder with the address each came from; of doubled lines of a map the last counts."""
    read = register(spark).read.format("leipzig").option("splitBytes", split_bytes)
    of = lambda kind: read.option("kind", kind).load(path)  # noqa: E731  each file is read for its own kind only
    urls = of("addresses").groupBy(F.col("key").alias("address")).agg(F.max_by("value", "seq").alias("url"))
    places = of("links").select(F.col("key").alias("address"), F.col("value").alias("sentence"), "seq").join(urls, "address").groupBy("sentence").agg(F.max_by("url", "seq").alias("locator"))
    return of("sentences").select(F.col("key").alias("sentence"), "seq", F.col("value").alias("text")).join(places, "sentence").select(F.lit(source).alias("source"), "seq", "locator", "text")
