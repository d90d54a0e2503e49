"""Lines that recur across documents as instances of one template.

The template tree has a fixed depth: a line goes to the leaf of its number of tokens and its leading
token, tokens with a digit being variable fields. In a leaf a line is its ``PARTS`` stretches (single
tokens, if it has no more), and a stretch that many of the leaf's lines have at that place is a constant,
others are variable. A template is a set of constants that make up enough of a line (``needed_parts``);
fields don't count.
Which constants of a line belong together isn't known before counting, so a line has one path for each
run of them in the order of their frequency: constants of one template are about equally frequent.
Leaves are never gathered: counts of stretches and of paths are partial sums over all lines.

A template recurs if its lines stand in enough documents that are otherwise different: ``LEAST_DOCUMENTS``
classes of near copies, and two for lines of ``LONG`` plain tokens or more. A copied document's own lines are
not a template, however many copies there are. A text has a MinHash signature of one value a bin (an
empty bin takes that of the next one filled); texts that share a band of ``ROWS`` values are tied to the
band's least text if at least ``ALIKE`` of all values agree, and what is tied together is a class. A
passage that many documents share ties them only where it is so much of each that they are near copies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..storage import write_table
from .arrow import columns_of, free_names, slices, spread, told_apart
from .components import components
from .shingles import mixed

#: Fewer tokens than this are no template.
LEAST_TOKENS = 3
#: Stretches of a line, at most.
PARTS = 8
#: From the first length on one stretch may vary, from the second so many.
ONE_VARIES, SOME_VARY, VARYING = 6, 12, 3
#: Documents, different as a whole, in which a template must stand; and those for lines of ``LONG`` plain tokens.
LEAST_DOCUMENTS = 4
LONG, LEAST_LONG = 50, 2
#: Frequent pairs of stretches up to this many are broadcast; more are joined by shuffle.
BROADCAST_PAIRS = 1_000_000
WIDTH = 5
#: Values of a signature, and of one band of it.
BINS = 128
ROWS = 4
#: Share of equal values from which on two texts are copies.
ALIKE = 0.5
_FIELD = np.uint64(0x5EED)
_ONE = np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = mixed(np.arange(1, WIDTH + 1, dtype=np.uint64)) | np.uint64(1)
#: Bytes that part tokens, and those that make a token a field.
_SPACE, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT[48:58] = True
#: A number for each byte, and the base of token hashes with its inverse modulo 2 ** 64.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_BASE = 0x9E3779B97F4A7C15
#: Bytes that are hashed at once, unless a token is longer.
CHUNK = 1 << 19
#: Bytes of the texts that are worked on at once.
BATCH_BYTES = 2 << 20


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(powers of the base, powers of its inverse) up to a place."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return tuple(both)


def _chunks(text: bytes) -> Iterator[bytes]:
    """A text in parts that end where a token does."""
    at = 0
    while len(text) - at > CHUNK:
        stop = at + CHUNK
        cut = max(text.rfind(b" ", at, stop), text.rfind(b"\n", at, stop)) + 1
        if cut <= at:  # one token so far, which goes on to the next space
            found = re.compile(rb"[ \n]").search(text, stop)
            cut = found.end() if found else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes of tokens, the line of each, line ends) of some bytes.

    A hash is the sum of the bytes' numbers times powers of the base by their place in the token; its last bit
    says whether the token has a digit.
    """
    raw = np.frombuffer(data, np.uint8)
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, stop = edges[::2], edges[1::2]
    powers, inverse = _powers(max(CHUNK, 1 << len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * powers[: len(raw)], out=sums[1:])
    ends = np.flatnonzero(raw == 10)
    hashes = mixed((sums[stop] - sums[start]) * inverse[start])
    digits = np.flatnonzero(_DIGIT[raw])
    has = np.searchsorted(digits, stop) > np.searchsorted(digits, start)
    return (hashes & ~_ONE) | has.astype(np.uint64), np.searchsorted(ends, start), len(ends)


def line_tokens(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all tokens, tokens of each line, lines of each text) of some lower-case texts in a row."""
    hashes, lines, before, held, size = [], [], 0, [], 0

    def take() -> None:
        nonlocal before, held, size
        found, line, ends = _tokens(b"".join(held))
        hashes.append(found)
        lines.append(line + before)
        before, held, size = before + ends, [], 0

    for text in rows:
        for part in _chunks(text + b"\n"):  # a text's end is its last line's
            held.append(part)
            size += len(part)
            if size >= CHUNK:
                take()
    take()
    return np.concatenate(hashes), np.bincount(np.concatenate(lines), minlength=before), np.fromiter((t.count(b"\n") + 1 for t in rows), np.int64, len(rows))


def signatures_of(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text, given its number of tokens, ``BINS`` values: the least hash of its shingles in each bin."""
    padded = np.concatenate([hashes, np.zeros(WIDTH, np.uint64)])
    shingles = mixed(sum(padded[i : i + len(hashes) + 1] * _PLACES[i] for i in range(WIDTH)))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - WIDTH + 1, 0))
    at = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(sizes - WIDTH + 1, 0)) - np.maximum(sizes - WIDTH + 1, 0), np.maximum(sizes - WIDTH + 1, 0)) + starts[owner]
    # a text shorter than a shingle is one, with what follows left out
    short = np.flatnonzero(sizes < WIDTH)
    few = [sum(int(x) * int(p) for x, p in zip(hashes[starts[k] : starts[k] + sizes[k]], _PLACES)) + int(sizes[k]) & (1 << 64) - 1 for k in short]
    found = np.concatenate([shingles[at], mixed(np.array(few, np.uint64))])
    place = np.concatenate([owner, short]) * BINS + (found >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    least = np.full(len(sizes) * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, place, found)
    taken = np.zeros(len(least), bool)
    taken[place] = True
    # an empty bin takes the value of the next one filled, around the end too, told apart by how far it is
    order = np.arange(BINS)
    here = np.where(taken.reshape(-1, BINS), order, 2 * BINS)
    ahead = np.minimum.accumulate(np.concatenate([here, here + BINS], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    return mixed(np.take_along_axis(least.reshape(-1, BINS), ahead % BINS, axis=1) + (ahead - order).astype(np.uint64) * _STEP)


def parts_of(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(line, plain tokens, number of stretches) of the lines long enough, and stretches of all these in a row.

    A stretch hashes to the sum of its tokens' hashes mixed with their places in the line, together with
    its leaf and its own place. A token with a digit is a variable field, others are plain; stretches
    and lines of nothing but fields are left out.
    """
    hashes = np.where(hashes & _ONE, _FIELD, hashes)
    starts = np.cumsum(counts) - counts
    place = np.arange(len(hashes), dtype=np.int64) - np.repeat(starts, counts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes + place.astype(np.uint64) * _STEP))])
    fields = np.concatenate([np.zeros(1, np.int64), np.cumsum(hashes == _FIELD)])
    usable = np.nonzero((counts >= LEAST_TOKENS) & (fields[starts + counts] - fields[starts] < counts))[0]
    n, first = counts[usable], starts[usable]
    leaf = mixed(hashes[first] * _STEP + n.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
    parts = np.minimum(n, PARTS)
    line = np.repeat(np.arange(len(usable)), parts)
    i = np.arange(len(line)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin, end = first[line] + n[line] * i // parts[line], first[line] + n[line] * (i + 1) // parts[line]
    found = mixed(leaf[line] + (sums[end] - sums[begin]) * _STEP + i.astype(np.uint64)).view(np.int64)
    kept = fields[end] - fields[begin] < end - begin
    return usable, n - (fields[first + n] - fields[first]), np.bincount(line[kept], minlength=len(usable)), found[kept]


_ROWS = T.StructType([
    *(T.StructField(n, t) for n, t in (("text_key", T.LongType()), ("line", T.IntegerType()), ("tokens", T.IntegerType()), ("plain", T.IntegerType()))),
    T.StructField("parts", T.ArrayType(T.LongType())),
    T.StructField("signature", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``BATCH_BYTES`` of text at a time or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


def line_parts(docs: DataFrame) -> DataFrame:
    """text_key, line, tokens, plain tokens and parts of every line; and one row a text with its signature and
    bands instead."""

    def cut(batches):
        for batch in chain.from_iterable(map(_by_size, slices(batches, 256))):
            hashes, counts, lines = line_tokens([x or b"" for x in pc.utf8_lower(batch.column("text")).cast(pa.binary()).to_pylist()])
            owner = np.repeat(np.arange(len(lines)), lines)
            sizes = np.bincount(owner, counts, len(lines)).astype(np.int64)
            line, plain, k, parts = parts_of(hashes, counts)
            own = owner[line]
            number = line - (np.cumsum(lines) - lines)[own]
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(k)).astype(np.int32)), pa.array(parts))
            none = [pa.nulls(len(own), f) for f in (pa.binary(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(keys[own], pa.int64()), pa.array(number.astype(np.int32)), pa.array(counts[line].astype(np.int32)), pa.array(plain.astype(np.int32)), listed, *none], names=_ROWS.names)
            rows = np.unique(own)  # a text without such a line has no part in this
            if len(rows):
                found = signatures_of(hashes, sizes)
                values = found[rows].reshape(-1, BINS // ROWS, ROWS)
                band = np.tile(np.arange(BINS // ROWS, dtype=np.uint64), (len(rows), 1))
                for i in range(ROWS):
                    band = mixed(band * _STEP + values[:, :, i])
                # 16 bits of each value tell others apart well enough
                said = values.reshape(len(rows), BINS).astype(np.uint16)
                none = [pa.nulls(len(rows), f) for f in (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(keys[rows], pa.int64()), *none, pa.array([x.tobytes() for x in said], pa.binary()), pa.array(list(band.view(np.int64)), pa.list_(pa.int64()))], names=_ROWS.names)

    return spread(docs).select(F.xxhash64("text").alias("text_key"), "text").mapInArrow(cut, _ROWS)


def copy_links(signed: DataFrame) -> DataFrame:
    """(a, b): ties between texts that are near copies by their signatures."""
    signed = signed.dropDuplicates(["text_key"])
    bands = write_table(signed.select("text_key", F.explode("bands").alias("band")), "bands")
    least = bands.groupBy("band").agg(F.min("text_key").alias("least"), F.count(F.lit(1)).alias("texts")).where("texts > 1").drop("texts")
    pairs = bands.join(least, "band").where("text_key <> least").select(F.col("text_key").alias("a"), F.col("least").alias("b")).distinct()
    left, right = (signed.select(F.col("text_key").alias(n), F.col("signature").alias(f"of_{n}")) for n in "ab")

    def alike(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BINS) for c in ("of_a", "of_b"))
            yield batch.filter(pa.array((a == b).mean(axis=1) >= ALIKE)).select(["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(alike, "a long, b long")


def needed_parts(tokens: Column, parts: Column) -> Column:
    """Stretches of a line that constants must be: more than half in any case."""
    vary = F.when(tokens >= SOME_VARY, VARYING).when(tokens >= ONE_VARIES, 1).otherwise(0)
    return F.greatest(parts - vary, F.floor(parts / 2) + 1).cast("int")


def line_paths(lines: DataFrame, least: int) -> DataFrame:
    """path, text_key, line and ``least`` (the documents that make the path a recurring template).

    More than half of a recurring line's stretches are constants, so among its stretches in pairs there is a
    pair of two (or the odd one at the end). Lines without a frequent pair go before stretches are
    counted one by one; every instance of a recurring template has the same frequent pair and stays.
    """
    wanted = F.when(F.col("plain") >= LONG, F.lit(min(least, LEAST_LONG))).otherwise(F.lit(least))
    part = lambda i: F.get("parts", F.lit(i))
    pairs = F.explode(F.array(*[part(i).bitwiseXOR(F.coalesce(part(i + 1), F.lit(0).cast("long"))) for i in range(0, PARTS, 2)]))
    paired = lines.select(wanted.alias("wanted"), pairs.alias("pair")).where("pair IS NOT NULL").groupBy("pair").agg(F.count(F.lit(1)).alias("times"), F.min("wanted").alias("wanted"))
    frequent = write_table(paired.where("times >= wanted").select("pair", "times"), "frequent-pairs")
    if frequent.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        frequent = F.broadcast(frequent)
    marked = lines.select("text_key", "line", "tokens", "plain", "parts", pairs.alias("pair")).join(frequent, "pair").where(F.col("times") >= wanted)
    # copies of a text have the same rows
    likely = write_table(marked.groupBy("text_key", "line").agg(F.first("tokens").alias("tokens"), F.first("plain").alias("plain"), F.first("parts").alias("parts")), "likely-lines")
    placed = likely.select("text_key", "line", "tokens", "plain", F.size("parts").alias("k"), F.posexplode("parts").alias("at", "part"))
    times = placed.groupBy("part").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= min(least, LEAST_LONG))
    constants = placed.join(times, "part").where(F.col("times") >= wanted)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("times")).alias("rare"), "at", "part")))  # PARTS at most
    kept = constants.groupBy("text_key", "line", "tokens", "plain", "k").agg(listed.alias("p")).withColumn("need", needed_parts(F.col("tokens"), F.col("k")))
    kept = kept.where(F.size("p") >= F.col("need"))
    m, need = F.size("p"), F.col("need")
    path = lambda i, n: F.xxhash64(F.array_sort(F.transform(F.slice("p", i, n), lambda x: x["part"])))
    lengths = F.sequence(need, m)
    paths = F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), m - n + 1), lambda i: path(i, n))))
    return kept.select("text_key", "line", wanted.alias("least"), F.explode(F.array_distinct(paths)).alias("path"))


def recurring_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """text_key and ``drop``: the sorted numbers of the lines of a text that are instances of a recurring template."""
    cut = write_table(line_parts(docs), "line-parts")
    rows = write_table(line_paths(cut.where("parts IS NOT NULL").select("text_key", "line", "tokens", "plain", "parts"), least), "line-paths")
    # at least so many texts first, which needs no classes
    enough = lambda what: F.count(F.lit(1)).alias(what)
    several = rows.select("path", "text_key", "least").distinct().groupBy("path").agg(enough("texts"), F.max("least").alias("least")).where("texts >= least").select("path")
    held = write_table(rows.join(several, "path", "left_semi"), "held-paths")
    classes = components(copy_links(cut.where("signature IS NOT NULL").select("text_key", "signature", "bands"))).withColumnRenamed("node", "text_key")
    classed = held.join(classes, "text_key", "left").withColumn("class", F.coalesce("component", "text_key"))
    chosen = classed.select("path", "class", "least").distinct().groupBy("path").agg(enough("classes"), F.max("least").alias("least")).where("classes >= least").select("path")
    lines = held.join(chosen, "path", "left_semi").select("text_key", "line").distinct()
    return lines.groupBy("text_key").agg(F.array_sort(F.collect_list("line")).alias("drop"))


def without_templates(docs: DataFrame, least: int = LEAST_DOCUMENTS, counts: tuple[str, str] = ("lines", "dropped")) -> DataFrame:
    """``docs`` with recurring template lines taken out of ``text``, and two more columns that count lines.

    All instances go, the first too. The other lines stay as they are, in order. A null text stays null
    and an empty one empty; equal texts lose the same lines; null and repeated ids are rows of their
    own; an empty table gives an empty result; further columns are kept. ``counts`` names the columns
    for a text's lines and those dropped, which ``docs`` must not have.
    """
    docs, names = told_apart(docs, "text")
    key, other, drop, cut, bounds = free_names(docs, "text_key", "dropped_key", "drop", "cut", "bounds")
    gone = recurring_lines(docs.select("text"), least).select(F.col("text_key").alias(other), F.col("drop").alias(drop))
    joined = docs.withColumn(key, F.xxhash64("text")).join(gone, F.col(key) == F.col(other), "left")
    # a column, so that a text is cut once, and only where lines go
    joined = joined.withColumn(cut, F.when(F.col(drop).isNotNull(), F.split(F.col("text"), "\n", -1)))
    lines = F.col(cut)
    # what stands between one dropped line and the next
    ends = F.concat(F.array(F.lit(-1)), F.col(drop), F.array(F.size(lines)))
    joined = joined.withColumn(bounds, F.when(F.col(drop).isNotNull(), ends))
    at = lambda k: F.get(F.col(bounds), k)
    between = lambda k: F.slice(lines, at(k - 1) + 2, at(k) - at(k - 1) - 1)
    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), between)), "\n")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    cleaned = F.when(F.col(drop).isNull(), F.col("text")).otherwise(kept)
    rows = joined.select(
        *[cleaned.alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.coalesce(n_lines, F.lit(0)).cast("long").alias(counts[0]),
        F.greatest(F.coalesce(F.size(drop), F.lit(0)), F.lit(0)).cast("long").alias(counts[1]),
    )
    return rows.toDF(*names, *counts)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, n_chars left and the digest of the text left, per document.

    A null text counts as empty: no lines if null, one if empty, none dropped, the digest of the empty
    string. Null and repeated ids are rows of their own, and equal texts have equal values; an empty table
    gives an empty result; further columns are ignored. Texts of any length are read whole.
    """
    cleaned = without_templates(columns_of(docs, "doc_id", "text"), counts=("n_lines", "n_dropped"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


def cleaned_documents(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` without recurring lines and without the documents that were nothing else; n_chars, where
    there is one, follows the text."""
    docs, names = told_apart(docs, "text", "n_chars")
    total, dropped = free_names(docs, "lines", "dropped")
    cleaned = without_templates(docs, least, (total, dropped))
    empty = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0
    rows = cleaned.where(~((F.col(dropped) > 0) & empty))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns).toDF(*names)
