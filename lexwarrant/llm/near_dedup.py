"""MinHash near-duplicate groups by an LSH forest, with every link confirmed on full shingle sets.

Documents with equal shingle sets are one class with one representative. A tree of the forest is one
order of signature values; all representatives are sorted by it over the whole cluster (ranges of
tree, prefix and further values), so those with a long common prefix stand side by side. A run of equal
prefixes of a level's depth is a region. Candidates are the pairs of a region whose sketches (two bits of each
of 128 values) agree well enough.

Depth adapts by region. In one of more than ``DENSE`` members only those are compared that have longer
prefixes in common, as much longer as it takes until few enough do. Such regions that share members are a team.
A team of up to ``WHOLE`` times ``DENSE`` members is compared whole, as a crowd (below), which loses nothing. If a
region of a larger one isn't one component after that, its members go to the next level of ``LEVELS``, where prefixes are longer and trees more,
so that what is only somewhat alike comes apart while a pair at the threshold still meets. What is dense at
the last level too is compared whole by bitmaps of the sets, which loses nothing.

A region with more candidates than members, as of a family of edited copies, gives a tree of them instead, and
what such trees connect is a crowd. Pairs are confirmed on full sets, and crowds compared whole on full sets in
tiles (see ``jaccard_join``), of which only links come out. Only links make components.

Two sets at the threshold of 0.8 miss each other in all trees of the first level with probability
(1 - 0.8 ** 4) ** 32 = 5e-8; the sketch fails them with 3e-6; a pair that only meets in dense regions
misses all trees of the second level with 9e-6 and of the third with 7e-6 (trees there share values, which
these figures allow for).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import write_table
from . import jaccard_join as J
from .arrow import columns_of, free_names, slices, spread, texts, told_apart
from .components import components
from .sets import forest, set_key, sets_of, texts_of
from .shingles import mixed, shingle_set, signature

WIDTH = 5
NEEDED = 80
#: Members of the largest region that is compared at its own depth.
DENSE = 1024
#: A team of dense regions with up to so many times ``DENSE`` members is compared whole.
WHOLE = 4
#: Candidates that a region of any size may give as pairs.
PAIRS = 16
#: Values of the sketch, two bits each, and how many deviations below the expected a pair may agree.
SKETCH = 128
#: Signature values that order a region beyond its prefix, two to a number.
DEEPER = 8
_DEVIATIONS = 5.0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_S = ("s0", "s1", "s2", "s3")
_T = tuple(f"t{i}" for i in range(DEEPER // 2))
#: Members of a region whose pairs are all looked at by distance; it is at most as many as ``PAIRS`` lets through.
_SMALL = 6


@dataclass(frozen=True)
class Level:
    trees: int
    depth: int
    #: Values of a signature, which the trees of a level share.
    values: int


LEVELS = (Level(32, 4, 128), Level(96, 8, 256), Level(256, 12, 512))


@lru_cache(maxsize=8)
def _order(level: Level) -> np.ndarray:
    """Which values each tree reads: its prefix, then those that order what shares the prefix."""
    if level.trees * level.depth == level.values:
        return (np.arange(level.trees)[:, None] * level.depth + np.arange(level.depth + DEEPER)) % level.values
    draw = np.random.default_rng(level.trees)
    return np.array([draw.permutation(level.values)[: level.depth + DEEPER] for _ in range(level.trees)])


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key and signature (32-bit values) of every text."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()), T.StructField("signature", T.BinaryType())])
    values = LEVELS[0].values

    def sign(batches):
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in texts(batch)]
            keys = [set_key(s) if len(s) else None for s in sets]
            values_of = [signature(s, values).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.binary()), pa.array(values_of, pa.binary())], names=schema.names)

    return columns_of(docs, "doc_id", "text").mapInArrow(sign, schema)


def entries(members: DataFrame, level: Level) -> DataFrame:
    """prefix, further values, rep and the sketch: one row a tree of every member (rep, signature)."""
    names = ("prefix", *_T, "rep", *_S)
    order = _order(level)

    def deal(batches):
        for batch in slices(batches, max(64, 65_536 // level.trees)):
            n = batch.num_rows
            if not n:
                continue
            table = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(n, level.values)
            read = table[:, order].astype(np.uint64)  # members, trees, places
            prefix = np.broadcast_to(np.arange(level.trees, dtype=np.uint64) + np.uint64(level.trees << 16), (n, level.trees))
            for i in range(level.depth):
                prefix = mixed(prefix * _STEP + read[:, :, i])
            further = (read[:, :, level.depth :: 2] << np.uint64(32)) | read[:, :, level.depth + 1 :: 2]
            bits = (table[:, :SKETCH] & 3).astype(np.uint64).reshape(n, 4, SKETCH // 4) << (2 * np.arange(SKETCH // 4, dtype=np.uint64))
            sketch = np.bitwise_or.reduce(bits, axis=2).view(np.int64)
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            flat = lambda x: pa.array(x.reshape(-1).view(np.int64))
            each = lambda x: pa.array(np.repeat(x, level.trees))
            yield pa.RecordBatch.from_arrays([flat(prefix), *(flat(further[:, :, i].copy()) for i in range(len(_T))), each(reps), *(each(sketch[:, i]) for i in range(4))], names=names)

    return members.select("rep", "signature").mapInArrow(deal, ", ".join(f"{n} long" for n in names))


def _most_apart(needed: int) -> int:
    """Sketch values in which two sets at the threshold may differ."""
    agree = needed / 100 + (1 - needed / 100) / 4
    return int(np.floor(SKETCH * (1 - agree) + _DEVIATIONS * np.sqrt(SKETCH * agree * (1 - agree))))


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many sketch values rows of x and y differ."""
    d = x ^ y
    return np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=-1)


def region_pairs(reps: np.ndarray, further: np.ndarray, sketch: np.ndarray, most: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(kind, a, b) of a region in its order: candidates, or a tree of them if they are more than the members.

    A region of more than ``DENSE`` members is looked at where longer prefixes are common: ``further`` has the
    values by which it is sorted on.
    """
    out, parts = [], [(0, len(reps), 0)]
    while parts:
        start, stop, depth = parts.pop()
        if stop - start < 2:
            continue
        if stop - start > DENSE:
            if depth < further.shape[1]:
                at = start + 1 + np.nonzero(np.diff(further[start:stop, depth]))[0]
                parts += [(int(s), int(e), depth + 1) for s, e in zip(np.append(start, at), np.append(at, stop))]
                continue
            i = np.arange(start, stop - 1)
            j = i + 1
        else:
            i, j = (x + start for x in np.triu_indices(stop - start, 1))
        good = _apart(sketch[i], sketch[j]) <= most
        i, j = i[good], j[good]
        crowded = len(i) > max(PAIRS, stop - start)
        if crowded:
            i, j = (x + start for x in forest(i - start, j - start, stop - start))
        out.append(("tie" if crowded else "pair", reps[i], reps[j]))
    return out


_LOOKED = "kind string, prefix long, a long, b long, " + ", ".join(f"{s} long" for s in _S)


def _looked(found: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (kind, prefix, a, b, sketch); ``pair`` and ``tie`` have no sketch."""
    kinds = pa.array([k for k, *_ in found], pa.string()).take(pa.array(np.repeat(np.arange(len(found)), [len(x[2]) for x in found])))
    prefix, a, b = (np.concatenate([np.zeros(0, np.int64), *(x[c] for x in found)]) for c in (1, 2, 3))
    sketch = np.concatenate([np.zeros((0, 4), np.int64), *(x[4] for x in found)])
    return pa.RecordBatch.from_arrays([kinds, pa.array(prefix), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *(pa.array(sketch[:, i].copy()) for i in range(4))], names=["kind", "prefix", "a", "b", *_S])


def looked_through(rows: DataFrame, needed: int) -> DataFrame:
    """(kind, prefix, a, b, sketch) of all regions of a level's ``entries``.

    ``pair`` and ``tie`` are candidates, ``dense`` members of large regions, ``edge`` members, with their
    sketches, of regions that a range of the order may have cut.
    """
    most, order = _most_apart(needed), ["prefix", *_T, "rep"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    first_s = 2 + len(_T)

    def look(rows: np.ndarray, begins: bool, ends: bool) -> pa.RecordBatch:
        prefix, reps, sketch = rows[:, 0], rows[:, first_s - 1], rows[:, first_s:].copy().view(np.uint64)
        starts = np.append(0, np.nonzero(np.diff(prefix))[0] + 1)
        lengths = np.diff(np.append(starts, len(prefix)))
        cut = np.zeros(len(starts), bool)
        cut[0] |= begins
        cut[-1] |= ends
        none = np.zeros((0, 4), np.int64)
        out = []
        small = np.repeat((lengths <= _SMALL) & ~cut, lengths)
        at = np.nonzero(small)[0]
        for d in range(1, _SMALL):
            at = at[at + d < len(prefix)]
            at = at[prefix[at] == prefix[at + d]]
            good = at[_apart(sketch[at], sketch[at + d]) <= most]
            out.append(("pair", prefix[good], reps[good], reps[good + d], none))
        for k in np.nonzero((lengths > _SMALL) | cut)[0]:
            here = slice(starts[k], starts[k] + lengths[k])
            if cut[k]:
                out.append(("edge", prefix[here], reps[here], reps[here], sketch[here].view(np.int64)))
                continue
            out += [(kind, np.full(len(a), prefix[starts[k]]), a, b, none) for kind, a, b in region_pairs(reps[here], rows[here, 1 : 1 + len(_T)], sketch[here], most)]
            if lengths[k] > DENSE:
                out.append(("dense", prefix[here], reps[here], reps[here], none))
        # what has no sketch to carry gets an empty one
        return _looked([(k, p, a, b, s if len(s) == len(a) else np.zeros((len(a), 4), np.int64)) for k, p, a, b, s in out])

    def walk(batches):
        held, begins = np.zeros((0, first_s + 4), np.int64), True
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            if not len(held):
                continue
            last = int(np.searchsorted(held[:, 0], held[-1, 0]))  # where the last region begins, which may go on
            if last:
                yield look(held[:last], begins, False)
                held, begins = held[last:], False
            if len(held) > 1 << 16:  # a long region goes in parts
                yield look(held, True, True)
                held, begins = held[:0], True
        if len(held):
            yield look(held, begins, True)

    return ordered.mapInArrow(walk, _LOOKED)


def candidates(looked: DataFrame, needed: int) -> tuple[DataFrame, DataFrame]:
    """((kind, a, b), (prefix, rep)): candidates of all regions, those of cut ones put together again; and members
    of dense ones."""
    most = _most_apart(needed)
    edges = looked.where("kind = 'edge'")
    sizes = edges.groupBy("prefix").agg(F.count(F.lit(1)).alias("members"))
    sized = edges.join(sizes, "prefix")

    def compare(table: pa.Table) -> pa.Table:
        sketch = np.stack([table.column(s).to_numpy() for s in _S], axis=1).view(np.uint64)
        # the order beyond the prefix isn't needed at this depth
        found = [(kind, a, a, b, np.zeros((len(a), 4), np.int64)) for kind, a, b in region_pairs(table.column("a").to_numpy(), np.zeros((len(sketch), 0), np.int64), sketch, most)]
        return pa.Table.from_batches([_looked(found)]).select(["kind", "a", "b"])

    mended = sized.where((F.col("members") > 1) & (F.col("members") <= DENSE)).select("prefix", "a", *_S).groupBy("prefix").applyInArrow(compare, "kind string, a long, b long")
    found = looked.where("kind IN ('pair', 'tie')").select("kind", "a", "b").union(mended).where("a < b").distinct()
    dense = looked.where("kind = 'dense'").select("prefix", F.col("a").alias("rep")).union(sized.where(F.col("members") > DENSE).select("prefix", F.col("a").alias("rep")))
    return found, dense


def _teams(dense: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((kind, a, b), (prefix, rep)): ties that make each small team of dense regions (prefix, rep) a crowd, and the
    members of large ones."""
    ends = dense.groupBy("prefix").agg(F.min("rep").alias("a")).join(dense, "prefix").select("a", F.col("rep").alias("b"))
    teams = components(ends)
    sizes = teams.groupBy("component").agg((F.count(F.lit(1)) > WHOLE * DENSE).alias("large"))
    sized = write_table(teams.join(sizes, "component"), "dense-teams")
    ties = sized.where("not large and component < node").select(F.lit("tie").alias("kind"), F.col("component").alias("a"), F.col("node").alias("b"))
    large = sized.where("large")
    if large.isEmpty():
        return ties, dense.limit(0)
    return ties, write_table(dense.join(large.select(F.col("node").alias("rep")), "rep", "left_semi"), "dense")


def _mixed(dense: DataFrame, known: DataFrame, settled: DataFrame | None) -> DataFrame:
    """Members (prefix, rep) of the dense regions that aren't one component of ``known``, nor within one crowd of
    ``settled``, which has been compared whole."""
    placed = dense.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = "min(component) <> max(component)"
    if settled is not None:
        placed = placed.join(settled.withColumnRenamed("node", "rep"), "rep", "left").withColumn("crowd", F.coalesce("crowd", "rep"))
        apart += " and min(crowd) <> max(crowd)"
    several = placed.groupBy("prefix").agg(F.expr(apart).alias("apart")).where("apart").select("prefix")
    return dense.join(several, "prefix", "left_semi")


def _signed_deeper(docs: DataFrame, ids: DataFrame, classes: DataFrame, width: int, values: int) -> DataFrame:
    """rep, n, signature of ``values`` and bitmap of the representatives in ``ids`` (rep)."""

    def sign(batches):
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in texts(batch)]
            held = [set_key(s) == key for s, key in zip(sets, batch.column("set_key").to_pylist())]  # another row may carry the same id
            sets = [s for s, h in zip(sets, held) if h]
            yield pa.RecordBatch.from_arrays([
                batch.column("rep").filter(pa.array(held, pa.bool_())), pa.array(list(map(len, sets)), pa.int64()), pa.array([signature(s, values).tobytes() for s in sets], pa.binary()),
                pa.array([J.bitmap(s, J.bitmap_bits(len(s))).tobytes() for s in sets], pa.binary()),
            ], names=["rep", "n", "signature", "bitmap"])

    return write_table(texts_of(docs, ids, classes).mapInArrow(sign, "rep long, n long, signature binary, bitmap binary").dropDuplicates(["rep", "signature"]), "deep-signed")


def linked(docs: DataFrame, classes: DataFrame, same: DataFrame, width: int, needed: int) -> DataFrame:
    """node, component over all links the forest finds between classes (rep, set_key, signature), and those
    of ``same`` (a, b)."""
    links, trees, settled = write_table(same, "same"), None, None

    def confirm(found: DataFrame) -> None:
        """``links`` with those among candidates (kind, a, b)."""
        nonlocal links, trees, settled
        if settled is not None:  # what a crowd has been compared for needs no second look
            of = lambda x: settled.select(F.col("node").alias(x), F.col("crowd").alias(f"of_{x}"))
            found = found.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce(F.col("of_a") != F.col("of_b"), F.lit(True))).select("kind", "a", "b")
        found = write_table(found, "candidates")
        few, many = found.where("kind = 'pair'").select("a", "b"), found.where("kind = 'tie'").select("a", "b")
        ids = few.select(F.col("a").alias("rep")).union(few.select("b"))
        crowds = None
        if not many.isEmpty():
            trees = many if trees is None else trees.union(many)
            settled = components(trees).withColumnRenamed("component", "crowd")
            grown = settled.join(many.select(F.col("a").alias("node")), "node", "left_semi").select("crowd").distinct()
            crowds = settled.join(grown, "crowd", "left_semi")
            ids = ids.union(crowds.select("node"))
        sets = sets_of(docs, ids.distinct(), classes, width)
        links = links.union(write_table(J.confirmed(few, sets, needed), "near-links"))
        if crowds is not None:
            links = links.union(J.crowd_links(crowds, sets, links, needed))

    members = classes
    for k, level in enumerate(LEVELS):
        found, dense = candidates(write_table(looked_through(entries(members, level), needed), "looked"), needed)
        dense = write_table(dense.distinct(), "dense")
        more = not dense.isEmpty()
        if more:
            ties, dense = _teams(dense)
            found, more = found.union(ties), not dense.isEmpty()
        confirm(found)
        if not more:
            break
        mixed_ones = write_table(_mixed(dense, components(links), settled), "mixed")
        if mixed_ones.isEmpty():
            break
        last = k == len(LEVELS) - 1
        members = _signed_deeper(docs, mixed_ones.select("rep").distinct(), classes, width, LEVELS[min(k + 1, len(LEVELS) - 1)].values)
        if last:
            ends = mixed_ones.groupBy("prefix").agg(F.min("rep").alias("a")).join(mixed_ones, "prefix").select("a", F.col("rep").alias("b"))
            pairs = J.team_pairs(components(ends).withColumnRenamed("component", "team"), members, needed)
            confirm(pairs.select(F.when(F.col("crowded"), "tie").otherwise("pair").alias("kind"), "a", "b"))
    return components(links)


def near_duplicates(docs: DataFrame, width: int = WIDTH, needed: int = NEEDED) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept, per document.

    Links join sets with 100 * intersection >= ``needed`` * union; trees and depths are set for 80. A
    null text or one without words has the empty set and is linked with nothing. A row with a null id
    can't be named by others: it is linked with nothing, its component is null, and it is kept. Rows
    that repeat an id count as one document for links; an empty table gives an empty result; further
    columns are ignored. Ids are integers.
    """
    docs = columns_of(docs, "doc_id", "text")
    docs = spread(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    sets = write_table(signed(docs, width), "signed")
    named = sets.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = write_table(named.groupBy("set_key").agg(F.min(F.struct("doc_id", "signature")).alias("r")).select("set_key", F.col("r.doc_id").alias("rep"), "r.signature"), "classes")
    # rows of a repeated id tie their classes together
    repeats = named.select("doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    same = named.select("doc_id", "set_key").join(repeats, "doc_id", "left_semi").join(classes.select("set_key", "rep"), "set_key").where("doc_id <> rep")
    found = linked(docs, classes, same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), width, needed).withColumnRenamed("node", "rep")
    by_class = classes.select("set_key", "rep").join(found, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("linked"))
    joined = sets.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(by_class, "set_key", "left")
    component = F.coalesce("linked", "doc_id")
    return joined.select(F.col("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, width: int = WIDTH, needed: int = NEEDED) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the least id stays."""
    docs, names = told_apart(docs, "doc_id", "text")
    (name,) = free_names(docs, "gone")
    gone = near_duplicates(docs, width, needed).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti").toDF(*names)
