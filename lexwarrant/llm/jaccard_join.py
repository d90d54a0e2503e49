"""Exact self-join of documents by the Jaccard similarity of their shingle sets.

All shingles have one order, rare ones first. Two sets at the threshold share some of the first few of each
in that order, so rows (shingle, size, place, document) of these, sorted over the whole cluster, bring every
pair that can link side by side; copies of one set collapse there. What shares a shingle is compared by
sizes and places, which bound the overlap from above. Where few share one, the pairs that pass are counted, and
those are candidates that share ``AGREE`` such shingles: that strangers share one grows with the square of their
number. Where many share one, they are tied together, and what ties connect is a team.

Each set has a bitmap, one bit a hash value, set where an odd number of its shingles fall, as wide as its size
asks for. Bits in which two bitmaps differ come from shingles that only one set has, so their count bounds the
overlap from above. Teams are compared by bitmaps in tiles: whole where they are small, else in bands of sizes
as wide as the threshold, so that links never skip a band, and in blocks within a band. What passes is
confirmed by intersecting the sorted arrays of both whole sets. Where more pairs of a tile pass than it could
need, as in a large family of copies, it gives a tree of them instead, and what such trees connect is compared
in tiles of whole sets, each tile in itself, then pairs of tiles of what isn't one component by then.

No bound ever fails a link, and nothing is sampled but the order: which shingles count as common is taken
from ``SAMPLE`` documents, or one of ``EVERY`` of a larger table, and any order gives the same links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import write_table
from .arrow import columns_of, slices, spread, texts
from .components import components
from .sets import forest, set_key, sets_of
from .shingles import shingle_set

WIDTH = 4
NEEDED = 85
#: Documents, about, by which common shingles are known, or one of so many if that is more; shingles of this many of
#: them are, and at most so many.
SAMPLE, EVERY, COMMON, MOST_COMMON = 16_384, 32, 2, 500_000
#: Documents that share a shingle and are paired by themselves, and those that are tied by bounds.
FEW, MANY = 256, 512
#: Shingles among the first ones that a pair must share, where its sets are large enough.
AGREE = 3
#: Members and shingles of a tile, about.
TILE, TILE_SHINGLES = 512, 2_000_000
#: Pairs for each member that a tile may give by themselves, and the least number that any may.
SPARSE, LEAST = 4, 64
#: Bits of a bitmap for each shingle of its set, and the widest one.
BITS, WIDEST = 4, 1 << 18
#: Bytes of bitmaps, about, whose tiles one call compares, and 64-bit words compared at once.
BUCKET, AT_ONCE = 4 << 20, 1 << 20


def agreed(n: int | np.ndarray, needed: int):
    """How many of its first shingles a set of n shares with any other at the threshold that isn't smaller."""
    return np.minimum(AGREE, -(-needed * n // 100))


def looked_at(n: int, needed: int) -> int:
    """How many of a set's first shingles hold the ``agreed`` ones."""
    return n - -(-needed * n // 100) + int(agreed(n, needed))


def bitmap_bits(n: int) -> int:
    return min(WIDEST, max(64, 1 << (BITS * n - 1).bit_length()))


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words of the parities of the shingles that fall on each bit."""
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set with fewer words."""
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def can_link(differ: int | np.ndarray, n: int | np.ndarray, m: int | np.ndarray, needed: int):
    """Whether sets of n and m members, of which at least ``differ`` aren't shared, can be at the threshold."""
    return differ * (100 + needed) <= (n + m) * (100 - needed)


def linked_sets(x: np.ndarray, y: np.ndarray, needed: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= needed * (len(x) + len(y) - common)


def common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that ``COMMON`` of the documents drawn have, by hash; their counts in the second row."""
    n = docs.count()
    drawn = docs if n <= SAMPLE else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(min(EVERY, n // SAMPLE))) == 0)

    def each(batches):
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in texts(batch)]
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    counted = drawn.select("text").mapInArrow(each, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    rows = counted.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()  # bounded by MOST_COMMON
    found = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("shingle", "n")])
    return found[:, np.argsort(found[0].view(np.uint64))]


def first_shingles(shingles: np.ndarray, common: np.ndarray, needed: int) -> np.ndarray:
    """The first shingles of a set in the order of all: rare ones by hash, then common ones, the least common first."""
    n = looked_at(len(shingles), needed)
    known = common[0].view(np.uint64)
    if not len(known):
        return shingles[:n]
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    times = np.where(known[at] == shingles, common[1][at], 0)
    return shingles[np.argsort(times, kind="stable")[:n]]


def signed(docs: DataFrame, width: int, needed: int, common: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, set_key, first (shingles to look at) and bitmap of every text."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()), T.StructField("first", T.ArrayType(T.LongType())), T.StructField("bitmap", T.BinaryType())])
    held = docs.sparkSession.sparkContext.broadcast(common)

    def sign(batches):
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([first_shingles(s, held.value, needed).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([bitmap(s, bitmap_bits(len(s))).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=schema.names)

    return columns_of(docs, "doc_id", "text").mapInArrow(sign, schema)


def met(members: DataFrame, needed: int) -> DataFrame:
    """(kind, shingle, a, b, least) of documents that share one of their first shingles.

    ``pair``: what sizes and places let link, where up to ``FEW`` share one; a link has ``least`` such rows at least
    or is tied. ``tie``: a tree of that where up to ``MANY`` do; beyond, neighbours by size. ``edge``: an end of a run
    of equal shingles that a range of the order may have cut.
    """
    place = F.shiftleft(F.col("n_shingles"), 32) + F.col("at")
    rows = members.select("n_shingles", F.xxhash64("set_key").alias("key"), F.col("doc_id").alias("rep"), F.posexplode("first").alias("at", "shingle")).select("shingle", place.alias("place"), "key", "rep")
    order = ["shingle", "place", "key", "rep"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def look(rows: np.ndarray, begins: bool, ends: bool) -> pa.RecordBatch:
        """``begins``, ``ends``: the first or the last run may be part of a longer one."""
        fresh = np.append(True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0))  # copies of one set have one place
        shingle, place, _, rep = rows[:, fresh]
        starts = np.append(0, np.nonzero(np.diff(shingle))[0] + 1)
        lengths = np.diff(np.append(starts, len(shingle)))
        cut = np.zeros(len(starts), bool)
        cut[0] |= begins
        cut[-1] |= ends
        whole = (lengths <= FEW) & ~cut
        few, most = np.repeat(whole, lengths), int(lengths[whole].max(initial=0))
        out: list[tuple[str, np.ndarray, np.ndarray]] = []
        at = np.nonzero(few)[0]
        for d in range(1, most):
            at = at[(at + d < len(shingle))]
            at = at[shingle[at] == shingle[at + d]]
            good = at[in_bounds(place[at], place[at + d], needed, AGREE - 1)]
            out.append(("pair", good, good + d))
        for k in np.nonzero(~whole)[0]:
            run = np.arange(starts[k], starts[k] + lengths[k])
            if lengths[k] <= MANY and not cut[k]:
                i, j = np.triu_indices(len(run), 1)
                good = in_bounds(place[run[i]], place[run[j]], needed, AGREE - 1)
                i, j = forest(i[good], j[good], len(run))
            else:  # what two can link lies between them by size
                n = place[run] >> 32
                i = np.nonzero(100 * n[:-1] >= needed * n[1:])[0]
                j = i + 1
            out.append(("tie", run[i], run[j]))
        at = np.unique([x for s, k in zip(starts[cut], lengths[cut]) for x in (s, s + k - 1)]).astype(int)
        out.append(("edge", at, at))
        kinds = pa.array([k for k, *_ in out]).take(pa.array(np.repeat(np.arange(len(out)), [len(i) for _, i, _ in out])))
        i, j = (np.concatenate([x[c] for x in out]) for c in (1, 2))
        least = agreed(np.minimum(place[i], place[j]) >> 32, needed).astype(np.int32)
        return pa.RecordBatch.from_arrays([kinds, pa.array(shingle[i]), pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j])), pa.array(least)], names=["kind", "shingle", "a", "b", "least"])

    def walk(batches):
        held, begins = np.zeros((4, 0), np.int64), True
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if not held.shape[1]:
                continue
            last = int(np.searchsorted(held[0], held[0, -1]))  # where the last run begins, which may go on
            if last:
                yield look(held[:, :last], begins, False)
                held, begins = held[:, last:], False
            if held.shape[1] > 1 << 16:  # a long run goes in parts, which end and begin with the same row
                yield look(held, True, True)
                held, begins = held[:, -1:], True
        if held.shape[1]:
            yield look(held, begins, True)

    return ordered.mapInArrow(walk, "kind string, shingle long, a long, b long, least int")


def in_bounds(x: np.ndarray, y: np.ndarray, needed: int, before: int = 0) -> np.ndarray:
    """Whether sets with these places of a shared shingle can link: each shares no more than it has left, and up to
    ``before`` that stand before it."""
    n, m, at, to = x >> 32, y >> 32, x & 0xFFFFFFFF, y & 0xFFFFFFFF
    most = np.minimum(n - at, m - to) + np.minimum(before, np.minimum(at, to))
    return can_link(n + m - 2 * most, n, m, needed)


def agreeing(found: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``met`` that share as many of their first shingles as a link that isn't tied."""
    counted = found.where("kind = 'pair' and a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"))
    return counted.where("n >= least").select("a", "b")


def _bands(n: str, needed: int) -> F.Column:
    """Bands of sizes: two sizes within the threshold of each other are in one band or in neighbours."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(np.log(100 / needed) * (1 + 1e-9))).cast("int")


def placed(rows: DataFrame, needed: int) -> tuple[DataFrame, DataFrame]:
    """(rows with band and block, tiles): ``rows`` (team, rep, n, ...) put into the tiles (team, band, block)."""
    n, shingles = F.count(F.lit(1)), F.sum("n")
    teams = rows.groupBy("team").agg(((n > TILE) | (shingles > TILE_SHINGLES)).alias("large"))
    banded = rows.join(teams, "team").withColumn("band", F.when(F.col("large"), _bands("n", needed)).otherwise(0)).drop("large")
    blocks = banded.groupBy("team", "band").agg(F.greatest(F.ceil(n / TILE), F.ceil(shingles / TILE_SHINGLES)).cast("int").alias("blocks"))
    out = banded.join(blocks, ["team", "band"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks")
    return out, blocks.select("team", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))


def _unit(rows: DataFrame) -> DataFrame:
    keys = ["team", "band", "block", "to_band", "to_block"]
    return rows.withColumn("unit", F.xxhash64(*keys)).drop(*keys)


def inside(rows: DataFrame) -> DataFrame:
    """Rows of tiles, each with the unit in which its tile meets itself."""
    return _unit(rows.withColumns({"to_band": F.col("band"), "to_block": F.col("block"), "own": F.lit(True)}))


def across(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """Rows of tiles once for every other tile of their team whose sizes can link; ``own`` tells the sides."""
    there = tiles.withColumnsRenamed({"band": "to_band", "block": "to_block"})
    met_by = lambda step: rows.join(there.withColumn("band", F.col("to_band") - step), ["team", "band"])
    same = met_by(0).where("block <> to_block")
    same = same.withColumns({"block": F.least("block", "to_block"), "to_block": F.greatest("block", "to_block"), "own": F.col("block") < F.col("to_block")})
    up = met_by(1).withColumn("own", F.lit(True))
    down = met_by(-1).withColumns({"band": F.col("to_band"), "block": F.col("to_block"), "to_band": F.col("band"), "to_block": F.col("block"), "own": F.lit(False)})
    return _unit(same.unionByName(up).unionByName(down))


def tile_pairs(own: np.ndarray, place: np.ndarray, maps: list[np.ndarray], needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the two sides of a tile pair, or of one tile, that bounds leave possible."""
    size = min(map(len, maps))
    bits = np.stack([folded(m, size) for m in maps])
    left, right = np.nonzero(own)[0], np.nonzero(~own)[0]
    alone = not len(right)
    if alone:
        right = left
    n, out = place >> 32, [np.zeros((2, 0), np.int64)]
    step = max(1, AT_ONCE // (size * max(1, len(right))))
    for at in range(0, len(left), step):
        i, j = np.meshgrid(left[at : at + step], right, indexing="ij")
        i, j = i.reshape(-1), j.reshape(-1)
        good = in_bounds(place[i], place[j], needed)
        if alone:
            good &= i < j
        i, j = i[good], j[good]
        differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        good = can_link(differ, n[i], n[j], needed)
        out.append(np.stack([i[good], j[good]]))
    return tuple(np.concatenate(out, axis=1))


def within_bounds(pairs: DataFrame, members: DataFrame, needed: int) -> DataFrame:
    """The pairs (a, b) that bitmaps of the documents (rep, n, bitmap) leave possible."""
    of = lambda x: members.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def bound(batches):
        for batch in slices(batches, 1024):
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            differ = np.zeros(len(n), np.int64)
            for k, maps in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())):
                x, y = (np.frombuffer(w, np.uint64) for w in maps)
                size = min(len(x), len(y))
                differ[k] = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64))
            good = pa.array(can_link(differ, n, m, needed))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(good) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(bound, "a long, b long").distinct()


_PAIRS = "a long, b long, crowded boolean"


def team_pairs(teams: DataFrame, members: DataFrame, needed: int) -> DataFrame:
    """(a, b, crowded) within teams (node, team): pairs that bitmaps of the documents (rep, n, bitmap) leave possible;
    of a tile with more of them than ``SPARSE`` a member a tree of them, as crowded."""
    rows, tiles = placed(teams.withColumnRenamed("node", "rep").join(members, "rep"), needed)
    rows, tiles = write_table(rows, "team-rows"), write_table(tiles, "team-tiles")
    names = ["unit", "own", "rep", "n", "bitmap"]
    dealt = inside(rows).select(*names).union(across(rows, tiles).select(*names))
    buckets = max(1, rows.agg(F.sum(F.length("bitmap") + 64)).first()[0] // BUCKET) if not rows.isEmpty() else 1

    def compare(table: pa.Table) -> pa.Table:
        unit, own, rep, n = (table.column(c).to_numpy() for c in ("unit", "own", "rep", "n"))
        maps = [np.frombuffer(m, np.uint64) for m in table.column("bitmap").to_pylist()]
        order = np.argsort(unit, kind="stable")
        out = [np.zeros((3, 0), np.int64)]
        for rows in np.split(order, np.nonzero(np.diff(unit[order]))[0] + 1):
            if len(rows) < 2 or not own[rows].any():
                continue
            i, j = tile_pairs(own[rows], n[rows] << 32, [maps[k] for k in rows], needed)
            crowded = len(i) > max(LEAST, SPARSE * len(rows))
            if crowded:
                i, j = forest(i, j, len(rows))
            x, y = rep[rows[i]], rep[rows[j]]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y), np.full(len(x), crowded)]))
        a, b, crowded = np.unique(np.concatenate(out, axis=1), axis=1)
        return pa.table([pa.array(a), pa.array(b), pa.array(crowded == 1)], names=["a", "b", "crowded"])

    bucketed = dealt.withColumn("bucket", F.pmod("unit", F.lit(buckets)))
    return bucketed.select("bucket", *names).groupBy("bucket").applyInArrow(compare, _PAIRS).where("a < b").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, needed: int) -> DataFrame:
    """The pairs (a, b) that are links, by whole sets (rep, shingles)."""
    of = lambda x: sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"of_{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b")

    def check(batches):
        for batch in slices(batches):
            arrays = (batch.column(c) for c in ("of_a", "of_b"))
            found = pa.array([linked_sets(x.values.to_numpy(), y.values.to_numpy(), needed) for x, y in zip(*arrays)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(found) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(check, "a long, b long").distinct()


def tile_links(left: list[int], right: list[int], sets: list[np.ndarray], component: np.ndarray, needed: int) -> list[tuple[int, int]]:
    """Links between rows ``left`` and ``right``, or within them if these are the same, as many as join their components."""
    _, at = np.unique(component, return_inverse=True)
    right, sizes = np.asarray(right), np.array([len(s) for s in sets])
    bits = 2 * bitmap_bits(int(sizes.max()))
    maps = np.stack([bitmap(s.view(np.uint64), min(bits, WIDEST)) for s in sets])
    same, of_right, out = np.array_equal(left, right), maps[right], []
    for i in left:
        near = (at[right] != at[i]) & (100 * np.minimum(sizes[right], sizes[i]) >= needed * np.maximum(sizes[right], sizes[i]))
        if same:
            near &= right > i
        look = np.nonzero(near)[0]
        differ = np.bitwise_count(maps[i] ^ of_right[look]).sum(axis=1, dtype=np.int64)
        for j in right[look[can_link(differ, sizes[i], sizes[right[look]], needed)]].tolist():
            if at[i] != at[j] and linked_sets(sets[i], sets[j], needed):
                out.append((i, j))
                at[at == at[j]] = at[i]
    return out


def crowd_links(crowds: DataFrame, sets: DataFrame, links: DataFrame, needed: int) -> DataFrame:
    """(a, b): links within crowds (node, crowd), as many as join components beside ``links`` (a, b)."""
    rows, tiles = placed(crowds.select(F.col("crowd").alias("team"), F.col("node").alias("rep")).join(sets, "rep").withColumn("n", F.size("shingles").cast("long")), needed)
    rows, tiles = write_table(rows, "crowd-rows"), write_table(tiles, "crowd-tiles")

    def compare(table: pa.Table) -> pa.Table:
        own, rep, component = (table.column(c).to_numpy() for c in ("own", "rep", "component"))
        lists = table.column("shingles").combine_chunks()
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        held = [values[s:e] for s, e in zip(ends[:-1], ends[1:])]
        first, second = np.nonzero(own)[0].tolist(), np.nonzero(~own)[0].tolist()
        found = tile_links(first, second or first, held, component, needed) if first else []
        i, j = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table([pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j]))], names=["a", "b"])

    def compared(dealt: DataFrame) -> DataFrame:
        return write_table(dealt.select("unit", "own", "rep", "component", "shingles").groupBy("unit").applyInArrow(compare, "a long, b long"), "crowd-links")

    def with_component(rows: DataFrame, known: DataFrame) -> DataFrame:
        return rows.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    within = compared(inside(with_component(rows, components(links))))
    # of a crowd that is one component by now nothing is left to compare, nor where there is no other tile
    known = components(links.union(within))
    held = with_component(rows.select("rep", "team", "band", "block"), known).groupBy("team")
    several = held.agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count_distinct("band", "block").alias("tiles")).where("low <> high and tiles > 1").select("team")
    several = write_table(several, "open-crowds")
    if several.isEmpty():
        return within
    left = with_component(rows.join(several, "team", "left_semi"), known)
    return within.union(compared(across(left, tiles.join(several, "team", "left_semi")))).distinct()


def joined_components(docs: DataFrame, members: DataFrame, same: DataFrame, width: int, needed: int) -> DataFrame:
    """node, component over all links between documents (doc_id, n_shingles, set_key, first, bitmap), and those of ``same`` (a, b)."""
    found = write_table(met(members, needed), "met")
    # rows may repeat an id, with the same text or with another
    known = members.dropDuplicates(["doc_id", "set_key"]).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bitmap")
    edges = found.where("kind = 'edge'")
    ends = edges.groupBy("shingle").agg(F.min("a").alias("b")).join(edges.select("shingle", "a"), "shingle").select("a", "b")  # a few rows a range
    teams = components(found.where("kind = 'tie'").select("a", "b").union(ends)).withColumnRenamed("component", "team")
    alone = within_bounds(agreeing(found), known, needed)
    pairs = write_table(alone.withColumn("crowded", F.lit(False)).union(team_pairs(teams, known, needed)), "bounded")
    few, many = pairs.where("not crowded").select("a", "b").distinct(), pairs.where("crowded").select("a", "b")
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, ids, members.select(F.col("doc_id").alias("rep"), "set_key"), width)
    links = same.union(write_table(confirmed(few, sets, needed), "links"))
    if many.isEmpty():
        return components(links)
    return components(links.union(crowd_links(components(many).withColumnRenamed("component", "crowd"), sets, links, needed)))


def jaccard_join(docs: DataFrame, width: int = WIDTH, needed: int = NEEDED) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every document.

    Links join sets with 100 * intersection >= ``needed`` * union. A null text or one without words has the
    empty set and is linked with nothing; fewer words than ``width`` are one shingle. A row with a null id
    can't be named by others: it is linked with nothing and its component is null. Rows that repeat an id
    count as one document for links and come out each. Texts are taken whole, however long, a task holding
    a batch of them or a tile's sets. Ties (equal sets) are joined by their sets' keys, so copies cost their
    rows once. An empty table gives an empty result; further columns are ignored. Ids are integers.
    """
    docs = columns_of(docs, "doc_id", "text")
    docs = spread(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    sets = write_table(signed(docs, width, needed, common_shingles(docs, width)), "signed")
    members = sets.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = write_table(members.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    # a document is tied to the least one of its class; where classes have one document each there is nothing to write
    same = write_table(members.select("doc_id", "set_key").join(classes, "set_key").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "same")
    found = joined_components(docs, members, same, width, needed).withColumnRenamed("node", "doc_id")
    joined = sets.select("doc_id", "n_shingles", "set_key").join(found, "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "doc_id")).alias("component_id"))
