"""Best-fit packing of token sequences by swap-based local search.

Documents longer than a sequence are cut; every other piece stays whole. Pieces are dealt at random
into shards of bounded size. A shard is packed best fit first, longest piece first, and then improved
by local search: documents move between underfull bins, one for none, one for one or two for one,
whenever that raises the sum of squared fills, until the emptiest bin has no document left. What stays
underfull goes on to a next level, where the bins of many shards meet, until one shard holds them.

Cases: a null text is an empty one and still yields its end token; null or repeated ids are rows of
their own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import write_table
from .arrow import columns_of, slices, spread, texts, type_of
from .vocabularies import word_bpe

CAPACITY = 2048
END_ID = 0
#: Pieces a shard holds on average.
SHARD = 8192
#: A bin emptier than this share of its capacity is packed again with those of other shards.
OPEN_BELOW = 15 / 16


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: each piece, longest first, goes where it leaves the least room."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    mask = 0  # bit f is set while some bin has f free
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        room = mask >> n
        if room:
            free = n + (room & -room).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
            bins[b].append(i)
        else:
            b, free = len(bins), capacity
            bins.append([i])
        left = free - n
        by_free.setdefault(left, []).append(b)
        mask |= 1 << left
    return bins


class LocalSearch:
    """Empties bins of a packing by moves and swaps, each of which raises the sum of squared fills."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        #: Underfull bins that hold a piece of a length: length -> bin -> pieces.
        self.holders: dict[int, dict[int, list[int]]] = {}
        #: (free, bin) of the underfull bins that may take documents.
        self.rooms: list[tuple[int, int]] = []

    def free(self, b: int) -> int:
        return self.capacity - self.fill[b]

    def _show(self, b: int) -> None:
        if self.free(b) > 0:
            insort(self.rooms, (self.free(b), b))
            for i in self.bins[b]:
                self.holders.setdefault(self.lengths[i], {}).setdefault(b, []).append(i)

    def _hide(self, b: int) -> None:
        if self.free(b) > 0:
            self.rooms.remove((self.free(b), b))
            for i in self.bins[b]:
                own = self.holders[self.lengths[i]]
                own.pop(b, None)

    def _exchange(self, donor: int, out: list[int], b: int, back: list[int]) -> None:
        self._hide(b)
        for i in out:
            self.bins[donor].remove(i)
            self.bins[b].append(i)
        for i in back:
            self.bins[b].remove(i)
            self.bins[donor].append(i)
        gain = sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in back)
        self.fill[donor] -= gain
        self.fill[b] += gain
        self._show(b)

    def _best_swap(self, n: int, floor: int) -> tuple[int, int, int] | None:
        """(gain, bin, piece): the swap of length ``n`` from the donor that fills a bin most."""
        most = self.rooms[-1][0] if self.rooms else 0
        for gain in range(min(most, n - 1), 0, -1):
            for b, pieces in self.holders.get(n - gain, {}).items():
                if self.free(b) >= gain and self.fill[b] + gain > floor:
                    return gain, b, pieces[0]
        return None

    def _step(self, donor: int) -> bool:
        own = sorted(set(self.bins[donor]), key=self.lengths.__getitem__, reverse=True)
        for i in own:  # move one for none
            for free, b in self.rooms:
                if free >= self.lengths[i]:
                    self._exchange(donor, [i], b, [])
                    return True
        best = None
        seen: set[int] = set()
        for i in own:  # one for one
            n = self.lengths[i]
            if n not in seen:
                seen.add(n)
                if (found := self._best_swap(n, self.fill[donor])) and (best is None or found[0] > best[0]):
                    best = (found[0], [i], found[1], found[2])
        if best is None:
            for k, i in enumerate(own):  # two for one
                for j in own[k + 1 :]:
                    n = self.lengths[i] + self.lengths[j]
                    if n not in seen:
                        seen.add(n)
                        if (found := self._best_swap(n, self.fill[donor])) and (best is None or found[0] > best[0]):
                            best = (found[0], [i, j], found[1], found[2])
        if best is None:
            return False
        self._exchange(donor, best[1], best[2], [best[3]])
        return True

    def run(self) -> list[list[int]]:
        total, order = sum(self.fill), sorted(range(len(self.bins)), key=self.fill.__getitem__)
        for b in order:
            self._show(b)
        left = len(order)
        for donor in order:
            if left * self.capacity - total < self.capacity:
                break  # fewer bins could not hold the documents
            self._hide(donor)
            if sum(free for free, _ in self.rooms) < self.fill[donor]:
                break
            while self.bins[donor] and self._step(donor):
                pass
            if self.bins[donor]:
                self._show(donor)
            else:
                left -= 1
        return [b for b in self.bins if b]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices into ``lengths``, none longer than ``capacity``."""
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocab_dir: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a random ``lot`` for every piece of every text."""
    schema = T.StructType([
        T.StructField("doc_id", type_of(docs, "doc_id")),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("lot", T.LongType()),
    ])

    def cut(batches):
        vocabulary = word_bpe(vocab_dir)
        task, count, width = TaskContext.get().partitionId(), 0, 4 * capacity
        end = END_ID.to_bytes(4, "little")
        for batch in slices(batches):
            rows, piece, start, length, crc, lot = [], [], [], [], [], []
            for k, text in enumerate(texts(batch)):
                ids = memoryview(vocabulary.ids(text) + end)
                for p, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    lot.append(zlib.crc32(b"%d:%d" % (task, count)))
                    count += 1
            vocabulary.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, lot))],
                names=schema.names,
            )

    return spread(columns_of(docs, "doc_id", "text")).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``pieces`` (any columns with ``length`` and ``lot``) with sequence_id and offset.

    ``pieces`` should be a written table: it is read once to count and once to pack.
    """
    out = T.StructType([f for f in pieces.schema if f.name != "lot"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    level_schema = T.StructType([*out, T.StructField("lot", T.LongType()), T.StructField("open", T.BooleanType())])

    def one_shard(level: int, last: bool):
        def place(table: pa.Table) -> pa.Table:
            lengths = table.column("length").to_pylist()
            base = (level << 48) + (table.column("shard")[0].as_py() << 16)
            order, sequence, offset, is_open = [], [], [], []
            for b, members in enumerate(pack_lengths(lengths, capacity)):
                at = 0
                for i in members:
                    order.append(i)
                    sequence.append(base + b)
                    offset.append(at)
                    at += lengths[i]
                is_open += [not last and at < OPEN_BELOW * capacity] * len(members)
            placed = table.drop_columns(["shard"]).take(pa.array(order, pa.int64()))
            lot = [zlib.crc32(x.to_bytes(8, "little")) for x in placed.column("lot").to_pylist()]
            columns = {n: placed.column(n) for n in placed.column_names}
            columns |= {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64()), "lot": pa.array(lot, pa.int64()), "open": pa.array(is_open, pa.bool_())}
            return pa.table([columns[n] for n in level_schema.names], names=level_schema.names)

        return place

    done, rest, before, level = None, pieces, None, 0
    n = pieces.count()
    while True:
        shards = max(1, -(-n // shard))
        last = shards == 1 or (before is not None and n > 0.9 * before)
        placed = rest.withColumn("shard", F.col("lot") % shards).groupBy("shard").applyInArrow(one_shard(level, last), level_schema)
        if last:
            return (placed if done is None else done.unionByName(placed)).select(*out.names)
        placed = write_table(placed, "packed")
        closed = placed.where(~F.col("open"))
        done = closed if done is None else done.unionByName(closed)
        rest = placed.where("open").drop("sequence_id", "offset", "open")
        before, n, level = n, rest.count(), level + 1
        if not n:
            return done.select(*out.names)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocab_dir: str | None = None, shard: int = SHARD) -> DataFrame:
    """Token pieces of ``docs`` with the sequence and the place there of each."""
    return pack(write_table(token_pieces(docs, capacity, vocab_dir), "pieces"), capacity, shard)
