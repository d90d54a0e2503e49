"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, at every place, the sum of code point times base to the power of its
position, modulo a prime. Any span's hash is a difference of two entries, so equality of any two spans
takes one comparison and the longest common extension of two places a binary search. Two primes give
62 bits. The array of an edited text is put together from the arrays of its two parts.

A fingerprint is the text's length and whole hash, and the ``SKETCH`` smallest mixed hashes among all
its spans of ``SPAN`` code points. Two fingerprints share a part of these; that part estimates the
Jaccard likeness J of the span sets, and the likeness given is 2J / (1 + J), the shared share of one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import write_table
from .arrow import columns_of, slices, texts, type_of

PRIMES = (np.uint64((1 << 31) - 1), np.uint64((1 << 31) - 19))
BASES = (1_000_003, 1_618_033)
SPAN = 16
SKETCH = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of a base and of its inverse modulo a prime, grown as longer texts come."""

    def __init__(self, base: int, prime: np.uint64):
        self.prime = prime
        self._tables = {name: np.array([1], np.uint64) for name in ("up", "down")}
        self._steps = {"up": base, "down": pow(base, -1, int(prime))}

    def get(self, name: str, n: int) -> np.ndarray:
        table = self._tables[name]
        while len(table) < n:
            step = np.uint64(pow(self._steps[name], len(table), int(self.prime)))
            table = self._tables[name] = np.concatenate([table, table * step % self.prime])
        return table[:n]


_POWERS = tuple(Powers(b, p) for b, p in zip(BASES, PRIMES))


class PrefixHashes:
    """Prefix arrays of a text of code points; entry k covers the first k of them."""

    __slots__ = ("sums",)

    def __init__(self, sums: tuple[np.ndarray, ...]):
        self.sums = sums

    @classmethod
    def of(cls, text: str) -> PrefixHashes:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        sums = []
        for powers in _POWERS:
            terms = codes * powers.get("up", len(codes)) % powers.prime
            # terms stay below 2**31, so a sum of 2**33 of them still fits
            sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]) % powers.prime)
        return cls(tuple(sums))

    def __len__(self) -> int:
        return len(self.sums[0]) - 1

    def joined(self, keep: int, other: PrefixHashes, take: int) -> PrefixHashes:
        """Arrays of the first ``keep`` code points followed by the first ``take`` of ``other``."""
        out = []
        for powers, own, more in zip(_POWERS, self.sums, other.sums):
            shift = powers.get("up", keep + 1)[keep]
            out.append(np.concatenate([own[: keep + 1], (own[keep] + shift * more[1 : take + 1]) % powers.prime]))
        return PrefixHashes(tuple(out))

    def spans(self, starts: np.ndarray | slice, ends: np.ndarray | slice, shift: np.ndarray | slice) -> np.ndarray:
        """62-bit hashes of spans; equal spans have equal ones wherever they stand."""
        halves = []
        for powers, sums in zip(_POWERS, self.sums):
            down = powers.get("down", len(sums))
            halves.append((sums[ends] + powers.prime - sums[starts]) % powers.prime * down[shift] % powers.prime)
        return (halves[0] << np.uint64(31)) | halves[1]

    def span(self, start: int, end: int) -> int:
        at = np.array([start])
        return int(self.spans(at, np.array([end]), at)[0])

    def common_extension(self, at: int, other: PrefixHashes, there: int) -> int:
        """How far the text from ``at`` agrees with the other from ``there``."""
        low, high = 0, min(len(self) - at, len(other) - there)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(at, at + mid) == other.span(there, there + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def sketch(self) -> np.ndarray:
        """The smallest distinct mixed hashes of all spans; a shorter text is one span itself."""
        n = len(self)
        if not n:
            return np.zeros(0, np.uint64)
        width = min(SPAN, n)
        hashes = self.spans(slice(0, n - width + 1), slice(width, n + 1), slice(0, n - width + 1))
        hashes = hashes * _MIX
        hashes ^= hashes >> np.uint64(29)
        hashes = hashes * _MIX >> np.uint64(24)
        if len(hashes) > 16 * SKETCH:
            least = np.unique(np.partition(hashes, 4 * SKETCH)[: 4 * SKETCH])
            if len(least) >= SKETCH:
                return least[:SKETCH]
        return np.unique(hashes)[:SKETCH]

    def fingerprint(self, sketch: np.ndarray) -> str:
        return f"{len(self):x}.{self.span(0, len(self)):016x}." + "".join(f"{x:010x}" for x in sketch.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two texts as their sketches show it; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:SKETCH]
    j = np.isin(np.intersect1d(a, b, assume_unique=True), least, assume_unique=True).sum() / len(least)
    return float(2 * j / (1 + j))


_OPEN = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("side", T.IntegerType()), T.StructField("text", T.StringType())])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Edited: the last floor(n / 2) code points replaced by the first as many, or all, of the next
    document's, in descending order of doc_id, the first document following the last. Rows with equal
    ids are ordered by text; null ids come last; ids may be of any type that has an order. A null text
    is an empty one; an empty table gives an empty result; a single document follows itself; further
    columns are ignored. common_next is the longest common prefix of the text and the next one.

    Texts are shuffled once, into ranges of ids. A range gives its first and last text along, and a
    second, small step joins the last row of each range with the first of the next: two rows a range.
    """
    fields = [
        T.StructField("doc_id", type_of(docs, "doc_id")),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("common_next", T.LongType()),
    ]
    schema = T.StructType([*fields, *_OPEN])
    arrow_types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]

    def one(doc_id, text, own, own_sketch, after, nxt, nxt_sketch):
        n = len(text)
        cut = n // 2
        take = min(cut, len(after))
        edited = own.joined(n - cut, nxt, take)
        edited_sketch = edited.sketch()
        return (
            doc_id, n, hashlib.sha256((text[: n - cut] + after[:take]).encode("utf-8", "surrogatepass")).hexdigest(),
            own.fingerprint(own_sketch), edited.fingerprint(edited_sketch),
            likeness(own_sketch, edited_sketch), likeness(own_sketch, nxt_sketch), own.common_extension(0, nxt, 0),
        )

    def measured(text):
        hashes = PrefixHashes.of(text)
        return text, hashes, hashes.sketch()

    def batch_of(rows, id_type):
        first, *rest = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(first, id_type), *(pa.array(c, t) for c, t in zip(rest, arrow_types))], names=schema.names)

    def of_range(batches) -> Iterator[pa.RecordBatch]:
        """Rows whose next is in the same range; then the first (side 0) and the last row (side 1) with their texts."""
        from pyspark import TaskContext

        part, held, id_type = TaskContext.get().partitionId(), None, None
        none = (None,) * 7
        for batch in slices(batches, 256):
            rows, id_type = [], batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                now = measured(text)
                rows.append((*one(*held, *now), None, None, None) if held else (doc_id, *none, part, 0, text))
                held = (doc_id, *now)
            if rows:
                yield batch_of(rows, id_type)
        if held:
            yield batch_of([(held[0], *none, part, 1, held[1])], id_type)

    def between(batches) -> Iterator[pa.RecordBatch]:
        """Last rows with the first row of the next range, in order; the last of all with the first of all."""
        begin = held = id_type = None
        for batch in slices(batches, 16):
            rows, id_type = [], batch.schema.field("doc_id").type
            for doc_id, side, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "side", "text"))):
                now = measured(text or "")
                if side:
                    held = (doc_id, *now)
                    continue
                begin = begin or now
                if held:
                    rows.append((*one(*held, *now), None, None, None))
            if rows:
                yield batch_of(rows, id_type)
        if held:
            yield batch_of([(*one(*held, *begin), None, None, None)], id_type)

    rows = columns_of(docs, "doc_id", "text")
    order = F.col("doc_id").desc_nulls_last()
    made = write_table(rows.repartitionByRange(order).sortWithinPartitions(order, F.col("text").asc_nulls_first()).mapInArrow(of_range, schema), "fingerprints")
    ends = made.where("part IS NOT NULL").coalesce(1).sortWithinPartitions("part", "side")
    names = [f.name for f in fields]
    return made.where("part IS NULL").select(*names).union(ends.mapInArrow(between, schema).select(*names))
