"""Fill-in-middle: documents cut in three at unit boundaries and put together in another order.

A text's units are runs of ASCII letters and single other characters. Where units and characters begin is
kept in bit vectors, one bit a byte, packed into 64-bit words with a directory of the ones before each
block of words. The total gives the number of units; select finds the byte at which a unit begins, so two
selects cut the text; rank over the characters' vector turns byte cuts into character counts. Texts are
worked on as the bytes they arrive in and never become lists of units.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .arrow import columns_of, spread

# The marks before the parts of a text. None can begin within another or across a text's
# end and a mark, so the first of each kind in an output is the mark itself.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of 100 documents this many are cut at all, and of 100 cut ones this many begin with their suffix.
RATE, SPM_RATE = 90, 20
#: 64-bit words of a block of the directory.
BLOCK = 8
_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123]] = True
_FIRST = np.ones(256, bool)
_FIRST[0x80:0xC0] = False  # what goes on with a character begun before
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


class BitVector:
    """Packed bits with the number of ones before each block; ``total`` is the number of all."""

    __slots__ = ("before", "length", "total", "words")

    def __init__(self, bits: np.ndarray):
        self.length = len(bits)
        packed = np.packbits(bits, bitorder="little")
        held = np.zeros(-(-max(len(packed), 1) // (8 * BLOCK)) * 8 * BLOCK, np.uint8)
        held[: len(packed)] = packed
        self.words = held.view("<u8")
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bitwise_count(self.words).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))])
        self.total = int(self.before[-1])

    def rank(self, at: int) -> int:
        """Ones before place ``at``."""
        word, bit = divmod(min(at, self.length), 64)
        block = word // BLOCK
        ones = int(self.before[block]) + int(np.bitwise_count(self.words[block * BLOCK : word]).sum(dtype=np.int64))
        return ones + ((int(self.words[word]) & ((1 << bit) - 1)).bit_count() if bit else 0)

    def select(self, k: int) -> int:
        """The place of the one with ``k`` ones before it; the length, if there are no more than ``k``."""
        if k >= self.total:
            return self.length
        block = int(np.searchsorted(self.before, k, "right")) - 1
        left = k - int(self.before[block])
        word = block * BLOCK
        while left >= (ones := int(self.words[word]).bit_count()):
            left, word = left - ones, word + 1
        held = int(self.words[word])
        for _ in range(left):
            held &= held - 1  # drops the lowest one
        return word * 64 + (held & -held).bit_length() - 1


def boundaries(text: bytes) -> tuple[BitVector, BitVector]:
    """(units, characters): a one at each byte where one begins."""
    raw = np.frombuffer(text, np.uint8)
    letter, first = _LETTER[raw], _FIRST[raw]
    begins = first.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return BitVector(begins), BitVector(first)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers by the document's id alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def arrange(text: bytes, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, int | None, int | None, bytes]:
    """(units, form, byte where the middle begins, where it ends, characters before it, in it, output)."""
    units, characters = boundaries(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in _MARKS) or h3 % 100 >= rate:
        return units.total, "plain", None, None, None, None, text
    low, high = sorted((h1 % (units.total + 1), h2 % (units.total + 1)))
    a, b = units.select(low), units.select(high)
    before = characters.rank(a)
    p, s, m = _MARKS
    if h4 % 100 < spm_rate:
        form, parts = "spm", (s, text[b:], p, text[:a], m, text[a:b])
    else:
        form, parts = "psm", (p, text[:a], s, text[b:], m, text[a:b])
    return units.total, form, a, b, before, characters.rank(b) - before, b"".join(parts)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form, middle_from, middle_to (bytes), prefix_chars, middle_chars, output, per row.

    Every row gives one row, whatever its id repeats, and the same row always gives the same. A null text
    is an empty one; empty texts, texts that hold a mark and those that the draw leaves out are ``plain``:
    their output is the text and their cuts are null. A null id draws as an empty id. Both cuts may fall on
    one place or on an end of the text, so parts may be empty. Texts are cut whole, however long: a text
    costs two bits a byte beside itself. Batches are taken row by row, so memory holds one text's vectors.
    An empty table gives an empty result; further columns are ignored.
    """
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("middle_from", T.LongType()), T.StructField("middle_to", T.LongType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType()),
    ])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column("doc_id")
                rows = [arrange(t or b"", i, seed, rate, spm_rate) for t, i in zip(part.column("text").to_pylist(), ids.to_pylist())]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=schema.names)

    found = spread(columns_of(docs, "doc_id", "text")).withColumn("text", F.col("text").cast("binary")).mapInArrow(cut, schema)
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone."""
    part = F.split(output, "<[PSM]>")
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))


def digests(docs: DataFrame) -> DataFrame:
    """What ``fill_in_middle`` gives for ``docs``, with the texts and those rebuilt from them as SHA-256."""
    found = fill_in_middle(docs)
    # made once a row: the text is split for its parts and digested, not carried on
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
