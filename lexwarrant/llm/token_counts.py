"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

In a merge vocabulary the encoding of a prefix has one last token, and what stands before it is the
encoding of the shorter prefix. So each prefix needs its last token only: the piece that ends there
and is *compatible* with the last token before it, meaning that the two side by side encode to
themselves. Counts follow as count(prefix) = count(prefix without its last token) + 1. Truncation and
budget questions are then answered by looking up, without encoding again.

Merges can't cross a place where no piece of the vocabulary has those two characters in a row, so a
text is cut there into units, and the prefix table of a unit is kept for its next occurrence.
"""

from __future__ import annotations

import functools
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .arrow import columns_of, slices, spread, texts, type_of
from .vocabularies import PIECE_BPE, Cache, vocab_path

LIMIT = 4096
_BAR = "▁"


class PrefixCounts:
    """Prefix token counts under a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.score[model.id_to_piece(i)] = model.get_score(i)
        self.longest = max(map(len, self.score))
        self._unit = self._units_pattern()
        self._agrees = Cache(self._compatible)
        self._tables = Cache(self._table, limit=1_600_000)  # counted with the two beside it
        self._totals = Cache(lambda unit: self._tables[unit][-1])

    def _units_pattern(self) -> re.Pattern:
        """The finest cut into units that merges of this vocabulary can't cross."""
        pairs = {(a, b) for piece in self.score for a, b in zip(piece, piece[1:])}
        if any(b == _BAR != a for a, b in pairs):
            return re.compile(r"(?s).+")
        letters = {c for piece in self.score for c in piece if c.isalpha()}
        if any(a != _BAR and (a in letters) != (b in letters) for a, b in pairs):
            return re.compile(rf"{_BAR}*[^{_BAR}]+|{_BAR}+")
        inside = "".join(map(re.escape, sorted(letters)))
        return re.compile(rf"{_BAR}*[{inside}]+|{_BAR}*[^{_BAR}{inside}]+|{_BAR}+")

    def _merge(self, text: str) -> list[str]:
        """The encoding of a short string by its merges, best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, pair: tuple[str, str]) -> bool:
        before, piece = pair
        return self._merge(before + piece) == ([before, piece] if before else [piece])

    def _table(self, unit: str) -> tuple[int, ...]:
        """Counts at the ends of all prefixes of a unit; place k has the first k characters."""
        score, agrees, longest = self.score, self._agrees, self.longest
        counts, last = [0], [""]
        for end in range(1, len(unit) + 1):
            for start in range(max(0, end - longest), end):
                piece = unit[start:end]
                if piece in score and agrees[last[start], piece]:
                    counts.append(counts[start] + 1)
                    last.append(piece)
                    break
            else:  # a character outside the vocabulary: one token for each of its bytes
                counts.append(counts[-1] + len(unit[end - 1].encode("utf-8", "surrogatepass")))
                last.append("")
        return tuple(counts)

    def units(self, text: str) -> list[str]:
        return self._unit.findall(_BAR + text.replace(" ", _BAR)) if text else []

    def count(self, text: str) -> int:
        return sum(map(self._totals.__getitem__, self.units(text)))

    def at_every_prefix(self, text: str) -> list[int]:
        """Place k: the tokens of the first k characters. len(text) + 1 numbers."""
        out, before = [], 0
        for unit in self.units(text):
            table = self._tables[unit]
            out += [before + n for n in table[1:]]
            before += table[-1]
        if not out:
            return [0]
        out[0] = 0  # the empty prefix has no leading bar either
        return out

    def longest_within(self, text: str, budget: int) -> tuple[int, int]:
        """(tokens of the text, characters of its longest prefix that has at most ``budget`` tokens)."""
        units = self.units(text)
        ends = list(accumulate(map(self._totals.__getitem__, units)))
        if not ends or ends[-1] <= budget:
            return (ends[-1] if ends else 0), len(text)
        from bisect import bisect_right

        k = bisect_right(ends, budget)  # unit k is the last that starts within the budget
        table, before = self._tables[units[k]], ends[k - 1] if k else 0
        inside = max(i for i, n in enumerate(table) if before + n <= budget)
        return ends[-1], max(0, sum(map(len, units[:k])) + inside - 1)

    def trim(self) -> None:
        self._tables.trim(beside=(self._totals, self._agrees))


@functools.lru_cache(maxsize=2)
def prefix_counts(vocab_dir: str | None = None) -> PrefixCounts:
    return PrefixCounts(vocab_path(PIECE_BPE, vocab_dir))


def count_tokens(docs: DataFrame, limit: int = LIMIT, vocab_dir: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fitting_chars of every text.

    fitting_chars is the length of the longest prefix with at most ``limit`` tokens. A null text is
    an empty one with no tokens; null, repeated and tied ids are rows of their own; an empty table
    gives an empty result; further columns are ignored. Narrow: no shuffle, any text length.
    """
    schema = T.StructType([
        T.StructField("doc_id", type_of(docs, "doc_id")),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
        T.StructField("fitting_chars", T.LongType()),
    ])

    def count(batches):
        counts = prefix_counts(vocab_dir)
        for batch in slices(batches):
            rows = texts(batch)
            found = [counts.longest_within(text, limit) for text in rows]
            counts.trim()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x.encode()) for x in rows], pa.int64()),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([n > limit for n, _ in found], pa.bool_()),
                    pa.array([k for _, k in found], pa.int64()),
                ],
                names=schema.names,
            )

    return spread(columns_of(docs, "doc_id", "text")).mapInArrow(count, schema)


def prefix_tables(docs: DataFrame, vocab_dir: str | None = None) -> DataFrame:
    """doc_id and ``counts``: the tokens of every prefix of its text, from 0 to all characters."""
    schema = T.StructType([T.StructField("doc_id", type_of(docs, "doc_id")), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def tables(batches):
        counts = prefix_counts(vocab_dir)
        for batch in slices(batches, 32):
            found = [counts.at_every_prefix(text) for text in texts(batch)]
            counts.trim()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=schema.names)

    return columns_of(docs, "doc_id", "text").mapInArrow(tables, schema)
