"""Shingle sets of chosen documents, and trees of pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ..storage import write_table
from .arrow import columns_of, slices, texts
from .shingles import shingle_set


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) of ``n`` rows that a search in breadth takes: they connect what all of them do."""
    near = np.zeros((n, n), bool)
    near[i, j] = near[j, i] = True
    new, out = np.ones(n, bool), []
    for root in range(n):
        if not new[root]:
            continue
        new[root], queue = False, [root]
        for at in queue:
            found = np.nonzero(near[at] & new)[0]
            new[found] = False
            out.append(np.stack([np.full(len(found), at), found]))
            queue.extend(found.tolist())
    return tuple(np.concatenate(out, axis=1))


def texts_of(docs: DataFrame, ids: DataFrame, classes: DataFrame) -> DataFrame:
    """rep, set_key and text of the representatives in ``ids`` (rep)."""
    wanted = classes.select("rep", "set_key").join(ids, "rep", "left_semi")
    return columns_of(docs, "doc_id", "text").withColumnRenamed("doc_id", "rep").join(wanted, "rep")


def sets_of(docs: DataFrame, ids: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """rep and shingles of the representatives in ``ids`` (rep), as a table."""

    def build(batches):
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in texts(batch)]
            held = [set_key(s) == key for s, key in zip(sets, batch.column("set_key").to_pylist())]  # another row may carry the same id
            yield pa.RecordBatch.from_arrays([batch.column("rep").filter(pa.array(held)), pa.array([s.view(np.int64) for s, h in zip(sets, held) if h], pa.list_(pa.int64()))], names=["rep", "shingles"])

    return write_table(texts_of(docs, ids, classes).mapInArrow(build, "rep long, shingles array<long>").dropDuplicates(["rep", "shingles"]), "sets")
