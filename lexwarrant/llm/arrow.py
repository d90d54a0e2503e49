"""Arrow helpers shared by the operators whose work is done in Python."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` cut down to the named columns, whatever else it carries, names that differ in case only included."""
    if len({c.lower() for c in docs.columns}) < len(docs.columns):
        docs = docs.toDF(*[c if c in names else f"_other_{i}" for i, c in enumerate(docs.columns)])
    return docs.select(*names)


def told_apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns renamed that differ from ``names`` or from each other in case only, and the
    names to give back with ``toDF`` at the end."""
    taken, out = {n.lower() for n in names}, []
    for i, c in enumerate(docs.columns):
        if c not in names and c.lower() in taken:
            c = f"_other_{i}"
        taken.add(c.lower())
        out.append(c)
    return docs.toDF(*out), docs.columns


def spread(docs: DataFrame) -> DataFrame:
    """``docs`` in at least as many partitions as there are cores; a table of many splits stays as it is.

    A small file is one split, which one core alone would work through.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() * 2 <= cores else docs


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def type_of(docs: DataFrame, name: str) -> T.DataType:
    return docs.schema[name].dataType


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python strings; a null text counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough that long texts don't pile up as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
