"""Whitening of embeddings along their leading components, found by LOBPCG over the cluster.

Vectors become whole numbers, of which sums and deviations are exact. Components are eigenvectors of the
covariance. Each round takes an orthonormal basis of the blocks of iterates, residuals and last directions,
has the covariance's product with it summed over centred rows where these lie, and does Rayleigh-Ritz with
the small matrices that come back (dimensions by block columns, however many rows there are). Rounds go on
until the residuals of the wanted components, by a product with these components themselves, are as small
as double precision lets them be.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import write_table
from .arrow import columns_of, spread, type_of

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Further columns that are iterated, so that the last wanted component is well apart from what isn't.
GUARD = 8
#: Residuals below this part of the largest eigenvalue are what rounding leaves.
TOLERANCE = 2e-14
#: Where residuals no longer fall, they must at least be below this part.
CERTIFIED = 1e-10
ROUNDS = 500
#: Rounds without a better residual after which rounding is all that's left.
PATIENCE = 4
#: Eigenvalues below this part of the largest are no directions of the data, and can't be whitened.
FLAT = 1e-12
#: Entries beyond this aren't whole numbers in double precision.
_EXACT = float(1 << 53)
ROWS = 2048


@dataclass(frozen=True)
class Fit:
    """n, sums by dimension, the trace, and eigenvalues, unit eigenvectors (columns) and residuals."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    identity_error: float
    rounds: int


def whole_vectors(rows: DataFrame, name: str = "embedding") -> DataFrame:
    """vec_id, x (array of long) of the rows whose vector is fit for it.

    Left out are null vectors, those with null, non-finite or unboundedly large entries (2**53 and more after
    scaling), and empty ones.
    """
    c = F.col("v").cast("array<double>")
    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(c, lambda e: F.coalesce(F.abs(e * F.lit(float(SCALE))) < F.lit(_EXACT), F.lit(False)))  # no NaN is below
    x = F.transform(c, lambda e: F.floor(e * F.lit(float(SCALE))) + F.lit(OFFSET).cast("long"))
    held = columns_of(rows, "vec_id", name).select("vec_id", F.col(name).alias("v"))
    return held.where(good).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten()  # heeds where a slice begins
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _blocks(batches, column: int, dimensions: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, _matrix(part.column(column), dimensions)


def _sums(x: DataFrame, dimensions: int) -> tuple[int, np.ndarray]:
    """(rows, exact sums by dimension): one row a task and dimension is shuffled."""

    def add(batches):
        n, sums = 0, np.zeros(dimensions, np.int64)
        for _, block in _blocks(batches, 0, dimensions):
            n, sums = n + len(block), sums + block.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions)), pa.array(np.full(dimensions, n)), pa.array(sums)], names=["i", "n", "s"])

    found = sorted(tuple(r) for r in x.select("x").mapInArrow(add, "i long, n long, s long").groupBy("i").agg(F.sum("n"), F.sum("s")).collect())  # a row a dimension
    return (found[0][1], np.array([s for _, _, s in found])) if found else (0, np.zeros(dimensions, np.int64))


def _product(x: DataFrame, n: int, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The covariance times ``block``: rows are centred, multiplied and summed in their tasks; a row a task and dimension is shuffled."""
    dimensions, width = block.shape

    def multiply(batches):
        total = np.zeros((dimensions, width))
        for _, rows in _blocks(batches, 0, dimensions):
            centred = rows - mean
            total += centred.T @ (centred @ block)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(dimensions + 1, dtype=np.int32) * width), pa.array(total.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions)), lists], names=["i", "v"])

    def join(table: pa.Table) -> pa.Table:
        parts = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return pa.table([table.column("i").slice(0, 1), pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))], names=["i", "v"])

    schema, out = "i long, v array<double>", np.zeros((dimensions, width))
    for i, v in x.select("x").mapInArrow(multiply, schema).groupBy("i").applyInArrow(join, schema).collect():  # dimensions by columns
        out[i] = v
    return out / n


def _trace(x: DataFrame, n: int, mean: np.ndarray) -> float:
    dimensions = len(mean)

    def add(batches):
        total = 0.0
        for _, rows in _blocks(batches, 0, dimensions):
            total += float(np.square(rows - mean).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["t"])

    return x.select("x").mapInArrow(add, "t double").agg(F.sum("t")).first()[0] / n


def _basis(blocks: list[np.ndarray]) -> np.ndarray:
    """Orthonormal columns that span the blocks; what earlier columns span already is dropped."""
    held = np.zeros((len(blocks[0]), 0))
    for block in blocks:
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        for _ in range(2):  # the second time for what rounding left
            block = block - held @ (held.T @ block)
        size, turn = np.linalg.svd(block, full_matrices=False)[:2][::-1]
        new = turn[:, size > 1e-10]
        for _ in range(2):
            new = np.linalg.qr(new - held @ (held.T @ new))[0]
        held = np.concatenate([held, new], axis=1)[:, : len(held)]
    return held


def lobpcg(product, dimensions: int, wanted: int, guard: int = GUARD, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(values, vectors, the matrix times vectors, residuals, rounds) of a positive matrix known by ``product`` alone.

    Raises if residuals neither reach ``tolerance`` nor stop falling below ``CERTIFIED``, both as parts of
    the largest eigenvalue.
    """
    width = min(dimensions, wanted + guard)
    iterate = _basis([np.random.default_rng(12).standard_normal((dimensions, width))])
    residual = direction = np.zeros((dimensions, 0))
    best, since = None, 0
    for turn in range(1, rounds + 1):
        basis = _basis([iterate, residual, direction])
        times = product(basis)
        small = basis.T @ times
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1][:width], mix[:, ::-1][:, :width]
        # products are made anew for each basis, so nothing of earlier rounding is carried on
        new, image = basis @ mix, times @ mix
        residual = image - new * values
        aside = mix.copy()
        aside[: iterate.shape[1]] = 0
        iterate, direction = new, basis @ aside
        largest = max(float(values[0]), np.finfo(float).tiny)
        left = np.linalg.norm(residual[:, :wanted], axis=0) / largest
        worst = float(left.max())
        since = 0 if best is None or worst < 0.5 * best[0] else since + 1
        if best is None or worst < best[0]:
            best = (worst, values[:wanted], new[:, :wanted], image[:, :wanted], left)
        if worst <= tolerance or (since >= PATIENCE and best[0] <= CERTIFIED) or basis.shape[1] == dimensions and turn > 1:
            break
    if best[0] > CERTIFIED:
        raise ArithmeticError(f"residuals of {best[0]:.1e} after {turn} rounds")
    return *best[1:], turn


def fit(x: DataFrame, dimensions: int, components: int = COMPONENTS) -> Fit | None:
    """Leading components of the vectors ``x``; None without rows or if all are equal."""
    n, sums = _sums(x, dimensions)
    if not n:
        return None
    mean = sums / n
    trace = _trace(x, n, mean)
    if trace <= 0:
        return None
    wanted = min(components, dimensions)
    values, vectors, _, _, rounds = lobpcg(lambda block: _product(x, n, mean, block), dimensions, wanted)
    # certified by a product with the components themselves
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    image = _product(x, n, mean, vectors)
    values = np.einsum("ij,ij->j", vectors, image)
    steep = values > FLAT * values[0]
    vectors, image, values = vectors[:, steep], image[:, steep], values[steep]
    residuals = np.linalg.norm(image - vectors * values, axis=0) / values[0]
    if residuals.max() > CERTIFIED:
        raise ArithmeticError(f"residuals of {residuals.max():.1e} after {rounds} rounds")
    scaled = vectors / np.sqrt(values)
    off = scaled.T @ (image / np.sqrt(values)) - np.eye(len(values))
    return Fit(n, sums, trace, values, vectors, residuals, float(np.abs(off).max()), rounds)


def _deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sums over dimensions of (n * x - S) ** 2; by Python's numbers where 64 bits might not hold them."""
    far = float(np.abs(rows).max(initial=0)) * n + float(np.abs(sums).max())
    if far < 2.0**62:
        d = rows * n - sums
        if float(np.square(d.astype(float)).sum(axis=1).max(initial=0)) < 2.0**62:
            return np.square(d).sum(axis=1).tolist()
    exact = ((rows.astype(object) * n - sums.astype(object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(rows: DataFrame, components: int = COMPONENTS, name: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, residual: a row per vector and component.

    Rows without a usable vector are left out: null ones, empty ones, and those with null, non-finite or
    entries of 2**47 and more. Where lengths differ, the most frequent counts (of equally frequent ones
    the longest), and rows of others are left out. Repeated rows and rows of a null or repeated id count and come
    out each. Components that the vectors don't spread along (by ``FLAT`` of the largest eigenvalue) are left
    out, so equal vectors, or a single one, give no row, as does an empty table. Of equal eigenvalues the
    components are any orthonormal ones, the same for all rows. A deviation beyond 64 bits is null. Further
    columns are ignored. Long vectors cost a block of ``ROWS`` rows in memory, and on the driver their
    length times three blocks.
    """
    spark, id_type = rows.sparkSession, type_of(rows, "vec_id").simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    x = write_table(spread(whole_vectors(rows, name)), "vectors")
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dimensions = lengths[0]["d"]
    x = x.where(F.size("x") == dimensions)
    found = fit(x, dimensions, components)
    if found is None:
        return spark.createDataFrame([], schema)
    n, sums, mean, k = found.n, found.sums, found.sums / found.n, len(found.values)
    scaled, explained = found.vectors / np.sqrt(found.values), found.values / found.trace

    def project(batches):
        for part, block in _blocks(batches, 1, dimensions):
            r = len(block)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(r), k)))
            columns = [np.tile(np.arange(1, k + 1, dtype=np.int32), r), np.full(r * k, n), [v for v in _deviations(block, n, sums) for _ in range(k)], ((block - mean) @ scaled).reshape(-1), np.tile(explained, r), np.full(r * k, found.identity_error), np.tile(found.residuals, r)]
            kinds = (pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 4)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return x.mapInArrow(project, schema)
