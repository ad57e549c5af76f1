"""Whitening of embedding vectors by the principal components of their covariance.

Entries become whole numbers, so counts, sums and sums of products are exact, whatever the order in
which partitions are added up:

1. every partition adds up its vectors; the driver gets one sum per dimension;
2. every partition multiplies its vectors, centred by the rounded mean, and the products are added
   up by cell of the covariance; the driver gets the upper triangle, ``d (d + 1) / 2`` numbers;
3. its float32 eigenvectors are corrected in extended precision by the iteration of Ogita and
   Aishima, which needs matrix products only; vectors of eigenvalues too close for it are turned by
   small problems of their own;
4. every vector is projected, and the covariance of the result is measured.

What the driver holds has the size of the covariance, never that of the table.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# The covariance and a few matrices of its size are held by the driver and by every task.
MOST_DIMENSIONS = 4096
# Numbers up to here are exact as doubles.
EXACT = 1 << 53
# The type of the corrections: 64 bits of mantissa where the machine has them, else those of a double.
WIDE = np.longdouble


def _whole(batch: pa.RecordBatch, d: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector is whole, and their entries as ``floor(1024 c)``, one row each."""
    column = batch.column("v")
    valid = np.asarray(column.is_valid())
    sizes = np.where(valid, np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL entries become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ends = np.cumsum(sizes)
    good = (bad[ends] == bad[ends - sizes]) & valid & (sizes > 0)
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.empty((0, d or 0), np.int64)
    if d is None:
        d = int(sizes[rows[0]])
    if (sizes[rows] != d).any():
        raise ValueError(f"vectors of {d} and of {int(sizes[rows][sizes[rows] != d][0])} entries in one table")
    values = values[np.repeat(good, sizes)].reshape(-1, d)
    scaled = np.floor(values * SCALE)
    if (np.abs(scaled) > EXACT).any():
        raise ValueError("an entry is too large for a whole number of 1024ths")
    return rows, scaled.astype(np.int64)


def _sum_batches(batches):
    n, sums = 0, None
    for batch in batches:
        _, z = _whole(batch, None if sums is None else len(sums))
        if len(z):
            n += len(z)
            # As Python's numbers where a batch could leave the range of a long.
            part = z.sum(axis=0, dtype=object) if np.abs(z).max() > 1 << 40 else z.sum(axis=0).astype(object)
            sums = part if sums is None else sums + part
    if n:
        cells = [*range(len(sums)), -1]
        values = [Decimal(int(s)) for s in sums] + [Decimal(n)]
        yield _cells(cells, values, len(sums))


def _cells(cells: list[int], values: list[Decimal], d: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int32()), pa.array([d] * len(cells), pa.int32()), pa.array(values, pa.decimal128(38, 0))],
        names=["cell", "d", "value"],
    )


_CELLS = "cell int, d int, value decimal(38,0)"


def _products(z: np.ndarray) -> np.ndarray:
    """``z' z`` exactly, as Python's whole numbers."""
    most = int(np.abs(z).max()) if z.size else 0
    if most * most * len(z) < EXACT:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if most < 1 << 25 and len(z) > 1:
        half = len(z) // 2
        return _products(z[:half]) + _products(z[half:])
    o = z.astype(object)
    return o.T @ o


def _product_batches(centre: np.ndarray):
    def run(batches):
        d, total = len(centre), None
        for batch in batches:
            _, z = _whole(batch, d)
            if len(z):
                part = _products(z - centre)
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(d)
            yield _cells((i * d + j).tolist(), [Decimal(int(v)) for v in total[i, j]], d)

    return run


@dataclass
class Moments:
    """Count, sums of ``floor(1024 c)`` per dimension, and the covariance with divisor ``n``."""

    n: int
    sums: list[int]
    covariance: np.ndarray


def _totals(cells: DataFrame) -> dict[int, int]:
    rows = cells.groupBy("cell").agg(F.sum("value").alias("value"), F.min("d").alias("a"), F.max("d").alias("b")).collect()
    for r in rows:
        if r["a"] != r["b"]:
            raise ValueError(f"vectors of {r['a']} and of {r['b']} entries in one table")
    return {r["cell"]: int(r["value"]) for r in rows}


def moments(vectors: DataFrame) -> Moments:
    """Of the whole vectors in column ``v``; an empty table has no dimensions."""
    totals = _totals(vectors.select("v").mapInArrow(_sum_batches, _CELLS))
    n = totals.pop(-1, 0)
    d = len(totals)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"{d} dimensions, {MOST_DIMENSIONS} at most")
    sums = [totals[i] for i in range(d)]
    covariance = np.zeros((d, d), WIDE)
    if n:
        centre = [(2 * s + n) // (2 * n) for s in sums]
        rest = [s - n * c for s, c in zip(sums, centre)]
        products = _totals(vectors.select("v").mapInArrow(_product_batches(np.array(centre, np.int64)), _CELLS))
        with localcontext() as context:
            context.prec = 60
            square = Decimal(n) * n
            for cell, value in products.items():
                i, j = divmod(cell, d)
                exact = Decimal(n * value - rest[i] * rest[j]) / square
                covariance[i, j] = covariance[j, i] = WIDE(str(exact))
    return Moments(n, sums, covariance)


def _clusters(values: np.ndarray, gap: WIDE) -> list[np.ndarray]:
    """Places of eigenvalues, in falling order, that chains of gaps below ``gap`` hold together."""
    order = np.argsort(-values, kind="stable")
    parts = np.split(order, np.flatnonzero(-np.diff(values[order]) > gap) + 1)
    return [p for p in parts if len(p) > 1]


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the symmetric ``a``, in falling order, from approximate vectors ``x``.

    One step of the iteration takes ``R = I - X'X`` and ``S = X'AX``; eigenvalues are
    ``s_ii / (1 - r_ii)``, and ``X (I + E)`` the next vectors, with ``e_ij = (s_ij + l_j r_ij) / (l_j - l_i)``.
    Errors are squared by a step, but for pairs of eigenvalues closer than the errors themselves:
    these only become orthogonal (``e_ij = r_ij / 2``).  Such a cluster is then turned by the vectors
    of its own small problem, shifted and scaled so that its eigenvalues are apart again, and solved
    and corrected in the same way.  Also returned is the largest correction of each step.
    """
    a, x = a.astype(WIDE), x.astype(WIDE)
    one, scale = np.eye(len(a), dtype=WIDE), np.abs(a).max() if a.size else WIDE(0)
    steps, tiny = [], np.finfo(WIDE).eps * len(a)
    values = np.zeros(len(a), WIDE)
    if scale == 0:
        return values, one, np.array(steps)
    a = a / scale
    for step in range(rounds):
        r, s = one - x.T @ x, x.T @ a @ x
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        gap = 2 * (np.sqrt((off**2).sum()) + np.sqrt((r**2).sum()))
        apart = values[None, :] - values[:, None]
        close = np.abs(apart) <= gap
        # In two parts, so that rounding errors over a small distance turn vectors but keep their angles.
        turned = (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(close, 1, apart)
        e = r / 2 + np.where(close, 0, turned)
        x = x + x @ e
        steps.append(float(np.abs(e).max()))
        if steps[-1] <= 4 * tiny:
            break
        for places in _clusters(values, gap) if step < rounds - 4 else ():  # the last steps only correct
            part = x[:, places]
            shifted = part.T @ (a @ part - values[places].mean() * part)
            size = np.abs(shifted).max()
            if size > 4 * tiny:  # else equal as far as can be told: any basis will do
                shifted = (shifted + shifted.T) / (2 * size)
                x[:, places] = part @ refine(shifted, np.linalg.eigh(shifted.astype(np.float32))[1])[1]
    x = x + x @ (one - x.T @ x) / 2  # what rounding over the smallest distances left
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order], np.array(steps)


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and their unit vectors as columns, to double precision."""
    if not len(covariance):
        return np.zeros(0), np.zeros((0, 0))
    size = np.abs(covariance).max()
    _, x = np.linalg.eigh((covariance / (size if size else 1)).astype(np.float32))
    values, x, _ = refine(covariance, x)
    x = x / np.sqrt((x**2).sum(axis=0))
    return values.astype(np.float64), x.astype(np.float64)


_PROJECTED = "vec_id long, deviation decimal(38,0), w array<double>"


def _project_batches(n: int, sums: list[int], axes: np.ndarray):
    total = np.array(sums, object)

    def run(batches):
        d = len(sums)
        mean = np.array([s / n for s in sums])
        for batch in batches:
            rows, z = _whole(batch, d)
            most = int(np.abs(z).max()) if z.size else 0
            limit = n * most + max(abs(s) for s in sums)
            if d * limit * limit < 1 << 63:
                off = z * n - total.astype(np.int64)
                deviation = [Decimal(v) for v in (off * off).sum(axis=1).tolist()]
            else:
                deviation = [Decimal(int(((row * n - total) ** 2).sum())) for row in z.astype(object)]
            w = (z - mean) @ axes if len(z) else np.zeros((0, axes.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(deviation, pa.decimal128(38, 0)),
                    pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "w"],
            )

    return run


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, np.ndarray, Moments]:
    """``vec_id, n, deviation, w``, the share of each component in all variance, and the moments.

    ``w`` has the whitened coordinates of the first ``components`` components, or of all dimensions
    if there are fewer.  Rows whose vector is NULL or empty or holds NULL or non-finite entries are
    dropped; NULL ids stay and repeated rows count and come as often as they do.  A component without
    variance has the coordinate 0.  Vectors of different lengths are an error, as are entries
    beyond 2**53 / 1024.  An empty table, or one without whole vectors, gives no rows.
    """
    vectors = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("v"))
    found = moments(vectors)
    values, axes = eigen(found.covariance)
    k = min(components, len(values))
    trace = float(np.trace(found.covariance))
    shares = values[:k] / trace if trace > 0 else np.zeros(k)
    seen = values[:k] > len(values) * np.finfo(np.float64).eps * max(trace, 0.0)
    used = np.where(seen, axes[:, :k] / np.sqrt(np.where(seen, values[:k], 1.0)), 0.0)
    if not found.n:
        empty = table.sparkSession.createDataFrame([], _PROJECTED)
        return empty.withColumn("n", F.lit(0).cast("long")), shares, found
    projected = stored(vectors.mapInArrow(_project_batches(found.n, found.sums, used), _PROJECTED), "whitened")
    return projected.withColumn("n", F.lit(found.n).cast("long")), shares, found


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of ``w`` minus the identity; None without rows."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    if not pairs:
        return None
    # The built-in keeps means while it adds up, so that products are of centred values.
    cells = [F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    row = whitened.agg(*cells).first()
    errors = [abs(v - (i == j)) for v, (i, j) in zip(row, pairs) if v is not None]
    return max(errors) if errors else None


def report(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is an exact long; one beyond its range is an error, not another number.
    Everything else is as in ``whiten``.
    """
    whitened, shares, _ = whiten(table, vector, components)
    error = identity_error(whitened, len(shares))
    share = F.array(*[F.lit(float(s)) for s in shares]).cast("array<double>")
    rows = whitened.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), F.posexplode("w").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
