"""Whitening of embeddings by shifted Cholesky QR.

Vectors are rounded to whole numbers, so that counts and sums are exact. Over the distinct vectors (the fit list), centred:

1. A pass over the rows gives the Gram matrix of ``X``. Its Cholesky factor, shifted where the matrix is too close to
   singular, is the first triangular factor ``R1``.
2. The next pass solves each row against the factors so far, ``Q = X R1^-1 R2^-1 ...``, and gives the Gram matrix of ``Q``.
   That repeats until ``Q`` is orthonormal; the factors compose to ``R = ... R2 R1``.
3. The singular values of ``R`` are those of ``X``: their squares over the number of rows are the eigenvalues of the
   covariance, its right singular vectors the components.

A pass ends in one row per dimension and task, added up in a shuffle by dimension; the driver holds matrices of
dimension x dimension, never rows. Rows are told apart by their whole vector, copies are combined before the shuffle.

Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are rows that don't have the
most common length (of equally common ones the greatest). Entries beyond 2^55 count as 2^55. Dimensions of one value
and directions without spread (under ``RANK`` of the greatest) are no components: a table of n distinct vectors
has at most n - 1, one distinct vector or none gives no rows. A ``deviation`` beyond a long is null. Null and
repeated ids are kept; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import settled, small_batches

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
_FURTHEST = float(1 << 55)
#: Passes over the rows at most; three are enough for a table of full rank.
PASSES = 6
#: Largest entry of the Gram matrix minus the identity at which the rows count as orthonormal.
ORTHONORMAL = 1e-11
#: Singular values under this part of the greatest are rounding errors.
RANK = 1e-12
_LIMB = 32


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors of sums ``sums``; ``components`` in rows, eigenvalues ``spread``, ``trace`` of the covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    spread: np.ndarray
    trace: float
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)


def lattice(vectors: DataFrame, vector: str = "embedding", *keep: Column) -> DataFrame:
    """``keep`` and ``x``, the vector as whole numbers, of the rows that count."""
    cell = F.col(vector)
    whole = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(_FURTHEST)), F.lit(-_FURTHEST))) + OFFSET
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    rows = vectors.where(cell.isNotNull() & (F.size(cell) > 0) & F.forall(cell, finite))
    common = rows.groupBy(F.size(cell).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size(cell) == (common["size"] if common else 0)).select(*keep, F.transform(cell, whole).alias("x"))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The vectors of a batch as rows."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _totals(distinct: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension, in two limbs."""

    def run(batches):
        n, sums = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n += len(x)
                sums = sums + np.stack([(x >> _LIMB).sum(axis=0), (x & ((1 << _LIMB) - 1)).sum(axis=0)], axis=1)
        if n:
            dims = np.arange(len(sums), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims), pa.array(np.full(len(dims), n)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["dim", "n", "high", "low"]
            )

    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    parts = distinct.mapInArrow(run, "dim int, n long, high long, low long")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), exact("high"), exact("low")).orderBy("dim").collect()
    return (rows[0].n if rows else 0), [(int(r.high) << _LIMB) + int(r.low) for r in rows]


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x`` minus the mean, rounded once: whole part and remainder of the mean apart."""
    mean, rest = sums // n, sums % n
    return (x - mean.astype(np.int64)).astype(float) - rest.astype(float) / n


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of a triangular factor, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _gram(distinct: DataFrame, n: int, sums: list[int], alive: np.ndarray, factors: list[np.ndarray], last: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after the triangular solves (and a projection on ``last``)."""
    whole = np.array(sums, dtype=object)

    def partial(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _centred(_matrix(batch), n, whole)[:, alive]
            for upper in factors:
                rows = solved(rows, upper)
            rows = rows if last is None else rows @ last
            total = rows.T @ rows + (0 if total is None else total)
        yield from _as_rows(total)

    def add(batches):
        sums_: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for i, row in zip(batch.column("i").to_pylist(), _matrix(batch, "row")):
                    sums_[i] = row + sums_.get(i, 0)
        for i, row in sums_.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row.tolist()], pa.list_(pa.float64()))], names=["i", "row"])

    schema = "i int, row array<double>"
    rows = distinct.mapInArrow(partial, schema).repartition("i").mapInArrow(add, schema).collect()
    width = len(alive) if last is None else last.shape[1]
    out = np.zeros((width, width))
    for r in rows:
        out[r.i] = r.row
    return (out + out.T) / 2


def _as_rows(matrix: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if matrix is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(matrix), dtype=np.int32)), pa.array(matrix.tolist(), pa.list_(pa.float64()))], names=["i", "row"]
        )


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper Cholesky factor; shifted by the bound of the rounding errors where the matrix isn't safely positive."""
    d = len(gram)
    values = np.linalg.eigvalsh(gram)
    # Rows are added in blocks, so errors grow with the root of their number.
    shift = 11 * (np.sqrt(n) * d + d * (d + 1)) * np.finfo(float).eps * values[-1]
    safe = values[0] > 100 * shift
    while True:
        try:
            return np.linalg.cholesky(gram if safe else gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            safe, shift = False, 10 * shift


def _composed(factors: list[np.ndarray]) -> np.ndarray:
    out = factors[0]
    for upper in factors[1:]:
        out = upper @ out
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of a table of distinct vectors ``x`` (whole numbers, one length)."""
    n, sums = _totals(distinct)
    none = Whitening(n, tuple(sums), np.zeros((0, len(sums))), np.zeros(0), 0.0, 0.0)
    if n < 2:
        return none
    every = np.arange(len(sums))
    gram = _gram(distinct, n, sums, every, [])
    trace = float(np.trace(gram)) / n
    alive = np.flatnonzero(np.diag(gram) > 0)
    if not len(alive):
        return none
    gram = gram[np.ix_(alive, alive)]
    factors: list[np.ndarray] = []
    while len(factors) < PASSES:
        factors.append(_factor(gram, n))
        gram = _gram(distinct, n, sums, alive, factors)
        if np.abs(gram - np.eye(len(alive))).max() <= ORTHONORMAL:
            break
    _, singular, right = np.linalg.svd(_composed(factors))
    held = int((singular > RANK * singular[0]).sum())
    top = min(components, held)
    axes = np.zeros((top, len(sums)))
    axes[:, alive] = right[:top]
    axes *= np.where(axes[np.arange(top), np.abs(axes).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    spread = singular[:top] ** 2 / n
    white = _gram(distinct, n, sums, every, [], (axes / np.sqrt(spread)[:, None]).T) / n
    return Whitening(n, tuple(sums), axes, spread, trace, float(np.abs(white - np.eye(top)).max()))


_NEW = "component integer, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, whole: np.ndarray) -> pa.Array:
    """Exact sums of ``(n * x - S) ** 2``; null where they leave a long."""
    mean, rest = (whole // n).astype(np.int64), (whole % n).astype(np.int64)
    off = x - mean
    most = (int(np.abs(off).max(initial=0)) + 1) * n
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return pa.array((((off * n) - rest) ** 2).sum(axis=1), pa.int64())
    exact = ((off.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1).tolist()
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """Every row of ``rows`` once per component, without ``x`` and with the columns of the whitening."""
    keep = [c for c in rows.columns if c != "x"]
    schema = rows.select(*keep).schema
    for name, kind in (f.split() for f in _NEW.split(", ")):
        schema = schema.add(name, kind)
    top, whole = len(model.spread), np.array(model.sums, dtype=object)
    axes = (model.components / np.sqrt(model.spread)[:, None]).T if top else None

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not top:
                continue
            x = _matrix(batch)
            white = _centred(x, model.n, whole) @ axes
            owner = pa.array(np.repeat(np.arange(len(x)), top))
            size = len(x) * top
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(owner) for c in keep),
                    pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, model.n)),
                    _deviations(x, model.n, whole).take(owner),
                    pa.array(white.ravel()),
                    pa.array(np.tile(model.spread / model.trace, len(x))),
                    pa.array(np.full(size, model.identity_error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def whitened(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``key`` and the whitened components of every valid row, fitted on the distinct vectors of the table."""
    small_batches(vectors.sparkSession)
    rows = settled(lattice(vectors, vector, F.col(key).alias("_key")), "lattice")
    distinct = settled(rows.select("x").distinct(), "vectors")
    return apply(rows, fit(distinct, components)).withColumnRenamed("_key", key)
