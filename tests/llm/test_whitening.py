"""Whitening against a dense eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import plans, whitening

SF = "/root/testdata/sf0.001"


def valid(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def lattice(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def expected(rows, top=16):
    """``n``, exact deviations by row, covariance and its eigenvalues by falling size, sums."""
    rows = [(i, lattice(v)) for i, v in rows]
    distinct = sorted({v for _, v in rows})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    deviation = [(i, sum((n * x - s) ** 2 for x, s in zip(v, sums))) for i, v in rows]
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in distinct])
    covariance = centred.T @ centred / n
    return n, deviation, covariance, (np.linalg.svd(centred, compute_uv=False) ** 2 / n)[:top], sums


def check(got, rows, top=None):
    n, deviation, covariance, values, sums = expected(rows)
    top = len(values) if top is None else top
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == sorted((i, d if d < 1 << 63 else None) for i, d in deviation)
    assert {r.n for r in got} == {n} and len(got) == top * len(rows)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, top + 1))
    mean = np.array([s / n for s in sums])
    x = {i: np.array(lattice(v)) - mean for i, v in rows}
    for component, own in by.items():
        explained = own[0].explained
        assert explained == pytest.approx(values[component - 1] / np.trace(covariance), rel=1e-6)
        # The whitened column is the projection on an eigenvector of that eigenvalue.
        own = sorted(own, key=lambda r: r.vec_id)
        z = np.array([r.whitened for r in own]) * math.sqrt(values[component - 1])
        axis, *_ = np.linalg.lstsq(np.array([x[r.vec_id] for r in own]), z, rcond=None)
        assert np.allclose(np.array([x[r.vec_id] for r in own]) @ axis, z, rtol=1e-6, atol=1e-6)
    assert max(r.identity_error for r in got) <= 1e-9


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = plans.op11_whitening(spark, SF).collect()
    check(got, valid(rows))
    n, _, covariance, values, sums = expected(valid(rows))
    _, axes = np.linalg.eigh(covariance)
    axes = axes[:, ::-1][:, :16]
    mean = np.array([s / n for s in sums])
    x = {i: np.array(lattice(v)) - mean for i, v in valid(rows)}
    for r in got:
        want = x[r.vec_id] @ axes[:, r.component - 1] / math.sqrt(values[r.component - 1])
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-6)


@pytest.mark.parametrize("width", [3, 20])
def test_ill_conditioned(spark, width):
    """Spreads of six powers of ten, copies, a constant dimension and one that is the sum of others."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, width)) * np.logspace(0, 6, width)
    x[:, 0] = 5
    x[:, -1] = np.floor(64 * x[:, 1:-1]).sum(axis=1) / 64
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, x[7].tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whitened(df).collect()
    check(got, rows, min(16, width - 2))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (None, [3.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [0.5, 1.0])]
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], "vec_id long, embedding array<float>, x string, n string")
    got = whitening.whitened(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i, c) for i in (1, 2, 2, 0, 10) for c in (1, 2))
    assert {r.n for r in got} == {3}
    points = [lattice(v) for v in ([0.5, 1.0], [0.25, -1.0], [3.0, 0.0])]
    sums = [sum(c) for c in zip(*points)]
    assert {r.deviation for r in got} == {sum((3 * x - s) ** 2 for x, s in zip(p, sums)) for p in points}
    assert got[0].identity_error < 1e-9
    for few in (df.limit(0), df.where("vec_id = 2"), df.where("vec_id = 4")):
        assert whitening.whitened(few).count() == 0
    assert {r.component for r in whitening.whitened(df.where("vec_id in (1, 2)")).collect()} == {1}
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert all(r.deviation is None and math.isfinite(r.whitened) for r in whitening.whitened(huge).where(F.col("vec_id") < 3).collect())
