"""Whitening against whole-table arithmetic in fractions and against matrices of known eigenvalues."""

from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, w string, component string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "n", "w", "c", 1) for i, v in rows], SCHEMA)


def plain(rows):
    """Exact n, sums and covariance of the whole vectors, and the whole vectors."""
    whole = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in whole], object)
    n, sums = len(x), x.sum(axis=0)
    off = x * n - sums
    cov = off.T @ off
    covariance = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in cov])
    return whole, x, n, sums, covariance, (off * off).sum(axis=1)


def test_query_agrees_with_exact_arithmetic(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    whole, x, n, sums, covariance, deviation = plain(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    df = queries.QUERIES["op12_whitening"](spark, sf_dir)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = df.collect()
    assert len(got) == 8 * len(whole) and {r["n"] for r in got} == {n}
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-8
    centred = (x - sums / n).astype(float)
    for k in range(8):
        want = centred @ vectors[:, k] / np.sqrt(values[k])
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in whole])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
        assert all(abs(by[i, k + 1]["explained"] - values[k] / values.sum()) < 1e-10 for i, _ in whole)
    assert all(by[i, 1]["deviation"] == d for (i, _), d in zip(whole, deviation))


def residuals(a, values, x):
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    size = np.abs(a).max()
    return float(np.abs(a @ x - x * values).max() / size), float(np.abs(x.T @ x - np.eye(len(a))).max())


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 2, 1],
        [5, 5, 5, 1, 1, 0],
        [4, 4 - 1e-6, 4 - 2e-6, 4 - 1e-9, 2, 1e-3],
        [1, 1 - 1e-7, 1 - 2e-7, 1 - 1e-12, 1 - 2e-12, 1e-8],
        [3, 0, 0, 0, 0, 0],
        [0, 0, 0, 0, 0, 0],
    ],
)
def test_vectors_of_clustered_eigenvalues(values):
    draw = np.random.default_rng(4)
    q, _ = np.linalg.qr(draw.normal(size=(6, 6)))
    q = q.astype(np.longdouble)
    for _ in range(4):  # orthogonal beyond double precision
        q = q + q @ (np.eye(6) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    size = max(float(np.abs(a).max()), 1e-300)
    _, start = np.linalg.eigh((a / size).astype(np.float32))
    got, x, steps = whitening.refine(a, start)
    assert np.abs(got - np.array(sorted(values, reverse=True))).max() < 1e-17 * 64
    bad, skew = residuals(a, got, x)
    assert (bad < 1e-16 or size == 1e-300) and skew < 1e-16
    assert len(steps) <= 12


def test_precision_beyond_float32_on_a_large_matrix():
    draw = np.random.default_rng(5)
    b = draw.normal(size=(400, 80)) * np.linspace(1, 3, 80)
    b[:, 40:] = b[:, :40] + draw.normal(size=(400, 40)) * 1e-5  # forty eigenvalues next to zero
    a = b.T @ b
    values, x = whitening.eigen(a.astype(np.longdouble))
    bad, skew = residuals(a, values, x)
    assert bad < 1e-14 and skew < 1e-14
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-9, atol=1e-11 * values[0])


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]),
        (1, [1.0, 2.0]),
        (2, [3.0, -1.0]),
        (None, [0.5, 0.25]),
        (3, None),
        (4, []),
        (5, [1.0, None]),
        (6, [nan, 1.0]),
        (7, [1.0, -inf]),
        (8, [1000.0, 4000.0]),
    ]
    got = whitening.report(table(spark, rows)).collect()
    _, _, n, _, covariance, deviation = plain(rows)
    assert n == 5 and len(got) == 10 and {r["n"] for r in got} == {5}
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation)
    assert sorted({str(r["vec_id"]) for r in got}) == ["1", "2", "8", "None"]
    assert abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1e-12
    assert got[0]["identity_error"] < 1e-6
    assert whitening.report(table(spark, [])).count() == 0
    assert whitening.report(table(spark, [(1, None), (2, [nan])])).count() == 0


def test_no_variance(spark):
    one = whitening.report(table(spark, [(1, [1.0, 2.0, 3.0])])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(k, 0, 0.0, 0.0) for k in (1, 2, 3)]
    line = whitening.report(table(spark, [(i, [float(i), 2.0 * i]) for i in range(50)])).collect()
    assert {r["whitened"] for r in line if r["component"] == 2} == {0.0}


def test_refused_tables(spark):
    for rows in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, [3e38, 0.0]), (2, [1.0, 2.0])]):
        with pytest.raises(Exception, match="entries|too large"):
            whitening.report(table(spark, rows)).count()


def test_products_are_exact():
    draw = np.random.default_rng(6)
    for most in (1000, 1 << 24, 1 << 40):
        z = draw.integers(-most, most, size=(70, 5))
        o = z.astype(object)
        assert (whitening._products(z) == o.T @ o).all()
