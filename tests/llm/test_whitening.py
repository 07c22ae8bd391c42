from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm.eigen import symmetric_eigen
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, w string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "?", "?", "?") for i, v in rows], SCHEMA)


def brute(vectors):
    """Exact n and sums, float64 covariance of the centred whole numbers."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, q = np.linalg.eigh(y.T @ y / n)
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x - s]
    return n, deviation, values[::-1], q[:, ::-1], y


def check(rows, vectors, k=8):
    n, deviation, values, q, y = brute(vectors)
    k = min(k, len(values))
    got = np.array([[r["whitened"] for r in rows[i * k:(i + 1) * k]] for i in range(len(vectors))])
    want = y @ q[:, :k] / np.sqrt(values[:k])
    want = want * np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < 1e-9
    assert {r["n"] for r in rows} == {n}
    assert [r["deviation"] for r in rows[::k]] == deviation
    assert [r["component"] for r in rows] == list(range(1, k + 1)) * len(vectors)
    assert np.allclose([r["explained"] for r in rows[:k]], values[:k] / values.sum(), rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def in_order(df):
    return df.orderBy("vec_id", "component").collect()


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(7)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(3, 0.4, 12)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [None] + [0.0] * 11), (902, [float("nan")] * 12),
           (903, [float("inf")] + [1.0] * 11), (904, []), (905, [1.0, 2.0])]
    got = in_order(whiten(frame(spark, rows + odd).repartition(5)))
    check(got, vectors)
    again = in_order(whiten(frame(spark, rows).repartition(2)))  # same whatever the tasks
    assert [r["whitened"] for r in again] == [r["whitened"] for r in got]


def test_repeated_rows_null_ids_few_dimensions(spark):
    vectors = [[1.0, 0.0, 2.0], [1.0, 0.0, 2.0], [0.5, 3.0, -1.0], [-2.0, 0.25, 0.125], [4.0, 1.0, 1.0]]
    rows = in_order(whiten(frame(spark, [(1, vectors[0]), (1, vectors[1]), (2, vectors[2]),
                                         (3, vectors[3]), (4, vectors[4])])))
    assert len(rows) == 15
    by_id = {}
    for r in rows:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert len(by_id[1]) == 6
    none = whiten(frame(spark, [(None, vectors[0]), (2, vectors[2])])).where("vec_id is null").collect()
    assert sorted(r["component"] for r in none) == [1, 2, 3]


def test_without_variance_and_empty(spark):
    rows = in_order(whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])))
    assert [r["whitened"] for r in rows] == [pytest.approx(rows[0]["whitened"]), None,
                                             pytest.approx(-rows[0]["whitened"]), None]
    assert [r["explained"] for r in rows[:2]] == [1.0, 0.0]
    same = in_order(whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])))
    assert all(r["whitened"] is None and r["explained"] == 0.0 and r["deviation"] == 0 for r in same)
    for nothing in ([], [(1, None)], [(1, [])]):
        out = whiten(frame(spark, nothing))
        assert out.collect() == [] and out.columns[0] == "vec_id"
    with pytest.raises(ValueError):
        whiten(frame(spark, [(1, [1e30, 2.0]), (2, [0.0, 1.0])]))


def test_query_on_the_whole_table(spark):
    rows = in_order(QUERIES["op11_whitening"](spark, "/root/testdata/sf0.01"))
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    check(rows, [r["embedding"] for r in given])


def exact_matrix(values, seed=3):
    """A symmetric matrix with these eigenvalues and known vectors (Householder)."""
    d = len(values)
    u = [Fraction(int(v)) for v in np.random.default_rng(seed).integers(1, 9, d)]
    norm = sum(v * v for v in u)
    q = [[Fraction(int(i == j)) - 2 * u[i] * u[j] / norm for j in range(d)] for i in range(d)]
    a = [[sum(q[i][k] * values[k] * q[j][k] for k in range(d)) for j in range(d)] for i in range(d)]
    exact = np.vectorize(lambda f: np.longdouble(f.numerator) / np.longdouble(f.denominator))
    return exact(np.array(a, dtype=object)), exact(np.array(q, dtype=object))


@pytest.mark.parametrize("gap", [Fraction(1, 10), Fraction(1, 10**6), Fraction(1, 10**9)])
def test_clustered_eigenvalues_are_told_apart(gap):
    values = [Fraction(5), Fraction(3) + 2 * gap, Fraction(3) + gap, Fraction(3), Fraction(1), Fraction(1, 7)]
    a, q = exact_matrix(values)
    found, x = symmetric_eigen(a)
    assert np.abs(found - np.array([np.longdouble(v.numerator) / np.longdouble(v.denominator)
                                    for v in values])).max() < 1e-17
    error = np.minimum(np.abs(x - q).max(axis=0), np.abs(x + q).max(axis=0)).max()
    assert error < 1e-17 / float(gap) * 10  # float32 alone: all of 1 for the smallest gap
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-17


def test_equal_eigenvalues_give_an_orthonormal_basis():
    a, _ = exact_matrix([Fraction(v) for v in (4, 2, 2, 2, 0, 0)])
    found, x = symmetric_eigen(a)
    assert np.abs(a @ x - x * found).max() < 1e-16
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-17
    assert len(symmetric_eigen(np.zeros((0, 0)))[0]) == 0
    assert symmetric_eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
