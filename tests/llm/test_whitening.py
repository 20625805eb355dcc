"""Shifted CholeskyQR against the eigenvectors of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest

from bikeflow.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def expected(vectors):
    """Integers, exact deviations, and eigenpairs of the covariance, centred exactly before multiplying."""
    x = [[int(np.floor(c * 64)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    exact = [[n * a - s for a, s in zip(row, sums)] for row in x]
    centred = np.array([[float(Fraction(a, n)) for a in row] for row in exact])
    # Of the rows themselves: the eigenvalues of their covariance would be rounded to a share of the largest.
    _, sizes, axes = np.linalg.svd(centred, full_matrices=False)
    return centred, [sum(a * a for a in row) for row in exact], sizes**2 / n, axes.T


def hold(found, ids, vectors, components=32, loose=1e-7):
    centred, deviations, values, axes = expected(vectors)
    k = min(components, int((values > values[0] * 1e-24).sum()))
    rows = {}
    for r in found:
        rows.setdefault(r.component, []).append(r)
    assert sorted(rows) == list(range(1, k + 1))
    for c, got in rows.items():
        assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted((i is None, i or 0) for i in ids)
        want = centred @ axes[:, c - 1] / np.sqrt(values[c - 1])
        by_place = sorted(zip(ids, deviations, want), key=lambda t: (t[0] is None, t[0] or 0, t[1]))
        got = sorted(got, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation))
        assert [r.deviation for r in got] == [t[1] for t in by_place]
        mine, theirs = np.array([r.whitened for r in got]), np.array([t[2] for t in by_place])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < loose * max(1, np.abs(theirs).max())
        assert all(abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-6 for r in got)
        assert {r.n for r in got} == {len(vectors)} and len({r.identity_error for r in got}) == 1
        assert got[0].identity_error < 1e-9


def test_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = whitening.op11_embedding_whitening(spark, SF)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    hold(found.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


@pytest.mark.parametrize("near", [3.0, 300.0, 30_000.0])
def test_nearly_dependent_dimensions(spark, near):
    """Two dimensions that differ by single steps only, beside wide ones."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 6)) * [near, near / 3, 1, 0.3, near / 9, 1]
    x[:, 5] = x[:, 0] + rng.integers(0, 2, 400) / 64
    vectors = [[float(c) for c in v] for v in x]
    data = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(7)
    hold(whitening.whitened(data).collect(), list(range(400)), vectors, loose=1e-4 if near > 1000 else 1e-6)


def test_directions_without_variance_are_left_out(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (300, 7)) / 64
    x[:, 3] = 0.5
    x[:, 6] = x[:, 0] + x[:, 1]
    vectors = [[float(c) for c in v] for v in x]
    found = whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(5), components=6).collect()
    hold(found, list(range(300)), vectors, components=5, loose=1e-6)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(60, 4))]
    ids = [None, 5, 5, *range(57)]
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0], [1e300, 0.0, 0.0, 0.0]]
    data = spark.createDataFrame([*zip(ids, vectors), *((9, b) for b in bad)], SCHEMA)
    for clash in ("key", "vector", "n", "component", "part"):
        data = data.withColumn(clash, data.vec_id)
    hold(whitening.whitened(data).collect(), ids, vectors)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
    assert found.columns[0] == "vec_id" and found.collect() == []


def test_exact_sums_of_squares():
    rng = np.random.default_rng(4)
    for most in (10, 2**31, 2**51, 2**61):
        values = rng.integers(-most, most, (20, 5))
        assert [int(v) for v in whitening.squares(values).to_pylist()] == [sum(int(a) ** 2 for a in row) for row in values]


def test_solves_against_the_factor():
    rng = np.random.default_rng(5)
    factor = np.triu(rng.normal(size=(9, 9))) + 4 * np.eye(9)
    rows = rng.normal(size=(30, 9))
    assert np.allclose(whitening.solved(rows, factor) @ factor, rows)
