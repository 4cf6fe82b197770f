import numpy as np
import pytest

from fieldprep.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, x string, place int"


def _brute(vectors, count):
    """Deviation, eigenvalues, absolute projections and trace from the full covariance."""
    x = np.floor(256 * np.asarray(vectors, np.float64))
    fit = np.unique(x, axis=0)
    mean, n = fit.sum(axis=0) / len(fit), len(fit)
    values, turn = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, turn = values[::-1][:count], turn[:, ::-1][:, :count]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, fit.sum(axis=0), strict=True)) for row in x]
    return n, deviation, values, np.abs((x - mean) @ turn / np.sqrt(values)), np.trace((fit - mean).T @ (fit - mean)) / n


def _found(df):
    rows = df.collect()
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    return by


def test_equals_the_full_eigendecomposition(spark):
    draws = np.random.default_rng(3)
    vectors = (draws.standard_normal((300, 12)) * np.linspace(3, 0.5, 12)).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:40]])
    df = spark.createDataFrame([(i, v.tolist(), 1, i, "a", 0) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    n, deviation, values, projected, trace = _brute(vectors, 4)
    found = _found(whitening.whiten(df))
    assert len(found) == len(vectors) and n == 300
    for i in range(len(vectors)):
        assert [found[i][k].deviation for k in (1, 2, 3, 4)] == [deviation[i]] * 4
        assert np.allclose([abs(found[i][k].whitened) for k in (1, 2, 3, 4)], projected[i], rtol=1e-9, atol=1e-10)
        assert np.allclose([found[i][k].explained for k in (1, 2, 3, 4)], values / trace, rtol=1e-12)
        assert found[i][1].n == n and found[i][1].identity_error < 1e-12


def test_the_signs_are_the_same_for_all_rows_and_components_uncorrelated(spark):
    draws = np.random.default_rng(4)
    vectors = draws.standard_normal((200, 6)) @ draws.standard_normal((6, 6))
    df = spark.createDataFrame([(i, v.tolist(), 1, i, "a", 0) for i, v in enumerate(vectors)], SCHEMA)
    found = _found(whitening.whiten(df))
    z = np.array([[found[i][k].whitened for k in (1, 2, 3, 4)] for i in range(200)])
    assert np.abs(z.T @ z / 200 - np.eye(4)).max() < 1e-10 and np.abs(z.mean(axis=0)).max() < 1e-10


def test_unusable_rows_are_left_out_and_short_ones_padded(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [3.0]), (7, [0.5, -1.0]), (None, [1.0, 2.0]), (7, [2.0, 2.0]), (8, [])]
    df = spark.createDataFrame([(i, v, None, 0, None, None) for i, v in rows], SCHEMA)
    got = whitening.whiten(df).collect()
    n, deviation, values, projected, trace = _brute([[1, 2], [3, 0], [0.5, -1], [1, 2], [2, 2], [0, 0]], 2)
    assert sorted((r.vec_id is None, r.vec_id) for r in got if r.component == 1) == [(False, 1), (False, 6), (False, 7), (False, 7), (False, 8), (True, None)]
    assert {r.component for r in got} == {1, 2}
    assert {r.n for r in got} == {n} == {5}
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[], []]])
def test_tables_without_variance_give_no_rows(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, 1, None, None) for i, v in enumerate(vectors)], SCHEMA)
    assert whitening.whiten(df).collect() == []


def test_directions_without_variance_are_no_components(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 1, 1, None, None) for i in range(20)], SCHEMA)
    got = whitening.whiten(df).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_deviation_beyond_64_bits_is_null():
    x = np.array([[2**31, 0], [0, 0]])
    assert whitening._deviation(x, 2, x.sum(axis=0)) == [2**62, 2**62]
    big = np.array([[2**40, 0], [0, 0]])
    assert whitening._deviation(big, 2, big.sum(axis=0)) == [None, None]


@pytest.mark.parametrize(
    "spectrum",
    [np.linspace(1, 2, 150), 1 / np.arange(1, 201), np.r_[[5, 5, 5, 4.999], np.ones(60)], np.array([3, 2, 1.0]), np.r_[np.ones(80), np.linspace(1.0001, 1.0002, 80)]],
)
def test_close_equal_and_few_eigenvalues(spectrum):
    turn = np.linalg.qr(np.random.default_rng(7).standard_normal((len(spectrum), len(spectrum))))[0]
    matrix = turn * spectrum @ turn.T
    values, vectors = whitening.leading_pairs(lambda block: matrix @ block, len(spectrum), 4)
    assert np.allclose(values, np.sort(spectrum)[::-1][:4], rtol=1e-13)
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() <= 1e-13 * values[0]


def test_minres_solves_indefinite_systems():
    draws = np.random.default_rng(5)
    matrix = draws.standard_normal((30, 30))
    matrix = matrix + matrix.T
    right = draws.standard_normal((30, 3))
    x = whitening._minres(lambda block: matrix @ block, right, 60, 1e-12)
    assert np.allclose(matrix @ x, right, atol=1e-7)
