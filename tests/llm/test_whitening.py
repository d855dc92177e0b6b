"""Whitening: exact polynomial, roots and components against plain versions."""

from fractions import Fraction

import numpy as np
import pytest

from livetables.llm import whitening
from livetables.llm.queries import QUERIES
from tests.conftest import SF001


def _polynomial(matrix):
    """Coefficients by the recurrence of traces, in fractions; lowest first."""
    d = len(matrix)
    m, out = np.zeros((d, d), dtype=object), [Fraction(1)]
    for k in range(1, d + 1):
        m = matrix.dot(m) + np.eye(d, dtype=int).astype(object) * out[-1]
        out.append(-Fraction(int(np.trace(matrix.dot(m)))) / k)
    return [int(c) for c in reversed(out)]


def _modular(matrix):
    primes = whitening.primes_below(1 << 31, 2 * whitening.coefficient_bound(int(np.trace(matrix)), len(matrix)))
    residues = np.array([[[int(v) % p for v in row] for row in matrix] for p in primes])
    return whitening.combined(whitening.modular_polynomial(residues, np.array(primes)).astype(object), primes)


def _scatter(x):
    x = x.astype(object)
    return len(x) * x.T.dot(x) - np.outer(x.sum(axis=0), x.sum(axis=0))


@pytest.mark.parametrize("d", [1, 2, 3, 5, 9])
@pytest.mark.parametrize("seed", [1, 2])
def test_polynomial_is_exact(d, seed):
    x = np.random.default_rng(seed).integers(-10 ** 6, 10 ** 6, (d + 4, d))
    assert _modular(_scatter(x)) == _polynomial(_scatter(x))


def test_polynomial_with_zero_pivots_and_zero_roots():
    for matrix in ([[4, 0, 0], [0, 4, 0], [0, 0, 9]], [[0, 0, 0], [0, 0, 0], [0, 0, 5]], [[2, 0, 2], [0, 3, 0], [2, 0, 2]]):
        assert _modular(np.array(matrix, dtype=object)) == _polynomial(np.array(matrix, dtype=object))


def test_multiple_and_close_roots_are_found():
    # (x - 4)^2 (x - 9) x
    roots = whitening.largest_roots([0, -144, 88, -17, 1], 4)
    assert [(round(float(r.value()), 30), r.multiple) for r in roots] == [(9.0, 1), (4.0, 2)]
    # (x - 10^30) (x - 10^30 - 1)
    big = 10 ** 30
    roots = whitening.largest_roots([big * (big + 1), -2 * big - 1, 1], 2)
    assert [round(r.value()) for r in roots] == [big + 1, big] and all(r.multiple == 1 for r in roots)


def test_null_space_of_a_multiple_root_is_orthonormal():
    rng = np.random.default_rng(3)
    q = rng.integers(-5, 5, (4, 4))
    block = np.kron(np.eye(2, dtype=int), q @ q.T)                  # each root twice
    matrix = [[int(v) for v in row] for row in block]
    root = whitening.largest_roots(_modular(block.astype(object)), 2)[0]
    assert root.multiple == 2
    v = whitening.null_space(matrix, root.value(), 2)
    assert np.abs(v @ v.T - np.eye(2)).max() < 1e-15
    assert np.abs(block @ v.T - float(root.value()) * v.T).max() < 1e-12 * float(root.value())


def test_exact_sums_over_the_whole_range():
    x = np.array([[2 ** 61, -2 ** 61, 3], [-2 ** 40, 7, 0], [1, -1, 2 ** 19]], np.int64)
    total = np.zeros((4, 4), dtype=object)
    for power, made in whitening.exact_sums(x).items():
        total += made.astype(object) << (20 * power)
    z = np.hstack([np.ones((3, 1), dtype=int), x]).astype(object)
    assert (total == z.T.dot(z)).all()


def _brute(rows, dims):
    """By id: deviation, and the projections by numpy's eigenvectors; rows are (id, vector) that take part."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    far = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, far, (x - sums / n) @ q / np.sqrt(np.maximum(e, 1e-300)), e / e.sum()


def _check(got, rows, dims, wanted=16):
    n, far, white, share = _brute(rows, dims)
    assert len(got) == len(rows) * min(wanted, dims)
    far_of, white_of = {i: f for (i, _), f in zip(rows, far)}, {i: w for (i, _), w in zip(rows, white)}    # rows that repeat an id are alike
    made = np.array([[r["whitened"], white_of[r["vec_id"]][r["component"] - 1]] for r in sorted(got, key=lambda r: r["component"])])
    made = made.reshape(min(wanted, dims), -1, 2)
    sign = np.sign((made[:, :, 0] * made[:, :, 1]).sum(axis=1))[:, None]
    assert np.abs(made[:, :, 0] - made[:, :, 1] * sign).max() < 1e-6
    assert all(r["deviation"] == far_of[r["vec_id"]] for r in got)
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    assert all(np.isclose(r["explained"], share[r["component"] - 1], rtol=1e-6) for r in got)


def test_hand_made_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, 0.9]), (2, [0.5, -0.3, 0.1]), (2, [0.5, -0.3, 0.1]), (3, [-0.9, 0.2, 0.4]), (4, [0.0, 0.0, 0.0]),
            (5, [0.7, 0.8, -0.1]), (6, [0.5, -0.3, 0.1])]
    bad = [(7, None), (8, []), (9, [0.1, None, 0.2]), (10, [nan, 0.0, 0.0]), (11, [0.0, -inf, 0.0]), (12, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], "vec_id long, embedding array<double>, component int, whitened string")
    _check(whitening.whiten(df).collect(), good, 3)


def test_rows_without_spread_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(spark.createDataFrame(rows, schema))
        assert out.columns == columns and out.collect() == []
    line = [(i, [float(i), 2.0 * i]) for i in range(5)] + [(None, [9.0, 18.0])]
    got = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert len(got) == 6 and {r["component"] for r in got} == {1} and got[0]["identity_error"] < 1e-12


def test_large_components(spark):
    df = spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 5.0]), (3, [7.0, 1e12])], "vec_id long, embedding array<double>")
    got = whitening.whiten(df, exact_deviation=True).collect()
    x = [[int(64 * c) for c in v] for v in ([1e12, 0.0], [-1e12, 5.0], [7.0, 1e12])]
    sums = [sum(v[j] for v in x) for j in range(2)]
    want = [sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    assert [int(r["deviation"]) for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == 1] == want
    assert all(r["deviation"] is None for r in whitening.whiten(df).collect())
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"))


def test_query_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    _check(QUERIES["op11_polynomial_whitening"](spark, SF001).collect(), rows, len(rows[0][1]))
