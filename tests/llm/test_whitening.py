"""Whitening against numpy's eigenvalues, and the qd solver on hard matrices."""

import math

import numpy as np
import pytest

from cohortline.llm import whitening as w
from tests.llm.conftest import SF, rows

RNG = np.random.default_rng(12)
LEFT = np.linalg.qr(RNG.normal(size=(300, 40)))[0]
RIGHT = np.linalg.qr(RNG.normal(size=(40, 40)))[0]


def with_values(values):
    return np.linalg.qr(LEFT @ np.diag(values) @ RIGHT.T, mode="r")


HARD = {
    "one": np.array([[3.0]]),
    "two": np.array([[1.0, 2.0], [0.0, 1e-9]]),
    "random": np.linalg.qr(RNG.normal(size=(300, 64)), mode="r"),
    "equal": np.eye(9),
    "diagonal": np.diag(np.arange(1.0, 12)),
    "groups": with_values([5.0] * 10 + [3.0] * 15 + [1.0] * 15),
    "close": with_values(1 + 1e-10 * np.arange(40)),
    "graded": with_values(10.0 ** -np.linspace(0, 9, 40)),
    "deficient": with_values([4.0] * 3 + [1.0] * 7 + [0.0] * 30),
    "mirrored": np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1),
    "rank one": np.linalg.qr(np.outer(RNG.normal(size=50), RNG.normal(size=20)), mode="r"),
    "nothing": np.zeros((5, 5)),
}


@pytest.mark.parametrize("name", sorted(HARD))
def test_right_vectors(name):
    r = HARD[name]
    values, vectors = w.right_vectors(r)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.abs(values - want).max() <= 1e-14 * len(want) * max(want[0], 1e-300)
    assert np.abs(vectors @ vectors.T - np.eye(len(r))).max() < 1e-11
    assert np.abs(r.T @ (r @ vectors.T) - vectors.T * values**2).max() <= 1e-12 * max(want[0] ** 2, 1e-300)


def test_small_singular_values_are_accurate():
    # A bidiagonal matrix fixes its smallest singular value to full relative accuracy.
    diagonal, above = np.array([1.0, 1e-5, 1e-9, 1e-14]), np.array([1.0, 1e-5, 1e-9])
    b = np.diag(diagonal) + np.diag(above, 1)
    values = w.singular_values(diagonal, above)
    assert math.isclose(np.prod(values), abs(np.prod(diagonal)), rel_tol=1e-13)
    assert math.isclose(values[0], np.linalg.norm(b, 2), rel_tol=1e-14)


def brute(vectors):
    """``{vec_id: (deviation, |whitened|)}`` and the explained shares, by numpy."""
    fine = {k: v for k, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    x = {k: [math.floor(1024 * c) + 100_000 for c in v] for k, v in fine.items()}
    n, total = len(x), [sum(c) for c in zip(*x.values())]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in x.values()])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    z = centred @ directions[:, :8] / np.sqrt(values[:8])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total)) for v in x.values()]
    return n, {k: (d, list(row)) for k, d, row in zip(x, deviation, z)}, values[:8] / values.sum()


def compare(found, vectors):
    n, want, share = brute(vectors)
    got = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], share[r["component"] - 1], rel_tol=1e-9)
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert got.keys() == want.keys()
    sign = {}
    for key, (deviation, z) in want.items():
        assert sorted(got[key]) == list(range(1, len(z) + 1))
        for c, value in enumerate(z, 1):
            r = got[key][c]
            assert r["deviation"] == deviation
            if abs(value) > 1e-3:
                sign.setdefault(c, math.copysign(1, r["whitened"] * value))
            assert math.isclose(r["whitened"], sign.get(c, 1) * value, rel_tol=1e-7, abs_tol=1e-3 if c not in sign else 1e-8)


def test_query_equals_brute_force(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(w.op12_whitening(spark, SF).collect(), [tuple(r) for r in given])


ODD = [
    (1, [1.0, 2.0, 0.5]), (2, [0.25, -2.0, 4.0]), (3, None), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]),
    (6, [float("inf"), 0.0, 0.0]), (7, [3.0, 1.0, -1.0]), (8, [0.1, 0.2, 0.3]), (9, [1.0, 2.0]), (10, []),
    (None, [2.0, 2.0, 2.0]), (1, [1.0, 2.0, 0.5]), (11, [-3.0, 0.5, 7.25]),
]


def frame(spark, data):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    return df.selectExpr("*", "'x' AS x", "'n' AS n", "1 AS key", "2 AS whitened", "3 AS v")


def test_odd_rows(spark):
    found = w.whiten(frame(spark, ODD).repartition(3)).collect()
    assert sorted([r["vec_id"] or 0 for r in found]) == [0, 1, 1, 2, 7, 8, 11]
    assert {r["n"] for r in found} == {7}
    fine = [v for k, v in ODD if k in (None, 1, 2, 7, 8, 11)]
    _, want, share = brute(list(enumerate(fine)))
    assert np.allclose(found[0]["explained"], share)
    assert sorted(int(r["deviation"]) for r in found) == sorted(d for d, _ in want.values())
    z = np.abs([r["whitened"] for r in found])
    assert np.allclose(np.sort(z, axis=0), np.sort(np.abs([row for _, row in want.values()]), axis=0))


def test_no_rows_and_no_spread(spark):
    assert w.whiten(frame(spark, ODD).limit(0)).count() == 0
    assert w.whiten(frame(spark, [(1, None), (2, [None])])).count() == 0
    assert [tuple(r["whitened"]) for r in w.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()] == [(None, None)] * 2
    flat = w.whiten(frame(spark, [(i, [float(i), 5.0]) for i in range(9)])).collect()
    assert all(r["whitened"][1] is None and r["whitened"][0] is not None for r in flat)


def test_large_values_stay_exact(spark):
    data = [(i, [float(i) * 1e9, -float(i * i), 1e6]) for i in range(40)]
    found = {r["vec_id"]: int(r["deviation"]) for r in w.whiten(frame(spark, data)).collect()}
    _, want, _ = brute(data)
    assert found == {k: d for k, (d, _) in want.items()}


def test_many_factors_in_a_tree(spark):
    x = np.random.default_rng(4).integers(-50, 50, (700, 6))
    vectors = spark.createDataFrame([(row.tolist(),) for row in x], "x array<long>").repartition(24)
    total = x.sum(0).tolist()
    r = w.triangular_factor(vectors, 700, total, fan_in=3)
    centred = x - x.mean(0)
    assert np.allclose(r.T @ r, centred.T @ centred)
