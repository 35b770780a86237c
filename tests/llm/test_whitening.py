"""Whitening against dense eigenvectors, exact sums and polynomials by interpolation-free recursion."""

import math
import random

import numpy as np
import pytest

from millrace.llm import whitening

DDL = "vec_id long, embedding array<float>, component string"


def leverrier(m):
    """Characteristic polynomial by traces of powers, constant first."""
    d = len(m)
    c, work = [1], np.zeros_like(m)
    for k in range(1, d + 1):
        work = m.dot(work + c[-1] * np.eye(d, dtype=object).astype(int).astype(object)) if k > 1 else m.copy()
        c.append(-sum(work[i, i] for i in range(d)) // k)
    return c[::-1]


def scatter(rng, d, n):
    y = np.array([[rng.randint(-40, 40) for _ in range(d)] for _ in range(n)], object)
    s = y.sum(axis=0)
    return n * y.T.dot(y) - np.outer(s, s)


@pytest.mark.parametrize("d", [1, 2, 5, 9])
def test_polynomial(spark, d):
    m = scatter(random.Random(d), d, 12)
    assert whitening.characteristic_polynomial(spark, m) == leverrier(m)


def test_polynomial_with_zero_columns(spark):
    m = np.array([[4, 0, 0, 2], [0, 0, 0, 0], [0, 0, 9, 0], [2, 0, 0, 1]], object)
    assert whitening.characteristic_polynomial(spark, m) == [0, 0, 45, -14, 1]


def test_roots_with_multiplicity():
    poly = [1]
    for root in (7, 7, 7, 20, 1000, 1001, 0):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [whitening.roots_above(poly, x) for x in (0, 6, 7, 20, 1000, 1001)] == [6, 6, 3, 2, 1, 0]
    spans = whitening.isolate(poly, 2048, 10)
    assert [x[3] for x in spans] == [1, 1, 1, 3]
    assert [whitening.refine(poly, *x[:3]) if x[3] == 1 else x[1] for x in spans] == [1001, 1000, 20, 7]


def expect(rows, wanted):
    x = np.floor(64 * np.array(rows, np.float64)) + 1_000_000
    n, z = len(x), x - x.mean(axis=0)
    value, vector = np.linalg.eigh(z.T @ z / n)
    value, vector = value[::-1][:wanted], vector[:, ::-1][:, :wanted]
    return z @ vector / np.sqrt(value), value / np.trace(z.T @ z / n)


def test_whitening_equals_dense_solution(spark):
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(60, 6)) * [9, 5, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    odd = [(None, [1.0] * 6, "a"), (900, None, "b"), (901, [], "c"), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], "d"),
           (903, [float("nan")] * 6, "e"), (904, [float("inf")] + [0.0] * 5, "f"), (905, [1.0, 2.0], "g"), (3, rows[3], "h")]
    table = spark.createDataFrame([(i, r, "x") for i, r in enumerate(rows)] + odd, DDL).repartition(5)
    usable = [*rows, [1.0] * 6, rows[3]]
    got = whitening.whiten(table, whitening.fit(table, components=4)).collect()
    assert len(got) == 62 * 4 and {r["n"] for r in got} == {62}
    white, explained = expect(usable, 4)
    ints = [[math.floor(64 * c) for c in r] for r in np.array(usable, np.float32).astype(float).tolist()]
    sums = [sum(c) for c in zip(*ints)]
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    for i in (0, 7, 59):
        deviation = sum((62 * x - s) ** 2 for x, s in zip(ints[i], sums))
        assert by_row[i, deviation].keys() == {1, 2, 3, 4}
    for k in range(4):
        mine = np.array([by_row[i, sum((62 * x - s) ** 2 for x, s in zip(ints[i], sums))][k + 1][0]["whitened"] for i in range(60)])
        sign = np.sign(mine @ white[:60, k])
        assert np.abs(mine - sign * white[:60, k]).max() < 1e-9
        assert {r["explained"] for r in got if r["component"] == k + 1}.pop() == pytest.approx(explained[k], rel=1e-12)
    assert len(by_row[3, sum((62 * x - s) ** 2 for x, s in zip(ints[3], sums))][1]) == 2
    assert max(r["identity_error"] for r in got) < 1e-9


def test_equal_variances_and_missing_ones(spark):
    """Three axes of equal variance give an orthonormal triple; a constant dimension gives no component."""
    rows = [[a, b, c, 5.0] for a in (0.0, 1.0) for b in (0.0, 1.0) for c in (0.0, 1.0)]
    table = spark.createDataFrame([(i, r, "") for i, r in enumerate(rows)], DDL)
    model = whitening.fit(table)
    assert model.explained.tolist() == [1 / 3] * 3 and model.variances.tolist() == [1024.0] * 3
    assert np.abs(model.vectors @ model.vectors.T - np.eye(3)).max() < 1e-15 and np.abs(model.vectors[:, 3]).max() == 0
    assert whitening.whiten(table, model).agg({"identity_error": "max"}).first()[0] < 1e-12


def test_huge_entries_stay_exact(spark):
    """Sums beyond a long stay exact; a deviation beyond it is null."""
    rows = [[3e15, 1.0], [-3e15, 2.0], [1e15, 4.0], [2e30, 0.0]]
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    ints = [[min(math.floor(64 * c), 2**62) for c in r] for r in rows]
    n, sums, second = whitening.moments(table)
    assert n == 4 and sums == [sum(c) for c in zip(*ints)]
    assert second.tolist() == [[sum(r[i] * r[j] for r in ints) for j in range(2)] for i in range(2)]
    got = whitening.whiten(table, whitening.fit(table)).collect()
    assert len(got) == 8 and all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-4


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "")], [(1, [1.0, 2.0], ""), (2, [1.0, 2.0], "")], [(1, None, "")]])
def test_no_variance(spark, rows):
    table = spark.createDataFrame(rows, DDL)
    got = whitening.whiten(table, whitening.fit(table))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
