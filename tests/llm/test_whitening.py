"""Whitening: error-free sums, the eigen-solver, and whole results against exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from loomlake.llm import whitening
from loomlake.llm.whitening import add, deviations, eigen, op12_whitening, quantised, total, two_product, two_sum, usable, whiten

BIG = (1 << 53) + 1


def test_sums_and_products_lose_nothing():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=500) * 10.0 ** rng.integers(-12, 12, 500), rng.normal(size=500)
    for f, exact in ((two_sum, lambda x, y: x + y), (two_product, lambda x, y: x * y)):
        for x, y, h, e in zip(a, b, *f(a, b), strict=True):
            assert Fraction(h) + Fraction(e) == exact(Fraction(x), Fraction(y))
    high, low = total((a, np.zeros(500)))
    true = sum(map(Fraction, a))
    assert abs(Fraction(float(high)) + Fraction(float(low)) - true) <= abs(true) * Fraction(1, 1 << 95)
    assert add((np.array([1.0]), np.array([2.0**-60])), (np.array([-1.0]), np.array([2.0**-70])))[0] == 2.0**-60 + 2.0**-70


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 65])
def test_eigen_solver(n):
    rng = np.random.default_rng(n)
    x, q = rng.normal(size=(n, n)), np.linalg.qr(rng.normal(size=(n, n)))[0]
    clustered = q @ np.diag([1.0] * (n // 2) + [2.0] * (n - n // 2)) @ q.T
    for a in (x + x.T, np.atleast_2d(np.cov(rng.normal(size=(n, 3 * n)))), np.eye(n), np.zeros((n, n)), np.ones((n, n)), clustered, q @ np.diag(10.0 ** -np.arange(n)) @ q.T):
        a = (a + a.T) / 2
        w, v = eigen(a)
        scale = np.abs(a).max() or 1.0
        assert (np.diff(w) <= 0).all() and np.abs(w - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * n * scale
        assert np.abs(v.T @ v - np.eye(n)).max() < 1e-13 and np.abs(a @ v - v * w).max() < 1e-13 * n * scale


def exact(x: list[list[int]]) -> np.ndarray:
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    u = [[n * r[j] - s[j] for j in range(d)] for r in x]
    return np.array([[float(Fraction(sum(r[i] * r[j] for r in u), n**3)) for j in range(d)] for i in range(d)])


@pytest.mark.parametrize("fan", [64, 2])
def test_query_equals_exact_arithmetic(spark, sf, monkeypatch, fan):
    monkeypatch.setattr(whitening, "FAN", fan)
    monkeypatch.setattr(whitening, "ENTRIES", 500)
    source = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = {r["vec_id"]: [int(np.floor(1024 * float(c))) + 100000 for c in r["embedding"]] for r in source}
    n, every = len(x), np.array(list(x.values()), dtype=object)
    v, s = exact(every.tolist()), every.sum(axis=0)
    w, basis = np.linalg.eigh(v)
    w, basis = w[::-1][:8], basis[:, ::-1][:, :8]
    rows = op12_whitening(spark, sf).collect()
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n}
    got = np.zeros((n, 8))
    at = {i: k for k, i in enumerate(x)}
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[r["vec_id"]], s, strict=True))
        assert abs(r["explained"] - w[r["component"] - 1] / np.trace(v)) < 1e-12 and r["identity_error"] < 1e-10
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s, strict=True)] for r in every])
    want = centred @ basis / np.sqrt(w)
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8


def test_a_mean_far_above_the_spread_costs_no_digits(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (400, 3)) + np.array([2**50, 2**51, 7])
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, x array<double>").repartition(7)
    rows, model = whiten(df, "x", 3)
    true = exact([[int(c) for c in r] for r in x])
    assert np.abs(model.components @ np.diag(model.values) @ model.components.T - true).max() < 1e-13
    assert model.identity_error < 1e-12 and rows.count() == 400 and model.sums == [int(c) for c in x.sum(axis=0)]


def test_odd_rows(spark):
    rows = [(BIG, [1.0, 2.0]), (None, [3.0, 1.0]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (11, [0.0, 0.0]), (11, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, x array<double>, least string")
    found, model = whiten(df, "x")
    assert sorted(map(str, [r["vec_id"] for r in found.collect()])) == sorted(map(str, [BIG, None, 11, 11])) and model.n == 4
    assert {len(r["whitened"]) for r in found.collect()} == {2} and model.identity_error < 1e-12
    flat, same = whiten(df.filter("vec_id = 11"), "x")
    assert [r["whitened"] for r in flat.collect()] == [[None, None]] * 2 and same.identity_error is None
    none, empty = whiten(df.filter("vec_id = 5"), "x")
    assert none.count() == 0 and empty.n == 0
    assert usable(df, "x").count() == 5


def test_empty_table_and_null_vectors_in_the_query(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, label int"
    for name, rows in (("none", []), ("nulls", [(1, None, None)]), ("one", [(1, [0.5, 0.25], 1)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    assert op12_whitening(spark, f"{tmp_path}/none").collect() == [] == op12_whitening(spark, f"{tmp_path}/nulls").collect()
    one = op12_whitening(spark, f"{tmp_path}/one").collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]


def test_deviations_beyond_long_products(spark):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(0, 0), (2.0**40, 1), (2.0**33, 5)])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").select("vec_id", quantised("v").alias("x"))
    _, model = whiten(df, "x")
    x = {r["vec_id"]: r["x"] for r in df.collect()}
    s = [sum(c) for c in zip(*x.values(), strict=True)]
    true = {i: sum((3 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in x.items()}
    got = {r["vec_id"]: r["deviation"] for r in deviations(df, "x", model, "deviation").collect()}
    assert got == {i: t if t < 1 << 63 else None for i, t in true.items()}
