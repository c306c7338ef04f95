"""The k-th neighbour estimate of mutual information against a brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from riskspark.operators import neighbours


def psi(n):
    m = n + 6.0
    return math.log(m) - 0.5 / m - 1 / 12 / m**2 + 1 / 120 / m**4 - 1 / 252 / m**6 - sum(1.0 / (n + j) for j in range(6))


def brute(xs, ys, k=3):
    keep = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None and math.isfinite(x) and math.isfinite(y)]
    n = len(keep)
    if n <= k:
        return None, n
    x = np.array([a for a, _ in keep])
    y = np.array([b for _, b in keep])
    sx = x.std() if x.std() > 0 else 1.0
    sy = y.std() if y.std() > 0 else 1.0
    u = np.round((x - x.mean()) / sx, 9)
    v = np.round((y - y.mean()) / sy, 9)
    total = psi(n) + psi(k)
    for i in range(n):
        d = np.maximum(np.abs(u - u[i]), np.abs(v - v[i]))
        eps = np.sort(np.delete(d, i))[k - 1]
        if eps > 0:
            nx = np.sum((u > u[i] - eps) & (u < u[i] + eps)) - 1
            ny = np.sum((v > v[i] - eps) & (v < v[i] + eps)) - 1
        else:
            nx, ny = np.sum(u == u[i]) - 1, np.sum(v == v[i]) - 1
        total -= (psi(nx + 1) + psi(ny + 1)) / n
    return max(total, 0.0), n


def test_equal_to_brute_force_with_ties_hot_values_and_odd_rows(spark):
    rng = random.Random(11)
    rows = []
    for i in range(700):
        a = rng.gauss(0, 1)
        rows.append((a, rng.randrange(5) * 1.0, a * a + rng.gauss(0, 0.3)))
    rows += [(0.0, 0.0, 0.0)] * 250  # a hot point, a third of the table
    rows += [(None, 1.0, 2.0), (float("nan"), 1.0, 1.0), (float("inf"), 2.0, 1.0), (1.0, None, 3.0), (2.0, 2.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double").withColumn("u", df_col_clash())
    got = {r["feature"]: (r["mutual_information"], r["rows"]) for r in neighbours.neighbour_information(df, ["a", "b"], "y").collect()}
    for name, index in (("a", 0), ("b", 1)):
        want, n = brute([r[index] for r in rows], [r[2] for r in rows])
        assert got[name][1] == n
        assert got[name][0] == pytest.approx(want, abs=1e-9)


def test_dependent_feature_scores_higher(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        a = rng.gauss(0, 1)
        rows.append((a, rng.gauss(0, 1), a * a + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = {r["feature"]: r["mutual_information"] for r in neighbours.neighbour_information(df, ["a", "b"], "y").collect()}
    assert got["a"] > 0.5 > 0.1 > got["b"]


def df_col_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_few_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 5.0), (None, None)], "x double, y double")
    got = neighbours.neighbour_information(df, ["x"], "y").collect()
    assert [(r["feature"], r["mutual_information"], r["rows"]) for r in got] == [("x", None, 2)]
    empty = spark.createDataFrame([], "x double, y double")
    got = neighbours.neighbour_information(empty, ["x"], "y").collect()
    assert [(r["feature"], r["mutual_information"], r["rows"]) for r in got] == [("x", None, 0)]


def test_spread_out_points_settle_at_coarse_levels(spark):
    # Two far clusters: points of the small one need the coarse grids.
    rows = [(float(i % 50), float(i % 7)) for i in range(400)] + [(1e6 + i, 1e6 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = neighbours.neighbour_information(df, ["x"], "y").collect()[0]
    want, n = brute([r[0] for r in rows], [r[1] for r in rows])
    assert got["rows"] == n
    assert got["mutual_information"] == pytest.approx(want, abs=1e-9)
