"""Level-wise boosted trees against a brute-force grower over the same bins."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import boost


def brute_tree(bins, y, pred, depth, lam, min_h, rate):
    """Greedy second-order tree on bin columns; returns per-row increments."""
    g = pred - y
    names = sorted(bins)
    node = np.ones(len(y), dtype=int)
    splits = {}
    frontier = [1]
    for _ in range(depth):
        new = []
        for n in frontier:
            rows = node == n
            G, H = g[rows].sum(), rows.sum()
            best = None
            for f in names:
                for b in sorted(set(bins[f][rows])):
                    left = rows & (bins[f] <= b)
                    hl, gl = left.sum(), g[left].sum()
                    hr, gr = H - hl, G - gl
                    if hl < min_h or hr < min_h:
                        continue
                    gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - G * G / (H + lam)
                    key = (-gain, f, b)
                    if gain > 0 and (best is None or key < best):
                        best = key
            if best is None:
                new.append(n)
                continue
            splits[n] = (best[1], best[2])
            new += [2 * n, 2 * n + 1]
        if not splits.keys() & set(frontier):
            break
        for n in frontier:
            if n in splits:
                f, b = splits[n]
                rows = node == n
                node[rows & (bins[f] <= b)] = 2 * n
                node[rows & (bins[f] > b)] = 2 * n + 1
        frontier = new
    out = np.zeros(len(y))
    for n in set(node):
        rows = node == n
        out[rows] = -rate * g[rows].sum() / (rows.sum() + lam)
    return out


def table(spark, n=800, seed=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b = rng.random(), rng.randrange(6)
        rows.append((a if rng.random() > 0.05 else None, float(b), 3 * (a > 0.4) + b * b * 0.2 + rng.gauss(0, 0.2), "x"))
    return spark.createDataFrame(rows, "a double, b double, y double, _bin_a string")


def test_boosted_predictions_equal_brute_force(spark):
    df = table(spark)
    model = boost.fit_booster(df, ["a", "b"], "y", trees=3, depth=2, bins=8, lam=1.0, min_hessian=5.0, rate=0.5)
    rows, _ = boost.binned(df, ["a", "b"], "y", 8)
    got = rows.select(model.prediction().alias("p"), "_bin_a", "_bin_b", "_y").toPandas()
    bins = {"a": got["_bin_a"].to_numpy(), "b": got["_bin_b"].to_numpy()}
    y = got["_y"].to_numpy()
    pred = np.full(len(y), y.mean())
    for _ in range(3):
        pred = pred + brute_tree(bins, y, pred, 2, 1.0, 5.0, 0.5)
    assert np.allclose(got["p"].to_numpy(), pred, atol=1e-9)
    # The input's own column named like an internal one is kept as it was.
    out = model.transform(df).select("_bin_a").distinct().collect()
    assert [r[0] for r in out] == ["x"]


def test_random_kind_is_deterministic_and_learns(spark):
    df = table(spark, seed=9)
    one = boost.fit_booster(df, ["a", "b"], "y", trees=5, depth=3, bins=16, kind="random", seed=1)
    two = boost.fit_booster(df, ["a", "b"], "y", trees=5, depth=3, bins=16, kind="random", seed=1)
    assert [t.splits for t in one.trees] == [t.splits for t in two.trees]
    scored = one.transform(df).where(F.col("y").isNotNull())
    err = scored.agg(F.avg((F.col("prediction") - F.col("y")) ** 2), F.variance("y")).first()
    assert err[0] < 0.5 * err[1]


def test_empty_and_null_targets(spark):
    empty = spark.createDataFrame([], "a double, y double")
    model = boost.fit_booster(empty, ["a"], "y", trees=2, depth=2)
    assert model.base == 0.0 and all(not t.splits for t in model.trees)
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 4.0)], "a double, y double")
    model = boost.fit_booster(df, ["a"], "y", trees=1, depth=2, min_hessian=1.0)
    assert model.base == pytest.approx(3.0)
    assert model.transform(df).count() == 3
