"""Cross-validation from fold sums against fits on the rows of each training part."""

import random

import numpy as np

from riskspark.operators import gramcv


def direct_enet(x, y, alpha, l1_ratio, iterations=20000):
    """Coordinate descent on the rows themselves, for the same objective."""
    n, p = x.shape
    mx, my = x.mean(0), y.mean()
    xc, yc = x - mx, y - my
    beta = np.zeros(p)
    for _ in range(iterations):
        for j in range(p):
            r = yc - xc @ beta + xc[:, j] * beta[j]
            rho = xc[:, j] @ r
            beta[j] = np.sign(rho) * max(abs(rho) - n * alpha * l1_ratio, 0) / (xc[:, j] @ xc[:, j] + n * alpha * (1 - l1_ratio))
    return my - mx @ beta, beta


def test_folds_equal_fits_on_rows(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(300)}", rng.random(), rng.random() * 3, 0.0) for _ in range(1500)]
    rows = [(k, a, b, 2 * a - b + rng.gauss(0, 0.3)) for k, a, b, _ in rows] + [(None, 1.0, 1.0, 1.0), ("k1", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "key string, a double, b double, y double")
    folds = {r["k"]: r["f"] for r in df.select(df.key.alias("k"), gramcv.hash_fold(4, 9, "key").alias("f")).collect()}
    for alpha, l1 in ((0.0, 0.0), (0.05, 0.0), (0.02, 0.7)):
        out = {r.fold: r for r in gramcv.cross_validate_linear(spark, df, ["a", "b"], "y", folds=4, repeats=1, seed=9, key="key", alpha=alpha, l1_ratio=l1).collect()}
        clean = [r for r in rows if r[0] is not None and r[1] is not None]
        for fold, got in out.items():
            train = np.array([r[1:] for r in clean if folds[r[0]] != fold])
            valid = np.array([r[1:] for r in clean if folds[r[0]] == fold])
            b, beta = direct_enet(train[:, :2], train[:, 2], alpha, l1) if l1 else (None, None)
            if not l1:
                x = np.c_[np.ones(len(train)), train[:, :2]]
                pen = np.diag([0, 1, 1]) * len(train) * alpha
                xc = train[:, :2] - train[:, :2].mean(0)
                beta = np.linalg.solve(xc.T @ xc + pen[1:, 1:], xc.T @ (train[:, 2] - train[:, 2].mean()))
                b = train[:, 2].mean() - train[:, :2].mean(0) @ beta
            err = valid[:, 2] - b - valid[:, :2] @ beta
            assert got.n_train == len(train) and got.n_valid == len(valid)
            assert np.isclose(got.rmse, np.sqrt((err ** 2).mean()), rtol=1e-7)
            assert np.allclose(got.coefficients, beta, atol=1e-6)
