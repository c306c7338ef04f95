"""Linear cross-validation from sufficient statistics: one pass for all folds and repeats.

Every row is dealt to one fold per repeat (a stable hash of its key, as in ``hash_fold``).
One aggregation gives, per (repeat, fold), the row count and the sums of x, y, x x', x y
and y y. A training part is its repeat's total minus its fold, so no fold is fitted by a
pass over rows. Ridge is solved in closed form on the centred Gram matrix; elastic net by
coordinate descent on it. Validation error follows from the fold's own sums:

    SSE = sum y^2 - 2 b sum y - 2 beta' X'y + n b^2 + 2 b beta' sum x + beta' X'X beta.

The table of sums has repeats x folds rows of (p + 1)^2 numbers, so it is collected.
Defined results: rows with a null feature, target or key take no part; a fold without
rows has no error (null); a training part without rows has no model (null).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.features import hash_fold


def fold_sums(df: DataFrame, features: Sequence[str], target: str, folds: int, repeats: int, seed: int, key: str) -> list[dict]:
    """Per (repeat, fold): n, sums of x, y, x x', x y, y y; one aggregation over all rows."""
    clean = df.where(F.col(key).isNotNull() & F.col(target).isNotNull())
    for c in features:
        clean = clean.where(F.col(c).isNotNull())
    rows = clean.select(
        F.array(*[hash_fold(folds, seed + r, key) for r in range(repeats)]).alias("_folds"),
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)],
        F.col(target).cast("double").alias("_y"),
    ).select(F.posexplode("_folds").alias("repeat", "fold"), "*").drop("_folds")
    p = len(features)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("_y").alias("sy"), F.sum(F.col("_y") * F.col("_y")).alias("syy")]
    sums += [F.sum(f"_x{i}").alias(f"sx{i}") for i in range(p)]
    sums += [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"sxy{i}") for i in range(p)]
    sums += [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"sxx{i}_{j}") for i in range(p) for j in range(i, p)]
    return [r.asDict() for r in rows.groupBy("repeat", "fold").agg(*sums).collect()]


def _arrays(row: dict, p: int) -> tuple[float, float, float, np.ndarray, np.ndarray, np.ndarray]:
    xx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = row[f"sxx{i}_{j}"]
    return float(row["n"]), float(row["sy"]), float(row["syy"]), np.array([row[f"sx{i}"] for i in range(p)], float), np.array([row[f"sxy{i}"] for i in range(p)], float), xx


def fit(n: float, sy: float, sx: np.ndarray, sxy: np.ndarray, sxx: np.ndarray, alpha: float, l1_ratio: float, iterations: int = 10_000, tol: float = 1e-12) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) minimising (1/2n)|y - b - X beta|^2 + alpha (r |beta|_1 + (1 - r)/2 |beta|^2)."""
    mx, my = sx / n, sy / n
    gram = sxx - n * np.outer(mx, mx)
    cov = sxy - n * mx * my
    p = len(sx)
    if l1_ratio == 0 or alpha == 0:
        beta = np.linalg.lstsq(gram + n * alpha * np.eye(p), cov, rcond=None)[0]
    else:
        beta = np.zeros(p)
        for _ in range(iterations):
            largest = 0.0
            for j in range(p):
                rho = cov[j] - gram[j] @ beta + gram[j, j] * beta[j]
                new = np.sign(rho) * max(abs(rho) - n * alpha * l1_ratio, 0.0) / (gram[j, j] + n * alpha * (1 - l1_ratio)) if gram[j, j] > 0 else 0.0
                largest = max(largest, abs(new - beta[j]))
                beta[j] = new
            if largest < tol:
                break
    return float(my - mx @ beta), beta


def cross_validate_linear(
    spark: SparkSession,
    df: DataFrame,
    features: Sequence[str],
    target: str,
    folds: int = 5,
    repeats: int = 1,
    seed: int = 42,
    key: str = "asset_id",
    alpha: float = 0.0,
    l1_ratio: float = 0.0,
) -> DataFrame:
    """(repeat, fold, n_train, n_valid, rmse, r2, intercept, coefficients) of every fold of every repeat."""
    p = len(features)
    table = {(r["repeat"], r["fold"]): _arrays(r, p) for r in fold_sums(df, features, target, folds, repeats, seed, key)}
    out = []
    for repeat in range(repeats):
        parts = [table.get((repeat, f)) for f in range(folds)]
        present = [t for t in parts if t is not None]
        if not present:
            continue
        total = [sum(t[k] for t in present) for k in range(6)]
        for fold, part in enumerate(parts):
            if part is None:
                continue
            train = [total[k] - part[k] for k in range(6)]
            n_t, n_v = train[0], part[0]
            if n_t <= 0:
                out.append((repeat, fold, int(n_t), int(n_v), None, None, None, None))
                continue
            b, beta = fit(train[0], train[1], train[3], train[4], train[5], alpha, l1_ratio)
            n, sy, syy, sx, sxy, sxx = part
            sse = syy - 2 * b * sy - 2 * beta @ sxy + n * b * b + 2 * b * (beta @ sx) + beta @ sxx @ beta
            sst = syy - sy * sy / n
            rmse = float(np.sqrt(max(sse, 0.0) / n))
            r2 = float(1 - sse / sst) if sst > 0 else None
            out.append((repeat, fold, int(n_t), int(n_v), rmse, r2, b, [float(v) for v in beta]))
    schema = "repeat int, fold int, n_train long, n_valid long, rmse double, r2 double, intercept double, coefficients array<double>"
    return spark.createDataFrame(out, schema)
