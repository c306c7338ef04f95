"""Regression training, validation and tuning with MLlib."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import partial
from itertools import product
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import numeric_columns
from riskspark.functions.ordering import quantiles
from riskspark.operators.features import hash_fold, hash_share
from riskspark.operators.forest import Forest, GrownForest
from riskspark.operators.scale import Scaler, or_one
from riskspark.session import in_parallel, materialize

MAX_DEPTH = 30  # the deepest tree MLlib builds; stands for "no limit"


# --- preprocessing ---------------------------------------------------------------


@dataclass(frozen=True)
class Preprocessor:
    """Median fill, then robust scaling, both exact and learned from training rows only."""

    fills: dict[str, float]
    scaler: Scaler

    def transform(self, df: DataFrame) -> DataFrame:
        known = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in self.fills.items()}
        return self.scaler.transform(df.withColumns(known))


def fit_preprocessor(df: DataFrame, features: Iterable[str]) -> Preprocessor:
    """One quantile pass; a second one only if values are missing, as filling shifts the quartiles."""
    features = list(features)
    marks = quantiles(df, {c: [0.25, 0.5, 0.75] for c in features})
    fills = {c: (q[0.5] if q[0.5] is not None else 0.0) for c, q in marks.items()}
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    holed = [c for c in features if gaps[c]]
    if holed:
        full = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c) for c in holed])
        marks |= quantiles(full, {c: [0.25, 0.5, 0.75] for c in holed})
    params = {c: ("robust", q[0.5], or_one(q[0.75] - q[0.25])) for c, q in marks.items()}
    return Preprocessor(fills, Scaler(params))


@dataclass
class LossModel:
    """Preprocessor, vector assembly, a regressor on log1p of the target and the way back."""

    features: list[str]
    target: str
    preprocessor: Preprocessor | None
    regressor: Any
    log_target: bool = True

    def prepared(self, df: DataFrame) -> DataFrame:
        """Add the model's input vector ``features`` without touching the input columns."""
        names = {c: f"_x_{c}" for c in self.features}
        inputs = df.select("*", *[F.col(c).cast("double").alias(n) for c, n in names.items()])
        if self.preprocessor:
            fills = {names[c]: v for c, v in self.preprocessor.fills.items()}
            params = {names[c]: p for c, p in self.preprocessor.scaler.params.items()}
            inputs = Preprocessor(fills, Scaler(params)).transform(inputs)
        assembler = VectorAssembler(inputCols=list(names.values()), outputCol="features")
        return assembler.transform(inputs).drop(*names.values())

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the predicted loss on the original scale."""
        scored = self.regressor.transform(self.prepared(df))
        loss = F.expm1("prediction") if self.log_target else F.col("prediction")
        return scored.withColumn("_loss", loss).drop("prediction", "features").withColumnRenamed("_loss", output)

    def importances(self, coefficients: bool = True) -> dict[str, float]:
        """Feature importances; of a linear model its coefficients, or nothing if those are not wanted."""
        values = getattr(self.regressor, "featureImportances", None)
        if values is None and coefficients:
            values = getattr(self.regressor, "coefficients", None)
        return {} if values is None else dict(zip(self.features, values.toArray().tolist(), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        """Regressor and preprocessor under one folder."""
        grown = isinstance(self.regressor, GrownForest)
        if grown:
            self.regressor.save(f"{path}/forest")
        else:
            PipelineModel([self.regressor]).write().overwrite().save(f"{path}/regressor")
        rows = [
            (i, c, self.target, self.log_target, self.preprocessor.fills[c], *self.preprocessor.scaler.params[c][1:], grown)
            if self.preprocessor
            else (i, c, self.target, self.log_target, None, None, None, grown)
            for i, c in enumerate(self.features)
        ]
        schema = "place int, feature string, target string, logged boolean, fill double, shift double, scale double, grown boolean"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/preprocessor")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LossModel:
        rows = spark.read.parquet(f"{path}/preprocessor").orderBy("place").collect()
        pre = None
        if rows[0]["shift"] is not None:
            fills = {r["feature"]: r["fill"] for r in rows}
            pre = Preprocessor(fills, Scaler({r["feature"]: ("robust", r["shift"], r["scale"]) for r in rows}))
        if "grown" in rows[0] and rows[0]["grown"]:
            regressor = GrownForest.load(spark, f"{path}/forest")
        else:
            regressor = PipelineModel.load(f"{path}/regressor").stages[0]
        return LossModel([r["feature"] for r in rows], rows[0]["target"], pre, regressor, rows[0]["logged"])


def fit_model(
    df: DataFrame, features: list[str], target: str, estimator: Estimator, preprocessor: Preprocessor | None = None
) -> LossModel:
    """Fit preprocessing (unless given) and the estimator on log1p of the target."""
    preprocessor = preprocessor or fit_preprocessor(df, features)
    model = LossModel(features, target, preprocessor, None)
    data = model.prepared(df).select("features", F.log1p(F.col(target).cast("double")).alias("label"))
    model.regressor = estimator.fit(data)
    return model


# --- registry --------------------------------------------------------------------


def random_forest(trees: int = 300, depth: int | None = None, min_leaf: int = 1, seed: int = 42) -> Estimator:
    return Forest(
        numTrees=trees, maxDepth=depth or MAX_DEPTH, minInstancesPerNode=min_leaf, seed=seed, featureSubsetStrategy="all", cacheNodeIds=True
    )


@dataclass(frozen=True)
class PenalisedLinear:
    """Least squares (halved mean) plus ``alpha`` times the mixed L1 / L2 penalty, on the scale of the label.

    MLlib divides the label by its standard deviation before it fits. That leaves the L1
    penalty as asked and weakens the L2 penalty by that deviation, so the parameters are
    chosen when the label is known.
    """

    alpha: float
    l1_ratio: float
    max_iter: int = 1000
    features_col: str = "features"

    def copy(self) -> PenalisedLinear:
        return self

    def setFeaturesCol(self, name: str) -> PenalisedLinear:  # noqa: N802 - the name estimators use
        return replace(self, features_col=name)

    def fit(self, data: DataFrame) -> Transformer:
        spread = data.agg(F.stddev_samp("label")).first()[0] or 1.0
        l1, l2 = self.alpha * self.l1_ratio, self.alpha * (1 - self.l1_ratio) * spread
        total = l1 + l2
        solver = LinearRegression(
            featuresCol=self.features_col, regParam=total, elasticNetParam=l1 / total if total else 0.0, standardization=False,
            maxIter=self.max_iter, tol=1e-9,
        )
        return solver.fit(data)


def elastic_net(alpha: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 1000) -> PenalisedLinear:
    return PenalisedLinear(alpha, l1_ratio, max_iter)


def model_registry(seed: int = 42, trees: int = 120, rounds: int = 120, depth: int | None = None) -> dict[str, Estimator]:
    """The candidate models; ``depth`` bounds the forest, None leaves it unlimited."""
    return {
        "Linear Regression": LinearRegression(),
        "ElasticNet": elastic_net(0.005, 0.2, 5000),
        "Random Forest": random_forest(trees, depth, 2, seed),
        "Gradient Boosting": GBTRegressor(maxIter=rounds, stepSize=0.05, maxDepth=3, seed=seed),
    }


# Grid per tunable model; None means unlimited depth.
SEARCH_SPACES: dict[str, dict[str, list[Any]]] = {
    "Random Forest": {"trees": [80, 120, 180], "depth": [None, 8, 14, 20], "min_leaf": [1, 2, 4]},
}
FOREST_SPACE: dict[str, list[Any]] = {"depth": [6, 10, 15, None], "min_leaf": [1, 2, 5]}


def sample_grid(space: Mapping[str, list[Any]], n: int, seed: int) -> list[dict[str, Any]]:
    """Seeded draw of ``n`` different grid points."""
    points = [dict(zip(space, values, strict=True)) for values in product(*space.values())]
    return random.Random(seed).sample(points, min(n, len(points)))


# --- metrics ---------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str, predicted: str, medians: bool = True) -> dict[str, float]:
    """mae, mse, rmse, r2, mape, explained variance from one aggregate, plus the median absolute error."""
    y, error = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    base = F.when(y == 0, F.lit(1.0)).otherwise(y)
    row = df.agg(
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("spread"),
        F.var_pop(error).alias("rest"),
        (F.avg(F.abs(error / base)) * 100).alias("mape"),
    ).first()
    if not row["n"]:
        raise ValueError("no rows to measure: the part is empty or has no known target")
    spread = row["spread"] or None
    out = {
        "mae": row["mae"],
        "mse": row["mse"],
        "rmse": row["mse"] ** 0.5,
        "r2": 1 - row["mse"] / spread if spread else 0.0,
        "mape": row["mape"],
        "explained_variance": 1 - row["rest"] / spread if spread else 0.0,
    }
    if medians:
        errors = df.select(F.abs(error).alias("e"))
        out["median_absolute_error"] = quantiles(errors, {"e": [0.5]})["e"][0.5]
    return out


def metrics_table(spark: SparkSession, metrics: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in metrics.items()], "metric string, value double")


# --- validation and selection ----------------------------------------------------


@dataclass(frozen=True)
class Fold:
    """One train / test pair with its fitted preprocessing."""

    train: DataFrame
    test: DataFrame
    preprocessor: Preprocessor


def make_folds(df: DataFrame, features: list[str], folds: int, seed: int, key: str = "asset_id") -> list[Fold]:
    """Hash folds; preprocessing is fitted once per fold and shared by all models."""
    place = hash_fold(folds, seed, key)
    pairs = [(df.where(place != i), df.where(place == i)) for i in range(folds)]
    fits = in_parallel(df.sparkSession, [partial(fit_preprocessor, train, features) for train, _ in pairs])
    return [Fold(train, test, fit) for (train, test), fit in zip(pairs, fits, strict=True)]


def cross_validate(folds: list[Fold], features: list[str], target: str, estimator: Estimator) -> dict[str, float]:
    """Mean rmse, mae and r2 over the folds, which are fitted side by side."""

    def judge(fold: Fold) -> dict[str, float]:
        model = fit_model(fold.train, features, target, estimator, fold.preprocessor)
        return regression_metrics(model.predict(fold.test), target, "prediction", medians=False)

    scores = in_parallel(folds[0].train.sparkSession, [partial(judge, fold) for fold in folds])
    return {k: sum(s[k] for s in scores) / len(scores) for k in ("rmse", "mae", "r2")}


HOLDOUT_METRICS = ["mae", "mse", "rmse", "r2", "mape", "median_absolute_error", "explained_variance"]
LEADERBOARD_SCHEMA = (
    "model string, cv_rmse_mean double, cv_mae_mean double, cv_r2_mean double, repeated_cv_rmse_mean double, "
    + ", ".join(f"holdout_{m} double" for m in HOLDOUT_METRICS)
)


def rank_leaderboard(rows: DataFrame) -> DataFrame:
    """Best first: r2 down, then rmse and mae up."""
    return rows.orderBy(F.desc("holdout_r2"), "holdout_rmse", "holdout_mae")


def holdout_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, key: str = "asset_id"):
    """(train, test) by key hash."""
    share = hash_share(seed, key)
    return df.where(share >= test_size), df.where(share < test_size)


def random_search(
    folds: list[Fold],
    features: list[str],
    target: str,
    build: Callable[..., Estimator],
    space: Mapping[str, list[Any]],
    n_iter: int,
    seed: int = 42,
) -> tuple[dict[str, Any], float]:
    """(best parameters, their mean rmse) among a seeded sample of the grid."""
    best: tuple[dict[str, Any], float] | None = None
    for point in sample_grid(space, n_iter, seed):
        rmse = cross_validate(folds, features, target, build(**point, seed=seed))["rmse"]
        if best is None or rmse < best[1]:
            best = (point, rmse)
    return best


def tune_random_forest(
    df: DataFrame, target: str = C.SOURCE_TARGET, folds: int = 3, n_iter: int = 6, seed: int = 42, trees: int = 300
) -> tuple[LossModel, dict[str, Any], float]:
    """Search depth and leaf size of a forest, refit the best on all rows."""
    features = numeric_columns(df, [target, "asset_id"])
    build = lambda **point: random_forest(trees=trees, **point)
    params, rmse = random_search(make_folds(df, features, folds, seed), features, target, build, FOREST_SPACE, n_iter)
    return fit_model(df, features, target, build(**params, seed=seed)), params, rmse


@dataclass
class TrainingResult:
    """Everything the later reports need."""

    best_name: str
    best_model: LossModel
    leaderboard: DataFrame
    metrics: dict[str, float]
    tuning: dict[str, Any]
    train: DataFrame
    scored: DataFrame  # test rows with prediction and residual


def train_and_select(
    df: DataFrame,
    features: list[str],
    target: str = C.TARGET,
    registry: Mapping[str, Estimator] | None = None,
    spaces: Mapping[str, Mapping[str, list[Any]]] = SEARCH_SPACES,
    test_size: float = 0.2,
    folds: int = 3,
    repeats: int = 2,
    search_iter: int = 3,
    seed: int = 42,
) -> TrainingResult:
    """Compare the registry by cross validation and holdout, tune, keep the best.

    ``df`` should be a written table with the id, the features and the target.
    """
    spark = df.sparkSession
    registry = dict(registry or model_registry(seed))
    train, test = holdout_split(df, test_size, seed)
    base = make_folds(train, features, folds, seed)
    repeated = [f for r in range(repeats) for f in make_folds(train, features, folds, seed + 1 + r)]
    shared = fit_preprocessor(train, features)

    rows, fitted = [], {}

    def judged(name: str, model: LossModel, cv: Mapping[str, float | None], repeated_rmse: float | None) -> tuple:
        held = regression_metrics(model.predict(test), target, "prediction")
        fitted[name] = model
        return (
            name, cv.get("rmse"), cv.get("mae"), cv.get("r2"), repeated_rmse, *[float(held[m]) for m in HOLDOUT_METRICS],
        )

    for name, estimator in registry.items():
        cv = cross_validate(base, features, target, estimator)
        again = cross_validate(repeated, features, target, estimator)["rmse"] if repeated else None
        rows.append(judged(name, fit_model(train, features, target, estimator, shared), cv, again))

    board = rank_leaderboard(spark.createDataFrame(rows, LEADERBOARD_SCHEMA))
    top = board.first()["model"]
    candidate = top if top in spaces else next((n for n in spaces if n in registry), None)
    tuning: dict[str, Any] = {"candidate": candidate or top}
    if candidate:
        params, rmse = random_search(base, features, target, random_forest, spaces[candidate], search_iter, seed)
        tuning |= {"best_params": params, "best_cv_rmse": rmse}
        tuned = fit_model(train, features, target, random_forest(**params, seed=seed), shared)
        row = judged(f"{candidate} Tuned", tuned, {"rmse": rmse}, None)
        board = rank_leaderboard(board.unionByName(spark.createDataFrame([row], LEADERBOARD_SCHEMA)))

    best_name = board.first()["model"]
    best = fitted[best_name]
    residual = F.col(target).cast("double") - F.col("prediction")
    scored = materialize(best.predict(test).withColumn("residual", residual), "scored")
    metrics = regression_metrics(scored, target, "prediction")
    return TrainingResult(best_name, best, board, metrics, tuning, train, scored)


def prediction_intervals(df: DataFrame, predicted: str = "prediction", residual: str = "residual") -> DataFrame:
    """Add p05 and p95 from the residual quantiles, not below zero."""
    marks = quantiles(df, {residual: [0.05, 0.95]})[residual]
    bound = lambda p: F.greatest(F.col(predicted) + F.lit(marks[p]), F.lit(0.0))
    return df.withColumns({"p05": bound(0.05), "p95": bound(0.95)})


def train_regressor(df: DataFrame, target: str = C.SOURCE_TARGET, estimator: Estimator | None = None) -> LossModel:
    """A forest on all number columns, without preprocessing."""
    features = numeric_columns(df, [target, "asset_id"])
    model = LossModel(features, target, None, None, log_target=False)
    data = model.prepared(df).select("features", F.col(target).cast("double").alias("label"))
    model.regressor = (estimator or random_forest()).fit(data)
    return model


# --- stacking --------------------------------------------------------------------


@dataclass
class StackedModel:
    """Base regressors whose predictions feed a ridge regression."""

    features: list[str]
    bases: dict[str, Transformer]
    top: Transformer

    def _inputs(self, df: DataFrame) -> DataFrame:
        out = VectorAssembler(inputCols=self.features, outputCol="_features").transform(df)
        return with_base_predictions(out, self.bases).drop("_features")

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        names = [f"_base_{n}" for n in self.bases]
        stacked = VectorAssembler(inputCols=names, outputCol="_stack").transform(self._inputs(df))
        scored = self.top.setFeaturesCol("_stack").setPredictionCol(output).transform(stacked)
        return scored.drop("_stack", *names)


def with_base_predictions(df: DataFrame, bases: Mapping[str, Transformer]) -> DataFrame:
    out = df
    for name, model in bases.items():
        out = model.setFeaturesCol("_features").setPredictionCol(f"_base_{name}").transform(out)
    return out


def stacking_regressor(
    df: DataFrame,
    features: list[str],
    target: str = C.SOURCE_TARGET,
    folds: int = 5,
    seed: int = 42,
    bases: Mapping[str, Estimator] | None = None,
    ridge: float = 1.0,
) -> StackedModel:
    """Fit the bases on all rows and the ridge on out-of-fold base predictions."""
    bases = dict(bases or {"rf": random_forest(200), "en": elastic_net()})
    data = VectorAssembler(inputCols=features, outputCol="_features").transform(df)
    data = data.select("asset_id", "_features", F.col(target).cast("double").alias("label"))
    place = hash_fold(folds, seed)

    def fitted(rows: DataFrame) -> dict[str, Transformer]:
        return {n: e.copy().setFeaturesCol("_features").fit(rows) for n, e in bases.items()}

    # Each fold is written as soon as it is predicted, so at most two folds' models are held at a time.
    def predicted(i: int) -> DataFrame:
        return materialize(with_base_predictions(data.where(place == i), fitted(data.where(place != i))).drop("_features"), "stack")

    parts = in_parallel(df.sparkSession, [partial(predicted, i) for i in range(folds)], 2)
    unseen = parts[0]
    for part in parts[1:]:
        unseen = unseen.unionByName(part)
    stacked = VectorAssembler(inputCols=[f"_base_{n}" for n in bases], outputCol="_stack").transform(unseen)
    # The penalty is per row here, while alpha counts once for all rows.
    top = PenalisedLinear(ridge / max(stacked.count(), 1), 0.0, features_col="_stack")
    return StackedModel(features, fitted(data), top.fit(stacked))


# --- importance and diagnostics --------------------------------------------------


def importance_report(spark: SparkSession, importances: Mapping[str, float]) -> DataFrame:
    """(feature, importance), largest first; empty for models that have none."""
    rows = [(c, float(v)) for c, v in importances.items()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def _bucketed_shuffle(df: DataFrame, features: list[str], seed: int, rows: int, key: str) -> DataFrame:
    """Add ``_shuffled``: per feature the value of another row.

    Rows are dealt into random buckets of about ten thousand and each feature
    moves one place along a random circle inside the bucket, so every value is
    used exactly once and no task has to order the whole table.
    """
    buckets = max(1, -(-rows // 10_000))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))
    dealt = df.withColumn("_bucket", place)
    moved: list[Column] = []
    for i, c in enumerate(features):
        circle = Window.partitionBy("_bucket").orderBy(F.xxhash64(F.col(key), F.lit(seed), F.lit(i)), F.col(key))
        start = F.first(F.col(c)).over(circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        follows = F.lead(F.lit(1)).over(circle).isNotNull()
        moved.append(F.when(follows, F.lead(F.col(c)).over(circle)).otherwise(start).cast("double"))
    return dealt.withColumn("_shuffled", F.array(*moved)).drop("_bucket")


def permutation_importance(
    model: LossModel, df: DataFrame, repeats: int = 5, seed: int = 42, key: str = "asset_id", top: int = 20
) -> DataFrame:
    """(feature, importance): mean rise of the rmse when one feature is shuffled.

    One job per repeat scores all features: every row is repeated per feature with
    that feature replaced.
    """
    spark, features, target = df.sparkSession, model.features, model.target
    base = regression_metrics(model.predict(df), target, "prediction", medians=False)["rmse"]
    rows = df.count()
    rises = {c: 0.0 for c in features}
    for r in range(repeats):
        mixed = _bucketed_shuffle(df.select(key, target, *features), features, seed + r, rows, key)
        varied = mixed.withColumn("_which", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))))
        swapped = {
            c: F.when(F.col("_which") == i, F.col("_shuffled")[i]).otherwise(F.col(c).cast("double"))
            for i, c in enumerate(features)
        }
        error = F.col(target).cast("double") - F.col("prediction")
        found = (
            model.predict(varied.withColumns(swapped))
            .groupBy("_which")
            .agg(F.sqrt(F.avg(error * error)).alias("rmse"))
            .collect()
        )
        for row in found:
            rises[features[row["_which"]]] += (row["rmse"] - base) / repeats
    return importance_report(spark, rises).limit(top)


def learning_curve(
    df: DataFrame,
    features: list[str],
    target: str,
    estimator: Estimator,
    sizes: Iterable[float] = (0.2, 0.4, 0.6, 0.8, 1.0),
    folds: int = 3,
    seed: int = 42,
) -> DataFrame:
    """(share, train_rows, train_rmse, validation_rmse) for growing hash shares of the training rows."""
    place, share = hash_fold(folds, seed), hash_share(seed, purpose="size")
    rows = []
    for size in sizes:
        sums = [0.0, 0.0, 0.0]
        for i in range(folds):
            part = df.where((place != i) & (share < size))
            model = fit_model(part, features, target, estimator)
            seen = regression_metrics(model.predict(part), target, "prediction", medians=False)
            unseen = regression_metrics(model.predict(df.where(place == i)), target, "prediction", medians=False)
            sums = [a + b for a, b in zip(sums, (part.count(), seen["rmse"], unseen["rmse"]), strict=True)]
        rows.append((float(size), *[s / folds for s in sums]))
    schema = "share double, train_rows double, train_rmse double, validation_rmse double"
    return df.sparkSession.createDataFrame(rows, schema)


def partial_dependence(
    model: LossModel, df: DataFrame, features: Iterable[str] | None = None, rows: int | None = None, points: int = 100,
    seed: int = 42, key: str = "asset_id",
) -> DataFrame:
    """(feature, value, prediction): mean prediction with one feature held at each grid value.

    All rows are read unless ``rows`` asks for a sample. The grid runs from the 5 % to
    the 95 % quantile and is a literal, so rows are repeated without a join.
    """
    features = list(features or model.features[:3])
    sample = df if rows is None else materialize(df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(rows), "sample")
    ends = quantiles(sample, {c: [0.05, 0.95] for c in features})
    out = None
    for c in features:
        low, high = ends[c][0.05], ends[c][0.95]
        steps = points if high > low else 1
        grid = [low + (high - low) * i / max(steps - 1, 1) for i in range(steps)]
        held = sample.drop(c).withColumn(c, F.explode(F.array(*[F.lit(float(v)) for v in grid])))
        part = (
            model.predict(held)
            .groupBy(F.lit(c).alias("feature"), F.col(c).alias("value"))
            .agg(F.avg("prediction").alias("prediction"))
        )
        out = part if out is None else out.unionByName(part)
    return out


def histogram(df: DataFrame, column: str, bins: int = 50, log_scale: bool = True) -> DataFrame:
    """(bin, low, high, count) over equal-width bins of the values or of log1p of them."""
    value = F.col(column).cast("double")
    value = F.log1p(F.greatest(value, F.lit(0.0))) if log_scale else value
    values = df.where(F.col(column).isNotNull()).select(value.alias("v"))
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if ends["low"] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, count long")
    low, high = ends["low"], ends["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("bin") * width + low).alias("low"),
        ((F.col("bin") + 1) * width + low).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
