"""Batch scoring: input checks, prediction, uncertainty, explanation, export."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import constants as C
from riskspark.functions.columns import clip, lenient_double, round_even, title_label
from riskspark.operators.attribution import attribution_of, mllib_trees, ranked_contributions
from riskspark.operators.forest import ROW, GrownForest, dealt
from riskspark.operators.train import LossModel
from riskspark.session import materialize

INF = float("inf")


class PredictionError(ValueError):
    """Unusable prediction input or settings."""


# --- input checks ----------------------------------------------------------------


def feature_rules(feature: str) -> dict[str, Any]:
    """Allowed range and kind of one model input."""
    if feature in C.UNIT_RANGE_FEATURES:
        return {"minimum": 0.0, "maximum": 1.0}
    if feature in C.BINARY_FEATURES:
        return {"minimum": 0.0, "maximum": 1.0, "binary": True}
    if feature in C.COUNT_FEATURES:
        return {"minimum": 0.0, "integer": True}
    if feature in C.NONNEGATIVE_FEATURES:
        return {"minimum": 0.0}
    return {}


def input_rules(df: DataFrame, features: Iterable[str]) -> list[tuple[Column, str]]:
    """(broken, message) per rule; a broken value is reported by every rule it breaks."""
    rules = []
    for c in features:
        raw, number = F.col(c), F.col(c).try_cast("double")
        absent = raw.isNull() | number.isNull() | F.isnan(number)
        if isinstance(df.schema[c].dataType, T.StringType):
            rules.append((raw.isNotNull() & number.isNull(), f"{c} must be numeric."))
        rules.append((absent, f"{c} contains missing or NaN value(s)."))
        rules.append((absent | (F.abs(number) == INF), f"{c} must be finite."))
        known = ~absent & (F.abs(number) != INF)
        limits = feature_rules(c)
        low, high = limits.get("minimum"), limits.get("maximum")
        real = ~absent
        if low is not None:
            rules.append((real & (number < low), f"{c} must be greater than or equal to {low}."))
        if high is not None:
            rules.append((real & (number > high), f"{c} must be less than or equal to {high}."))
        if limits.get("binary"):
            rules.append((absent | ~number.isin(0.0, 1.0), f"{c} must be binary: 0 or 1."))
        if limits.get("integer"):
            rules.append((absent | ~known | (number % 1 != 0), f"{c} must be an integer count."))
    return [(F.coalesce(r, F.lit(False)), m) for r, m in rules]


def require_features(df: DataFrame, features: Iterable[str]) -> None:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise PredictionError("Missing required feature(s): " + ", ".join(missing))


def validate_input(df: DataFrame, features: Iterable[str] = tuple(C.MODEL_FEATURES), shown: int = 8) -> DataFrame:
    """The table with double features; raises with the first broken rules, found in one aggregate."""
    features = list(features)
    require_features(df, features)
    rules = input_rules(df, features)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(r).alias(f"rule{i}") for i, (r, _) in enumerate(rules)]
    ).first()
    if not found["rows"]:
        raise PredictionError("Input data is empty.")
    errors = [m for i, (_, m) in enumerate(rules) if found[f"rule{i}"]]
    if errors:
        more = f" Plus {len(errors) - shown} more validation error(s)." if len(errors) > shown else ""
        raise PredictionError(" ".join(errors[:shown]) + more)
    return as_numbers(df, features)


def as_numbers(df: DataFrame, features: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in features})


def split_input(df: DataFrame, features: Iterable[str] = tuple(C.MODEL_FEATURES)) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with ``reasons``): lets one bad row not stop a large batch."""
    features = list(features)
    require_features(df, features)
    reasons = F.array_compact(F.array(*[F.when(r, F.lit(m)) for r, m in input_rules(df, features)]))
    judged = df.withColumn("reasons", reasons)
    good = as_numbers(judged.where(F.size("reasons") == 0).drop("reasons"), features)
    return good, judged.where(F.size("reasons") > 0)


# --- uncertainty -----------------------------------------------------------------


def training_distance(profiles: Mapping[str, Mapping[str, float]], features: Iterable[str]) -> Column:
    """Mean over the features of the distance from the median in IQRs, plus 2 in the tails, at most 12 each."""
    features = list(features)
    if not profiles:
        return F.lit(0.0)
    parts = []
    for c in features:
        p = profiles.get(c, {})
        value = F.col(c).cast("double")
        away = F.abs(value - F.lit(float(p.get("median", 0.0)))) / F.lit(max(float(p.get("iqr", 1.0)), 1e-6))
        tail = (value < F.lit(float(p.get("p01", -INF)))) | (value > F.lit(float(p.get("p99", INF))))
        parts.append(clip(away + F.when(tail, F.lit(2.0)).otherwise(F.lit(0.0)), high=12))
    return reduce(lambda a, b: a + b, parts) / len(parts)


def uncertainty(predicted: Column, distance: Column, mape: float, spread: Column | None = None) -> Column:
    """Larger of the staged spread and the error floor, widened with the distance."""
    floor = F.greatest(predicted * max(mape / 100, 0.01), F.lit(1.0))
    base = floor if spread is None else F.greatest(spread, floor)
    return base * (F.least(distance, F.lit(12.0)) / 2.5 + 1)


def confidence_score(predicted: Column, doubt: Column, mae: float) -> Column:
    """0-100, falling with uncertainty and interval width relative to the prediction."""
    scale = F.greatest(predicted, F.lit(float(mae)))
    score = F.exp(-doubt / scale) * F.exp(doubt * (1.96 * 2.0) / scale * -0.08) * 100
    return round_even(clip(score, 0, 100), 2)


def check_thresholds(raw: Mapping[str, Any]) -> dict[str, float]:
    """The four level bounds, non-negative and never falling."""
    given = raw.get("thresholds", raw)
    missing = [k for k in C.RISK_LABELS if k not in given]
    if missing:
        raise PredictionError("Missing risk threshold(s): " + ", ".join(missing))
    bounds = {k: float(given[k]) for k in C.RISK_LABELS}
    values = list(bounds.values())
    if any(v != v or v < 0 for v in values) or values != sorted(values):
        raise PredictionError("Risk thresholds must be non-negative and increasing.")
    return bounds


def risk_level(predicted: Column, thresholds: Mapping[str, float] = C.RISK_THRESHOLDS) -> Column:
    """A loss on a bound belongs to the higher level."""
    chain = None
    for key, label in C.RISK_LABELS.items():
        hit = predicted < F.lit(float(thresholds[key]))
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise("Critical")


# --- staged spread of a boosted model --------------------------------------------


def tree_tables(regressor: Any) -> list[dict[str, np.ndarray]]:
    """Node arrays per tree: split feature, threshold, children and value. Small, read once on the driver."""
    tables = []
    for tree in regressor._java_obj.trees():
        feature, threshold, left, right, value = [], [], [], [], []

        def add(node: Any) -> int:
            at = len(value)
            for column in (feature, threshold, left, right):
                column.append(-1)
            value.append(node.prediction())
            if node.subtreeDepth() > 0:
                split = node.split()
                feature[at], threshold[at] = split.featureIndex(), split.threshold()
                left[at] = add(node.leftChild())
                right[at] = add(node.rightChild())
            return at

        add(tree.rootNode())
        tables.append(
            {
                "feature": np.array(feature),
                "threshold": np.array(threshold, dtype=float),
                "left": np.array(left),
                "right": np.array(right),
                "value": np.array(value, dtype=float),
            }
        )
    return tables


def _tree_values(tree: Mapping[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), dtype=int)
    while True:
        inner = np.flatnonzero(tree["feature"][at] >= 0)
        if not inner.size:
            return tree["value"][at]
        nodes = at[inner]
        goes_left = x[inner, tree["feature"][nodes]] <= tree["threshold"][nodes]
        at[inner] = np.where(goes_left, tree["left"][nodes], tree["right"][nodes])


def staged_spread(model: LossModel, df: DataFrame, output: str = "staged_spread") -> DataFrame:
    """Add the standard deviation of the later half of the staged predictions, on the loss scale.

    MLlib does not expose staged predictions, so the trees are walked column-wise
    over Arrow batches of the input vectors; other columns stay where they are. The trees
    travel with the task.
    """
    trees = tree_tables(model.regressor)
    weights = list(model.regressor.treeWeights)
    start = max(0, int(len(trees) * 0.5))
    logged = model.log_target

    @F.pandas_udf("double")
    def spread(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=float)
        return pd.Series(walked_spread(trees, weights, np.stack(vectors.to_numpy()), start, logged))

    inputs = model.prepared(df)
    return inputs.withColumn(output, spread(vector_to_array("features"))).drop("features")


def walked_spread(trees: list[Mapping[str, np.ndarray]], weights: list[float], x: np.ndarray, start: int, logged: bool) -> np.ndarray:
    """Per row of ``x``, the deviation of the running sums of tree values from stage ``start`` on."""
    stages = np.cumsum([w * _tree_values(t, x) for t, w in zip(trees, weights, strict=True)], axis=0)
    return np.std((np.expm1(stages) if logged else stages)[start:], axis=0)


# --- explanation -----------------------------------------------------------------


def label_of(feature: str) -> str:
    return C.FEATURE_LABELS.get(feature, title_label(feature))


def contributions(importances: Mapping[str, float]) -> Column:
    """array<struct<feature,label,contribution,impact>>: value times importance, largest size first.

    Equal sizes keep the later feature first.
    """
    entries = []
    for i, (c, weight) in enumerate(importances.items()):
        part = F.col(c).cast("double") * F.lit(float(weight))
        entries.append(
            F.struct(
                F.abs(part).alias("size"),
                F.lit(i).alias("place"),
                F.lit(c).alias("feature"),
                F.lit(label_of(c)).alias("label"),
                round_even(part, 6).alias("contribution"),
                F.when(part >= 0, "Increases risk").otherwise("Decreases risk").alias("impact"),
            )
        )
    ranked = F.reverse(F.array_sort(F.array(*entries)))
    keep = lambda e: F.struct(e["feature"], e["label"], e["contribution"], e["impact"])
    return F.transform(ranked, keep)


def top_label(explained: Column, place: int) -> Column:
    return F.coalesce(F.get(explained, F.lit(place))["label"], F.lit(""))


# --- export and the whole step ---------------------------------------------------


def export_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """Input columns under their exported names: CVSS on 0-10, negative raw counts as 0."""
    out = []
    for c in columns or df.columns:
        name, kind = C.FEATURE_EXPORTS.get(c, (f"derived_feature__{c}", "derived"))
        value = F.col(c)
        if kind == "cvss_0_to_10":
            value = round_even(lenient_double(value) * 10, 2)
        elif c in C.CLIPPED_EXPORTS:
            value = clip(lenient_double(value), low=0)
        elif kind == "scaled":
            value = lenient_double(value)
        out.append(value.alias(name))
    return out


def add_scores(
    df: DataFrame,
    features: Iterable[str],
    importances: Mapping[str, float],
    metrics: Mapping[str, float],
    profiles: Mapping[str, Mapping[str, float]],
    as_of: str,
    thresholds: Mapping[str, float] = C.RISK_THRESHOLDS,
    spread: str | None = None,
    currency: str = "USD",
    predicted: str = "predicted_loss",
    explained: str | None = None,
) -> DataFrame:
    """Export view plus the ten result columns for rows that carry ``predicted_loss``.

    ``explained`` names an array of per-row attributions in the order of ``features``
    (tree models); without it, value times importance stands for the contribution.
    """
    features = list(features)
    inputs = [c for c in df.columns if c not in {predicted, spread, explained}]
    loss = F.col(predicted)
    doubt = uncertainty(
        loss,
        training_distance(profiles, features),
        float(metrics.get("mape") or 3.0),
        F.col(spread) if spread else None,
    )
    why = ranked_contributions(F.col(explained), features, {c: label_of(c) for c in features}) if explained else contributions(importances)
    staged = df.withColumns({"_doubt": doubt, "_why": why})
    doubt, why = F.col("_doubt"), F.col("_why")
    return staged.select(
        *export_columns(df, inputs),
        loss,
        F.lit(currency).alias("currency"),
        risk_level(loss, thresholds).alias("risk_level"),
        confidence_score(loss, doubt, float(metrics.get("mae") or 1.0)).alias("confidence_score"),
        F.greatest(loss - doubt * 1.96, F.lit(0.0)).alias("prediction_interval_lower"),
        (loss + doubt * 1.96).alias("prediction_interval_upper"),
        *[top_label(why, i).alias(f"top_feature_{i + 1}") for i in range(3)],
        F.lit(as_of).alias("timestamp"),
    )


def predict_table(
    model: LossModel,
    df: DataFrame,
    metrics: Mapping[str, float],
    profiles: Mapping[str, Mapping[str, float]],
    as_of: str,
    thresholds: Mapping[str, float] = C.RISK_THRESHOLDS,
    currency: str = "USD",
    validate: bool = True,
) -> DataFrame:
    """Check, predict, bound, explain and export a table; one map stage after the check."""
    rows = validate_input(df, model.features) if validate else df
    scored = model.predict(rows, "predicted_loss").withColumn("predicted_loss", F.greatest("predicted_loss", F.lit(0.0)))
    spread = None
    if hasattr(model.regressor, "treeWeights") and type(model.regressor).__name__.startswith("GBT"):
        spread = "staged_spread"
        scored = staged_spread(model, scored, spread)
    importances = model.importances(coefficients=False) or {c: 1.0 for c in model.features}
    explained = None
    if is_tree_model(model.regressor):
        # Path-dependent tree attributions of each row on the model's own input vector.
        trees, weights = mllib_trees(model.regressor)
        explained = "_attributions"
        vectors = vector_to_array("features")
        scored = model.prepared(scored).withColumn(explained, attribution_of(vectors, len(model.features), trees, weights)).drop("features")
    elif isinstance(model.regressor, GrownForest):
        explained = "_attributions"
        named = materialize(model.prepared(scored).withColumn(ROW, F.monotonically_increasing_id()), "explained")
        sums = model.regressor.attributions(materialize(dealt(named, vector_to_array("features")), "explained-rows"))
        scored = named.drop("features").join(sums.withColumnRenamed("sums", explained), ROW).drop(ROW)
    return add_scores(
        scored, model.features, importances, metrics, profiles, as_of, check_thresholds(thresholds), spread, currency, explained=explained
    )


def is_tree_model(regressor: Any) -> bool:
    return type(regressor).__name__ in {"GBTRegressionModel", "RandomForestRegressionModel", "DecisionTreeRegressionModel"}


