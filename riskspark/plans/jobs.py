"""The four jobs, composed from the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import present
from riskspark.operators import assets, features, impute, loss, merge, pentest, profile, scale, score, select, threat, train
from riskspark.session import materialize
from riskspark.sources import tables


# --- threat ----------------------------------------------------------------------


def clean_threats(
    raw: DataFrame, as_of: str, tie_break: Iterable[str] | None = None, keep: Iterable[str] | None = None
) -> DataFrame:
    """Validated, typed rows with one row per dedup key; ``keep`` narrows the rows before their shuffle, where ``tie_break`` is still needed."""
    accepted, _ = threat.validate_threats(raw, as_of)
    typed = threat.coerce_types(accepted)
    if keep is not None:
        typed = typed.select(*present(typed, dict.fromkeys([*keep, *(tie_break or [])])))
    out = threat.deduplicate(typed, tie_break=tie_break)
    return out if keep is None else out.select(*present(out, dict.fromkeys(keep)))


# What the roll-up reads, directly or through derived columns.
ROLLED_UP = [
    *C.DEDUP_KEYS, "last_seen", "cvss_score", "epss_score", "severity", "attack_vector", "kev_listed", "exploit_count",
    "affected_systems_count", "published_date", "first_seen", "days_since_published", "days_since_first_seen",
    "days_active", "threat_actor",
]


def threat_job(
    raw: DataFrame,
    as_of: str,
    normalize: bool = True,
    severities: Iterable[str] | None = None,
    tie_break: Iterable[str] | None = None,
    k: int = 5,
) -> DataFrame:
    """Raw vulnerability rows to one row per asset.

    The deduplicated rows are written once, since the imputer and the roll-up both
    read them; columns nobody reads are left out before the shuffle (rows that tie on
    all others are interchangeable). Outlier flags never reach the asset row and are not computed, counts
    hold no gaps after cleaning and need no median pass. Rows are rolled up before
    scaling: the scaler is learned from the per-asset moments and applied to the
    aggregates, which gives the same values as scaling every row first and saves
    two passes over all rows.
    """
    clean = materialize(clean_threats(raw, as_of, tie_break, ROLLED_UP), "clean")
    imputer = impute.fit_imputer(clean, k, median_columns=())
    if severities is None and "severity" in clean.columns:
        severities = threat.observed_severities(clean)
    rows = threat.engineer_threats(imputer.transform(clean), as_of)
    if not normalize:
        return threat.aggregate_assets(rows, severities=severities)
    minmax, standard = present(rows, C.MINMAX_COLUMNS), present(rows, C.STANDARD_COLUMNS)
    rolled = threat.aggregate_assets(rows, severities=severities, ends=minmax, moments=standard)
    rolled = materialize(rolled, "rolled")
    scaler = scale.scaler_from_moments(rolled, minmax, standard)
    out = scale.rescale_aggregates(rolled, scaler)
    return out.select(*[c for c in out.columns if not c.startswith("_")])


def threat_job_stepwise(
    raw: DataFrame,
    as_of: str,
    severities: Iterable[str] | None = None,
    tie_break: Iterable[str] | None = None,
    k: int = 5,
) -> DataFrame:
    """The same result stage by stage: clean, flag, impute, engineer, scale rows, roll up."""
    clean = materialize(clean_threats(raw, as_of, tie_break), "clean")
    flagged = threat.fit_outliers(clean).transform(clean)
    rows = threat.engineer_threats(impute.fit_imputer(flagged, k).transform(flagged), as_of)
    rows = materialize(rows, "engineered")
    return threat.aggregate_assets(scale.fit_scaler(rows).transform(rows), severities=severities)


def run_threats(spark: SparkSession, path: str, output: str, as_of: str, **options: Any) -> DataFrame:
    """Raw CSV to the saved per-asset table."""
    out = threat_job(tables.load_threats(spark, path), as_of, **options)
    tables.write_table(out, output)
    return tables.read_table(spark, output)


# --- assets ----------------------------------------------------------------------


def asset_job(raw: DataFrame, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(enriched assets, rejected rows)."""
    typed = assets.normalise_types(raw)
    if not validate:
        return assets.enrich_assets(typed), raw.sparkSession.createDataFrame([], "asset_id string, reason string")
    accepted, rejected = assets.validate_assets(typed)
    return assets.enrich_assets(accepted), rejected


def load_assets(
    spark: SparkSession, path: str, fmt: str | None = None, validate: bool = True, **options: Any
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of an asset file; an error if nothing is accepted."""
    typed = assets.normalise_types(tables.read_assets(spark, path, fmt, **options))
    if not validate:
        return typed, spark.createDataFrame([], "asset_id string, reason string")
    accepted, rejected = assets.validate_assets(typed)
    if accepted.isEmpty():
        raise ValueError("All rows were rejected during schema validation. Check the source file format.")
    return accepted, rejected


def run_assets(spark: SparkSession, path: str, output_dir: str) -> DataFrame:
    """Asset file to clean parquet, clean CSV and a JSON summary; returns the enriched table."""
    accepted, rejected = load_assets(spark, path)
    parquet = tables.save_assets(assets.enrich_assets(accepted), f"{output_dir}/assets_clean.parquet")
    enriched = spark.read.parquet(parquet)
    tables.save_assets(enriched, f"{output_dir}/assets_clean.csv")
    rejected.write.mode("overwrite").json(f"{output_dir}/assets_rejected.jsonl")
    summary = assets.summary_to_dict(assets.inventory_summary(enriched, rejected))
    tables.write_json_report(spark, summary, f"{output_dir}/assets_summary.json")
    return enriched


# --- pentest, loss, merge --------------------------------------------------------


def pentest_job(findings: DataFrame, output: str | None = None) -> DataFrame:
    """Findings to scored assets."""
    out = pentest.score_pentest_risk(pentest.build_pentest_features(findings))
    if output:
        tables.write_table(out, output)
    return out


def loss_job(rows: DataFrame, costs: Mapping[str, Any] = C.COSTS, output: str | None = None) -> DataFrame:
    """Asset rows to priced asset rows."""
    out = loss.estimate_losses(rows, costs)
    if output:
        tables.write_table(out, output)
    return out


def integration_job(parts: Iterable[DataFrame | None], output: str | None = None, **options: Any) -> DataFrame | None:
    """Merge per-asset tables."""
    out = merge.merge_on_asset_id(parts, **options)
    if output and out is not None:
        tables.write_table(out, output)
    return out


def portfolio_job(
    threats: DataFrame, findings: DataFrame, inventory: DataFrame, as_of: str, tie_break: Iterable[str] | None = None
) -> DataFrame:
    """Threat, pentest and inventory rows joined per asset and priced: one row per asset with threats.

    The inventory is spread and written before it is checked and enriched, as that costs much per row and
    its files, being small, would be worked through by one task. (Only spread, Spark moves the checks before it.)
    """
    rolled = threat_job(threats, as_of, tie_break=tie_break)
    spread = materialize(inventory.repartition("asset_id"), "inventory") if "asset_id" in inventory.columns else inventory
    enriched, _ = asset_job(spread)
    merged = integration_job([rolled, pentest_job(findings), enriched], check=False)
    return loss_job(merged)


# --- training and prediction -----------------------------------------------------


@dataclass
class MlResult:
    """Outcome of the training job."""

    selected: list[str]
    selection: dict[str, Any]
    training: train.TrainingResult
    profile: DataFrame
    quality: DataFrame
    feature_profiles: dict[str, dict[str, float]]


def ml_job(
    df: DataFrame,
    target: str = C.TARGET,
    source_target: str = C.SOURCE_TARGET,
    id_column: str = "asset_id",
    output: str | None = None,
    registry: Mapping[str, Estimator] | None = None,
    selection: Mapping[str, Any] | None = None,
    training: Mapping[str, Any] | None = None,
) -> MlResult:
    """Check, profile, engineer, select, train and save.

    The table (one row per asset) is written first, as checks and profiles pass over it several times.
    """
    spark = df.sparkSession
    data = materialize(tables.with_target(df, target, source_target), "model-table")
    profile.validate_schema(data, target, id_column)
    profiled = profile.profile_table(data, target)
    quality = profile.quality_report(data, target, id_column)

    engineered = features.build_cyber_features(data).withColumn("_target", F.col(target).cast("double"))
    matrix = materialize(
        engineered.select(
            F.col(id_column).alias("asset_id"),
            *[c for c in select.remove_leakage(engineered, id_column=id_column).columns if c != "_target"],
            F.col("_target").alias(target),
        ),
        "matrix",
    )
    selected, report = select.select_features(matrix.drop("asset_id"), target, **(selection or {}))
    narrow = matrix.select("asset_id", *selected, target)
    result = train.train_and_select(narrow, selected, target, registry, **(training or {}))
    profiles = profile.feature_profile(narrow, selected)
    if output:
        result.best_model.save(spark, f"{output}/model")
        result.leaderboard.coalesce(1).write.mode("overwrite").csv(f"{output}/leaderboard", header=True)
        intervals = train.prediction_intervals(result.scored).select("prediction", "p05", "p95")
        intervals.write.mode("overwrite").csv(f"{output}/prediction_intervals", header=True)
        for name, content in {
            "metrics": result.metrics,
            "feature_selection_report": report,
            "feature_list": {"features": selected, "target": target},
            "feature_profiles": profiles,
            "tuning": result.tuning,
            "training_config": {"target": target, "selection": selection or {}, "training": training or {}},
        }.items():
            tables.write_json_report(spark, content, f"{output}/{name}.json")
        profiled.coalesce(1).write.mode("overwrite").json(f"{output}/data_profile")
        quality.coalesce(1).write.mode("overwrite").json(f"{output}/data_quality_report")
    return MlResult(selected, report, result, profiled, quality, profiles)


def predict_job(result: MlResult, df: DataFrame, as_of: str, thresholds: Mapping[str, float] = C.RISK_THRESHOLDS) -> DataFrame:
    """Score a table with the best model of a training job."""
    model = result.training.best_model
    return score.predict_table(model, df, result.training.metrics, result.feature_profiles, as_of, thresholds)


def predict_csv(
    spark: SparkSession,
    model: train.LossModel,
    metrics: Mapping[str, float],
    profiles: Mapping[str, Mapping[str, float]],
    source: str,
    output: str,
    as_of: str,
) -> str:
    """CSV of model inputs to CSV of predictions, features first, results last."""
    tables.require_path(spark, source)
    if tables.suffix_of(source) != ".csv":
        raise score.PredictionError("CSV prediction requires a .csv input file.")
    rows = spark.read.csv(source, header=True, escape='"')
    scored = score.predict_table(model, rows, metrics, profiles, as_of)
    return tables.write_table(tables.order_prediction_columns(scored), output)
