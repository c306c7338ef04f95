import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.operators import features, profile, score, select, train
from riskspark.plans import jobs
from riskspark.sources import tables
from tests.conftest import AS_OF
from tests.helpers import by, plan_text, rows


@pytest.fixture(scope="module")
def model_rows(spark):
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(240).select(
        F.concat(F.lit("ASSET-"), i).alias("asset_id"),
        (i % 17 / 17.0).alias("a"),
        (i * 7 % 31).cast("double").alias("b"),
        noise.alias("c"),
        F.when(i % 20 != 0, i % 5).cast("double").alias("d"),
        (F.exp(i % 17 / 5.0) * 1000 + i * 7 % 31 * 100).alias(C.TARGET),
    ).cache()


NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def boosted(spark, model_rows):
    return train.fit_model(model_rows, NAMES, C.TARGET, train.model_registry(rounds=15)["Gradient Boosting"])


# --- checks and profiles ---------------------------------------------------------


def test_validate_schema(spark):
    good = spark.createDataFrame([("a", 1.0, 0.1, 2, 1, 5.0)], "asset_id string, cvss_score_max double, epss_score_max double, vuln_count int, unique_cve_count int, financial_loss_usd double")
    assert profile.validate_schema(good)["rows"] == 1
    bad = spark.createDataFrame([(-1.0,), (math.inf,), (None,)], "financial_loss_usd double")
    with pytest.raises(ValueError) as err:
        profile.validate_schema(bad)
    for part in ("id column", "cvss_score_max", "1 null", "infinite", "negative"):
        assert part in str(err.value)


def test_profile_table(spark, model_rows):
    got = {(r["section"], r["item"]): r["value"] for r in rows(profile.profile_table(model_rows))}
    want = model_rows.toPandas()[C.TARGET].describe(percentiles=[0.01, 0.25, 0.5, 0.75, 0.95, 0.99])
    for item, value in want.items():
        assert got["target_distribution", item] == pytest.approx(value)
    assert got["missing_values", "d"] == 12 and got["shape", "columns"] == 6 and got["shape", "numeric_columns"] == 5


def test_quality_report(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0, None if i == 3 else 1.0, "x") for i in range(20)] + [(500.0, 1000.0, 5.0, 9.0, "x")], "a double, b double, flat double, holes double, t string")
    got = {(r["section"], r["item"], r["other"]): r["value"] for r in rows(profile.quality_report(df))}
    assert got["missing_by_column", "holes", None] == 1
    assert got["outliers_iqr", "a", None] == 1 and got["outliers_iqr", "flat", None] == 0 and got["outliers_iqr", "holes", None] == 0
    assert got["high_correlation_pairs", "a", "b"] == pytest.approx(1.0)
    limited = profile.quality_report(df, threshold=0.5, pairs=1)
    assert limited.where("section = 'high_correlation_pairs'").count() == 1


def test_feature_profile(spark, model_rows):
    p = profile.feature_profile(model_rows, ["b", "d"])
    b = model_rows.toPandas()["b"]
    assert p["b"]["p05"] == pytest.approx(b.quantile(0.05)) and p["b"]["iqr"] == pytest.approx(b.quantile(0.75) - b.quantile(0.25))
    assert p["b"]["min"] == 0 and p["b"]["max"] == 30
    flat = profile.feature_profile(spark.createDataFrame([(1.0,)], "z double"), ["z"])
    assert flat["z"]["iqr"] == 1e-6
    assert rows(profile.profile_rows(model_rows, ["b"]))[0]["feature"] == "b"


# --- features --------------------------------------------------------------------


def test_features_without_inputs_are_zero(spark):
    r = rows(features.build_cyber_features(spark.createDataFrame([("a",)], "asset_id string")))[0]
    assert all(r[c] == 0 for c in features.cyber_features(spark.range(1))) and r["risk_percentile"] == 1.0


def test_feature_values(spark):
    df = spark.createDataFrame(
        [(0.5, 0.25, 0.2, 3, 2, 4, 10, 1, 2, 1, 1, 2, 5.0, 0.8, 0.4, 0.3, 0.1, -1.0)],
        "cvss_score_max double, cvss_score_mean double, epss_score_max double, vuln_count int, unique_cve_count int, exploit_count_sum int, affected_systems_count_sum int, is_network_exposed_max int, kev_flag_sum int, kev_flag_max int, sev_count_critical int, sev_count_high int, days_since_published_max double, composite_risk_score_max double, composite_risk_score_mean double, epss_cvss_interaction_max double, epss_cvss_interaction_mean double, epss_score_mean double",
    )
    r = rows(features.build_cyber_features(df))[0]
    composite = 0.35 * 0.5 + 3 * 0.2 + 0.2 * 0.3 + 0.15
    want = {
        "cvss_severity_score": 0.425, "asset_criticality_encoding": math.log(11), "kev_feature_strength": math.log(3) + 1,
        "exploit_activity_score": math.log(5) * 1.2, "exposure_score": 1 + math.log(11), "threat_density": 1.5,
        "attack_surface_score": math.log(4) * 2 * 1.05, "business_risk_score": 0.8 * math.log(11), "composite_vulnerability_score": composite,
        "threat_frequency": math.log(4), "cvss_asset_criticality_interaction": 0.5 * math.log(11), "epss_exploit_count_interaction": 0.2 * math.log(5),
        "vendor_product_risk": math.log(3) * 4, "recent_threat_score": 0.8 / (1 + math.log(6)), "business_exposure_index": math.log(11) * 2,
        "weighted_risk_index": composite * (2 + math.log(3)), "asset_importance_score": math.log(14), "threat_intelligence_confidence": 0.44,
        "average_epss": 0.0, "exploit_availability": 1, "vulnerability_age": 5.0,
    }
    for c, v in want.items():
        assert r[c] == pytest.approx(v), c


def test_infinite_becomes_null(spark):
    df = spark.createDataFrame([(math.inf,), (1.0,)], "x double")
    assert {r["x"] for r in rows(features.build_cyber_features(df, rank=False))} == {None, 1.0}


def test_feature_plan_has_no_python(spark, model_rows):
    plan = plan_text(features.build_cyber_features(model_rows, rank=False))
    assert "Python" not in plan and "Exchange" not in plan.split("InMemory")[0]


def test_one_hot(spark):
    df = spark.createDataFrame([("a", 1, "x", True), ("b", 2, None, None), ("c", 3, "y", False)], "asset_id string, n int, t string, f boolean")
    out = features.one_hot_encode(df)
    assert out.columns == ["asset_id", "n", "t_x", "t_y", "t_nan", "f_False", "f_True", "f_nan"]
    assert rows(out, "n")[1] == {"asset_id": "b", "n": 2, "t_x": False, "t_y": False, "t_nan": True, "f_False": False, "f_True": False, "f_nan": True}
    with pytest.raises(ValueError, match="exclude"):
        features.one_hot_encode(df, max_values=1)


def test_split_is_stable_and_complete(spark, model_rows):
    big = spark.range(20000).select(F.col("id").cast("string").alias("asset_id"), F.lit(1.0).alias(C.SOURCE_TARGET))
    parts = features.train_val_test_split(big)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 20000 and np.allclose(np.array(sizes) / 20000, [0.7, 0.15, 0.15], atol=0.01)
    again = features.train_val_test_split(big.repartition(9))
    assert rows(parts[2], "asset_id") == rows(again[2], "asset_id")
    with pytest.raises(ValueError):
        features.train_val_test_split(big, target="nope")


# --- selection -------------------------------------------------------------------


def test_filters(spark):
    df = spark.createDataFrame([(i * 1.0, i * 2.0 + (i % 2) * 1e-3, 7.0, float((i * 7) % 5), None if i else math.inf, "t") for i in range(12)], "a double, b double, flat double, other double, void double, t string")
    columns = ["a", "b", "flat", "other", "void"]
    matrix = select.numeric_matrix(df, columns)
    assert select.varying_columns(matrix, columns) == ["a", "b", "other"]
    assert select.varying_columns(matrix, columns, threshold=5.0) == ["a", "b"]
    assert select.correlation_filter(df.drop("void"), "other", 0.98).columns == ["a", "flat", "other", "t"]
    assert select.remove_leakage(df.withColumns({"asset_id": F.lit(1), "financial_loss_usd": F.lit(1)})).columns == df.columns


def test_mutual_information(spark):
    df = spark.range(4000).select((F.col("id") % 4).cast("double").alias("y"), (F.col("id") % 4 * 10).cast("double").alias("same"), (F.floor(F.col("id") / 4) % 4).cast("double").alias("free"), F.lit(1.0).alias("flat"))
    got = by(select.mutual_information(df, ["same", "free", "flat"], "y", bins=4), "feature")
    assert got["same"]["mutual_information"] == pytest.approx(math.log(4))
    assert got["free"]["mutual_information"] == pytest.approx(0, abs=1e-9) and got["flat"]["mutual_information"] == 0


def test_rank_fusion():
    got = select.fuse_ranks(["x", "y"], {"x": 2.0, "y": 1.0}, {"x": 0.0, "y": 0.5}, ["y"])
    assert [r["feature"] for r in got] == ["y", "x"]
    assert got[0]["selection_score"] == pytest.approx(0.15 + 0.3 + 0.25 + 0.15) and got[1]["selection_score"] == pytest.approx(0.3)
    assert select.fuse_ranks(["x"], {"x": 0.0}, {}, [])[0]["selection_score"] == 0


def test_select_features(spark, model_rows):
    data = model_rows.drop("asset_id").withColumns({"copy": F.col("a") * 2, "flat": F.lit(1.0)})
    names, report = select.select_features(data, trees=8, elimination_trees=4, depth=4, max_features=2)
    assert report["initial_numeric_features"] == 6 and report["after_variance_threshold"] == 5 and report["correlation_dropped"] == ["copy"]
    assert set(names) == {"a", "b"} and len(report["feature_scores"]) == 4
    assert select.recursive_elimination(select.numeric_matrix(data, ["a", "b", "c", "d"]), ["a", "b", "c", "d"], C.TARGET, 2, trees=4, depth=4) == ["a", "b"]


# --- training --------------------------------------------------------------------


def test_preprocessor_refits_after_filling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (None,)], "x double")
    p = train.fit_preprocessor(df, ["x"])
    filled = np.array([1, 2, 3, 4, 2.5, 2.5])
    iqr = np.quantile(filled, 0.75) - np.quantile(filled, 0.25)
    assert p.fills == {"x": 2.5} and p.scaler.params["x"] == ("robust", 2.5, pytest.approx(iqr))
    np.testing.assert_allclose([r["x"] for r in rows(p.transform(df))], (filled - 2.5) / iqr)


def test_metrics(spark):
    y, p = np.array([0.0, 10.0, 20.0, 30.0]), np.array([1.0, 8.0, 20.0, 36.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    m = train.regression_metrics(df, "y", "p")
    e = y - p
    want = dict(mae=np.abs(e).mean(), mse=(e**2).mean(), rmse=np.sqrt((e**2).mean()), r2=1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
                mape=np.mean(np.abs(e / np.where(y == 0, 1, y))) * 100, median_absolute_error=np.median(np.abs(e)), explained_variance=1 - e.var() / y.var())
    assert m == {k: pytest.approx(v) for k, v in want.items()}
    assert train.metrics_table(spark, m).count() == 7


def test_intervals_and_histogram(spark):
    df = spark.createDataFrame([(10.0, -20.0), (50.0, 0.0), (90.0, 20.0)], "prediction double, residual double")
    got = rows(train.prediction_intervals(df))
    assert [r["p05"] for r in got] == [0.0, 32.0, 72.0] and [r["p95"] for r in got] == [28.0, 68.0, 108.0]
    values = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 5, 9, 10, 10]] + [(None,)], "v double")
    counts = [r["count"] for r in rows(train.histogram(values, "v", 5, log_scale=False), "bin")]
    assert counts == np.histogram([0, 0, 1, 5, 9, 10, 10], 5)[0].tolist()
    logged = [r["count"] for r in rows(train.histogram(values, "v", 5), "bin")]
    assert logged == np.histogram(np.log1p([0, 0, 1, 5, 9, 10, 10]), 5)[0].tolist()
    assert sum(r["count"] for r in rows(train.histogram(spark.createDataFrame([(3.0,)], "v double"), "v"))) == 1
    assert train.histogram(values.where("v is null"), "v").count() == 0


def test_train_select_save_load_and_predict(spark, model_rows, tmp_path):
    registry = {k: v for k, v in train.model_registry(trees=8, rounds=8, depth=5).items() if k != "Gradient Boosting"}
    space = {"Random Forest": {"trees": [5, 8], "depth": [4, None], "min_leaf": [1]}}
    result = train.train_and_select(model_rows, NAMES, C.TARGET, registry, space, folds=2, repeats=1, search_iter=2)
    board = [r["model"] for r in result.leaderboard.collect()]
    assert set(board) == {"Linear Regression", "ElasticNet", "Random Forest", "Random Forest Tuned"} and board[0] == result.best_name
    r2 = [r["holdout_r2"] for r in result.leaderboard.collect()]
    assert r2 == sorted(r2, reverse=True) and r2[0] > 0.5
    assert result.tuning["candidate"] == "Random Forest" and set(result.tuning["best_params"]) == {"trees", "depth", "min_leaf"}
    path = str(tmp_path / "model")
    result.best_model.save(spark, path)
    loaded = train.LossModel.load(spark, path)
    want, got = (by(m.predict(model_rows), "asset_id") for m in (result.best_model, loaded))
    assert all(got[k]["prediction"] == pytest.approx(want[k]["prediction"]) for k in want)
    assert train.sample_grid({"x": [1, 2, 3]}, 2, 7) == train.sample_grid({"x": [1, 2, 3]}, 2, 7)


def test_ml_job(spark, tmp_path):
    i = F.col("id")
    table = spark.range(120).select(
        F.concat(F.lit("ASSET-"), i).alias("asset_id"), (i % 19 / 19.0).alias("cvss_score_max"), (i * 5 % 23 / 23.0).alias("epss_score_max"),
        (i % 7 + 1).alias("vuln_count"), (i % 3 + 1).alias("unique_cve_count"), (i % 11).cast("double").alias("days_since_published_max"),
        ((i % 19) * 1000 + i * 5 % 23 * 10).cast("double").alias(C.SOURCE_TARGET), F.lit("word").alias("note"),
    )
    out = str(tmp_path / "ml")
    result = jobs.ml_job(
        table, output=out, registry={"Linear Regression": train.model_registry()["Linear Regression"]},
        selection=dict(trees=4, elimination_trees=3, depth=3, max_features=5), training=dict(folds=2, repeats=0, spaces={}),
    )
    assert result.training.best_name == "Linear Regression" and len(result.selected) == 5
    assert not set(result.selected) & {*C.LEAKAGE_COLUMNS, "asset_id", "note"}
    assert set(result.feature_profiles) == set(result.selected)
    for name in ("model", "leaderboard", "prediction_intervals", "metrics.json", "feature_list.json", "data_profile", "training_config.json"):
        assert tables.path_exists(spark, f"{out}/{name}")
    wanted = features.build_cyber_features(table).select(*result.selected)
    # Feature names such as vuln_count carry input rules the sample satisfies.
    scored = jobs.predict_job(result, wanted, AS_OF)
    assert scored.count() == 120 and scored.columns[-10:] == tables.PREDICTION_COLUMNS


def test_simple_trainers(spark, model_rows):
    data = model_rows.drop("d")
    plain = train.train_regressor(data, C.TARGET, train.random_forest(5, 5))
    assert plain.features == NAMES
    assert train.regression_metrics(plain.predict(data), C.TARGET, "prediction")["r2"] > 0.8
    tuned, params, rmse = train.tune_random_forest(data, C.TARGET, folds=2, n_iter=1, trees=4)
    assert set(params) == {"depth", "min_leaf"} and rmse > 0 and tuned.features == NAMES
    report = rows(train.importance_report(spark, plain.importances()))
    assert [r["importance"] for r in report] == sorted((r["importance"] for r in report), reverse=True)
    stacked = train.stacking_regressor(data, NAMES, C.TARGET, folds=2, bases={"rf": train.random_forest(5, 5), "en": train.elastic_net(0.1)})
    assert train.regression_metrics(stacked.predict(data), C.TARGET, "prediction")["r2"] > 0.8


def test_diagnostics(spark, model_rows, boosted):
    got = rows(train.permutation_importance(boosted, model_rows, repeats=2))
    assert [r["feature"] for r in got][:2] == ["a", "b"] and len(got) == 3
    curve = rows(train.learning_curve(model_rows, NAMES, C.TARGET, train.elastic_net(0.01), (0.5, 1.0), 2))
    assert [r["share"] for r in curve] == [0.5, 1.0] and curve[0]["train_rows"] < curve[1]["train_rows"] == 120
    flat = rows(train.partial_dependence(boosted, model_rows, ["a"], points=4), "value")
    assert len(flat) == 4 and flat[0]["prediction"] < flat[-1]["prediction"]
    data = model_rows.toPandas()
    low = data["a"].quantile(0.05)
    held = boosted.predict(model_rows.withColumn("a", F.lit(float(low)))).agg(F.avg("prediction")).first()[0]
    assert min(r["prediction"] for r in flat if r["value"] == pytest.approx(low)) == pytest.approx(held)


def test_shuffled_values_are_a_permutation(spark, model_rows):
    moved = train._bucketed_shuffle(model_rows, ["a", "b"], 3, 25_000, "asset_id").toPandas()
    for i, c in enumerate(["a", "b"]):
        assert sorted(v[i] for v in moved["_shuffled"]) == sorted(moved[c])
    assert (moved["_shuffled"].map(lambda v: v[1]) != moved["b"]).mean() > 0.8


# --- scoring ---------------------------------------------------------------------


def inputs(spark, **changes):
    base = {c: 0.0 for c in C.MODEL_FEATURES} | {"vuln_count": 2.0}
    data = {**base, **changes}
    kinds = ", ".join(f"{c} {'string' if isinstance(v, str) else 'double'}" for c, v in data.items())
    return spark.createDataFrame([tuple(data.values())], kinds)


@pytest.mark.parametrize("changes,message", [
    ({"vuln_count": "x"}, "must be numeric"), ({"vuln_count": None}, "missing or NaN"), ({"vuln_count": math.nan}, "missing or NaN"),
    ({"weighted_risk_index": math.inf}, "must be finite"), ({"epss_score_max": -0.1}, "greater than or equal to 0.0"),
    ({"cvss_score_max": 1.5}, "less than or equal to 1.0"), ({"kev_flag_max": 0.5}, "binary"), ({"vuln_count": 1.5}, "integer count"),
])
def test_input_rules(spark, changes, message):
    df = inputs(spark, **changes)
    with pytest.raises(score.PredictionError, match=message):
        score.validate_input(df)
    good, bad = score.split_input(inputs(spark).unionByName(df) if "x" not in changes.values() else df)
    assert bad.count() == 1 and message in " ".join(rows(bad)[0]["reasons"])


def test_input_check_as_a_whole(spark):
    assert rows(score.validate_input(inputs(spark, vuln_count="3")))[0]["vuln_count"] == 3.0
    with pytest.raises(score.PredictionError, match="empty"):
        score.validate_input(inputs(spark).where("false"))
    with pytest.raises(score.PredictionError, match="Missing required"):
        score.validate_input(inputs(spark).drop("vuln_count"))
    nine = {c: -1.0 for c in C.MODEL_FEATURES[:4]} | {"kev_flag_max": 2.0, "is_critical_max": 2.0, "is_exploitable_max": 2.0}
    with pytest.raises(score.PredictionError, match=r"Plus \d+ more validation error"):
        score.validate_input(inputs(spark, **nine))


def test_levels(spark):
    levels = [(0, "Very Low"), (50_000, "Low"), (150_000, "Medium"), (300_000, "High"), (699_999, "High"), (700_000, "Critical")]
    chosen = spark.range(1).select(F.array(*[score.risk_level(F.lit(float(v))) for v, _ in levels]).alias("r")).first()["r"]
    assert chosen == [level for _, level in levels]


def test_thresholds():
    assert score.check_thresholds({"thresholds": C.RISK_THRESHOLDS})["high"] == 700_000
    for bad in ({"very_low": 1}, {**C.RISK_THRESHOLDS, "low": -1}, {**C.RISK_THRESHOLDS, "low": 9e9}, {**C.RISK_THRESHOLDS, "low": math.nan}):
        with pytest.raises(score.PredictionError):
            score.check_thresholds(bad)


# Two published cases with their loss, level, confidence and interval, and the
# training profile they were scored with (p01, median, p99, iqr per model input in order).
CASES = [
    ([0.007333740207505826, 0.48023285362413515, 0.48023285362413515, 0.006063092177010274, 3.0156649937786115, 0.3945160104306443,
      0.6575342465753424, 3, -0.24961472378082955, 0, 0, 0.8767123287671232, 0.2372878609746235, 0.2372878609746235, 0.2372878609746235,
      1, 1, 0, -0.08111644266323091, -0.08111644266323091, 0, 0, 0],
     25003.096691120994, "Very Low", 96.0, 23286.734857996657, 26719.458524245332, 6.58),
    ([0.016978659116149233, 0.3454902111235858, 0.3454902111235858, 0.004677385466587959, 5.868678654991364, 0.19078755057878483,
      0.4227005870841487, 14, -1.1648687109772045, 0, 0, 0.8356164383561644, 1.6814438645846912, -1.299005696263826, 1.6814438645846912,
      0, 0, 0, -0.08111644266323091, -0.08111644266323091, 0, 0, 0],
     90001.23008996953, "Low", 94.59, 82527.9046615157, 97474.55551842335, 4.23),
]
TRAINED = [
    (0.0010005102602327186, 0.006313219742068454, 0.799822509479833, 0.009264725009754973),
    (0.08606702684639585, 0.2782772877730124, 3.4930788785304814, 0.3249357469577171),
    (0.08606702684639585, 0.2782772877730124, 3.4114241915163883, 0.3249357469577171),
    (0.0009583744852732036, 0.005412760507859007, 0.303874485665107, 0.0068437403075568524),
    (1.4166788950622442, 1.5211257304890855, 8.20997051989726, 1.5401160642030565),
    (0.01746255222424538, 0.2465603848835808, 0.5657101326956439, 0.22745871773861215),
    (0.21917808219178075, 0.6354642313546424, 0.9726027397260275, 0.3320015220700154),
    (1.0, 1.0, 42.0, 2.0),
    (-3.0785815932968976, -0.08320490792694318, 11.10191200053785, 0.16640981585388637),
    (0.0, 0.0, 2.0, 1e-06),
    (0.0, 0.0, 1.0, 1e-06),
    (0.21917808219178075, 0.6986301369863013, 0.9863013698630136, 0.5068493150684934),
    (-1.6134751727780847, 0.34144335638062007, 1.983895399321335, 1.4942307610167969),
    (-1.6214871339631614, -0.037121809614252065, 1.9418326030996826, 1.5743503728675634),
    (0.0, 0.34144335638062007, 1.983895399321335, 1.1506514360733626),
    (0.0, 0.0, 10.0, 1.0),
    (0.0, 0.0, 1.0, 1.0),
    (0.0, 0.0, 0.5198729831546307, 1e-06),
    (-0.08111644266323091, -0.08111644266323091, 11.999635977790852, 1e-06),
    (-0.08111644266323091, -0.08111644266323091, 4.16366843502228, 1e-06),
    (0.0, 0.0, 0.0, 1e-06),
    (0.0, 0.0, 0.0, 1e-06),
    (0.0, 0.0, 0.0, 1e-06),
]
MAE, MAPE = 28143.767550259214, 3.0829818008627683
# (loss, half width of the interval, confidence) of the three cases whose uncertainty came from the model itself.
OTHERS = [(219638.71545410255, 27737.206598976198, 91.88), (448530.65467186796, 84432.34838758611, 88.15), (900303.8420781234, 197841.1871832710, 86.31)]


def test_published_cases(spark):
    schema = ", ".join(f"{c} double" for c in C.MODEL_FEATURES) + ", predicted_loss double"
    df = spark.createDataFrame([tuple(float(v) for v in case[0]) + (case[1],) for case in CASES], schema)
    profiles = {c: dict(zip(("p01", "median", "p99", "iqr"), p)) for c, p in zip(C.MODEL_FEATURES, TRAINED)}
    out = score.add_scores(df, C.MODEL_FEATURES, {c: 1.0 for c in C.MODEL_FEATURES}, {"mae": MAE, "mape": MAPE}, profiles, AS_OF)
    assert out.columns[-10:] == tables.PREDICTION_COLUMNS
    for r, (_, loss, level, confidence, lower, upper, cvss) in zip(rows(out), CASES):
        assert r["predicted_loss"] == loss and r["risk_level"] == level and r["confidence_score"] == confidence
        assert r["prediction_interval_lower"] == pytest.approx(lower, rel=1e-9)
        assert r["prediction_interval_upper"] == pytest.approx(upper, rel=1e-9)
        assert r["raw_feature__cvss_score_mean_0_to_10"] == cvss


@pytest.mark.parametrize("loss,half,confidence", OTHERS)
def test_published_confidence(spark, loss, half, confidence):
    got = spark.range(1).select(score.confidence_score(F.lit(loss), F.lit(half / 1.96), MAE).alias("c")).first()["c"]
    assert got == confidence


def test_staged_spread_against_the_model_itself(spark, model_rows, boosted):
    got = by(score.staged_spread(boosted, model_rows), "asset_id")
    data = boosted.prepared(model_rows)
    points = [(r["asset_id"], r["features"]) for r in data.limit(6).collect()]
    trees, weights = boosted.regressor.trees, boosted.regressor.treeWeights
    for key, x in points:
        stages = np.expm1(np.cumsum([w * t.predict(x) for t, w in zip(trees, weights)]))
        assert got[key]["staged_spread"] == pytest.approx(np.std(stages[int(len(trees) * 0.5):]))
    assert set(got) == set(by(model_rows, "asset_id"))


def test_contributions(spark):
    df = spark.createDataFrame([(1.0, -3.0, 2.0)], "vuln_count double, b_c double, z double")
    why = df.select(score.contributions({"vuln_count": 1.0, "b_c": 1.0, "z": 0.5}).alias("w")).first()["w"]
    assert [(e["label"], e["contribution"], e["impact"]) for e in why] == [
        ("B C", -3.0, "Decreases risk"), ("Z", 1.0, "Increases risk"), ("Vulnerability Count", 1.0, "Increases risk")]
    short = df.select(score.top_label(score.contributions({"z": 1.0}), 2).alias("t")).first()["t"]
    assert short == ""


def test_export_names_and_clips(spark):
    df = spark.createDataFrame([(0.65753, -2.0, -1.0, -0.5, "k")], "cvss_score_mean double, vuln_count double, exploit_count_sum double, epss_score_max double, other string")
    r = rows(df.select(*score.export_columns(df)))[0]
    assert r == {"raw_feature__cvss_score_mean_0_to_10": 6.58, "raw_feature__vulnerability_count": 0.0, "scaled_feature__exploit_count_sum": -1.0,
                 "raw_feature__epss_score_max": -0.5, "derived_feature__other": "k"}


def test_predict_csv(spark, model_rows, boosted, tmp_path):
    source = str(tmp_path / "in.csv")
    model_rows.select(*NAMES).limit(5).toPandas().to_csv(source, index=False)
    profiles = profile.feature_profile(model_rows, NAMES)
    jobs.predict_csv(spark, boosted, {"mae": 1.0, "mape": 3.0}, profiles, source, str(tmp_path / "out.csv"), AS_OF)
    out = spark.read.csv(str(tmp_path / "out.csv"), header=True)
    assert out.columns == [f"derived_feature__{c}" for c in NAMES] + tables.PREDICTION_COLUMNS and out.count() == 5
    with pytest.raises(score.PredictionError):
        jobs.predict_csv(spark, boosted, {}, {}, str(tmp_path), str(tmp_path / "o"), AS_OF)
    with pytest.raises(FileNotFoundError):
        jobs.predict_csv(spark, boosted, {}, {}, "/tmp/none-such.csv", str(tmp_path / "o"), AS_OF)
