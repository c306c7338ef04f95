"""Cases that once went wrong: folds, penalties, text forms, broken input, work folders."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from riskspark import session as S
from riskspark.operators import assets, features, loss, merge, scale, score, threat, train
from riskspark.plans import jobs
from riskspark.sources import scans, tables


def test_folds_are_even_inside_the_training_part(spark):
    rows = spark.range(2000).select(F.concat(F.lit("A"), "id").alias("asset_id"))
    seen, unseen = train.holdout_split(rows)
    assert 300 < unseen.count() < 500
    for k in (2, 3, 5):
        sizes = [r["count"] for r in seen.groupBy(features.hash_fold(k, 42)).count().collect()]
        assert len(sizes) == k and min(sizes) > 0.8 * seen.count() / k
    shares = rows.select(features.hash_share(42).alias("a"), features.hash_share(42, purpose="size").alias("b"))
    assert abs(shares.agg(F.corr("a", "b")).first()[0]) < 0.1


def test_metrics_of_no_rows_say_so(spark):
    with pytest.raises(ValueError, match="no rows"):
        train.regression_metrics(spark.createDataFrame([], "y double, p double"), "y", "p")


def linear_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    y = 300 * x[:, 0] - 150 * x[:, 1] + rng.normal(size=60) * 20 + 7
    return x, y, spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"])


def test_ridge_equals_the_closed_form(spark):
    x, y, rows = linear_rows(spark)
    alpha = 50.0
    c, d = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(c.T @ c + alpha * np.eye(2), c.T @ d)
    model = train.PenalisedLinear(alpha / 60, 0.0).fit(rows)
    assert model.coefficients.toArray() == pytest.approx(want, rel=0.02)


def test_elastic_net_equals_coordinate_descent(spark):
    x, y, rows = linear_rows(spark)
    alpha, ratio = 40.0, 0.2
    c, d, w = x - x.mean(axis=0), y - y.mean(), np.zeros(2)
    for _ in range(2000):
        for j in range(2):
            rho = c[:, j] @ (d - c @ w + c[:, j] * w[j]) / 60
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (c[:, j] @ c[:, j] / 60 + alpha * (1 - ratio))
    model = train.elastic_net(alpha, ratio).fit(rows)
    assert model.coefficients.toArray() == pytest.approx(w, rel=0.02)


def test_linear_models_explain_with_equal_weights(spark):
    rows = spark.createDataFrame([(f"A{i}", float(i), float(i * i)) for i in range(20)], "asset_id string, x double, financial_loss_usd double")
    model = train.fit_model(rows, ["x"], "financial_loss_usd", LinearRegression())
    assert model.importances() and model.importances(coefficients=False) == {}


def test_walked_spread():
    tree = {"feature": np.array([0, -1, -1]), "threshold": np.array([1.0, 0, 0]), "left": np.array([1, 0, 0]), "right": np.array([2, 0, 0]), "value": np.array([0, 2.0, 6.0])}
    got = score.walked_spread([tree, tree], [1.0, 0.5], np.array([[0.0], [3.0]]), 0, False)
    assert got.tolist() == [np.std([2, 3]), np.std([6, 9])]


@pytest.mark.parametrize("port, good", [("22", True), ("22.0", True), (" 22\t", True), ("22.5", False), ("0", False), ("70000", False), ("x", False)])
def test_ports(spark, port, good):
    assert spark.range(1).select(assets.is_port(F.lit(port))).first()[0] is good


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-01T00:00:00.123456789Z", "2024-01-01 00:00:00.123456"),
        ("20240101T000000Z", "2024-01-01 00:00:00"),
        ("2024-01-01T10Z", "2024-01-01 10:00:00"),
        ("2024-01-01", "2024-01-01 00:00:00"),
        ("2024-01-01T10:00:00+02:00", "2024-01-01 08:00:00"),
        ("2024-01-01 10:00:00,5", "2024-01-01 10:00:00.5"),
        ("not a date", None),
        ("2024-13-01", None),
    ],
)
def test_moments(spark, text, want):
    got = spark.range(1).select(assets.parse_moment(F.lit(text)).cast("string")).first()[0]
    assert got == want


def test_white_space_of_any_kind_is_cut(spark):
    rows = spark.createDataFrame([("A", "HIGH\t"), ("B", "\nlow \r")], "asset_id string, severity string")
    assert [r["severity"] for r in threat.complete_columns(rows, "2024-01-01").orderBy("asset_id").collect()] == ["high", "low"]


def test_severity_words_with_dots(spark):
    rows = spark.createDataFrame([("A", "n.a.", "c"), ("A", "low", "d")], "asset_id string, severity string, cve_id string")
    out = threat.aggregate_assets(rows)
    assert out.select("`sev_count_n.a.`", "sev_count_low").first()[:] == (1, 1)


def test_downtime_levels_come_from_the_given_table(spark):
    rows = spark.createDataFrame([("critical",), (None,)], "business_criticality string")
    costs = {"downtime": {"medium_systems_cost_per_min_usd": 100}}
    assert [r[0] for r in rows.select(loss.downtime_loss(rows, costs)).collect()] == [48_000.0, 48_000.0]
    assert rows.select(loss.downtime_loss(rows, {})).first()[0] == 840.0 * 8 * 60


def test_line_breaks_in_csv_cells_survive(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'x\n"y"'), ("b", "z")], "k string, v string")
    tables.write_table(rows.coalesce(1), f"{tmp_path}/t.csv")
    back = tables.read_table(spark, f"{tmp_path}/t.csv", "k string, v string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_broken_report_lines_fail(spark, tmp_path):
    (tmp_path / "n.jsonl").write_text('{"host": "h", "info": {"severity": "low"}}\n{"host": "cut o')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        scans.parse_nuclei_jsonl(spark, str(tmp_path / "n.jsonl")).collect()


def test_merge_checks_keys_in_one_pass(spark):
    one = spark.createDataFrame([("A", 1)], "asset_id string, x int")
    assert not merge.has_rows(one.limit(0)) and merge.has_rows(one)
    with pytest.raises(ValueError, match="Null"):
        merge.has_rows(spark.createDataFrame([(None, 1)], "asset_id string, x int"))
    outer = merge.merge_on_asset_id([one, spark.createDataFrame([("B", 2)], "asset_id string, y int")], how="outer")
    assert sorted(map(tuple, outer.collect())) == [("A", 1, None), ("B", None, 2)]


def test_written_tables_can_be_discarded(spark):
    table = S.materialize(spark.range(3), "t")
    path = table._written_to.removeprefix("file:")
    assert os.path.isdir(path) and path.startswith(S.shared_folder(spark).removeprefix("file:"))
    S.discard(table)
    assert not os.path.exists(path)


def test_cluster_sessions_need_a_shared_folder(spark, monkeypatch):
    class Context:
        applicationId, master = "other", "spark://host:7077"  # noqa: N815

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_folder(Session)


def test_robust_scale_takes_dotted_names(spark):
    rows = spark.createDataFrame([(float(i), float(i)) for i in range(5)], "`x.y` double, z double")
    scaled = scale.robust_scale(rows)[0]
    assert sorted(r["x.y"] for r in scaled.collect()) == [-1.0, -0.5, 0.0, 0.5, 1.0]


def test_the_portfolio_spreads_its_inventory(spark, monkeypatch):
    """One small inventory file is enriched by many tasks; the checks are not moved back before the spreading."""
    inventory = spark.range(400).select(F.concat(F.lit("ASSET-"), "id").alias("asset_id"), F.lit("1.1.1.1").alias("host")).coalesce(1)
    got = []
    monkeypatch.setattr(jobs, "asset_job", lambda df: got.append(df) or (df, None))
    monkeypatch.setattr(jobs, "threat_job", lambda *a, **k: inventory.select("asset_id"))
    monkeypatch.setattr(jobs, "pentest_job", lambda df: df)
    monkeypatch.setattr(jobs, "loss_job", lambda df: df)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = jobs.portfolio_job(inventory, inventory.select("asset_id"), inventory, "2024-02-01T00:00:00Z")
        assert len(got[0].inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {r["asset_id"] for r in out.collect()} == {f"ASSET-{i}" for i in range(400)}


def test_tie_columns_go_once_they_have_decided(spark):
    rows = spark.createDataFrame([("a", "c", 1, 5.0), ("a", "c", 2, 7.0)], "asset_id string, cve_id string, tie int, cvss_score double")
    kept = jobs.clean_threats(rows, "2024-02-01T00:00:00Z", ["tie"], jobs.ROLLED_UP)
    assert "tie" not in kept.columns and [r["cvss_score"] for r in kept.collect()] == [7.0]
    assert "tie" in jobs.clean_threats(rows, "2024-02-01T00:00:00Z", ["tie"]).columns
