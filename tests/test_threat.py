import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.operators import scale, threat
from riskspark.plans import jobs
from tests.conftest import AS_OF
from tests.helpers import by, plan_text, rows


def raw(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_validate_adds_missing_columns(spark):
    df = raw(spark, [("a", None, None, "2024-01-01", "x", "external", 5.0)],
             "asset_id string, cve_id string, source string, published string, known_ransomware string, scope string, asset_exposure_score double")
    good, bad = threat.validate_threats(df, AS_OF)
    r = rows(good)[0]
    assert (r["record_id"], r["source_feed"], r["published_date"]) == ("a::", "unknown", "2024-01-01")
    assert (r["last_seen"], r["days_active"], r["kev_listed"]) == (AS_OF, 0, True)
    assert (r["affected_systems_count"], r["attack_vector"]) == (5.0, "network")
    assert bad.count() == 0


def test_validate_defaults_without_evidence(spark):
    r = rows(threat.validate_threats(raw(spark, [("a",)], "asset_id string"), AS_OF)[0])[0]
    assert (r["source_feed"], r["kev_listed"], r["affected_systems_count"], r["attack_vector"]) == ("unknown", False, 1.0, "local")
    with pytest.raises(ValueError, match="asset_id"):
        threat.validate_threats(raw(spark, [(1,)], "x int"), AS_OF)


def test_validate_reads_numbers_and_severity_leniently(spark):
    df = raw(spark, [("a", "8.0", "NaN", " Informational ", "7.9"), ("b", "bad", None, None, "x")],
             "asset_id string, cvss_score string, epss_score string, severity string, exploit_count string")
    r = by(threat.validate_threats(df, AS_OF)[0], "asset_id")
    assert (r["a"]["cvss_score"], r["a"]["epss_score"], r["a"]["severity"], r["a"]["exploit_count"]) == (8.0, None, "info", 7.9)
    assert (r["b"]["cvss_score"], r["b"]["severity"], r["b"]["exploit_count"]) == (None, "low", None)


def test_validate_rejects_and_strict(spark):
    df = raw(spark, [("a", 10.0, 1.0), ("", 1.0, 0.1), (None, 1.0, 0.1), ("b", 10.1, 0.1), ("c", 5.0, -0.1), ("d", None, None)],
             "asset_id string, cvss_score double, epss_score double")
    good, bad = threat.validate_threats(df, AS_OF)
    assert sorted(r["asset_id"] for r in rows(good)) == ["a", "d"]
    assert bad.count() == 4 and {r["error"] for r in rows(bad)} == {threat.REJECT_REASON}
    with pytest.raises(ValueError):
        threat.validate_threats(df, AS_OF, strict=True)


def test_declared_rules(spark):
    df = raw(spark, [("bad", "network", -1, "2024-01-02", "2024-01-01"), ("HIGH", "local", 0, "2024-01-01", "2024-01-02")],
             "severity string, attack_vector string, exploit_count int, first_seen string, last_seen string")
    broken = rows(threat.declared_rule_violations(df))
    assert len(broken) == 1
    assert broken[0]["reasons"] == ["severity not allowed", "exploit_count negative", "first_seen after last_seen"]


def test_coerce(spark):
    df = raw(spark, [(" Yes ", "3.9", " High "), (None, None, None), ("no", "x", "LOW")], "kev_listed string, exploit_count string, severity string")
    got = rows(threat.coerce_types(df))
    assert [(r["kev_listed"], r["exploit_count"], r["severity"]) for r in got] == [(True, 3, "high"), (False, 0, None), (False, 0, "low")]


def test_deduplicate_newest_wins_and_null_keys_are_equal(spark):
    data = [("a", "c1", "f", "2024-01-01", 1), ("a", "c1", "f", "2024-01-03", 2), ("a", "c1", "f", None, 3),
            ("a", None, "f", None, 4), ("a", None, "f", None, 5), ("b", "c1", "f", "2024-01-01", 6), ("b", "c1", "f", "2024-01-01", 7)]
    df = raw(spark, data, "asset_id string, cve_id string, source_feed string, last_seen string, n int")
    for table in (df, df.repartition(5, "n")):
        assert sorted(r["n"] for r in rows(threat.deduplicate(table))) == [2, 5, 7]
    assert threat.deduplicate(df, keys=["asset_id", "missing"]).count() == 2


def test_deduplicate_cuts_hot_keys_before_the_shuffle(spark):
    df = raw(spark, [("a", "c", "f", "x")], "asset_id string, cve_id string, source_feed string, last_seen string")
    plan = plan_text(threat.deduplicate(df))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_outliers_iqr(spark):
    values = [1.0] * 3 + [2.0] * 3 + [3.0] * 3
    df = raw(spark, [(v, 5.0, None) for v in values] + [(5.0, 5.0, None), (None, 9.0, None), (4.5, 5.0, None)],
             "cvss_score double, epss_score double, exploit_count double")
    model = threat.fit_outliers(df)
    assert "exploit_count" not in model.params
    low, high = model.params["cvss_score"]
    got = [(r["cvss_score"], r["epss_score"], r["is_outlier"]) for r in rows(model.transform(df))]
    for c, e, flag in got:
        assert flag == ((c is not None and not low <= c <= high) or e == 9.0)
    # A value exactly on the fence is inside.
    edge = raw(spark, [(high,), (low,), (high + 1e-9,)], "cvss_score double")
    assert [r["is_outlier"] for r in rows(model.transform(edge))] == [False, False, True]


def test_outliers_zscore(spark):
    df = raw(spark, [(0.0, 1.0)] * 20 + [(100.0, 1.0)], "cvss_score double, epss_score double")
    got = rows(threat.fit_outliers(df, "zscore").transform(df))
    assert [r["cvss_score"] for r in got if r["is_outlier"]] == [100.0]


def test_engineer_scores_and_days(spark):
    data = [("critical", "network", 10.0, 1.0, True, "2024-01-31T00:01:00Z", 2), ("odd", "odd", None, 0.1, False, "2025-01-01", 0), (None, None, 5.0, None, False, "junk", 1)]
    df = raw(spark, data, "severity string, attack_vector string, cvss_score double, epss_score double, kev_listed boolean, published_date string, exploit_count long")
    a, b, c = rows(threat.engineer_threats(df, AS_OF))
    assert a["composite_risk_score"] == 10.0 and a["days_since_published"] == 0
    assert (a["is_exploitable"], a["is_critical"], a["is_network_exposed"], a["kev_flag"]) == (1, 1, 1, 1)
    assert a["epss_cvss_interaction"] == 10.0 and a["risk_exploit_product"] == 10.9861
    assert b["composite_risk_score"] is None and b["days_since_published"] == 0 and b["is_exploitable"] == 1
    assert c["composite_risk_score"] == 2.0 and c["days_since_published"] is None and c["is_exploitable"] == 0
    assert c["epss_cvss_interaction"] is None


def test_engineer_keeps_given_days_and_counts_complete_ones(spark):
    df = raw(spark, [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 23, 59), 4)], "first_seen timestamp, last_seen timestamp, days_since_first_seen int")
    r = rows(threat.engineer_threats(df, AS_OF))[0]
    assert (r["days_active"], r["days_since_first_seen"]) == (2, 4)


def test_aggregate(spark):
    data = [("a", "c1", 1.0, None, "high", "t1"), ("a", "c1", 3.0, None, "weird", None), ("a", None, None, None, None, "t2"), (None, "c9", 9.0, 1, "high", "t1"), ("b", None, None, 4, "low", None)]
    df = raw(spark, data, "asset_id string, cve_id string, cvss_score double, exploit_count long, severity string, threat_actor string")
    got = by(threat.aggregate_assets(df), "asset_id")
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a["cvss_score_max"], a["cvss_score_mean"], a["exploit_count_sum"], a["exploit_count_max"]) == (3.0, 2.0, 0, None)
    assert (a["vuln_count"], a["unique_cve_count"], a["unique_threat_actor_count"]) == (3, 1, 2)
    assert (a["sev_count_high"], a["sev_count_weird"], a["sev_count_low"]) == (1, 1, 0)
    assert (b["unique_cve_count"], b["unique_threat_actor_count"], b["exploit_count_sum"]) == (0, 0, 4)
    rough = by(threat.aggregate_assets(df, approximate=True), "asset_id")
    assert rough["a"]["unique_threat_actor_count"] == 2
    with pytest.raises(ValueError):
        threat.aggregate_assets(df, group_key="nope")


def threat_rows(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("ASSET-"), F.col("id") % 7).alias("asset_id"), F.concat(F.lit("CVE-"), F.col("id") % 150).alias("cve_id"),
        F.lit("feed").alias("source"), F.when(F.col("id") % 9 != 0, (F.col("id") * 37 % 100) / 10.0).alias("cvss_score"),
        F.when(F.col("id") % 8 != 0, (F.col("id") * 53 % 97) / 100.0).alias("epss_score"),
        F.element_at(F.array(*[F.lit(s) for s in ("Critical", "HIGH", "low")]), (F.col("id") % 3 + 1).cast("int")).alias("severity"),
        (F.col("id") % 5).alias("exploit_count"), F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 300).cast("int")).cast("string").alias("published"),
    )


def test_threat_job_equals_the_stages_one_by_one(spark):
    import pandas as pd

    raw_rows = threat_rows(spark)
    fast = jobs.threat_job(raw_rows, AS_OF).toPandas().sort_values("asset_id").reset_index(drop=True)
    slow = jobs.threat_job_stepwise(raw_rows, AS_OF).toPandas().sort_values("asset_id").reset_index(drop=True)
    assert list(fast.columns) == list(slow.columns)
    pd.testing.assert_frame_equal(fast, slow, rtol=1e-9, atol=1e-9)
    shuffled = jobs.threat_job(raw_rows.repartition(9), AS_OF).toPandas().sort_values("asset_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(fast, shuffled, rtol=1e-9, atol=1e-9)
    plain = jobs.threat_job(raw_rows, AS_OF, normalize=False)
    assert max(r["cvss_score_max"] for r in rows(plain)) > 1


def test_threat_chain_has_no_python_and_no_cartesian_join(spark):
    clean = jobs.clean_threats(threat_rows(spark), AS_OF, keep=jobs.ROLLED_UP)
    plan = plan_text(threat.aggregate_assets(threat.engineer_threats(clean, AS_OF), severities=["high"]))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_scaler(spark, tmp_path):
    df = raw(spark, [(0.0, 1.0, 7.0), (5.0, 3.0, 7.0), (None, None, 7.0)], "cvss_score double, exploit_count double, days_active double")
    model = scale.fit_scaler(df)
    got = rows(model.transform(df))
    assert [(r["cvss_score"], r["exploit_count"], r["days_active"]) for r in got] == [(0.0, -1.0, 0.0), (1.0, 1.0, 0.0), (None, None, 0.0)]
    model.save(spark, str(tmp_path / "scaler"))
    assert scale.Scaler.load(spark, str(tmp_path / "scaler")) == model
    flat = scale.fit_scaler(raw(spark, [(4.0,)], "cvss_score double"))
    assert rows(flat.transform(raw(spark, [(4.0,), (6.0,)], "cvss_score double"))) == [{"cvss_score": 0.0}, {"cvss_score": 2.0}]


def test_robust_scale(spark):
    df = raw(spark, [(1.0, 1), (2.0, 1), (3.0, 1), (10.0, 1)], "x double, c int")
    out, model = scale.robust_scale(df)
    assert model.params["x"] == ("robust", 2.5, 3.0) and model.params["c"][2] == 1.0
    assert [r["x"] for r in rows(out)] == pytest.approx([-0.5, -1 / 6, 1 / 6, 2.5])
