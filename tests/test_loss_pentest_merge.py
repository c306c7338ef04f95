import pytest
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.operators import loss, merge, pentest
from riskspark.plans import jobs
from tests.helpers import by, plan_text, rows


def price(spark, schema, *data):
    return rows(loss.estimate_losses(spark.createDataFrame(list(data), schema)))


def test_single_row(spark):
    r = price(spark, "asset_id string, cvss_score_max double, epss_score_max double, vuln_count int", ("a1", 9.8, 0.2, 3))[0]
    assert r["loss_data_breach_usd"] == pytest.approx(732000 * 1.49)
    assert r["loss_ransomware_usd"] == pytest.approx((2_540_000 * 0.46 + 1_850_000) * 0.2)
    assert r["loss_downtime_usd"] == 840 * 8 * 60
    assert r["loss_legal_usd"] == pytest.approx(1_940_000 * 0.03 + 3.5 * 3000)
    assert r["loss_reputation_usd"] == pytest.approx(300 * 0.038 * 4200)
    assert r["exploit_probability"] == pytest.approx(0.2 + 0.98 * 0.08)
    assert r["financial_impact_usd"] == pytest.approx(sum(r[c] for c in C.LOSS_COLUMNS))
    assert r["expected_annual_loss_usd"] == pytest.approx(r["financial_impact_usd"] * r["exploit_probability"])


def test_no_columns_at_all(spark):
    r = price(spark, "asset_id string", ("a",))[0]
    assert r["loss_data_breach_usd"] == pytest.approx(732000 * 1.25)
    assert r["loss_ransomware_usd"] == pytest.approx((2_540_000 * 0.46 + 1_850_000) * 0.15)
    assert r["exploit_probability"] == pytest.approx(0.01 + 0.04)


def test_zero_scores_take_the_default_only_in_the_probability(spark):
    r = price(spark, "epss_score_max double, cvss_score_max double", (0.0, 0.0))[0]
    assert r["exploit_probability"] == pytest.approx(0.01 + 0.04)
    assert r["loss_data_breach_usd"] == pytest.approx(732000)


def test_null_values(spark):
    schema = "vuln_count int, cvss_score_max double, kev_flag_max int, epss_score_max double"
    r = price(spark, schema, (None, 10.0, 0, None))[0]
    assert r["loss_data_breach_usd"] == pytest.approx(732000 * 1.5)  # unknown records count as the floor
    assert r["loss_legal_usd"] is None and r["loss_reputation_usd"] is None
    assert r["loss_ransomware_usd"] == pytest.approx((2_540_000 * 0.46 + 1_850_000) * 0.15)
    assert r["exploit_probability"] is None and r["expected_annual_loss_usd"] is None
    assert r["financial_impact_usd"] == pytest.approx(r["loss_data_breach_usd"] + r["loss_ransomware_usd"] + r["loss_downtime_usd"])
    r = price(spark, schema, (1, None, None, 0.5))[0]
    assert r["loss_data_breach_usd"] is None and r["loss_ransomware_usd"] is None


@pytest.mark.parametrize("word,rate", [("Critical", 5600), ("high", 2100), ("LOW", 210), ("odd", 840), (None, 840)])
def test_downtime_by_criticality(spark, word, rate):
    r = price(spark, "business_criticality string, estimated_downtime_hours double", (word, 2.0))[0]
    assert r["loss_downtime_usd"] == rate * 120


def test_downtime_reads_only_the_exact_severity_column(spark):
    assert price(spark, "sev_count_critical int", (5,))[0]["loss_downtime_usd"] == 840 * 8 * 60
    assert price(spark, "sev_count_CRITICAL int", (5,))[0]["loss_downtime_usd"] == 840 * 68 * 60


def test_probability_inputs_and_bounds(spark):
    schema = "epss_score_max double, cvss_score_max double, kev_flag_max int, has_public_exploit_max int, pentest_risk_score double"
    a, b = price(spark, schema, (0.1, 5.0, 1, 1, 50.0), (1.0, 10.0, 1, 1, 100.0))
    assert a["exploit_probability"] == pytest.approx(0.1 * 3.25 + 0.04 + 0.025) and b["exploit_probability"] == 0.95


def test_custom_costs_and_plan(spark):
    df = spark.createDataFrame([(1,)], "vuln_count int")
    costs = {"reputation": {"avg_customer_ltv_usd": 1}, "downtime": {"medium_systems_cost_per_min_usd": 1}}
    r = rows(jobs.loss_job(df, costs))[0]
    assert r["loss_reputation_usd"] == pytest.approx(3.8) and r["loss_downtime_usd"] == 480
    plan = plan_text(loss.estimate_losses(df))
    assert "Exchange" not in plan and "Python" not in plan


# --- findings --------------------------------------------------------------------


def test_findings_stack_and_score(spark):
    nmap = spark.createDataFrame([("a", "nmap", "22"), ("a", "nmap", "n/a"), ("a", "nmap", "8.0"), (None, "nmap", "1")], "asset_id string, source_tool string, port string")
    nuclei = spark.createDataFrame([("a", "nuclei", "Critical"), ("a", None, "high"), ("b", "nuclei", "informational")], "asset_id string, source_tool string, severity string")
    sub = spark.createDataFrame([("a", "subfinder", "x"), ("a", "subfinder", "x"), ("a", "subfinder", "y")], "asset_id string, source_tool string, subdomain string")
    got = by(jobs.pentest_job(pentest.stack_findings([nmap, nuclei, sub])), "asset_id")
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["open_port_count"], a["finding_count"], a["critical_findings"], a["high_findings"], a["subdomain_count"]) == (2, 7, 1, 1, 2)
    assert a["pentest_weight_sum"] == 20.0 and a["pentest_risk_score"] == pytest.approx(21.1) and a["pentest_risk_grade"] == "MEDIUM"
    assert got["b"]["pentest_weight_sum"] == 0.25 and got["b"]["subdomain_count"] == 0


def test_findings_without_port_or_rows(spark):
    df = spark.createDataFrame([("a", "x")], "asset_id string, source_tool string")
    r = rows(pentest.build_pentest_features(df))[0]
    assert r["open_port_count"] == 0 and "subdomain_count" not in r and r["pentest_weight_sum"] == 0.5
    assert jobs.pentest_job(df.where("false")).count() == 0


def test_grades(spark):
    grades = [(0, "LOW"), (10, "LOW"), (10.01, "MEDIUM"), (30, "MEDIUM"), (60, "HIGH"), (100, "CRITICAL"), (500, "CRITICAL")]
    df = spark.createDataFrame([(float(s),) for s, _ in grades], "pentest_weight_sum double").coalesce(1)
    got = [(r["pentest_risk_score"], r["pentest_risk_grade"]) for r in rows(pentest.score_pentest_risk(df))]
    assert got == [(min(s, 100), g) for s, g in grades]


# --- merge -----------------------------------------------------------------------


def test_merge_keeps_the_first_tables_columns(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "asset_id string, v int")
    b = spark.createDataFrame([("x", 9, 5), ("z", 9, 6)], "asset_id string, v int, w int")
    empty = b.where("false").withColumn("q", F.lit(1))
    got = by(merge.merge_on_asset_id([None, a, empty, b]), "asset_id")
    assert got == {"x": {"asset_id": "x", "v": 1, "w": 5}, "y": {"asset_id": "y", "v": 2, "w": None}}
    assert set(by(merge.merge_on_asset_id([a, b], how="outer"), "asset_id")) == {"x", "y", "z"}
    assert merge.merge_on_asset_id([a, b], how="inner").count() == 1
    assert merge.merge_on_asset_id([None, empty]) is None
    repeated = b.unionByName(b)
    assert merge.merge_on_asset_id([a, repeated]).count() == 3


def test_merge_needs_a_full_key(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "asset_id string, v int")
    with pytest.raises(ValueError, match="Null values"):
        merge.merge_on_asset_id([a])
    with pytest.raises(ValueError, match="not found"):
        merge.require_key(a.drop("asset_id"))


def test_integrity_report(spark):
    a = spark.createDataFrame([("x", 1), ("x", None), (None, 2), (None, None)], "asset_id string, v int")
    assert rows(merge.integrity_report(a)) == [{"rows": 4, "columns": 2, "missing_key": 2, "duplicate_keys": 2, "null_cells": 4}]
    assert rows(merge.integrity_report(a.where("false")))[0]["rows"] == 0
    assert rows(merge.integrity_report(a.drop("asset_id")))[0]["duplicate_keys"] is None


def test_written_tables_carry_counts_and_skip_count_jobs(spark):
    from riskspark.operators import merge
    from riskspark.session import materialize

    a = materialize(spark.createDataFrame([("x", 1), ("y", 2)], "asset_id string, v int"), "part", key="asset_id")
    b = materialize(spark.createDataFrame([("x", 3)], "asset_id string, w int"), "part", key="asset_id")
    empty = materialize(spark.createDataFrame([], "asset_id string, u int"), "part", key="asset_id")
    bad = materialize(spark.createDataFrame([(None, 3)], "asset_id string, w int"), "part", key="asset_id")
    assert a.stats == {"rows": 2, "missing_key": 0} and empty.stats["rows"] == 0
    assert sorted(tuple(r) for r in merge.merge_on_asset_id([a, empty, b]).collect()) == [("x", 1, 3), ("y", 2, None)]
    try:
        merge.merge_on_asset_id([a, bad])
        raise AssertionError("a null key must be refused")
    except ValueError:
        pass
