"""Scan findings to one scored row per asset."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import clip, column_or, lenient_double
from riskspark.operators.threat import weight_of


def stack_findings(tables: Iterable[DataFrame]) -> DataFrame:
    """All tools' findings in one table; columns a tool lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def build_pentest_features(findings: DataFrame) -> DataFrame:
    """Counts and weight sum per asset from one aggregation."""
    severity = F.upper(F.coalesce(column_or(findings, "severity", "").cast("string"), F.lit("")))
    port = column_or(findings, "port", None).cast("string")
    rows = findings.where(F.col("asset_id").isNotNull()).withColumns(
        {
            "_severity": severity,
            "_weight": weight_of(severity, C.FINDING_WEIGHT, C.OTHER_FINDING_WEIGHT),
            "_port": lenient_double(port),
        }
    )
    columns = [
        F.count("_port").alias("open_port_count"),
        F.count("source_tool").alias("finding_count"),
        F.coalesce(F.sum("_weight"), F.lit(0.0)).alias("pentest_weight_sum"),
        F.count_if(F.col("_severity") == "CRITICAL").alias("critical_findings"),
        F.count_if(F.col("_severity") == "HIGH").alias("high_findings"),
    ]
    if "subdomain" in findings.columns:
        columns.append(F.count_distinct(F.col("subdomain")).alias("subdomain_count"))
    return rows.groupBy("asset_id").agg(*columns)


def score_pentest_risk(features: DataFrame) -> DataFrame:
    """Score 0-100 and grade; a score on a bound belongs to the lower grade."""
    raw = (
        column_or(features, "pentest_weight_sum", 0.0)
        + column_or(features, "open_port_count", 0) * 0.4
        + column_or(features, "subdomain_count", 0) * 0.15
    )
    out = features.withColumn("pentest_risk_score", clip(raw, 0, 100))
    score, grade = F.col("pentest_risk_score"), None
    for label, top in C.GRADE_BOUNDS:
        grade = F.when(score <= top, label) if grade is None else grade.when(score <= top, label)
    return out.withColumn("pentest_risk_grade", grade.otherwise("nan"))
