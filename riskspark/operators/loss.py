"""Expected yearly loss per asset as column expressions; one projection, no shuffle.

Missing columns are settled from the table's columns when the plan is built.
A zero counts as "not given" only where noted, null is carried through as noted.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import clip, column_or, lenient_double

MEDIUM_PER_MINUTE = 840.0  # fixed value: where a cost table names no medium level

Costs = Mapping[str, Mapping[str, float]]


def _cost(costs: Costs, part: str, name: str) -> float:
    return float((costs.get(part) or {}).get(name, C.COSTS[part][name]))


def _number(df: DataFrame, names: list[str], default: float | Column) -> Column:
    found = [n for n in names if n in df.columns]
    if found:
        return lenient_double(F.col(found[0]))
    return default if isinstance(default, Column) else F.lit(float(default))


def _per_vulnerability(df: DataFrame, name: str, each: int) -> Column:
    """A given figure, else so many per known vulnerability."""
    return _number(df, [name], _number(df, ["vuln_count"], 1) * each)


def _zero_is(value: Column, default: float) -> Column:
    return F.when(value == 0, F.lit(float(default))).otherwise(value)


def data_breach_loss(df: DataFrame, costs: Costs = C.COSTS) -> Column:
    """Record cost with a floor, raised by up to 100 % with severity; unknown records count as the floor."""
    floor = _cost(costs, "data_breach", "baseline_cost_usd") * 0.15
    records = _per_vulnerability(df, "estimated_records_at_risk", 1000)
    impact = _number(df, ["vulnerability_impact_score_max", "cvss_score_max"], 5)
    cost = F.greatest(F.lit(floor), records * _cost(costs, "data_breach", "cost_per_record_usd"))
    return cost * (clip(impact / 20, high=1) + 1)


def ransomware_loss(df: DataFrame, costs: Costs = C.COSTS) -> Column:
    """Ransom plus recovery times the strongest signal, at least 0.15; unknown pressure is ignored."""
    payment = _cost(costs, "ransomware", "avg_ransom_payment_usd") * _cost(costs, "ransomware", "payment_rate")
    flag = _number(df, ["known_ransomware_max", "kev_flag_max"], 0)
    pressure = _number(df, ["epss_score_max", "exploit_risk_score_max"], 0)
    signal = F.when(flag.isNotNull(), F.greatest(flag, pressure, F.lit(0.15)))
    return signal * (payment + _cost(costs, "ransomware", "avg_recovery_cost_usd"))


def downtime_loss(df: DataFrame, costs: Costs = C.COSTS) -> Column:
    """Cost per minute by business criticality (unknown words count as medium) times hours down.

    Levels come from the given cost table only.

    The default of the hours reads ``sev_count_CRITICAL`` in exactly this spelling,
    so tables with lower-case severity columns get the plain 8 hours.
    """
    per_minute = costs.get("downtime") or {}
    suffix = "_systems_cost_per_min_usd"
    word = F.lower(column_or(df, ["business_criticality", "business_criticality_mode"], "medium").cast("string"))
    levels = {n.removesuffix(suffix): float(v) for n, v in per_minute.items() if n.endswith(suffix)}
    rate = F.lit(levels.get("medium", MEDIUM_PER_MINUTE))
    for level, cost in levels.items():
        rate = F.when(word == level, F.lit(cost)).otherwise(rate)
    hours = _number(df, ["estimated_downtime_hours"], _number(df, ["sev_count_CRITICAL"], 0) * 12 + 8)
    return rate * hours * 60


def legal_loss(df: DataFrame, costs: Costs = C.COSTS) -> Column:
    """Litigation and fine up to 100,000 records, plus notification per record."""
    fixed = _cost(costs, "legal", "avg_litigation_cost_usd") + _cost(costs, "legal", "avg_regulatory_fine_usd")
    records = _per_vulnerability(df, "estimated_records_at_risk", 1000)
    notice = records * _cost(costs, "legal", "notification_cost_per_record_usd")
    return clip(records / 100_000, high=1) * fixed + notice


def reputation_loss(df: DataFrame, costs: Costs = C.COSTS) -> Column:
    """Customers lost times their lifetime value."""
    churn = _cost(costs, "reputation", "avg_customer_churn_rate_post_breach")
    customers = _per_vulnerability(df, "estimated_customer_count", 100)
    return customers * churn * _cost(costs, "reputation", "avg_customer_ltv_usd")


def exploit_probability(df: DataFrame) -> Column:
    """Chance of exploitation in [0.001, 0.95]; zero EPSS counts as 0.01, zero CVSS as 5."""
    epss = _zero_is(_number(df, ["epss_score_max", "epss_score_mean"], 0.01), 0.01)
    cvss = _zero_is(_number(df, ["cvss_score_max", "cvss_score_mean"], 5), 5) / 10
    kev = _number(df, ["kev_flag_max"], 0)
    public = _number(df, ["has_public_exploit_max", "is_exploitable_max"], 0)
    pressure = _number(df, ["threat_pressure_factor_max"], _number(df, ["pentest_risk_score"], 0) / 100)
    return clip(epss * (kev * 1.5 + public * 0.75 + 1) + cvss * 0.08 + pressure * 0.05, 0.001, 0.95)


def estimate_losses(df: DataFrame, costs: Costs = C.COSTS) -> DataFrame:
    """Five loss parts, their sum (null parts skipped), probability and expected yearly loss."""
    parts = [data_breach_loss, ransomware_loss, downtime_loss, legal_loss, reputation_loss]
    out = df.withColumns({name: part(df, costs) for name, part in zip(C.LOSS_COLUMNS, parts, strict=True)})
    impact = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in C.LOSS_COLUMNS])
    out = out.withColumns({"financial_impact_usd": impact, "exploit_probability": exploit_probability(df)})
    return out.withColumn(C.SOURCE_TARGET, expected_annual_loss("exploit_probability", "financial_impact_usd"))


def expected_annual_loss(probability: str, impact: str) -> Column:
    """Probability times impact, neither below zero; unknown if either is."""
    return clip(F.col(probability), low=0) * clip(F.col(impact), low=0)
