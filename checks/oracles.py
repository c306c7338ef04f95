"""The SQL each query is compared with, as DuckDB text over the given tables.

Sums and logarithms may differ in their last bits between engines, so doubles are
rounded on both sides. A small offset before rounding (``settled`` here, ``settle``
in queries.py) keeps exact half-way decimals off the rounding bound.
"""

from __future__ import annotations

import re

from checks.proxies import ASSET, FINDING, THREAT
from riskspark import constants as C


def settled(sql: str, digits: int = 4, name: str | None = None) -> str:
    scale = float(10**digits)
    text = f"round_even((({sql}) + {0.00137 / scale!r}) * {scale!r}, 0) / {scale!r}"
    return f"{text} AS {name}" if name else text


def rounded(sql: str, digits: int) -> str:
    """The library's own rounding."""
    scale = float(10**digits)
    return f"round_even(({sql}) * {scale!r}, 0) / {scale!r}"


def words(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def numbers(values: list[int]) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]"


def texts(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --- threat chain ----------------------------------------------------------------

CTES = {
    "threat": THREAT,
    "complete": """
SELECT * REPLACE (
   CASE WHEN lower(trim(coalesce(severity, 'low'))) IN ('informational', 'none') THEN 'info'
        ELSE lower(trim(coalesce(severity, 'low'))) END AS severity,
   CAST(exploit_count AS DOUBLE) AS exploit_count),
 asset_id || '::' || coalesce(cve_id, '') AS record_id, coalesce(source, 'unknown') AS source_feed,
 published AS published_date, coalesce(date_added, published) AS first_seen, 0 AS days_active,
 coalesce(length(CAST(date_added AS VARCHAR)) > 0, false) AS kev_listed,
 asset_exposure_score AS affected_systems_count,
 CASE WHEN upper(coalesce(scope, '')) IN ('GLOBAL', 'EXTERNAL', 'INTERNET') THEN 'network' ELSE 'local' END AS attack_vector
FROM threat""",
    "valid": """
SELECT * FROM complete WHERE asset_id IS NOT NULL AND length(asset_id) > 0
 AND (cvss_score IS NULL OR cvss_score BETWEEN 0 AND 10) AND (epss_score IS NULL OR epss_score BETWEEN 0 AND 1)""",
    "typed": """
SELECT * REPLACE (CAST(coalesce(trunc(exploit_count), 0) AS BIGINT) AS exploit_count,
 CAST(coalesce(trunc(affected_systems_count), 0) AS BIGINT) AS affected_systems_count) FROM valid""",
    "clean": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, cve_id, source_feed
 ORDER BY last_seen DESC NULLS LAST, tie_a DESC, tie_b DESC, tie_c DESC) AS rn FROM typed) WHERE rn = 1""",
}


def neighbour_ctes(target: str, given: str, tag: str) -> dict[str, str]:
    return {
        f"donor_{tag}": f"""
SELECT {given} AS k, count(*) AS n, sum({target}) AS s FROM clean
WHERE {given} IS NOT NULL AND {target} IS NOT NULL GROUP BY {given}""",
        f"asked_{tag}": f"SELECT DISTINCT {given} AS k FROM clean WHERE {target} IS NULL AND {given} IS NOT NULL",
        f"near_{tag}": f"""
SELECT a.k, d.n, d.s, coalesce(sum(d.n) OVER (PARTITION BY a.k ORDER BY abs(d.k - a.k), d.k
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM asked_{tag} a CROSS JOIN donor_{tag} d""",
        f"fill_{tag}": f"""
SELECT k, sum(greatest(least(n, 5 - before), 0) * s / n) / sum(greatest(least(n, 5 - before), 0)) AS fill
FROM near_{tag} GROUP BY k""",
    }


CTES |= neighbour_ctes("cvss_score", "epss_score", "c") | neighbour_ctes("epss_score", "cvss_score", "e")
CTES["imputed"] = """
SELECT clean.* REPLACE (
  coalesce(cvss_score, CASE WHEN epss_score IS NULL THEN m.c ELSE fill_c.fill END) AS cvss_score,
  coalesce(epss_score, CASE WHEN cvss_score IS NULL THEN m.e ELSE fill_e.fill END) AS epss_score)
FROM clean
LEFT JOIN fill_c ON clean.cvss_score IS NULL AND clean.epss_score = fill_c.k
LEFT JOIN fill_e ON clean.epss_score IS NULL AND clean.cvss_score = fill_e.k
CROSS JOIN (SELECT avg(cvss_score) AS c, avg(epss_score) AS e FROM clean) m"""


def engineered(source: str) -> str:
    severity = "CASE severity WHEN 'critical' THEN 4.0 WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'low' THEN 1.0 ELSE 0.0 END"
    vector = "CASE attack_vector WHEN 'network' THEN 4.0 WHEN 'adjacent' THEN 3.0 WHEN 'local' THEN 2.0 WHEN 'physical' THEN 1.0 ELSE 0.0 END"
    # Typed as doubles: plain decimal literals would make DuckDB calculate in decimals.
    score = (
        f"((cvss_score / 10 * 0.4::DOUBLE + coalesce(epss_score, 0) * 0.3::DOUBLE + CAST({severity} AS DOUBLE) / 4 * 0.2::DOUBLE "
        f"+ CAST({vector} AS DOUBLE) / 4 * 0.1::DOUBLE) * 10 + CAST(kev_listed AS INT) * 0.5::DOUBLE)"
    )
    clipped = f"CASE WHEN cvss_score IS NOT NULL THEN least(greatest({score}, 0), 10) END"
    days = lambda c: f"greatest((epoch_us(TIMESTAMP '2024-02-01') - epoch_us({c})) // 86400000000, 0)"
    return f"""
SELECT *, {rounded("composite_risk_score * ln(1 + exploit_count)", 4)} AS risk_exploit_product FROM (
SELECT *, {rounded(clipped, 4)} AS composite_risk_score,
 {days('published_date')} AS days_since_published, {days('first_seen')} AS days_since_first_seen,
 CAST(coalesce(epss_score >= 0.1, false) AS INT) AS is_exploitable,
 CAST(coalesce(severity = 'critical', false) AS INT) AS is_critical,
 CAST(coalesce(attack_vector = 'network', false) AS INT) AS is_network_exposed,
 CAST(kev_listed AS INT) AS kev_flag,
 {rounded('epss_score * cvss_score', 4)} AS epss_cvss_interaction
FROM {source})"""


def scaled(source: str) -> str:
    stats = [f"min({c}) AS {c}_lo, max({c}) - min({c}) AS {c}_spread" for c in C.MINMAX_COLUMNS]
    stats += [f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_dev" for c in C.STANDARD_COLUMNS]
    one = lambda c: f"CASE WHEN {c} = 0 THEN 1 ELSE {c} END"
    new = [f"({c} - {c}_lo) / ({one(c + '_spread')}) AS {c}" for c in C.MINMAX_COLUMNS]
    new += [f"({c} - {c}_mean) / ({one(c + '_dev')}) AS {c}" for c in C.STANDARD_COLUMNS]
    return f"SELECT {source}.* REPLACE ({', '.join(new)}) FROM {source} CROSS JOIN (SELECT {', '.join(stats)} FROM {source}) s"


AGGREGATE_OUTPUTS = [f"{c}_{fn}" for c, fns in C.ASSET_AGGREGATES.items() for fn in fns]


def aggregated(source: str) -> str:
    sql = {"max": "max", "min": "min", "mean": "avg", "sum": "sum"}
    parts = [f"{sql[fn]}({c}) AS {c}_{fn}" for c, fns in C.ASSET_AGGREGATES.items() for fn in fns]
    parts += ["count(*) AS vuln_count", "count(DISTINCT cve_id) AS unique_cve_count"]
    parts += [f"count(*) FILTER (severity = '{w}') AS sev_count_{w}" for w in C.SEVERITIES]
    return f"SELECT asset_id, {', '.join(parts)} FROM {source} GROUP BY asset_id"


ASSET_COUNTS = ["vuln_count", "unique_cve_count", *[f"sev_count_{w}" for w in C.SEVERITIES]]
CTES["engineered"] = engineered("imputed")
CTES["scaled"] = scaled("engineered")
CTES["rolled"] = aggregated("scaled")
# The same without filling and scaling: input of the model-table queries.
CTES["engineered_raw"] = engineered("clean")
CTES["rolled_raw"] = aggregated("engineered_raw")


def losses(source: str) -> str:
    d = lambda x: f"{x!r}::DOUBLE"
    return f"""
SELECT *, least(greatest(epss * (1 + kev_flag_max * 1.5::DOUBLE + is_exploitable_max * 0.75::DOUBLE)
   + cvss / 10 * 0.08::DOUBLE + pressure * 0.05::DOUBLE, 0.001), 0.95) * financial_impact_usd AS expected_annual_loss_usd,
 least(greatest(epss * (1 + kev_flag_max * 1.5::DOUBLE + is_exploitable_max * 0.75::DOUBLE)
   + cvss / 10 * 0.08::DOUBLE + pressure * 0.05::DOUBLE, 0.001), 0.95) AS exploit_probability FROM (
SELECT *, loss_data_breach_usd + loss_ransomware_usd + loss_downtime_usd + loss_legal_usd + loss_reputation_usd
 AS financial_impact_usd FROM (
SELECT *,
 greatest({d(4_880_000 * 0.15)}, vuln_count * 1000 * 165.0::DOUBLE) * (1 + least(cvss_score_max / 20, 1)) AS loss_data_breach_usd,
 {d(2_540_000 * 0.46 + 1_850_000.0)} * greatest(kev_flag_max, epss_score_max, 0.15) AS loss_ransomware_usd,
 840.0::DOUBLE * 8 * 60 AS loss_downtime_usd,
 1940000.0::DOUBLE * least(vuln_count * 1000 / 100000, 1) + 3.5::DOUBLE * vuln_count * 1000 AS loss_legal_usd,
 vuln_count * 100 * 0.038::DOUBLE * 4200 AS loss_reputation_usd,
 CASE WHEN epss_score_max = 0 THEN 0.01 ELSE epss_score_max END AS epss,
 CASE WHEN cvss_score_max = 0 THEN 5.0 ELSE cvss_score_max END AS cvss FROM {source}))"""


CTES["priced_raw"] = losses("(SELECT *, 0.0 AS pressure FROM rolled_raw)")

# --- findings --------------------------------------------------------------------

CTES["finding"] = FINDING
CTES["pentest"] = """
SELECT asset_id, count(TRY_CAST(port AS DOUBLE)) AS open_port_count, count(source_tool) AS finding_count,
 sum(CASE s WHEN 'CRITICAL' THEN 10.0 WHEN 'HIGH' THEN 7.0 WHEN 'MEDIUM' THEN 4.0 WHEN 'LOW' THEN 1.0
     WHEN 'INFO' THEN 0.25 WHEN 'INFORMATIONAL' THEN 0.25 ELSE 0.5 END)::DOUBLE AS pentest_weight_sum,
 count(*) FILTER (s = 'CRITICAL') AS critical_findings, count(*) FILTER (s = 'HIGH') AS high_findings,
 count(DISTINCT subdomain) AS subdomain_count
FROM (SELECT *, upper(coalesce(severity, '')) AS s FROM finding) GROUP BY asset_id"""
CTES["pentest_scored"] = """
SELECT *, CASE WHEN score <= 10 THEN 'LOW' WHEN score <= 30 THEN 'MEDIUM' WHEN score <= 60 THEN 'HIGH' ELSE 'CRITICAL' END
 AS pentest_risk_grade, score AS pentest_risk_score FROM (SELECT *,
 least(greatest(pentest_weight_sum + open_port_count * 0.4::DOUBLE + subdomain_count * 0.15::DOUBLE, 0), 100) AS score FROM pentest)"""

# --- assets ----------------------------------------------------------------------

OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LABEL = "[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
RULES = [
    ("starts_with(asset_id, 'ASSET-')", "asset_id must start with 'ASSET-'"),
    (f"host = '' OR regexp_full_match(host, '({OCTET}[.]){{3}}{OCTET}')", "host is not a valid IPv4 or IPv6 address"),
    (
        f"domain = '' OR regexp_full_match(domain, '({LABEL}[.])+[a-zA-Z]{{2,63}}') AND length(domain) <= 253",
        "domain is not a valid hostname or FQDN",
    ),
    ("len(list_filter(ports, lambda p: p < 1 OR p > 65535)) = 0", "ports must be whole numbers from 1 to 65535"),
    ("port_of_service IS NULL OR (port_of_service BETWEEN 1 AND 65535 AND name_of_service <> '')", "services need a valid port and a name"),
    ("TRY_CAST(last_seen AS TIMESTAMPTZ) IS NOT NULL", "last_seen cannot be parsed"),
    ("host <> '' OR domain <> ''", "both host and domain are empty"),
]
CTES["asset"] = ASSET
CTES["asset_typed"] = """
SELECT trim(asset_id) AS asset_id, trim(host) AS host, trim(domain) AS domain, last_seen,
 coalesce(CAST(ports AS INT[]), []) AS ports,
 TRY_CAST(nullif(regexp_extract(services, '"port":([0-9]+)', 1), '') AS INT) AS port_of_service,
 lower(regexp_extract(services, '"service":"([^"]*)"', 1)) AS name_of_service,
 lower(regexp_extract(tags, '"([^"]*)"', 1)) AS tag,
 CASE WHEN discovered_by LIKE '%nmap%' THEN ['nmap', 'crtsh'] ELSE ['crtsh'] END AS discovered_by,
 lower(internet_exposed) IN ('true', '1', 'yes') AS internet_exposed FROM asset"""
CTES["asset_judged"] = (
    "SELECT *, concat_ws('; ', "
    + ", ".join(f"CASE WHEN NOT ({rule}) THEN '{text.replace(chr(39), chr(39) * 2)}' END" for rule, text in RULES)
    + ") AS reason FROM asset_typed"
)
CTES["asset_good"] = """
SELECT * REPLACE (lower(domain) AS domain), list_distinct(ports) AS open_ports,
 CASE WHEN name_of_service <> '' THEN [name_of_service] ELSE []::VARCHAR[] END AS names FROM asset_judged WHERE reason = ''"""
overlap = lambda column, values: f"list_has_any({column}, {values})"
CTES["asset_flagged"] = f"""
SELECT *, len(open_ports) AS number_of_ports, CASE WHEN port_of_service IS NULL THEN 0 ELSE 1 END AS number_of_services,
 {overlap('names', texts(C.WEB_SERVICES))} OR {overlap('open_ports', numbers(C.WEB_PORTS))} AS has_web_service,
 {overlap('names', texts(C.DATABASE_SERVICES))} OR {overlap('open_ports', numbers(C.DATABASE_PORTS))} AS has_database_service,
 tag = 'tls' OR list_contains(open_ports, 443) OR {overlap('names', texts(C.TLS_SERVICES))} AS has_tls,
 {overlap('names', texts(C.REMOTE_SERVICES))} OR {overlap('open_ports', numbers(C.REMOTE_PORTS))} AS has_remote_access_service,
 {overlap('open_ports', numbers(C.HIGH_RISK_PORTS))} AS high_risk, internet_exposed AS is_public_asset FROM asset_good"""
CTES["asset_enriched"] = f"""
SELECT *,
 {rounded("least(0.10 * least(number_of_ports / 20, 1.0) + CASE WHEN is_public_asset THEN 0.40 ELSE 0 END + CASE WHEN high_risk THEN 0.30 ELSE 0 END + CASE WHEN has_remote_access_service THEN 0.15 ELSE 0 END + CASE WHEN has_database_service THEN 0.05 ELSE 0 END, 1.0)::DOUBLE", 4)} AS exposure_score,
 {rounded("least(CASE WHEN is_public_asset THEN 3.0 ELSE 0 END + CASE WHEN has_remote_access_service THEN 2.5 ELSE 0 END + CASE WHEN has_database_service THEN 2.0 ELSE 0 END + CASE WHEN high_risk THEN 1.5 ELSE 0 END + CASE WHEN has_web_service THEN 0.5 ELSE 0 END + CASE WHEN number_of_ports > 5 THEN 0.3 ELSE 0 END + CASE WHEN number_of_ports > 10 THEN 0.2 ELSE 0 END, 10.0)::DOUBLE", 2)} AS asset_risk_score,
 CASE WHEN tag = 'firewall' OR {overlap('names', texts(C.FIREWALL_SERVICES))} THEN 'Firewall'
  WHEN has_remote_access_service AND ({overlap('names', "['rdp', 'ms-wbt-server', 'microsoft-ds']")} OR list_contains(open_ports, 3389)) THEN 'Windows Server'
  WHEN (list_contains(names, 'ssh') OR list_contains(open_ports, 22)) AND NOT ({overlap('names', "['rdp', 'ms-wbt-server']")} OR list_contains(open_ports, 3389)) THEN 'Linux Server'
  WHEN has_database_service THEN 'Database Server'
  WHEN {overlap('names', texts(C.SMB_SERVICES))} THEN 'Windows File Server'
  WHEN has_web_service THEN 'Web Server'
  WHEN {overlap('names', texts(C.MAIL_SERVICES))} OR {overlap('open_ports', numbers(C.MAIL_PORTS))} THEN 'Mail Server'
  WHEN {overlap('names', texts(C.DNS_SERVICES))} OR list_contains(open_ports, 53) THEN 'DNS Server'
  WHEN domain <> '' AND host = '' AND list_contains(discovered_by, 'crtsh') THEN 'Domain Asset'
  WHEN domain <> '' AND host <> '' AND number_of_ports = 0 THEN 'Domain Asset'
  WHEN host <> '' AND domain = '' AND number_of_ports = 0 THEN 'Network Host'
  ELSE 'Unknown' END AS asset_type FROM asset_flagged"""

CTES["portfolio"] = losses(
    "(SELECT rolled.*, p.pentest_weight_sum, p.pentest_risk_score, p.pentest_risk_grade, p.finding_count, a.asset_type, "
    "a.asset_risk_score, a.exposure_score, p.pentest_risk_score / 100 AS pressure "
    "FROM rolled LEFT JOIN pentest_scored p USING (asset_id) LEFT JOIN asset_enriched a USING (asset_id))"
)

# --- model table -----------------------------------------------------------------

L = "ln(1 + {})".format
CTES["modelled"] = f"""
SELECT *, composite_vulnerability_score * (1 + kev_feature_strength) AS weighted_risk_index FROM (SELECT *,
 least(greatest(0.7 * cmax + 0.3 * cmean, 0), 10) AS cvss_severity_score,
 {L('affected')} AS asset_criticality_encoding, {L('kevs')} + kev_flag_max AS kev_feature_strength,
 {L('exploits')} * (1 + emax) AS exploit_activity_score, network + {L('affected')} AS exposure_score,
 coalesce(vuln_count / nullif(unique_cve_count, 0), 0) AS threat_density,
 {L('vuln_count')} * (1 + network) * (1 + cmax / 10) AS attack_surface_score, rmax * {L('affected')} AS business_risk_score,
 0.35 * cmax + 3.0 * emax + 0.2 * pmax + 0.15 * sev_count_critical AS composite_vulnerability_score,
 {L('vuln_count')} AS threat_frequency, cmax * {L('affected')} AS cvss_asset_criticality_interaction,
 emax * {L('exploits')} AS epss_exploit_count_interaction, network AS attack_vector_encoding,
 {L('unique_cve_count')} * (1 + sev_count_high + sev_count_critical) AS vendor_product_risk,
 cmean AS mean_cvss_per_asset, cmax AS maximum_cvss, emean AS average_epss, rmax / (1 + {L('age')}) AS recent_threat_score,
 {L('affected')} * (1 + network) AS business_exposure_index, {L('affected + vuln_count')} AS asset_importance_score,
 rmean * (1 + pmean) AS threat_intelligence_confidence, age AS vulnerability_age,
 CASE WHEN exploits > 0 OR kevs > 0 THEN 1 ELSE 0 END AS exploit_availability FROM (SELECT *,
 greatest(coalesce(cvss_score_max, 0), 0) AS cmax, greatest(coalesce(cvss_score_mean, 0), 0) AS cmean,
 greatest(coalesce(epss_score_max, 0), 0) AS emax, greatest(coalesce(epss_score_mean, 0), 0) AS emean,
 greatest(exploit_count_sum, 0)::DOUBLE AS exploits, greatest(affected_systems_count_sum, 0)::DOUBLE AS affected,
 is_network_exposed_max::DOUBLE AS network, kev_flag_sum::DOUBLE AS kevs, days_since_published_max::DOUBLE AS age,
 coalesce(composite_risk_score_max, 0) AS rmax, coalesce(composite_risk_score_mean, 0) AS rmean,
 coalesce(epss_cvss_interaction_max, 0) AS pmax, coalesce(epss_cvss_interaction_mean, 0) AS pmean FROM priced_raw))"""
CYBER = [
    "cvss_severity_score", "asset_criticality_encoding", "kev_feature_strength", "exploit_activity_score", "exposure_score",
    "threat_density", "attack_surface_score", "business_risk_score", "composite_vulnerability_score", "threat_frequency",
    "cvss_asset_criticality_interaction", "epss_exploit_count_interaction", "attack_vector_encoding", "vendor_product_risk",
    "mean_cvss_per_asset", "maximum_cvss", "average_epss", "recent_threat_score", "business_exposure_index",
    "weighted_risk_index", "asset_importance_score", "threat_intelligence_confidence", "vulnerability_age",
]


def chain(last: str, *needed: str) -> str:
    """``last`` preceded by the named steps and everything they build on."""
    order = list(CTES)
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        for other in order[: order.index(name)]:
            if re.search(rf"\b{other}\b", CTES[name]):
                need(other)

    for name in needed:
        need(name)
    parts = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in order if n in wanted)
    return f"WITH {parts} {last}"


LOSSES = [*C.LOSS_COLUMNS, "financial_impact_usd", "expected_annual_loss_usd"]
ROW = ["asset_id", "cve_id", "tie_a", "tie_b"]


def row_list() -> str:
    return ", ".join(ROW)


def aggregates(source: str) -> str:
    doubles = ", ".join(settled(c, 4, c) for c in AGGREGATE_OUTPUTS)
    counts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ASSET_COUNTS)
    return f"SELECT asset_id, {counts}, {doubles} FROM {source}"


def long_counts(section: str, pairs: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{item}' AS item, CAST({sql} AS DOUBLE) AS value FROM {source}" for item, sql in pairs
    )


CORRELATED = [
    "cvss_score_mean", "epss_score_mean", "composite_risk_score_mean", "vuln_count", "unique_cve_count", "exploit_count_sum",
    "affected_systems_count_sum", "kev_flag_sum", "sev_count_low", "sev_count_high",
]
INFORMED = ["vuln_count", "epss_score_mean", "kev_flag_sum", "sev_count_high"]
PROFILED = ["epss_score_mean", "cvss_score_mean", "vuln_count", "kev_flag_sum", "sev_count_low"]
SCORED = ["epss_score_mean", "vuln_count", "kev_flag_sum", "sev_count_low"]
WEIGHTS = {"epss_score_mean": 0.4, "vuln_count": 0.003, "kev_flag_sum": 0.01, "sev_count_low": 0.005}
MODEL_METRICS = {"mae": 28143.77, "mape": 3.083}


def unpivot(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns)


def information_sql(bins: int = 8) -> str:
    steps = "[" + ", ".join(f"{i / bins!r}" for i in range(1, bins)) + "]"
    edge = lambda c: f"(SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), {steps})) FROM priced_raw)"
    place = lambda c: f"len(list_filter({edge(c)}, lambda e: {c} > e))"
    target = "expected_annual_loss_usd"
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {settled("greatest(sum(n / t * ln(n * t / (nx * ny))), 0)", 6, "mutual_information")} FROM (
SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM (
SELECT {place(c)} AS x, {place(target)} AS y, count(*)::DOUBLE AS n FROM priced_raw GROUP BY ALL))"""
        for c in INFORMED
    )



def psi_sql(n: str) -> str:
    """Digamma for n >= 1, the same series as the library's: six recurrence steps, then asymptotics."""
    m = f"(CAST({n} AS DOUBLE) + 6.0)"
    steps = " + ".join(f"1.0 / (CAST({n} AS DOUBLE) + {j}.0)" for j in range(6))
    return f"(ln({m}) - 0.5 / {m} - {1.0 / 12!r} / ({m} * {m}) + {1.0 / 120!r} / pow({m}, 4) - {1.0 / 252!r} / pow({m}, 6) - ({steps}))"


def neighbour_sql(k: int = 3) -> str:
    """Brute force: every pair of rows, the k-th smallest distance by sorting, counts by comparing with all rows."""
    target = "expected_annual_loss_usd"
    parts = []
    for c in INFORMED:
        parts.append(f"""SELECT '{c}' AS feature, {settled(f"CASE WHEN max(n) > {k} THEN greatest({psi_sql('max(n)')} + {psi_sql(str(k))} - avg({psi_sql('nx + 1')}) - avg({psi_sql('ny + 1')}), 0) END", 6, "mutual_information")}, CAST(max(n) AS BIGINT) AS rows FROM (
WITH b AS (SELECT CAST({c} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y FROM priced_raw
  WHERE isfinite(CAST({c} AS DOUBLE)) AND isfinite(CAST({target} AS DOUBLE))),
s AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my,
  CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS sx, CASE WHEN stddev_pop(y) > 0 THEN stddev_pop(y) ELSE 1 END AS sy FROM b),
p AS (SELECT row_number() OVER () AS i, round((x - mx) / sx, 9) AS u, round((y - my) / sy, 9) AS v FROM b, s),
e AS (SELECT a.i, a.u, a.v, list_sort(list(greatest(abs(o.u - a.u), abs(o.v - a.v))))[{k}] AS eps
  FROM p a JOIN p o ON a.i <> o.i GROUP BY a.i, a.u, a.v),
c AS (SELECT e.i,
  (SELECT count(*) FROM p WHERE CASE WHEN e.eps > 0 THEN p.u > e.u - e.eps AND p.u < e.u + e.eps ELSE p.u = e.u END) - 1 AS nx,
  (SELECT count(*) FROM p WHERE CASE WHEN e.eps > 0 THEN p.v > e.v - e.eps AND p.v < e.v + e.eps ELSE p.v = e.v END) - 1 AS ny
  FROM e)
SELECT c.nx, c.ny, s.n FROM c, s)""")
    return " UNION ALL ".join(parts)


def root_split_sql(bins: int = 8, lam: float = 1.0, min_hessian: float = 1.0) -> str:
    """Second-order gain of every border of every feature at the root; the largest wins."""
    steps = "[" + ", ".join(f"{i / bins!r}" for i in range(1, bins)) + "]"
    target = "expected_annual_loss_usd"
    rows = f"(SELECT * FROM priced_raw WHERE {target} IS NOT NULL)"
    edge = lambda c: f"(SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), {steps})) FROM {rows})"
    place = lambda c: f"CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter({edge(c)}, lambda e: CAST({c} AS DOUBLE) > e)) END"
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, {place(c)} AS bin, g FROM grad" for c in INFORMED)
    score = lambda g, h: f"({g}) * ({g}) / (({h}) + {lam!r})"
    return f"""SELECT * FROM (WITH base AS (SELECT avg(CAST({target} AS DOUBLE)) AS m FROM {rows}),
grad AS (SELECT r.*, base.m - CAST(r.{target} AS DOUBLE) AS g FROM {rows} r, base),
sse AS (SELECT sum(g * g) AS e FROM grad),
hist AS (SELECT feature, bin, sum(g) AS g, count(*)::DOUBLE AS h FROM ({cells}) GROUP BY feature, bin),
cum AS (SELECT feature, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
  sum(g) OVER (PARTITION BY feature) AS gt, sum(h) OVER (PARTITION BY feature) AS ht
  FROM hist WINDOW w AS (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cand AS (SELECT feature, bin, hl, ht - hl AS hr,
  {score("gl", "hl")} + {score("gt - gl", "ht - hl")} - {score("gt", "ht")} AS gain
  FROM cum WHERE hl >= {min_hessian!r} AND ht - hl >= {min_hessian!r})
SELECT CAST(1 AS BIGINT) AS node, feature, bin, CAST(hl AS BIGINT) AS left_rows, CAST(hr AS BIGINT) AS right_rows,
  {settled("gain / CASE WHEN e > 0 THEN e ELSE 1 END", 6, "gain_share")}
FROM cand, sse WHERE gain > 0 ORDER BY gain DESC, feature, bin LIMIT 1)"""

def profile_sql(columns: list[str]) -> str:
    q = lambda c, p: f"quantile_cont(CAST({c} AS DOUBLE), {p!r})"
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, min({c})::DOUBLE AS min, {q(c, 0.01)} AS p01, {q(c, 0.05)} AS p05, {q(c, 0.5)} AS median,
 {q(c, 0.95)} AS p95, {q(c, 0.99)} AS p99, max({c})::DOUBLE AS max, greatest({q(c, 0.75)} - {q(c, 0.25)}, 1e-6) AS iqr FROM priced_raw"""
        for c in columns
    )


def scored_sql() -> str:
    """Prediction post-processing for a given loss (here the expected loss a thousandth of)."""
    profiles = f"profiles AS ({profile_sql(SCORED)})"
    pick = lambda c, f: f"(SELECT {f} FROM profiles WHERE feature = '{c}')"
    away = [
        f"least(abs({c} - {pick(c, 'median')}) / {pick(c, 'iqr')} + CASE WHEN {c} < {pick(c, 'p01')} OR {c} > {pick(c, 'p99')} THEN 2.0 ELSE 0.0 END, 12)"
        for c in SCORED
    ]
    parts = ", ".join(
        f"{{'size': abs({c} * {w}::DOUBLE), 'place': {i}, 'label': '{C.FEATURE_LABELS.get(c, c.replace('_', ' ').title())}'}}"
        for i, (c, w) in enumerate(WEIGHTS.items())
    )
    score = "100 * exp(-doubt / scale) * exp(-0.08::DOUBLE * (doubt * 3.92::DOUBLE) / scale)"
    return f"""{profiles}, distanced AS (SELECT *, expected_annual_loss_usd / 1000 AS loss, ({' + '.join(away)}) / {len(SCORED)} AS distance FROM priced_raw),
doubted AS (SELECT *, greatest(loss * 0.03083::DOUBLE, 1) * (1 + least(distance, 12) / 2.5::DOUBLE) AS doubt, greatest(loss, 28143.77::DOUBLE) AS scale,
 list_reverse_sort([{parts}]) AS why FROM distanced)
SELECT asset_id, {settled('loss', 2, 'predicted_loss')}, 'USD' AS currency,
 CASE WHEN loss < 50000 THEN 'Very Low' WHEN loss < 150000 THEN 'Low' WHEN loss < 300000 THEN 'Medium' WHEN loss < 700000 THEN 'High' ELSE 'Critical' END AS risk_level,
 {settled(rounded(score, 2), 2, 'confidence_score')}, {settled('greatest(loss - 1.96::DOUBLE * doubt, 0)', 2, 'prediction_interval_lower')},
 {settled('loss + 1.96::DOUBLE * doubt', 2, 'prediction_interval_upper')},
 why[1].label AS top_feature_1, why[2].label AS top_feature_2, why[3].label AS top_feature_3 FROM doubted"""


def with_more(base: str, more: str) -> str:
    """Further CTEs and the final select after a chain."""
    return base.rsplit(" SELECT 0", 1)[0] + ", " + more


def histogram_sql(value: str, bins: int) -> str:
    low, width = "lo + bin * (hi - lo) / {n}".format(n=bins), "lo + (bin + 1) * (hi - lo) / {n}".format(n=bins)
    return (
        f"SELECT bin, {settled(low, 6, 'low')}, {settled(width, 6, 'high')}, count(v) AS \"count\" FROM "
        f"(SELECT unnest(range({bins}))::INT AS bin) CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM threat) "
        f"LEFT JOIN (SELECT v, least(floor((v - l) / ((h - l) / {bins}))::INT, {bins - 1}) AS place FROM (SELECT {value} AS v, min({value}) OVER () AS l, max({value}) OVER () AS h FROM threat)) ON place = bin "
        "GROUP BY bin, lo, hi"
    )


def share(purpose: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{purpose}:{seed}:' || asset_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


LINE = "(SELECT asset_id, epss_score_mean::DOUBLE AS x, expected_annual_loss_usd::DOUBLE AS y FROM priced_raw WHERE epss_score_mean IS NOT NULL)"


def learning_curve_sql() -> str:
    rows = f"(SELECT *, floor({share('fold')} * 3)::INT AS f, {share('size')} AS s FROM {LINE})"
    parts = []
    for size in (0.2, 0.4, 0.6, 0.8, 1.0):
        for fold in range(3):
            inside = f"f <> {fold} AND s < {size}"
            error = "(y - (exp(a + b * x) - 1))"
            parts.append(
                f"SELECT {size}::DOUBLE AS share, count(*) FILTER ({inside}) AS n, sqrt(avg({error} * {error}) FILTER ({inside})) AS seen, sqrt(avg({error} * {error}) FILTER (f = {fold})) AS unseen "
                f"FROM {rows} CROSS JOIN (SELECT regr_slope(ln(1 + y), x) AS b, regr_intercept(ln(1 + y), x) AS a FROM {rows} WHERE {inside})"
            )
    return (
        f"SELECT {settled('share', 2, 'share')}, {settled('avg(n)', 3, 'train_rows')}, {settled('avg(seen) / 1000', 3, 'train_rmse')}, {settled('avg(unseen) / 1000', 3, 'validation_rmse')} "
        f"FROM ({' UNION ALL '.join(parts)}) t GROUP BY t.share"
    )


LOSS_INPUTS = """(SELECT *,
 CASE WHEN tie_a % 11 > 0 THEN ['critical', 'High', 'medium', 'low', 'other'][(tie_a % 5 + 1)::INT] END AS word,
 CASE WHEN tie_b <> 3 THEN tie_a % 9000 END AS records, CASE WHEN tie_b <> 4 THEN (tie_a % 30)::DOUBLE END AS hours,
 tie_a % 700 AS customers, CASE WHEN tie_b <> 2 THEN (tie_a % 2)::DOUBLE END AS ransom, (tie_a % 2)::DOUBLE AS kev,
 CASE WHEN tie_b <> 6 THEN (tie_a % 3) / 10.0::DOUBLE END AS epss, (tie_a % 4) * 2.0::DOUBLE AS cvss, (tie_a % 7) / 10.0::DOUBLE AS pressure
 FROM threat WHERE asset_id IS NOT NULL)"""


def wide_losses_sql() -> str:
    levels = {"critical": 5600, "high": 2100, "low": 210}
    parts = {
        "loss_data_breach_usd": "CASE WHEN records IS NULL THEN 732000.0::DOUBLE ELSE greatest(732000.0::DOUBLE, records * 165.0::DOUBLE) END * (1 + least(cvss / 20, 1))",
        "loss_ransomware_usd": "CASE WHEN ransom IS NOT NULL THEN greatest(ransom, coalesce(epss, 0), 0.15::DOUBLE) END * (2540000 * 0.46::DOUBLE + 1850000)",
        "loss_downtime_usd": f"CASE lower(word) {' '.join(f'WHEN {chr(39)}{w}{chr(39)} THEN {v}.0::DOUBLE' for w, v in levels.items())} ELSE 840.0::DOUBLE END * hours * 60",
        "loss_legal_usd": "1940000.0::DOUBLE * least(records / 100000.0::DOUBLE, 1) + 3.5::DOUBLE * records",
        "loss_reputation_usd": "customers * 0.038::DOUBLE * 4200",
    }
    total = " + ".join(f"coalesce({c}, 0)" for c in parts)
    e, c = "CASE WHEN epss = 0 THEN 0.01::DOUBLE ELSE epss END", "CASE WHEN cvss = 0 THEN 5.0::DOUBLE ELSE cvss END"
    raw = f"({e}) * (kev * 1.5::DOUBLE + 1) + ({c}) / 10 * 0.08::DOUBLE + pressure * 0.05::DOUBLE"
    chance = f"CASE WHEN epss IS NOT NULL THEN least(greatest({raw}, 0.001::DOUBLE), 0.95::DOUBLE) END"
    inner = f"(SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in parts.items())}, {chance} AS exploit_probability FROM {LOSS_INPUTS})"
    outer = f"(SELECT *, {total} AS financial_impact_usd, exploit_probability * ({total}) AS expected_annual_loss_usd FROM {inner})"
    return f"SELECT {row_list()}, " + ", ".join(settled(c, 2, c) for c in LOSSES) + f", {settled('exploit_probability', 6, 'exploit_probability')} FROM {outer}"


def oracle_sql() -> dict[str, str]:
    quartile = lambda c, p: f"quantile_cont({c}, {p})"
    fences = ", ".join(
        f"{quartile(c, 0.25)} - 1.5 * ({quartile(c, 0.75)} - {quartile(c, 0.25)}) AS {c}_lo, "
        f"{quartile(c, 0.75)} + 1.5 * ({quartile(c, 0.75)} - {quartile(c, 0.25)}) AS {c}_hi"
        for c in C.OUTLIER_COLUMNS
    )
    outside = " OR ".join(f"coalesce({c} < {c}_lo OR {c} > {c}_hi, false)" for c in C.OUTLIER_COLUMNS)
    moments = ", ".join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_dev" for c in C.OUTLIER_COLUMNS)
    far = " OR ".join(f"coalesce(abs(({c} - {c}_mean) / nullif({c}_dev, 0)) > 1.7, false)" for c in C.OUTLIER_COLUMNS)
    row = row_list()
    loss_columns = ", ".join(settled(c, 2, c) for c in LOSSES)
    flags = ["has_web_service", "has_database_service", "has_tls", "has_remote_access_service"]
    feature_rows = ", ".join(settled(c, 4, c) for c in CYBER)
    target = "expected_annual_loss_usd"
    error = f"({target} - predicted)"
    predicted = (
        "(SELECT *, vuln_count * 190000.0::DOUBLE AS predicted FROM priced_raw)"
    )
    metric = {
        "mae": f"avg(abs({error}))",
        "mse": f"avg({error} * {error}) / 1e9",
        "rmse": f"sqrt(avg({error} * {error}))",
        "r2": f"1 - avg({error} * {error}) / var_pop({target})",
        "mape": f"avg(abs({error} / CASE WHEN {target} = 0 THEN 1 ELSE {target} END)) * 100",
        "explained_variance": f"1 - var_pop({error}) / var_pop({target})",
        "median_absolute_error": f"median(abs({error}))",
    }
    robust = lambda c: f"({c} - {quartile(c, 0.5)} OVER ()) / ({quartile(c, 0.75)} OVER () - {quartile(c, 0.25)} OVER ())"
    pair = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :]]
    summary = " UNION ALL ".join(
        [
            long_counts(
                "pipeline_metadata",
                [
                    ("total_records_processed", "count(*)"),
                    ("accepted", "count(*) FILTER (reason = '')"),
                    ("rejected", "count(*) FILTER (reason <> '')"),
                    ("pass_rate_pct", rounded("count(*) FILTER (reason = '') * 100 / count(*)", 2)),
                ],
                "asset_judged",
            ),
            long_counts(
                "internet_exposure",
                [
                    ("exposed", "count(*) FILTER (is_public_asset)"),
                    ("internal", "count(*) FILTER (NOT is_public_asset)"),
                    ("exposure_pct", rounded("avg(is_public_asset::INT) * 100", 2)),
                ],
                "asset_enriched",
            ),
            long_counts("service_flags", [(f, f"count(*) FILTER ({f})") for f in flags], "asset_enriched"),
            long_counts(
                "port_statistics",
                [
                    ("assets_with_open_ports", "count(*) FILTER (number_of_ports > 0)"),
                    ("max_ports_on_single_asset", "max(number_of_ports)"),
                    ("mean_ports", rounded("avg(number_of_ports)", 3)),
                ],
                "asset_enriched",
            ),
            long_counts(
                "risk_score_distribution",
                [
                    ("mean", rounded("avg(asset_risk_score)", 3)),
                    ("median", rounded("median(asset_risk_score)", 3)),
                    ("max", rounded("max(asset_risk_score)", 3)),
                    ("high_risk_count", "count(*) FILTER (asset_risk_score >= 5)"),
                ],
                "asset_enriched",
            ),
            long_counts(
                "exposure_score_distribution",
                [("mean", rounded("avg(exposure_score)", 4)), ("max", rounded("max(exposure_score)", 4))],
                "asset_enriched",
            ),
            "SELECT 'asset_type_distribution' AS section, asset_type AS item, count(*)::DOUBLE AS value FROM asset_enriched GROUP BY asset_type",
            "SELECT 'discovery_source' AS section, t AS item, count(*)::DOUBLE AS value FROM (SELECT unnest(discovered_by) AS t FROM asset_enriched) GROUP BY t",
        ]
    )
    quality = " UNION ALL ".join(
        f"SELECT '{c}' AS item, CASE WHEN max(hi) = max(lo) THEN 0.0 ELSE count(*) FILTER (v < lo - 1.5 * (hi - lo) OR v > hi + 1.5 * (hi - lo)) END::DOUBLE AS value "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS v, quantile_cont(CAST({c} AS DOUBLE), 0.25) OVER () AS lo, quantile_cont(CAST({c} AS DOUBLE), 0.75) OVER () AS hi FROM priced_raw)"
        for c in CORRELATED
    )
    nulls = (
        "asset_id cve_id source cvss_score epss_score severity scope exploit_count date_added published last_seen asset_exposure_score tie_a tie_b tie_c"
    ).split()
    bins = 20
    return {
        "threat_validate": chain(
            f"SELECT {row}, record_id, source_feed, kev_listed, attack_vector, severity, cvss_score, epss_score, exploit_count, affected_systems_count, first_seen FROM valid",
            "valid",
        ),
        "threat_rejects": chain(
            f"SELECT {row}, 'required field/range validation failed' AS error FROM complete WHERE asset_id IS NULL OR cvss_score NOT BETWEEN 0 AND 10 OR epss_score NOT BETWEEN 0 AND 1",
            "complete",
        ),
        "threat_declared_rules": chain(
            f"SELECT {row}, concat_ws('; ', CASE WHEN lower(trim(severity)) NOT IN {words(C.SEVERITIES)} THEN 'severity not allowed' END, "
            "CASE WHEN exploit_count < 0 THEN 'exploit_count negative' END, CASE WHEN cvss_score NOT BETWEEN 0 AND 10 THEN 'cvss_score out of range' END) AS reasons FROM threat "
            f"WHERE coalesce(lower(trim(severity)) NOT IN {words(C.SEVERITIES)}, false) OR coalesce(cvss_score NOT BETWEEN 0 AND 10, false)",
            "threat",
        ),
        "threat_coerce": chain(
            f"SELECT {row}, kev_listed, cvss_score, epss_score, exploit_count, affected_systems_count, severity, attack_vector FROM typed", "typed"
        ),
        "threat_dedup": chain(f"SELECT {row}, source_feed, last_seen FROM clean", "clean"),
        "outliers_iqr": chain(f"SELECT {row}, {outside} AS is_outlier FROM clean CROSS JOIN (SELECT {fences} FROM clean)", "clean"),
        "outliers_zscore": chain(f"SELECT {row}, {far} AS is_outlier FROM clean CROSS JOIN (SELECT {moments} FROM clean)", "clean"),
        "impute_neighbours": chain(
            f"SELECT {row}, {settled('cvss_score', 6, 'cvss_score')}, {settled('epss_score', 6, 'epss_score')} FROM imputed", "imputed"
        ),
        "impute_medians": chain(
            f"SELECT {row}, coalesce(exploit_count::DOUBLE, (SELECT quantile_cont(exploit_count::DOUBLE, 0.5) FROM threat)) AS exploit_count FROM threat", "threat"
        ),
        "impute_defaults": chain(
            f"SELECT {row}, coalesce(severity, 'low') AS severity, CAST(coalesce(exploit_count, 0) AS BIGINT) AS exploit_count FROM threat", "threat"
        ),
        "null_report": chain(
            "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM threat" for c in nulls) + ") WHERE nulls > 0",
            "threat",
        ),
        "threat_features": chain(
            f"SELECT {row}, {settled('composite_risk_score', 4, 'composite_risk_score')}, CAST(days_since_published AS BIGINT) AS days_since_published, CAST(days_since_first_seen AS BIGINT) AS days_since_first_seen, "
            f"is_exploitable, is_critical, is_network_exposed, kev_flag, {settled('epss_cvss_interaction', 4, 'epss_cvss_interaction')}, {settled('risk_exploit_product', 4, 'risk_exploit_product')} FROM engineered_raw",
            "engineered_raw",
        ),
        "threat_scaled": chain(
            f"SELECT {row}, " + ", ".join(settled(c, 5, c) for c in C.MINMAX_COLUMNS + C.STANDARD_COLUMNS) + f" FROM ({scaled('engineered_raw')})",
            "engineered_raw",
        ),
        "asset_aggregate": chain(aggregates("rolled_raw"), "rolled_raw"),
        "threat_job": chain(aggregates("rolled"), "rolled"),
        "pentest_features": chain("SELECT * FROM pentest", "pentest"),
        "pentest_job": chain(
            f"SELECT asset_id, {settled('pentest_risk_score', 4, 'pentest_risk_score')}, pentest_risk_grade FROM pentest_scored", "pentest_scored"
        ),
        "loss_job": chain(
            f"SELECT asset_id, {loss_columns}, {settled('exploit_probability', 6, 'exploit_probability')} FROM priced_raw", "priced_raw"
        ),
        "merge_tables": chain(
            "SELECT r.asset_id, r.vuln_count, p.finding_count, p.pentest_risk_grade, a.asset_type FROM rolled_raw r LEFT JOIN pentest_scored p USING (asset_id) LEFT JOIN asset_enriched a USING (asset_id)",
            "rolled_raw", "pentest_scored", "asset_enriched",
        ),
        "integrity_report": chain(
            'SELECT count(*) AS "rows", 15::BIGINT AS "columns", count(*) FILTER (asset_id IS NULL) AS missing_key, '
            "count(*) - (SELECT count(*) FROM (SELECT DISTINCT asset_id FROM threat)) AS duplicate_keys, "
            "CAST(sum(" + " + ".join(f"({c} IS NULL)::INT" for c in ["asset_id", "cve_id", "source", "cvss_score", "epss_score", "severity", "scope", "exploit_count", "date_added", "published", "last_seen", "asset_exposure_score", "tie_a", "tie_b", "tie_c"]) + ") AS BIGINT) AS null_cells FROM threat",
            "threat",
        ),
        "asset_accepted": chain(
            "SELECT asset_id, host, domain, concat_ws(',', array_to_string(ports, ',')) AS ports, array_to_string(discovered_by, ',') AS discovered_by, tag AS tags, internet_exposed, CAST(last_seen AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS last_seen FROM asset_good",
            "asset_good",
        ),
        "asset_rejected": chain("SELECT asset_id, reason FROM asset_judged WHERE reason <> ''", "asset_judged"),
        "asset_enrich": chain(
            f"SELECT asset_id, CAST(number_of_ports AS INT) AS number_of_ports, number_of_services, {', '.join(flags)}, is_public_asset, exposure_score, asset_risk_score, asset_type FROM asset_enriched",
            "asset_enriched",
        ),
        "asset_summary": chain(summary, "asset_enriched"),
        "portfolio": chain(
            f"SELECT asset_id, vuln_count, finding_count, pentest_risk_grade, asset_type, {loss_columns}, {settled('exploit_probability', 6, 'exploit_probability')} FROM portfolio",
            "portfolio",
        ),
        "top_assets": chain(
            f"SELECT asset_id, vuln_count, {settled(target, 2, target)} FROM portfolio ORDER BY expected_annual_loss_usd DESC NULLS LAST, asset_id LIMIT 20".replace(
                "ORDER BY expected_annual_loss_usd", "ORDER BY portfolio.expected_annual_loss_usd"
            ),
            "portfolio",
        ),
        "model_profile": chain(
            " UNION ALL ".join(
                f"SELECT '{item}' AS item, {settled(sql, 2, 'value')} FROM priced_raw"
                for item, sql in [
                    ("count", f"count({target})"),
                    ("mean", f"avg({target})"),
                    ("std", f"stddev_samp({target})"),
                    ("min", f"min({target})"),
                    ("max", f"max({target})"),
                    *[(f"{p * 100:g}%", f"quantile_cont({target}, {p})") for p in (0.01, 0.25, 0.5, 0.75, 0.95, 0.99)],
                ]
            ),
            "priced_raw",
        ),
        "model_quality": chain(quality, "priced_raw"),
        "correlations": chain(
            " UNION ALL ".join(
                f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {settled(f'corr({a}, {b})', 6, 'correlation')} FROM priced_raw" for a, b in pair
            ),
            "priced_raw",
        ),
        "cyber_features": chain(
            f"SELECT asset_id, {feature_rows}, exploit_availability, "
            + settled("(rank() OVER (ORDER BY weighted_risk_index) + (count(*) OVER (PARTITION BY weighted_risk_index) - 1) / 2) / count(*) OVER ()", 8, "risk_percentile")
            + " FROM modelled",
            "modelled",
        ),
        "percent_rank_rows": chain(
            "SELECT cvss_score, "
            + settled("(rank() OVER (ORDER BY cvss_score) + (count(*) OVER (PARTITION BY cvss_score) - 1) / 2) / count(*) OVER ()", 8, "share")
            + f", {row} FROM threat WHERE cvss_score IS NOT NULL UNION ALL SELECT cvss_score, NULL AS share, {row} FROM threat WHERE cvss_score IS NULL",
            "threat",
        ),
        "mutual_information": chain(information_sql(), "priced_raw"),
        "neighbour_information": chain(neighbour_sql(), "priced_raw"),
        "second_order_split": chain(root_split_sql(), "priced_raw"),
        "one_hot": chain(
            f"SELECT {row}, " + ", ".join(f"coalesce(severity = '{w}', false) AS severity_{w.strip()}" for w in ["Critical", "HIGH", "NONE", "low"])
            + ", coalesce(severity = 'medium ', false) AS severity_medium, severity IS NULL AS severity_nan FROM threat",
            "threat",
        ),
        "robust_scale": chain(
            f"SELECT {row}, " + ", ".join(settled(robust(c), 6, c) for c in ["cvss_score", "epss_score", "asset_exposure_score"]) + " FROM threat", "threat"
        ),
        "feature_profile": chain(
            "SELECT feature, " + ", ".join(settled(f, 6, f) for f in ["min", "p01", "p05", "median", "p95", "p99", "max", "iqr"])
            + f" FROM ({profile_sql(PROFILED)})",
            "priced_raw",
        ),
        "regression_metrics": chain(
            " UNION ALL ".join(f"SELECT '{k}' AS metric, {settled(v, 3, 'value')} FROM {predicted}" for k, v in metric.items()), "priced_raw"
        ),
        "prediction_intervals": chain(
            f"SELECT asset_id, {settled(f'greatest(predicted + quantile_cont({error}, 0.05) OVER (), 0)', 2, 'p05')}, {settled(f'greatest(predicted + quantile_cont({error}, 0.95) OVER (), 0)', 2, 'p95')} FROM {predicted}",
            "priced_raw",
        ),
        "loss_histogram": chain(histogram_sql("asset_exposure_score", bins), "threat"),
        "loss_histogram_log": chain(histogram_sql("ln(1 + greatest(asset_exposure_score, 0))", 50), "threat"),
        "loss_wide": chain(wide_losses_sql(), "threat"),
        "loss_custom_costs": chain(
            f"SELECT {row}, {settled('100.0::DOUBLE * 60 * hours', 2, 'loss_downtime_usd')} FROM {LOSS_INPUTS}", "threat"
        ),
        "table_round_trips": chain(f"SELECT {row}, severity, cvss_score, exploit_count, suffix FROM threat CROSS JOIN (SELECT unnest(['.parquet', '.csv', '.jsonl']) AS suffix)", "threat"),
        "nuclei_report": chain(
            "SELECT asset_id, 'nuclei' AS source_tool, asset_id AS host, event_id::VARCHAR AS matched_at, source_tool AS template_id, upper(coalesce(severity, '')) AS severity, source_tool AS finding_name, 'a,b' AS tags FROM finding",
            "finding",
        ),
        "category_codes": chain(
            f"SELECT c.asset_id, c.cve_id, c.tie_a, c.tie_b, c.name, c.value, coalesce(k.code, -1) AS code FROM "
            f"(SELECT {row}, unnest([{{'name': 'cve_id', 'value': cve_id}}, {{'name': 'severity', 'value': severity}}], recursive := true) FROM threat) c "
            "LEFT JOIN (SELECT name, value, dense_rank() OVER (PARTITION BY name ORDER BY value) - 1 AS code FROM "
            "(SELECT DISTINCT name, value FROM (SELECT unnest([{'name': 'cve_id', 'value': cve_id}, {'name': 'severity', 'value': severity}], recursive := true) FROM threat) WHERE value IS NOT NULL)) k "
            "ON k.name = c.name AND k.value = c.value",
            "threat",
        ),
        "csv_line_breaks": chain(
            f"SELECT {row}, severity, concat_ws(chr(10), 'said \"no\"', severity, '') AS note, exploit_count FROM threat", "threat"
        ),
        "httpx_report": chain(
            "SELECT CASE WHEN event_id % 3 > 0 THEN asset_id ELSE 'http://' || asset_id END AS asset_id, 'httpx' AS source_tool, 'http://' || asset_id AS url, event_id % 5 * 100 AS status_code, severity AS title, "
            "source_tool AS tech_stack, event_id % 2 = 0 AS tls, 'cdn' AS waf FROM finding",
            "finding",
        ),
        "nuclei_rejects": chain(
            "SELECT event_id, 'unreadable or mistyped record' AS reason, (SELECT count(*) FROM finding) AS records_read, "
            "(SELECT count(*) FROM finding WHERE event_id % 7 = 0) AS records_rejected FROM finding WHERE event_id % 7 = 0",
            "finding",
        ),
        "nuclei_checked": chain(
            "SELECT asset_id, 'nuclei' AS source_tool, asset_id AS host, event_id::VARCHAR AS matched_at, source_tool AS template_id, upper(coalesce(severity, '')) AS severity, source_tool AS finding_name, 'a,b' AS tags FROM finding WHERE event_id % 7 <> 0",
            "finding",
        ),
        "httpx_rejects": chain(
            "SELECT event_id, 'unreadable or mistyped record' AS reason, (SELECT count(*) FROM finding) AS records_read, "
            "(SELECT count(*) FROM finding WHERE event_id % 11 = 0) AS records_rejected FROM finding WHERE event_id % 11 = 0",
            "finding",
        ),
        "nmap_report": chain(
            "SELECT asset_id, asset_id AS ip_address, 'nmap' AS source_tool, coalesce(TRY_CAST(coalesce(port, '0') AS INT), 0) AS port, 'tcp' AS protocol, "
            "'open' AS state, source_tool AS service, NULL::VARCHAR AS product, NULL::VARCHAR AS version FROM finding WHERE event_id % 13 <> 0 AND event_id % 17 <> 0",
            "finding",
        ),
        "whatweb_report": chain(
            "SELECT asset_id, 'whatweb' AS source_tool, asset_id AS url, event_id % 5 * 100 AS status_code, "
            "CASE WHEN event_id % 4 = 0 THEN 'WordPress,' || source_tool ELSE source_tool END AS tech_stack, event_id % 4 = 0 AS cms_detected "
            "FROM finding, (SELECT greatest(1, count(*) // 500) AS nb FROM finding) b WHERE ((event_id % nb) + nb) % nb % 9 <> 4",
            "finding",
        ),
        "naabu_report": chain("SELECT asset_id, event_id::VARCHAR AS ip_address, TRY_CAST(port AS INT) AS port, 'naabu' AS source_tool FROM finding", "finding"),
        "subfinder_report": chain("SELECT subdomain AS asset_id, 'subfinder' AS source_tool, subdomain FROM finding WHERE subdomain IS NOT NULL", "finding"),
        "stacked_findings": chain(
            "SELECT 'nuclei' AS source_tool, count(*) AS findings, count(*) AS with_severity, 0::BIGINT AS with_subdomain FROM finding UNION ALL "
            "SELECT 'subfinder', count(subdomain), 0, count(subdomain) FROM finding",
            "finding",
        ),
        "merge_kinds": chain(
            " UNION ALL ".join(
                f"SELECT asset_id, r.vuln_count, p.finding_count, '{how}' AS how FROM rolled_raw r {join} JOIN pentest_scored p USING (asset_id)"
                for how, join in [("inner", "INNER"), ("right", "RIGHT"), ("outer", "FULL")]
            ),
            "rolled_raw", "pentest_scored",
        ),
        "data_split": chain(
            f"SELECT asset_id, CASE WHEN s < 0.7 THEN 'train' WHEN s < 0.85 THEN 'val' ELSE 'test' END AS part FROM (SELECT asset_id, {share('split')} AS s FROM priced_raw)",
            "priced_raw",
        ),
        "fold_sizes": chain(
            f"SELECT asset_id, CASE WHEN s < 0.2 THEN 'holdout' ELSE 'train' END AS part, CASE WHEN s < 0.2 THEN -1 ELSE floor(f * 5)::INT END AS fold "
            f"FROM (SELECT asset_id, {share('split')} AS s, {share('fold')} AS f FROM priced_raw)",
            "priced_raw",
        ),
        "plain_regressor": chain(
            f"SELECT asset_id, {settled('(a + b * x) / 1000', 3, 'prediction')} FROM {LINE} CROSS JOIN (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {LINE})", "priced_raw"
        ),
        "line_model": chain(
            f"SELECT asset_id, {settled('(exp(a + b * x) - 1) / 1000', 3, 'prediction')} FROM {LINE} CROSS JOIN (SELECT regr_slope(ln(1 + y), x) AS b, regr_intercept(ln(1 + y), x) AS a FROM {LINE})",
            "priced_raw",
        ),
        "learning_curve": chain(learning_curve_sql(), "priced_raw"),
        "partial_dependence": chain(
            f"SELECT 'x' AS feature, {settled('v', 6, 'value')}, {settled('(exp(a + b * v) - 1) / 1000', 3, 'prediction')} FROM "
            f"(SELECT a, b, low + (high - low) * i / 99 AS v FROM (SELECT regr_slope(ln(1 + y), x) AS b, regr_intercept(ln(1 + y), x) AS a, quantile_cont(x, 0.05) AS low, quantile_cont(x, 0.95) AS high FROM {LINE}) CROSS JOIN (SELECT unnest(range(100)) AS i))",
            "priced_raw",
        ),
        "prediction_scores": with_more(chain("SELECT 0", "priced_raw"), scored_sql()),
        "prediction_rejects": chain(
            "SELECT tie_a, tie_b, concat_ws('; ', CASE WHEN epss_score IS NULL THEN 'epss_score_max contains missing or NaN value(s).; epss_score_max must be finite.' END, "
            "CASE WHEN cvss_score IS NULL THEN 'cvss_score_max contains missing or NaN value(s).; cvss_score_max must be finite.' WHEN cvss_score > 1 THEN 'cvss_score_max must be less than or equal to 1.0.' END, "
            "CASE WHEN exploit_count IS NULL THEN 'vuln_count contains missing or NaN value(s).; vuln_count must be finite.; vuln_count must be an integer count.' END) AS reasons "
            "FROM threat WHERE epss_score IS NULL OR cvss_score IS NULL OR cvss_score > 1 OR exploit_count IS NULL",
            "threat",
        ),
        "export_view": chain(
            f"SELECT {rounded('cvss_score * 10', 2)} AS raw_feature__cvss_score_max_0_to_10, epss_score AS raw_feature__epss_score_max, "
            "greatest(exploit_count - 2, 0)::DOUBLE AS raw_feature__vulnerability_count, tie_a AS derived_feature__tie_a, tie_b AS derived_feature__tie_b FROM threat WHERE exploit_count IS NOT NULL "
            f"UNION ALL SELECT {rounded('cvss_score * 10', 2)}, epss_score, NULL, tie_a, tie_b FROM threat WHERE exploit_count IS NULL",
            "threat",
        ),
        } | {"tree_attributions": tree_attributions_sql(), "linear_cv_one": linear_cv_sql(False), "linear_cv_two": linear_cv_sql(True)}


def tree_attributions_sql() -> str:
    """Exact Shapley values of two fixed trees by walking every subset of the three features.

    Fixed values: the node tables (tree, node, feature, threshold, left, right, leaf value,
    cover) and the tree weights of the query; features 0, 1, 2 are l_quantity,
    l_extendedprice, l_discount. A walk holds the share of a row under each subset: known
    features follow the row, unknown ones split by cover.
    """
    return f"""
WITH RECURSIVE nodes(tree, node, feature, threshold, lft, rgt, value, cover) AS (VALUES
  (0, 0, 0, 25.0, 1, 2, 0.0, 100.0), (0, 1, 2, 0.05, 3, 4, 0.0, 50.0), (0, 2, 1, 40000.0, 5, 6, 0.0, 50.0),
  (0, 3, -1, 0.0, -1, -1, 10.0, 30.0), (0, 4, -1, 0.0, -1, -1, 20.0, 20.0), (0, 5, -1, 0.0, -1, -1, 30.0, 10.0),
  (0, 6, 0, 40.0, 7, 8, 0.0, 40.0), (0, 7, -1, 0.0, -1, -1, 50.0, 25.0), (0, 8, -1, 0.0, -1, -1, 70.0, 15.0),
  (1, 0, 2, 0.03, 1, 2, 0.0, 80.0), (1, 1, -1, 0.0, -1, -1, -4.0, 20.0), (1, 2, 1, 20000.0, 3, 4, 0.0, 60.0),
  (1, 3, -1, 0.0, -1, -1, 6.0, 45.0), (1, 4, -1, 0.0, -1, -1, 12.0, 15.0)
), weights(tree, w) AS (VALUES (0, 1.0), (1, 0.5)),
r AS (
  SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber,
    [CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE), CAST(l_discount AS DOUBLE)] AS x
  FROM lineitem
),
walk(rid, x, s, tree, node, share) AS (
  SELECT r.rid, r.x, sub.range, w.tree, 0, 1.0::DOUBLE FROM r, range(8) sub, weights w
  UNION ALL
  SELECT k.rid, k.x, k.s, k.tree, c.node,
    k.share * CASE WHEN (k.s >> n.feature) & 1 = 1
                   THEN CASE WHEN (k.x[n.feature + 1] <= n.threshold) = (c.node = n.lft) THEN 1.0 ELSE 0.0 END
                   ELSE c.cover / n.cover END
  FROM walk k
  JOIN nodes n ON n.tree = k.tree AND n.node = k.node AND n.feature >= 0
  JOIN nodes c ON c.tree = n.tree AND (c.node = n.lft OR c.node = n.rgt)
  WHERE k.share > 0
),
v AS (
  SELECT k.rid, k.s, sum(k.share * n.value * w.w) AS v
  FROM walk k JOIN nodes n ON n.tree = k.tree AND n.node = k.node AND n.feature < 0 JOIN weights w ON w.tree = k.tree
  GROUP BY k.rid, k.s
),
phi AS (
  SELECT a.rid, i.range AS i,
    sum(CASE bit_count(a.s::TINYINT) WHEN 1 THEN 1.0 / 6 ELSE 1.0 / 3 END * (b.v - a.v)) AS phi
  FROM v a JOIN range(3) i ON (a.s >> i.range) & 1 = 0
  JOIN v b ON b.rid = a.rid AND b.s = a.s | (1 << i.range)
  GROUP BY a.rid, i.range
)
SELECT r.l_orderkey, r.l_linenumber,
  {settled("(SELECT v FROM v WHERE v.rid = r.rid AND v.s = 0)", 6, "base_value")},
  {settled("(SELECT v FROM v WHERE v.rid = r.rid AND v.s = 7)", 6, "prediction")},
  {settled("(SELECT phi FROM phi WHERE phi.rid = r.rid AND phi.i = 0)", 6, "phi_quantity")},
  {settled("(SELECT phi FROM phi WHERE phi.rid = r.rid AND phi.i = 1)", 6, "phi_extendedprice")},
  {settled("(SELECT phi FROM phi WHERE phi.rid = r.rid AND phi.i = 2)", 6, "phi_discount")}
FROM r
"""


def linear_cv_sql(two: bool) -> str:
    """Folds as in hash_fold (md5 of 'fold:<seed>:<key>'), each fitted on the rows of the other folds."""
    x2 = ", l_discount AS x2" if two else ""
    fit = (
        "(var_pop(t.x2) * covar_pop(t.x, t.y) - covar_pop(t.x, t.x2) * covar_pop(t.x2, t.y)) / (var_pop(t.x) * var_pop(t.x2) - covar_pop(t.x, t.x2) ^ 2) AS b1, "
        "(var_pop(t.x) * covar_pop(t.x2, t.y) - covar_pop(t.x, t.x2) * covar_pop(t.x, t.y)) / (var_pop(t.x) * var_pop(t.x2) - covar_pop(t.x, t.x2) ^ 2) AS b2, "
        "avg(t.x) AS mx, avg(t.x2) AS mx2, avg(t.y) AS my"
        if two
        else "regr_slope(t.y, t.x) AS b1, 0.0 AS b2, avg(t.x) AS mx, 0.0 AS mx2, avg(t.y) AS my"
    )
    second = "f.x2" if two else "0.0"
    err = f"(f.y - (m.my - m.b1 * m.mx - m.b2 * m.mx2) - m.b1 * f.x - m.b2 * {second})"
    return f"""
WITH r AS (
  SELECT l_orderkey AS k, l_quantity AS x{x2}, l_extendedprice / 1000 AS y FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL{" AND l_discount IS NOT NULL" if two else ""}
), f AS (
  SELECT r.*, t.rep,
    CAST(floor(CAST(('0x' || substr(md5(concat_ws(':', 'fold', CAST(42 + t.rep AS VARCHAR), CAST(k AS VARCHAR))), 1, 8)) AS UBIGINT) / 4294967296.0 * 5) AS INTEGER) AS fold
  FROM r, (SELECT range AS rep FROM range(2)) t
), m AS (
  SELECT v.rep, v.fold, count(*) AS n_train, {fit}
  FROM (SELECT DISTINCT rep, fold FROM f) v JOIN f t ON t.rep = v.rep AND t.fold <> v.fold
  GROUP BY v.rep, v.fold
)
SELECT CAST(m.rep AS INTEGER) AS repeat, m.fold, m.n_train, count(*) AS n_valid,
  {settled(f"sqrt(avg({err} ^ 2))", 4, "rmse")},
  {settled(f"1 - sum({err} ^ 2) / (sum(f.y * f.y) - sum(f.y) ^ 2 / count(*))", 4, "r2")}
FROM m JOIN f ON f.rep = m.rep AND f.fold = m.fold
GROUP BY m.rep, m.fold, m.n_train, m.b1, m.b2, m.mx, m.mx2, m.my
"""
