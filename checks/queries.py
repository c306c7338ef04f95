"""Every operator and job as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as O
from checks import proxies as P
from riskspark import constants as C
from riskspark.functions.ordering import average_percent_rank
from riskspark.operators import assets, attribution, boost, features, gramcv, impute, loss, merge, neighbours, pentest, profile, scale, score, select, threat, train
from riskspark.plans import jobs
from riskspark.session import materialize, shared_folder
from riskspark.sources import scans, tables

TIES = ["tie_a", "tie_b", "tie_c"]
ROW = O.ROW
TARGET = C.SOURCE_TARGET


def settle(value: str | Column, digits: int = 4, name: str | None = None) -> Column:
    """Round for comparison; see oracles.py."""
    column = F.col(value) if isinstance(value, str) else value
    by = float(10**digits)
    out = F.rint((column.cast("double") + F.lit(0.00137 / by)) * by) / by
    return out.alias(name or value)


# --- shared stages ---------------------------------------------------------------


def valid(spark: SparkSession, d: str) -> DataFrame:
    return threat.validate_threats(P.threats(spark, d), P.AS_OF)[0]


def clean(spark: SparkSession, d: str) -> DataFrame:
    return jobs.clean_threats(P.threats(spark, d), P.AS_OF, TIES)


def engineered(spark: SparkSession, d: str) -> DataFrame:
    return threat.engineer_threats(clean(spark, d), P.AS_OF)


def rolled(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(jobs.clean_threats(P.threats(spark, d), P.AS_OF, TIES, jobs.ROLLED_UP), "clean")
    return threat.aggregate_assets(threat.engineer_threats(rows, P.AS_OF), severities=C.SEVERITIES)


def priced(spark: SparkSession, d: str) -> DataFrame:
    return loss.estimate_losses(rolled(spark, d))


def judged_assets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return assets.validate_assets(assets.normalise_types(P.assets(spark, d)))


def portfolio(spark: SparkSession, d: str) -> DataFrame:
    return jobs.portfolio_job(P.threats(spark, d), P.findings(spark, d), P.assets(spark, d), P.AS_OF, TIES)


def shown_aggregates(df: DataFrame) -> DataFrame:
    return df.select(
        "asset_id",
        *[F.col(c).cast("bigint").alias(c) for c in O.ASSET_COUNTS],
        *[settle(c) for c in O.AGGREGATE_OUTPUTS],
    )


def model_matrix(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """Written model table (id, features, target) and a short feature list."""
    names = ["epss_score_mean", "vuln_count", "kev_flag_sum", "weighted_risk_index", "attack_surface_score"]
    built = features.build_cyber_features(priced(spark, d), rank=False)
    kept = built.select("asset_id", *[F.col(c).cast("double").alias(c) for c in names], F.col(TARGET).alias(C.TARGET))
    return materialize(kept, "model"), names


# --- threat ----------------------------------------------------------------------


def threat_validate(spark, d):
    return valid(spark, d).select(
        *ROW, "record_id", "source_feed", "kev_listed", "attack_vector", "severity", "cvss_score", "epss_score",
        "exploit_count", "affected_systems_count", "first_seen",
    )


def threat_rejects(spark, d):
    return threat.validate_threats(P.threats(spark, d), P.AS_OF)[1].select(*ROW, "error")


def threat_declared_rules(spark, d):
    broken = threat.declared_rule_violations(P.threats(spark, d))
    return broken.select(*ROW, F.concat_ws("; ", "reasons").alias("reasons"))


def threat_coerce(spark, d):
    return threat.coerce_types(valid(spark, d)).select(
        *ROW, "kev_listed", "cvss_score", "epss_score", "exploit_count", "affected_systems_count", "severity",
        "attack_vector",
    )


def threat_dedup(spark, d):
    return clean(spark, d).select(*ROW, "source_feed", "last_seen")


def outliers_iqr(spark, d):
    rows = materialize(clean(spark, d).select(*ROW, *C.OUTLIER_COLUMNS), "clean")
    return threat.fit_outliers(rows).transform(rows).select(*ROW, "is_outlier")


def outliers_zscore(spark, d):
    rows = materialize(clean(spark, d).select(*ROW, *C.OUTLIER_COLUMNS), "clean")
    model = threat.fit_outliers(rows, "zscore", zscore_threshold=1.7)
    return model.transform(rows).select(*ROW, "is_outlier")


def impute_neighbours(spark, d):
    rows = materialize(clean(spark, d).select(*ROW, *C.NEIGHBOUR_COLUMNS), "clean")
    filled = impute.fit_neighbours(rows).transform(rows)
    return filled.select(*ROW, settle("cvss_score", 6), settle("epss_score", 6))


def impute_medians(spark, d):
    rows = P.threats(spark, d)
    return impute.fit_medians(rows).transform(rows).select(*ROW, F.col("exploit_count").cast("double").alias("exploit_count"))


def impute_defaults(spark, d):
    return impute.domain_defaults(P.threats(spark, d)).select(
        *ROW, "severity", F.col("exploit_count").cast("bigint").alias("exploit_count")
    )


def null_report(spark, d):
    return impute.null_report(P.threats(spark, d))


def threat_features(spark, d):
    return engineered(spark, d).select(
        *ROW, settle("composite_risk_score"), "days_since_published", "days_since_first_seen", "is_exploitable",
        "is_critical", "is_network_exposed", "kev_flag", settle("epss_cvss_interaction"), settle("risk_exploit_product"),
    )


def threat_scaled(spark, d):
    columns = C.MINMAX_COLUMNS + C.STANDARD_COLUMNS
    rows = materialize(engineered(spark, d).select(*ROW, *columns), "engineered")
    return scale.fit_scaler(rows).transform(rows).select(*ROW, *[settle(c, 5) for c in columns])


def asset_aggregate(spark, d):
    return shown_aggregates(rolled(spark, d))


def threat_job(spark, d):
    return shown_aggregates(jobs.threat_job(P.threats(spark, d), P.AS_OF, severities=C.SEVERITIES, tie_break=TIES))


# --- findings, losses, merge -----------------------------------------------------


def pentest_features(spark, d):
    return pentest.build_pentest_features(P.findings(spark, d))


def pentest_job(spark, d):
    return jobs.pentest_job(P.findings(spark, d)).select("asset_id", settle("pentest_risk_score"), "pentest_risk_grade")


def shown_losses(df: DataFrame, *more: str) -> DataFrame:
    return df.select("asset_id", *more, *[settle(c, 2) for c in O.LOSSES], settle("exploit_probability", 6))


def loss_job(spark, d):
    return shown_losses(priced(spark, d))


def merge_tables(spark, d):
    parts = [rolled(spark, d), jobs.pentest_job(P.findings(spark, d)), jobs.asset_job(P.assets(spark, d))[0]]
    merged = merge.merge_on_asset_id([materialize(p, "part", key="asset_id") for p in parts])
    return merged.select("asset_id", "vuln_count", "finding_count", "pentest_risk_grade", "asset_type")


def integrity_report(spark, d):
    return merge.integrity_report(P.threats(spark, d))


def portfolio_query(spark, d):
    return shown_losses(portfolio(spark, d), "vuln_count", "finding_count", "pentest_risk_grade", "asset_type")


def top_assets(spark, d):
    best = portfolio(spark, d).orderBy(F.desc_nulls_last(TARGET), "asset_id").limit(20)
    return best.select("asset_id", "vuln_count", settle(TARGET, 2))


# --- assets ----------------------------------------------------------------------


def asset_accepted(spark, d):
    good, _ = judged_assets(spark, d)
    return good.select(
        "asset_id", "host", "domain",
        *[F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in ("ports", "discovered_by", "tags")],
        "internet_exposed", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"),
    )


def asset_rejected(spark, d):
    return judged_assets(spark, d)[1]


def asset_enrich(spark, d):
    return jobs.asset_job(P.assets(spark, d))[0].select(
        "asset_id", "number_of_ports", "number_of_services", "has_web_service", "has_database_service", "has_tls",
        "has_remote_access_service", "is_public_asset", "exposure_score", "asset_risk_score", "asset_type",
    )


def asset_summary(spark, d):
    return assets.inventory_summary(*jobs.asset_job(P.assets(spark, d)))


# --- model table -----------------------------------------------------------------


def model_profile(spark, d):
    found = profile.profile_table(materialize(priced(spark, d), "priced"), TARGET)
    return found.where("section = 'target_distribution'").select("item", settle("value", 2))


def model_quality(spark, d):
    rows = materialize(priced(spark, d).select("asset_id", TARGET, *O.CORRELATED), "priced")
    return profile.quality_report(rows, TARGET).where("section = 'outliers_iqr'").select("item", "value")


def correlations(spark, d):
    rows = materialize(priced(spark, d).select(*O.CORRELATED), "priced")
    place = {c: i for i, c in enumerate(O.CORRELATED)}
    order = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    pairs = profile.correlations(rows, O.CORRELATED).where(order[F.col("feature_a")] < order[F.col("feature_b")])
    return pairs.select("feature_a", "feature_b", settle("correlation", 6))


def cyber_features(spark, d):
    built = features.build_cyber_features(priced(spark, d))
    return built.select(
        "asset_id", *[settle(c) for c in O.CYBER], "exploit_availability", settle("risk_percentile", 8)
    )


def percent_rank_rows(spark, d):
    ranked = average_percent_rank(P.threats(spark, d), "cvss_score", "share")
    return ranked.select(*ROW, "cvss_score", settle("share", 8))


def mutual_information(spark, d):
    rows = materialize(priced(spark, d).select(*O.INFORMED, TARGET), "priced")
    found = select.mutual_information(rows, O.INFORMED, TARGET, bins=8)
    return found.select("feature", settle("mutual_information", 6))


def second_order_split(spark, d):
    rows = materialize(priced(spark, d).select(*O.INFORMED, TARGET), "priced")
    found = boost.root_split(rows, O.INFORMED, TARGET, bins=8, lam=1.0, min_hessian=1.0)
    return found.select("node", "feature", "bin", "left_rows", "right_rows", settle("gain_share", 6))


def neighbour_information(spark, d):
    rows = materialize(priced(spark, d).select(*O.INFORMED, TARGET), "priced")
    found = neighbours.neighbour_information(rows, O.INFORMED, TARGET, k=3)
    return found.select("feature", settle("mutual_information", 6), "rows")


def one_hot(spark, d):
    coded = features.one_hot_encode(P.threats(spark, d).select(*ROW, "severity"), exclude=["asset_id", "cve_id"])
    return coded.withColumnRenamed("severity_medium ", "severity_medium")


def category_codes(spark, d):
    """Dense codes of every cve_id and severity of the threat rows, in long form."""
    rows = P.threats(spark, d).select(*ROW, "severity")
    return features.coded_cells(rows, ROW, ["cve_id", "severity"])


def robust_scale(spark, d):
    columns = ["cvss_score", "epss_score", "asset_exposure_score"]
    rows = P.threats(spark, d).select(*ROW, *columns)
    return scale.robust_scale(rows, exclude=["tie_a", "tie_b"])[0].select(*ROW, *[settle(c, 6) for c in columns])


def feature_profile(spark, d):
    rows = materialize(priced(spark, d).select(*O.PROFILED), "priced")
    table = profile.profile_rows(rows, O.PROFILED)
    return table.select("feature", *[settle(c, 6) for c in profile.PROFILE_FIELDS])


def with_guess(spark: SparkSession, d: str) -> DataFrame:
    guess = F.col("vuln_count") * 190000.0
    return materialize(priced(spark, d).select("asset_id", TARGET, guess.alias("predicted")), "guess")


def regression_metrics(spark, d):
    found = train.regression_metrics(with_guess(spark, d), TARGET, "predicted")
    shown = F.when(F.col("metric") == "mse", F.col("value") / 1e9).otherwise(F.col("value"))
    return train.metrics_table(spark, found).select("metric", settle(shown, 3, "value"))


def prediction_intervals(spark, d):
    rows = with_guess(spark, d).withColumn("residual", F.col(TARGET) - F.col("predicted"))
    bounds = train.prediction_intervals(rows, "predicted")
    return bounds.select("asset_id", settle("p05", 2), settle("p95", 2))


def loss_histogram(spark, d):
    bins = train.histogram(P.threats(spark, d), "asset_exposure_score", 20, log_scale=False)
    return bins.select("bin", settle("low", 6), settle("high", 6), "count")


def loss_histogram_log(spark, d):
    return train.histogram(P.threats(spark, d), "asset_exposure_score").select("bin", settle("low", 6), settle("high", 6), "count")


def loss_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Assets with every input that the loss parts can read, nulls and zeros among them."""
    rows = P.threats(spark, d).where("asset_id IS NOT NULL")
    word = F.element_at(F.array(*[F.lit(w) for w in ("critical", "High", "medium", "low", "other")]), (F.col("tie_a") % 5 + 1).cast("int"))
    return rows.select(
        *ROW,
        F.when(F.col("tie_a") % 11 > 0, word).alias("business_criticality"),
        F.when(F.col("tie_b") != 3, F.col("tie_a") % 9000).alias("estimated_records_at_risk"),
        F.when(F.col("tie_b") != 4, (F.col("tie_a") % 30).cast("double")).alias("estimated_downtime_hours"),
        (F.col("tie_a") % 700).alias("estimated_customer_count"),
        F.when(F.col("tie_b") != 2, (F.col("tie_a") % 2).cast("double")).alias("known_ransomware_max"),
        (F.col("tie_a") % 2).cast("double").alias("kev_flag_max"),
        F.when(F.col("tie_b") != 6, F.col("tie_a") % 3 / 10.0).alias("epss_score_max"),
        (F.col("tie_a") % 4 * 2.0).alias("cvss_score_max"),
        (F.col("tie_a") % 7 / 10.0).alias("threat_pressure_factor_max"),
    )


def loss_wide(spark, d):
    return loss.estimate_losses(loss_inputs(spark, d)).select(*ROW, *[settle(c, 2) for c in O.LOSSES], settle("exploit_probability", 6))


def loss_custom_costs(spark, d):
    costs = {"downtime": {"medium_systems_cost_per_min_usd": 100}}
    rows = loss_inputs(spark, d)
    return rows.select(*ROW, settle(loss.downtime_loss(rows, costs), 2, "loss_downtime_usd"))


def prediction_scores(spark, d):
    rows = materialize(priced(spark, d).select("asset_id", *O.SCORED, (F.col(TARGET) / 1000).alias("predicted_loss")), "priced")
    profiles = profile.feature_profile(rows, O.SCORED)
    scored = score.add_scores(rows, O.SCORED, O.WEIGHTS, O.MODEL_METRICS, profiles, P.AS_OF)
    return scored.select(
        F.col("derived_feature__asset_id").alias("asset_id"), settle("predicted_loss", 2), "currency", "risk_level",
        settle("confidence_score", 2), settle("prediction_interval_lower", 2), settle("prediction_interval_upper", 2),
        "top_feature_1", "top_feature_2", "top_feature_3",
    )


def model_inputs(spark: SparkSession, d: str) -> DataFrame:
    return P.threats(spark, d).select(
        F.col("epss_score").alias("epss_score_max"), F.col("cvss_score").alias("cvss_score_max"),
        F.col("exploit_count").alias("vuln_count"), "tie_a", "tie_b",
    )


def prediction_rejects(spark, d):
    _, bad = score.split_input(model_inputs(spark, d), ["epss_score_max", "cvss_score_max", "vuln_count"])
    return bad.select("tie_a", "tie_b", F.concat_ws("; ", "reasons").alias("reasons"))


def export_view(spark, d):
    rows = model_inputs(spark, d).withColumn("vuln_count", F.col("vuln_count") - 2)
    return rows.select(*score.export_columns(rows))


# --- sources: tables and reports written first, then read back --------------------


def scratch_path(spark: SparkSession, suffix: str) -> str:
    return f"{shared_folder(spark)}/source-{uuid.uuid4().hex}{suffix}"


def table_round_trips(spark, d):
    """The threat rows written and read back in every format."""
    rows = P.threats(spark, d).select(*ROW, "severity", "cvss_score", "exploit_count")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    parts = [
        tables.read_table(spark, tables.write_table(rows, scratch_path(spark, suffix)), kinds).withColumn("suffix", F.lit(suffix))
        for suffix in (".parquet", ".csv", ".jsonl")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def csv_line_breaks(spark, d):
    """Threat rows with line breaks and quotes in a text cell, written as CSV by as many tasks as read them and read back by split records."""
    rows = P.threats(spark, d).select(*ROW, "severity", F.concat_ws("\n", F.lit('said "no"'), "severity", F.lit("")).alias("note"), "exploit_count")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    path = scratch_path(spark, ".csv")
    tables.write_table(rows, path)
    return tables.read_table(spark, path, kinds)


def nuclei_report(spark, d):
    info = F.struct("severity", F.col("source_tool").alias("name"), F.array(F.lit("a"), F.lit("b")).alias("tags"))
    fields = [F.col("asset_id").alias("host"), F.col("event_id").cast("string").alias("matched-at"), F.col("source_tool").alias("template-id"), info.alias("info")]
    path = scratch_path(spark, "")
    P.findings(spark, d).select(F.to_json(F.struct(*fields)).alias("value")).write.text(path)
    return scans.parse_nuclei_jsonl(spark, path)


def httpx_report(spark, d):
    fields = [
        F.when(F.col("event_id") % 3 > 0, F.col("asset_id")).otherwise("").alias("host"),
        F.concat(F.lit("http://"), "asset_id").alias("url"),
        (F.col("event_id") % 5 * 100).alias("status_code"),
        F.col("severity").alias("title"),
        F.array("source_tool").alias("tech"),
        F.when(F.col("event_id") % 2 == 0, F.struct(F.lit("1.3").alias("version"))).alias("tls"),
        F.lit("").alias("webserver"),
        F.lit("cdn").alias("cdn_name"),
    ]
    path = scratch_path(spark, "")
    P.findings(spark, d).select(F.to_json(F.struct(*fields)).alias("value")).write.text(path)
    return scans.parse_httpx_jsonl(spark, path)


BROKEN_NUCLEI, BROKEN_HTTPX, BROKEN_NMAP, UNCLOSED_NMAP = 7, 11, 13, 17


def planted_nuclei(spark: SparkSession, d: str) -> str:
    """The nuclei lines of nuclei_report, with every seventh event's line cut short."""
    info = F.struct("severity", F.col("source_tool").alias("name"), F.array(F.lit("a"), F.lit("b")).alias("tags"))
    fields = [F.col("asset_id").alias("host"), F.col("event_id").cast("string").alias("matched-at"), F.col("source_tool").alias("template-id"), info.alias("info")]
    cut = F.concat(F.lit('{"host":"'), "asset_id", F.lit('","matched-at":"'), F.col("event_id").cast("string"), F.lit('","info":{'))
    path = scratch_path(spark, "")
    P.findings(spark, d).select(F.when(F.col("event_id") % BROKEN_NUCLEI == 0, cut).otherwise(F.to_json(F.struct(*fields))).alias("value")).write.text(path)
    return path


def rejects_of(checked: scans.Checked, pattern: str) -> DataFrame:
    return checked.rejected.select(
        F.regexp_extract("record", pattern, 1).cast("long").alias("event_id"), "reason",
        F.lit(checked.counts["read"]).cast("long").alias("records_read"), F.lit(checked.counts["rejected"]).cast("long").alias("records_rejected"),
    )


def nuclei_rejects(spark, d):
    return rejects_of(scans.read_nuclei_jsonl(spark, planted_nuclei(spark, d)), '"matched-at":"([0-9]+)"')


def nuclei_checked(spark, d):
    return scans.read_nuclei_jsonl(spark, planted_nuclei(spark, d)).rows


def httpx_rejects(spark, d):
    fields = [
        F.when(F.col("event_id") % 3 > 0, F.col("asset_id")).otherwise("").alias("host"),
        F.concat(F.lit("http://"), "asset_id").alias("url"),
        (F.col("event_id") % 5 * 100).alias("status_code"),
        F.col("severity").alias("title"),
    ]
    mistyped = F.concat(F.lit('{"host":"'), "asset_id", F.lit('","status_code":"n/a","title":"'), F.col("event_id").cast("string"), F.lit('"}'))
    path = scratch_path(spark, "")
    P.findings(spark, d).select(F.when(F.col("event_id") % BROKEN_HTTPX == 0, mistyped).otherwise(F.to_json(F.struct(*fields))).alias("value")).write.text(path)
    return rejects_of(scans.read_httpx_jsonl(spark, path), '"title":"([0-9]+)"')


def nmap_report(spark, d):
    """Hosts written as Nmap XML, with mismatched tags in some and the end tag missing in others."""
    port = F.coalesce(F.col("port"), F.lit("0"))
    good = F.concat(
        F.lit('<host><address addr="'), "asset_id", F.lit('" addrtype="ipv4"/><ports><port protocol="tcp" portid="'), port,
        F.lit('"><state state="open"/><service name="'), "source_tool", F.lit('"/></port></ports></host>'),
    )
    mismatched = F.concat(F.lit('<host><address addr="'), "asset_id", F.lit('"/><ports><port portid="1"></ports></host>'))
    unclosed = F.concat(F.lit('<host><address addr="'), "asset_id", F.lit('"/><ports><port portid="2"/></ports>'))
    text = F.when(F.col("event_id") % BROKEN_NMAP == 0, mismatched).when(F.col("event_id") % UNCLOSED_NMAP == 0, unclosed).otherwise(good)
    path = scratch_path(spark, ".xml")
    P.findings(spark, d).select(text.alias("value")).write.text(path)
    return scans.read_nmap_xml(spark, path).rows


WHATWEB_FILE_ROWS, BROKEN_WHATWEB = 500, 9


def whatweb_report(spark, d):
    """Targets written as WhatWeb JSON arrays, one file per bucket of about 500; the arrays of some buckets are cut short."""
    found = P.findings(spark, d)
    buckets = max(1, found.count() // WHATWEB_FILE_ROWS)
    plugins = F.when(F.col("event_id") % 4 == 0, F.create_map(F.lit("WordPress"), F.lit("4"), "source_tool", F.lit("x"))).otherwise(F.create_map("source_tool", F.lit("x")))
    item = F.to_json(F.struct(F.col("asset_id").alias("target"), (F.col("event_id") % 5 * 100).alias("http_status"), plugins.alias("plugins")))
    bucket = F.pmod("event_id", F.lit(buckets))
    files = found.groupBy(bucket.alias("bucket")).agg(F.concat_ws(",", F.collect_list(item)).alias("items"))
    text = F.concat(F.lit("["), "items", F.when(F.col("bucket") % BROKEN_WHATWEB == 4, F.lit("")).otherwise(F.lit("]")))
    path = scratch_path(spark, "")
    # The groups leave one file per bucket already: each bucket is whole in one task.
    files.select(text.alias("value"), "bucket").write.partitionBy("bucket").text(path)
    return scans.read_whatweb_json(spark, path).rows


def naabu_report(spark, d):
    path = scratch_path(spark, ".csv")
    P.findings(spark, d).select(F.col("asset_id").alias("host"), F.col("event_id").alias("ip"), "port").write.csv(path, header=True)
    return scans.parse_naabu_csv(spark, path)


def subfinder_report(spark, d):
    path = scratch_path(spark, ".txt")
    P.findings(spark, d).where("subdomain IS NOT NULL").select(F.concat(F.lit("\t"), "subdomain", F.lit(" ")).alias("value")).write.text(path)
    return scans.parse_subfinder_txt(spark, path)


def stacked_findings(spark, d):
    found = pentest.stack_findings([nuclei_report(spark, d), subfinder_report(spark, d)])
    return found.groupBy("source_tool").agg(F.count(F.lit(1)).alias("findings"), F.count("severity").alias("with_severity"), F.count("subdomain").alias("with_subdomain"))


def merge_kinds(spark, d):
    """Rows of the other join kinds."""
    left, right = materialize(rolled(spark, d), "part"), materialize(jobs.pentest_job(P.findings(spark, d)), "part")
    out = None
    for how in ("inner", "right", "outer"):
        part = merge.merge_on_asset_id([left, right], how=how).select("asset_id", "vuln_count", "finding_count", F.lit(how).alias("how"))
        out = part if out is None else out.unionByName(part)
    return out


# --- splits and one-feature models: SQL has the same regression -------------------


def data_split(spark, d):
    parts = features.train_val_test_split(priced(spark, d))
    named = [p.select("asset_id", F.lit(n).alias("part")) for n, p in zip(("train", "val", "test"), parts, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


def fold_sizes(spark, d):
    """Where every asset goes: held out, or in which fold of the training part."""
    seen, unseen = train.holdout_split(priced(spark, d))
    placed = seen.select("asset_id", F.lit("train").alias("part"), features.hash_fold(5, 42).alias("fold"))
    return placed.unionByName(unseen.select("asset_id", F.lit("holdout").alias("part"), F.lit(-1).alias("fold")))


def one_feature(spark: SparkSession, d: str) -> DataFrame:
    """Written table of one input and the target; a straight line through it is regr_slope in SQL."""
    rows = priced(spark, d).select("asset_id", F.col("epss_score_mean").cast("double").alias("x"), F.col(TARGET).cast("double").alias(C.TARGET))
    return materialize(rows.where("x IS NOT NULL"), "line")


def plain_regressor(spark, d):
    rows = one_feature(spark, d)
    model = train.train_regressor(rows, C.TARGET, LinearRegression())
    return model.predict(rows).select("asset_id", settle(F.col("prediction") / 1000, 3, "prediction"))


def line_model(spark, d):
    rows = one_feature(spark, d)
    model = train.fit_model(rows, ["x"], C.TARGET, LinearRegression())
    return model.predict(rows).select("asset_id", settle(F.col("prediction") / 1000, 3, "prediction"))


def learning_curve(spark, d):
    found = train.learning_curve(one_feature(spark, d), ["x"], C.TARGET, LinearRegression())
    return found.select(settle("share", 2), settle("train_rows", 3), *[settle(F.col(c) / 1000, 3, c) for c in ("train_rmse", "validation_rmse")])


def partial_dependence(spark, d):
    rows = one_feature(spark, d)
    model = train.fit_model(rows, ["x"], C.TARGET, LinearRegression())
    return train.partial_dependence(model, rows).select("feature", settle("value", 6), settle(F.col("prediction") / 1000, 3, "prediction"))


# --- tree models: no SQL counterpart, tested on fixtures --------------------------


def forest_importance(spark, d):
    rows, names = model_matrix(spark, d)
    return train.importance_report(spark, select.forest_importance(rows, names, C.TARGET))


def feature_selection(spark, d):
    rows = features.build_cyber_features(priced(spark, d), rank=False).withColumnRenamed(TARGET, C.TARGET)
    _, report = select.select_features(materialize(rows.drop("asset_id"), "select"))
    schema = (
        "feature string, mutual_information double, random_forest_importance double, shap_importance double, "
        "rfe_selected int, selection_score double"
    )
    return spark.createDataFrame([tuple(r.values()) for r in report["feature_scores"]], schema)


def leaderboard(spark, d):
    rows, names = model_matrix(spark, d)
    return train.train_and_select(rows, names).leaderboard


def boosted(spark: SparkSession, d: str):
    rows, names = model_matrix(spark, d)
    return rows, train.fit_model(rows, names, C.TARGET, train.model_registry()["Gradient Boosting"])


def predict_table(spark, d):
    rows, model = boosted(spark, d)
    metrics = train.regression_metrics(model.predict(rows), C.TARGET, "prediction")
    profiles = profile.feature_profile(rows, model.features)
    return score.predict_table(model, rows, metrics, profiles, P.AS_OF)


def staged_spread(spark, d):
    rows, model = boosted(spark, d)
    return score.staged_spread(model, rows).select("asset_id", "staged_spread")


def permutation_importance(spark, d):
    rows, model = boosted(spark, d)
    return train.permutation_importance(model, rows)


# Two trees over l_quantity (0), l_extendedprice (1), l_discount (2), as rows
# (feature, threshold, left, right, leaf value, cover) per node, and their weights.
FIXED_TREES = (
    [(0, 25.0, 1, 2, 0.0, 100.0), (2, 0.05, 3, 4, 0.0, 50.0), (1, 40000.0, 5, 6, 0.0, 50.0), (-1, 0.0, -1, -1, 10.0, 30.0),
     (-1, 0.0, -1, -1, 20.0, 20.0), (-1, 0.0, -1, -1, 30.0, 10.0), (0, 40.0, 7, 8, 0.0, 40.0), (-1, 0.0, -1, -1, 50.0, 25.0),
     (-1, 0.0, -1, -1, 70.0, 15.0)],
    [(2, 0.03, 1, 2, 0.0, 80.0), (-1, 0.0, -1, -1, -4.0, 20.0), (1, 20000.0, 3, 4, 0.0, 60.0), (-1, 0.0, -1, -1, 6.0, 45.0),
     (-1, 0.0, -1, -1, 12.0, 15.0)],
)
FIXED_WEIGHTS = [1.0, 0.5]
FIXED_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def fixed_trees() -> list[attribution.Tree]:
    import numpy as np

    return [attribution.Tree(*(np.array(col, float if k >= 4 or k == 1 else int) for k, col in enumerate(zip(*nodes)))) for nodes in FIXED_TREES]


def tree_attributions(spark, d):
    """Attributions of every lineitem row under two fixed trees; prediction = base + their sum."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in FIXED_FEATURES])
    trees = fixed_trees()
    base = attribution.base_value(trees, FIXED_WEIGHTS)
    out = attribution.with_attributions(rows, FIXED_FEATURES, trees, FIXED_WEIGHTS, "phi")
    total = F.aggregate("phi", F.lit(0.0), lambda acc, v: acc + v)
    return out.select(
        "l_orderkey", "l_linenumber", settle(F.lit(base), 6, "base_value"), settle(F.lit(base) + total, 6, "prediction"),
        *[settle(F.col("phi")[i], 6, f"phi_{c[2:]}") for i, c in enumerate(FIXED_FEATURES)],
    )


def shap_importance(spark, d):
    """Mean absolute attribution per feature of the boosted model over all rows, and the worst additivity gap."""
    rows, model = boosted(spark, d)
    trees, weights = attribution.mllib_trees(model.regressor)
    base = attribution.base_value(trees, weights)
    scored = model.regressor.transform(model.prepared(rows))
    explained = materialize(
        scored.select("prediction", attribution.attribution_of(score.vector_to_array("features"), len(model.features), trees, weights).alias("attributions")),
        "explained",
    )
    importance = attribution.mean_abs(explained, model.features)
    summed = F.aggregate("attributions", F.lit(base), lambda acc, v: acc + v)
    gap = explained.agg(F.max(F.abs(summed - F.col("prediction"))).alias("gap")).first()["gap"]
    data = [(c, float(v), float(base), float(gap or 0.0)) for c, v in importance.items()]
    return spark.createDataFrame(data, "feature string, mean_abs_shap double, base_value double, max_additivity_gap double")


def line_items(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    return rows.select("l_orderkey", "l_quantity", "l_discount", (F.col("l_extendedprice") / 1000).alias("price"))


def shown_cv(out: DataFrame) -> DataFrame:
    return out.select("repeat", "fold", "n_train", "n_valid", settle("rmse", 4), settle("r2", 4))


def linear_cv_one(spark, d):
    """Least squares of price on quantity, five folds by order, two repeats, from one pass of sums."""
    return shown_cv(gramcv.cross_validate_linear(spark, line_items(spark, d), ["l_quantity"], "price", folds=5, repeats=2, key="l_orderkey"))


def linear_cv_two(spark, d):
    """As linear_cv_one with quantity and discount."""
    return shown_cv(gramcv.cross_validate_linear(spark, line_items(spark, d), ["l_quantity", "l_discount"], "price", folds=5, repeats=2, key="l_orderkey"))


def stacking(spark, d):
    rows, names = model_matrix(spark, d)
    return train.stacking_regressor(rows, names, C.TARGET).predict(rows).select("asset_id", "prediction")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        threat_validate, threat_rejects, threat_declared_rules, threat_coerce, threat_dedup, outliers_iqr, outliers_zscore,
        impute_neighbours, impute_medians, impute_defaults, null_report, threat_features, threat_scaled, asset_aggregate,
        threat_job, pentest_features, pentest_job, loss_job, merge_tables, integrity_report, top_assets, asset_accepted,
        asset_rejected, asset_enrich, asset_summary, model_profile, model_quality, correlations, cyber_features,
        percent_rank_rows, mutual_information, neighbour_information, second_order_split, one_hot, category_codes, robust_scale, feature_profile, regression_metrics,
        prediction_intervals, loss_histogram, prediction_scores, prediction_rejects, export_view, data_split,
        forest_importance, feature_selection, leaderboard, predict_table, staged_spread, permutation_importance,
        partial_dependence, learning_curve, stacking, tree_attributions, shap_importance, linear_cv_one, linear_cv_two, table_round_trips, csv_line_breaks, nuclei_report, httpx_report, nuclei_rejects, nuclei_checked, httpx_rejects, nmap_report, whatweb_report, naabu_report, subfinder_report, stacked_findings, merge_kinds, plain_regressor, line_model, fold_sizes, loss_histogram_log, loss_wide, loss_custom_costs,
    )
}
QUERIES["portfolio"] = portfolio_query
