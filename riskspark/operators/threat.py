"""Threat records: validation, cleaning, row features and the per-asset roll-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import clip, column_or, lenient_double, lenient_long, present, quoted, round_even, strip, text_flag
from riskspark.functions.ordering import quantiles

REJECT_REASON = "required field/range validation failed"


# --- validation ------------------------------------------------------------------


def complete_columns(df: DataFrame, as_of: str) -> DataFrame:
    """Derive the columns later steps expect from whatever the table has.

    ``as_of`` (ISO text) stands in for the present moment, so a job can be rerun.
    """
    if "asset_id" not in df.columns:
        raise ValueError("Required column missing: asset_id")
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "record_id" not in have:
        cve = F.coalesce(column_or(df, "cve_id", "").cast("string"), F.lit(""))
        new["record_id"] = F.concat(F.col("asset_id").cast("string"), F.lit("::"), cve)
    if "source_feed" not in have:
        new["source_feed"] = F.coalesce(column_or(df, "source", "unknown"), F.lit("unknown"))
    if "published_date" not in have and "published" in have:
        new["published_date"] = F.col("published")
    if "first_seen" not in have and "date_added" in have:
        new["first_seen"] = F.coalesce(*[F.col(c) for c in present(df, ["date_added", "published"])])
    if "last_seen" not in have:
        new["last_seen"] = F.lit(as_of)
    if "days_since_first_seen" not in have and "days_since_published" in have:
        new["days_since_first_seen"] = F.col("days_since_published")
    if "days_active" not in have:
        new["days_active"] = F.lit(0)
    if "kev_listed" not in have:
        evidence = present(df, ["date_added", "known_ransomware"])
        filled = F.length(F.col(evidence[0]).cast("string")) > 0 if evidence else F.lit(False)
        new["kev_listed"] = F.coalesce(filled, F.lit(False))
    if "affected_systems_count" not in have:
        new["affected_systems_count"] = column_or(df, "asset_exposure_score", 1)
    if "attack_vector" not in have:
        scope = F.upper(F.coalesce(column_or(df, "scope", "").cast("string"), F.lit("")))
        new["attack_vector"] = F.when(scope.isin(C.NETWORK_SCOPES), "network").otherwise("local")
    out = df.withColumns(new) if new else df

    fixed = {c: lenient_double(F.col(c)) for c in present(out, C.OUTLIER_COLUMNS)}
    if "severity" in have:
        word = F.lower(strip(F.coalesce(F.col("severity").cast("string"), F.lit("low"))))
        fixed["severity"] = F.when(word.isin("informational", "none"), "info").otherwise(word)
    return out.withColumns(fixed)


def acceptable(df: DataFrame) -> Column:
    """True for rows with an asset id and scores in range; unknown scores pass. Never null."""
    rule = F.col("asset_id").isNotNull() & (F.length(F.col("asset_id").cast("string")) > 0)
    for c, top in (("cvss_score", 10), ("epss_score", 1)):
        if c in df.columns:
            rule = rule & (F.col(c).isNull() | F.col(c).between(0, top))
    return rule


def validate_threats(df: DataFrame, as_of: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``error``); ``strict`` raises if any row is bad."""
    out = complete_columns(df, as_of)
    good = acceptable(out)
    rejected = out.where(~good).withColumn("error", F.lit(REJECT_REASON))
    if strict and rejected.limit(1).count():
        raise ValueError(REJECT_REASON)
    return out.where(good), rejected


def declared_rule_violations(df: DataFrame) -> DataFrame:
    """Rows that break the declared record rules, with ``reasons``.

    Stricter than :func:`validate_threats` and not part of the threat job.
    """
    rules = {}
    for c, allowed in (("severity", C.SEVERITIES), ("attack_vector", C.ATTACK_VECTORS)):
        if c in df.columns:
            rules[f"{c} not allowed"] = ~F.lower(strip(F.col(c))).isin(allowed)
    for c in present(df, ["exploit_count", "affected_systems_count"]):
        rules[f"{c} negative"] = F.col(c) < 0
    for c, top in (("cvss_score", 10), ("epss_score", 1)):
        if c in df.columns:
            rules[f"{c} out of range"] = ~F.col(c).between(0, top)
    if {"first_seen", "last_seen"} <= set(df.columns):
        rules["first_seen after last_seen"] = as_utc(df, "first_seen") > as_utc(df, "last_seen")
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(text)) for text, rule in rules.items()]))
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


# --- cleaning --------------------------------------------------------------------


def coerce_types(df: DataFrame) -> DataFrame:
    """Flags to boolean, scores to double, counts to whole numbers (null is 0), words lower-cased."""
    fixed = {c: text_flag(F.col(c)) for c in present(df, ["kev_listed"])}
    fixed |= {c: lenient_double(F.col(c)) for c in present(df, ["cvss_score", "epss_score"])}
    fixed |= {c: F.coalesce(lenient_long(F.col(c)), F.lit(0).cast("bigint")) for c in present(df, C.MEDIAN_COLUMNS)}
    words = present(df, ["severity", "attack_vector", "attack_complexity"])
    fixed |= {c: F.lower(strip(F.col(c))) for c in words}
    return df.withColumns(fixed) if fixed else df


def deduplicate(
    df: DataFrame,
    keys: Iterable[str] = tuple(C.DEDUP_KEYS),
    newest: str = "last_seen",
    tie_break: Iterable[str] | None = None,
) -> DataFrame:
    """Keep the newest row per key (null keys are equal, null dates lose).

    ``row_number() = 1`` lets Spark cut every key down to one row per task before
    the shuffle, so a key with a third of all rows does not pile up. The shuffle is
    on the whole key, not on the asset alone: one asset may be very large.
    """
    keys = present(df, keys)
    ties = list(tie_break) if tie_break is not None else sorted(set(df.columns) - {*keys, newest})
    order = [F.col(c).desc_nulls_last() for c in present(df, [newest]) + ties]
    # The hash in front only speeds up the sort: it decides most comparisons in one step.
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") == 1).drop("_row")


@dataclass(frozen=True)
class OutlierModel:
    """Per column: fences (low, high) or, for z-scores, (mean, deviation, threshold)."""

    method: str
    params: dict[str, tuple[float, ...]]

    def rule(self, column: str) -> Column:
        value = F.col(column).cast("double")
        if self.method == "zscore":
            mean, deviation, threshold = self.params[column]
            if not deviation:
                return F.lit(False)
            return F.coalesce(F.abs((value - mean) / deviation) > threshold, F.lit(False))
        low, high = self.params[column]
        return F.coalesce((value < low) | (value > high), F.lit(False))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``is_outlier``: true if any known column is out of bounds. Removes nothing."""
        rules = [self.rule(c) for c in present(df, self.params)]
        return df.withColumn("is_outlier", reduce(lambda a, b: a | b, rules, F.lit(False)))


def fit_outliers(
    df: DataFrame,
    method: str = "iqr",
    columns: Iterable[str] = tuple(C.OUTLIER_COLUMNS),
    zscore_threshold: float = 3.5,
    iqr_multiplier: float = 1.5,
) -> OutlierModel:
    """Learn outlier bounds in one pass over the columns."""
    columns = present(df, columns)
    params: dict[str, tuple[float, ...]] = {}
    if method == "zscore":
        stats = df.agg(
            *[F.avg(c).alias(f"{c}|mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}|dev") for c in columns]
        ).first()
        for c in columns:
            if stats[f"{c}|mean"] is not None:
                params[c] = (stats[f"{c}|mean"], stats[f"{c}|dev"], zscore_threshold)
        return OutlierModel(method, params)
    for c, q in quantiles(df, {c: [0.25, 0.75] for c in columns}).items():
        if q[0.25] is not None:
            spread = q[0.75] - q[0.25]
            params[c] = (q[0.25] - iqr_multiplier * spread, q[0.75] + iqr_multiplier * spread)
    return OutlierModel("iqr", params)


# --- row features ----------------------------------------------------------------


def weight_of(value: Column, weights: Mapping[str, float], other: float) -> Column:
    """Number that belongs to a word; ``other`` for unknown words and null."""
    out = None
    for word, weight in weights.items():
        hit = value == word
        out = F.when(hit, F.lit(float(weight))) if out is None else out.when(hit, F.lit(float(weight)))
    return out.otherwise(F.lit(float(other)))


def as_utc(df: DataFrame, column: str) -> Column:
    """A date column of any kind as a UTC timestamp, null if unreadable."""
    if dict(df.dtypes)[column] == "string":
        return F.try_to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")


def whole_days(start: Column, end: Column) -> Column:
    """Complete days between two moments, never below 0, null if either is unknown."""
    day = 86_400_000_000
    days = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(day)).cast("bigint")
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0).cast("bigint")))


def engineer_threats(df: DataFrame, as_of: str) -> DataFrame:
    """Risk score, day counts, 0/1 flags and interaction terms; one projection, no shuffle."""
    have = set(df.columns)
    severity = weight_of(column_or(df, "severity", "low"), C.SEVERITY_WEIGHT, 0) / 4
    vector = weight_of(column_or(df, "attack_vector", "local"), C.VECTOR_WEIGHT, 0) / 4
    cvss = column_or(df, "cvss_score", 0.0) / 10
    epss = F.coalesce(column_or(df, "epss_score", 0.0), F.lit(0.0))
    listed = column_or(df, "kev_listed", False).cast("double")
    blend = (cvss * 0.4 + epss * 0.3 + severity * 0.2 + vector * 0.1) * 10 + listed * 0.5
    out = df.withColumn("composite_risk_score", round_even(clip(blend, 0, 10), 4))

    moment = F.to_timestamp(F.lit(as_of))
    days = {}
    for source, target in (("published_date", "days_since_published"), ("first_seen", "days_since_first_seen")):
        if source in have and target not in have:
            days[target] = whole_days(as_utc(df, source), moment)
    if {"first_seen", "last_seen"} <= have and "days_active" not in have:
        days["days_active"] = whole_days(as_utc(df, "first_seen"), as_utc(df, "last_seen"))

    flags = {}
    if "epss_score" in have:
        flags["is_exploitable"] = F.col("epss_score") >= 0.1
    if "severity" in have:
        flags["is_critical"] = F.col("severity") == "critical"
    if "attack_vector" in have:
        flags["is_network_exposed"] = F.col("attack_vector") == "network"
    if "kev_listed" in have:
        flags["kev_flag"] = F.col("kev_listed")
    flags = {c: F.coalesce(rule, F.lit(False)).cast("int") for c, rule in flags.items()}

    terms = {}
    if {"epss_score", "cvss_score"} <= have:
        terms["epss_cvss_interaction"] = round_even(F.col("epss_score") * F.col("cvss_score"), 4)
    if "exploit_count" in have:
        terms["risk_exploit_product"] = round_even(F.col("composite_risk_score") * F.log1p("exploit_count"), 4)
    return out.withColumns({**days, **flags, **terms})


# --- per-asset roll-up -----------------------------------------------------------

_REDUCERS = {
    "max": F.max,
    "min": F.min,
    "mean": F.avg,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
}


# --- fixed values: counted without repeats ---
DISTINCT_COUNTS = {"cve_id": "unique_cve_count", "threat_actor": "unique_threat_actor_count"}


# Severity words that may become columns of their own; more are refused, never cut.
MAX_SEVERITY_WORDS = 64


def observed_severities(df: DataFrame, most: int | None = MAX_SEVERITY_WORDS) -> list[str]:
    """The severity words in a table. They become columns, so at most ``most`` of them pass the driver; more are refused, never cut."""
    words = df.where(F.col("severity").isNotNull()).select("severity").distinct()
    found = (words if most is None else words.limit(most + 1)).collect()
    if most is not None and len(found) > most:
        raise ValueError(f"severity has more than {most} values; pass the ones to count")
    return sorted(r["severity"] for r in found)


def aggregate_assets(
    df: DataFrame,
    group_key: str = "asset_id",
    severities: Iterable[str] | None = None,
    approximate: bool = False,
    ends: Iterable[str] = (),
    moments: Iterable[str] = (),
) -> DataFrame:
    """One row per asset: the aggregate map, row and distinct counts, severity counts.

    Distinct counts are taken from narrow (asset, value) pairs and joined to the
    main aggregate. In one aggregate Spark would have to group by both and carry
    every buffer through a shuffle of nearly all rows. Pairs are spread by asset
    and value, so a huge asset is counted in many tasks. As ``df`` is read once per
    branch, pass a written table or cheap projections of one.
    ``severities`` fixes the severity columns; by default they are the observed words.
    ``ends`` adds minimum and maximum (``_<column>_lo``, ``_hi``), ``moments`` count, mean
    and squared deviation (``_n``, ``_avg``, ``_dev``) for a scaler fitted afterwards.
    """
    if group_key not in df.columns:
        raise ValueError(f"group_key '{group_key}' not found in DataFrame.")
    rows = df.where(F.col(group_key).isNotNull())
    columns = [
        _REDUCERS[fn](F.col(c)).alias(f"{c}_{fn}")
        for c, fns in C.ASSET_AGGREGATES.items()
        if c in df.columns
        for fn in fns
    ]
    columns.append(F.count(F.lit(1)).alias("vuln_count"))
    distinct = {c: n for c, n in DISTINCT_COUNTS.items() if c in df.columns}
    if approximate:
        columns += [F.approx_count_distinct(c).alias(n) for c, n in distinct.items()]
    severity_columns = []
    if "severity" in df.columns:
        words = observed_severities(df) if severities is None else severities
        severity_columns = [f"sev_count_{w}" for w in words]
        columns += [F.count_if(F.col("severity") == w).alias(f"sev_count_{w}") for w in words]
    for c in ends:
        columns += [F.min(F.col(c)).alias(f"_{c}_lo"), F.max(F.col(c)).alias(f"_{c}_hi")]
    for c in moments:
        dev = F.var_pop(F.col(c)) * F.count(F.col(c))
        columns += [F.count(F.col(c)).alias(f"_{c}_n"), F.avg(F.col(c)).alias(f"_{c}_avg"), dev.alias(f"_{c}_dev")]
    out = rows.groupBy(group_key).agg(*columns)
    if approximate or not distinct:
        return out
    for c, name in distinct.items():
        pairs = rows.where(F.col(c).isNotNull()).select(group_key, c).distinct()
        counts = pairs.groupBy(group_key).agg(F.count(F.lit(1)).alias(name))
        out = out.join(counts, group_key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    last = [*severity_columns, *[c for c in out.columns if c.startswith("_")]]
    names = list(distinct.values())
    return out.select(*[quoted(c) for c in (*[c for c in out.columns if c not in {*names, *last}], *names, *last)])
