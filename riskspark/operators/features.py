"""Model features per asset, encoding and splitting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import constants as C
from riskspark.functions.columns import clip, finite_or_null
from riskspark.functions.ordering import SMALL_DISTINCT, average_percent_rank, running_total
from riskspark.session import lookup, materialize

# Values per column that may become columns of their own; wider columns go to the long form.
MAX_COLUMN_VALUES = 1000


def _known(df: DataFrame, name: str) -> Column:
    """Column or 0; null is 0."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def _amount(df: DataFrame, name: str) -> Column:
    """Column or 0; null and negative are 0."""
    return F.greatest(_known(df, name), F.lit(0.0))


def cyber_features(df: DataFrame) -> dict[str, Column]:
    """All row-local features by name, in output order."""
    cvss_max, cvss_mean = _amount(df, "cvss_score_max"), _amount(df, "cvss_score_mean")
    epss_max, epss_mean = _amount(df, "epss_score_max"), _amount(df, "epss_score_mean")
    vulns, cves = _amount(df, "vuln_count"), _amount(df, "unique_cve_count")
    exploits, affected = _amount(df, "exploit_count_sum"), _amount(df, "affected_systems_count_sum")
    network, kev_sum = _amount(df, "is_network_exposed_max"), _amount(df, "kev_flag_sum")
    critical, high = _amount(df, "sev_count_critical"), _amount(df, "sev_count_high")
    age = _amount(df, "days_since_published_max")
    risk_max, risk_mean = _known(df, "composite_risk_score_max"), _known(df, "composite_risk_score_mean")
    pair_max, pair_mean = _known(df, "epss_cvss_interaction_max"), _known(df, "epss_cvss_interaction_mean")

    reach = F.log1p(affected)
    kev_strength = F.log1p(kev_sum) + _known(df, "kev_flag_max")
    composite = cvss_max * 0.35 + epss_max * 3.0 + pair_max * 0.2 + critical * 0.15
    return {
        "cvss_severity_score": clip(cvss_max * 0.7 + cvss_mean * 0.3, 0, 10),
        "asset_criticality_encoding": reach,
        "kev_feature_strength": kev_strength,
        "exploit_activity_score": F.log1p(exploits) * (epss_max + 1),
        "exposure_score": network + reach,
        "threat_density": F.coalesce(F.try_divide(vulns, cves), F.lit(0.0)),
        "attack_surface_score": F.log1p(vulns) * (network + 1) * (cvss_max / 10 + 1),
        "business_risk_score": risk_max * reach,
        "composite_vulnerability_score": composite,
        "threat_frequency": F.log1p(vulns),
        "cvss_asset_criticality_interaction": cvss_max * reach,
        "epss_exploit_count_interaction": epss_max * F.log1p(exploits),
        "attack_vector_encoding": network,
        "vendor_product_risk": F.log1p(cves) * (high + critical + 1),
        "mean_cvss_per_asset": cvss_mean,
        "maximum_cvss": cvss_max,
        "average_epss": epss_mean,
        "recent_threat_score": risk_max / (F.log1p(age) + 1),
        "business_exposure_index": reach * (network + 1),
        "weighted_risk_index": composite * (kev_strength + 1),
        "asset_importance_score": F.log1p(affected + vulns),
        "threat_intelligence_confidence": risk_mean * (pair_mean + 1),
        "vulnerability_age": age,
        "exploit_availability": ((exploits > 0) | (kev_sum > 0)).cast("int"),
    }


def infinite_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floats}) if floats else df


def build_cyber_features(df: DataFrame, rank: bool = True, small: int = SMALL_DISTINCT) -> DataFrame:
    """Add the model features; existing columns of the same name are overwritten.

    ``rank`` adds ``risk_percentile``, the only feature that looks at other rows.
    """
    out = df.withColumns(cyber_features(df))
    if rank:
        out = average_percent_rank(out, "weighted_risk_index", "risk_percentile", small)
    return infinite_to_null(out)


# --- encoding and splitting ------------------------------------------------------


def one_hot_encode(
    df: DataFrame, target: str = C.SOURCE_TARGET, exclude: Iterable[str] = ("asset_id",), max_values: int | None = MAX_COLUMN_VALUES
) -> DataFrame:
    """Replace text and boolean columns by one boolean column per value plus one for null.

    Values become columns, so their names pass the driver: a column with more than
    ``max_values`` values (an id, free text) is refused, never cut; exclude it or encode it
    in the long form of :func:`coded_cells`, whose values never leave the executors.
    """
    skip = {target, *exclude}
    kinds = (T.StringType, T.BooleanType)
    words = [f for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]
    if not words:
        return df
    cells = F.array(
        *[F.struct(F.lit(f.name).alias("name"), F.col(f.name).cast("string").alias("value")) for f in words]
    )
    found = df.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").distinct()
    found = materialize(found, "values")
    if max_values is not None:
        for row in found.groupBy("name").count().where(F.col("count") > max_values).collect():
            raise ValueError(f"{row['name']} has more than {max_values} values; exclude it")
    values: dict[str, list[str]] = {}
    for row in found.collect():
        values.setdefault(row["name"], []).append(row["value"])
    encoded: list[Column] = []
    for f in words:
        label = str.title if isinstance(f.dataType, T.BooleanType) else str
        for value in sorted(values.get(f.name, [])):
            hit = F.coalesce(F.col(f.name).cast("string") == F.lit(value), F.lit(False))
            encoded.append(hit.alias(f"{f.name}_{label(value)}"))
        encoded.append(F.col(f.name).isNull().alias(f"{f.name}_nan"))
    gone = {f.name for f in words}
    return df.select(*[c for c in df.columns if c not in gone], *encoded)


def category_codes(df: DataFrame, columns: Iterable[str], small: int = SMALL_DISTINCT) -> DataFrame:
    """Dictionary (name, value, code) of the non-null values of text columns: dense codes from 0
    per column in value order.

    Codes are ranks taken by range: values are range-partitioned, each range counted, and
    offsets of the ranges added (``running_total``), so no column's values meet in one task
    and none reach the driver. Written once.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    found = materialize(df.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").distinct().withColumn("one", F.lit(1)), "categories")
    return materialize(running_total(found, "one", order="value", group="name", small=small).select("name", "value", F.col("before").cast("long").alias("code")), "codes")


def coded_cells(df: DataFrame, keys: Iterable[str], columns: Iterable[str], small: int = SMALL_DISTINCT) -> DataFrame:
    """One-hot in long form: (keys..., name, value, code) per row and encoded column.

    The wide boolean table is this table pivoted; a null cell has code -1 (the ``_nan``
    column). The dictionary is broadcast only within its counted bound; beyond it the
    join shuffles and AQE splits a skewed value, and null cells stay out of the join.
    """
    keys, columns = list(keys), list(columns)
    dictionary = category_codes(df, columns, small)
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.name", "c.value")
    known = long.where("value IS NOT NULL").join(lookup(dictionary), ["name", "value"])
    missing = long.where("value IS NULL").withColumn("code", F.lit(-1).cast("long"))
    return known.select(*keys, "name", "value", "code").unionByName(missing)


def hash_share(seed: int, key: str = "asset_id", purpose: str = "split") -> Column:
    """A stable number in [0, 1) per key; the same after any repartitioning.

    ``purpose`` keeps draws apart: rows that a split left in training are still
    spread evenly over folds. It is read off an MD5, which other engines have too.
    """
    digest = F.md5(F.concat_ws(":", F.lit(purpose), F.lit(seed), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_fold(folds: int, seed: int, key: str = "asset_id") -> Column:
    """Stable fold number 0..folds-1 per key."""
    return F.floor(hash_share(seed, key, "fold") * folds).cast("int")


def train_val_test_split(
    df: DataFrame, target: str = C.SOURCE_TARGET, seed: int = 42, key: str = "asset_id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """70 / 15 / 15 split by key hash."""
    if target not in df.columns:
        raise ValueError(f"Target column not found: {target}")
    share = hash_share(seed, key)
    return df.where(share < 0.7), df.where((share >= 0.7) & (share < 0.85)), df.where(share >= 0.85)
