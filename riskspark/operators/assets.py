"""Asset inventory: typing, validation, enrichment and summary, all as expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import constants as C
from riskspark.functions.columns import present, round_even, strip, text_flag

SERVICE = "struct<port:string,service:string,version:string>"
# --- fixed values: patterns ------------------------------------------------------
IPV4 = r"((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LABEL = r"[a-zA-Z0-9]([a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?"
FQDN = rf"^(?=.{{1,253}}$)(?!-)({LABEL}\.)+[a-zA-Z]{{2,63}}$"
ISO_MOMENT = r"^\d{4}-?\d{2}-?\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
ISO_PARTS = r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"


# --- typing ----------------------------------------------------------------------


def _is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def list_column(df: DataFrame, name: str) -> Column:
    """A list cell (native, JSON text or quoted text) as array of text; unreadable is empty.

    Elements stay text: decoding straight to numbers would lose the whole list
    over one bad element, and the row would pass without its ports.
    """
    empty = F.array().cast("array<string>")
    if name not in df.columns:
        return empty
    if _is_array(df, name):
        return F.coalesce(F.col(name).cast("array<string>"), empty)
    return F.coalesce(F.from_json(strip(F.col(name).cast("string")), "array<string>"), empty)


def service_column(df: DataFrame, name: str = "services") -> Column:
    """A list of service objects; entries that are no objects are left out."""
    empty = F.array().cast(f"array<{SERVICE}>")
    if name not in df.columns:
        return empty
    if _is_array(df, name) and isinstance(df.schema[name].dataType.elementType, T.StructType):
        fields = df.schema[name].dataType.elementType.names

        def entry(e: Column) -> Column:
            parts = [
                (e[f].cast("string") if f in fields else F.lit(None).cast("string")).alias(f)
                for f in ("port", "service", "version")
            ]
            return F.struct(*parts)

        native = F.filter(F.col(name), lambda e: e.isNotNull())
        return F.coalesce(F.transform(native, entry), empty)
    objects = F.filter(list_column(df, name), lambda e: F.ltrim(e).startswith("{"))
    return F.transform(objects, lambda e: F.from_json(e, SERVICE))


def normalise_types(df: DataFrame) -> DataFrame:
    """Text without nulls, decoded lists, boolean exposure, dates still as text."""
    texts = present(df, ["asset_id", "host", "domain", "last_seen"])
    new = {c: strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in texts}
    new |= {c: list_column(df, c) for c in ("ports", "tags", "discovered_by")}
    new["services"] = service_column(df)
    if "internet_exposed" in df.columns:
        new["internet_exposed"] = text_flag(F.col("internet_exposed"))
    return df.withColumns(new)


# --- validation ------------------------------------------------------------------


def is_ip_address(value: Column) -> Column:
    """Dotted IPv4 without leading zeros, or IPv6 (compressed, with IPv4 tail or zone)."""
    plain = F.regexp_replace(value, r"%[^%]+$", "")
    tail = F.regexp_replace(plain, rf"(?<=:){IPV4}$", "0:0")
    groups = r"[0-9a-fA-F]{1,4}(:[0-9a-fA-F]{1,4})*"
    full = tail.rlike(r"^([0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}$")
    short = tail.rlike(rf"^({groups})?::({groups})?$")
    count = F.size(F.regexp_extract_all(tail, F.lit(r"([0-9a-fA-F]{1,4})"), 1))
    return value.rlike(rf"^{IPV4}$") | full | (short & (count <= 7))


def is_domain(value: Column) -> Column:
    """Single label or fully qualified name."""
    return F.when(value.contains("."), value.rlike(FQDN)).otherwise(value.rlike(rf"^{LABEL}$"))


def port_number(value: Column) -> Column:
    """Whole numbers, also as decimals such as 22.0; other text is null."""
    plain = F.regexp_extract(strip(value), r"^([+-]?\d+)(\.0*)?$", 1)
    return plain.try_cast("int")


def is_port(value: Column) -> Column:
    return F.coalesce(port_number(value).between(C.PORT_LOW, C.PORT_HIGH), F.lit(False))


def parse_moment(value: Column) -> Column:
    """ISO-8601 text, extended or basic, to UTC; null if unreadable.

    Fractions are cut at microseconds. If only the offset is unreadable it is dropped.
    """
    part = lambda i, default: F.coalesce(F.nullif(F.regexp_extract(value, ISO_PARTS, i), F.lit("")), F.lit(default))
    day, clock = F.concat_ws("-", part(1, ""), part(2, ""), part(3, "")), F.concat_ws(":", part(4, "00"), part(5, "00"), part(6, "00"))
    moment = F.concat(day, F.lit("T"), clock, F.lit("."), F.substring(F.rpad(part(7, "0"), 6, "0"), 1, 6))
    offset = part(8, "Z")
    digits = F.regexp_replace(offset, "[Z:]", "")
    zone = F.when(offset == "Z", F.lit("Z")).otherwise(F.concat_ws(":", F.substring(digits, 1, 3), F.rpad(F.substring(digits, 4, 2), 2, "0")))
    readable = value.rlike(ISO_MOMENT)
    return F.coalesce(F.try_to_timestamp(F.when(readable, F.concat(moment, zone))), F.try_to_timestamp(F.when(readable, F.concat(moment, F.lit("Z")))))


def _rules() -> list[tuple[Column, str]]:
    """(rule, message) per field of a type-normalised asset row."""
    col = F.col
    moment = parse_moment(col("last_seen"))
    services = F.forall(
        "services", lambda s: is_port(s["port"]) & (F.length(strip(F.coalesce(s["service"], F.lit("")))) > 0)
    )
    return [
        (col("asset_id").startswith("ASSET-"), "asset_id must start with 'ASSET-'"),
        ((col("host") == "") | is_ip_address(col("host")), "host is not a valid IPv4 or IPv6 address"),
        ((col("domain") == "") | is_domain(col("domain")), "domain is not a valid hostname or FQDN"),
        (F.forall("ports", is_port), "ports must be whole numbers from 1 to 65535"),
        (services, "services need a valid port and a name"),
        (moment.isNotNull(), "last_seen cannot be parsed"),
        ((col("host") != "") | (col("domain") != ""), "both host and domain are empty"),
    ]


def validate_assets(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split type-normalised rows into (accepted, rejected with ``reason``).

    Accepted rows hold exactly the asset columns, normalised; other columns go.
    """
    texts = {c: F.lit("") for c in ("asset_id", "host", "domain", "last_seen") if c not in df.columns}
    if "internet_exposed" not in df.columns:
        texts["internet_exposed"] = F.lit(False)
    full = df.withColumns(texts) if texts else df
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(m)) for r, m in _rules()]))
    judged = full.withColumn("_reasons", reasons)
    rejected = judged.where(F.size("_reasons") > 0).select("asset_id", F.concat_ws("; ", "_reasons").alias("reason"))

    word = lambda e: F.lower(strip(e))
    service = lambda s: F.struct(
        port_number(s["port"]).alias("port"),
        word(s["service"]).alias("service"),
        strip(F.coalesce(s["version"], F.lit(""))).alias("version"),
    )
    accepted = judged.where(F.size("_reasons") == 0).select(
        "asset_id",
        "host",
        F.lower("domain").alias("domain"),
        F.transform("ports", port_number).alias("ports"),
        F.transform("services", service).alias("services"),
        F.filter(F.transform("tags", word), lambda t: t != "").alias("tags"),
        F.transform("discovered_by", word).alias("discovered_by"),
        "internet_exposed",
        parse_moment(F.col("last_seen")).alias("last_seen"),
    )
    return accepted, rejected


# --- enrichment ------------------------------------------------------------------


def _texts(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _overlap(values: Column, catalogue: Iterable) -> Column:
    return F.coalesce(F.arrays_overlap(values, _texts(catalogue)), F.lit(False))


def _score(parts: Iterable[tuple[Column, float]]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(hit, F.lit(w)).otherwise(F.lit(0.0)) for hit, w in parts])


def asset_type() -> Column:
    """First matching rule wins."""
    svc, ports, tags = F.col("_names"), F.col("_ports"), F.col("_tags")
    rdp = _overlap(svc, ["rdp", "ms-wbt-server"]) | F.array_contains(ports, 3389)
    windows = _overlap(svc, ["rdp", "ms-wbt-server", "microsoft-ds"]) | F.array_contains(ports, 3389)
    ssh = F.array_contains(svc, "ssh") | F.array_contains(ports, 22)
    has_domain, has_host = strip(F.col("domain")) != "", strip(F.col("host")) != ""
    no_ports = F.size(ports) == 0
    crtsh = F.array_contains(F.transform("discovered_by", F.lower), "crtsh")
    rules = [
        (F.array_contains(tags, "firewall") | _overlap(svc, C.FIREWALL_SERVICES), "Firewall"),
        (F.col("has_remote_access_service") & windows, "Windows Server"),
        (ssh & ~rdp, "Linux Server"),
        (F.col("has_database_service"), "Database Server"),
        (_overlap(svc, C.SMB_SERVICES), "Windows File Server"),
        (F.col("has_web_service"), "Web Server"),
        (_overlap(svc, C.MAIL_SERVICES) | _overlap(ports, C.MAIL_PORTS), "Mail Server"),
        (_overlap(svc, C.DNS_SERVICES) | F.array_contains(ports, 53), "DNS Server"),
        (has_domain & ~has_host & crtsh, "Domain Asset"),
        (has_domain & has_host & no_ports, "Domain Asset"),
        (has_host & ~has_domain & no_ports, "Network Host"),
    ]
    chain = None
    for rule, label in rules:
        chain = F.when(rule, label) if chain is None else chain.when(rule, label)
    return chain.otherwise("Unknown")


def enrich_assets(df: DataFrame) -> DataFrame:
    """Add counts, flags, scores and the asset type to validated assets."""
    names = F.array_distinct(
        F.filter(F.transform("services", lambda s: F.lower(strip(s["service"]))), lambda n: n != "")
    )
    prepared = df.withColumns(
        {
            "_names": F.coalesce(names, F.array().cast("array<string>")),
            "_ports": F.coalesce(F.array_distinct(F.array_compact("ports")), F.array().cast("array<int>")),
            "_tags": F.coalesce(F.transform("tags", lambda t: F.lower(t)), F.array().cast("array<string>")),
        }
    )
    svc, ports, tags = F.col("_names"), F.col("_ports"), F.col("_tags")
    flagged = prepared.withColumns(
        {
            "number_of_ports": F.size(ports),
            "number_of_services": F.coalesce(F.size("services"), F.lit(0)),
            "has_web_service": _overlap(svc, C.WEB_SERVICES) | _overlap(ports, C.WEB_PORTS),
            "has_database_service": _overlap(svc, C.DATABASE_SERVICES) | _overlap(ports, C.DATABASE_PORTS),
            "has_tls": F.array_contains(tags, "tls") | F.array_contains(ports, 443) | _overlap(svc, C.TLS_SERVICES),
            "has_remote_access_service": _overlap(svc, C.REMOTE_SERVICES) | _overlap(ports, C.REMOTE_PORTS),
            "is_public_asset": F.coalesce(F.col("internet_exposed"), F.lit(False)),
            "_high_risk": _overlap(ports, C.HIGH_RISK_PORTS),
        }
    )
    col = F.col
    count_part = F.least(col("number_of_ports") / 20, F.lit(1.0)) * 0.10
    exposure = count_part + _score(
        [
            (col("is_public_asset"), 0.40),
            (col("_high_risk"), 0.30),
            (col("has_remote_access_service"), 0.15),
            (col("has_database_service"), 0.05),
        ]
    )
    risk = _score(
        [
            (col("is_public_asset"), 3.0),
            (col("has_remote_access_service"), 2.5),
            (col("has_database_service"), 2.0),
            (col("_high_risk"), 1.5),
            (col("has_web_service"), 0.5),
            (col("number_of_ports") > 5, 0.3),
            (col("number_of_ports") > 10, 0.2),
        ]
    )
    return flagged.withColumns(
        {
            "exposure_score": round_even(F.least(exposure, F.lit(1.0)), 4),
            "asset_risk_score": round_even(F.least(risk, F.lit(10.0)), 2),
            "asset_type": asset_type(),
        }
    ).drop("_names", "_ports", "_tags", "_high_risk")


# --- summary ---------------------------------------------------------------------


def inventory_summary(enriched: DataFrame, rejected: DataFrame) -> DataFrame:
    """Long table (section, item, value) of the enriched inventory.

    The risk score has at most a few hundred possible values, so its median is
    safe to take with the built-in exact aggregate.
    """
    n = F.count(F.lit(1))
    flags = ["has_web_service", "has_database_service", "has_tls", "has_remote_access_service"]
    risk, exposure, ports, public = (
        F.col(c) for c in ("asset_risk_score", "exposure_score", "number_of_ports", "is_public_asset")
    )
    wanted: list[tuple[str, str, Column]] = [
        ("internet_exposure", "exposed", F.count_if(public)),
        ("internet_exposure", "internal", F.count_if(~public)),
        ("internet_exposure", "exposure_pct", round_even(F.avg(public.cast("double")) * 100, 2)),
        *[("service_flags", f, F.count_if(F.col(f))) for f in flags],
        ("port_statistics", "assets_with_open_ports", F.count_if(ports > 0)),
        ("port_statistics", "max_ports_on_single_asset", F.max(ports)),
        ("port_statistics", "mean_ports", round_even(F.avg(ports), 3)),
        ("risk_score_distribution", "mean", round_even(F.avg(risk), 3)),
        ("risk_score_distribution", "median", round_even(F.median(risk), 3)),
        ("risk_score_distribution", "max", round_even(F.max(risk), 3)),
        ("risk_score_distribution", "high_risk_count", F.count_if(risk >= 5.0)),
        ("exposure_score_distribution", "mean", round_even(F.avg(exposure), 4)),
        ("exposure_score_distribution", "max", round_even(F.max(exposure), 4)),
    ]
    entry = lambda s, i, v: F.struct(
        F.lit(s).alias("section"), F.lit(i).alias("item"), v.cast("double").alias("value")
    )

    def long(one_row: DataFrame, cells: list[tuple[str, str, Column]]) -> DataFrame:
        return one_row.select(F.explode(F.array(*[entry(*c) for c in cells])).alias("e")).select("e.*")

    stats = enriched.agg(*[v.cast("double").alias(f"{s}|{i}") for s, i, v in wanted])
    fixed = long(stats, [(s, i, F.col(f"`{s}|{i}`")) for s, i, _ in wanted])

    outcome = enriched.select(F.lit(1).alias("ok")).unionByName(rejected.select(F.lit(0).alias("ok")))
    accepted, processed = F.col("accepted"), F.col("processed")
    meta = long(
        outcome.agg(F.coalesce(F.sum("ok"), F.lit(0)).alias("accepted"), n.alias("processed")),
        [
            ("pipeline_metadata", "total_records_processed", processed),
            ("pipeline_metadata", "accepted", accepted),
            ("pipeline_metadata", "rejected", processed - accepted),
            ("pipeline_metadata", "pass_rate_pct", round_even(accepted * 100 / F.greatest(processed, F.lit(1)), 2)),
        ],
    )

    def counted(section: str, source: DataFrame) -> DataFrame:
        grouped = source.where(F.col("item").isNotNull()).groupBy("item").agg(n.cast("double").alias("value"))
        return grouped.select(F.lit(section).alias("section"), "item", "value")

    types = counted("asset_type_distribution", enriched.select(F.col("asset_type").alias("item")))
    tools = counted("discovery_source", enriched.select(F.explode("discovered_by").alias("item")))
    return meta.unionByName(fixed).unionByName(types).unionByName(tools)


def summary_to_dict(summary: DataFrame) -> dict[str, dict[str, float]]:
    """The summary (a few dozen rows) as nested maps for a JSON file."""
    out: dict[str, dict[str, float]] = {}
    for row in summary.collect():
        out.setdefault(row["section"], {})[row["item"]] = row["value"]
    return out
