"""Scanner reports as findings tables. A path may be one file or a folder of many.

The ``parse_*`` readers fail the job on a report line or file that cannot be read
instead of leaving a row of nulls. The ``read_*`` readers keep going: each parses once,
writes the parse once (counting read and rejected records while writing), and returns
the rows together with the rejected records, each with its file, its text and a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import constants as C
from riskspark.functions.columns import strip
from riskspark.session import materialize

# Internal column names of the checked readers; report fields never start with them.
CORRUPT, SOURCE = "__unreadable_record", "__source_file"
UNREADABLE = "unreadable or mistyped record"
UNCLOSED = "host element without its end tag"


@dataclass
class Checked:
    """Rows of a report, its rejected records (file, record, reason) and the counts of the write."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def _checked(parsed: DataFrame, tag: str) -> Checked:
    """Write a permissive parse once; rows and rejected records are read back from it."""
    seen = Observation(f"{tag}-counts")
    written = materialize(parsed.observe(seen, F.count(F.lit(1)).alias("read"), F.count(CORRUPT).alias("rejected")), tag)
    counts = {k: int(v) for k, v in seen.get.items()}
    rows = written.where(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE, "__reason")
    reason = F.col("__reason") if "__reason" in written.columns else F.lit(UNREADABLE)
    rejected = written.where(F.col(CORRUPT).isNotNull()).select(F.col(SOURCE).alias("file"), F.col(CORRUPT).alias("record"), reason.alias("reason"))
    return Checked(rows, rejected, counts)


def _permissive_json(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    full = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path, multiLine=multi_line).withColumn(SOURCE, F.col("_metadata.file_path"))

NMAP_HOST = (
    "address array<struct<_addr:string>>, "
    "ports struct<port:array<struct<_portid:string,_protocol:string,"
    "state:struct<_state:string>,service:struct<_name:string,_product:string,_version:string>>>>"
)
NUCLEI = (
    "host string, ip string, `matched-at` string, `template-id` string, "
    "info struct<severity:string,name:string,tags:string>"
)
HTTPX = "host string, url string, status_code long, title string, tech string, tls string, webserver string, cdn_name string"
WHATWEB = "target string, http_status long, plugins map<string,string>"


def _given(value: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(value, F.lit(""))


def _joined(value: Column) -> Column:
    """A JSON list joined by commas; other text stays as it is."""
    return F.coalesce(F.array_join(F.from_json(value, "array<string>"), ","), value)


def parse_nmap_xml(spark: SparkSession, path: str, asset_id: str | None = None) -> DataFrame:
    """One row per host and port."""
    hosts = spark.read.format("xml").option("rowTag", "host").option("mode", "FAILFAST").schema(NMAP_HOST).load(path)
    return nmap_rows(hosts, asset_id)


def read_nmap_xml(spark: SparkSession, path: str, asset_id: str | None = None) -> Checked:
    """Hosts and ports, and the host elements that could not be read.

    The files are cut at every ``</host>`` (a splittable text read, so one large file is
    read by many tasks); each piece is parsed as one host element on its own, so a broken
    host costs only itself. A piece holding two host starts kept the first without its end
    tag: that part is rejected, the last host of the piece is parsed.
    """
    pieces = spark.read.text(path, lineSep="</host>").select("value", F.col("_metadata.file_path").alias(SOURCE))
    starts = F.filter(F.split("value", r"(?=<host[\s>])"), lambda p: p.rlike(r"^<host[\s>]"))
    closed = F.when(F.size(starts) > 0, F.array(F.struct(F.element_at(starts, -1).alias("text"), F.lit(True).alias("closed"))))
    unclosed = F.transform(F.slice(starts, 1, F.greatest(F.size(starts) - 1, F.lit(0))), lambda p: F.struct(p.alias("text"), F.lit(False).alias("closed")))
    elements = pieces.select(SOURCE, F.explode(F.concat(unclosed, F.coalesce(closed, F.array().cast("array<struct<text:string,closed:boolean>>")))).alias("e"))
    full = T.StructType.fromDDL(NMAP_HOST).add(CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "rowTag": "host"}
    host = F.from_xml(F.concat("e.text", F.lit("</host>")), full, options)
    parsed = elements.select(SOURCE, "e.closed", F.when(F.col("e.closed"), host).alias("h"), "e.text").select(
        SOURCE,
        *[F.col("h")[f.name].alias(f.name) for f in T.StructType.fromDDL(NMAP_HOST).fields],
        F.when(~F.col("closed"), F.col("text")).otherwise(F.col("h")[CORRUPT]).alias(CORRUPT),
        F.when(~F.col("closed"), F.lit(UNCLOSED)).otherwise(F.lit(UNREADABLE)).alias("__reason"),
    )
    out = _checked(parsed, "nmap")
    return Checked(nmap_rows(out.rows, asset_id), out.rejected, out.counts)


def nmap_rows(hosts: DataFrame, asset_id: str | None = None) -> DataFrame:
    ip = F.col("address")[0]["_addr"]
    rows = hosts.select(ip.alias("ip_address"), F.explode("ports.port").alias("p"))
    return rows.select(
        (F.lit(asset_id) if asset_id else F.col("ip_address")).alias("asset_id"),
        "ip_address",
        F.lit("nmap").alias("source_tool"),
        F.coalesce(F.col("p._portid").try_cast("int"), F.lit(0)).alias("port"),
        F.col("p._protocol").alias("protocol"),
        F.col("p.state._state").alias("state"),
        F.col("p.service._name").alias("service"),
        F.col("p.service._product").alias("product"),
        F.col("p.service._version").alias("version"),
    )


def parse_nuclei_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row per template match."""
    return nuclei_rows(spark.read.schema(NUCLEI).json(path, mode="FAILFAST"))


def read_nuclei_jsonl(spark: SparkSession, path: str) -> Checked:
    """Template matches and the lines that could not be read."""
    out = _checked(_permissive_json(spark, path, NUCLEI, False), "nuclei")
    return Checked(nuclei_rows(out.rows), out.rejected, out.counts)


def nuclei_rows(items: DataFrame) -> DataFrame:
    return items.select(
        F.coalesce(_given(F.col("host")), F.col("ip")).alias("asset_id"),
        F.lit("nuclei").alias("source_tool"),
        "host",
        F.col("`matched-at`").alias("matched_at"),
        F.col("`template-id`").alias("template_id"),
        F.upper(F.coalesce("info.severity", F.lit(""))).alias("severity"),
        F.col("info.name").alias("finding_name"),
        _joined(F.col("info.tags")).alias("tags"),
    )


def parse_httpx_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row per probed address; any TLS detail counts as TLS."""
    return httpx_rows(spark.read.schema(HTTPX).json(path, mode="FAILFAST"))


def read_httpx_jsonl(spark: SparkSession, path: str) -> Checked:
    """Probed addresses and the lines that could not be read."""
    out = _checked(_permissive_json(spark, path, HTTPX, False), "httpx")
    return Checked(httpx_rows(out.rows), out.rejected, out.counts)


def httpx_rows(items: DataFrame) -> DataFrame:
    no_tls = F.lower(strip(F.coalesce("tls", F.lit("")))).isin("", "false", "0", "0.0", "{}", "[]", "null")
    return items.select(
        F.coalesce(_given(F.col("host")), F.col("url")).alias("asset_id"),
        F.lit("httpx").alias("source_tool"),
        "url",
        "status_code",
        "title",
        _joined(F.col("tech")).alias("tech_stack"),
        (~no_tls).alias("tls"),
        F.coalesce(_given(F.col("webserver")), F.col("cdn_name")).alias("waf"),
    )


def parse_whatweb_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per target; the file holds one object or an array of them."""
    return whatweb_rows(spark.read.schema(WHATWEB).json(path, multiLine=True, mode="FAILFAST"))


def read_whatweb_json(spark: SparkSession, path: str) -> Checked:
    """Targets and the files that could not be read (a file is one JSON document, rejected whole)."""
    out = _checked(_permissive_json(spark, path, WHATWEB, True), "whatweb")
    return Checked(whatweb_rows(out.rows), out.rejected, out.counts)


def whatweb_rows(items: DataFrame) -> DataFrame:
    names = F.coalesce(F.map_keys("plugins"), F.array().cast("array<string>"))
    return items.select(
        F.col("target").alias("asset_id"),
        F.lit("whatweb").alias("source_tool"),
        F.col("target").alias("url"),
        F.col("http_status").alias("status_code"),
        F.array_join(F.array_sort(names), ",").alias("tech_stack"),
        F.exists(names, lambda n: F.lower(n).isin(C.CMS_NAMES)).alias("cms_detected"),
    )


def parse_naabu_csv(spark: SparkSession, path: str) -> DataFrame:
    """Open ports; without a host column the address is the asset id."""
    df = spark.read.csv(path, header=True)
    df = df.withColumnsRenamed({"host": "asset_id", "ip": "ip_address"}).withColumn("source_tool", F.lit("naabu"))
    if "asset_id" not in df.columns and "ip_address" in df.columns:
        df = df.withColumn("asset_id", F.col("ip_address"))
    return df.withColumn("port", F.col("port").try_cast("int")) if "port" in df.columns else df


def parse_subfinder_txt(spark: SparkSession, path: str, root_asset_id: str | None = None) -> DataFrame:
    """One row per subdomain line."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("subdomain")).where("subdomain <> ''")
    return lines.select(
        (F.lit(root_asset_id) if root_asset_id else F.col("subdomain")).alias("asset_id"),
        F.lit("subfinder").alias("source_tool"),
        "subdomain",
    )
