"""Threat, finding and asset rows derived from the given tables.

The same SQL text runs in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.session import use_utc

AS_OF = "2024-02-01T00:00:00+00:00"

THREAT = """
SELECT CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE concat('ASSET-', CAST(l_suppkey AS STRING)) END AS asset_id,
 concat('CVE-', CAST(l_partkey AS STRING)) AS cve_id, l_returnflag AS source,
 CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 501 = 0 THEN CAST(11 AS DOUBLE) ELSE l_quantity / 5 END AS cvss_score,
 CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount * 10 END AS epss_score,
 CASE WHEN l_quantity >= 45 THEN 'Critical' WHEN l_quantity >= 30 THEN 'HIGH' WHEN l_quantity >= 15 THEN 'medium '
      WHEN l_quantity >= 5 THEN 'low' WHEN l_quantity >= 3 THEN 'NONE' END AS severity,
 CASE WHEN l_linestatus = 'O' THEN 'external' ELSE 'internal' END AS scope,
 CASE WHEN l_linenumber = 5 THEN NULL ELSE l_linenumber - 1 END AS exploit_count,
 CASE WHEN l_tax >= 0.07 THEN l_shipdate END AS date_added, l_shipdate AS published, l_shipdate AS last_seen,
 l_extendedprice / 10000 AS asset_exposure_score, l_orderkey AS tie_a, l_linenumber AS tie_b, l_extendedprice AS tie_c
FROM lineitem
"""

FINDING = """
SELECT concat('ASSET-', CAST(user_id AS STRING)) AS asset_id,
 CASE event_type WHEN 'view' THEN 'nmap' WHEN 'signup' THEN 'subfinder' WHEN 'click' THEN 'httpx' ELSE 'nuclei' END AS source_tool,
 CASE event_type WHEN 'purchase' THEN 'critical' WHEN 'error' THEN 'High' WHEN 'click' THEN 'info' WHEN 'signup' THEN NULL ELSE 'low' END AS severity,
 CASE WHEN event_type = 'view' THEN regexp_extract(props, '[0-9]+', 0) WHEN event_type = 'click' THEN 'n/a' END AS port,
 CASE WHEN event_type = 'signup' THEN concat('h', regexp_extract(props, '[0-9]+', 0)) END AS subdomain, event_id
FROM events
"""

ASSET = """
SELECT CASE WHEN c_custkey % 41 = 0 THEN concat('HOST-', CAST(c_custkey AS STRING)) ELSE concat('ASSET-', CAST(c_custkey AS STRING)) END AS asset_id,
 CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 43 = 0 THEN '10.0.0.300'
      ELSE concat('10.', CAST(c_nationkey AS STRING), '.', CAST(c_custkey % 256 AS STRING), '.', CAST(1 + c_custkey % 254 AS STRING)) END AS host,
 CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat(lower(c_mktsegment), CAST(c_custkey AS STRING), '.Example.com') END AS domain,
 CASE c_custkey % 8 WHEN 0 THEN '[22, 80]' WHEN 1 THEN '[443, 3389]' WHEN 2 THEN '[3306, 3306]' WHEN 3 THEN '[]' WHEN 4 THEN '[25, 53]'
      WHEN 5 THEN '[70000]' WHEN 6 THEN NULL ELSE '[21,22,23,25,53,80,110,135,139,443,445]' END AS ports,
 CASE c_custkey % 8 WHEN 0 THEN '[{"port":22,"service":"SSH","version":"8"}]' WHEN 1 THEN '[{"port":443,"service":"https","version":""}]'
      WHEN 4 THEN '[{"port":25,"service":"smtp","version":""}]' ELSE '[]' END AS services,
 CASE WHEN c_custkey % 19 = 0 THEN '["Firewall"]' ELSE '["tls"]' END AS tags,
 CASE WHEN c_custkey % 3 = 0 THEN '["crtsh"]' ELSE '["nmap","crtsh"]' END AS discovered_by,
 CASE WHEN c_acctbal > 5000 THEN 'yes' ELSE 'no' END AS internet_exposed,
 CASE WHEN c_custkey % 47 = 0 THEN 'not a date' ELSE '2024-01-01T00:00:00+00:00' END AS last_seen
FROM customer
"""


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    use_utc(spark).read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(f"check_{table}")
    return spark.sql(sql.replace(f"FROM {table}", f"FROM check_{table}"))


def threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", THREAT)


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", FINDING)


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", ASSET)
