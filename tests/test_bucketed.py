"""Per-asset tables saved bucketed by asset join without an exchange."""

from riskspark.operators import merge
from riskspark.sources import tables


def test_merge_of_bucketed_tables_has_no_exchange(spark):
    spark.sql("SET spark.sql.autoBroadcastJoinThreshold=-1")
    try:
        a = tables.save_bucketed(spark.range(200).selectExpr("concat('A', id) AS asset_id", "id AS v"), "bucketed_a", buckets=8)
        b = tables.save_bucketed(spark.range(150).selectExpr("concat('A', id) AS asset_id", "id * 2 AS w"), "bucketed_b", buckets=8)
        c = tables.save_bucketed(spark.range(100).selectExpr("concat('A', id) AS asset_id", "id * 3 AS u"), "bucketed_c", buckets=8)
        merged = merge.merge_on_asset_id([a, b, c], check=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert merged.count() == 200 and merged.where("u IS NOT NULL").count() == 100
    finally:
        spark.sql("SET spark.sql.autoBroadcastJoinThreshold=10485760")
        for name in ("bucketed_a", "bucketed_b", "bucketed_c"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
