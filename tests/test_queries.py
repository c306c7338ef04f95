"""Every query with SQL against that SQL on the smallest tables; plans of the main jobs."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from tests.helpers import plan_text

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert differences(queries()[name](spark, FOLDER).toPandas(), duck.execute(SQL[name]).df()) == ""


def test_names_and_entry(spark):
    assert set(SQL) <= set(queries())
    assert entry(spark).columns == ["asset_id", "vuln_count", "expected_annual_loss_usd"]


@pytest.mark.parametrize("name", ["threat_validate", "threat_dedup", "threat_features", "pentest_job", "asset_enrich", "loss_job", "asset_rejected"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plan_text(queries()[name](spark, FOLDER))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(queries()["pentest_features"](spark, FOLDER))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in plan
