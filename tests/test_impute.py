import math

import numpy as np
import pytest

from riskspark.operators import impute
from tests.helpers import by, rows

SCHEMA = "id int, cvss_score double, epss_score double"


def brute_force(donors, key, k=5):
    """Mean of the k nearest; a group that overflows the last place contributes its mean, lower keys first."""
    groups = {}
    for x, y in donors:
        groups.setdefault(x, []).append(y)
    total, left = 0.0, k
    for x in sorted(groups, key=lambda g: (abs(g - key), g)):
        take = min(left, len(groups[x]))
        total += take * sum(groups[x]) / len(groups[x])
        left -= take
        if not left:
            break
    return total / (k - left) if k > left else None


@pytest.mark.parametrize("small,broadcast", [(200_000, 500_000), (0, 0)])
def test_neighbours_match_brute_force(spark, small, broadcast):
    rng = np.random.default_rng(8)
    data = []
    for i in range(500):
        c, e = float(rng.integers(0, 60)) / 10, float(rng.integers(0, 90)) / 100
        if i % 11 == 0:
            c = float(rng.normal(3, 4))
        lost = rng.random()
        data.append((i, None if lost < 0.25 else c, None if lost > 0.7 else e))
    data += [(1000, None, -50.0), (1001, None, 50.0), (1002, None, None), (1003, -9.0, None)]
    df = spark.createDataFrame(data, SCHEMA)
    model = impute.fit_neighbours(df, small=small)
    model.broadcast_rows = broadcast
    got = by(model.transform(df), "id")
    assert len(got) == len(data)
    both = [(e, c) for _, c, e in data if c is not None and e is not None]
    mean_c = np.mean([c for _, c, _ in data if c is not None])
    mean_e = np.mean([e for _, _, e in data if e is not None])
    for i, c, e in data:
        want_c = c if c is not None else mean_c if e is None else brute_force(both, e)
        want_e = e if e is not None else mean_e if c is None else brute_force([(c2, e2) for e2, c2 in both], c)
        assert math.isclose(got[i]["cvss_score"], want_c, rel_tol=1e-9), i
        assert math.isclose(got[i]["epss_score"], want_e, rel_tol=1e-9), i


def test_few_donors_and_ties(spark):
    df = spark.createDataFrame([(1, 2.0, 0.1), (2, 4.0, 0.3), (3, None, 0.2), (4, None, None)], SCHEMA)
    got = by(impute.fit_neighbours(df).transform(df), "id")
    assert got[3]["cvss_score"] == 3.0 and got[4]["cvss_score"] == 3.0 and got[4]["epss_score"] == pytest.approx(0.2)
    # Equal distance at the last place: the lower key comes first.
    near = impute.fit_neighbours(df, k=1).transform(df)
    assert by(near, "id")[3]["cvss_score"] in (2.0, 4.0)
    exact = spark.createDataFrame([(1, 2.0, 1.0), (2, 4.0, 3.0), (3, None, 2.0)], SCHEMA)
    assert by(impute.fit_neighbours(exact, k=1).transform(exact), "id")[3]["cvss_score"] == 2.0


def test_fit_and_transform_are_separate(spark):
    train = spark.createDataFrame([(1, 2.0, 0.1), (2, 4.0, 0.3)], SCHEMA)
    other = spark.createDataFrame([(9, None, 0.9)], SCHEMA)
    assert by(impute.fit_neighbours(train, k=1).transform(other), "id")[9]["cvss_score"] == 4.0


def test_column_without_any_value_stays_null(spark):
    df = spark.createDataFrame([(1, None, 0.1), (2, None, None)], SCHEMA)
    got = by(impute.fit_neighbours(df).transform(df), "id")
    assert got[1]["cvss_score"] is None and got[2]["epss_score"] == 0.1


def test_medians_defaults_and_report(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3, "high"), (4, 4, None)], "exploit_count int, affected_systems_count int, severity string")
    filled = impute.fit_medians(df).transform(df)
    assert [r["affected_systems_count"] for r in rows(filled)] == [3.5, 3.0, 4.0]
    assert [r["severity"] for r in rows(impute.domain_defaults(df))] == ["low", "high", "low"]
    assert [r["affected_systems_count"] for r in rows(impute.domain_defaults(df))] == [1, 3, 4]
    report = {r["column"]: r["nulls"] for r in rows(impute.null_report(df))}
    assert report == {"affected_systems_count": 1, "severity": 2}


def test_whole_imputer(spark):
    df = spark.createDataFrame([(2.0, 0.1, 1, None), (None, 0.1, None, "high")], "cvss_score double, epss_score double, exploit_count int, severity string")
    got = rows(impute.fit_imputer(df).transform(df))
    assert [(r["cvss_score"], r["exploit_count"], r["severity"]) for r in got] == [(2.0, 1.0, "low"), (2.0, 1.0, "high")]
