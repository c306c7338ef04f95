import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.functions import ordering as O
from riskspark.operators.profile import correlations

SMALL = [0, O.SMALL_DISTINCT]  # 0 forces the range-partitioned path


def sample(seed=1, n=700):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 40, n).astype(float)
    b = rng.lognormal(size=n)
    a[rng.random(n) < 0.3] = 7.0  # one hot value
    a[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({"id": range(n), "a": a, "b": b, "c": 3.0})


def frame(spark, pdf):
    return spark.createDataFrame(pdf).replace(float("nan"), None)


@pytest.mark.parametrize("small", SMALL)
def test_quantiles_match_linear_interpolation(spark, small):
    pdf = sample()
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = O.quantiles(frame(spark, pdf), {c: ps for c in "abc"}, small=small, direct_bytes=1 << 80)
    for c in "abc":
        for p in ps:
            assert got[c][p] == pytest.approx(pdf[c].quantile(p), abs=1e-12)


@pytest.mark.parametrize("small", SMALL)
def test_quantiles_of_large_tables_are_bracketed_and_exact(spark, small):
    pdf = sample(4, 3000)
    ps = [0.0, 0.01, 0.05, 0.25, 0.5, 0.95, 0.99, 1.0]
    df = frame(spark, pdf).withColumn("none", F.lit(None).cast("double"))
    got = O.quantiles(df, {c: ps for c in ["a", "b", "c", "none"]}, small=small, direct_bytes=0)
    for c in "abc":
        assert [got[c][p] for p in ps] == pytest.approx([pdf[c].quantile(p) for p in ps], abs=1e-12)
    assert set(got["none"].values()) == {None}


def test_missed_brackets_take_the_direct_way(spark):
    pdf = sample(6, 2000)
    df = frame(spark, pdf)
    rough = O._narrowed_quantiles(df, {"b": [0.5], "c": [0.5]}, O.SMALL_DISTINCT, accuracy=2)
    assert rough.get("c") == {0.5: 3.0}
    assert O.quantiles(df, {"b": [0.5]}, direct_bytes=0)["b"][0.5] == pytest.approx(pdf["b"].median())


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert O.quantiles(df, {"a": [0.5]}) == {"a": {0.5: None}}
    assert O.medians(df, []) == {}


@pytest.mark.parametrize("small", SMALL)
def test_percent_rank_shares_ties(spark, small):
    pdf = sample(2)
    got = O.average_percent_rank(frame(spark, pdf), "a", "r", small=small).toPandas().sort_values("id")
    np.testing.assert_allclose(got["r"].astype(float), pdf["a"].rank(pct=True), rtol=1e-12)


def test_percent_rank_is_the_same_after_repartition(spark):
    df = frame(spark, sample(3))
    a = O.average_percent_rank(df, "a", "r").orderBy("id").toPandas()
    b = O.average_percent_rank(df.repartition(7, "b"), "a", "r").orderBy("id").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_percent_rank_edge_tables(spark):
    same = spark.createDataFrame([(1.0,)] * 4, "a double")
    assert {r["r"] for r in O.average_percent_rank(same, "a", "r").collect()} == {0.625}
    none = spark.createDataFrame([(None,)], "a double")
    assert O.average_percent_rank(none, "a", "r").first()["r"] is None


def test_correlations_use_pairwise_known_rows(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(1e6, 1.0, (300, 3)), columns=list("xyz"))
    pdf["y"] += pdf["x"]
    pdf["k"] = 0.1
    pdf.loc[rng.random(300) < 0.2, "x"] = np.nan
    expected = pdf.corr()
    got = {(r[0], r[1]): r[2] for r in correlations(frame(spark, pdf).repartition(5), list("xyzk")).collect()}
    for a in "xyz":
        for b in "xyz":
            assert got[a, b] == pytest.approx(expected.loc[a, b], abs=1e-9)
        assert got[a, "k"] is None
