import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabreg.operators import evaluate as EV
from tabreg.operators import split


def _table(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(rng.lognormal(12, 0.4, n))],
                                 "key long, y double")


def test_split_sizes_and_union(spark):
    df = _table(spark, 1450)
    a = split.stratified_split(df, "key", "y", p=0.8, seed=12345)
    bins = a.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect()
    for r in bins:
        assert r["t"] == math.ceil(0.8 * r["n"])
    tr = split.keep_rows(df, a, "key", F.col("split") == "train")
    ho = split.drop_rows(df, a, "key", F.col("split") == "train")
    assert tr.count() + ho.count() == 1450
    assert tr.join(ho, "key").count() == 0
    # 4 quartile bins of (almost) equal size
    assert sorted(r["n"] for r in bins)[0] >= 362


def test_split_reproducible_across_partitioning(spark):
    df = _table(spark, 600, seed=2)
    a = {r["key"]: r["split"] for r in split.stratified_split(df, "key", "y").collect()}
    b = {r["key"]: r["split"] for r in split.stratified_split(df.repartition(5), "key", "y").collect()}
    assert a == b


@settings(max_examples=8, deadline=None)
@given(st.integers(30, 400), st.integers(2, 10))
def test_folds_disjoint_complete_balanced(spark, n, k):
    df = _table(spark, n, seed=n)
    f = split.stratified_folds(df, "key", "y", k=k).collect()
    assert sorted(r["key"] for r in f) == list(range(n))
    by_bin = {}
    for r in f:
        by_bin.setdefault(r["bin"], []).append(r["fold"])
    for folds in by_bin.values():
        counts = np.bincount(folds, minlength=k + 1)[1:]
        assert counts.max() - counts.min() <= 1


def test_metrics_and_residuals(spark):
    rows = [("m", i, float(i % 7), float(i % 7) + (0.5 if i % 3 == 0 else -0.25)) for i in range(300)]
    df = spark.createDataFrame(rows, "model string, key long, obs double, pred double")
    m = EV.regression_metrics(df, by=["model"]).collect()[0]
    e = np.array([r[3] - r[2] for r in rows])
    assert m["rmse"] == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert m["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert m["rsquared"] == pytest.approx(np.corrcoef([r[3] for r in rows], [r[2] for r in rows])[0, 1] ** 2)
    rt = EV.residual_table(df, label_from="key", by=["model"])
    sd = rt.agg(F.stddev_samp("stdres")).first()[0]
    assert sd == pytest.approx(1.0)


def test_anderson_darling_matches_numpy(spark):
    from tabreg.functions.stats import norm_cdf
    rng = np.random.default_rng(7)
    x = rng.standard_t(5, size=400)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = EV.anderson_darling(df, "x").collect()[0]
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    n = len(z)
    i = np.arange(1, n + 1)
    p = norm_cdf(z)
    a2 = -n - np.mean((2 * i - 1) * (np.log(p) + np.log(1 - p[::-1])))
    assert got["a2"] == pytest.approx(a2, rel=1e-6)
    assert 0 <= got["p_value"] <= 1


def test_qq_pairs(spark):
    df = spark.createDataFrame([(float(v), int(k)) for k, v in enumerate([3.0, 1.0, 2.0, 5.0])], "v double, k long")
    q = sorted(EV.qq_pairs(df, "v", key="k").collect(), key=lambda r: r["i"])
    assert [r["v"] for r in q] == [1.0, 2.0, 3.0, 5.0]
    from statistics import NormalDist
    assert q[0]["theoretical"] == pytest.approx(NormalDist().inv_cdf((1 - 3 / 8) / (4 + 1 - 3 / 4)))


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(f"v{i}", float(e)) for i, e in enumerate([5, 4, 4, 3, 1, -6])], "variable string, estimate double")
    got = sorted(r["variable"] for r in EV.top_n_by(df, "estimate", 2).collect())
    assert got == ["v0", "v1", "v2"]


def test_sketch_options_run(spark):
    from tabreg.operators import profile
    df = _table(spark, 800, seed=9)
    sk = profile.skim_numeric(df, ["y"], method="approx").first()
    assert sk["p0"] <= sk["p50"] <= sk["p100"]
    a = split.stratified_split(df, "key", "y", method="approx")
    assert a.count() == 800 and a.where("split = 'train'").count() >= 0.79 * 800
