"""Levels as tables, HSD intervals, confidence bands, coefficient statistics, normal quantiles."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.functions import stats
from tabreg.operators import evaluate, features, matrix, models, relate


def test_quantile_functions():
    nd = NormalDist()
    p = np.concatenate([np.logspace(-15, -1, 60), np.linspace(0.01, 0.99, 50), 1 - np.logspace(-12, -2, 20)])
    assert stats.norm_ppf_array(p) == pytest.approx([nd.inv_cdf(float(x)) for x in p], rel=1e-9, abs=1e-12)
    assert np.isnan(stats.norm_ppf_array([0.0, 1.0, -1.0])).all()
    # printed tables
    assert stats.t_ppf(0.975, 5) == pytest.approx(2.570582, abs=1e-6)
    assert stats.t_ppf(0.05, 12) == pytest.approx(-1.782288, abs=1e-6)
    assert stats.qtukey(0.95, 3, 10) == pytest.approx(3.877, abs=1e-3)
    assert stats.qtukey(0.95, 10, 120) == pytest.approx(4.560, abs=2e-3)
    for p, k, df in ((0.9, 2, 4.0), (0.99, 30, 1e5)):
        assert stats.ptukey(stats.qtukey(p, k, df), k, df) == pytest.approx(p, abs=1e-9)


def test_levels_stay_a_table(spark):
    n = 30_000                                                   # every level once: all tie at the cut
    df = spark.range(n).select(F.concat(F.lit("v"), F.col("id")).alias("c"), F.when(F.col("id") % 2 == 0, "x").alias("d"))
    m = features.LevelLumper(["c", "d"], n=1).fit(df)
    assert m.kept.where("variable = 'c'").count() == n
    assert m.transform(df).where("c = 'Other' or d = 'Other'").count() == 0
    assert m.transform(df).where("d is null").count() == n // 2 and m.transform(df).columns == ["c", "d"]
    assert m.levels(limit=10 ** 6)["d"] == ["x"]
    with pytest.raises(ValueError):
        m.levels(limit=10)
    ix = features.LevelIndexer(["c"]).fit(df)
    out = ix.transform(spark.createDataFrame([("v0",), ("v9999",), ("new",), (None,)], "c string")).collect()
    order = sorted(f"v{i}" for i in range(n))
    assert {r["c"]: r["c_index"] for r in out} == {"v0": 0, "v9999": order.index("v9999"), "new": None, None: None}
    with pytest.raises(ValueError, match="LevelIndexer"):
        features.ContrastEncoder(nominal=["c"]).fit(df)


def test_intervals_hold_the_verdicts_of_all_pairs(spark):
    rng = np.random.default_rng(13)
    rows = [(f"l{int(g)}", None if g == 7 else "only", float(rng.normal(g / 4, 1))) for g in rng.integers(0, 25, 2500)]
    df = spark.createDataFrame(rows, "f string, one string, y double")
    iv = relate.hsd_intervals(df, "y", ["f", "one"], q=3.0).collect()
    assert len(iv) == 26
    at = {(r["variable"], r["level"]): r for r in iv}
    for p in relate.hsd_pairs(df, "y", ["f", "one"], q=3.0).collect():
        a, b = at[p["variable"], p["level_a"]], at[p["variable"], p["level_b"]]
        assert a["position"] < b["position"]
        assert p["significant"] == (a["first_below"] is not None and b["position"] >= a["first_below"]) == (a["position"] <= b["n_above"])
    k = sum(r["variable"] == "f" for r in iv)
    assert all(r["n_below"] == (k - r["first_below"] + 1 if r["first_below"] else 0) for r in iv if r["variable"] == "f")


def test_band_covers_the_line_like_the_formula(spark):
    rng = np.random.default_rng(14)
    x = rng.uniform(0, 5, 30)
    y = 2 * x + rng.normal(size=30)
    rows = [(float(a), float(b), 1.0) for a, b in zip(x, y)] + [(None, 9.0, 1.0), (99.0, None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double, flat double")
    band = {r["x"]: r for r in relate.fit_band(df, "y", ["x"], points=5).collect()}
    b1, b0 = np.polyfit(x, y, 1)
    s = np.sqrt(((y - b0 - b1 * x) ** 2).sum() / 28)
    for at in np.linspace(x.min(), x.max(), 5):
        r = band[min(band, key=lambda v: abs(v - at))]
        half = 2.048407 * s * np.sqrt(1 / 30 + (at - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
        assert (r["fit"], r["lower"], r["upper"]) == pytest.approx((b0 + b1 * at, b0 + b1 * at - half, b0 + b1 * at + half), abs=1e-5)
    flat = relate.fit_band(df, "y", ["flat"], points=2).collect()
    assert all(r["lower"] is None for r in flat)


def test_coefficient_statistics_equal_the_library_table(spark):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(400, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    y = x @ [1.0, 0.02, 40] + rng.normal(size=400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([x, y])], "a double, b double, c double, y double")
    g = matrix.gram(df, ["a", "b", "c"], "y")[()]
    want = {r["variable"]: r for r in models.ols_table(df, ["a", "b", "c"], "y").collect()}
    for v, est, se, t, p in models.coefficient_stats(g, ["a", "b", "c"], "y"):
        r = want[v]
        assert (est, se, t) == pytest.approx((r["estimate"], r["std_error"], r["t"]), rel=1e-6)
        assert p == pytest.approx(r["p"], abs=1e-9)
    rows = [("m", *r) for r in models.coefficient_stats(g, ["a", "b", "c"], "y")] + [("m", "tiny", 0.001, 1.0, 9.0, 0.0), ("m", "weak", 5.0, 9.0, 0.5, 0.6)]
    table = spark.createDataFrame(rows, "model string, variable string, estimate double, std_error double, t double, p double")
    assert {r["variable"] for r in models.top_significant(table, 2).collect()} == {"a", "c"}
    imp = dict(models.linear_importance(g, ["a", "b", "c"], "y", models.LinearSpec("enet", lam=0.3, alpha=1.0)))
    assert imp["a"] > imp["c"] > 0
    step = dict(models.linear_importance(g, ["a", "b", "c"], "y", models.LinearSpec("step")))
    assert step["a"] == pytest.approx(abs(want["a"]["t"]), rel=0.05)


def test_heavy_value_is_spread_in_the_normality_rank(spark):
    rows = [(i, 1.0 if i < 900 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "key long, v double")
    a = evaluate.anderson_darling(df, "v", key="key").first()
    b = evaluate.anderson_darling(df.drop("key"), "v").first()
    assert a["a2"] == pytest.approx(b["a2"]) and a["n"] == 1000
