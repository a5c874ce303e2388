import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabreg.operators import profile, relate


def test_nzv_ratio_boundary_and_ties(spark):
    # a: 95 x 'p' / 5 x 'q' -> ratio 19 (not > 19): not nzv ; b: tie -> ratio 1 ; c: constant
    rows = [("p" if i < 95 else "q", "x" if i % 2 else "y", "k") for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    nz = {r["variable"]: r for r in profile.near_zero_variance(df, ["a", "b", "c"], 95 / 5, 10).collect()}
    assert nz["a"]["freq_ratio"] == pytest.approx(19.0) and not nz["a"]["nzv"]
    assert nz["b"]["freq_ratio"] == pytest.approx(1.0)
    assert nz["c"]["zero_var"] and nz["c"]["nzv"]
    nz2 = {r["variable"]: r for r in profile.near_zero_variance(df, ["a"], 18.9, 10).collect()}
    assert nz2["a"]["nzv"]


def test_skewness_type3(spark):
    x = np.array([1.0, 2.0, 10.0, 3.0, 7.5, 0.5])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = profile.skewness(df, ["x"]).collect()[0]["skew"]
    m3 = np.mean((x - x.mean()) ** 3)
    assert got == pytest.approx(m3 / x.std(ddof=1) ** 3)


def test_box_stats_and_histogram(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=500), [8.0, -9.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    b = profile.box_stats(df, "x").collect()[0]
    q1, q3 = np.quantile(x, [0.25, 0.75])
    assert b["q1"] == pytest.approx(q1) and b["q3"] == pytest.approx(q3)
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert b["lower_whisker"] == pytest.approx(inside.min()) and b["upper_whisker"] == pytest.approx(inside.max())
    h = profile.histogram(df, ["x"], bins=30).collect()
    assert sum(r["n"] for r in h) == len(x) and max(r["bin"] for r in h) == 29


def _planted_groups(spark, means=(0, 0, 1, 1, 5), n=40, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"g{i}", float(m + rng.normal(scale=0.3))) for i, m in enumerate(means) for _ in range(n)]
    return spark.createDataFrame(rows, "grp string, y double")


def test_anova_matches_numpy(spark):
    df = _planted_groups(spark)
    a = relate.anova_oneway(df, "y", ["grp"], with_p=True).collect()[0]
    pdf = df.toPandas()
    grand = pdf.y.mean()
    ssb = sum(len(g) * (g.y.mean() - grand) ** 2 for _, g in pdf.groupby("grp"))
    ssw = sum(((g.y - g.y.mean()) ** 2).sum() for _, g in pdf.groupby("grp"))
    assert a["ss_between"] == pytest.approx(ssb) and a["ss_within"] == pytest.approx(ssw)
    assert a["f"] == pytest.approx((ssb / 4) / (ssw / (len(pdf) - 5)))
    assert a["p"] < 1e-10


def test_hsd_letters_planted(spark):
    g = relate.hsd_groups(_planted_groups(spark), "y", ["grp"]).collect()
    lab = {r["level"]: r["groups"] for r in g}
    assert lab["g4"] == "a"
    assert lab["g2"] == lab["g3"] == "b"
    assert lab["g0"] == lab["g1"] == "c"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=2, max_size=9))
def test_letters_consistent_with_pairwise_differences(spark, means):
    """Two levels share a letter exactly when their means differ by at most HSD."""
    rows = [(f"L{i}", float(m) + d) for i, m in enumerate(means) for d in (-1.0, 1.0)]
    df = spark.createDataFrame(rows, "grp string, y double")
    q = 3.0
    out = relate.hsd_groups(df, "y", ["grp"], q=q).collect()
    hsd = out[0]["hsd"]
    for a in out:
        for b in out:
            share = bool(set(a["groups"]) & set(b["groups"]))
            assert share == (abs(a["mean"] - b["mean"]) <= hsd + 1e-9), (means, a, b)


def test_corr_matrix_symmetric(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    x[:, 2] = x[:, 0] * 2 + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    c = {(r["var_x"], r["var_y"]): r["r"] for r in relate.corr_matrix(df, ["a", "b", "c"]).collect()}
    ref = np.corrcoef(x.T)
    assert c[("a", "c")] == pytest.approx(ref[0, 2]) and c[("c", "a")] == c[("a", "c")]
    assert c[("b", "b")] == 1.0


def test_skim_reads_what_lies_behind_its_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    df = spark.range(0, 400, 1, 4).select(F.col("id").cast("double").alias("a"))
    df = df.select(seen("a").alias("a"), F.when(F.col("a") % 4 != 0, F.col("a")).alias("b"))
    got = {r["variable"]: r for r in profile.skim_numeric(df, ["a", "b"]).collect()}
    assert read.value == 400
    assert (got["a"]["n_missing"], got["b"]["n_missing"]) == (0, 100)
    assert [got["a"][c] for c in ("p0", "p25", "p50", "p75", "p100")] == pytest.approx([0, 99.75, 199.5, 299.25, 399])
