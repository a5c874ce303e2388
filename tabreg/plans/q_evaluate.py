"""Catalogue: metrics, fold summaries, comparisons, residual tables (A16-A19 W1 W6 J5 U2
ML11 ML14 F8 F9 E13 O2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import evaluate as EV
from tabreg.operators import split
from tabreg.plans.common import r6
from tabreg.plans.q_split import _BINS_SQL, SEED
from tabreg.plans.registry import register
from tabreg.session import cut_lineage
from tabreg.sources.tables import table

MODELS = ["status_mean", "priority_mean"]


def oof_predictions(spark, sf_dir):
    """Stand-in out-of-fold table ``(model, key, fold, obs, pred)``: two group-mean
    predictors of the log order price, folds from the stratified fold operator."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    o = o.withColumn("obs", F.log("o_totalprice"))
    folds = split.stratified_folds(o, "o_orderkey", "o_totalprice", k=10, seed=SEED).select("o_orderkey", "fold")
    o = cut_lineage(o.join(folds, "o_orderkey"))     # one fold assignment, read by both models
    outs = []
    for model, g in (("status_mean", "o_orderstatus"), ("priority_mean", "o_orderpriority")):
        means = o.groupBy(g).agg(F.avg("obs").alias("pred"))
        outs.append(o.join(means, g).select(F.lit(model).alias("model"), F.col("o_orderkey").alias("key"),
                                            "fold", "obs", "pred"))
    return outs[0].unionByName(outs[1])


_OOF_SQL = f"""
WITH {_BINS_SQL},
f AS (SELECT o_orderkey, CAST((pos - 1) % 10 + 1 AS INTEGER) AS fold FROM rk),
b AS (SELECT o.o_orderkey, ln(o.o_totalprice) AS obs, o.o_orderstatus, o.o_orderpriority, f.fold
      FROM orders o JOIN f ON o.o_orderkey = f.o_orderkey),
oof AS (
  SELECT 'status_mean' AS model, o_orderkey AS key, fold, obs, avg(obs) OVER (PARTITION BY o_orderstatus) AS pred FROM b
  UNION ALL
  SELECT 'priority_mean', o_orderkey, fold, obs, avg(obs) OVER (PARTITION BY o_orderpriority) FROM b
),
fm AS (SELECT model, fold, count(*) AS n, sqrt(avg((pred - obs) * (pred - obs))) AS rmse,
              power(corr(pred, obs), 2) AS rsquared, avg(abs(pred - obs)) AS mae FROM oof GROUP BY model, fold)"""


@register("regression_metrics", "A17", sql=_OOF_SQL + """
SELECT model, count(*) AS n, round(sqrt(avg((pred - obs) * (pred - obs))), 6) AS rmse,
       round(power(corr(pred, obs), 2), 6) AS rsquared, round(avg(abs(pred - obs)), 6) AS mae
FROM oof GROUP BY model
""")
def regression_metrics(spark, sf_dir):
    m = EV.regression_metrics(oof_predictions(spark, sf_dir), by=["model"])
    return m.select("model", "n", r6("rmse"), r6("rsquared"), r6("mae"))


@register("fold_summary", "A18 A16", sql=_OOF_SQL + """,
sd AS (SELECT model, stddev_samp(pred - obs) AS res_sd FROM oof GROUP BY model)
SELECT fm.model, round(avg(rmse), 6) AS mean_rmse, round(stddev_samp(rmse), 6) AS sd_rmse, count(*) AS n_folds,
       round(min(sd.res_sd), 6) AS res_sd
FROM fm JOIN sd ON fm.model = sd.model GROUP BY fm.model
""")
def fold_summary(spark, sf_dir):
    oof = oof_predictions(spark, sf_dir)
    fm = EV.regression_metrics(oof, by=["model", "fold"])
    s = EV.fold_summary(fm, ["model"]).join(EV.residual_sd(oof, by=["model"]), "model")
    return s.select("model", r6("mean_rmse"), r6("sd_rmse"), "n_folds", r6("res_sd"))


@register("model_summary", "A19", sql=_OOF_SQL + """
SELECT model, round(min(rmse), 6) AS min, round(quantile_cont(rmse, 0.25), 6) AS q1,
       round(quantile_cont(rmse, 0.5), 6) AS median, round(avg(rmse), 6) AS mean,
       round(quantile_cont(rmse, 0.75), 6) AS q3, round(max(rmse), 6) AS max
FROM fm GROUP BY model
""")
def model_summary(spark, sf_dir):
    fm = EV.regression_metrics(oof_predictions(spark, sf_dir), by=["model", "fold"])
    s = EV.model_summary(fm, "rmse")
    return s.select("model", *[r6(c) for c in ["min", "q1", "median", "mean", "q3", "max"]])


@register("metric_stack", "J5 U2 O1", sql=_OOF_SQL + """
SELECT fold, round(max(CASE WHEN model = 'status_mean' THEN rmse END), 6) AS status_mean,
       round(max(CASE WHEN model = 'priority_mean' THEN rmse END), 6) AS priority_mean,
       round(max(CASE WHEN model = 'status_mean' THEN rmse END)
             - max(CASE WHEN model = 'priority_mean' THEN rmse END), 6) AS diff
FROM fm GROUP BY fold
""")
def metric_stack(spark, sf_dir):
    oof = oof_predictions(spark, sf_dir)
    per_model = [EV.regression_metrics(oof.where(F.col("model") == m), by=["model", "fold"]) for m in MODELS]
    fm = EV.stack(per_model)                                          # U2
    al = EV.align_folds(fm, MODELS)                                   # J5
    return al.select("fold", r6("status_mean"), r6("priority_mean"),
                     r6(F.col("status_mean") - F.col("priority_mean"), "diff"))


@register("residual_table", "ML14 W6 F9 E13 A16", sql=_OOF_SQL + """,
r AS (SELECT oof.*, pred - obs AS res, (pred - obs) / stddev_samp(pred - obs) OVER (PARTITION BY model) AS stdres
      FROM oof)
SELECT model, count(*) AS n,
       count(CASE WHEN abs(obs - pred) > 0.5 THEN 1 END) AS n_obs_label,
       count(CASE WHEN abs(stdres) > 2 THEN 1 END) AS n_std_label,
       CAST(sum(CASE WHEN abs(stdres) > 2 THEN key ELSE 0 END) AS BIGINT) AS key_sum_std,
       round(sum(stdres * stdres), 4) AS sum_sq_std
FROM r GROUP BY model
""")
def residual_table(spark, sf_dir):
    rt = EV.residual_table(oof_predictions(spark, sf_dir), label_from="key", by=["model"])
    return rt.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("obs_label") != "").alias("n_obs_label"),
        F.count_if(F.col("std_label") != "").alias("n_std_label"),
        F.sum(F.when(F.col("std_label") != "", F.col("key")).otherwise(0)).cast("long").alias("key_sum_std"),
        F.round(F.sum(F.col("stdres") * F.col("stdres")), 4).alias("sum_sq_std"))


_COEF_SQL = """
WITH c AS (SELECT p_brand AS variable, round(avg(p_retailprice) / 100 - 14, 1) AS estimate,
                  count(*) AS n FROM part GROUP BY p_brand)"""


@register("top_coefficients", "W1 F8 O1 T14 T28", sql=_COEF_SQL + """
SELECT variable, estimate, n FROM (
  SELECT *, rank() OVER (ORDER BY estimate DESC) AS rk FROM c WHERE abs(estimate) > 0.01
) t WHERE rk <= 10
""")
def top_coefficients(spark, sf_dir):
    """A coefficient-shaped table from the data (one estimate per brand, rounded so that
    ties occur), screened by |estimate|, top 10 signed values with ties."""
    p = table(spark, sf_dir, "part")
    c = p.groupBy(F.col("p_brand").alias("variable")).agg(
        F.round(F.avg("p_retailprice") / 100 - 14, 1).alias("estimate"), F.count(F.lit(1)).alias("n"))
    c = c.where(F.abs("estimate") > 0.01)
    return EV.top_n_by(c, "estimate", 10).select("variable", "estimate", "n")


@register("scaled_importance", "ML11", sql="""
WITH i AS (SELECT p_type, p_brand, abs(avg(p_retailprice) - 1500) AS importance FROM part GROUP BY ALL),
g AS (SELECT p_type, min(importance) AS lo, max(importance) AS hi FROM i GROUP BY p_type)
SELECT i.p_type, p_brand, round((importance - lo) * 100.0 / (hi - lo), 6) AS scaled
FROM i JOIN g ON i.p_type = g.p_type
""")
def scaled_importance(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    imp = p.groupBy("p_type", "p_brand").agg(F.abs(F.avg("p_retailprice") - 1500).alias("importance"))
    s = EV.scaled_importance(imp, "importance", by=["p_type"])
    return s.select("p_type", "p_brand", r6("scaled"))


# Upper normal tail in double precision (a published rational approximation with a continued fraction
# beyond 7.07) and normal quantiles (a published rational approximation, relative error 1e-9).
# Fixed values of the two approximations, highest power first.
_TAIL_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
             220.206867912376)
_TAIL_LOW = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
             793.826512519948, 440.413735824752)
_PPF_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01,
          2.506628277459239e+00)
_PPF_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00,
          2.938163982698783e+00)
_PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)


def _horner(coefs, x):
    out = f"({coefs[0]!r})"
    for c in coefs[1:]:
        out = f"({out} * {x} + ({c!r}))"
    return out


_TAIL_SQL = (f"CASE WHEN y < 7.07106781186547 THEN exp(-y * y / 2) * {_horner(_TAIL_TOP, 'y')} / {_horner(_TAIL_LOW, 'y')} "
             "ELSE exp(-y * y / 2) / (y + 1 / (y + 2 / (y + 3 / (y + 4 / (y + 0.65))))) / 2.506628274631 END")
_PPF_SQL = (f"CASE WHEN p < 0.02425 THEN {_horner(_PPF_C, 'sqrt(-2 * ln(p))')} / {_horner(_PPF_D, 'sqrt(-2 * ln(p))')} "
            f"WHEN p > 0.97575 THEN -{_horner(_PPF_C, 'sqrt(-2 * ln(1 - p))')} / {_horner(_PPF_D, 'sqrt(-2 * ln(1 - p))')} "
            f"ELSE (p - 0.5) * {_horner(_PPF_A, 'pow(p - 0.5, 2)')} / {_horner(_PPF_B, 'pow(p - 0.5, 2)')} END")


@register("anderson_darling", "A20 W3", sql=_OOF_SQL + f""",
r AS (SELECT model, pred - obs AS x, row_number() OVER (PARTITION BY model ORDER BY pred - obs, key) AS i,
             count(*) OVER (PARTITION BY model) AS n FROM oof),
m AS (SELECT model, avg(x) AS mu, stddev_samp(x) AS sd FROM r GROUP BY model),
z AS (SELECT model, i, n, (x - mu) / sd AS z, abs((x - mu) / sd) AS y FROM r JOIN m USING (model)),
t AS (SELECT model, i, n, z, ln({_TAIL_SQL}) AS low, ln(1 - {_TAIL_SQL}) AS high FROM z),
a AS (SELECT model, any_value(n) AS n, -any_value(n) - sum((2 * i - 1) * CASE WHEN z < 0 THEN low ELSE high END
             + (2 * (n - i) + 1) * CASE WHEN z < 0 THEN high ELSE low END) / any_value(n) AS a2 FROM t GROUP BY model),
adj AS (SELECT *, a2 * (1 + 0.75 / n + 2.25 / (n * n)) AS s FROM a)
SELECT model, n, round(a2, 3) AS a2,
       CASE WHEN s < 0.2 THEN 1 - exp(-13.436 + 101.14 * s - 223.73 * s * s) WHEN s < 0.34 THEN 1 - exp(-8.318 + 42.796 * s - 59.938 * s * s)
            WHEN s < 0.6 THEN exp(0.9177 - 4.279 * s - 1.38 * s * s) WHEN s < 10 THEN round(exp(1.2937 - 5.709 * s + 0.0186 * s * s), 6)
            ELSE 3.7e-24 END AS p_value FROM adj
""")
def anderson_darling(spark, sf_dir):
    """A-D normality of the out-of-fold residuals, per model."""
    oof = oof_predictions(spark, sf_dir).withColumn("res", F.col("pred") - F.col("obs"))
    return EV.anderson_darling(oof, "res", by=["model"], key="key").select("model", "n", F.round("a2", 3).alias("a2"), "p_value")


@register("qq_pairs", "W3", sql=_OOF_SQL + f""",
r AS (SELECT model, key, pred - obs AS res, row_number() OVER (PARTITION BY model ORDER BY pred - obs, key) AS i,
             count(*) OVER (PARTITION BY model) AS n, stddev_samp(pred - obs) OVER (PARTITION BY model) AS sd FROM oof),
p AS (SELECT *, (i - 0.5) / n AS p FROM r)
SELECT model, key, i, n, round(res / sd, 6) AS stdres, round({_PPF_SQL}, 4) AS theoretical FROM p
""")
def qq_pairs(spark, sf_dir):
    """Q-Q pairs of the standardised residuals per model."""
    rt = EV.residual_table(oof_predictions(spark, sf_dir), label_from="key", by=["model"])
    return EV.qq_pairs(rt, "stdres", by=["model"], key="key").select(
        "model", "key", "i", "n", r6("stdres"), F.round("theoretical", 4).alias("theoretical"))
