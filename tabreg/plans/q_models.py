"""Catalogue: matrix filters, models, tuning, imputation, scoring (M1-M7 ML1-ML15 X3 X5
U4 I6 I7 I9 J7). Most are rows-only checks (model fits have no SQL form); the Gram
matrix, standardisation, Box-Cox profile and zero-variance screen have oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabreg.functions import linalg
from tabreg.operators import evaluate as EV
from tabreg.operators import compare, features, foldrecipe, foresthist, impute, matrix, models, split, tune
from tabreg.operators.score import refit_and_score
from tabreg.plans.common import r6
from tabreg.plans.registry import register
from tabreg.session import cut_lineage
from tabreg.sources.tables import table

FEATURES = ["log_ext", "avg_discount", "avg_tax", "n_lines", "sum_qty", "prio_rank", "status_f", "status_o"]
LABEL = "log_net"
KEY = "o_orderkey"

_MODEL_SQL = """(
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS set,
         CASE WHEN o.o_orderkey % 5 <> 0 THEN ln(a.net) END AS log_net,
         ln(a.ext) AS log_ext, a.avg_discount, a.avg_tax, CAST(a.n_lines AS DOUBLE) AS n_lines, a.sum_qty,
         CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS prio_rank,
         CASE WHEN o.o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS status_f,
         CASE WHEN o.o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END AS status_o,
         a.ext, a.net
  FROM orders o JOIN (
    SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS net, sum(l_extendedprice) AS ext,
           avg(l_discount) AS avg_discount, avg(l_tax) AS avg_tax, count(*) AS n_lines, sum(l_quantity) AS sum_qty
    FROM lineitem GROUP BY l_orderkey) a ON o.o_orderkey = a.l_orderkey
)"""


def model_table(spark, sf_dir):
    """One row per order: label = ln(net revenue of its lines) (NULL on the unlabelled
    set), predictors from the lines and the order."""
    li = table(spark, sf_dir, "lineitem")
    a = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.sum("l_extendedprice").alias("ext"), F.avg("l_discount").alias("avg_discount"),
        F.avg("l_tax").alias("avg_tax"), F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    t = o.join(a, o.o_orderkey == a.l_orderkey).drop("l_orderkey")
    is_test = F.col("o_orderkey") % 5 == 0
    return t.select(
        "o_orderkey", F.when(is_test, "test").otherwise("train").alias("set"),
        F.when(~is_test, F.log("net")).alias("log_net"), F.log("ext").alias("log_ext"),
        "avg_discount", "avg_tax", "n_lines", "sum_qty",
        F.substring("o_orderpriority", 1, 1).cast("double").alias("prio_rank"),
        (F.col("o_orderstatus") == "F").cast("double").alias("status_f"),
        (F.col("o_orderstatus") == "O").cast("double").alias("status_o"), "ext", "net")


def _train_with_folds(spark, sf_dir, k=10):
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    keys = cut_lineage(t.select(KEY, LABEL))           # the folds read it several times
    folds = split.stratified_folds(keys, KEY, LABEL, k=k, seed=12345).select(KEY, "fold")
    return t.join(folds, KEY)


# -- matrix -------------------------------------------------------------------------------

_GCOLS = ["log_ext", "avg_discount", "avg_tax"]


def _gram_sql():
    names = ["1.0"] + _GCOLS + [LABEL]
    labels = ["(Intercept)"] + _GCOLS + [LABEL]
    parts = []
    for i in range(len(names)):
        for j in range(i, len(names)):
            parts.append(f"SELECT {i} AS i, {j} AS j, '{labels[i]}' AS name_i, '{labels[j]}' AS name_j, "
                         f"round(sum({names[i]} * {names[j]}), 4) AS value FROM m")
    return f"WITH m AS (SELECT * FROM {_MODEL_SQL} t WHERE log_net IS NOT NULL) " + " UNION ALL ".join(parts)


@register("gram_matrix", "M3 ML3 ML10 (sufficient statistics)", sql=_gram_sql())
def gram_matrix(spark, sf_dir):
    t = model_table(spark, sf_dir)
    g = matrix.gram_long(t, _GCOLS, LABEL)
    return g.select(F.col("i"), F.col("j"), "name_i", "name_j", F.round("value", 4).alias("value"))


@register("standardize", "M6 M7", sql=f"""
WITH m AS (SELECT * FROM {_MODEL_SQL} t WHERE set = 'train'),
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in FEATURES)} FROM m)
{' UNION ALL '.join(f"SELECT '{c}' AS variable, round(min(s.m_{c}), 6) AS center, round(min(s.s_{c}), 6) AS scale, "
                    f"round(avg(({c} - s.m_{c}) / s.s_{c}), 6) AS mean_after, "
                    f"round(stddev_samp(({c} - s.m_{c}) / s.s_{c}), 6) AS sd_after "
                    f"FROM {_MODEL_SQL} t, s WHERE t.set = 'test'" for c in FEATURES)}
""")
def standardize(spark, sf_dir):
    """Fit centring/scaling on the training set, apply it to the unlabelled set (M7)."""
    t = model_table(spark, sf_dir)
    rec = matrix.Recipe([matrix.Standardize(FEATURES)]).fit(t.where(F.col("set") == "train"))
    te = rec.transform(t.where(F.col("set") == "test"))
    params = rec.steps[0].params
    agg = te.agg(*[F.avg(c).alias(f"m|{c}") for c in FEATURES], *[F.stddev_samp(c).alias(f"s|{c}") for c in FEATURES])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.round(F.lit(params[c][0]), 6).alias("center"),
                 F.round(F.lit(params[c][1]), 6).alias("scale"),
                 F.round(F.col(f"`m|{c}`"), 6).alias("mean_after"), F.round(F.col(f"`s|{c}`"), 6).alias("sd_after"))
        for c in FEATURES])).alias("_s")).select("_s.*")


_BC_COLS = ["ext", "net", "sum_qty"]
_BC_LAMS = [-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0]


def _bc_sql():
    parts = []
    for c in _BC_COLS:
        for lam in _BC_LAMS:
            t = f"ln({c})" if lam == 0 else f"(power({c}, {lam}) - 1) / {lam}"
            parts.append(f"SELECT '{c}' AS variable, CAST({lam} AS DOUBLE) AS lam, "
                         f"round(-count({c}) / 2.0 * ln(var_pop({t})) + ({lam} - 1) * sum(ln({c})), 2) AS loglik "
                         f"FROM {_MODEL_SQL} m WHERE {c} > 0")
    return " UNION ALL ".join(parts)


@register("boxcox_profile", "M5", sql=_bc_sql())
def boxcox_profile(spark, sf_dir):
    p = matrix.boxcox_profile(model_table(spark, sf_dir), _BC_COLS, _BC_LAMS)
    return p.select("variable", "lam", F.round("loglik", 2).alias("loglik"))


# Exponents: the best of a grid of 0.01, then of one of 0.0001 around it.
def _lambda_sql(rows, keys):
    """SQL of (keys, lam) from ``rows`` (keys, positive x)."""
    by = ", ".join(keys)
    ll = "-count(*) / 2.0 * ln(var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END)) + (any_value(lam) - 1) * sum(ln(x))"
    return f"""l1 AS (SELECT {by}, arg_max(lam, ll) AS l1 FROM (
  SELECT {by}, lam, {ll} AS ll FROM {rows}, (SELECT i / 100.0::DOUBLE AS lam FROM range(-500, 501) g(i)) GROUP BY {by}, lam) GROUP BY {by}),
lam AS (SELECT {by}, arg_max(lam, ll) AS lam FROM (
  SELECT {by}, lam, {ll} AS ll FROM (
    SELECT r.*, greatest(least(l1 + i / 10000.0, 5.0), -5.0) AS lam FROM {rows} r JOIN l1 USING ({by}), range(-100, 101) g(i))
  GROUP BY {by}, lam) GROUP BY {by})"""


@register("boxcox_lambda", "M5", sql=f"""
WITH r AS (SELECT variable, x FROM (UNPIVOT (
  SELECT ext / 1000 AS ext_k, sum_qty, pow(1 + 10 * avg_discount, 3) AS odds FROM {_MODEL_SQL} t)
  ON ext_k, sum_qty, odds INTO NAME variable VALUE x)),
{_lambda_sql("r", ["variable"])}
SELECT variable, round(lam, 2) AS lam FROM lam
""")
def boxcox_lambda(spark, sf_dir):
    """Chosen Box-Cox exponents of three columns, two passes for all of them."""
    t = model_table(spark, sf_dir).select((F.col("ext") / 1000).alias("ext_k"), "sum_qty",
                                          F.pow(1 + 10 * F.col("avg_discount"), 3).alias("odds"))
    lams = matrix.boxcox_lambdas(t, t.columns, fudge=0.0)
    return spark.createDataFrame([(c, round(v, 2)) for c, v in lams.items()], "variable string, lam double")


_RECIPE_COLS = {"log_ext": "log_ext", "avg_tax": "avg_tax", "n_lines": "n_lines", "combo": "log_ext + 2 * avg_tax",
                "near": "log_ext + 0.1 * avg_discount", "rare": "CASE WHEN o_orderkey % 97 = 0 THEN 1.0 ELSE 0.0 END",
                "once": "CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END",
                "odds": "pow(1 + 10 * avg_discount, 3)"}


@register("recipe_folds", "X3 M1 M3 M4 M5 M6 M7", sql=f"""
WITH m AS (SELECT o_orderkey, o_orderkey % 2 + 1 AS f, {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in _RECIPE_COLS.items())}
           FROM {_MODEL_SQL} t WHERE set = 'train'),
p AS (SELECT h.fold, m.* EXCLUDE (f) FROM m JOIN (VALUES (1), (2)) h(fold) ON m.f <> h.fold),
u AS (SELECT fold, o_orderkey, variable, v FROM (UNPIVOT p ON {', '.join(_RECIPE_COLS)} INTO NAME variable VALUE v)),
top AS (SELECT fold, variable, count(*) AS levels, sum(c) AS n, max(c, 2) AS c FROM (
  SELECT fold, variable, v, count(*) AS c FROM u GROUP BY ALL) GROUP BY ALL),
nzv AS (SELECT fold, variable, levels = 1 OR (c[1] / c[2] > 19 AND 100.0 * levels / n <= 10) AS nzv FROM top),
k AS (SELECT fold, variable FROM nzv WHERE NOT nzv AND variable <> 'combo'),
r AS (SELECT a.fold, a.variable AS a, b.variable AS b, abs(corr(a.v, b.v)) AS r FROM u a JOIN u b USING (fold, o_orderkey)
      WHERE a.variable <> b.variable AND (a.fold, a.variable) IN (FROM k) AND (b.fold, b.variable) IN (FROM k) GROUP BY ALL),
mr AS (SELECT fold, a AS variable, avg(r) AS mr FROM r GROUP BY ALL),
hi AS (SELECT r.fold, CASE WHEN x.mr > y.mr THEN r.a ELSE r.b END AS variable FROM r
       JOIN mr x ON x.fold = r.fold AND x.variable = r.a JOIN mr y ON y.fold = r.fold AND y.variable = r.b
       WHERE r.r > 0.9 AND x.mr > y.mr),
s AS (SELECT fold, variable, CASE WHEN nzv THEN 'nzv' WHEN variable = 'combo' THEN 'lincomb'
             WHEN (fold, variable) IN (FROM hi) THEN 'corr' ELSE 'kept' END AS step FROM nzv),
pos AS (SELECT fold, variable FROM u GROUP BY ALL HAVING min(v) > 0),
q AS (SELECT fold, variable, v AS x FROM u WHERE (fold, variable) IN (FROM pos)
      AND (fold, variable) IN (SELECT fold, variable FROM s WHERE step = 'kept')),
{_lambda_sql("q", ["fold", "variable"])},
z AS (SELECT fold, variable, avg(v) AS center, stddev_samp(v) AS scale FROM u GROUP BY ALL)
SELECT CAST(s.fold AS INTEGER) AS fold, s.variable, s.step, round(lam, 2) AS lambda,
       CASE WHEN step = 'kept' AND lam IS NULL THEN round(center, 6) END AS center,
       CASE WHEN step = 'kept' AND lam IS NULL THEN round(scale, 6) END AS scale
FROM s JOIN z USING (fold, variable) LEFT JOIN lam ON lam.fold = s.fold AND lam.variable = s.variable AND step = 'kept'
""")
def recipe_folds(spark, sf_dir):
    """The recipe of either of two folds, fitted on the other one: planted columns of almost one
    value, of one value in one fold, an exact combination, a near copy and a skewed column; every
    positive column that stays has its exponent."""
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    t = t.select(KEY, LABEL, (F.col(KEY) % 2 + 1).cast("int").alias("fold"),
                 *[F.expr(e).cast("double").alias(c) for c, e in _RECIPE_COLS.items()])
    stats = foldrecipe.fold_statistics(t, list(_RECIPE_COLS), LABEL, "fold",
                                       foldrecipe.FoldRecipe(("nzv", "lincomb", "corr", "boxcox", "center", "scale"), fudge=0.0))
    out = foldrecipe.recipe_table(stats, spark)
    plain = F.col("lambda").isNull()
    return out.select("fold", "variable", "step", F.round("lambda", 2).alias("lambda"),
                      F.when(plain, F.round("center", 6)).alias("center"), F.when(plain, F.round("scale", 6)).alias("scale"))


@register("zero_variance", "M2", sql=f"""
SELECT variable, is_zv FROM (
  SELECT 'status_f' AS variable, min(status_f) = max(status_f) AS is_zv FROM {_MODEL_SQL} t
  UNION ALL SELECT 'const_one', true FROM (SELECT 1) x
  UNION ALL SELECT 'n_lines', min(n_lines) = max(n_lines) FROM {_MODEL_SQL} t
)
""")
def zero_variance(spark, sf_dir):
    t = model_table(spark, sf_dir).withColumn("const_one", F.lit(1.0))
    cols = ["status_f", "const_one", "n_lines"]
    zv = set(matrix.zero_variance_columns(t, cols))
    return spark.createDataFrame([(c, c in zv) for c in cols], "variable string, is_zv boolean")


@register("drop_near_zero_variance", "M1 A6", sql=f"""
WITH m AS (SELECT {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in _RECIPE_COLS.items())} FROM {_MODEL_SQL} t),
u AS (SELECT variable, v FROM (UNPIVOT m ON {', '.join(_RECIPE_COLS)} INTO NAME variable VALUE v)),
t AS (SELECT variable, count(*) AS levels, sum(c) AS n, max(c, 2) AS c FROM (SELECT variable, v, count(*) AS c FROM u GROUP BY ALL)
      GROUP BY ALL)
SELECT variable AS dropped FROM t WHERE levels = 1 OR (c[1] / c[2] > 19 AND 100.0 * levels / n <= 10)
""")
def drop_near_zero_variance(spark, sf_dir):
    """Columns of almost one value, by the filter that drops them."""
    t = model_table(spark, sf_dir).select(*[F.expr(e).cast("double").alias(c) for c, e in _RECIPE_COLS.items()])
    step = matrix.DropColumns(t.columns, "nzv").fit(t)
    return spark.createDataFrame([(c,) for c in t.columns if c not in step.transform(t).columns], "dropped string")


@register("drop_combos", "M3", sql=f"""
WITH d AS (SELECT log_ext AS x1, avg_tax AS x2, log_ext + 2 * avg_tax AS y FROM {_MODEL_SQL} t),
mu AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d),
c AS (SELECT sum(pow(x1 - m1, 2)) AS s11, sum(pow(x2 - m2, 2)) AS s22, sum((x1 - m1) * (x2 - m2)) AS s12,
             sum((x1 - m1) * (y - my)) AS s1y, sum((x2 - m2) * (y - my)) AS s2y, sum(pow(y - my, 2)) AS syy FROM d, mu)
SELECT 'combo' AS dropped FROM c
WHERE abs(syy - (s1y * s1y * s22 - 2 * s1y * s2y * s12 + s2y * s2y * s11) / (s11 * s22 - s12 * s12)) <= 1e-9 * syy
""")
def drop_combos(spark, sf_dir):
    """Planted exact combination ``combo = log_ext + 2 avg_tax`` must be found."""
    t = model_table(spark, sf_dir).withColumn("combo", F.col("log_ext") + 2 * F.col("avg_tax"))
    cols = FEATURES + ["combo"]
    g = matrix.gram(t, cols)[()]
    return spark.createDataFrame([(c,) for c in matrix.linear_combos(g, cols)], "dropped string")


_CORR_COLS = {c: c for c in FEATURES} | {"ext": "ext", "ext_k": "ext / 1000 + avg_tax"}


@register("drop_correlated", "M4 A11", sql=f"""
WITH d AS (SELECT o_orderkey, {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in _CORR_COLS.items())} FROM {_MODEL_SQL} t),
u AS (SELECT o_orderkey, variable, v FROM (UNPIVOT d ON {', '.join(_CORR_COLS)} INTO NAME variable VALUE v)),
r AS (SELECT a.variable AS a, b.variable AS b, abs(corr(a.v, b.v)) AS r FROM u a JOIN u b USING (o_orderkey)
      WHERE a.variable <> b.variable GROUP BY ALL),
m AS (SELECT a AS variable, avg(r) AS m FROM r GROUP BY a)
SELECT r.a AS dropped FROM r JOIN m x ON x.variable = r.a JOIN m y ON y.variable = r.b WHERE r.r > 0.9 AND x.m > y.m
""")
def drop_correlated(spark, sf_dir):
    t = model_table(spark, sf_dir).withColumn("ext_k", F.col("ext") / 1000 + F.col("avg_tax"))
    cols = FEATURES + ["ext", "ext_k"]
    g = matrix.gram(t, cols)[()]
    return spark.createDataFrame([(c,) for c in matrix.high_correlation(matrix.correlation_from_gram(g, cols), cols, 0.9)],
                                 "dropped string")


# -- models -------------------------------------------------------------------------------

@register("ols_table", "ML1 ML2 T14 W1")
def ols_table(spark, sf_dir):
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    return models.ols_table(t, FEATURES, LABEL)


@register("stepwise", "ML3")
def stepwise(spark, sf_dir):
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    chosen, trace, fit = models.stepwise(t, FEATURES, LABEL)
    return spark.createDataFrame([(r["step"], r["action"], r["variable"], float(r["aic"])) for r in trace],
                                 "step int, action string, variable string, aic double")


# Two predictors, one of them with a mean of about 1.7e9 and a spread of about 50 (seconds since an
# epoch), so the solution in SQL is Cramer's rule on centred sums.
_TWO = ["epoch", "avg_discount"]
_TWO_SQL = f"""
WITH d AS (SELECT log_net AS y, 1.7e9 + 10 * sum_qty / n_lines + n_lines AS x1, avg_discount AS x2
           FROM {_MODEL_SQL} t WHERE set = 'train'),
mu AS (SELECT count(*) AS n, avg(x1 - 1.7e9) AS m1, avg(x2) AS m2, avg(y) AS my FROM d),
c AS (SELECT n, m1, m2, my, z.* FROM mu, (
  SELECT sum(pow(x1 - 1.7e9 - m1, 2)) AS s11, sum(pow(x2 - m2, 2)) AS s22,
         sum((x1 - 1.7e9 - m1) * (x2 - m2)) AS s12, sum((x1 - 1.7e9 - m1) * (y - my)) AS s1y,
         sum((x2 - m2) * (y - my)) AS s2y, sum(pow(y - my, 2)) AS syy FROM d, mu) z)"""


def _two_predictors(spark, sf_dir):
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    return t.withColumn("epoch", F.lit(1.7e9) + 10 * F.col("sum_qty") / F.col("n_lines") + F.col("n_lines"))


@register("ols_large_mean", "ML1 ML2", sql=f"""{_TWO_SQL},
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c)
SELECT 'epoch' AS variable, round(b1, 6) AS estimate FROM b
UNION ALL SELECT 'avg_discount', round(b2, 6) FROM b
""")
def ols_large_mean(spark, sf_dir):
    fit = models.fit_linear(_two_predictors(spark, sf_dir), _TWO, LABEL, models.LinearSpec("ols"))
    return spark.createDataFrame([(c, round(float(b), 6)) for c, b in zip(_TWO, fit.coef)],
                                 "variable string, estimate double")


@register("coefficient_table", "ML2 ML11", sql=_TWO_SQL + """,
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
v AS (SELECT *, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v FROM b),
t AS (SELECT 'epoch' AS variable, b1 AS estimate, sqrt(v * s22 / (s11 * s22 - s12 * s12)) AS std_error, v.n FROM v
      UNION ALL SELECT 'avg_discount', b2, sqrt(v * s11 / (s11 * s22 - s12 * s12)), v.n FROM v)
SELECT variable, round(estimate, 6) AS estimate, round(std_error, 8) AS std_error, round(estimate / std_error, 4) AS t,
       round(abs(estimate / std_error), 4) AS importance,
       round(100 * (abs(estimate / std_error) - min(abs(estimate / std_error)) OVER ())
             / (max(abs(estimate / std_error)) OVER () - min(abs(estimate / std_error)) OVER ()), 4) AS scaled
FROM t
""")
def coefficient_table(spark, sf_dir):
    """Standard errors and t of least squares from the centred Gram matrix, |t| as importance."""
    g = matrix.gram(_two_predictors(spark, sf_dir), _TWO, LABEL)[()]
    rows = [("lm", *r) for r in models.coefficient_stats(g, _TWO, LABEL)]
    t = spark.createDataFrame(rows, "model string, variable string, estimate double, std_error double, t double, p double")
    imp = spark.createDataFrame(models.linear_importance(g, _TWO, LABEL, models.LinearSpec("ols")), "variable string, importance double")
    out = t.join(EV.scaled_importance(imp, "importance"), "variable")
    return out.select("variable", r6("estimate"), F.round("std_error", 8).alias("std_error"), F.round("t", 4).alias("t"),
                      F.round("importance", 4).alias("importance"), F.round("scaled", 4).alias("scaled"))


@register("ridge_importance", "ML11 ML4", sql=_TWO_SQL + """,
r AS (SELECT s12 / sqrt(s11 * s22) AS r, s1y / n / sqrt(s11 / n) AS r1, s2y / n / sqrt(s22 / n) AS r2, n FROM c)
SELECT 'epoch' AS variable, round(abs(r1 * 1.01 - r2 * r) / (1.01 * 1.01 - r * r) * sqrt(n / (n - 1)), 6) AS importance FROM r
UNION ALL SELECT 'avg_discount', round(abs(r2 * 1.01 - r1 * r) / (1.01 * 1.01 - r * r) * sqrt(n / (n - 1)), 6) FROM r
""")
def ridge_importance(spark, sf_dir):
    """|coefficient| of a ridge fit on the standardised scale."""
    g = matrix.gram(_two_predictors(spark, sf_dir), _TWO, LABEL)[()]
    rows = models.linear_importance(g, _TWO, LABEL, models.LinearSpec("ridge", lam=0.01))
    return spark.createDataFrame([(c, round(v, 6)) for c, v in rows], "variable string, importance double")


_TWO_LAMS = [0.0, 0.001, 0.01, 0.1, 0.5]


@register("ridge_closed", "ML4", sql=_TWO_SQL + """,
r AS (SELECT s12 / sqrt(s11 * s22) AS r, s1y / n / sqrt(s11 / n) AS r1, s2y / n / sqrt(s22 / n) AS r2,
             sqrt(s11 / n) AS d1, sqrt(s22 / n) AS d2, my FROM c),
l AS (SELECT CAST(lam AS DOUBLE) AS lam FROM (VALUES """ + ", ".join(f"({x})" for x in _TWO_LAMS) + """) v(lam))
SELECT lam, round((r1 * (1 + lam) - r2 * r) / (pow(1 + lam, 2) - r * r) / d1, 6) AS epoch,
       round((r2 * (1 + lam) - r1 * r) / (pow(1 + lam, 2) - r * r) / d2, 6) AS avg_discount
FROM r, l
""")
def ridge_closed(spark, sf_dir):
    """Ridge coefficients of two predictors along five penalties, one Gram pass."""
    g = matrix.gram(_two_predictors(spark, sf_dir), _TWO, LABEL)[()]
    rows = [(x, *(round(float(b), 6) for b in linalg.ridge(g, _TWO, LABEL, x).coef)) for x in _TWO_LAMS]
    return spark.createDataFrame(rows, "lam double, epoch double, avg_discount double")


@register("lasso_threshold", "ML5 ML6", sql=_TWO_SQL + """,
r AS (SELECT s1y / n / sqrt(s11 / n) AS r1, sqrt(s11 / n) AS d1 FROM c),
l AS (SELECT CAST(lam AS DOUBLE) AS lam, CAST(alpha AS DOUBLE) AS alpha
      FROM (VALUES """ + ", ".join(f"({x}, {a})" for x in _TWO_LAMS for a in (0.25, 1.0)) + """) v(lam, alpha))
SELECT lam, alpha, round(sign(r1) * greatest(abs(r1) - lam * alpha, 0) / (1 + lam * (1 - alpha)) / d1, 6) + 0.0 AS epoch
FROM r, l
""")
def lasso_threshold(spark, sf_dir):
    """Lasso and elastic net of one predictor: the soft threshold of its correlation."""
    g = matrix.gram(_two_predictors(spark, sf_dir), _TWO[:1], LABEL)[()]
    rows = [(x, a, round(float(linalg.elastic_net(g, _TWO[:1], LABEL, x, a).coef[0]), 6) + 0.0)
            for x in _TWO_LAMS for a in (0.25, 1.0)]
    return spark.createDataFrame(rows, "lam double, alpha double, epoch double")


@register("stepwise_four", "ML3", sql=_TWO_SQL + """,
a AS (SELECT 'both' AS model, n, 3 AS k,
             syy - (s1y * s1y * s22 - 2 * s1y * s2y * s12 + s2y * s2y * s11) / (s11 * s22 - s12 * s12) AS rss FROM c
      UNION ALL SELECT 'epoch', n, 2, syy - s1y * s1y / s11 FROM c
      UNION ALL SELECT 'avg_discount', n, 2, syy - s2y * s2y / s22 FROM c
      UNION ALL SELECT 'none', n, 1, syy FROM c)
SELECT model, round(n * ln(rss / n) + 2 * k, 4) AS aic FROM a
""")
def stepwise_four(spark, sf_dir):
    """AIC of the four models that the stepwise search over two predictors compares."""
    g = matrix.gram(_two_predictors(spark, sf_dir), _TWO, LABEL)[()]
    sets = {"both": _TWO, "epoch": _TWO[:1], "avg_discount": _TWO[1:], "none": []}
    rows = [(name, round(linalg.aic(g, feats, LABEL)[0], 4)) for name, feats in sets.items()]
    return spark.createDataFrame(rows, "model string, aic double")


def _linear_cv(spark, sf_dir, kind, grid, name):
    d = _train_with_folds(spark, sf_dir)
    res = tune.tune_linear(d, FEATURES, LABEL, "fold", grid, kind=kind, key=KEY, model_name=name)
    return res


@register("ridge", "ML4 X3")
def ridge(spark, sf_dir):
    grid = [{"lam": float(x)} for x in np.linspace(0, 0.5, 100)]
    return _linear_cv(spark, sf_dir, "ridge", grid, "ridge").grid_metrics


@register("lasso", "ML5 X3")
def lasso(spark, sf_dir):
    grid = [{"lam": float(x), "alpha": 1.0} for x in np.linspace(0, 0.025, 100)]
    return _linear_cv(spark, sf_dir, "enet", grid, "lasso").grid_metrics


def _enet_grid():
    return tune.param_grid(alpha=[float(a) for a in np.linspace(0, 0.25, 10)],
                           lam=[float(x) for x in np.linspace(0, 0.05, 10)])


@register("elastic_net", "ML6 X3 U4")
def elastic_net(spark, sf_dir):
    return _linear_cv(spark, sf_dir, "enet", _enet_grid(), "enet").grid_metrics


@register("tune_grid", "X3 ML12 O2 A17 A18")
def tune_grid(spark, sf_dir):
    """Best elastic-net setting with its per-fold metrics (RMSE, R^2 from the fold Gram
    blocks; MAE from the out-of-fold predictions)."""
    res = _linear_cv(spark, sf_dir, "enet", _enet_grid(), "enet")
    fm = res.fold_metrics.where(F.col("grid_id") == res.best["grid_id"])
    mae = res.oof.groupBy("fold").agg(F.avg(F.abs(F.col("pred") - F.col("obs"))).alias("mae"))
    return fm.join(mae, "fold")


# Folds and settings are those of the reference where the stand-in's 8 predictors allow it (every node
# size, every share of the predictors tried per split, every depth); tree counts are shorter. README has
# the measured time of the full counts.
_TREES = [5, 10, 20]


@register("bagged", "ML7 X3")
def bagged(spark, sf_dir):
    """Bagged trees: ten node sizes, ten folds, nested tree counts from one fit each."""
    return tune.tune_forest(_train_with_folds(spark, sf_dir), FEATURES, LABEL, "fold",
                            lambda s: models.forest(FEATURES, LABEL, mtry="all", min_node=int(s["min_node"]), max_depth=8),
                            tune.param_grid(min_node=list(range(1, 11))), _TREES, "bagged", parallelism=8).grid_metrics


@register("forest", "ML8 X3")
def forest(spark, sf_dir):
    """Random forest: 4 to 8 of the 8 predictors tried per split, two node sizes, ten folds."""
    return tune.tune_forest(_train_with_folds(spark, sf_dir), FEATURES, LABEL, "fold",
                            lambda s: models.forest(FEATURES, LABEL, mtry=int(s["mtry"]), min_node=int(s["min_node"]), max_depth=8),
                            tune.param_grid(mtry=[4, 5, 6, 7, 8], min_node=[4, 5]), _TREES, "forest", parallelism=8).grid_metrics


@register("boosted", "ML9 X3 X5")
def boosted(spark, sf_dir):
    """Boosting: three depths, ten folds, all tree counts of a setting from one path."""
    return tune.boosting_paths(_train_with_folds(spark, sf_dir), FEATURES, LABEL, "fold",
                               lambda s: models.boosted(FEATURES, LABEL, depth=int(s["depth"]), shrinkage=0.1, min_node=3),
                               tune.param_grid(depth=[3, 4, 5]), _TREES, "gbm", parallelism=8).grid_metrics


@register("boost_path", "X5 ML9")
def boost_path(spark, sf_dir):
    p = tune.boost_path(_train_with_folds(spark, sf_dir), FEATURES, LABEL, "fold",
                        lambda: models.boosted(FEATURES, LABEL, n_trees=30, depth=3, shrinkage=0.1), parallelism=8)
    return p.groupBy("n_trees").agg(F.avg("rmse").alias("rmse"), F.count(F.lit(1)).alias("n_folds"))


NPRUNE = [int(x) for x in np.floor(np.linspace(2, 100, 10))]


@register("spline", "ML10 X3")
def spline(spark, sf_dir):
    """Number of terms of the hinge regression tuned over 10 folds: metrics of every setting and
    fold, and the terms kept with the best one on all rows."""
    res = models.tune_mars(cut_lineage(_train_with_folds(spark, sf_dir)), FEATURES, LABEL, "fold", NPRUNE)
    rows = [(n, int(f), t, rmse, r2, n == res.best, len(res.model.terms) + 1) for n, f, t, rmse, r2 in res.fold_metrics]
    return spark.createDataFrame(rows, "nprune int, fold int, n_terms int, rmse double, rsquared double, best boolean, "
                                       "n_terms_best int")


_KNOT_P = [(i + 1) / 10 for i in range(9)]


@register("spline_one_knot", "ML10", sql=f"""
WITH m AS (SELECT sum_qty AS x, log_net AS y FROM {_MODEL_SQL} t WHERE set = 'train'),
k AS (SELECT unnest(quantile_cont(x, {_KNOT_P})) AS knot FROM m),
h AS (SELECT DISTINCT knot, greatest(x - knot, 0) AS a, greatest(knot - x, 0) AS b, y, count(*) AS w FROM m, k GROUP BY ALL),
mu AS (SELECT knot, sum(w) AS n, sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb, sum(w * y) / sum(w) AS my FROM h GROUP BY knot),
c AS (SELECT knot, any_value(n) AS n, sum(w * pow(a - ma, 2)) AS saa, sum(w * pow(b - mb, 2)) AS sbb,
             sum(w * (a - ma) * (b - mb)) AS sab, sum(w * (a - ma) * (y - my)) AS say, sum(w * (b - mb) * (y - my)) AS sby,
             sum(w * pow(y - my, 2)) AS syy FROM h JOIN mu USING (knot) GROUP BY knot),
r AS (SELECT knot, n, syy - (say * say * sbb - 2 * say * sby * sab + sby * sby * saa) / (saa * sbb - sab * sab) AS rss FROM c)
SELECT round(knot, 6) AS knot, round(sqrt(rss / n), 6) AS rmse FROM r ORDER BY rss LIMIT 1
""")
def spline_one_knot(spark, sf_dir):
    """The best single knot of one feature: the first pair of the forward search."""
    t = model_table(spark, sf_dir).where(F.col("set") == "train")
    pairs = [g for g in models.hinge_candidates(t, ["sum_qty"], 9) if len(g) == 2]
    g = models._hinge_blocks(t, pairs, LABEL)[()]
    found = linalg.forward_pairs(g, [tuple(models._hname(*x) for x in p) for p in pairs], LABEL, max_terms=3)[0]
    knot = next(p[0][1] for p in pairs if models._hname(*p[0]) in found)
    rmse = (linalg.rss(g, linalg.ols(g, found, LABEL), LABEL) / g.n) ** 0.5
    return spark.createDataFrame([(round(knot, 6), round(float(rmse), 6))], "knot double, rmse double")


@register("ols_folds", "X3 A17 M6", sql=f"""
WITH d AS (SELECT o_orderkey % 2 + 1 AS f, log_net AS y, 10 * sum_qty / n_lines + n_lines AS x1, avg_discount AS x2
           FROM {_MODEL_SQL} t WHERE set = 'train'),
p AS (SELECT h.fold, d.* FROM d JOIN (VALUES (1), (2)) h(fold) ON d.f <> h.fold),
mu AS (SELECT fold, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM p GROUP BY fold),
c AS (SELECT fold, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my, sum(pow(x1 - m1, 2)) AS s11,
             sum(pow(x2 - m2, 2)) AS s22, sum((x1 - m1) * (x2 - m2)) AS s12, sum((x1 - m1) * (y - my)) AS s1y,
             sum((x2 - m2) * (y - my)) AS s2y FROM p JOIN mu USING (fold) GROUP BY fold),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
e AS (SELECT b.fold, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS pred FROM d JOIN b ON d.f = b.fold)
SELECT CAST(fold AS INTEGER) AS fold, round(sqrt(avg(pow(pred - y, 2))), 6) AS rmse, round(pow(corr(pred, y), 2), 6) AS rsquared
FROM e GROUP BY fold
""")
def ols_folds(spark, sf_dir):
    """Least squares over two folds with centring and scaling refitted in each."""
    t = _two_predictors(spark, sf_dir).withColumn("fold", (F.col(KEY) % 2 + 1).cast("int"))
    res = tune.tune_linear(t, _TWO, LABEL, "fold", [{"lam": 0.0}], kind="ols",
                           recipe=foldrecipe.FoldRecipe(("zv", "center", "scale")))
    return res.fold_metrics.select("fold", F.round("rmse", 6).alias("rmse"), F.round("rsquared", 6).alias("rsquared"))


@register("lasso_folds", "X3 ML5 ML12 U4", sql=f"""
WITH d AS (SELECT o_orderkey % 2 + 1 AS f, log_net AS y, sum_qty AS x FROM {_MODEL_SQL} t WHERE set = 'train'),
p AS (SELECT h.fold, d.* FROM d JOIN (VALUES (1), (2)) h(fold) ON d.f <> h.fold),
c AS (SELECT fold, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / stddev_pop(x) AS r, stddev_pop(x) AS sd FROM p GROUP BY fold),
b AS (SELECT fold, lam, mx, my, sign(r) * greatest(abs(r) - lam, 0) / sd AS b
      FROM c, (SELECT unnest([{', '.join(map(str, _TWO_LAMS))}])::DOUBLE AS lam)),
e AS (SELECT b.fold, lam, sqrt(avg(pow(y - my - b * (x - mx), 2))) AS rmse FROM d JOIN b ON d.f = b.fold GROUP BY b.fold, lam),
g AS (SELECT lam, avg(rmse) AS mean FROM e GROUP BY lam)
SELECT CAST(fold AS INTEGER) AS fold, lam, round(rmse, 6) AS rmse, lam = (SELECT arg_min(lam, mean) FROM g) AS best FROM e
""")
def lasso_folds(spark, sf_dir):
    """Five penalties of a one-predictor lasso over two folds, and the best of them."""
    t = model_table(spark, sf_dir).where(F.col("set") == "train").withColumn("fold", (F.col(KEY) % 2 + 1).cast("int"))
    res = tune.tune_linear(t, ["sum_qty"], LABEL, "fold", tune.param_grid(lam=_TWO_LAMS), kind="enet")
    return res.fold_metrics.select("fold", "lam", F.round("rmse", 6).alias("rmse"),
                                   (F.col("lam") == float(res.best["lam"])).alias("best"))


@register("score_two", "ML13 ML15 E12", sql=f"""
WITH d AS (SELECT o_orderkey, set, log_net AS y, sum_qty AS x1, avg_discount AS x2 FROM {_MODEL_SQL} t),
mu AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, count(*) AS n, stddev_pop(x1) AS d1, stddev_pop(x2) AS d2
       FROM d WHERE set = 'train'),
r AS (SELECT m1, m2, my, d1, d2, sum((x1 - m1) * (x2 - m2)) / n / d1 / d2 AS r, sum((x1 - m1) * (y - my)) / n / d1 AS r1,
             sum((x2 - m2) * (y - my)) / n / d2 AS r2 FROM d, mu WHERE set = 'train' GROUP BY m1, m2, my, d1, d2, n),
b AS (SELECT *, (r1 * 1.001 - r2 * r) / (pow(1.001, 2) - r * r) / d1 AS b1, (r2 * 1.001 - r1 * r) / (pow(1.001, 2) - r * r) / d2 AS b2 FROM r)
SELECT o_orderkey AS Id, round(exp(my + b1 * (x1 - m1) + b2 * (x2 - m2)), 2) AS prediction FROM d, b WHERE set = 'test'
""")
def score_two(spark, sf_dir):
    """The unlabelled orders scored by a ridge fit of two predictors on all labelled ones, as prices."""
    t = model_table(spark, sf_dir)
    cols = ["sum_qty", "avg_discount"]
    scored, _ = refit_and_score(t.where(F.col("set") == "train"), t.where(F.col("set") == "test"), cols, LABEL,
                                models.LinearSpec("ridge", lam=0.001), recipe=matrix.Recipe([matrix.Standardize(cols)]), key=KEY)
    return scored.select(F.col(KEY).alias("Id"), F.round("prediction", 2).alias("prediction"))


_FACTORS = ["o_orderpriority", "o_orderstatus", "n_lines_f"]
FEATURES_TREE = ["log_ext", "avg_discount", "avg_tax", "n_lines", "sum_qty", "prio_rank"]


def _factor_table(spark, sf_dir):
    """The training rows with their folds, factors as contrasts, and derived columns of all kinds."""
    d = _train_with_folds(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(KEY, "o_orderpriority", "o_orderstatus")
    d = d.join(o, KEY).withColumn("n_lines_f", F.col("n_lines").cast("int").cast("string")).withColumns(
        {c: F.expr(e).cast("double") for c, e in _RECIPE_COLS.items() if c not in FEATURES})
    enc = features.ContrastEncoder(nominal=_FACTORS).fit(d)
    numeric = [c for c in [*FEATURES, *_RECIPE_COLS] if not c.startswith("status")]
    return cut_lineage(enc.transform(d)), [*dict.fromkeys(numeric), *enc.output_columns()]


@register("linear_recipe", "X3 ML1 ML3 M1 M3 M4 M5 M6")
def linear_recipe(spark, sf_dir):
    """Least squares and stepwise selection over 10 folds with the whole recipe (near-zero variance,
    combinations, correlations, Box-Cox, centring, scaling) refitted in each: metrics by fold, the
    number of the recipe's terms and of the fit's."""
    d, cols = _factor_table(spark, sf_dir)
    out, recipe, stats = [], foldrecipe.FoldRecipe(("nzv", "lincomb", "corr", "boxcox", "center", "scale")), None
    for kind in ("ols", "step"):
        res = tune.tune_linear(d, cols, LABEL, "fold", [{"lam": 0.0}], kind=kind, model_name=kind, recipe=recipe, statistics=stats)
        stats = res.statistics
        sizes = [(int(f), len(res.recipes[f].terms), len(res.fits[(0, f)].features)) for f in res.statistics.folds]
        n = spark.createDataFrame(sizes, "fold int, n_terms int, n_used int")
        out.append(res.fold_metrics.join(n, "fold").select("model", "fold", "n_terms", "n_used", "rmse", "rsquared"))
    return EV.stack(out)


# -- nine models on the same folds ------------------------------------------------------------

LAMBDAS = {"ridge": [float(x) for x in np.linspace(0, 0.5, 100)], "lasso": [float(x) for x in np.linspace(0, 0.025, 100)]}
_OLS_RECIPE = foldrecipe.FoldRecipe(("nzv", "lincomb", "corr", "boxcox", "center", "scale"))
_PEN_RECIPE = foldrecipe.FoldRecipe(("zv", "center", "scale"))


@register("model_compare", "A17 A19 U2 J5 T23 X1 X2 X3")
def model_compare(spark, sf_dir):
    """Nine tuned models on the same ten folds of the 80 % part (summary of their RMSE) and on the
    20 % hold-out, worst first: least squares and stepwise with the whole recipe, three penalised fits
    with centring and scaling, bagging, forest, boosting and hinges."""
    d, cols = _factor_table(spark, sf_dir)
    d = d.drop("fold")
    a = cut_lineage(split.stratified_split(d, KEY, LABEL, p=0.8, seed=12345))
    train = split.keep_rows(d, a, KEY, F.col("split") == "train")
    holdout = split.drop_rows(d, a, KEY, F.col("split") == "train")
    folds = split.stratified_folds(train, KEY, LABEL, k=10, seed=12345).select(KEY, "fold")
    train, holdout = cut_lineage(train.join(folds, KEY)), cut_lineage(holdout)
    at = (train, cols, LABEL, "fold")
    few = (train, FEATURES_TREE, LABEL, "fold")
    forest_of = lambda mtry, node: (lambda s: models.forest(FEATURES_TREE, LABEL, mtry=mtry, min_node=node, max_depth=6))
    lm = compare.linear("lm", *at, [{"lam": 0.0}], "ols", _OLS_RECIPE)
    ridge = compare.linear("ridge", *at, [{"lam": x} for x in LAMBDAS["ridge"]], "ridge", _PEN_RECIPE)
    shared = foresthist.Shared()                       # bag and forest draw the same bags
    try:
        bag = compare.trees("bag", *few, forest_of("all", 5), [{}], [5, 10], parallelism=8, shared=shared)
        forest = compare.trees("forest", *few, forest_of(4, 4), [{}], [5, 10], parallelism=8, shared=shared)
    finally:
        shared.release()
    found = [
        lm,
        compare.linear("step", *at, [{"lam": 0.0}], "step", _OLS_RECIPE, lm.statistics),
        ridge,
        compare.linear("lasso", *at, [{"lam": x, "alpha": 1.0} for x in LAMBDAS["lasso"]], "enet", _PEN_RECIPE, ridge.statistics),
        compare.linear("elnet", *at, _enet_grid(), "enet", _PEN_RECIPE, ridge.statistics),
        bag,
        forest,
        compare.trees("gbm", *few, lambda s: models.boosted(FEATURES_TREE, LABEL, depth=3, shrinkage=0.3, min_node=3), [{}],
                      [5, 10], boosted=True, parallelism=8),
        compare.hinges("mars", train, FEATURES_TREE, LABEL, "fold", NPRUNE)]
    return compare.comparison(found, holdout, LABEL)


_GAPS = {"avg_tax": "o_orderkey % 7 = 0", "sum_qty": "o_orderkey % 11 = 3", "log_ext": "o_orderkey % 13 = 5",
         "prio": "o_orderkey % 17 = 2"}


@register("chained_impute", "I6 I7 J7 I5", sql=f"""
SELECT {', '.join(f'count(*) FILTER (WHERE {w}) AS n_imputed_{c}, CAST(0 AS BIGINT) AS n_left_{c}, CAST(0 AS BIGINT) AS n_outside_{c}'
                  for c, w in _GAPS.items())},
       count(*) AS n
FROM {_MODEL_SQL} t
""")
def chained_impute(spark, sf_dir):
    """Plant gaps in three numbers and a text, impute them by chained trees with donor draws (one
    predictor is a text with gaps of its own), report per column how many cells were filled, how many
    are left and how many got a value that no row was observed with."""
    t = model_table(spark, sf_dir)
    t = t.withColumn("prio", F.concat(F.lit("P"), F.col("prio_rank").cast("int").cast("string"))) \
         .withColumn("status", F.when(F.col(KEY) % 19 != 1, F.when(F.col("status_f") == 1, "F")
                                      .when(F.col("status_o") == 1, "O").otherwise("P")))
    t = cut_lineage(t.withColumns({c: F.when(~F.expr(w), F.col(c)) for c, w in _GAPS.items()}))    # read twice
    preds = {"*": [*_GAPS, "avg_discount", "n_lines", "status"]}
    done = cut_lineage(impute.chained_impute(t, KEY, list(_GAPS), preds, seed=1970, min_node=5))
    outside = done.agg(*[F.struct(F.count_if(F.col(f"{c}_imputed")).alias("filled"), F.count_if(F.col(c).isNull()).alias("left")).alias(c)
                         for c in _GAPS], F.count(F.lit(1)).alias("n"))
    for c in _GAPS:
        seen = done.where(~F.col(f"{c}_imputed")).select(c).distinct()      # a frequent value is one row
        strange = done.where(F.col(f"{c}_imputed")).join(seen, c, "left_anti").agg(F.count(F.lit(1)).alias("n"))
        outside = outside.withColumns({f"n_imputed_{c}": F.col(f"{c}.filled"), f"n_left_{c}": F.col(f"{c}.left"),
                                       f"n_outside_{c}": strange.select("n").scalar()})
    return outside.drop(*_GAPS)


@register("score", "ML13 ML15 E12")
def score(spark, sf_dir):
    t = model_table(spark, sf_dir)
    train = t.where(F.col("set") == "train")
    new = t.where(F.col("set") == "test")
    scored, _ = refit_and_score(train, new, FEATURES, LABEL, models.LinearSpec("enet", lam=0.001, alpha=0.5),
                                recipe=matrix.Recipe([matrix.Standardize(FEATURES)]), key=KEY)
    return scored.select(F.col(KEY).alias("Id"), r6("prediction", "prediction"))


@register("forest_importance", "ML11 ML8")
def forest_importance(spark, sf_dir):
    """Impurity importances of a random forest on the training rows, scaled to 0..100."""
    t = models.assemble(model_table(spark, sf_dir).where(F.col("set") == "train"), FEATURES)
    m = models.forest(FEATURES, LABEL, num_trees=20, mtry=3, min_node=5, max_depth=8).fit(t)
    imp = models.feature_importance(m, FEATURES, "forest", spark)
    return EV.scaled_importance(imp, "importance", by=["model"]).select("model", "variable", "importance", "scaled")
