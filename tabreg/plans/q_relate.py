"""Catalogue: relating columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import relate
from tabreg.plans.common import SALES_NUMERIC, SALES_SQL, r6
from tabreg.plans.registry import register
from tabreg.sources.tables import sales

_CORR_COLS = SALES_NUMERIC + ["l_extendedprice"]


def _corr_sql():
    parts = []
    for x in _CORR_COLS:
        for y in _CORR_COLS:
            r = "CASE WHEN count(*) > 0 THEN 1.0 END" if x == y else f"round(corr({x}, {y}), 6)"
            parts.append(f"SELECT '{x}' AS var_x, '{y}' AS var_y, {r} AS r FROM {SALES_SQL} s")
    return " UNION ALL ".join(parts)


@register("corr_matrix", "A11", sql=_corr_sql())
def corr_matrix(spark, sf_dir):
    return relate.corr_matrix(sales(spark, sf_dir), _CORR_COLS).select("var_x", "var_y", r6("r"))


_SCREEN = SALES_NUMERIC + ["o_totalprice", "net_price", "gross_price"]
_SCREEN_SQL = (f"(SELECT *, l_extendedprice * (1 - l_discount) AS net_price, "
               f"l_extendedprice * (1 + l_tax) AS gross_price FROM {SALES_SQL} s0)")


@register("corr_screen", "A12 F8 O1", sql=" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS variable, round(corr({c}, l_extendedprice), 6) AS r FROM {_SCREEN_SQL} s) "
    f"WHERE abs(r) >= 0.5" for c in _SCREEN))
def corr_screen(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount"))) \
                            .withColumn("gross_price", F.col("l_extendedprice") * (1 + F.col("l_tax")))
    sc = relate.corr_screen(s, _SCREEN, "l_extendedprice", 0.5)
    return sc.select("variable", r6("r"))


# the factor stand-ins: all categorical columns of ``sales`` plus the integer quantity as
# a 50-level factor whose level means lie close together (overlapping HSD letters)
_FACTORS = ["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "p_type", "qty"]


def _factor_source(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("qty", F.col("l_quantity").cast("int").cast("string")) \
                               .withColumn("price_k", F.col("l_extendedprice") / 1000)


_FSRC_SQL = (f"(SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty, "
             f"l_extendedprice / 1000 AS price_k FROM {SALES_SQL} s0)")
_MELT_F = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level, price_k AS y "
                             f"FROM {_FSRC_SQL} s" for c in _FACTORS)
_LS_SQL = f"""ls AS (SELECT variable, level, count(*) AS n, avg(y) AS mean,
                    coalesce(var_samp(y), 0) AS var FROM ({_MELT_F}) m GROUP BY ALL)"""


@register("anova_oneway", "A13 R2", sql=f"""
WITH {_LS_SQL},
g AS (SELECT variable, count(*) AS k, sum(n) AS nn, sum(n * mean) / sum(n) AS grand FROM ls GROUP BY variable),
a AS (SELECT ls.variable, g.k, g.nn, sum(n * power(mean - grand, 2)) AS ssb, sum((n - 1) * var) AS ssw
      FROM ls JOIN g ON ls.variable = g.variable GROUP BY ls.variable, g.k, g.nn)
SELECT variable, CAST(k AS BIGINT) AS k, CAST(nn AS BIGINT) AS n, CAST(k - 1 AS BIGINT) AS df_between,
       CAST(nn - k AS BIGINT) AS df_within, round(ssb, 4) AS ss_between, round(ssw, 4) AS ss_within,
       round(ssb / (k - 1), 6) AS ms_between, round(ssw / (nn - k), 6) AS ms_within,
       round((ssb / (k - 1)) / (ssw / (nn - k)), 6) AS f
FROM a
""")
def anova_oneway(spark, sf_dir):
    a = relate.anova_oneway(_factor_source(spark, sf_dir), "price_k", _FACTORS)
    return a.select("variable", "k", "n", "df_between", "df_within",
                    F.round("ss_between", 4).alias("ss_between"), F.round("ss_within", 4).alias("ss_within"),
                    r6("ms_between"), r6("ms_within"), r6("f"))


HSD_Q = 3.5   # the studentized-range critical value, given to both sides


def _hsd_sql(q):
    return f"""
WITH {_LS_SQL},
g AS (SELECT variable, count(*) AS k, sum(n) AS nn, count(*) / sum(1.0 / n) AS n_h FROM ls GROUP BY variable),
av AS (SELECT ls.variable, sum((n - 1) * var) / (g.nn - g.k) AS msw, g.n_h FROM ls JOIN g ON ls.variable = g.variable
       GROUP BY ls.variable, g.nn, g.k, g.n_h),
lv AS (SELECT ls.*, {q} * sqrt(av.msw / av.n_h) AS hsd,
              row_number() OVER (PARTITION BY ls.variable ORDER BY mean DESC, level) AS pos
       FROM ls JOIN av ON ls.variable = av.variable),
rc AS (SELECT a.*, (SELECT count(*) FROM lv b WHERE b.variable = a.variable AND b.mean >= a.mean - a.hsd) AS reach
       FROM lv a),
kp AS (SELECT *, reach > coalesce(max(reach) OVER (PARTITION BY variable ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kept FROM rc),
iv AS (SELECT variable, pos AS s, reach AS e, row_number() OVER (PARTITION BY variable ORDER BY pos) AS idx
       FROM kp WHERE kept)"""


@register("hsd_letters", "A14 W5 (q given)", sql=_hsd_sql(HSD_Q) + """
SELECT kp.variable, kp.level, kp.n, round(kp.mean, 6) AS mean, CAST(kp.pos AS INTEGER) AS position,
       round(kp.hsd, 6) AS hsd,
       (SELECT string_agg(CASE WHEN idx <= 26 THEN chr(CAST(96 + idx AS INTEGER))
                               WHEN idx <= 52 THEN chr(CAST(38 + idx AS INTEGER))
                               ELSE 'a' || CAST(idx AS VARCHAR) END, '' ORDER BY idx)
          FROM iv WHERE iv.variable = kp.variable AND iv.s <= kp.pos AND iv.e >= kp.pos) AS groups
FROM kp
""")
def hsd_letters(spark, sf_dir):
    h = relate.hsd_groups(_factor_source(spark, sf_dir), "price_k", _FACTORS, q=HSD_Q)
    return h.select("variable", "level", "n", r6("mean"), "position", r6("hsd"), "groups")


# The studentized range without a special function: the normal distribution by cumulated trapezoids on a
# grid of 0.01, P(range <= w) by a sum over the grid, the quantile between the two grid values of w
# around 0.95, then the first-order correction for the error degrees of freedom.
_Q_SQL = """
z AS (SELECT i, exp(-0.5 * pow(i / 100.0, 2)) / sqrt(2 * pi()) AS phi FROM range(-900, 901) r(i)),
nc AS (SELECT i, phi, sum(phi) OVER (ORDER BY i) * 0.01 - phi * 0.005 AS cdf FROM z),
ks AS (SELECT DISTINCT k FROM g),
pr AS (SELECT k, w, k * 0.01 * sum(a.phi * pow(greatest(a.cdf - coalesce(b.cdf, 0), 0), k - 1)) AS p
       FROM ks, range(100, 801) r(w) JOIN nc a ON true LEFT JOIN nc b ON b.i = a.i - w GROUP BY k, w),
qi AS (SELECT k, min(w) AS w1 FROM pr WHERE p >= 0.95 GROUP BY k),
qq AS (SELECT qi.k, (w1 - 1 + (0.95 - lo.p) / (hi.p - lo.p)) / 100 AS q FROM qi JOIN pr lo ON lo.k = qi.k AND lo.w = w1 - 1
       JOIN pr hi ON hi.k = qi.k AND hi.w = w1)"""


@register("hsd_letters_alpha", "A14 W5 (q from alpha)", sql=_hsd_sql("qq.q").replace(
    "JOIN av ON ls.variable = av.variable)", "JOIN av ON ls.variable = av.variable JOIN g g2 ON g2.variable = ls.variable JOIN qq ON qq.k = g2.k)"
).replace("av AS (SELECT", _Q_SQL.strip() + ",\nav AS (SELECT", 1) + """
SELECT kp.variable, kp.level, kp.n, round(kp.mean, 6) AS mean, CAST(kp.pos AS INTEGER) AS position, round(kp.hsd, 1) AS hsd,
       (SELECT string_agg(CASE WHEN idx <= 26 THEN chr(CAST(96 + idx AS INTEGER))
                               WHEN idx <= 52 THEN chr(CAST(38 + idx AS INTEGER))
                               ELSE '[' || CAST(idx AS VARCHAR) || ']' END, '' ORDER BY idx)
          FROM iv WHERE iv.variable = kp.variable AND iv.s <= kp.pos AND iv.e >= kp.pos) AS groups
FROM kp
""")
def hsd_letters_alpha(spark, sf_dir):
    """Letters with q = studentized-range quantile at 1 - alpha for each factor's (k, df)."""
    h = relate.hsd_groups(_factor_source(spark, sf_dir), "price_k", _FACTORS, alpha=0.05)
    return h.select("variable", "level", "n", r6("mean"), "position", F.round("hsd", 1).alias("hsd"), "groups")


@register("hsd_intervals", "J6 A14 (q given)", sql=_hsd_sql(HSD_Q) + """
SELECT a.variable, a.level, CAST(a.pos AS INTEGER) AS position, round(a.mean, 6) AS mean, round(a.hsd, 6) AS hsd,
       (SELECT count(*) FROM rc b WHERE b.variable = a.variable AND b.reach < a.pos) AS n_above,
       CASE WHEN a.reach < g.k THEN CAST(a.reach + 1 AS INTEGER) END AS first_below, CAST(g.k - a.reach AS BIGINT) AS n_below
FROM rc a JOIN g ON g.variable = a.variable
""")
def hsd_intervals(spark, sf_dir):
    """The levels from which a level differs, as two runs of positions: one row a level."""
    p = relate.hsd_intervals(_factor_source(spark, sf_dir), "price_k", _FACTORS, q=HSD_Q)
    return p.select("variable", "level", "position", r6("mean"), r6("hsd"), "n_above", "first_below", "n_below")


@register("hsd_pairs", "J6 (q given)", sql=_hsd_sql(HSD_Q) + """
SELECT a.variable, a.level AS level_a, b.level AS level_b, round(a.mean - b.mean, 6) AS diff,
       round(a.hsd, 6) AS hsd, (a.mean - b.mean) > a.hsd AS significant
FROM lv a JOIN lv b ON a.variable = b.variable AND a.pos < b.pos
""")
def hsd_pairs(spark, sf_dir):
    p = relate.hsd_pairs(_factor_source(spark, sf_dir), "price_k", _FACTORS, q=HSD_Q)
    return p.select("variable", "level_a", "level_b", r6("diff"), r6("hsd"), "significant")


@register("hsd_label_rows", "J4", sql=_hsd_sql(HSD_Q) + f""",
lab AS (SELECT kp.level AS l_returnflag,
       (SELECT string_agg(CASE WHEN idx <= 26 THEN chr(CAST(96 + idx AS INTEGER)) ELSE 'z' END, '' ORDER BY idx)
          FROM iv WHERE iv.variable = kp.variable AND iv.s <= kp.pos AND iv.e >= kp.pos) AS groups
        FROM kp WHERE kp.variable = 'l_returnflag')
SELECT s.l_returnflag, lab.groups, count(*) AS n
FROM {_FSRC_SQL} s LEFT JOIN lab ON s.l_returnflag = lab.l_returnflag
GROUP BY ALL
""")
def hsd_label_rows(spark, sf_dir):
    src = _factor_source(spark, sf_dir)
    g = relate.hsd_groups(src, "price_k", _FACTORS, q=HSD_Q)
    lab = relate.label_rows(src, g, "l_returnflag")
    return lab.groupBy("l_returnflag", "groups").agg(F.count(F.lit(1)).alias("n"))


@register("simple_fit", "A15", sql=" UNION ALL ".join(f"""
SELECT '{x}' AS variable, CAST(regr_count(l_extendedprice, {x}) AS BIGINT) AS n,
       round(regr_slope(l_extendedprice, {x}), 6) AS slope,
       round(regr_intercept(l_extendedprice, {x}), 4) AS intercept,
       round(regr_r2(l_extendedprice, {x}), 6) AS r2,
       round(regr_sxx(l_extendedprice, {x}), 2) AS sxx,
       round(regr_avgx(l_extendedprice, {x}), 6) AS mean_x,
       round(sqrt(regr_syy(l_extendedprice, {x}) * (1 - regr_r2(l_extendedprice, {x}))
                  / (regr_count(l_extendedprice, {x}) - 2)), 4) AS sigma
FROM {SALES_SQL} s""" for x in ["l_quantity", "p_retailprice", "l_discount"]))
def simple_fit(spark, sf_dir):
    f = relate.simple_fit(sales(spark, sf_dir), "l_extendedprice", ["l_quantity", "p_retailprice", "l_discount"])
    return f.select("variable", "n", r6("slope"), F.round("intercept", 4).alias("intercept"), r6("r2"),
                    F.round("sxx", 2).alias("sxx"), r6("mean_x"), F.round("sigma", 4).alias("sigma"))


@register("fit_band", "A15", sql=" UNION ALL ".join(f"""
SELECT '{x}' AS variable, round(v, 6) AS x, round(b0 + b1 * v, 4) AS fit, round(b0 + b1 * v - h, 3) AS lower, round(b0 + b1 * v + h, 3) AS upper
FROM (SELECT *, lo + (hi - lo) * i / 79.0 AS v,
             (1.959963984540054 + (pow(1.959963984540054, 3) + 1.959963984540054) / (4 * (n - 2))) * s
             * sqrt(1 / n + pow(lo + (hi - lo) * i / 79.0 - mx, 2) / sxx) AS h
      FROM (SELECT regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0, regr_count(y, x)::DOUBLE AS n, regr_avgx(y, x) AS mx,
                   regr_sxx(y, x) AS sxx, min(x) AS lo, max(x) AS hi,
                   sqrt(regr_syy(y, x) * (1 - regr_r2(y, x)) / (regr_count(y, x) - 2)) AS s
            FROM (SELECT l_extendedprice / 1000 AS y, CAST({x} AS DOUBLE) AS x FROM {SALES_SQL} s0)), range(0, 80) r(i))"""
    for x in ["l_quantity", "l_discount"]))
def fit_band(spark, sf_dir):
    """The fitted line and its 95 % band at 80 values of each x."""
    s = sales(spark, sf_dir).withColumn("price_k", F.col("l_extendedprice") / 1000)
    b = relate.fit_band(s, "price_k", ["l_quantity", "l_discount"])
    return b.select("variable", r6("x"), F.round("fit", 4).alias("fit"), F.round("lower", 3).alias("lower"),
                    F.round("upper", 3).alias("upper"))
