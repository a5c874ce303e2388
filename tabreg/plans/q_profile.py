"""Catalogue: profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import profile
from tabreg.plans.common import GAPS_SQL, SALES_FACTORS, SALES_NUMERIC, SALES_SQL, r6
from tabreg.plans.registry import register
from tabreg.sources.tables import sales, sales_with_gaps


def _melt_sql(cols, src, cast="DOUBLE", keep=""):
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS variable, CAST({c} AS {cast}) AS value FROM {src} s"
                              for c in cols)


_SKIM_NUM = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "l_extendedprice"]


@register("skim_numeric", "A3", sql=f"""
SELECT variable, CAST(count(*) - count(value) AS BIGINT) AS n_missing,
       round(count(value) / count(*), 6) AS complete_rate,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd,
       round(quantile_cont(value, 0.0), 6) AS p0, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
       round(quantile_cont(value, 1.0), 6) AS p100
FROM ({_melt_sql(_SKIM_NUM, GAPS_SQL)}) m GROUP BY variable
""")
def skim_numeric(spark, sf_dir):
    sk = profile.skim_numeric(sales_with_gaps(spark, sf_dir), _SKIM_NUM)
    return sk.select("variable", "n_missing", *[r6(c) for c in
                                                ["complete_rate", "mean", "sd", "p0", "p25", "p50", "p75", "p100"]])


_FACT = SALES_FACTORS


@register("skim_factor", "A3", sql=f"""
WITH m AS ({_melt_sql(_FACT, SALES_SQL, 'VARCHAR')}),
c AS (SELECT variable, value AS level, count(*) AS n FROM m WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS rk FROM c),
tot AS (SELECT variable, count(*) AS n_rows, count(value) AS n_complete FROM m GROUP BY variable)
SELECT tot.variable, CAST(n_rows - n_complete AS BIGINT) AS n_missing,
       round(n_complete / n_rows, 6) AS complete_rate,
       (SELECT count(*) FROM c WHERE c.variable = tot.variable) AS n_unique,
       (SELECT string_agg(level || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY rk) FROM r
         WHERE r.variable = tot.variable AND rk <= 4) AS top_counts
FROM tot
""")
def skim_factor(spark, sf_dir):
    sk = profile.skim_factor(sales(spark, sf_dir), _FACT)
    return sk.select("variable", "n_missing", r6("complete_rate"), "n_unique", "top_counts")


@register("level_counts", "A5 R2", sql=f"""
SELECT variable, value AS level, count(*) AS n
FROM ({_melt_sql(_FACT, SALES_SQL, 'VARCHAR')}) m GROUP BY ALL
""")
def level_counts(spark, sf_dir):
    return profile.level_counts(sales(spark, sf_dir), _FACT)


_NZV_COLS = SALES_FACTORS + ["l_linenumber", "p_size", "nearly_const"]


def _nzv_source_sql():
    return (f"(SELECT *, CASE WHEN l_orderkey % 97 = 0 THEN 'rare' ELSE 'common' END AS nearly_const "
            f"FROM {SALES_SQL} s0)")


@register("near_zero_variance", "A6 W2 M2 T11", sql=f"""
WITH m AS ({_melt_sql(_NZV_COLS, _nzv_source_sql(), 'VARCHAR')}),
c AS (SELECT variable, value AS level, count(*) AS n FROM m GROUP BY ALL),
t AS (SELECT variable, max(n) AS top_n, count(*) AS n_unique,
             arg_max(level, (n, level)) AS top_level FROM c GROUP BY variable),
s AS (SELECT c.variable, max(c.n) AS second_n FROM c JOIN t ON c.variable = t.variable
      WHERE c.level <> t.top_level GROUP BY c.variable),
nr AS (SELECT count(*) AS n FROM {SALES_SQL} s1)
SELECT t.variable,
       round(CASE WHEN n_unique <= 1 THEN 0.0 ELSE top_n / second_n END, 6) AS freq_ratio,
       round(100.0 * n_unique / nr.n, 6) AS percent_unique,
       n_unique <= 1 AS zero_var,
       ((CASE WHEN n_unique <= 1 THEN 0.0 ELSE top_n / second_n END) > 19.0
         AND 100.0 * n_unique / nr.n <= 10.0) OR n_unique <= 1 AS nzv
FROM t LEFT JOIN s ON t.variable = s.variable, nr
""")
def near_zero_variance(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn(
        "nearly_const", F.when(F.col("l_orderkey") % 97 == 0, "rare").otherwise("common"))
    nz = profile.near_zero_variance(s, _NZV_COLS, freq_cut=95 / 5, unique_cut=10)
    return nz.select("variable", r6("freq_ratio"), r6("percent_unique"), "zero_var", "nzv")


def _skew_sql(cols, src):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS variable,
          (SELECT avg(power({c} - mu, 3)) / power(stddev_samp({c}), 3)
             FROM {src} x, (SELECT avg({c}) AS mu FROM {src} y) u) AS skew""")
    return " UNION ALL ".join(parts)


@register("skewness", "A7 F8 O1 T12", sql=f"""
SELECT variable, round(skew, 6) AS skew,
       CASE WHEN abs(skew) > 1 THEN 'severe' WHEN abs(skew) > 0.5 THEN 'moderate' ELSE 'none' END AS skew_class
FROM ({_skew_sql(SALES_NUMERIC + ['l_extendedprice', 'o_totalprice'], SALES_SQL)}) t
""")
def skewness(spark, sf_dir):
    sk = profile.skewness(sales(spark, sf_dir), SALES_NUMERIC + ["l_extendedprice", "o_totalprice"])
    return sk.select("variable", r6("skew"), "skew_class")


_HIST_COLS = ["l_extendedprice", "l_quantity", "p_retailprice"]


def _hist_sql(group=None, density=False):
    g = f"{group}, " if group else ""
    src = _melt_sql(_HIST_COLS, SALES_SQL, "DOUBLE", keep=group or "")
    base = f"""
WITH m AS ({src}),
r AS (SELECT variable, min(value) AS lo, max(value) AS hi,
             CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) / 29.0 END AS w
      FROM m GROUP BY variable),
b AS (SELECT {g}m.variable, r.lo, r.w,
             CAST(coalesce(least(greatest(ceil((value - r.lo) / r.w + 0.5) - 1, 0), 29), 0) AS INTEGER) AS bin
      FROM m JOIN r ON m.variable = r.variable)"""
    if not density:
        return base + f"""
SELECT {g}variable, bin, count(*) AS n, round(min(lo + bin * coalesce(w, 0)), 6) AS center
FROM b GROUP BY ALL"""
    return base + f"""
, tot AS (SELECT {g}variable, count(*) AS n_group FROM m GROUP BY ALL)
SELECT b.{group}, b.variable, bin, count(*) AS n, round(min(lo + bin * coalesce(w, 0)), 6) AS center,
       round(count(*) / (min(tot.n_group) * min(b.w)), 9) AS density
FROM b JOIN tot ON b.{group} = tot.{group} AND b.variable = tot.variable
GROUP BY b.{group}, b.variable, bin"""


@register("histogram", "A8", sql=_hist_sql())
def histogram(spark, sf_dir):
    h = profile.histogram(sales(spark, sf_dir), _HIST_COLS, bins=30)
    return h.select("variable", "bin", "n", r6("center"))


@register("binned_density", "A21", sql=_hist_sql("l_returnflag", density=True))
def binned_density(spark, sf_dir):
    d = profile.binned_density(sales(spark, sf_dir), _HIST_COLS, "l_returnflag", bins=30)
    return d.select("l_returnflag", "variable", "bin", "n", r6("center"),
                    F.round("density", 9).alias("density"))


@register("box_stats", "A9", sql=f"""
WITH q AS (
  SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
         quantile_cont(l_extendedprice, 0.75) AS q3
  FROM {SALES_SQL} s GROUP BY l_returnflag
)
SELECT s.l_returnflag, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr, count(*) AS n,
       round(min(CASE WHEN l_extendedprice >= q1 - 1.5 * (q3 - q1) THEN l_extendedprice END), 6) AS lower_whisker,
       round(max(CASE WHEN l_extendedprice <= q3 + 1.5 * (q3 - q1) THEN l_extendedprice END), 6) AS upper_whisker,
       count(CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1) THEN 1 END)
         AS n_outliers
FROM {SALES_SQL} s JOIN q ON s.l_returnflag = q.l_returnflag
GROUP BY s.l_returnflag, q1, med, q3
""")
def box_stats(spark, sf_dir):
    b = profile.box_stats(sales(spark, sf_dir), "l_extendedprice", ["l_returnflag"])
    return b.select("l_returnflag", *[r6(c) for c in ["q1", "median", "q3", "iqr"]], "n",
                    r6("lower_whisker"), r6("upper_whisker"), "n_outliers")


@register("best_row", "O2 ML12", sql=f"""
SELECT p_type, arg_min(p_brand, (avg_price, p_brand)) AS p_brand, round(min(avg_price), 6) AS avg_price
FROM (SELECT p_type, p_brand, avg(l_extendedprice) AS avg_price FROM {SALES_SQL} s GROUP BY ALL) t
GROUP BY p_type
""")
def best_row(spark, sf_dir):
    g = sales(spark, sf_dir).groupBy("p_type", "p_brand").agg(F.avg("l_extendedprice").alias("avg_price"))
    b = profile.best_row(g, "avg_price", by=["p_type"])
    return b.select("p_type", "p_brand", r6("avg_price"))
