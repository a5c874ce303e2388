"""Catalogue: missing-value reports and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import clean, impute, missing
from tabreg.plans.common import GAP_NUMERIC, GAPS_SQL, ORDERS_TAGGED_SQL, r2, r6
from tabreg.plans.registry import register
from tabreg.session import cut_lineage
from tabreg.sources.tables import SALES_COLUMNS, orders_tagged, sales_with_gaps

_ALL = SALES_COLUMNS


def _unpivot_counts_sql(cols):
    parts = [f"SELECT '{c}' AS variable, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
             f"count(*) AS n FROM {GAPS_SQL} g" for c in cols]
    return " UNION ALL ".join(parts)


@register("missing_share", "A1 R1 F7", sql=f"""
SELECT variable, n_missing, round(n_missing / n, 6) AS missing_share
FROM ({_unpivot_counts_sql(_ALL)}) t WHERE n_missing > 0
""")
def missing_share(spark, sf_dir):
    ms = missing.missing_share(sales_with_gaps(spark, sf_dir), _ALL)
    return ms.select("variable", "n_missing", r6("missing_share"))


_PAT = ["l_quantity", "l_discount", "l_tax", "p_size"]


@register("missing_pattern", "A2", sql=f"""
SELECT {', '.join(f'CAST({c} IS NULL AS BIGINT) AS {c}' for c in _PAT)},
       count(*) AS n_rows,
       CAST({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in _PAT)} AS BIGINT) AS n_missing_cols,
       0 AS is_margin
FROM {GAPS_SQL} g
GROUP BY ALL
UNION ALL
SELECT {', '.join(f'CAST(count(*) - count({c}) AS BIGINT) AS {c}' for c in _PAT)},
       CAST(NULL AS BIGINT) AS n_rows,
       CAST({' + '.join(f'(count(*) - count({c}))' for c in _PAT)} AS BIGINT) AS n_missing_cols,
       1 AS is_margin
FROM {GAPS_SQL} g
""")
def missing_pattern(spark, sf_dir):
    return missing.missing_pattern(sales_with_gaps(spark, sf_dir), _PAT)


@register("missing_columns", "P6", sql=f"""
SELECT variable, n_missing, n - n_missing AS n_present
FROM ({_unpivot_counts_sql(_ALL)}) t WHERE n_missing > 0
""")
def missing_columns(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir)
    cols = missing.columns_with_missing(g, _ALL)          # P6: names only
    sub = g.select(*cols)
    # F5 as conditional counts in one aggregate (one scan instead of two filters per column)
    wide = sub.agg(*[F.count_if(F.col(c).isNull()).alias(f"m|{c}") for c in cols],
                   *[F.count_if(F.col(c).isNotNull()).alias(f"p|{c}") for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"`m|{c}`").alias("n_missing"),
                 F.col(f"`p|{c}`").alias("n_present")) for c in cols])).alias("_s")).select("_s.*")


@register("joint_fill", "I1 F6 T9", sql=f"""
SELECT count(CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 1 END) AS n_joint,
       round(sum(CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 0 ELSE l_quantity END), 2) AS sum_quantity,
       round(sum(CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 0 ELSE l_tax END), 4) AS sum_tax,
       count(*) - count(CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 0 ELSE l_quantity END) AS n_null_quantity,
       count(*) - count(CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 0 ELSE l_tax END) AS n_null_tax
FROM {GAPS_SQL} g
""")
def joint_fill(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir)
    n_joint = clean.all_missing_rows(g, ["l_quantity", "l_tax", "l_tax"]).agg(F.count(F.lit(1)).alias("n")).scalar()
    f = missing.fill_when_all_missing(g, ["l_quantity", "l_tax", "l_tax"], {"l_quantity": 0.0, "l_tax": 0.0})
    return f.agg(n_joint.alias("n_joint"), r2(F.sum("l_quantity"), "sum_quantity"),
                 F.round(F.sum("l_tax"), 4).alias("sum_tax"),
                 F.count_if(F.col("l_quantity").isNull()).alias("n_null_quantity"),
                 F.count_if(F.col("l_tax").isNull()).alias("n_null_tax"))


_PAIR_SQL = f"""(
  SELECT CASE WHEN l_linenumber = 3 AND l_orderkey % 2 = 1 THEN NULL ELSE p_type END AS vtype,
         l_discount AS amount
  FROM {GAPS_SQL} g
)"""


@register("paired_fill", "I2 T3", sql=f"""
SELECT 'together' AS mode,
       count(CASE WHEN vt = 'NONE' THEN 1 END) AS n_none,
       round(sum(am), 4) AS sum_amount, count(*) - count(am) AS n_null_amount
FROM (SELECT CASE WHEN vtype IS NULL AND amount IS NULL THEN 'NONE' ELSE vtype END AS vt,
             CASE WHEN vtype IS NULL AND amount IS NULL THEN 0 ELSE amount END AS am FROM {_PAIR_SQL} p) a
UNION ALL
SELECT 'sequential' AS mode,
       count(CASE WHEN vt = 'NONE' THEN 1 END) AS n_none,
       round(sum(amount), 4) AS sum_amount, count(*) - count(amount) AS n_null_amount
FROM (SELECT CASE WHEN vtype IS NULL AND amount IS NULL THEN 'NONE' ELSE vtype END AS vt, amount
      FROM {_PAIR_SQL} p) b
""")
def paired_fill(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir).select(
        F.when((F.col("l_linenumber") == 3) & (F.col("l_orderkey") % 2 == 1), F.lit(None))
         .otherwise(F.col("p_type")).alias("vtype"), F.col("l_discount").alias("amount"))
    out = []
    for mode, seq in (("together", False), ("sequential", True)):
        f = missing.paired_fill(g, ["vtype", "amount"], {"vtype": "NONE", "amount": 0.0}, sequential=seq)
        out.append(f.agg(F.lit(mode).alias("mode"), F.count_if(F.col("vtype") == "NONE").alias("n_none"),
                         F.round(F.sum("amount"), 4).alias("sum_amount"),
                         F.count_if(F.col("amount").isNull()).alias("n_null_amount")))
    return out[0].unionByName(out[1])


@register("min_fill", "I3 I4 J2 A10", sql=f"""
WITH m AS (SELECT min(l_tax) AS min_tax, min(p_size) AS min_size FROM {GAPS_SQL} g),
f AS (
  SELECT CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN 0 ELSE l_quantity END AS q,
         CASE WHEN l_quantity IS NULL AND l_tax IS NULL THEN m.min_tax ELSE l_tax END AS t,
         CASE WHEN p_size IS NULL AND l_returnflag = 'N' THEN m.min_size ELSE p_size END AS s
  FROM {GAPS_SQL} g, m
)
SELECT round(sum(q), 2) AS sum_quantity, round(sum(t), 4) AS sum_tax, CAST(sum(s) AS BIGINT) AS sum_size,
       count(*) - count(t) AS n_null_tax, count(*) - count(s) AS n_null_size
FROM f
""")
def min_fill(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir)
    f = missing.fill_all_missing_with(g, ["l_quantity", "l_tax"], {"l_quantity": 0.0}, {"l_tax": "min"})
    f = missing.conditional_fill(f, "p_size", F.col("l_returnflag") == "N", missing.global_extreme(g, "p_size"))
    return f.agg(r2(F.sum("l_quantity"), "sum_quantity"), F.round(F.sum("l_tax"), 4).alias("sum_tax"),
                 F.sum("p_size").cast("long").alias("sum_size"),
                 F.count_if(F.col("l_tax").isNull()).alias("n_null_tax"),
                 F.count_if(F.col("p_size").isNull()).alias("n_null_size"))


@register("restore_label", "I8", sql=f"""
SELECT set, count(*) AS n, count(label) AS n_labelled, round(sum(label), 2) AS sum_label
FROM (SELECT set, CASE WHEN set <> 'test' THEN coalesce(o_totalprice, 0) END AS label
      FROM {ORDERS_TAGGED_SQL} o) t
GROUP BY set
""")
def restore_label(spark, sf_dir):
    o = orders_tagged(spark, sf_dir).withColumn("label", F.coalesce(F.col("o_totalprice"), F.lit(0.0)))
    r = missing.restore_label(o, "label")
    return r.groupBy("set").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("n_labelled"),
                                r2(F.sum("label"), "sum_label"))


def _impute_sql():
    cols = GAP_NUMERIC + ["prio_rank"]
    targets = ["l_quantity", "l_discount", "l_tax", "p_size"]
    base = (f"(SELECT *, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS prio_rank FROM {GAPS_SQL} g0)")
    parts = []
    for y in targets:
        for x in cols:
            if x == y:
                continue
            parts.append(
                f"SELECT '{y}' AS target, '{x}' AS predictor, nullif(corr({x}, {y}), 'NaN'::DOUBLE) AS rv, "
                f"nullif(corr({x}, CAST({y} IS NULL AS DOUBLE)), 'NaN'::DOUBLE) AS rm FROM {base} g")
    body = " UNION ALL ".join(parts)
    return (f"SELECT target, predictor, round(rv, 6) AS r_value, round(rm, 6) AS r_missing, "
            f"greatest(coalesce(abs(rv), 0), coalesce(abs(rm), 0)) > 0.1 AS selected FROM ({body}) t")


@register("impute_predictors", "I5", sql=_impute_sql())
def impute_predictors(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir).withColumn(
        "prio_rank", F.substring("o_orderpriority", 1, 1).cast("double"))
    ip = missing.impute_predictors(g, GAP_NUMERIC + ["prio_rank"], mincor=0.1)
    return ip.select("target", "predictor", r6("r_value"), r6("r_missing"), "selected")


@register("imputed_pairs", "I9", sql=f"""
SELECT imputed, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM (
  SELECT l_orderkey, l_tax IS NULL AS imputed FROM {GAPS_SQL} g) t GROUP BY imputed
""")
def imputed_pairs(spark, sf_dir):
    """Observed against imputed cells of one column over a key, filled by donor draws."""
    g = sales_with_gaps(spark, sf_dir).withColumn("row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    done = impute.donor_draw(cut_lineage(g.select("row_key", "l_orderkey", "l_tax")), "row_key", "l_tax")
    pairs = impute.imputed_pairs(done.where(F.col("l_tax").isNotNull()), "l_orderkey", "l_tax")
    return pairs.groupBy("imputed").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").cast("long").alias("key_sum"))
