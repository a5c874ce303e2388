"""Catalogue: derived features, level lumping, contrasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators import features as FT
from tabreg.plans.common import SALES_SQL, r6
from tabreg.plans.registry import register
from tabreg.sources.codebook import Codebook
from tabreg.sources.tables import sales, table


@register("flags_and_ratios", "E8 E9 E10 E11 E12", sql=f"""
WITH t AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_urgent,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS not_final,
         l_quantity + p_size AS total,
         l_quantity + 0.5 * p_size + 0.25 * l_tax AS weighted,
         CASE WHEN l_quantity - 1 <> 0 THEN l_extendedprice / (l_quantity - 1) END AS ratio,
         CASE WHEN l_discount = 0 THEN 0 ELSE 1 END AS has_discount,
         CASE WHEN l_extendedprice - 1000 > 0 THEN ln(l_extendedprice - 1000) END AS log_price,
         exp(ln(l_extendedprice)) AS round_trip
  FROM {SALES_SQL} s
)
SELECT is_urgent, not_final, has_discount, count(*) AS n, round(avg(total), 6) AS avg_total,
       round(avg(weighted), 6) AS avg_weighted, count(ratio) AS n_ratio, round(avg(ratio), 4) AS avg_ratio,
       count(log_price) AS n_log, round(avg(log_price), 6) AS avg_log, round(sum(round_trip), 2) AS sum_round_trip
FROM t GROUP BY ALL
""")
def flags_and_ratios(spark, sf_dir):
    s = sales(spark, sf_dir)
    f = FT.add_features(s, {
        "is_urgent": X.equals_flag("o_orderpriority", "1-URGENT"),                # E8
        "not_final": X.equals_flag("o_orderstatus", "F", when_equal=0),           # E8 (differs)
        "total": F.col("l_quantity") + F.col("p_size"),                           # E9 sum
        "weighted": X.weighted_sum({"l_quantity": 1.0, "p_size": 0.5, "l_tax": 0.25}),
        "ratio": X.safe_ratio(F.col("l_extendedprice"), F.col("l_quantity") - 1),  # E9 guarded
        "has_discount": X.presence_flag("l_discount"),                            # E10
        "log_price": X.log_positive(F.col("l_extendedprice") - 1000),             # E11
    })
    f = FT.log_label(f, "l_extendedprice", "log_ext")
    f = FT.back_transform(f, "log_ext", "round_trip")                             # E12
    return f.groupBy("is_urgent", "not_final", "has_discount").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("total"), "avg_total"), r6(F.avg("weighted"), "avg_weighted"),
        F.count("ratio").alias("n_ratio"), F.round(F.avg("ratio"), 4).alias("avg_ratio"),
        F.count("log_price").alias("n_log"), r6(F.avg("log_price"), "avg_log"),
        F.round(F.sum("round_trip"), 2).alias("sum_round_trip"))


@register("lump_levels", "L2", sql="""
WITH c AS (SELECT p_brand, count(*) AS cnt FROM part GROUP BY p_brand),
r AS (SELECT p_brand, rank() OVER (ORDER BY cnt DESC) AS rk FROM c),
k AS (SELECT 1 AS n_keep UNION ALL SELECT 2)
SELECT k.n_keep, CASE WHEN r.rk <= k.n_keep THEN p.p_brand ELSE 'Other' END AS level, count(*) AS n
FROM part p JOIN r ON p.p_brand = r.p_brand, k
GROUP BY ALL
""")
def lump_levels(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand")
    outs = []
    for n_keep in (1, 2):
        m = FT.LevelLumper(["p_brand"], n=n_keep).fit(p)
        outs.append(m.transform(p).groupBy(F.lit(n_keep).alias("n_keep"), F.col("p_brand").alias("level"))
                    .agg(F.count(F.lit(1)).alias("n")))
    return outs[0].unionByName(outs[1])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("contrast_columns", "L5 T21", sql=f"""
WITH t AS (
  SELECT o_orderpriority, p_type,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 3 AS x
  FROM {SALES_SQL} s
)
SELECT o_orderpriority AS level, count(*) AS n,
       round(min(x / sqrt(10)), 6) AS o_orderpriority_L,
       round(min((x * x - 2) / sqrt(14)), 6) AS o_orderpriority_Q,
       round(min(CASE x WHEN -2 THEN -1 WHEN -1 THEN 2 WHEN 0 THEN 0 WHEN 1 THEN -2 ELSE 1 END / sqrt(10)), 6)
         AS o_orderpriority_C,
       round(min(CASE x WHEN -2 THEN 1 WHEN -1 THEN -4 WHEN 0 THEN 6 WHEN 1 THEN -4 ELSE 1 END / sqrt(70)), 6)
         AS o_orderpriority_4,
       {', '.join(f"CAST(sum(CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END) AS DOUBLE) AS p_type_{v}"
                  for v in ['LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])}
FROM t GROUP BY o_orderpriority
""")
def contrast_columns(spark, sf_dir):
    s = sales(spark, sf_dir).select("o_orderpriority", "p_type")
    s = s.withColumn("level", F.col("o_orderpriority"))
    enc = FT.ContrastEncoder(nominal=["p_type"], ordinal=["o_orderpriority"],
                             levels={"o_orderpriority": _PRIORITIES}).fit(s)
    e = enc.transform(s)
    dummies = [c for c in enc.output_columns() if c.startswith("p_type_")]
    poly = [c for c in enc.output_columns() if c.startswith("o_orderpriority_")]
    return e.groupBy("level").agg(F.count(F.lit(1)).alias("n"),
                                  *[r6(F.min(c), c) for c in poly],
                                  *[F.sum(c).alias(c) for c in dummies])


@register("level_index", "L5", sql="""
WITH d AS (SELECT o_custkey, dense_rank() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) - 1 AS i FROM orders WHERE o_custkey IS NOT NULL),
n AS (SELECT count(DISTINCT o_custkey) AS levels FROM orders)
SELECT CAST(i % 10 AS INTEGER) AS last_digit, count(*) AS n, CAST(sum(i) AS BIGINT) AS index_sum, any_value(levels) AS levels
FROM d, n GROUP BY ALL
""")
def level_index(spark, sf_dir):
    """Places of the levels of a column with many of them, kept and applied as a table."""
    o = table(spark, sf_dir, "orders").select("o_custkey")
    m = FT.LevelIndexer(["o_custkey"]).fit(o)
    n = m.levels.agg(F.count(F.lit(1)).alias("levels")).select("levels").scalar()
    out = m.transform(o).where(F.col("o_custkey_index").isNotNull())
    return out.groupBy((F.col("o_custkey_index") % 10).cast("int").alias("last_digit")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_custkey_index").cast("long").alias("index_sum")).withColumn("levels", n)


@register("unused_levels", "L4 L6", sql="""
WITH cb(level, rank) AS (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('0-NEVER', 4),
                                ('4-NOT SPECIFIED', 5), ('5-LOW', 6))
SELECT level, CAST(row_number() OVER (ORDER BY rank) AS INTEGER) AS rank
FROM cb WHERE level IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
                        OR o_orderpriority <> '2-HIGH')
""")
def unused_levels(spark, sf_dir):
    cb = Codebook(ordered={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "0-NEVER",
                                               "4-NOT SPECIFIED", "5-LOW"]}).to_frame(spark)
    o = table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") != "F") | (F.col("o_orderpriority") != "2-HIGH"))
    out = FT.drop_unused_levels(cb, o, "o_orderpriority")
    return out.select("level", "rank")
