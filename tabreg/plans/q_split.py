"""Catalogue: stratified split and folds, row selection by assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import split
from tabreg.plans.registry import register
from tabreg.sources.tables import table

SEED = 12345

# break points at 0, .25, .5, .75, 1 (type 7); bin = 1 + #interior breaks below the label;
# position inside the bin by md5(seed|key), then key
_BINS_SQL = f"""
q AS (SELECT quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]) AS b FROM orders),
bn AS (SELECT o_orderkey, o_totalprice,
              1 + CAST(o_totalprice > q.b[2] AS INTEGER) + CAST(o_totalprice > q.b[3] AS INTEGER)
                + CAST(o_totalprice > q.b[4] AS INTEGER) AS bin
       FROM orders, q),
rk AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), o_orderkey)
                 AS pos,
              count(*) OVER (PARTITION BY bin) AS n_bin
       FROM bn)"""


@register("stratified_split", "W4 X1", sql=f"""
WITH {_BINS_SQL}
SELECT CAST(bin AS INTEGER) AS bin, n_bin,
       count(CASE WHEN pos <= ceil(n_bin * 0.8) THEN 1 END) AS n_train,
       count(CASE WHEN pos > ceil(n_bin * 0.8) THEN 1 END) AS n_holdout,
       CAST(sum(CASE WHEN pos <= ceil(n_bin * 0.8) THEN o_orderkey ELSE 0 END) AS BIGINT) AS key_sum_train
FROM rk GROUP BY bin, n_bin
""")
def stratified_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    a = split.stratified_split(o, "o_orderkey", "o_totalprice", p=0.8, seed=SEED)
    return a.groupBy(F.col("bin").cast("int").alias("bin"), "n_bin").agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "holdout").alias("n_holdout"),
        F.sum(F.when(F.col("split") == "train", F.col("o_orderkey")).otherwise(0)).cast("long").alias("key_sum_train"))


@register("stratified_folds", "X2 X4 W4", sql=f"""
WITH {_BINS_SQL}
SELECT CAST(bin AS INTEGER) AS bin, CAST((pos - 1) % 10 + 1 AS INTEGER) AS fold, count(*) AS n,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM rk GROUP BY ALL
""")
def stratified_folds(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    f = split.stratified_folds(o, "o_orderkey", "o_totalprice", k=10, seed=SEED)
    return f.groupBy(F.col("bin").cast("int").alias("bin"), "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("long").alias("key_sum"))


@register("split_rows", "J1 T18", sql=f"""
WITH {_BINS_SQL},
a AS (SELECT o_orderkey, CASE WHEN pos <= ceil(n_bin * 0.8) THEN 'train' ELSE 'holdout' END AS split FROM rk)
SELECT part, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS sum_price FROM (
  SELECT 'train' AS part, o.* FROM orders o WHERE o_orderkey IN (SELECT o_orderkey FROM a WHERE split = 'train')
  UNION ALL
  SELECT 'holdout' AS part, o.* FROM orders o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a WHERE split = 'train')
) t GROUP BY ALL
""")
def split_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = split.stratified_split(o, "o_orderkey", "o_totalprice", p=0.8, seed=SEED)
    train = split.keep_rows(o, a, "o_orderkey", F.col("split") == "train").withColumn("part", F.lit("train"))
    hold = split.drop_rows(o, a, "o_orderkey", F.col("split") == "train").withColumn("part", F.lit("holdout"))
    u = train.unionByName(hold)
    return u.groupBy("part", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                                   F.round(F.sum("o_totalprice"), 2).alias("sum_price"))
