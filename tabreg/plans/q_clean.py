"""Catalogue: sources, codebook reconciliation, recodes, filters (S2 S6 U1 U3 P1-P10 E1-E7
J3 L3 L6 F1-F9 A4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators import clean
from tabreg.plans.common import GAPS_SQL, SALES_SQL, r2, r6
from tabreg.plans.registry import register
from tabreg.session import scratch_path
from tabreg.sources import io
from tabreg.sources.codebook import Codebook, relevel_frame, rename_level_frame
from tabreg.sources.tables import orders_tagged, sales, sales_with_gaps, table

# Codebook used by the stand-in queries (a deliberately incomplete one: '5-LOW' and some
# flag values are missing so that reconciliation and violations have work to do).
PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
STAND_IN_CODEBOOK = Codebook(
    ordered={"o_orderpriority": PRIORITY_LEVELS},
    unordered={"l_returnflag": ["A", "R"], "l_linestatus": ["O"], "o_orderstatus": ["F", "O"]},
)


@register("union_tagged", "S2 U1 P1 P2 F4", sql=f"""
SELECT set, o_orderstatus, count(*) AS n, count(price) AS n_labelled,
       round(sum(price), 2) AS sum_price
FROM (
  SELECT 'train' AS set, o_orderstatus, o_totalprice AS price FROM orders WHERE o_orderkey % 5 <> 0
  UNION ALL
  SELECT 'test' AS set, o_orderstatus, CAST(NULL AS DOUBLE) AS price FROM orders WHERE o_orderkey % 5 = 0
) t
GROUP BY set, o_orderstatus
""")
def union_tagged(spark, sf_dir):
    o = orders_tagged(spark, sf_dir)
    train = io.tag_set(o.where(F.col("set") == "train").drop("set"), "train")
    test = io.tag_set(o.where(F.col("set") == "test").drop("set", "o_totalprice"), "test", label="o_totalprice")
    u = io.union_by_name([train, test])
    u = clean.rename_columns(u, {"o_totalprice": "price"})
    u = clean.lead_then_sorted(u, ["set", "o_orderkey", "price"])
    return u.groupBy("set", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count("price").alias("n_labelled"), r2(F.sum("price"), "sum_price"))


@register("codebook_reconcile", "S6 P9 P10 E3 L3", sql="""
SELECT level, rank, count(*) AS n
FROM (
  SELECT CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED')
              THEN o_orderpriority ELSE 'none' END AS level,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
                   WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 0 END AS INTEGER) AS rank
  FROM orders
) t
GROUP BY level, rank
""")
def codebook_reconcile(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    rec = clean.reconcile(o, STAND_IN_CODEBOOK, ["o_orderpriority"], fills={"o_orderpriority": "none"})
    return rec.groupBy(F.col("o_orderpriority").alias("level"),
                       F.col("o_orderpriority_rank").alias("rank")).agg(F.count(F.lit(1)).alias("n"))


@register("codebook_lookup", "J3 L3 L6 S6", sql="""
WITH cb(column_name, kind, rank, level) AS (
  VALUES ('o_orderpriority','ordered',1,'1-URGENT'), ('o_orderpriority','ordered',2,'2-HIGH'),
         ('o_orderpriority','ordered',3,'3-MEDIUM'), ('o_orderpriority','ordered',4,'4-NOT SPECIFIED'),
         ('l_returnflag','unordered',1,'A'), ('l_returnflag','unordered',2,'R'),
         ('l_linestatus','unordered',1,'O'),
         ('o_orderstatus','unordered',1,'F'), ('o_orderstatus','unordered',2,'O')
),
cb2 AS (
  SELECT column_name,
         CASE WHEN column_name = 'o_orderstatus' AND level = 'F' THEN 'FINISHED' ELSE level END AS level,
         CASE WHEN column_name = 'o_orderpriority' AND level = '3-MEDIUM' THEN 1
              WHEN column_name = 'o_orderpriority' AND level = '1-URGENT' THEN 2
              WHEN column_name = 'o_orderpriority' AND level = '2-HIGH' THEN 3
              ELSE rank END AS rank
  FROM cb
),
m AS (
  SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value FROM orders
  UNION ALL SELECT 'o_orderstatus', CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE o_orderstatus END FROM orders
)
SELECT m.column_name AS column_name, m.value AS level, CAST(cb2.rank AS INTEGER) AS rank, count(*) AS n
FROM m LEFT JOIN cb2 ON m.column_name = cb2.column_name AND m.value = cb2.level
GROUP BY m.column_name, m.value, cb2.rank
""")
def codebook_lookup(spark, sf_dir):
    """Melted form: level counts joined to the (re-levelled, renamed) codebook table."""
    cb = STAND_IN_CODEBOOK.to_frame(spark)
    cb = rename_level_frame(cb, "o_orderstatus", "F", "FINISHED")          # L6
    cb = relevel_frame(cb, "o_orderpriority", ["3-MEDIUM"])                 # L3
    o = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.when(F.col("o_orderstatus") == "F", "FINISHED")
                            .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    from tabreg.operators.profile import level_counts
    counts = level_counts(o, ["o_orderpriority", "o_orderstatus"])
    j = counts.join(F.broadcast(cb.select(F.col("column").alias("variable"), "level", "rank")),
                    ["variable", "level"], "left")
    return j.select(F.col("variable").alias("column_name"), "level", "rank", "n")


@register("codebook_violations", "U3 A4 S6", sql="""
WITH m AS (
  SELECT 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem
  UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders
)
SELECT column_name, value, count(*) AS n FROM m
WHERE NOT ((column_name = 'l_returnflag' AND value IN ('A','R'))
        OR (column_name = 'l_linestatus' AND value IN ('O'))
        OR (column_name = 'o_orderstatus' AND value IN ('F','O')))
GROUP BY column_name, value
""")
def codebook_violations(spark, sf_dir):
    cb = STAND_IN_CODEBOOK.to_frame(spark)
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    v1 = clean.codebook_violations(li, cb, ["l_returnflag", "l_linestatus"])
    v2 = clean.codebook_violations(o, cb, ["o_orderstatus"])
    return v1.unionByName(v2).select(F.col("column").alias("column_name"), "value", "n")


@register("coerce_numeric", "P7 P8 E1", sql="""
WITH t AS (
  SELECT CASE WHEN l_linenumber = 2 THEN 'NA'
              WHEN l_linenumber = 4 THEN 'n/a'
              ELSE regexp_extract(p_brand, '#([0-9]+)', 1) END AS brand_txt,
         p_size
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT count(*) AS n,
       count(TRY_CAST(NULLIF(brand_txt, 'NA') AS DOUBLE)) AS n_number,
       count(NULLIF(brand_txt, 'NA')) AS n_not_code,
       round(sum(TRY_CAST(NULLIF(brand_txt, 'NA') AS DOUBLE)), 2) AS sum_brand,
       count(DISTINCT CAST(p_size AS VARCHAR)) AS n_size_codes
FROM t
""")
def coerce_numeric(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    t = li.join(p, li.l_partkey == p.p_partkey).select(
        F.when(F.col("l_linenumber") == 2, F.lit("NA"))
         .when(F.col("l_linenumber") == 4, F.lit("n/a"))
         .otherwise(F.regexp_extract("p_brand", r"#([0-9]+)", 1)).alias("brand_txt"),
        F.col("p_size"))
    t = clean.codes_to_null(t, ["brand_txt"])                  # E1
    t = t.withColumn("brand_num", F.col("brand_txt"))
    t = clean.to_number(t, ["brand_num"])                      # P7
    t = clean.to_code(t, ["p_size"])                           # P8
    return t.agg(F.count(F.lit(1)).alias("n"), F.count("brand_num").alias("n_number"),
                 F.count("brand_txt").alias("n_not_code"), r2(F.sum("brand_num"), "sum_brand"),
                 F.countDistinct("p_size").alias("n_size_codes"))


@register("recode_levels", "E2 L1", sql="""
SELECT p_type_merged, count(*) AS n, round(avg(p_retailprice), 6) AS mean_price
FROM (
  SELECT CASE WHEN p_type IN ('SMALL','MEDIUM') THEN 'SM_MED'
              WHEN p_type = 'PROMO' THEN 'ECONOMY'
              ELSE p_type END AS p_type_merged, p_retailprice
  FROM part
) t
GROUP BY p_type_merged
""")
def recode_levels(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    p = clean.recode_values(p, "p_type", {"SMALL": "SM_MED", "MEDIUM": "SM_MED", "PROMO": "ECONOMY"})
    return p.groupBy(F.col("p_type").alias("p_type_merged")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("p_retailprice"), "mean_price"))


@register("value_fixes", "E6 E7", sql=f"""
SELECT l_returnflag,
       count(*) AS n,
       CAST(sum(CASE WHEN p_size = 50 THEN 5 ELSE p_size END) AS BIGINT) AS sum_size_fixed,
       round(sum(CASE WHEN l_tax <= 0.02 THEN l_discount ELSE l_tax END), 4) AS sum_tax_floor
FROM {GAPS_SQL} s GROUP BY l_returnflag
""")
def value_fixes(spark, sf_dir):
    s = sales_with_gaps(spark, sf_dir)
    s = s.withColumn("p_size", X.replace_value("p_size", 50, 5))                # E6
    s = s.withColumn("tax_floor", X.floor_fallback("l_tax", 0.02, "l_discount"))  # E7
    return s.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("long").alias("sum_size_fixed"),
        F.round(F.sum("tax_floor"), 4).alias("sum_tax_floor"))


@register("pair_indicators", "E4 E5 T5", sql="""
WITH t AS (
  SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS c1,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE l_linestatus END AS c2
  FROM lineitem
)
SELECT counter, sign, count(*) AS n FROM (
  SELECT CAST(coalesce(c1 IN ('A','F'), false) AS INTEGER) + CAST(coalesce(c2 IN ('A','F'), false) AS INTEGER) AS counter,
         CASE WHEN coalesce(c1 IN ('R','O'), false) OR coalesce(c2 IN ('R','O'), false) THEN -1
              WHEN coalesce(c1 IN ('A'), false) OR coalesce(c2 IN ('A'), false) THEN 1
              ELSE 0 END AS sign
  FROM t
) u GROUP BY counter, sign
""")
def pair_indicators(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_returnflag")).alias("c1"),
        F.when(F.col("l_linenumber") != 2, F.col("l_linestatus")).alias("c2"))
    t = li.select(X.member_count(["c1", "c2"], ["A", "F"]).alias("counter"),
                  X.signed_indicator(["c1", "c2"], ["R", "O"], ["A"]).alias("sign"))
    return t.groupBy("counter", "sign").agg(F.count(F.lit(1)).alias("n"))


OUTLIER_RULES = {"big_quantity": ("l_quantity", 49.0), "big_price": ("l_extendedprice", 100000.0),
                 "big_size": ("p_size", 50.0)}


@register("range_report", "F1 P4", sql=f"""
SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS sum_price
FROM {SALES_SQL} s WHERE l_extendedprice > 95000 GROUP BY l_returnflag
""")
def range_report(spark, sf_dir):
    s = clean.range_filter(sales(spark, sf_dir), "l_extendedprice", lower=95000)
    return s.select("l_returnflag", "l_extendedprice").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r2(F.sum("l_extendedprice"), "sum_price"))


@register("outlier_rules", "F2 P4", sql=f"""
SELECT rule, count(*) AS n FROM (
  SELECT 'big_quantity' AS rule FROM {SALES_SQL} s WHERE l_quantity >= 49
  UNION ALL SELECT 'big_price' FROM {SALES_SQL} s WHERE l_extendedprice >= 100000
  UNION ALL SELECT 'big_size' FROM {SALES_SQL} s WHERE p_size >= 50
  UNION ALL SELECT 'any' FROM {SALES_SQL} s WHERE l_quantity >= 49 OR l_extendedprice >= 100000 OR p_size >= 50
) t GROUP BY rule
""")
def outlier_rules(spark, sf_dir):
    report, _ = clean.complement_rules(OUTLIER_RULES)
    rep = clean.rule_report(sales(spark, sf_dir), report)
    # one pass: every reported row counts once for 'any' and once per rule that fired
    rules = rep.select(F.explode(F.concat(F.col("fired"), F.array(F.lit("any")))).alias("rule"))
    return rules.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("outlier_filter", "F3 T15", sql=f"""
SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS sum_price
FROM {SALES_SQL} s
WHERE l_quantity < 49 AND l_extendedprice < 100000 AND p_size < 50 AND p_retailprice < 2000
""")
def outlier_filter(spark, sf_dir):
    _, keep = clean.complement_rules(OUTLIER_RULES)
    kept = clean.rule_filter(sales(spark, sf_dir), keep + [F.col("p_retailprice") < 2000])
    return kept.agg(F.count(F.lit(1)).alias("n"), r2(F.sum("l_extendedprice"), "sum_price"))


@register("large_error_flags", "F9 E13", sql=f"""
SELECT count(*) AS n, count(CASE WHEN label <> '' THEN 1 END) AS n_flagged,
       CAST(sum(CASE WHEN label <> '' THEN CAST(label AS BIGINT) ELSE 0 END) AS BIGINT) AS key_sum
FROM (
  SELECT CASE WHEN abs(l_extendedprice / l_quantity - p_retailprice) > 0.5
              THEN CAST(l_orderkey AS VARCHAR) ELSE '' END AS label
  FROM {SALES_SQL} s
) t
""")
def large_error_flags(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("res", F.col("l_extendedprice") / F.col("l_quantity") - F.col("p_retailprice"))
    f = clean.flag_large(s, "res", 0.5, "l_orderkey")
    return f.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label") != "", 1)).alias("n_flagged"),
                 F.sum(F.when(F.col("label") != "", F.col("label").cast("long")).otherwise(0)).alias("key_sum"))


@register("drop_columns", "P3 P5", sql=f"""
SELECT count(*) AS n, round(sum(l_quantity), 2) AS sum_quantity, round(CAST(sum(p_size) AS DOUBLE), 2) AS sum_size
FROM {SALES_SQL} s
""")
def drop_columns(spark, sf_dir):
    s = sales(spark, sf_dir).drop("l_extendedprice", "o_totalprice", "l_returnflag")   # P3
    kinds = {"numeric": clean.numeric_columns(s, exclude=["l_orderkey", "l_linenumber"])}
    num = clean.select_kind(s, kinds, "numeric")                                       # P5
    return num.agg(F.count(F.lit(1)).alias("n"), r2(F.sum("l_quantity"), "sum_quantity"),
                   r2(F.sum("p_size"), "sum_size"))


@register("missing_rows", "F5", sql=f"""
SELECT 'missing' AS part, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM {GAPS_SQL} g WHERE l_tax IS NULL
UNION ALL SELECT 'observed', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM {GAPS_SQL} g WHERE l_tax IS NOT NULL
""")
def missing_rows(spark, sf_dir):
    g = sales_with_gaps(spark, sf_dir)
    parts = [clean.missing_rows(g, "l_tax", miss).withColumn("part", F.lit(name)) for miss, name in ((True, "missing"), (False, "observed"))]
    return io.union_by_name(parts).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").cast("long").alias("key_sum"))


@register("distinct_values", "A4", sql="SELECT DISTINCT o_orderpriority AS level FROM orders")
def distinct_values(spark, sf_dir):
    return clean.distinct_values(table(spark, sf_dir, "orders"), "o_orderpriority").withColumnRenamed("o_orderpriority", "level")


_TEXT_SQL = """(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN 'NA' WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders)"""


@register("csv_scan", "S1", sql=f"""
SELECT o_orderpriority AS level, count(*) AS n, CAST(sum(CAST(o_orderkey AS BIGINT)) AS BIGINT) AS key_sum
FROM {_TEXT_SQL} t GROUP BY o_orderpriority
""")
def csv_scan(spark, sf_dir):
    """All orders as CSV and back: every column text, the empty string missing, "NA" a value."""
    path = scratch_path(spark)
    k = F.col("o_orderkey")
    text = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("o_orderkey"), "o_orderstatus",
        F.when(k % 7 == 0, "NA").when(k % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    text.write.option("header", True).csv(path)
    back = io.read_text_csv(spark, path, text.columns)
    return back.groupBy(F.col("o_orderpriority").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"))


@register("snapshot", "S3 S4", sql="""
SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS set, count(*) AS n, round(sum(o_totalprice), 2) AS sum_price
FROM orders GROUP BY ALL
""")
def snapshot(spark, sf_dir):
    """The tagged orders as a snapshot by set, read back."""
    path = scratch_path(spark)
    io.write_snapshot(orders_tagged(spark, sf_dir), path, ["set"])
    return io.read_snapshot(spark, path).groupBy("set").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("sum_price"))


@register("scored_file", "S5 E12", sql="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY ALL
""")
def scored_file(spark, sf_dir):
    """Keys and back-transformed log prices of all orders as a scored CSV, read back and joined."""
    path = scratch_path(spark)
    o = table(spark, sf_dir, "orders")
    io.write_scored(o.select("o_orderkey", F.exp(F.log("o_totalprice")).alias("p")), path, "o_orderkey", "p", ("Id", "SalePrice"))
    back = io.read_text_csv(spark, path).select(F.col("Id").cast("long").alias("o_orderkey"), F.col("SalePrice").cast("double").alias("price"))
    return o.join(back, "o_orderkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price"))
