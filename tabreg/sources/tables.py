"""Readers for the driver's parquet tables and the stand-in views built on them.

The stand-ins only give rows in the schema an operator expects (a label, numeric and
categorical predictors, a set tag, planted missing values); they do none of an
operator's work. Every scan reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALES_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "o_orderstatus", "o_totalprice", "o_orderpriority",
    "p_type", "p_brand", "p_size", "p_retailprice",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` joined to its order and part. Both joins are many-to-one on a
    unique key; the planner picks broadcast or sort-merge from the measured sizes."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(*SALES_COLUMNS))


def sales_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales`` with planted missing values (the driver tables hold none): quantity and
    tax missing together on orders whose key is a multiple of 7, discount on line number 3,
    tax alone on line number 5, size where the part size is a multiple of 11."""
    s = sales(spark, sf_dir)
    return s.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        F.when((F.col("l_orderkey") % 7 != 0) & (F.col("l_linenumber") != 5), F.col("l_tax")).alias("l_tax"),
        "l_returnflag", "l_linestatus", "o_orderstatus", "o_totalprice", "o_orderpriority",
        "p_type", "p_brand",
        F.when(F.col("p_size") % 11 != 0, F.col("p_size")).alias("p_size"),
        "p_retailprice",
    )


def orders_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with a set tag (every 5th key is the unlabelled set)."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("set", F.when(F.col("o_orderkey") % 5 == 0, F.lit("test")).otherwise(F.lit("train")))
