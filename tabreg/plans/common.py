"""Shared pieces of the catalogue: stand-in views in SQL (mirroring ``sources.tables``)
and rounding helpers used identically on both sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALES_SQL = """(
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, o_orderstatus, o_totalprice, o_orderpriority,
         p_type, p_brand, p_size, p_retailprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

GAPS_SQL = f"""(
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount,
         CASE WHEN l_orderkey % 7 <> 0 AND l_linenumber <> 5 THEN l_tax END AS l_tax,
         l_returnflag, l_linestatus, o_orderstatus, o_totalprice, o_orderpriority,
         p_type, p_brand,
         CASE WHEN p_size % 11 <> 0 THEN p_size END AS p_size,
         p_retailprice
  FROM {SALES_SQL} s
)"""

ORDERS_TAGGED_SQL = """(
  SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS set
  FROM orders
)"""

GAP_NUMERIC = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "l_extendedprice",
               "o_totalprice"]
SALES_NUMERIC = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
SALES_FACTORS = ["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "p_type", "p_brand"]


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name or (c if isinstance(c, str) else "x"))


def r2(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 2).alias(name or (c if isinstance(c, str) else "x"))


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
