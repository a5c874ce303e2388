"""The codebook: allowed levels per categorical column.

Held twice: as a small Python mapping (drives the literal arrays of the wide
reconciliation, no join needed) and as a DataFrame ``(column, kind, rank, level)`` for
the melted operators (violations, level counts), joined by broadcast: its size is the
literal level lists, fixed and known on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODEBOOK_SCHEMA = "column string, kind string, rank int, level string"


@dataclass
class Codebook:
    """``ordered`` and ``unordered`` map a column name to its level list (lowest first
    for ordered columns)."""

    ordered: dict[str, list[str]] = field(default_factory=dict)
    unordered: dict[str, list[str]] = field(default_factory=dict)

    def levels(self, column: str) -> list[str]:
        if column in self.ordered:
            return self.ordered[column]
        return self.unordered[column]

    def kind(self, column: str) -> str:
        return "ordered" if column in self.ordered else "unordered"

    @property
    def columns(self) -> list[str]:
        return [*self.ordered, *self.unordered]

    def rows(self) -> list[tuple[str, str, int, str]]:
        out = []
        for kind, book in (("ordered", self.ordered), ("unordered", self.unordered)):
            for c, lv in book.items():
                out.extend((c, kind, i + 1, str(v)) for i, v in enumerate(lv))
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), CODEBOOK_SCHEMA)

    # L3: re-order levels; named levels first in the given order, the rest keep their order
    def relevel(self, column: str, first: Sequence[str]) -> "Codebook":
        cur = self.levels(column)
        new = [*first, *[v for v in cur if v not in first]]
        return self._replace(column, new)

    # Rename one level in the codebook
    def rename_level(self, column: str, old: str, new: str) -> "Codebook":
        return self._replace(column, [new if v == old else v for v in self.levels(column)])

    def with_levels(self, column: str, levels: Sequence[str], kind: str | None = None) -> "Codebook":
        kind = kind or (self.kind(column) if column in self.columns else "unordered")
        o, u = dict(self.ordered), dict(self.unordered)
        o.pop(column, None)
        u.pop(column, None)
        (o if kind == "ordered" else u)[column] = [str(v) for v in levels]
        return Codebook(o, u)

    def _replace(self, column: str, levels: list[str]) -> "Codebook":
        return self.with_levels(column, levels, self.kind(column))


def codebook_from_frame(cb: DataFrame) -> Codebook:
    """Inverse of ``Codebook.to_frame``; the codebook is small by construction."""
    o: dict[str, list[str]] = {}
    u: dict[str, list[str]] = {}
    for r in cb.orderBy("column", "rank").collect():
        (o if r["kind"] == "ordered" else u).setdefault(r["column"], []).append(r["level"])
    return Codebook(o, u)


def amend_from_data(cb_frame: DataFrame, df: DataFrame, column: str,
                    order_by: str | None = None) -> DataFrame:
    """Replace a column's codebook rows by the distinct values found in the data.

    Levels are numbered by first appearance along ``order_by`` (e.g. the row key), or
    alphabetically. The distinct step is a partial aggregate, so a hot value costs nothing.
    """
    if order_by:
        found = (df.where(F.col(column).isNotNull())
                   .groupBy(F.col(column).cast("string").alias("level"))
                   .agg(F.min(order_by).alias("_first")))
        w_order = [F.col("_first"), F.col("level")]
    else:
        found = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("level")).distinct()
        w_order = [F.col("level")]
    from tabreg.operators.order import with_group_rank
    kind = (cb_frame.where(F.col("column") == column).select("kind").limit(1))
    # levels numbered by the distributed exact rank (no single-task window over the values)
    new_rows = (with_group_rank(found, [], w_order, rank_col="rank").withColumn("rank", F.col("rank").cast("int"))
                     .withColumn("column", F.lit(column))
                     .withColumn("kind", F.coalesce(kind.select("kind").scalar(), F.lit("unordered")))
                     .select("column", "kind", "rank", "level"))
    return cb_frame.where(F.col("column") != column).unionByName(new_rows)


def rename_level_frame(cb_frame: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """L6 on the table form: rename one level of one column."""
    return cb_frame.withColumn(
        "level", F.when((F.col("column") == column) & (F.col("level") == old), F.lit(new))
                  .otherwise(F.col("level")))


def relevel_frame(cb_frame: DataFrame, column: str, first: Sequence[str]) -> DataFrame:
    """L3 on the table form: named levels first (in the given order), the rest after them
    in their old order."""
    pos = F.array_position(F.array(*[F.lit(v) for v in first]), F.col("level"))
    from pyspark.sql import Window
    w = Window.partitionBy("column").orderBy(F.when(pos > 0, pos).otherwise(F.lit(len(first)) + F.col("rank")))
    target = cb_frame.where(F.col("column") == column).withColumn("rank", F.row_number().over(w).cast("int"))
    return cb_frame.where(F.col("column") != column).unionByName(target.select(*cb_frame.columns))


def mapping_from_pairs(pairs: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """``{new: [old, ...]}`` (the way a level merge is written) -> ``{old: new}``."""
    out: dict[str, str] = {}
    for new, olds in pairs.items():
        for o in olds:
            out[o] = new
    return out
