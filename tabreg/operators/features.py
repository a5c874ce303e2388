"""Derived features and factor levels.

Fitted steps (level lumping, contrast coding) follow the ``fit`` / ``transform`` shape of
``pyspark.ml``: ``fit`` runs one aggregate and keeps only the small level lists on the
driver; ``transform`` is a pure projection, so it runs inside whole-stage codegen and can
be applied to any table (a training fold, a hold-out, a stream).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.functions.stats import poly_contrasts
from tabreg.operators.order import small_side, top_n_with_ties, with_group_rank
from tabreg.session import cut_lineage


# -- row features ----------------------------------------------------------------------

def add_features(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """Add named column expressions in one projection (evaluated on the input row)."""
    return df.withColumns(dict(features))


def log_label(df: DataFrame, label: str, out: str | None = None) -> DataFrame:
    """Natural log of the label; 0 and negatives become NULL."""
    return df.withColumn(out or f"log_{label}", X.log_positive(label))


def back_transform(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Plain ``exp`` (no bias correction)."""
    return df.withColumn(out or col, F.exp(F.col(col)))


# -- level merges, lumping, unused levels -----------------------------------------------

def merge_levels(df: DataFrame, column: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """L1: ``{new: [old, ...]}``; unlisted levels are kept."""
    mapping = {o: n for n, olds in groups.items() for o in olds}
    return df.withColumn(column, X.recode(column, mapping))


def merged_level_order(levels: Sequence[str], groups: Mapping[str, Sequence[str]]) -> list[str]:
    """Level list after a merge: a merged level takes the place of its first member."""
    mapping = {o: n for n, olds in groups.items() for o in olds}
    out: list[str] = []
    for lv in levels:
        new = mapping.get(lv, lv)
        if new not in out:
            out.append(new)
    return out


@dataclass
class LumpModel:
    """Kept levels as a table ``(variable, level)``, one row per kept level; nothing is collected."""

    columns: Sequence[str]
    kept: DataFrame
    other: str = "Other"

    def transform(self, df: DataFrame) -> DataFrame:
        """One join a column, broadcast where the counted levels allow it; NULL stays NULL."""
        for c in self.columns:
            mine = self.kept.where(F.col("variable") == c).select(F.col("level").alias("_lump"))
            order = df.columns
            df = df.join(small_side(mine), F.col(c).cast("string") == F.col("_lump"), "left")
            df = df.withColumn(c, F.when(F.col(c).isNull() | F.col("_lump").isNotNull(), F.col(c).cast("string"))
                               .otherwise(F.lit(self.other))).select(*order)
        return df

    def levels(self, limit: int = 10_000) -> dict[str, list[str]]:
        """``{column: sorted kept levels}`` on the driver; more than ``limit`` in all is an error."""
        rows = self.kept.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} kept levels")
        return {c: sorted(r["level"] for r in rows if r["variable"] == c) for c in self.columns}


@dataclass
class LevelLumper:
    """L2: keep the ``n`` most frequent levels of each column (ties at the cut are all
    kept), every other level becomes ``other``. ``fit`` is one melted count, written once; the
    model is a table, so any number of tied levels may be kept."""

    columns: Sequence[str]
    n: int = 1
    other: str = "Other"

    def fit(self, df: DataFrame) -> LumpModel:
        from tabreg.operators.profile import level_counts
        counts = cut_lineage(level_counts(df, self.columns))
        kept = top_n_with_ties(counts, "n", self.n, by=["variable"])     # rank() <= n, ties kept
        return LumpModel(list(self.columns), cut_lineage(kept.select("variable", "level")), self.other)


@dataclass
class LevelIndexModel:
    """``levels``: a table ``(variable, level, index)`` with indices from 0 in level order."""

    columns: Sequence[str]
    levels: DataFrame

    def transform(self, df: DataFrame, suffix: str = "_index") -> DataFrame:
        """Adds ``<column><suffix>``; NULL and levels not seen at ``fit`` have none."""
        for c in self.columns:
            mine = self.levels.where(F.col("variable") == c).select(F.col("level").alias("_level"),
                                                                    F.col("index").alias(f"{c}{suffix}"))
            df = df.join(small_side(mine), F.col(c).cast("string") == F.col("_level"), "left").drop("_level")
        return df


@dataclass
class LevelIndexer:
    """L5 for columns of any number of levels: the place of every level in its column's sorted levels,
    as a table (one-hot columns per level are ``ContrastEncoder``'s, whose levels must be few). No
    level list is collected; the places are exact distributed ranks."""

    columns: Sequence[str]

    def fit(self, df: DataFrame) -> LevelIndexModel:
        from tabreg.operators.profile import melt
        seen = melt(df, self.columns).where(F.col("value").isNotNull()).select("variable", F.col("value").alias("level")).distinct()
        ranked = with_group_rank(cut_lineage(seen), ["variable"], ["level"], "index")
        return LevelIndexModel(list(self.columns), cut_lineage(ranked.withColumn("index", F.col("index") - 1)))


def drop_unused_levels(codebook_frame: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """L4: keep only the codebook rows of ``column`` whose level occurs in the data
    (a semi join against the distinct values), renumbering the ranks."""
    present = df.select(F.col(column).cast("string").alias("level")).distinct()
    mine = codebook_frame.where(F.col("column") == column).join(present, "level", "left_semi")
    w = Window.partitionBy("column").orderBy("rank")
    mine = mine.withColumn("rank", F.row_number().over(w).cast("int"))
    return codebook_frame.where(F.col("column") != column).unionByName(mine.select(*codebook_frame.columns))


# -- contrast coding (L5, T21) ----------------------------------------------------------

def _safe(s: str) -> str:
    return "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in str(s))


POLY_SUFFIX = ["L", "Q", "C"]


@dataclass
class ContrastModel:
    nominal: dict[str, list[str]] = field(default_factory=dict)
    ordinal: dict[str, list[str]] = field(default_factory=dict)
    ordinal_encoding: str = "poly"
    drop_input: bool = True

    def output_columns(self) -> list[str]:
        out = []
        for c, lv in self.nominal.items():
            out += [f"{c}_{_safe(v)}" for v in lv[1:]]
        for c, lv in self.ordinal.items():
            if self.ordinal_encoding == "poly":
                out += [f"{c}_{POLY_SUFFIX[j] if j < 3 else j + 1}" for j in range(len(lv) - 1)]
            elif self.ordinal_encoding == "rank":
                out.append(f"{c}_rank")
            else:
                out += [f"{c}_{_safe(v)}" for v in lv[1:]]
        return out

    def expressions(self) -> dict[str, Column]:
        ex: dict[str, Column] = {}
        for c, lv in self.nominal.items():
            for v in lv[1:]:                                   # drop-first treatment coding
                ex[f"{c}_{_safe(v)}"] = F.when(F.col(c).isNull(), F.lit(None).cast("double")) \
                                         .otherwise((F.col(c) == F.lit(v)).cast("double"))
        for c, lv in self.ordinal.items():
            pos = F.array_position(F.array(*[F.lit(v) for v in lv]), F.col(c))
            if self.ordinal_encoding == "poly":
                z = poly_contrasts(len(lv))
                for j in range(len(lv) - 1):
                    name = f"{c}_{POLY_SUFFIX[j] if j < 3 else j + 1}"
                    scores = F.array(*[F.lit(float(z[i, j])) for i in range(len(lv))])
                    ex[name] = F.when(pos > 0, F.element_at(scores, pos.cast("int")))
            elif self.ordinal_encoding == "rank":
                ex[f"{c}_rank"] = F.when(pos > 0, pos.cast("double"))
            else:
                for v in lv[1:]:
                    ex[f"{c}_{_safe(v)}"] = F.when(F.col(c).isNull(), F.lit(None).cast("double")) \
                                             .otherwise((F.col(c) == F.lit(v)).cast("double"))
        return ex

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns(self.expressions())
        if self.drop_input:
            out = out.drop(*self.nominal, *self.ordinal)
        return out


@dataclass
class ContrastEncoder:
    """Expand factors into numeric columns. Unordered factors get drop-first
    indicators; ordered factors get orthonormal polynomial scores (``poly``), their rank
    (``rank``) or indicators (``dummy``). Level lists come from ``levels`` (e.g. the
    codebook, in its order) or, when absent, from the data at ``fit`` (sorted); every level is a
    column, so more than ``max_levels`` of them are an error."""

    nominal: Sequence[str] = ()
    ordinal: Sequence[str] = ()
    levels: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ordinal_encoding: str = "poly"
    drop_input: bool = True
    max_levels: int = 10_000

    def fit(self, df: DataFrame) -> ContrastModel:
        need = [c for c in [*self.nominal, *self.ordinal] if c not in self.levels]
        found: dict[str, list[str]] = {}
        if need:
            from tabreg.operators.profile import level_counts
            seen = cut_lineage(level_counts(df, need).select("variable", "level"))
            if (n := seen.count()) > self.max_levels:         # counted before any level is collected
                raise ValueError(f"{n} levels would be as many columns; LevelIndexer keeps them as a table")
            for r in seen.collect():
                found.setdefault(r["variable"], []).append(r["level"])
        lv = {c: list(self.levels[c]) if c in self.levels else sorted(found.get(c, []))
              for c in [*self.nominal, *self.ordinal]}
        return ContrastModel({c: lv[c] for c in self.nominal}, {c: lv[c] for c in self.ordinal},
                             self.ordinal_encoding, self.drop_input)
