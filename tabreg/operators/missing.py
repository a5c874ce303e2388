"""Missing values: shares, patterns, rule-based fills, predictor selection (A1, A2, P6,
I1-I5, I8, J2, A10).

Every report is a single aggregate over all columns at once; the fills are column
expressions; a global extreme used in a fill is a scalar subquery, not a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.session import cut_lineage


def missing_counts_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``n`` and the number of NULLs of every column (one pass)."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def missing_share(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True,
                  exclude: Sequence[str] = ()) -> DataFrame:
    """A1 + R1 + F7: long form ``(variable, n_missing, missing_share)``.

    One aggregate over all columns, then an unpivot of that single row."""
    cols = [c for c in (cols or df.columns) if c not in exclude]
    wide = missing_counts_wide(df, cols)
    long = wide.unpivot(["n"], cols, "variable", "n_missing")
    long = long.select("variable", F.col("n_missing").cast("long").alias("n_missing"),
                       (F.col("n_missing") / F.col("n")).alias("missing_share"))
    if only_missing:
        long = long.where(F.col("n_missing") > 0)
    return long


def columns_with_missing(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Names of the columns holding any NULL (one aggregate; returns names only)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: group rows by which of ``cols`` are missing.

    One row per pattern: a 0/1 flag per column (1 = missing), ``n_rows`` and
    ``n_missing_cols``. A margin row (``is_margin = 1``) holds the NULL count of every
    column in the flag columns. One pass: the grouping keys are 0/1 flags, so partial
    aggregation leaves at most 2^k rows per task; the margin is summed from the pattern
    table itself.
    """
    flags = {c: F.col(c).isNull().cast("long") for c in cols}
    pats = (df.select(*[v.alias(c) for c, v in flags.items()])
              .groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")))
    pats = cut_lineage(pats)                              # at most 2^k rows
    out = pats.withColumn("n_missing_cols", sum((F.col(c) for c in cols), F.lit(0)).cast("long")) \
              .withColumn("is_margin", F.lit(0))
    margin = (pats.agg(*[F.sum(F.col(c) * F.col("n_rows")).cast("long").alias(c) for c in cols])
                  .withColumn("n_rows", F.lit(None).cast("long"))
                  .withColumn("n_missing_cols", sum((F.col(c) for c in cols), F.lit(0)).cast("long"))
                  .withColumn("is_margin", F.lit(1)))
    return out.unionByName(margin)


# -- rule-based fills --------------------------------------------------------------------

def fill_when_all_missing(df: DataFrame, cols: Sequence[str], values: Mapping[str, object]) -> DataFrame:
    """Where every column in ``cols`` is missing, set the given constants.

    The joint condition is evaluated once against the input row (``withColumns``), so
    filling one column does not change the condition for the next."""
    cond = X.all_null(cols)
    return df.withColumns({c: F.when(cond, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def paired_fill(df: DataFrame, cols: Sequence[str], values: Mapping[str, object],
                sequential: bool = False) -> DataFrame:
    """I2 (T3): fill a type/amount pair that is missing together.

    ``sequential=False`` (the stated intent) tests the condition on the input row for
    both columns. ``sequential=True`` re-tests after each column is filled, which is what
    a chain of dependent assignments does: after the first column is filled the
    condition no longer holds for the second."""
    if not sequential:
        return fill_when_all_missing(df, cols, values)
    out = df
    for c, v in values.items():
        out = out.withColumn(c, F.when(X.all_null(cols), F.lit(v)).otherwise(F.col(c)))
    return out


def global_extreme(df: DataFrame, column: str, how: str = "min") -> Column:
    """The table-wide min/max of ``column`` ignoring NULL, as a scalar subquery
    usable inside any row expression of the same or another frame."""
    agg = F.min(column) if how == "min" else F.max(column)
    return df.agg(agg.alias("_x")).scalar()


def fill_all_missing_with(df: DataFrame, cols: Sequence[str], constants: Mapping[str, object],
                          extremes: Mapping[str, str]) -> DataFrame:
    """Joint-missing fill where some columns take constants and others a global
    extreme (``{"col": "min"}``), the extreme taken over the input before filling."""
    cond = X.all_null(cols)
    # all extremes from one aggregate: a scalar subquery returning one struct
    one = df.agg(F.struct(*[(F.min(c) if how == "min" else F.max(c)).alias(c)
                            for c, how in extremes.items()]).alias("_x")).scalar()
    scalars = {c: one[c] for c in extremes}
    upd = {c: F.when(cond, F.lit(v)).otherwise(F.col(c)) for c, v in constants.items()}
    upd.update({c: F.when(cond, s).otherwise(F.col(c)) for c, s in scalars.items()})
    return df.withColumns(upd)


def conditional_fill(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """I4: ``column`` takes ``value`` where it is missing and ``condition`` holds."""
    return df.withColumn(column, F.when(F.col(column).isNull() & F.coalesce(condition, F.lit(False)), value)
                         .otherwise(F.col(column)))


def restore_label(df: DataFrame, label: str, set_col: str = "set", unlabelled: str = "test") -> DataFrame:
    """I8: the label of the unlabelled set goes back to NULL."""
    return df.withColumn(label, F.when(F.col(set_col) != F.lit(unlabelled), F.col(label)))


# -- predictor selection for imputation (I5) ---------------------------------------------

def impute_predictors(df: DataFrame, numeric_cols: Sequence[str], mincor: float = 0.1,
                      exclude: Sequence[str] = ()) -> DataFrame:
    """For every incomplete target ``y`` and candidate ``x``, the pairwise-complete
    correlation of ``x`` with ``y`` and with ``y``'s missing flag; ``x`` is a predictor of
    ``y`` when the larger absolute value exceeds ``mincor``.

    Categorical columns enter through their rank code (the caller adds rank columns).
    One pass builds the pairwise-complete moment matrix of the columns and the targets'
    missing flags (``matrix.pairwise_moments``), so the cost does not grow with the
    number of (target, predictor) pairs. Returns
    ``(target, predictor, r_value, r_missing, selected)``.
    """
    from tabreg.operators.matrix import corr_from_moments, pairwise_moments
    from tabreg.session import cut_lineage
    cols = [c for c in numeric_cols if c not in exclude]
    miss = missing_counts_wide(df, cols).first()
    targets = [c for c in cols if miss[c] > 0]
    if not targets:
        return df.sparkSession.createDataFrame([], "target string, predictor string, r_value double, "
                                                   "r_missing double, selected boolean")
    r = cut_lineage(corr_from_moments(pairwise_moments(df, cols, targets)))
    val = r.where(F.col("var_y").isin(targets) & (F.col("var_x") != F.col("var_y"))) \
           .select(F.col("var_y").alias("target"), F.col("var_x").alias("predictor"), F.col("r").alias("r_value"))
    ind = r.where(F.col("var_y").isin([f"{t}__isna" for t in targets]) & F.col("var_x").isin(cols)) \
           .select(F.regexp_replace("var_y", "__isna$", "").alias("target"), F.col("var_x").alias("predictor"),
                   F.col("r").alias("r_missing"))
    long = val.join(ind, ["target", "predictor"], "left").where(F.col("predictor").isin(cols))
    best = F.greatest(F.coalesce(F.abs("r_value"), F.lit(0.0)), F.coalesce(F.abs("r_missing"), F.lit(0.0)))
    return long.withColumn("selected", best > F.lit(mincor))
