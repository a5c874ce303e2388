"""Column profiles (A3 skim, A5 level counts, A6 near-zero variance, W2 second most common,
A7 skewness, A8 histogram, A21 binned density, A9 box statistics, A10, O1, O2).

Per-column work is melted into one long ``(variable, value)`` relation or one wide
aggregate, never a job per column. Counts are partial aggregates (a hot level costs one
row per task); quantiles use the distributed exact order statistics of ``order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators.order import small_side, top_k_rows
from tabreg.operators.quantiles import quantile_table
from tabreg.session import cut_lineage


def melt(df: DataFrame, cols: Sequence[str], value_type: str = "string",
         keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long ``(keep..., variable, value)`` for many columns in one pass."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast(value_type).alias("value")) for c in cols
    ])).alias("_m")).select(*keep, "_m.variable", "_m.value")


# -- categorical ------------------------------------------------------------------------

def level_counts(df: DataFrame, cols: Sequence[str], keep_null: bool = False) -> DataFrame:
    """A5: ``(variable, level, n)`` for every categorical column in one job."""
    m = melt(df, cols)
    if not keep_null:
        m = m.where(F.col("value").isNotNull())
    return m.groupBy("variable", F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def top_two(counts: DataFrame) -> DataFrame:
    """Per variable the most common level and count, the second count, the number of
    levels. Aggregates only (no window over the level table): the top is the max of
    ``(n, level)``; the second is the max over the other levels, so a tie gives
    ``second == top``."""
    best = counts.groupBy("variable").agg(
        F.max(F.struct(F.col("n"), F.col("level"))).alias("_best"),
        F.count(F.lit(1)).alias("n_unique"),
        F.sum("n").alias("n_nonnull"))
    best = best.select("variable", F.col("_best.level").alias("top_level"),
                       F.col("_best.n").alias("top_n"), "n_unique", "n_nonnull")
    second = (counts.join(best.select("variable", "top_level"), "variable")
                    .where(F.col("level") != F.col("top_level"))
                    .groupBy("variable").agg(F.max("n").alias("second_n")))
    return best.join(second, "variable", "left")


def near_zero_variance(df: DataFrame, cols: Sequence[str], freq_cut: float = 95 / 5,
                       unique_cut: float = 10.0) -> DataFrame:
    """``(variable, freq_ratio, percent_unique, zero_var, nzv)``.

    freq_ratio = most common / second most common count (0 with one level or none);
    percent_unique = 100 * distinct non-missing values / rows;
    nzv = (freq_ratio > freq_cut and percent_unique <= unique_cut) or zero_var.
    """
    # one pass: counts per (variable, level) including the NULL level, materialised
    # (it is an aggregate); the row count is any variable's total
    allc = cut_lineage(level_counts(df, cols, keep_null=True))
    n_rows = allc.where(F.col("variable") == cols[0]).agg(F.sum("n")).scalar()
    counts = allc.where(F.col("level").isNotNull())
    t2 = top_two(counts)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    out = names.join(t2, "variable", "left")
    ratio = F.when(F.coalesce(F.col("n_unique"), F.lit(0)) <= 1, F.lit(0.0)) \
             .otherwise(F.col("top_n") / F.col("second_n"))
    pct = F.lit(100.0) * F.coalesce(F.col("n_unique"), F.lit(0)) / n_rows
    zero = F.coalesce(F.col("n_unique"), F.lit(0)) <= 1
    return out.select(
        "variable",
        ratio.cast("double").alias("freq_ratio"),
        pct.cast("double").alias("percent_unique"),
        zero.alias("zero_var"),
        (((ratio > F.lit(freq_cut)) & (pct <= F.lit(unique_cut))) | zero).alias("nzv"))


def skim_factor(df: DataFrame, cols: Sequence[str], top: int = 4) -> DataFrame:
    """A3 for categorical columns: missing, complete rate, distinct levels, the ``top``
    most common levels as ``"level: n"`` text (count desc, then level)."""
    allc = cut_lineage(level_counts(df, cols, keep_null=True))    # one pass, then small tables
    n_rows = allc.where(F.col("variable") == cols[0]).agg(F.sum("n")).scalar()
    counts = allc.where(F.col("level").isNotNull())
    # only the ``top`` leading levels of each variable are collected (salted two-stage top-k:
    # a variable with very many levels is never ordered in one task)
    tops = (top_k_rows(counts, ["variable"], [F.col("n").desc(), F.col("level")], top)
                  .groupBy("variable").agg(F.array_sort(F.collect_list(
                      F.struct((-F.col("n")).alias("neg_n"), F.col("level")))).alias("_top")))
    per = counts.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("n_complete")).join(tops, "variable")
    per = per.withColumn("top_counts", F.array_join(F.transform(
        "_top", lambda s: F.concat(s["level"], F.lit(": "), (-s["neg_n"]).cast("string"))), ", "))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return names.join(per.drop("_top"), "variable", "left").select(
        "variable",
        (F.lit(n_rows) - F.coalesce(F.col("n_complete"), F.lit(0))).cast("long").alias("n_missing"),
        (F.coalesce(F.col("n_complete"), F.lit(0)) / F.lit(n_rows)).alias("complete_rate"),
        F.coalesce(F.col("n_unique"), F.lit(0)).cast("long").alias("n_unique"),
        "top_counts")


# -- numeric ----------------------------------------------------------------------------

def skim_numeric(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """A3 for numeric columns: missing, complete rate, mean, sd (n-1), and the exact
    0/25/50/75/100 % quantiles (type 7). Moments in one aggregate; quantiles by two scans of
    the melted values (``method="approx"``: sketches alone). The columns are written once, so
    joins behind ``df`` run once and not in every scan."""
    m = melt(cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(cols)])), cols, "double")
    moments = m.groupBy("variable").agg(
        F.count_if(F.col("value").isNull()).cast("long").alias("n_missing"),
        (F.count("value") / F.count(F.lit(1))).alias("complete_rate"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    names = ["p0", "p25", "p50", "p75", "p100"]
    q = quantile_table(m, "value", probs, ["variable"], method)
    qw = q.groupBy("variable").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(nm)
                                     for p, nm in zip(probs, names)])
    return moments.join(qw, "variable", "left")


def skewness(df: DataFrame, cols: Sequence[str], moderate: float = 0.5, severe: float = 1.0) -> DataFrame:
    """Per column ``m3 / s^3`` (sample sd), and a class none / moderate / severe
    by absolute value; sorted by absolute skew, largest first. One aggregate."""
    wide = df.agg(*[X.skew_type3(c).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "variable", "skew")
    cls = (F.when(F.abs("skew") > severe, F.lit("severe"))
            .when(F.abs("skew") > moderate, F.lit("moderate")).otherwise(F.lit("none")))
    return long.withColumn("skew_class", cls).orderBy(F.abs("skew").desc())


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30,
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins centred on ``min + i*width`` with width = range/(bins-1),
    right-closed; ``(group..., variable, bin, center, n)``. Range per variable from one
    aggregate (a table of ``#variables`` rows); bin counts are partial aggregates."""
    m = melt(df, cols, "double", keep=group_cols).where(F.col("value").isNotNull())
    rng = m.groupBy("variable").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / F.lit(bins - 1))
    j = m.join(F.broadcast(rng), "variable")  # one row per variable: size = len(cols)
    idx = F.ceil((F.col("value") - F.col("_lo")) / width + F.lit(0.5)) - 1
    j = j.withColumn("bin", F.coalesce(F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1)), F.lit(0)).cast("int"))
    out = j.groupBy(*group_cols, "variable", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("_lo") + F.col("bin") * F.coalesce(width, F.lit(0.0))).alias("center"))
    return out


def binned_density(df: DataFrame, cols: Sequence[str], group_col: str, bins: int = 30) -> DataFrame:
    """Histogram per (variable, group) normalised to a density: count / (n_group * width).
    The group totals and widths come from the (small) histogram table itself."""
    h = cut_lineage(histogram(df, cols, bins, [group_col]))
    tot = h.groupBy(group_col, "variable").agg(F.sum("n").alias("_n"))
    # width = (max - min) / (bins - 1); the centres of the first and last bins give the range
    rng = h.groupBy("variable").agg(((F.max("center") - F.min("center")) / F.lit(bins - 1)).alias("_w"),
                                    F.max("bin").alias("_top"))
    rng = rng.withColumn("_w", F.when(F.col("_top") == bins - 1, F.col("_w")))
    return (h.join(tot, [group_col, "variable"]).join(rng.drop("_top"), "variable")
             .withColumn("density", F.when(F.col("_w") > 0, F.col("n") / (F.col("_n") * F.col("_w"))))
             .drop("_n", "_w"))


def box_stats(df: DataFrame, value: str, group_cols: Sequence[str] = (), coef: float = 1.5,
              method: str = "exact") -> DataFrame:
    """Per group the exact (type 7) quartiles, whiskers = most extreme values inside
    ``coef * IQR`` of the box, and the outlier count."""
    group_cols = list(group_cols)
    q = quantile_table(df, value, [0.25, 0.5, 0.75], group_cols, method)
    qw = q.groupBy(*group_cols).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - coef * F.col("iqr")
    hi = F.col("q3") + coef * F.col("iqr")
    base = df.where(F.col(value).isNotNull()).select(*group_cols, F.col(value).cast("double").alias("_v"))
    if group_cols:
        j = base.join(small_side(cut_lineage(qw)), group_cols)  # one row per group
    else:  # one row in all: a scalar, not a join
        j = base.withColumn("_q", qw.select(F.struct("q1", "median", "q3", "iqr")).scalar()).select("_v", "_q.*")
    v = F.col("_v")
    agg = j.groupBy(*group_cols, "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= lo, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi, v)).alias("upper_whisker"),
        F.count_if((v < lo) | (v > hi)).alias("n_outliers"))
    return agg


def extreme(df: DataFrame, column: str, how: str = "min") -> Column:
    """A10 as a scalar subquery column."""
    return df.agg((F.min(column) if how == "min" else F.max(column)).alias("_x")).scalar()


def best_row(df: DataFrame, metric: str, by: Sequence[str] = (), largest: bool = False) -> DataFrame:
    """O2 / ML12 ``bestTune``: the row with the smallest (or largest) metric, per group;
    ``min_by`` over a struct of the row, so no sort and no window."""
    others = [c for c in df.columns if c not in by]
    pick = F.max_by if largest else F.min_by
    agg = df.groupBy(*by).agg(pick(F.struct(*others), F.col(metric)).alias("_r"))
    return agg.select(*by, "_r.*")
