"""Evaluation: metrics, fold summaries, model comparison, residual tables, normality
(A16-A20, W1, W3, W6, J5, U2, ML11, ML14, F9, E13).

Metrics are single aggregates (per model/fold group). Residual standardisation divides by
a per-model sd from a small aggregate joined back (never an unpartitioned window).
Anderson-Darling and Q-Q use the distributed exact rank and one pandas UDF for the
normal CDF / quantile (``erf`` is not a Spark SQL function).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.operators.order import small_side, top_n_with_ties, with_group_rank
from tabreg.session import cut_lineage


def regression_metrics(df: DataFrame, pred: str = "pred", obs: str = "obs",
                       by: Sequence[str] = ()) -> DataFrame:
    """``rmse``, ``rsquared`` (squared correlation of pred and obs) and ``mae``."""
    e = F.col(pred) - F.col(obs)
    r = F.try_divide(F.covar_samp(pred, obs), F.stddev_samp(pred) * F.stddev_samp(obs))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.pow(r, 2).alias("rsquared"),
        F.avg(F.abs(e)).alias("mae"))


def residual_sd(df: DataFrame, pred: str = "pred", obs: str = "obs", by: Sequence[str] = ()) -> DataFrame:
    """Sample sd of the residuals, per group."""
    return df.groupBy(*by).agg(F.stddev_samp(F.col(pred) - F.col(obs)).alias("res_sd"))


def residual_table(df: DataFrame, pred: str = "pred", obs: str = "obs", label_from: str = "key",
                   by: Sequence[str] = (), obs_gap: float = 0.5, std_gap: float = 2.0) -> DataFrame:
    """ML14 + W6 + F9: residual, standardised residual (res / sd(res) of its group), and
    labels for rows with ``|obs - pred| > obs_gap`` and ``|stdres| > std_gap``.
    The sd comes from a per-group aggregate joined back (one row per model)."""
    res = df.withColumn("res", F.col(pred) - F.col(obs))
    sd = res.groupBy(*by).agg(F.stddev_samp("res").alias("_sd"))
    if by:
        j = res.join(small_side(cut_lineage(sd)), list(by))
    else:
        j = res.withColumn("_sd", sd.select("_sd").scalar())
    j = j.withColumn("stdres", F.try_divide(F.col("res"), F.col("_sd"))).drop("_sd")
    lab = F.col(label_from).cast("string")
    return (j.withColumn("obs_label", F.when(F.abs(F.col(obs) - F.col(pred)) > obs_gap, lab).otherwise(F.lit("")))
             .withColumn("std_label", F.when(F.abs(F.col("stdres")) > std_gap, lab).otherwise(F.lit(""))))


def fold_summary(fold_metrics: DataFrame, by: Sequence[str], metric: str = "rmse") -> DataFrame:
    """Mean and sd of a fold metric per group (e.g. per model and grid point)."""
    return fold_metrics.groupBy(*by).agg(F.avg(metric).alias(f"mean_{metric}"),
                                         F.stddev_samp(metric).alias(f"sd_{metric}"),
                                         F.count(F.lit(1)).alias("n_folds"))


def model_summary(fold_metrics: DataFrame, metric: str = "rmse", model: str = "model") -> DataFrame:
    """Min, quartiles (type 7), median, mean, max of a metric over folds, per model.
    A group is one model's folds (k rows), so the exact ``percentile`` buffers k values."""
    m = F.col(metric)
    return fold_metrics.groupBy(model).agg(
        F.min(m).alias("min"), F.percentile(m, 0.25).alias("q1"), F.percentile(m, 0.5).alias("median"),
        F.avg(m).alias("mean"), F.percentile(m, 0.75).alias("q3"), F.max(m).alias("max"))


def align_folds(fold_metrics: DataFrame, models: Sequence[str], metric: str = "rmse",
                fold: str = "fold", model: str = "model") -> DataFrame:
    """One row per fold, one column per model (a pivot with the model list given, so
    Spark does not scan for the distinct values)."""
    return fold_metrics.groupBy(fold).pivot(model, list(models)).agg(F.first(metric))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack metric rows by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_n_by(df: DataFrame, weight: str, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest signed values of ``weight`` with ties kept (``rank() <= n``),
    per group; no group is ordered in a single task (salted two-stage top-n)."""
    return top_n_with_ties(df, weight, n, by)


def scaled_importance(imp: DataFrame, value: str = "importance", by: Sequence[str] = ()) -> DataFrame:
    """ML11: min-max scale an importance column to 0..100 per group."""
    g = imp.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    j = imp.join(g, list(by)) if by else imp.withColumns(
        {"_lo": g.select("_lo").scalar(), "_hi": g.select("_hi").scalar()})
    return j.withColumn("scaled", F.try_divide((F.col(value) - F.col("_lo")) * 100.0,
                                               F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")


# -- normality: Q-Q pairs and Anderson-Darling ---------------------------------------------

@F.pandas_udf(T.DoubleType())
def norm_logcdf_udf(z: pd.Series) -> pd.Series:
    from tabreg.functions.stats import norm_logcdf
    return pd.Series(norm_logcdf(z.to_numpy(dtype=float)))


@F.pandas_udf(T.DoubleType())
def norm_ppf_udf(p: pd.Series) -> pd.Series:
    from tabreg.functions.stats import norm_ppf_array
    return pd.Series(norm_ppf_array(p.to_numpy(dtype=float)))


def qq_pairs(df: DataFrame, value: str, by: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Sample quantiles against theoretical normal quantiles at ``(i - a)/(n + 1 - 2a)``,
    a = 3/8 for n <= 10 else 1/2. Ranks by the distributed exact rank."""
    by = list(by)
    cols = by + [value] + ([key] if key else [])
    base = df.where(F.col(value).isNotNull()).select(*cols)
    order = [F.col(value)] + ([F.col(key)] if key else [F.xxhash64(*[F.col(c) for c in cols])])
    r = with_group_rank(base, by, order, rank_col="i", size_col="n")
    a = F.when(F.col("n") <= 10, F.lit(3.0 / 8)).otherwise(F.lit(0.5))
    return r.withColumn("theoretical", norm_ppf_udf((F.col("i") - a) / (F.col("n") + 1 - 2 * a)))


def anderson_darling(df: DataFrame, value: str, by: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Anderson-Darling normality statistic with estimated mean and sd, and its p.

    A2 = -n - (1/n) sum_i (2i - 1) [ln F(z_(i)) + ln(1 - F(z_(n+1-i)))]; regrouped so each
    row only needs its own rank i: sum_i [(2i - 1) ln F(z_i) + (2(n - i) + 1) ln F(-z_i)], with
    both logarithms taken without cutting off either tail. The rank's ties are broken by a hash of
    the whole row (or of ``key``), so the rows of one heavy value are spread over tasks.
    """
    by = list(by)
    tie = F.xxhash64(*([F.col(key)] if key else [F.col(c) for c in df.columns]))
    base = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"), tie.alias("_tie"))
    mom = base.groupBy(*by).agg(F.avg("_x").alias("_mu"), F.stddev_samp("_x").alias("_sd"))
    r = with_group_rank(base, by, [F.col("_x"), F.col("_tie")], rank_col="_i", size_col="_n")
    r = r.join(mom, by) if by else r.withColumns({"_mu": mom.select("_mu").scalar(),
                                                 "_sd": mom.select("_sd").scalar()})
    z = (F.col("_x") - F.col("_mu")) / F.col("_sd")
    term = ((2 * F.col("_i") - 1) * norm_logcdf_udf(z)
            + (2 * (F.col("_n") - F.col("_i")) + 1) * norm_logcdf_udf(-z))
    s = r.groupBy(*by, "_n").agg(F.sum(term).alias("_s"))
    out = s.select(*by, F.col("_n").alias("n"), (-F.col("_n") - F.col("_s") / F.col("_n")).alias("a2"))
    return out.withColumn("p_value", _ad_p_udf(F.col("a2"), F.col("n").cast("double")))


@F.pandas_udf(T.DoubleType())
def _ad_p_udf(a2: pd.Series, n: pd.Series) -> pd.Series:
    from tabreg.functions.stats import ad_pvalue
    return pd.Series([ad_pvalue(float(a), int(m)) for a, m in zip(a2, n)])
