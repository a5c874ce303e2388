"""Label-stratified, reproducible hold-out split and k folds.

Rows are binned by quantile break points of the label (exact type-7 quantiles); inside a
bin they are ordered by ``md5(seed|key)``. The position inside the bin decides: the first
``ceil(p * n_bin)`` positions go to training, and fold = ``(position - 1) % k + 1``.
Positions come from ``order.with_hash_rank`` (counts per hash prefix, one exchange of the
rows), so a bin holding a third of all rows is still spread over many tasks. The result is an
assignment table keyed by the row key; callers attach it with semi / anti / equi joins.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators.order import with_hash_rank
from tabreg.operators.quantiles import quantile_table


def label_breaks(df: DataFrame, label: str, n_breaks: int = 5, method: str = "exact") -> DataFrame:
    """One row of break points ``b0 <= ... <= b{n-1}`` (quantiles at 0, 1/(n-1), ... 1);
    ``method="approx"`` takes them from a quantile sketch instead of a sort."""
    probs = [float(x) for x in np.linspace(0.0, 1.0, n_breaks)]
    q = quantile_table(df, label, probs, (), method)     # callers pass a narrow (key, label) table
    return q.agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"b{i}")
                   for i, p in enumerate(probs)])


def with_label_bin(df: DataFrame, label: str, n_breaks: int = 5, bin_col: str = "bin",
                   method: str = "exact") -> DataFrame:
    """Bin = 1 + number of interior break points strictly below the label (right-closed
    intervals, lowest included). Duplicate break points merge bins, as ``unique`` does."""
    br = label_breaks(df, label, n_breaks, method)
    interior = [br.select(f"b{i}").scalar() for i in range(1, n_breaks - 1)]   # scalar subqueries
    b = F.lit(1)
    for s in interior:
        b = b + (F.col(label) > s).cast("int")
    return df.withColumn(bin_col, b)


def _cuts_for_folds(n: int, k: int) -> int:
    cuts = n // k
    return int(min(max(cuts, 2), 5))


def _ranked(df: DataFrame, key: str, label: str, seed, n_breaks: int, method: str = "exact") -> DataFrame:
    base = df.where(F.col(label).isNotNull()).select(key, label)
    binned = with_label_bin(base, label, n_breaks, method=method)
    return with_hash_rank(binned, ["bin"], X.md5_order(seed, key), [key], rank_col="pos", size_col="n_bin")


def stratified_split(df: DataFrame, key: str, label: str, p: float = 0.8, seed=12345,
                     n_breaks: int = 5, method: str = "exact") -> DataFrame:
    """``(key, bin, pos, n_bin, split)`` with split = 'train' for the first
    ``ceil(p * n_bin)`` rows of each bin in md5 order, else 'holdout'. ``method`` chooses
    exact or sketched bin break points."""
    r = _ranked(df, key, label, seed, n_breaks, method)
    return r.withColumn("split", F.when(F.col("pos") <= F.ceil(F.col("n_bin") * F.lit(p)), F.lit("train"))
                        .otherwise(F.lit("holdout"))).select(key, "bin", "pos", "n_bin", "split")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 10, seed=12345,
                     n_breaks: int | None = None, method: str = "exact") -> DataFrame:
    """``(key, bin, fold)``, fold in 1..k, balanced inside every label bin.
    ``n_breaks`` defaults to ``min(max(n // k, 2), 5)`` break points."""
    if n_breaks is None:
        n = df.where(F.col(label).isNotNull()).count()
        n_breaks = _cuts_for_folds(n, k)
    r = _ranked(df, key, label, seed, n_breaks, method)
    return r.withColumn("fold", ((F.col("pos") - 1) % k + 1).cast("int")).select(key, "bin", "fold")


def keep_rows(df: DataFrame, assignment: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in the (filtered) assignment -- a semi join."""
    a = assignment if where is None else assignment.where(where)
    return df.join(a.select(key), key, "left_semi")


def drop_rows(df: DataFrame, assignment: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose key is *not* in the (filtered) assignment -- an anti join."""
    a = assignment if where is None else assignment.where(where)
    return df.join(a.select(key), key, "left_anti")


def expected_train_size(bin_sizes: list[int], p: float) -> int:
    """Sum of ``ceil(p * n_bin)``; for tests and reports."""
    return int(sum(math.ceil(p * n) for n in bin_sizes))
