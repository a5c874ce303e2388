"""Feature-matrix operators (M1-M7) and the one-pass Gram matrix.

The Gram matrix of ``[1, x_1..x_p, y]`` holds every sufficient statistic a linear model
needs: n, the sums, X'X, X'y and y'y. It is computed in ONE pass and kept centred (count,
means, centred cross products): every task folds its rows with numpy (``mapInPandas``) into
one packed row, and the packed rows are merged in two levels. With ``by`` (e.g. the fold
column) one pass gives a block per group; a training fold's matrix is then
``total - block(fold)``. Only p x p matrices reach the driver, never rows.

M1 near-zero variance and M2 zero variance come from aggregates; M3 linear
combinations and M4 high correlations from the Gram matrix; M5 Box-Cox lambda from one
aggregate over a lambda grid; M6 centring/scaling from one aggregate; M7 is a recipe of
fitted steps applied by projection.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.operators.profile import near_zero_variance

ONE = "(Intercept)"


def _tree_merge(blocks: DataFrame, by: Sequence[str], state: Sequence[str], arrays: Sequence[str], add) -> DataFrame:
    """Fold the tasks' packed blocks to one row per ``by`` key: first in about the square root of
    the shuffle partitions, then one task per key, reading them batch by batch. ``add(a, b)``
    joins two blocks given as lists in the order ``state`` (scalars) + ``arrays``."""
    by = list(by)
    width = max(1, math.isqrt(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def fold(batches):
        acc: dict[tuple, list] = {}
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                key = tuple(None if pd.isna(v) else v for v in row[:len(by)])
                block = [np.asarray(v, dtype=float) for v in row[len(by):]]
                acc[key] = add(acc[key], block) if key in acc else block
        if acc:
            yield _packed(acc, by, state, arrays)

    some = blocks.repartition(width).mapInPandas(fold, blocks.schema)
    return (some.repartition(width, *by) if by else some.repartition(1)).mapInPandas(fold, blocks.schema)


def _packed(acc: dict, by: Sequence[str], state: Sequence[str], arrays: Sequence[str]) -> pd.DataFrame:
    """One row per key: its scalars and its matrices as flat lists."""
    cols = {b: [k[i] for k in acc] for i, b in enumerate(by)}
    cols |= {c: [float(v[i]) for v in acc.values()] for i, c in enumerate(state)}
    cols |= {c: [v[len(state) + i].ravel() for v in acc.values()] for i, c in enumerate(arrays)}
    return pd.DataFrame(cols)


def _add_centred(a: list, b: list) -> list:
    """Joins (n, skipped, mean, centred cross products) of two row sets without ever forming
    raw sums, so columns with a large mean and a small spread keep their digits."""
    n = a[0] + b[0]
    if n == 0:
        return [n, a[1] + b[1], a[2], a[3]]
    q = a[2].size
    d = b[2] - a[2]
    c = a[3].reshape(q, q) + b[3].reshape(q, q) + np.outer(d, d) * (a[0] * b[0] / n)
    return [n, a[1] + b[1], a[2] + d * (b[0] / n), c]


def gram_blocks(df: DataFrame, features: Sequence[str], label: str | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, skipped, mean, cross)``: per key the row count, the means and the centred
    cross products of ``[features..., label]`` as flat arrays.

    Every task emits one packed row per key, merged in two levels, so the shuffle carries
    tasks x keys rows whatever the number of columns. Rows with a NULL in a used column are
    left out, as a model fit does, and counted in ``skipped``.
    """
    by = list(by)
    used = [*features] + ([label] if label else [])
    ucols = [f"_g{k}" for k in range(len(used))]
    sel = df.select(*by, *[F.col(c).cast("double").alias(u) for c, u in zip(used, ucols)])
    schema = "".join(f"`{b}` {sel.schema[b].dataType.simpleString()}, " for b in by)
    schema += "n double, skipped double, mean array<double>, cross array<double>"
    state, arrays = ["n", "skipped"], ["mean", "cross"]

    def fold(batches):
        acc: dict[tuple, list] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            for key, g in (pdf.groupby(by, sort=False, dropna=False) if by else [((), pdf)]):
                key = tuple(None if pd.isna(v) else v for v in (key if isinstance(key, tuple) else (key,)))
                x = g[ucols].to_numpy(dtype=float)
                whole = ~np.isnan(x).any(axis=1)
                skipped, x = float((~whole).sum()), x[whole]
                mean = x.mean(axis=0) if len(x) else np.zeros(len(used))
                z = x - mean
                block = [float(len(x)), skipped, mean, z.T @ z]
                acc[key] = _add_centred(acc[key], block) if key in acc else block
        if acc:
            yield _packed(acc, by, state, arrays)

    return _tree_merge(sel.mapInPandas(fold, schema), by, state, arrays, _add_centred)


def gram_long(df: DataFrame, features: Sequence[str], label: str | None = None,
              by: Sequence[str] = ()) -> DataFrame:
    """``(by..., i, j, name_i, name_j, value)``: the raw sums of products for i <= j over
    ``[1, features..., label]``, from the merged blocks."""
    by = list(by)
    names = [ONE, *features] + ([label] if label else [])
    iu = np.triu_indices(len(names))
    merged = gram_blocks(df, features, label, by)
    schema = "".join(f"`{b}` {merged.schema[b].dataType.simpleString()}, " for b in by)
    schema += "i int, j int, name_i string, name_j string, value double"

    def unpack(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                n, skipped, mean, cross = row[len(by):]
                m = Gram(names, n, np.asarray(mean), np.asarray(cross).reshape(len(mean), -1)).m
                out = {b: [row[i]] * len(iu[0]) for i, b in enumerate(by)}
                out |= {"i": iu[0].astype("int32"), "j": iu[1].astype("int32"), "name_i": [names[i] for i in iu[0]],
                        "name_j": [names[j] for j in iu[1]], "value": m[iu]}
                yield pd.DataFrame(out)

    return merged.mapInPandas(unpack, schema)


@dataclass
class Gram:
    """Collected sufficient statistics over ``names = [1, features..., label]``: the row count,
    the means and the centred cross products of ``names[1:]``."""

    names: list[str]
    n: float
    mean: np.ndarray
    cross: np.ndarray
    skipped: float = 0.0

    def _at(self, cols: Sequence[str]) -> list[int]:
        return [self.names.index(c) - 1 for c in cols]

    @property
    def m(self) -> np.ndarray:
        """The raw Gram matrix."""
        full = np.concatenate([[1.0], self.mean])
        out = self.n * np.outer(full, full)
        out[1:, 1:] += self.cross
        return out

    def means(self, cols: Sequence[str]) -> np.ndarray:
        return self.mean[self._at(cols)]

    def centred(self, rows: Sequence[str], cols: Sequence[str] | None = None) -> np.ndarray:
        """Centred cross products of ``rows`` with ``cols`` (default: with themselves)."""
        return self.cross[np.ix_(self._at(rows), self._at(rows if cols is None else cols))]

    def cov_pop(self, cols: Sequence[str]) -> np.ndarray:
        return self.centred(cols) / self.n

    def __add__(self, other: "Gram") -> "Gram":
        n, skipped, mean, cross = _add_centred([self.n, self.skipped, self.mean, self.cross],
                                               [other.n, other.skipped, other.mean, other.cross])
        return Gram(self.names, n, mean, cross, skipped)

    def __sub__(self, other: "Gram") -> "Gram":
        n = self.n - other.n
        if n <= 0:
            return Gram(self.names, 0.0, np.zeros_like(self.mean), np.zeros_like(self.cross), self.skipped - other.skipped)
        mean = self.mean + (self.mean - other.mean) * (other.n / n)
        d = other.mean - mean
        cross = self.cross - other.cross - np.outer(d, d) * (n * other.n / self.n)
        return Gram(self.names, n, mean, cross, self.skipped - other.skipped)


def gram(df: DataFrame, features: Sequence[str], label: str | None = None,
         by: Sequence[str] = ()) -> dict:
    """``{group_key: Gram}`` (``()`` without ``by``); #groups x p^2 numbers reach the driver,
    independent of the row count. Warns when rows were left out for a NULL."""
    names = [ONE, *features] + ([label] if label else [])
    q = len(names) - 1
    out: dict = {} if by else {(): Gram(names, 0.0, np.zeros(q), np.zeros((q, q)))}
    for r in gram_blocks(df, features, label, by).collect():
        out[tuple(r[b] for b in by)] = Gram(names, r["n"], np.array(r["mean"]), np.array(r["cross"]).reshape(q, q),
                                            r["skipped"])
    if skipped := sum(g.skipped for g in out.values()):
        warnings.warn(f"{skipped:.0f} rows with a NULL among the used columns are left out of the fit", RuntimeWarning)
    return out


# -- M2 / M1 ------------------------------------------------------------------------------

def zero_variance_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """M2: columns with one distinct non-missing value (min = max) or none."""
    row = df.agg(*[(F.min(c) == F.max(c)).alias(f"{c}") for c in cols]).first()
    return [c for c in cols if row[c] is None or row[c]]


def near_zero_variance_columns(df: DataFrame, cols: Sequence[str], freq_cut: float = 95 / 5,
                               unique_cut: float = 10.0) -> list[str]:
    """M1: names flagged by the near-zero-variance screen."""
    nz = near_zero_variance(df, cols, freq_cut, unique_cut)
    return [r["variable"] for r in nz.where("nzv").select("variable").collect()]


# -- M3 / M4 from the Gram matrix -----------------------------------------------------------

def linear_combos(g: Gram, cols: Sequence[str], tol: float = 1e-9) -> list[str]:
    """M3: columns (in order) that are exact linear combinations of earlier kept columns
    and the intercept: the residual sum of squares of regressing a column on the kept
    ones, read off the centred cross-product matrix, is ~0."""
    c, mean = g.centred(cols), g.means(cols)
    sd = np.sqrt(np.clip(np.diag(c), 0.0, None))
    constant = np.diag(c) <= 1e-28 * g.n * mean ** 2
    sd[sd == 0] = 1.0
    c = c / np.outer(sd, sd)                                  # columns of very different size
    kept: list[int] = []
    drop: list[str] = []
    for k, name in enumerate(cols):
        ss = c[k, k]
        if kept:
            a = c[np.ix_(kept, kept)]
            b = c[kept, k]
            coef = np.linalg.lstsq(a, b, rcond=None)[0]
            ss = ss - b @ coef
        if ss <= tol * max(c[k, k], 1e-300) or constant[k]:
            drop.append(name)
        else:
            kept.append(k)
    return drop


def correlation_from_gram(g: Gram, cols: Sequence[str]) -> np.ndarray:
    c = g.cov_pop(cols)
    sd = np.sqrt(np.clip(np.diag(c), 0, None))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = c / np.outer(sd, sd)
    return r


def high_correlation(r: np.ndarray, names: Sequence[str], cutoff: float = 0.9) -> list[str]:
    """M4: greedy removal. Columns are visited by mean |r| (largest first); in every pair
    above the cutoff the member with the larger mean |r| to the still-kept columns goes."""
    a = np.abs(np.nan_to_num(r.copy()))
    np.fill_diagonal(a, np.nan)
    p = len(names)
    order = np.argsort(-np.nanmean(a, axis=0), kind="stable")
    deleted = np.zeros(p, dtype=bool)
    for ii in range(p - 1):
        i = order[ii]
        for jj in range(ii + 1, p):
            j = order[jj]
            if deleted[i] or deleted[j]:
                continue
            if a[i, j] > cutoff:
                keep = ~deleted
                mi = np.nanmean(np.where(keep, a[i], np.nan))
                mj = np.nanmean(np.where(keep, a[j], np.nan))
                deleted[i if mi > mj else j] = True
    return [names[k] for k in range(p) if deleted[k]]


# -- M5 Box-Cox ---------------------------------------------------------------------------

def boxcox_profile(df: DataFrame, cols: Sequence[str], lambdas: Sequence[float]) -> DataFrame:
    """M5: profile log-likelihood of the Box-Cox transform for every (column, lambda) in
    one aggregate: ``-n/2 ln(var_pop(t_lambda(x))) + (lambda - 1) sum(ln x)`` over the
    strictly positive values; ``(variable, lam, loglik)``."""
    aggs = []
    for c in cols:
        x = F.when(F.col(c) > 0, F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"{c}|n"), F.sum(F.log(x)).alias(f"{c}|sl")]
        for k, lam in enumerate(lambdas):
            t = F.log(x) if lam == 0 else (F.pow(x, F.lit(float(lam))) - 1) / float(lam)
            aggs.append(F.var_pop(t).alias(f"{c}|v{k}"))
    wide = df.agg(*aggs)
    recs = []
    for c in cols:
        for k, lam in enumerate(lambdas):
            n, sl, v = F.col(f"`{c}|n`"), F.col(f"`{c}|sl`"), F.col(f"`{c}|v{k}`")
            ll = -n / 2 * F.log(v) + F.lit(float(lam) - 1) * sl
            recs.append(F.struct(F.lit(c).alias("variable"), F.lit(float(lam)).alias("lam"), ll.alias("loglik")))
    return wide.select(F.explode(F.array(*recs)).alias("_b")).select("_b.*")


def boxcox_lambdas(df: DataFrame, cols: Sequence[str], lambdas: Sequence[float] | None = None,
                   fudge: float = 0.2) -> dict[str, float]:
    """Best lambda per column, snapped to 0 or 1 within ``fudge``: two passes over all columns at
    once (``foldrecipe.boxcox_exponents``), or, where ``lambdas`` lists them, the best of these. A
    column without spread or with a value that is not positive keeps 1 (no transform)."""
    if lambdas is None:
        from tabreg.operators.foldrecipe import WHOLE, boxcox_exponents
        found = boxcox_exponents(df, cols, None, fudge).get(WHOLE, {})
        return {c: found[c][0] if c in found else 1.0 for c in cols}
    prof = boxcox_profile(df, cols, lambdas)
    best = prof.groupBy("variable").agg(F.max_by("lam", "loglik").alias("lam")).collect()
    out = {}
    for r in best:
        lam = 1.0 if r["lam"] is None else float(r["lam"])       # constant column: no finite likelihood
        out[r["variable"]] = 0.0 if abs(lam) < fudge else 1.0 if abs(lam - 1) < fudge else lam
    return out


# -- M6 / M7: fitted steps -------------------------------------------------------------

@dataclass
class FittedStep:
    exprs: dict = field(default_factory=dict)
    drop: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns(self.exprs) if self.exprs else df
        return out.drop(*self.drop) if self.drop else out


@dataclass
class Standardize:
    """M6: centre and scale by the sample sd (one aggregate at fit)."""
    cols: Sequence[str]
    center: bool = True
    scale: bool = True

    def fit(self, df: DataFrame) -> FittedStep:
        r = df.agg(*[F.avg(c).alias(f"m|{c}") for c in self.cols],
                   *[F.stddev_samp(c).alias(f"s|{c}") for c in self.cols]).first()
        ex = {}
        for c in self.cols:
            v = F.col(c).cast("double")
            if self.center:
                v = v - F.lit(r[f"m|{c}"])
            if self.scale and r[f"s|{c}"]:
                v = v / F.lit(r[f"s|{c}"])
            ex[c] = v
        step = FittedStep(ex)
        step.params = {c: (r[f"m|{c}"], r[f"s|{c}"]) for c in self.cols}
        return step


@dataclass
class BoxCox:
    """M5 as a step: per strictly positive column, the grid-argmax lambda."""
    cols: Sequence[str]
    lambdas: Sequence[float] | None = None

    def fit(self, df: DataFrame) -> FittedStep:
        pos = df.agg(*[F.min(c).alias(c) for c in self.cols]).first()
        cols = [c for c in self.cols if pos[c] is not None and pos[c] > 0]
        lams = boxcox_lambdas(df, cols, self.lambdas) if cols else {}
        ex = {}
        for c, lam in lams.items():
            if lam == 1.0:
                continue
            x = F.col(c).cast("double")
            ex[c] = F.when(x > 0, F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam)
        step = FittedStep(ex)
        step.params = lams
        return step


@dataclass
class DropColumns:
    """A step that drops columns chosen at fit time by a rule (zv / nzv / lincomb / corr)."""
    cols: Sequence[str]
    rule: str = "zv"
    cutoff: float = 0.9

    def fit(self, df: DataFrame) -> FittedStep:
        cols = list(self.cols)
        if self.rule == "zv":
            drop = zero_variance_columns(df, cols)
        elif self.rule == "nzv":
            drop = near_zero_variance_columns(df, cols)
        else:
            g = gram(df, cols)[()]
            if self.rule == "lincomb":
                drop = linear_combos(g, cols)
            else:
                drop = high_correlation(correlation_from_gram(g, cols), cols, self.cutoff)
        return FittedStep({}, drop)


@dataclass
class Recipe:
    """M7: an ordered list of steps; ``fit`` fits each on the output of the previous
    (on the training table only), ``transform`` applies the fitted projections anywhere."""
    steps: list

    def fit(self, df: DataFrame) -> "FittedRecipe":
        fitted = []
        cur = df
        for s in self.steps:
            f = s.fit(cur)
            fitted.append(f)
            cur = f.transform(cur)
        return FittedRecipe(fitted)


@dataclass
class FittedRecipe:
    steps: list

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s.transform(df)
        return df


# -- pairwise-complete moments (correlations with missing values) ---------------------------

def pairwise_moments(df: DataFrame, cols: Sequence[str], indicators: Sequence[str] = ()) -> DataFrame:
    """One pass: for every pair (i, j) of ``cols`` (plus 0/1 missing indicators of
    ``indicators``, named ``<col>__isna``), over the rows where both are present: the count
    ``n``, the means ``mx, my`` and the centred sums ``cxx, cyy, cxy``. Each task folds its rows
    with a few matrix products on values shifted by the batch means, emits one packed row, and
    the rows are merged in two levels. Only p^2 rows come out, whatever the row count.
    """
    cols = list(cols)
    names = cols + [f"{c}__isna" for c in indicators]
    exprs = [F.col(c).cast("double").alias(f"_p{k}") for k, c in enumerate(cols)]
    exprs += [F.col(c).isNull().cast("double").alias(f"_p{len(cols) + k}") for k, c in enumerate(indicators)]
    p = len(names)
    sel = df.select(*exprs)
    pc = [f"_p{k}" for k in range(p)]

    def fold(batches):
        acc = None
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[pc].to_numpy(dtype=float)
            m = (~np.isnan(x)).astype(float)
            shift = np.nan_to_num(x).sum(axis=0) / np.maximum(m.sum(axis=0), 1.0)
            x0 = np.nan_to_num(x - shift)
            n = m.T @ m
            per = np.maximum(n, 1.0)
            sx = x0.T @ m                       # sx[i, j] = sum of x_i where x_i and x_j present
            cxx = (x0 * x0).T @ m - sx * sx / per
            mx = sx / per + shift[:, None]
            blk = [n, mx, mx.T, cxx, cxx.T, x0.T @ x0 - sx * sx.T / per]
            acc = blk if acc is None else _add_pairs(acc, blk)
        if acc is not None:
            yield _packed({(): acc}, [], [], _MOMENTS)

    def unpack(batches):
        ii, jj = (k.ravel() for k in np.meshgrid(np.arange(p), np.arange(p), indexing="ij"))
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                yield pd.DataFrame({"var_x": [names[i] for i in ii], "var_y": [names[j] for j in jj],
                                    **{k: np.asarray(v) for k, v in zip(_MOMENTS, row)}})

    blocks = sel.mapInPandas(fold, ", ".join(f"{k} array<double>" for k in _MOMENTS))
    merged = _tree_merge(blocks, [], [], _MOMENTS, _add_pairs)
    return merged.mapInPandas(unpack, "var_x string, var_y string, " + ", ".join(f"{k} double" for k in _MOMENTS))


_MOMENTS = ["n", "mx", "my", "cxx", "cyy", "cxy"]


def _add_pairs(a: list, b: list) -> list:
    """Joins the pairwise moments of two row sets, element by element."""
    a, b = [np.ravel(v) for v in a], [np.ravel(v) for v in b]
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * share
    return [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w,
            a[5] + b[5] + dx * dy * w]


def corr_from_moments(m: DataFrame) -> DataFrame:
    """Pearson r per pair from ``pairwise_moments``; NULL when a side is constant (its spread
    is within the rounding of its mean)."""
    n = F.col("n")
    spread = lambda c, mean: F.col(c) > F.lit(1e-28) * n * F.col(mean) * F.col(mean)
    r = F.when(spread("cxx", "mx") & spread("cyy", "my"), F.col("cxy") / (F.sqrt("cxx") * F.sqrt("cyy")))
    return m.select("var_x", "var_y", F.col("n").cast("long").alias("n"), r.alias("r"))
