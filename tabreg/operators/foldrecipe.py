"""Preprocessing refitted inside every fold, without a pass per fold (X3 with M1-M7).

The recipe of fold f is fitted on the rows of the other folds. All it needs are statistics that
subtract or add up over folds, so each is taken once, by fold, for all folds together:

* zero and near-zero variance: one melted count of (column, value) with a count per fold; the
  training counts of fold f are the totals less those of f;
* linear combinations, correlations, centring and scaling, and the fits themselves: one Gram
  block per fold, ``total - block(f)``;
* Box-Cox: the count, sum of logarithms and centred squares of the transformed column over a
  lambda grid, by fold, in two passes (a grid over the whole range, then a fine one around every
  fold's best value, whose parabola gives the exponent).

A Box-Cox column depends on its fold's exponent, so the Gram pass carries one more column per
(fold, transformed column). With k folds and p columns the driver sees k blocks of at most
(p + k p')^2 numbers, p' of them transformed; never a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.operators import matrix
from tabreg.operators.matrix import Gram, _packed, _tree_merge, gram
from tabreg.operators.profile import melt
from tabreg.session import cut_lineage

STEPS = ("zv", "nzv", "lincomb", "corr", "boxcox", "center", "scale")
COARSE = tuple(np.arange(-5.0, 5.001, 0.25))
FINE = 0.01
WHOLE = None                                    # the recipe of all rows


@dataclass(frozen=True)
class FoldRecipe:
    """Steps in the order in which they are fitted, with their cut-offs."""

    steps: Sequence[str] = STEPS
    freq_cut: float = 95 / 5
    unique_cut: float = 10.0
    corr_cut: float = 0.9
    fudge: float = 0.2                          # exponents this close to 0 or 1 become 0 or 1

    def __post_init__(self):
        if unknown := set(self.steps) - set(STEPS):
            raise ValueError(f"unknown steps {sorted(unknown)}")


@dataclass
class FittedRecipe:
    """One fold's recipe: the columns that went, by step, and the terms that stay."""

    fold: object
    dropped: dict[str, str] = field(default_factory=dict)            # column -> step
    source: dict[str, str] = field(default_factory=dict)             # term -> column
    lambdas: dict[str, float] = field(default_factory=dict)          # column -> exponent
    mean: dict[str, float] = field(default_factory=dict)
    sd: dict[str, float] = field(default_factory=dict)
    expressions: dict[str, Column] = field(default_factory=dict)     # of the terms that are no columns

    @property
    def terms(self) -> list[str]:
        return list(self.source)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the recipe's terms as columns, centred and scaled where the recipe does so;
        columns that the recipe dropped go."""
        scaled = {}
        for t in self.terms:
            e = self.expressions.get(t, F.col(t)).cast("double")
            if t in self.mean:
                e = e - F.lit(self.mean[t])
            if self.sd.get(t):
                e = e / F.lit(self.sd[t])
            scaled[t] = e
        return df.withColumns(scaled).drop(*[c for c in self.dropped if c in df.columns])

    def rows(self) -> list[tuple]:
        """``(column, step, lambda, center, scale)``; the step is ``kept`` for a term."""
        out = [(c, step, None, None, None) for c, step in self.dropped.items()]
        return out + [(c, "kept", self.lambdas.get(c), self.mean.get(t), self.sd.get(t)) for t, c in self.source.items()]


# -- variety of values ------------------------------------------------------------------

def value_variety(df: DataFrame, cols: Sequence[str], fold_col: str, folds: Sequence) -> dict:
    """``{fold: {column: (freq_ratio, percent_unique, levels)}}`` of the rows outside of each fold
    (``WHOLE``: of all rows). NULL is no value; a column with one value has ratio 0."""
    spark = df.sparkSession
    per_fold = [F.count_if(F.col(fold_col) == f).alias(f"n{i}") for i, f in enumerate(folds)]
    counts = cut_lineage(melt(df, cols, "double", keep=[fold_col]).groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"), *per_fold))
    # all folds side by side: a row per value and none per value and fold
    left = {-1: F.col("n")} | {i: F.col("n") - F.col(f"n{i}") for i in range(len(folds))}
    name = lambda what, i: f"{what}{i + 1}"
    held = {i: F.when((e > 0) & F.col("value").isNotNull(), e) for i, e in left.items()}
    first = counts.groupBy("variable").agg(*[a for i, e in left.items() for a in (
        F.sum(e).alias(name("rows", i)), F.max(held[i]).alias(name("top", i)), F.count(held[i]).alias(name("levels", i)))])
    first = {r["variable"]: r for r in first.collect()}                                      # one row a column
    top = spark.createDataFrame([(v, *[r[name("top", i)] for i in left]) for v, r in first.items()],
                                "variable string, " + ", ".join(f"{name('top', i)} long" for i in left))
    second = counts.join(F.broadcast(top), "variable").groupBy("variable").agg(*[a for i in left for a in (
        F.count_if(held[i] == F.col(name("top", i))).alias(name("at_top", i)),
        F.max(F.when(held[i] < F.col(name("top", i)), held[i])).alias(name("next", i)))])
    second = {r["variable"]: r for r in second.collect()}
    found = [{"variable": v, "part": i, "rows": r[name("rows", i)], "top": r[name("top", i)], "levels": r[name("levels", i)],
              "at_top": second[v][name("at_top", i)], "next": second[v][name("next", i)]} for v, r in first.items() for i in left]
    out: dict = {f: {} for f in [WHOLE, *folds]}
    for r in found:                                             # columns x (folds + 1)
        levels = r["levels"] or 0
        after = r["top"] if (r["at_top"] or 0) > 1 else r["next"]
        ratio = float(r["top"] / after) if levels > 1 else 0.0
        fold = WHOLE if r["part"] < 0 else folds[r["part"]]
        out[fold][r["variable"]] = (ratio, 100.0 * levels / r["rows"] if r["rows"] else 0.0, levels)
    return out


# -- Box-Cox exponents -------------------------------------------------------------------

def boxcox(x: Column, lam: float) -> Column:
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(float(lam))) - 1) / F.lit(float(lam))


def _add_profiles(a: list, b: list) -> list:
    """Joins (n, sum of logs, least value, mean and centred squares per lambda) of two row sets."""
    n = a[0] + b[0]
    wide = len(a[3]) // max(1, len(a[0]))
    na, nb = (np.repeat(v[0], wide) for v in (a, b))
    share = nb / np.maximum(na + nb, 1)
    d = b[3] - a[3]
    return [n, a[1] + b[1], np.fmin(a[2], b[2]), a[3] + d * share, a[4] + b[4] + d * d * na * share]


def boxcox_profiles(df: DataFrame, cols: Sequence[str], lambdas: Mapping[str, Sequence[float]],
                    by: Sequence[str] = ()) -> dict:
    """``{key: [n, sum of logs, least value, mean, centred squares]}`` by ``by`` in one pass: per
    column over its positive values (the least over all values), and per column and lambda for the
    transformed values. Every column has the same number of lambdas."""
    by, cols = list(by), list(cols)
    grid = np.array([list(lambdas[c]) for c in cols], float)
    arrays = ["n", "logs", "least", "mean", "squares"]
    sel = df.select(*by, *[F.col(c).cast("double").alias(f"_b{i}") for i, c in enumerate(cols)])
    schema = "".join(f"`{b}` {sel.schema[b].dataType.simpleString()}, " for b in by)
    schema += ", ".join(f"{a} array<double>" for a in arrays)

    def block(x: np.ndarray) -> list:
        n, logs, least = np.zeros(len(cols)), np.zeros(len(cols)), np.full(len(cols), np.nan)
        mean, squares = np.zeros(grid.shape), np.zeros(grid.shape)
        for i in range(len(cols)):
            v = x[:, i][~np.isnan(x[:, i])]
            if len(v):
                least[i] = v.min()
            log = np.log(v[v > 0])
            n[i], logs[i] = len(log), log.sum()
            for j, lam in enumerate(grid[i] if len(log) else ()):
                t = log if lam == 0 else np.expm1(lam * log) / lam
                mean[i, j] = t.mean()
                squares[i, j] = ((t - mean[i, j]) ** 2).sum()
        return [n, logs, least, mean.ravel(), squares.ravel()]

    def fold(batches):
        acc: dict[tuple, list] = {}
        for pdf in batches:
            for key, g in (pdf.groupby(by, sort=False, dropna=False) if by else [((), pdf)]):
                key = tuple(None if pd.isna(v) else v for v in (key if isinstance(key, tuple) else (key,)))
                b = block(g[[f"_b{i}" for i in range(len(cols))]].to_numpy(dtype=float))
                acc[key] = _add_profiles(acc[key], b) if key in acc else b
        if acc:
            yield _packed(acc, by, [], arrays)

    merged = _tree_merge(sel.mapInPandas(fold, schema), by, [], arrays, _add_profiles)
    return {tuple(r[b] for b in by): [np.array(r[a], float) for a in arrays] for r in merged.collect()}


def _loglik(profile: list, grid: np.ndarray) -> np.ndarray:
    """Profile log-likelihood per column and lambda; -inf where the column has no spread."""
    n, logs, squares = profile[0][:, None], profile[1][:, None], profile[4].reshape(grid.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        ll = -n / 2 * np.log(squares / n) + (grid - 1) * logs
    return np.where(np.isfinite(ll), ll, -np.inf)


def boxcox_exponents(df: DataFrame, cols: Sequence[str], fold_col: str | None = None, fudge: float = 0.2,
                     coarse: Sequence[float] = COARSE) -> dict:
    """``{fold: {column: (lambda, least training value)}}`` for the columns whose training values
    are all positive (``WHOLE``: all rows), in two passes over the table for all folds and columns.

    The lambda of the largest profile log-likelihood: the best of ``coarse``, then of a grid of
    step 0.01 between its neighbours, then the top of the parabola through the best three. A best
    value at an end of ``coarse`` stays there; a column without spread has no lambda."""
    cols = list(cols)
    if not cols:
        return {}
    by = [fold_col] if fold_col else []
    coarse = sorted(float(x) for x in coarse)
    first = boxcox_profiles(df, cols, {c: coarse for c in cols}, by)

    def parts(blocks: dict) -> dict:
        out = {}
        for leave in [WHOLE, *[k[0] for k in blocks if fold_col]]:
            total = None
            for key, b in blocks.items():
                if leave is WHOLE or key[0] != leave:
                    total = b if total is None else _add_profiles(total, b)
            if total is not None:
                out[leave] = total
        return out

    grid = np.tile(np.array(coarse), (len(cols), 1))
    start = {f: _loglik(p, grid).argmax(axis=1) for f, p in parts(first).items()}
    # the fine grids of all folds side by side; folds mostly agree, so equal cells share one grid
    cells = {i: sorted({int(s[i]) for s in start.values()}) for i in range(len(cols))}
    widest = max(len(v) for v in cells.values())
    step = max(b - a for a, b in zip(coarse, coarse[1:]))
    m = int(round(step / FINE))
    fine = np.arange(-m, m + 1) * (step / m)
    lams = {c: np.concatenate([coarse[k] + fine for k in (cells[i] * widest)[:widest]]) for i, c in enumerate(cols)}
    second = boxcox_profiles(df, cols, lams, by)
    grid = np.array([lams[c] for c in cols])
    out: dict = {}
    for f, p in parts(second).items():
        ll, out[f] = _loglik(p, grid), {}
        for i, c in enumerate(cols):
            cell = cells[i].index(int(start[f][i]))
            mine = slice(cell * len(fine), (cell + 1) * len(fine))
            l, x = ll[i, mine], grid[i, mine]
            if not p[0][i] or not p[2][i] > 0 or not np.isfinite(l).any():
                continue
            k = int(l.argmax())
            lam = x[k]
            if 0 < k < len(l) - 1 and np.isfinite(l[k - 1:k + 2]).all():
                bend = l[k - 1] - 2 * l[k] + l[k + 1]
                if bend < 0:
                    lam += (x[1] - x[0]) * 0.5 * (l[k - 1] - l[k + 1]) / bend
            lam = min(max(lam, coarse[0]), coarse[-1])
            lam = 0.0 if abs(lam) < fudge else 1.0 if abs(lam - 1) < fudge else float(lam)
            out[f][c] = (lam, float(p[2][i]))
    return out


# -- the statistics of all folds ------------------------------------------------------------

@dataclass
class FoldStatistics:
    """What every fold's recipe and fit are computed from."""

    recipe: FoldRecipe
    features: list[str]
    label: str | None
    folds: list
    blocks: dict                                # fold -> Gram of its rows
    total: Gram
    variety: dict
    exponents: dict
    columns: dict[str, Column]                  # Box-Cox terms of all folds

    def train(self, fold) -> Gram:
        return self.total if fold is WHOLE else self.total - self.blocks[fold]

    def fitted(self, fold=WHOLE) -> FittedRecipe:
        """The recipe fitted on the rows outside of ``fold`` (``WHOLE``: on all rows)."""
        g, out, left = self.train(fold), FittedRecipe(fold), list(self.features)
        terms = {c: c for c in left}
        for step in self.recipe.steps:
            gone: list[str] = []
            if step in ("zv", "nzv"):
                of = self.variety[fold]
                gone = [c for c in left if of[c][2] <= 1 or (
                    step == "nzv" and of[c][0] > self.recipe.freq_cut and of[c][1] <= self.recipe.unique_cut)]
            elif step == "lincomb":
                gone = matrix.linear_combos(g, [terms[c] for c in left])
                gone = [c for c in left if terms[c] in gone]
            elif step == "corr" and len(left) > 1:
                names = [terms[c] for c in left]
                gone = matrix.high_correlation(matrix.correlation_from_gram(g, names), names, self.recipe.corr_cut)
                gone = [c for c in left if terms[c] in gone]
            elif step == "boxcox":
                for c, (lam, least) in self.exponents.get(fold, {}).items():
                    if c in left and lam != 1.0:
                        terms[c] = _term(c, fold)
                        out.lambdas[c] = lam
                        out.expressions[terms[c]] = self.columns[terms[c]]
            out.dropped |= {c: step for c in gone}
            left = [c for c in left if c not in gone]
        out.source = {terms[c]: c for c in left}
        if {"center", "scale"} & set(self.recipe.steps) and left:
            mean = g.means(out.terms)
            sd = np.sqrt(np.clip(np.diag(g.centred(out.terms)), 0, None) / max(g.n - 1, 1))
            out.mean = dict(zip(out.terms, map(float, mean))) if "center" in self.recipe.steps else {}
            out.sd = dict(zip(out.terms, map(float, sd))) if "scale" in self.recipe.steps else {}
        return out


def _term(column: str, fold) -> str:
    return f"{column}__bc" if fold is WHOLE else f"{column}__bc_{fold}"


def fold_statistics(df: DataFrame, features: Sequence[str], label: str | None, fold_col: str,
                    recipe: FoldRecipe = FoldRecipe()) -> FoldStatistics:
    """One melted count (with zv or nzv), two passes for Box-Cox exponents (with boxcox) and one
    Gram pass, by fold, whatever the number of folds.

    ``features`` are numeric columns (factors go through ``ContrastEncoder`` first, whose levels are
    those of the codebook, so a level that only the held-out rows show is an indicator without
    variance in training and goes). Rows with a NULL among the features are left out of the Gram
    blocks with a warning; rows without a fold or label should be filtered before. A column is
    transformed in a fold if its training values are positive; a held-out value that is not takes
    the least training value."""
    features = list(features)
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())      # k values
    variety = value_variety(df, features, fold_col, folds) if {"zv", "nzv"} & set(recipe.steps) else {}
    exponents: dict = {}
    columns: dict[str, Column] = {}
    if "boxcox" in recipe.steps:
        # an indicator or a column with a value at or below 0 in two folds is positive in no training part
        low = df.groupBy(fold_col).agg(*[F.min(c).alias(f"m{i}") for i, c in enumerate(features)]).collect()
        able = [c for i, c in enumerate(features) if sum(r[f"m{i}"] is not None and r[f"m{i}"] <= 0 for r in low) < 2]
        exponents = boxcox_exponents(df, able, fold_col, recipe.fudge)
        for f, of in exponents.items():
            for c, (lam, least) in of.items():
                if lam != 1.0:
                    x = F.col(c).cast("double")
                    columns[_term(c, f)] = boxcox(F.when(x <= 0, F.lit(least)).otherwise(x), lam)
    wide = df.withColumns(columns) if columns else df
    blocks = {k[0]: b for k, b in gram(wide, [*features, *columns], label, by=[fold_col]).items()}
    total = None
    for b in blocks.values():
        total = b if total is None else total + b
    return FoldStatistics(recipe, features, label, folds, blocks, total, variety, exponents, columns)


def recipe_table(stats: FoldStatistics, spark) -> DataFrame:
    """``(fold, variable, step, lambda, center, scale)`` of every fold's recipe."""
    rows = [(int(f), *r) for f in stats.folds for r in stats.fitted(f).rows()]
    return spark.createDataFrame(rows, "fold int, variable string, step string, lambda double, center double, scale double")


__all__ = ["FoldRecipe", "FittedRecipe", "FoldStatistics", "fold_statistics", "recipe_table", "boxcox_exponents",
           "boxcox_profiles", "value_variety", "STEPS", "WHOLE"]
