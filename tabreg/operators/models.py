"""Regression models (ML1-ML11, ML13).

Linear family (OLS, stepwise AIC, ridge, lasso, elastic net, MARS) from ONE distributed
Gram pass plus a p x p solve on the driver; MLlib ``LinearRegression`` for the OLS
coefficient table (standard errors, t, p); MLlib forests and boosting for tree models.
Scoring a linear fit is a column expression (no UDF, no model broadcast beyond literals).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions import linalg
from tabreg.functions.stats import t_two_sided
from tabreg.operators.matrix import ONE, gram
from tabreg.operators.order import top_n_with_ties
from tabreg.operators.quantiles import exact_quantiles


# -- linear predictors as column expressions ---------------------------------------------

def linear_expr(fit: linalg.LinearFit) -> Column:
    e = F.lit(float(fit.intercept))
    for c, b in zip(fit.features, fit.coef):
        if b != 0.0:
            e = e + F.col(c).cast("double") * F.lit(float(b))
    return e


def predict_linear(df: DataFrame, fit: linalg.LinearFit, out: str = "pred") -> DataFrame:
    """ML13 for linear fits: one projection."""
    return df.withColumn(out, linear_expr(fit))


def coefficient_frame(spark, fit: linalg.LinearFit, model: str) -> DataFrame:
    rows = [(model, k, float(v)) for k, v in fit.as_dict().items()]
    return spark.createDataFrame(rows, "model string, variable string, estimate double")


# -- ML1 / ML2: OLS with the coefficient table -------------------------------------------

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """The feature vector column; a row with a NULL or NaN feature is an error, never left out."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def ols_table(df: DataFrame, features: Sequence[str], label: str, model: str = "lm") -> DataFrame:
    """ML2: ``(model, variable, estimate, std_error, t, p)`` from MLlib's normal-equation
    solver (one distributed pass for the normal equations). MLlib lists the intercept
    last in its summary arrays; we name it ``(Intercept)``."""
    data = assemble(df.where(F.col(label).isNotNull()), features)
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0,
                          elasticNetParam=0.0, standardization=False, fitIntercept=True)
    m = lr.fit(data)
    s = m.summary
    names = list(features) + ["(Intercept)"]
    est = list(map(float, m.coefficients)) + [float(m.intercept)]
    rows = [(model, n, e, float(se), float(t), float(p))
            for n, e, se, t, p in zip(names, est, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "model string, variable string, estimate double, "
                                                 "std_error double, t double, p double")


def coefficient_stats(g, features: Sequence[str], label: str) -> list[tuple]:
    """``(variable, estimate, std_error, t, p)`` of least squares from the inverse of the centred Gram
    matrix, intercept first; no pass over the rows beyond the Gram's."""
    fit = linalg.ols(g, features, label)
    sxx = g.centred(features)
    sd = np.sqrt(np.clip(np.diag(sxx), 1e-300, None))
    inv = np.linalg.pinv(sxx / np.outer(sd, sd), rcond=1e-13, hermitian=True) / np.outer(sd, sd)
    dof = g.n - len(features) - 1
    var = linalg.rss(g, fit, label) / dof if dof > 0 else float("nan")
    mx = g.means(features)
    est = [fit.intercept, *map(float, fit.coef)]
    se = np.sqrt(var * np.array([1 / g.n + mx @ inv @ mx, *np.diag(inv)]))
    return [(v, e, float(s), e / float(s) if s > 0 else None, t_two_sided(e / float(s), dof) if s > 0 else None)
            for v, e, s in zip([ONE, *features], est, se)]


def linear_importance(g, features: Sequence[str], label: str, spec: "LinearSpec") -> list[tuple[str, float]]:
    """ML11 from a fit: |t| of least squares (and stepwise) coefficients, |coefficient| on the
    standardised scale of penalised ones; a column that the fit leaves out has 0."""
    if spec.kind in ("ols", "step"):
        fit = spec.fit(g, features, label)
        found = {v: abs(t) for v, _, _, t, _ in coefficient_stats(g, fit.features, label)[1:] if t is not None}
    else:
        fit = spec.fit(g, features, label)
        sd = np.sqrt(np.clip(np.diag(g.centred(fit.features)), 0, None) / max(g.n - 1, 1))
        found = dict(zip(fit.features, np.abs(fit.coef) * sd))
    return [(c, float(found.get(c, 0.0))) for c in features]


def top_significant(table: DataFrame, n: int = 10, least: float = 0.01, alpha: float = 0.05) -> DataFrame:
    """W1 on a coefficient table ``(model, variable, estimate, ..., p)``: the ``n`` largest estimates, ties
    kept, among the coefficients with |estimate| over ``least`` and p below ``alpha``, intercept aside."""
    held = table.where((F.abs("estimate") > least) & (F.col("p") < alpha) & (F.col("variable") != ONE))
    return top_n_with_ties(held, "estimate", n, ["model"])


# -- Gram-based linear estimators ----------------------------------------------------------

@dataclass
class LinearSpec:
    """Which linear model to fit from a Gram matrix."""
    kind: str = "ols"            # ols | ridge | enet | step
    lam: float = 0.0
    alpha: float = 1.0

    def fit(self, g, features: Sequence[str], label: str) -> linalg.LinearFit:
        if self.kind == "ols":
            return linalg.ols(g, features, label)
        if self.kind == "ridge":
            return linalg.ridge(g, features, label, self.lam)
        if self.kind == "enet":
            if self.alpha == 0.0:
                return linalg.ridge(g, features, label, self.lam)
            return linalg.elastic_net(g, features, label, self.lam, self.alpha)
        if self.kind == "step":
            chosen, _ = linalg.stepwise_aic(g, features, label)
            return linalg.ols(g, chosen, label)
        raise ValueError(self.kind)


def fit_linear(df: DataFrame, features: Sequence[str], label: str, spec: LinearSpec) -> linalg.LinearFit:
    g = gram(df, features, label)[()]
    return spec.fit(g, features, label)


def stepwise(df: DataFrame, features: Sequence[str], label: str, direction: str = "both"):
    """ML3: chosen features, the AIC trace and the refit, from one Gram pass."""
    g = gram(df, features, label)[()]
    chosen, trace = linalg.stepwise_aic(g, features, label, direction)
    return chosen, trace, linalg.ols(g, chosen, label)


# -- ML7-ML9: MLlib tree ensembles ----------------------------------------------------------

def forest(features: Sequence[str], label: str, num_trees: int = 100, mtry: int | str = "all",
           min_node: int = 1, max_depth: int = 10, seed: int = 1, subsample: float = 1.0) -> RandomForestRegressor:
    """ML7 (``mtry='all'``: bagged trees) / ML8 random forest with ``mtry`` features tried
    per split."""
    return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                                 featureSubsetStrategy=str(mtry), minInstancesPerNode=min_node,
                                 maxDepth=max_depth, seed=seed, subsamplingRate=subsample,
                                 bootstrap=True)


def boosted(features: Sequence[str], label: str, n_trees: int = 100, depth: int = 3, shrinkage: float = 0.1,
            min_node: int = 10, subsample: float = 0.5, seed: int = 1) -> GBTRegressor:
    """ML9 gradient boosting (squared loss, row subsampling 0.5 by default)."""
    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=depth,
                        stepSize=shrinkage, minInstancesPerNode=min_node, subsamplingRate=subsample,
                        seed=seed, lossType="squared")


def feature_importance(model, features: Sequence[str], name: str, spark) -> DataFrame:
    """ML11 input for tree models: MLlib's impurity importances."""
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(name, f, float(v)) for f, v in zip(features, imp)],
                                 "model string, variable string, importance double")


# -- ML10: additive hinge regression (MARS, degree 1) ---------------------------------------

@dataclass
class HingeModel:
    terms: list = field(default_factory=list)       # (feature, knot, sign) ; sign 0 = linear
    fit: linalg.LinearFit | None = None

    def expr(self) -> Column:
        return linear_expr(self.fit)

    def basis_exprs(self) -> dict[str, Column]:
        return {_hname(f, k, s): _hinge(f, k, s) for f, k, s in self.terms}

    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return df.withColumns(self.basis_exprs()).withColumn(out, self.expr())


def _hname(f: str, k: float | None, s: int) -> str:
    if s == 0:
        return f"{f}__lin"
    return f"h_{f}_{'p' if s > 0 else 'm'}_{('%.6g' % k).replace('.', 'd').replace('-', 'n')}"


def _hinge(f: str, k: float | None, s: int) -> Column:
    x = F.col(f).cast("double")
    if s == 0:
        return x
    return F.greatest(F.lit(0.0), x - F.lit(k)) if s > 0 else F.greatest(F.lit(0.0), F.lit(k) - x)


def hinge_candidates(df: DataFrame, features: Sequence[str], n_knots: int = 15) -> list[tuple[tuple, ...]]:
    """Groups of terms ``(feature, knot, sign)``: a mirrored pair at each of ``n_knots`` evenly spaced
    exact quantiles inside every feature, and the feature itself (sign 0). Knots come from the
    features alone, never from the label."""
    probs = [(i + 1) / (n_knots + 1) for i in range(n_knots)]
    knots: dict[str, set[float]] = {f: set() for f in features}
    melted = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("variable"), F.col(f).cast("double").alias("v"))
                                           for f in features])).alias("_m")).select("_m.*")
    for r in exact_quantiles(melted, "v", probs, ["variable"]).collect():     # n_knots per feature
        knots[r["variable"]].add(float(r["quantile"]))
    return [g for f in features for g in [((f, None, 0),), *(((f, k, 1), (f, k, -1)) for k in sorted(knots[f]))]]


def _hinge_blocks(df: DataFrame, groups: Sequence[tuple], label: str, by: Sequence[str] = ()) -> dict:
    basis = {_hname(*t): _hinge(*t) for g in groups for t in g}
    data = df.where(F.col(label).isNotNull()).select(
        *by, F.col(label).cast("double").alias(label), *[e.alias(n) for n, e in basis.items()])
    return gram(data, list(basis), label, by)


def mars_path(g, groups: Sequence[tuple], label: str, max_terms: int) -> list[tuple[float, list[str]]]:
    """Forward search over the candidate groups, then the whole backward path, on one Gram matrix."""
    named = [tuple(_hname(*t) for t in group) for group in groups]
    chosen = linalg.forward_pairs(g, named, label, max_terms)
    return linalg.backward_path(g, [c for p in chosen for c in p], label)


def _hinge_model(g, groups: Sequence[tuple], label: str, keep: Sequence[str]) -> HingeModel:
    terms = {_hname(*t): t for group in groups for t in group}
    return HingeModel([terms[c] for c in keep], linalg.ols(g, list(keep), label))


def mars(df: DataFrame, features: Sequence[str], label: str, n_knots: int = 15, max_terms: int = 101,
         nprune: int | None = None, penalty: float = 2.0) -> HingeModel:
    """ML10: degree-1 MARS from one Gram pass over all candidate hinges: a forward search adds the
    group that lowers the residual sum most, the backward path drops terms one by one, and the
    size of the smallest GCV (of at most ``nprune`` terms) stays."""
    groups = hinge_candidates(df.where(F.col(label).isNotNull()), features, n_knots)
    g = _hinge_blocks(df, groups, label)[()]
    return _hinge_model(g, groups, label, linalg.pruned(mars_path(g, groups, label, max_terms), g.n, nprune, penalty))


@dataclass
class MarsTuning:
    fold_metrics: list[tuple]         # (nprune, fold, terms, rmse, rsquared)
    best: int                         # nprune of the smallest mean rmse, the smaller one of a tie
    model: HingeModel                 # refitted on all rows with it
    fits: dict                        # (nprune, fold) -> fit


def tune_mars(df: DataFrame, features: Sequence[str], label: str, fold_col: str, nprune: Sequence[int],
              n_knots: int = 15, max_terms: int = 101, penalty: float = 2.0) -> MarsTuning:
    """ML10 with ``nprune`` tuned by cross-validation (X3) from one Gram pass by fold: every fold's
    forward and backward path runs on ``total - block(f)`` and each size is scored on block f, so no
    setting and no fold reads a row again. The knots are those of all labelled rows' features."""
    data = df.where(F.col(label).isNotNull())
    groups = hinge_candidates(data, features, n_knots)
    blocks = {k[0]: b for k, b in _hinge_blocks(data, groups, label, [fold_col]).items()}
    total = None
    for b in blocks.values():
        total = b if total is None else total + b
    rows, fits = [], {}
    for f in sorted(blocks):
        train = total - blocks[f]
        path = mars_path(train, groups, label, max_terms)
        for most in nprune:
            keep = linalg.pruned(path, train.n, most, penalty)
            fits[(most, f)] = fit = linalg.ols(train, keep, label)
            m = linalg.metrics_on(blocks[f], fit, label)
            rows.append((int(most), f, len(keep) + 1, m["rmse"], m["rsquared"]))
    mean = {most: sum(r[3] for r in rows if r[0] == most) / len(blocks) for most in nprune}
    best = min(nprune, key=lambda m: (mean[m], m))
    keep = linalg.pruned(mars_path(total, groups, label, max_terms), total.n, best, penalty)
    return MarsTuning(rows, int(best), _hinge_model(total, groups, label, keep), fits)


__all__ = ["LinearSpec", "fit_linear", "stepwise", "ols_table", "forest", "boosted", "mars", "tune_mars",
           "predict_linear", "linear_expr", "coefficient_frame", "feature_importance", "assemble", "ONE"]
