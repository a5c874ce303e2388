"""Comparison of tuned models on shared folds and on a hold-out.

A candidate is a model with its chosen setting: the metric of every fold, and a function that scores
a table with the refit on all training rows. Every candidate of a comparison is tuned on the same
fold column of the same table, so their folds can be set side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.operators import evaluate as EV
from tabreg.operators import models, tune
from tabreg.operators.foldrecipe import WHOLE, FoldRecipe, FoldStatistics
from tabreg.operators.foresthist import Shared


@dataclass
class Candidate:
    name: str
    fold_rmse: dict                              # fold -> RMSE of the chosen setting
    best: dict
    predict: Callable[[DataFrame], DataFrame]    # adds ``pred``
    statistics: FoldStatistics | None = None     # of the recipe, for other models with the same one


def _best_folds(res: tune.TuneResult) -> dict:
    rows = res.fold_metrics.where(F.col("grid_id") == res.best["grid_id"]).select("fold", "rmse").collect()   # k rows
    return {r["fold"]: r["rmse"] for r in rows}


def linear(name: str, train: DataFrame, features: Sequence[str], label: str, fold_col: str, grid: Sequence[Mapping],
           kind: str, recipe: FoldRecipe, statistics: FoldStatistics | None = None) -> Candidate:
    """Least squares (``ols``), stepwise (``step``), ridge, or lasso and elastic net (``enet``), the
    recipe refitted in every fold and once on all rows; ``statistics`` of another candidate with the same
    table and recipe save their passes."""
    res = tune.tune_linear(train, features, label, fold_col, grid, kind=kind, model_name=name, recipe=recipe,
                           statistics=statistics)
    spec = models.LinearSpec(kind, lam=float(res.best.get("lam", 0.0)), alpha=float(res.best.get("alpha", 1.0)))
    whole = res.recipes[WHOLE]
    fit = spec.fit(res.statistics.train(WHOLE), whole.terms, label)

    def predict(df: DataFrame) -> DataFrame:
        return models.predict_linear(df.withColumns(whole.expressions) if whole.expressions else df, fit)

    return Candidate(name, _best_folds(res), res.best, predict, res.statistics)


def trees(name: str, train: DataFrame, features: Sequence[str], label: str, fold_col: str, make: Callable[[Mapping], object],
          grid: Sequence[Mapping], n_trees: Sequence[int], boosted: bool = False, parallelism: int = 4,
          shared: Shared | None = None) -> Candidate:
    """Bagged trees, random forests or (``boosted``) boosting, tree counts from shared fits; forests of one
    comparison may pass one ``shared``, so that rows and bags are made once."""
    at = (train, features, label, fold_col, make, grid, n_trees, name, parallelism)
    res = tune.boosting_paths(*at) if boosted else tune.tune_forest(*at, shared=shared)
    est = make(res.best)
    est = est.setMaxIter(res.best["n_trees"]) if boosted else est.setNumTrees(res.best["n_trees"])
    model = est.fit(models.assemble(train.where(F.col(label).isNotNull()), features))

    def predict(df: DataFrame) -> DataFrame:
        return model.transform(models.assemble(df, features)).withColumnRenamed("prediction", "pred").drop("features")

    return Candidate(name, _best_folds(res), res.best, predict)


def hinges(name: str, train: DataFrame, features: Sequence[str], label: str, fold_col: str, nprune: Sequence[int],
           n_knots: int = 15) -> Candidate:
    """MARS with its number of terms tuned on the folds."""
    res = models.tune_mars(train, features, label, fold_col, nprune, n_knots)
    return Candidate(name, {f: rmse for n, f, _, rmse, _ in res.fold_metrics if n == res.best}, {"nprune": res.best},
                     res.model.transform)


def fold_table(spark, candidates: Sequence[Candidate]) -> DataFrame:
    """``(model, fold, rmse)``; all candidates must have the same folds."""
    folds = {frozenset(c.fold_rmse) for c in candidates}
    if len(folds) > 1:
        raise ValueError("the candidates were tuned on different folds")
    rows = [(c.name, int(f), float(v)) for c in candidates for f, v in sorted(c.fold_rmse.items())]
    return spark.createDataFrame(rows, "model string, fold int, rmse double")


def comparison(candidates: Sequence[Candidate], holdout: DataFrame, label: str) -> DataFrame:
    """One row a model: the summary of its folds' RMSE, and RMSE, R^2 and MAE on the hold-out rows,
    worst hold-out RMSE first."""
    spark = holdout.sparkSession
    within = EV.model_summary(fold_table(spark, candidates))
    scored = [EV.regression_metrics(c.predict(holdout), "pred", label).withColumn("model", F.lit(c.name)) for c in candidates]
    out = EV.stack(scored).select("model", "n", F.col("rmse").alias("holdout_rmse"), F.col("rsquared").alias("holdout_rsquared"),
                                  F.col("mae").alias("holdout_mae"))
    return within.join(out, "model").orderBy(F.desc("holdout_rmse"))
