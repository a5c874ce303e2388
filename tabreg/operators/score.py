"""Scoring and the final refit (ML13, ML15, E12, S5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.operators.matrix import FittedRecipe, Recipe
from tabreg.operators.models import LinearSpec, fit_linear, linear_expr
from tabreg.sources.io import write_scored


def refit_and_score(train: DataFrame, new: DataFrame, features: Sequence[str], label: str,
                    spec: LinearSpec, recipe: Recipe | None = None, key: str = "key",
                    back_transform: bool = True, out: str = "prediction") -> tuple[DataFrame, object]:
    """ML15: fit the preprocessing recipe and the chosen linear setting on all labelled
    rows, then score the unlabelled rows (ML13) and back-transform with ``exp`` (E12,
    no bias correction)."""
    fitted: FittedRecipe | None = recipe.fit(train) if recipe else None
    tr = fitted.transform(train) if fitted else train
    nw = fitted.transform(new) if fitted else new
    feats = [c for c in features if c in tr.columns]
    fit = fit_linear(tr, feats, label, spec)
    pred = linear_expr(fit)
    if back_transform:
        pred = F.exp(pred)
    return nw.select(F.col(key), pred.alias(out)), fit


def score_and_write(scored: DataFrame, path: str, key: str, prediction: str = "prediction",
                    names: tuple[str, str] | None = None) -> None:
    """``key, prediction`` CSV with a header."""
    write_scored(scored, path, key, prediction, out_names=names)
