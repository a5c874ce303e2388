"""Cross-validated tuning (X3, X5, U4, ML12).

* Linear family: ONE pass builds a Gram block per fold; fold f's training matrix is
  ``total - block(f)``; every grid point is fitted on the driver from those matrices and
  scored on block f (RMSE and R^2 come straight from the block's sums). Out-of-fold
  predictions of the chosen setting take one more scan (a ``CASE fold`` projection).
  With a ``recipe`` the preprocessing is refitted on every fold's training rows, from the
  same kind of statistics by fold (``foldrecipe``).
* MLlib estimators: one fit per (grid point, fold) on the rows of the other folds, submitted from a
  small driver thread pool so several Spark jobs overlap; plain forests and boosting grow all grid
  points and folds side by side instead (``foresthist``, ``boosthist``). Tree counts share a fit: a smaller forest is a prefix of a larger one (``tune_forest``), and the
  held-out loss after every boosting iteration is that of a shorter path (``boosting_paths``, X5).

Returned tables: ``grid_metrics`` (one row per setting), ``fold_metrics`` (setting x fold),
``best`` (the chosen setting) and ``oof`` (out-of-fold predictions of the best setting).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.functions import linalg
from tabreg.operators import boosthist, foldrecipe, foresthist
from tabreg.operators import evaluate as EV
from tabreg.operators.matrix import gram
from tabreg.operators.models import LinearSpec, assemble, linear_expr
from tabreg.session import cut_lineage


def param_grid(**axes: Sequence) -> list[dict]:
    """U4: cartesian product of parameter lists (driver-side, grid-sized)."""
    keys = list(axes)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[list(axes[k]) for k in keys])]


@dataclass
class TuneResult:
    grid_metrics: DataFrame
    fold_metrics: DataFrame
    best: dict
    oof: DataFrame | None = None
    fits: dict | None = None
    recipes: dict | None = None         # fold -> its fitted recipe; WHOLE -> that of all rows
    statistics: "foldrecipe.FoldStatistics | None" = None


def tune_linear(df: DataFrame, features: Sequence[str], label: str, fold_col: str,
                grid: Sequence[Mapping], kind: str = "enet", key: str | None = None,
                model_name: str = "linear", recipe: "foldrecipe.FoldRecipe | None" = None,
                statistics: "foldrecipe.FoldStatistics | None" = None) -> TuneResult:
    """X3 for the linear family from one Gram pass grouped by fold; ``recipe`` is fitted anew on
    the training rows of every fold, and every fold's model has that recipe's terms. ``statistics``
    are those of an earlier result on the same table with the same columns, label, folds and recipe;
    then the rows are not read again."""
    spark = df.sparkSession
    data = df.where(F.col(label).isNotNull())
    stats = recipes = None
    if recipe is not None:
        if statistics is not None and (statistics.recipe, statistics.features, statistics.label) != (recipe, list(features), label):
            raise ValueError("the statistics are those of another recipe, other features or another label")
        stats = statistics or foldrecipe.fold_statistics(data, features, label, fold_col, recipe)
        data = data.withColumns(stats.columns) if stats.columns else data
        folds, blocks, total = stats.folds, {(f,): b for f, b in stats.blocks.items()}, stats.total
        recipes = {f: stats.fitted(f) for f in [*folds, foldrecipe.WHOLE]}
        terms = {f: recipes[f].terms for f in folds}
    else:
        blocks = gram(data, features, label, by=[fold_col])
        folds = sorted(k[0] for k in blocks)
        total = None
        for b in blocks.values():
            total = b if total is None else total + b
        terms = dict.fromkeys(folds, list(features))
    train = {f: total - blocks[(f,)] for f in folds}
    keys = sorted({k for g in grid for k in g})
    fold_rows, grid_rows = [], []
    fits: dict = {}
    # visit each alpha's lambdas from large to small so every fit starts from its neighbour
    order = sorted(range(len(grid)), key=lambda i: (float(grid[i].get("alpha", 1.0)), -float(grid[i].get("lam", 0.0))))
    warm: dict = {}
    for gi in order:
        spec = LinearSpec(kind=kind, lam=float(grid[gi].get("lam", 0.0)), alpha=float(grid[gi].get("alpha", 1.0)))
        for f in folds:
            key_w = (spec.alpha, f)
            if kind == "enet" and spec.alpha > 0:
                fit = linalg.elastic_net(train[f], terms[f], label, spec.lam, spec.alpha, warm=warm.get(key_w))
            else:
                fit = spec.fit(train[f], terms[f], label)
            warm[key_w] = fit
            fits[(gi, f)] = fit
    for gi, setting in enumerate(grid):
        rm = []
        for f in folds:
            fit = fits[(gi, f)]
            m = linalg.metrics_on(blocks[(f,)], fit, label)
            rm.append(m)
            fold_rows.append((model_name, gi, int(f), *[float(setting.get(k, 0.0)) for k in keys],
                              m["rmse"], m["rsquared"]))
        rmses = [m["rmse"] for m in rm]
        mean = sum(rmses) / len(rmses)
        sd = math.sqrt(sum((x - mean) ** 2 for x in rmses) / (len(rmses) - 1)) if len(rmses) > 1 else float("nan")
        r2s = [m["rsquared"] for m in rm]
        grid_rows.append((model_name, gi, *[float(setting.get(k, 0.0)) for k in keys], mean, sd,
                          sum(r2s) / len(r2s)))
    cols = ", ".join(f"{k} double" for k in keys)
    fm = spark.createDataFrame(fold_rows, f"model string, grid_id int, fold int, {cols + ', ' if cols else ''}"
                                          f"rmse double, rsquared double")
    gm = spark.createDataFrame(grid_rows, f"model string, grid_id int, {cols + ', ' if cols else ''}"
                                          f"rmse double, rmse_sd double, rsquared double")
    best_i = min(range(len(grid_rows)), key=lambda i: (grid_rows[i][-3], i))
    best = {"grid_id": best_i, **dict(grid[best_i])}
    oof = None
    if key is not None:
        pred = None
        for f in folds:
            e = linear_expr(fits[(best_i, f)])
            pred = F.when(F.col(fold_col) == f, e) if pred is None else pred.when(F.col(fold_col) == f, e)
        oof = data.select(F.lit(model_name).alias("model"), F.col(key).alias("key"), F.col(fold_col).alias("fold"),
                          F.col(label).cast("double").alias("obs"), pred.alias("pred"))
    return TuneResult(gm, fm, best, oof, fits, recipes, stats)


def _assembled(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str]) -> DataFrame:
    """Feature vectors of the labelled rows, written once: every fit reads this, not the source."""
    return cut_lineage(assemble(df.where(F.col(label).isNotNull()), features).select(*keep, label, "features"))


def _run_fits(run: Callable, jobs: Sequence, parallelism: int) -> list:
    """``run`` of every job from a driver thread pool, so that several Spark jobs overlap. A fit that
    fails (lost executors beyond Spark's own retries) is submitted again on its own once the others
    are done; a second failure is the caller's."""
    def guarded(job):
        try:
            return run(job), None
        except Exception as error:  # noqa: BLE001 - any failure of one fit is retried below
            return None, error

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        done = list(ex.map(guarded, jobs))
    return [run(job) if error is not None else result for job, (result, error) in zip(jobs, done)]


def _grid_tables(spark, model_name: str, grid: Sequence[Mapping], scores: Mapping) -> tuple[DataFrame, DataFrame, int]:
    """Fold and grid metrics from ``{(setting, fold): (rmse, rsquared, mae)}``, and the best setting."""
    keys = sorted({k for g in grid for k in g})
    value = lambda g, k: float(g.get(k, 0.0))
    fold_rows = [(model_name, gi, int(f), *[value(grid[gi], k) for k in keys], *m) for (gi, f), m in sorted(scores.items())]
    grid_rows = []
    for gi, g in enumerate(grid):
        rs = [m[0] for (g2, _), m in scores.items() if g2 == gi]
        r2 = [m[1] for (g2, _), m in scores.items() if g2 == gi and m[1] is not None]
        mean = sum(rs) / len(rs)
        sd = math.sqrt(sum((x - mean) ** 2 for x in rs) / (len(rs) - 1)) if len(rs) > 1 else float("nan")
        grid_rows.append((model_name, gi, *[value(g, k) for k in keys], mean, sd, sum(r2) / len(r2) if r2 else None))
    cols = "".join(f"{k} double, " for k in keys)
    fm = spark.createDataFrame(fold_rows, f"model string, grid_id int, fold int, {cols}rmse double, rsquared double, mae double")
    gm = spark.createDataFrame(grid_rows, f"model string, grid_id int, {cols}rmse double, rmse_sd double, rsquared double")
    return fm, gm, min(range(len(grid)), key=lambda i: (grid_rows[i][-3], i))


def tune_mllib(df: DataFrame, features: Sequence[str], label: str, fold_col: str,
               make: Callable[[Mapping], object], grid: Sequence[Mapping], key: str | None = None,
               model_name: str = "mllib", parallelism: int = 4) -> TuneResult:
    """X3 for MLlib estimators: fit on the other folds, score the held-out fold, metrics by
    one aggregate per fold. Only metrics are kept, not models; with ``key`` the best setting is
    fitted again per fold for its out-of-fold predictions. A row with a NULL feature is an error."""
    spark = df.sparkSession
    data = _assembled(df, features, label, [c for c in [key, fold_col] if c])
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())   # k values

    def fitted(gi, f):
        model = make(grid[gi]).fit(data.where(F.col(fold_col) != f))
        return model.transform(data.where(F.col(fold_col) == f))

    def run(job):
        m = EV.regression_metrics(fitted(*job), "prediction", label).first()
        return m["rmse"], m["rsquared"], m["mae"]

    jobs = [(gi, f) for gi in range(len(grid)) for f in folds]
    fm, gm, best = _grid_tables(spark, model_name, grid, dict(zip(jobs, _run_fits(run, jobs, parallelism))))
    oof = None
    if key is not None:
        parts = _run_fits(lambda f: fitted(best, f), folds, parallelism)
        oof = EV.stack([p.select(F.lit(model_name).alias("model"), F.col(key).alias("key"), F.col(fold_col).alias("fold"),
                                 F.col(label).cast("double").alias("obs"), F.col("prediction").alias("pred")) for p in parts])
    return TuneResult(gm, fm, {"grid_id": best, **dict(grid[best])}, oof)


def nested_forest_metrics(model, held_out: DataFrame, label: str, counts: Sequence[int]) -> dict[int, tuple]:
    """``{m: (rmse, rsquared, mae)}`` of the first m trees of a fitted forest for every m of
    ``counts``, from one pass over the held-out rows: a forest of m trees is a prefix of a larger
    one, so the number of trees is tuned by one fit."""
    trees = model.trees[:max(counts)]
    scored = held_out
    for i, tree in enumerate(trees):
        scored = tree.setPredictionCol(f"_t{i}").transform(scored)
    y = F.col(label).cast("double")
    aggs = []
    for m in counts:
        p = sum((F.col(f"_t{i}") for i in range(1, m)), F.col("_t0")) / F.lit(float(m))
        aggs += [F.sqrt(F.avg((p - y) ** 2)).alias(f"rmse{m}"), F.pow(F.corr(p, y), 2).alias(f"r2{m}"), F.avg(F.abs(p - y)).alias(f"mae{m}")]
    row = scored.agg(*aggs).first()
    return {m: (row[f"rmse{m}"], row[f"r2{m}"], row[f"mae{m}"]) for m in counts}


def tune_forest(df: DataFrame, features: Sequence[str], label: str, fold_col: str, make: Callable[[Mapping], object],
                grid: Sequence[Mapping], n_trees: Sequence[int], model_name: str = "forest", parallelism: int = 4,
                shared: "foresthist.Shared | None" = None) -> TuneResult:
    """ML7/ML8 with X3: one forest of ``max(n_trees)`` per (setting, fold) gives the metrics of all
    tree counts. ``make(setting)`` returns the estimator; its tree count is set here. Plain forests grow
    side by side (``foresthist``), other estimators are fitted one by one. Only metrics are kept. Tunings of one
    table with the same features, label and folds may pass one ``shared``: it keeps the assembled rows and the bags
    until its ``release``."""
    rows, of = shared or foresthist.Shared(), (df, list(features), label, fold_col)
    if rows.source is None:
        rows.source, rows.data = of, _assembled(df, features, label, [fold_col])
        rows.sizes = dict(sorted((r[0], r[1]) for r in rows.data.groupBy(fold_col).agg(F.count(F.lit(1))).collect()))   # k values
    elif rows.source[0] is not df or rows.source[1:] != of[1:]:
        raise ValueError("the shared rows are those of another table, other features, another label or other folds")
    data, sizes = rows.data, rows.sizes
    counts = sorted({int(m) for m in n_trees})
    full = [{**g, "n_trees": m} for g in grid for m in counts]
    estimators = [make(g).setNumTrees(counts[-1]) for g in grid]

    def run(job):
        gi, f = job
        model = estimators[gi].fit(data.where(F.col(fold_col) != f))
        return nested_forest_metrics(model, data.where(F.col(fold_col) == f), label, counts)

    groups, found = {}, {}
    for gi, e in enumerate(estimators):
        plain = foresthist.supports(e, len(features)) and counts[0] > 0 and len(sizes) > 1
        groups.setdefault((e.getSeed(), e.getSubsamplingRate(), e.getMaxBins()) if plain else None, []).append(gi)
    for alike, members in groups.items():
        if alike is None:
            jobs = [(gi, f) for gi in members for f in sizes]
            found |= dict(zip(jobs, _run_fits(run, jobs, parallelism)))
        else:
            own = foresthist.scores(data, fold_col, label, sizes, [estimators[gi] for gi in members], counts, shared)
            found |= {(members[i], f): m for (i, f), m in own.items()}
    scores = {(gi * len(counts) + j, f): got[m] for (gi, f), got in found.items() for j, m in enumerate(counts)}
    fm, gm, best = _grid_tables(df.sparkSession, model_name, full, scores)
    return TuneResult(gm, fm, {"grid_id": best, **full[best]})


def boosting_paths(df: DataFrame, features: Sequence[str], label: str, fold_col: str, make: Callable[[Mapping], object],
                   grid: Sequence[Mapping], n_trees: Sequence[int], model_name: str = "gbm",
                   parallelism: int = 4) -> TuneResult:
    """ML9 with X3 and X5: one path of ``max(n_trees)`` iterations per (setting, fold), shared by all
    tree counts: the held-out loss after every iteration is that of a shorter fit. With 16 counts, 27
    settings and 10 folds that is 270 paths for 4,320 evaluations. ``make(setting)`` returns the
    estimator; its iterations are set here. Paths of plain squared-loss boosting grow side by side
    (``boosthist``), other estimators are fitted one by one. Only losses are kept."""
    data = _assembled(df, features, label, [fold_col])
    sizes = dict(sorted((r[0], r[1]) for r in data.groupBy(fold_col).agg(F.count(F.lit(1))).collect()))   # k values
    counts = sorted({int(m) for m in n_trees})
    full = [{**g, "n_trees": m} for g in grid for m in counts]
    estimators = [make(g).setMaxIter(counts[-1]) for g in grid]

    def run(job):
        gi, f = job
        model = estimators[gi].fit(data.where(F.col(fold_col) != f))
        return model.evaluateEachIteration(data.where(F.col(fold_col) == f), "squared")

    groups, losses = {}, {}
    for gi, e in enumerate(estimators):
        groups.setdefault((e.getSeed(), e.getSubsamplingRate(), e.getMaxBins()) if boosthist.supports(e) and len(sizes) > 1 else None,
                          []).append(gi)
    for shared, members in groups.items():
        if shared is None:
            jobs = [(gi, f) for gi in members for f in sizes]
            losses |= dict(zip(jobs, _run_fits(run, jobs, parallelism)))
        else:
            found = boosthist.paths(data, fold_col, label, sizes, [estimators[gi] for gi in members], counts[-1])
            losses |= {(members[i], f): path for (i, f), path in found.items()}
    scores = {(gi * len(counts) + j, f): (math.sqrt(max(loss[m - 1], 0.0)), None, None)
              for (gi, f), loss in losses.items() for j, m in enumerate(counts)}
    fm, gm, best = _grid_tables(df.sparkSession, model_name, full, scores)
    return TuneResult(gm, fm, {"grid_id": best, **full[best]})


def boost_path(df: DataFrame, features: Sequence[str], label: str, fold_col: str, make: Callable[[], object],
               model_name: str = "gbm", parallelism: int = 4) -> DataFrame:
    """Held-out RMSE after every boosting iteration of one setting, per fold.
    ``(model, fold, n_trees, rmse)``; the mean over folds per ``n_trees`` picks the size."""
    res = boosting_paths(df, features, label, fold_col, lambda _: make(), [{}], range(1, make().getMaxIter() + 1),
                         model_name, parallelism)
    return res.fold_metrics.select("model", "fold", F.col("n_trees").cast("int").alias("n_trees"), "rmse")
