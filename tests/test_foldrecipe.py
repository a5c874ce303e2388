"""Recipes refitted inside folds against fits on the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.functions import linalg
from tabreg.operators import compare, foldrecipe, matrix, tune
from tabreg.operators.foldrecipe import FoldRecipe

COLS = ["x", "twin", "combo", "z", "skew", "rare", "once", "const"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(8)
    n = 1200
    x, z = rng.normal(size=n), rng.normal(size=n)
    data = {"x": x, "twin": x + 0.01 * rng.normal(size=n), "combo": 2 * x - z, "z": z, "skew": rng.gamma(2.0, size=n) ** 2 + 0.1,
            "rare": (np.arange(n) % 97 == 0).astype(float), "fold": np.arange(n) % 4 + 1, "const": np.full(n, 3.0)}
    data["once"] = ((data["fold"] == 2) & (rng.random(n) < 0.5)).astype(float)     # a level of one fold only
    data["y"] = 2 * x + z + np.log(data["skew"]) + 5 * data["once"] + 0.1 * rng.normal(size=n)
    rows = [(int(i), *(float(data[c][i]) for c in COLS), float(data["y"][i]), int(data["fold"][i])) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, " + ", ".join(f"{c} double" for c in COLS) + ", y double, fold int")
    return df.repartition(6), data


def brute_lambda(v):
    grid = np.arange(-2, 3, 0.0005)
    ll = [-len(v) / 2 * np.log(np.var(np.log(v) if abs(g) < 1e-12 else (v ** g - 1) / g)) + (g - 1) * np.log(v).sum() for g in grid]
    return grid[int(np.argmax(ll))]


def test_recipe_of_every_fold_is_that_of_its_training_rows(planted):
    df, data = planted
    stats = foldrecipe.fold_statistics(df, COLS, "y", "fold", FoldRecipe(fudge=0.0))
    for f in (1, 2, 3, 4, foldrecipe.WHOLE):
        rows = np.ones(1200, bool) if f is None else data["fold"] != f
        got = stats.fitted(f)
        assert (got.dropped["const"], got.dropped["rare"], got.dropped["z"]) == ("zv", "nzv", "lincomb")
        assert ("twin" in got.dropped) != ("x" in got.dropped)
        assert ("once" in got.dropped) == (f == 2)                     # without variance where fold 2 is held out
        assert got.lambdas["skew"] == pytest.approx(brute_lambda(data["skew"][rows]), abs=1e-3)
        for t, c in got.source.items():
            v = data[c][rows]
            v = (v ** got.lambdas[c] - 1) / got.lambdas[c] if c in got.lambdas else v
            assert got.mean[t] == pytest.approx(v.mean(), rel=1e-9, abs=1e-9)
            assert got.sd[t] == pytest.approx(v.std(ddof=1), rel=1e-9)


def test_held_out_rows_do_not_move_the_recipe(planted):
    df, _ = planted
    recipe = FoldRecipe(("zv", "nzv", "lincomb", "corr", "boxcox", "center", "scale"))
    want = foldrecipe.fold_statistics(df, COLS, "y", "fold", recipe).fitted(2)
    odd = F.col("fold") == 2
    moved = df.withColumn("skew", F.when(odd, -F.col("skew")).otherwise(F.col("skew"))) \
        .withColumn("x", F.when(odd, F.col("x") * 100 + 7).otherwise(F.col("x"))) \
        .withColumn("rare", F.when(odd, F.col("key") % 2).otherwise(F.col("rare"))) \
        .withColumn("const", F.when(odd, F.col("key")).otherwise(F.col("const")))
    got = foldrecipe.fold_statistics(moved, COLS, "y", "fold", recipe).fitted(2)
    assert (got.dropped, got.source) == (want.dropped, want.source)
    assert got.lambdas == pytest.approx(want.lambdas, abs=1e-9)
    assert got.mean == pytest.approx(want.mean, rel=1e-6) and got.sd == pytest.approx(want.sd, rel=1e-6)


def test_tuning_with_a_recipe_equals_fits_on_rows(planted):
    df, data = planted
    res = tune.tune_linear(df, COLS, "y", "fold", [{"lam": 0.0}], kind="ols", key="key", recipe=FoldRecipe(fudge=0.0))
    oof = {r["key"]: r["pred"] for r in res.oof.collect()}
    rmse = {r["fold"]: r["rmse"] for r in res.fold_metrics.collect()}
    for f in (1, 2, 3, 4):
        rec = res.recipes[f]
        cols = []
        for t, c in rec.source.items():
            v = data[c]
            cols.append((v ** rec.lambdas[c] - 1) / rec.lambdas[c] if c in rec.lambdas else v)
        a, out = np.column_stack([np.ones(1200), *cols]), data["fold"] == f
        b = np.linalg.lstsq(a[~out], data["y"][~out], rcond=None)[0]
        pred = a[out] @ b
        assert rmse[f] == pytest.approx(np.sqrt(((pred - data["y"][out]) ** 2).mean()), rel=1e-7)
        assert [oof[int(k)] for k in np.flatnonzero(out)] == pytest.approx(pred.tolist(), rel=1e-6, abs=1e-6)


def test_fitted_recipe_transforms_other_tables(planted):
    df, _ = planted
    rec = foldrecipe.fold_statistics(df, COLS, "y", "fold").fitted()
    out = rec.transform(df)
    row = out.agg(*[F.avg(t).alias(f"m_{t}") for t in rec.terms], *[F.stddev_samp(t).alias(f"s_{t}") for t in rec.terms]).first()
    assert all(abs(row[f"m_{t}"]) < 1e-8 and row[f"s_{t}"] == pytest.approx(1.0) for t in rec.terms)
    assert "rare" not in out.columns


def test_zero_variance_alone_and_odd_columns(spark):
    rows = [(i, float(i), 1.0, None if i % 2 else 1.0, i % 2 + 1, float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "key long, a double, c double, gaps double, fold int, y double")
    variety = foldrecipe.value_variety(df, ["a", "c", "gaps"], "fold", [1, 2])
    assert variety[foldrecipe.WHOLE]["c"] == (0.0, pytest.approx(100 / 60), 1)
    assert variety[1]["gaps"][2] == 0 and variety[2]["gaps"][2] == 1        # fold 2 holds the rows with a gap
    stats = foldrecipe.fold_statistics(df, ["a", "c"], "y", "fold", FoldRecipe(("zv",)))
    assert stats.fitted(1).dropped == {"c": "zv"} and stats.fitted(1).terms == ["a"]
    with pytest.raises(ValueError):
        FoldRecipe(("nope",))


def test_boxcox_exponent_within_a_thousandth(spark):
    rng = np.random.default_rng(12)
    data = {"a": rng.normal(5, 1, 800).clip(0.5) ** 3, "b": np.exp(rng.normal(size=800)), "c": rng.normal(10, 1, 800), "d": -rng.random(800)}
    df = spark.createDataFrame([tuple(float(data[c][i]) for c in "abcd") for i in range(800)], "a double, b double, c double, d double")
    got = foldrecipe.boxcox_exponents(df, list("abcd"), fudge=0.0)[foldrecipe.WHOLE]
    assert set(got) == {"a", "b", "c"}
    for c in "ab":
        assert got[c][0] == pytest.approx(brute_lambda(data[c]), abs=1e-3)
    assert matrix.boxcox_lambdas(df, ["a", "b"]) == {"a": pytest.approx(got["a"][0]), "b": 0.0}
    assert linalg is not None


def test_models_of_one_recipe_share_its_statistics(planted, monkeypatch):
    df, _ = planted
    recipe, grid = FoldRecipe(), [{"lam": 0.0}]
    first = tune.tune_linear(df, COLS, "y", "fold", grid, kind="ols", recipe=recipe)
    alone = tune.tune_linear(df, COLS, "y", "fold", grid, kind="step", recipe=recipe).fold_metrics.collect()
    monkeypatch.setattr(foldrecipe, "fold_statistics", None)          # the rows are not read again
    shared = tune.tune_linear(df, COLS, "y", "fold", grid, kind="step", recipe=recipe, statistics=first.statistics)
    assert shared.fold_metrics.collect() == alone
    with pytest.raises(ValueError):
        tune.tune_linear(df, COLS[:3], "y", "fold", grid, recipe=recipe, statistics=first.statistics)


def test_variety_makes_no_row_per_value_and_fold(spark, monkeypatch):
    rows = [(float(i % 3) if i % 7 else None, None, 2.0, i % 2) for i in range(60)] + [(9.0, None, 2.0, 1)]
    df = spark.createDataFrame(rows, "a double, empty double, one double, fold int")
    melted = foldrecipe.melt(df, ["a", "empty", "one"], "double", keep=["fold"])
    monkeypatch.setattr(foldrecipe, "melt", lambda *_, **__: melted)
    monkeypatch.setattr(F, "explode", None)                           # the only rows are one a value
    got = foldrecipe.value_variety(df, ["a", "empty", "one"], "fold", [0, 1])
    for fold in (None, 0, 1):
        a = [r[0] for r in rows if r[3] != fold and r[0] is not None]
        counts = sorted((a.count(v) for v in set(a)), reverse=True)
        n = sum(r[3] != fold for r in rows)
        assert got[fold]["a"] == (counts[0] / counts[1], 100.0 * len(counts) / n, len(counts))
        assert got[fold]["empty"] == (0.0, 0.0, 0) and got[fold]["one"] == (0.0, 100.0 / n, 1)


def test_candidates_of_one_recipe_share_its_statistics(planted, monkeypatch):
    df, _ = planted
    recipe, grid = FoldRecipe(("zv", "center", "scale")), [{"lam": 0.01, "alpha": 1.0}]
    at = (df, COLS, "y", "fold")
    ridge = compare.linear("ridge", *at, [{"lam": 0.1}], "ridge", recipe)
    alone = compare.linear("lasso", *at, grid, "enet", recipe)
    monkeypatch.setattr(foldrecipe, "fold_statistics", None)          # the rows are not read again
    shared = compare.linear("lasso", *at, grid, "enet", recipe, ridge.statistics)
    assert shared.fold_rmse == pytest.approx(alone.fold_rmse)
