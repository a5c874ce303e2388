import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.functions import linalg
from tabreg.operators import boosthist, foresthist, impute, matrix, models, tune


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    n = 3000
    x = rng.normal(size=(n, 10))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(scale=0.1, size=n)
    rows = [(int(i), *map(float, x[i]), float(y[i]), int(i % 5) + 1) for i in range(n)]
    cols = ", ".join(f"x{j} double" for j in range(10))
    return spark.createDataFrame(rows, f"key long, {cols}, y double, fold int"), x, y


FE = [f"x{j}" for j in range(10)]


def test_gram_matches_numpy(planted):
    df, x, y = planted
    g = matrix.gram(df, FE, "y")[()]
    a = np.column_stack([np.ones(len(y)), x, y])
    assert np.allclose(g.m, a.T @ a)


def test_gram_keeps_digits_of_large_means(spark):
    rng = np.random.default_rng(3)
    x = 1.7e9 + 50 * rng.standard_normal(3000)
    y = (x - 1.7e9) / 50 + rng.standard_normal(3000)
    df = spark.createDataFrame([(float(a), float(b), int(i % 4)) for i, (a, b) in enumerate(zip(x, y))],
                               "x double, y double, fold int").repartition(7)
    g = matrix.gram(df, ["x"], "y")[()]
    r = np.corrcoef(x, y)[0, 1]
    assert matrix.correlation_from_gram(g, ["x", "y"])[0, 1] == pytest.approx(r, rel=1e-9)
    assert matrix.linear_combos(g, ["x"]) == []
    pairs = {(p["var_x"], p["var_y"]): p["r"]
             for p in matrix.corr_from_moments(matrix.pairwise_moments(df, ["x", "y"])).collect()}
    assert pairs[("x", "y")] == pytest.approx(r, rel=1e-9)
    blocks = matrix.gram(df, ["x"], "y", by=["fold"])
    rest = g - blocks[(2,)]
    keep = np.arange(3000) % 4 != 2
    assert rest.n == keep.sum()
    assert linalg.ols(rest, ["x"], "y").coef[0] == pytest.approx(np.polyfit(x[keep] - 1.7e9, y[keep], 1)[0], rel=1e-8)


def test_gram_counts_rows_left_out_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, 5.0)], "x double, y double")
    with pytest.warns(RuntimeWarning, match="1 rows"):
        g = matrix.gram(df, ["x"], "y")[()]
    assert (g.n, g.skipped) == (2.0, 1.0)
    assert matrix.gram(df.where("false"), ["x"], "y")[()].n == 0


def test_ols_recovers_coefficients(planted):
    df, x, y = planted
    fit = models.fit_linear(df, FE, "y", models.LinearSpec("ols"))
    assert fit.coef[:3] == pytest.approx([3, -2, 0.5], abs=0.01)
    t = models.ols_table(df, FE, "y").collect()
    est = {r["variable"]: r for r in t}
    assert est["x0"]["estimate"] == pytest.approx(fit.coef[0], abs=1e-8)
    a = np.column_stack([x, np.ones(len(y))])
    beta, res, *_ = np.linalg.lstsq(a, y, rcond=None)
    s2 = res[0] / (len(y) - a.shape[1])
    se = np.sqrt(np.diag(s2 * np.linalg.inv(a.T @ a)))
    assert est["x1"]["std_error"] == pytest.approx(se[1], rel=1e-6)


def test_ridge_closed_form(planted):
    df, x, y = planted
    g = matrix.gram(df, FE, "y")[()]
    lam = 0.3
    fit = linalg.ridge(g, FE, "y", lam)
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    n = len(y)
    b = np.linalg.solve(z.T @ z / n + lam * np.eye(10), z.T @ (y - y.mean()) / n)
    assert fit.coef == pytest.approx(b / sd, rel=1e-8)
    # the elastic net solver at alpha ~ 0 agrees with the closed form
    enet = linalg.elastic_net(g, FE, "y", lam, 1e-12)
    assert enet.coef == pytest.approx(fit.coef, rel=1e-5)


def test_lasso_zeroes_noise_and_stepwise_drops_it(planted):
    df, _, _ = planted
    g = matrix.gram(df, FE, "y")[()]
    fit = linalg.elastic_net(g, FE, "y", 0.05, 1.0)
    assert np.all(fit.coef[3:] == 0.0) and np.all(fit.coef[:3] != 0.0)
    chosen, trace, _ = models.stepwise(df, FE, "y")
    assert set(["x0", "x1", "x2"]) <= set(chosen)
    assert trace[-1]["aic"] < trace[0]["aic"]


def test_tune_linear_one_pass(planted):
    df, _, _ = planted
    grid = tune.param_grid(alpha=[0.0, 1.0], lam=[0.0, 0.1, 1.0])
    res = tune.tune_linear(df, FE, "y", "fold", grid, kind="enet", key="key")
    gm = res.grid_metrics.orderBy("rmse").first()
    assert gm["lam"] == 0.0
    assert res.fold_metrics.count() == 30
    oof = res.oof
    m = oof.agg(F.sqrt(F.avg((F.col("pred") - F.col("obs")) ** 2))).first()[0]
    assert m == pytest.approx(gm["rmse"], rel=0.05)


def test_mars_finds_knot(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 10, 2000)
    y = np.maximum(0, x - 4) + rng.normal(scale=0.05, size=2000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    m = models.mars(df, ["x"], "y", n_knots=19, max_terms=5)
    knots = {k for _, k, _ in m.terms}
    assert min(abs(k - 4) for k in knots) < 0.3
    pred = m.transform(df).agg(F.sqrt(F.avg((F.col("pred") - F.col("y")) ** 2))).first()[0]
    assert pred < 0.1


def test_linear_combos_and_correlation(planted, spark):
    df, _, _ = planted
    d = df.withColumn("combo", F.col("x0") + 2 * F.col("x1")).withColumn("near", F.col("x3") + 0.05 * F.sin(F.col("x5") * 100))
    cols = FE + ["combo", "near"]
    g = matrix.gram(d, cols)[()]
    assert matrix.linear_combos(g, cols) == ["combo"]
    dropped = matrix.high_correlation(matrix.correlation_from_gram(g, cols), cols, 0.9)
    assert len(set(dropped) & {"x3", "near"}) == 1


def test_boxcox_recovers_log(spark):
    rng = np.random.default_rng(9)
    x = np.exp(rng.normal(2, 0.5, 3000))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = matrix.boxcox_lambdas(df, ["x"])["x"]
    assert lam == 0.0


def test_donor_imputation_recovers_leaf_values(spark):
    """x2 is decided by a split on x1; a removed x2 must come back from its own leaf."""
    rng = np.random.default_rng(2)
    n = 2000
    x1 = rng.uniform(0, 1, n)
    x1 = np.where(x1 < 0.5, x1 * 0.8, 0.2 + x1 * 0.8)      # no rows in (0.4, 0.6): tree bins cannot blur the split
    x2 = np.where(x1 < 0.5, 10.0, 20.0)
    miss = rng.uniform(size=n) < 0.2
    rows = [(int(i), float(x1[i]), None if miss[i] else float(x2[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, x1 double, x2 double")
    out = impute.chained_impute(df, "key", ["x2"], {"x2": ["x1"]}, min_node=5, max_depth=3, max_bins=512)
    got = {r["key"]: (r["x2"], r["x2_imputed"]) for r in out.collect()}
    assert all(got[i][0] == x2[i] for i in range(n))
    assert sum(v[1] for v in got.values()) == miss.sum()
    again = {r["key"]: r["x2"] for r in impute.chained_impute(df.repartition(3), "key", ["x2"], {"x2": ["x1"]},
                                                              min_node=5, max_depth=3, max_bins=512).collect()}
    assert again == {k: v[0] for k, v in got.items()}


@pytest.mark.parametrize("per_key", [100_000, 7])
def test_donors_are_observed_values_of_the_leaf(spark, monkeypatch, per_key):
    """One hot leaf has a single donor for most of the gaps; salts must not change a draw."""
    monkeypatch.setattr(impute, "DRAWS_PER_KEY", per_key)
    rows = [(i, "hot", None if i else 5.0) for i in range(400)]
    rows += [(1000 + i, "mixed", None if i % 3 else float(i)) for i in range(300)]
    rows += [(2000 + i, None, None if i % 2 else -float(i)) for i in range(40)] + [(3000 + i, "none", None) for i in range(5)]
    df = spark.createDataFrame(rows, "key long, leaf string, y double").repartition(5)
    got = impute.donor_draw(df, "key", "y", ["leaf"]).collect()
    assert len(got) == len(rows)
    seen = {}
    for _, leaf, y in rows:
        seen.setdefault(leaf, set()).add(y)
    for r in got:
        before = next(y for k, leaf, y in rows if k == r["key"])
        assert (r["y"] in seen[r["leaf"]]) and (before is None or r["y"] == before)
        assert r["y_imputed"] == (before is None and r["leaf"] != "none")
    drawn = {r["key"]: r["y"] for r in got}
    monkeypatch.setattr(impute, "DRAWS_PER_KEY", 10 ** 9)
    assert drawn == {r["key"]: r["y"] for r in impute.donor_draw(df, "key", "y", ["leaf"]).collect()}
    assert len({drawn[1000 + i] for i in range(300) if i % 3}) > 30            # draws vary


def test_incomplete_and_text_predictors_decide_the_leaf(spark):
    """y follows a text with gaps and the gaps of a number; nothing else tells it."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        kind = ["x", "y", None][i % 3]
        num = None if rng.random() < 0.4 else float(rng.normal())
        y = {"x": "low", "y": "mid", None: "high"}[kind] if num is not None else "gap"
        rows.append((i, kind, num, y if rng.random() < 0.8 else None, y))
    df = spark.createDataFrame(rows, "key long, kind string, num double, y string, truth string").repartition(4)
    out = impute.chained_impute(df, "key", ["y"], {"y": ["kind", "num"]}, max_depth=4)
    assert out.where("y <> truth or y is null").count() == 0
    assert out.where("y_imputed").count() == sum(r[3] is None for r in rows)
    empty = impute.chained_impute(df.withColumn("void", F.lit(None).cast("double")), "key", ["void"], {"void": ["num"]})
    assert empty.where("void is not null or void_imputed").count() == 0 and empty.count() == 1500


def test_tune_grid_runs_every_setting_of_the_reference(spark, monkeypatch):
    from tabreg.plans import q_models
    seen, run = [], q_models.tune.tune_linear
    monkeypatch.setattr(q_models.tune, "tune_linear", lambda *a, **b: seen.append(run(*a, **b)) or seen[-1])
    got = q_models.tune_grid(spark, "/root/testdata/sf0.001").collect()
    grid = seen[0].grid_metrics.select("alpha", "lam").distinct().collect()
    assert len(grid) == 100 and max(g["alpha"] for g in grid) == 0.25 and max(g["lam"] for g in grid) == 0.05
    assert len(got) == 10 and all(r["mae"] > 0 for r in got)


def test_forward_and_backward_search_equal_brute_force(planted):
    df, x, y = planted
    rng = np.random.default_rng(5)
    pairs = [(f"x{i}", f"x{j}") for i, j in ((0, 3), (1, 4), (2, 5), (6, 7))] + [("x8",)]
    g = matrix.gram(df, FE, "y")[()]
    resid = lambda cols: linalg.rss(g, linalg.ols(g, list(cols), "y"), "y")
    chosen, want = [], []
    for group in linalg.forward_pairs(g, pairs, "y", max_terms=6):
        best = min((p for p in pairs if p not in want and len(chosen) + len(p) + 1 <= 6), key=lambda p: resid(chosen + list(p)))
        want.append(best)
        chosen += best
        assert group == best
    path = linalg.backward_path(g, FE, "y")
    cur = list(FE)
    for value, cols in path:
        assert sorted(cols) == sorted(cur) and value == pytest.approx(resid(cur), rel=1e-6)
        if cur:
            cur = min(([c for c in cur if c != d] for d in cur), key=resid)
    assert linalg.backward_path(g, [], "y") == [(pytest.approx(resid([])), [])]
    assert rng is not None


def test_tuned_hinges_score_folds_like_fits_on_rows(spark):
    rng = np.random.default_rng(21)
    n = 1500
    a, b, c = rng.uniform(0, 10, n), rng.uniform(-5, 5, n), rng.normal(size=n)
    y = np.maximum(a - 4, 0) * 2 - np.maximum(0.5 - b, 0) + 0.2 * rng.normal(size=n)
    fold = np.arange(n) % 5 + 1
    df = spark.createDataFrame([(float(a[i]), float(b[i]), float(c[i]), float(y[i]), int(fold[i])) for i in range(n)],
                               "a double, b double, c double, y double, fold int").repartition(4)
    res = models.tune_mars(df, ["a", "b", "c"], "y", "fold", [2, 3, 5, 9, 15], n_knots=9, max_terms=15)
    assert len(res.fold_metrics) == 25
    term = lambda name: next(t for g in models.hinge_candidates(df, ["a", "b", "c"], 9) for t in g if models._hname(*t) == name)
    data = {"a": a, "b": b, "c": c}

    def column(name):
        f, k, s = term(name)
        return data[f] if s == 0 else np.maximum(0, s * (data[f] - k))

    for most, f, terms, rmse, _ in res.fold_metrics:
        assert terms <= most
        if most in (3, 15):
            fit = res.fits[(most, f)]
            m = np.column_stack([np.ones(n), *map(column, fit.features)])
            coef = np.linalg.lstsq(m[fold != f], y[fold != f], rcond=None)[0]
            assert rmse == pytest.approx(np.sqrt(((m @ coef - y)[fold == f] ** 2).mean()), rel=1e-6)
    mean = {m: np.mean([r[3] for r in res.fold_metrics if r[0] == m]) for m in (2, 3, 5, 9, 15)}
    assert mean[res.best] == min(mean.values()) and mean[res.best] < 0.26 < mean[2]
    pred = np.array([r["pred"] for r in res.model.transform(df).select("pred", "a").orderBy("a").collect()])
    assert np.sqrt(((pred - y[np.argsort(a)]) ** 2).mean()) < 0.25


# -- trees: planted splits -----------------------------------------------------------------

@pytest.fixture(scope="module")
def steps(spark):
    """y jumps by 10 at a = 3 and by 4 at b = 0; c is noise."""
    rng = np.random.default_rng(31)
    n = 1200
    a, b, c = rng.uniform(0, 10, n), rng.uniform(-1, 1, n), rng.normal(size=n)
    y = 10.0 * (a > 3) + 4.0 * (b > 0) + 0.1 * rng.normal(size=n)
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), float(y[i]), i % 3 + 1) for i in range(n)]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, y double, fold int").repartition(4)


ABC = ["a", "b", "c"]


def test_bagged_and_forest_tuning_find_the_planted_splits(steps):
    grid = [{"mtry": 3, "min_node": 5}, {"mtry": 1, "min_node": 5}]
    make = lambda s: models.forest(ABC, "y", mtry=int(s["mtry"]), min_node=int(s["min_node"]), max_depth=3)
    res = tune.tune_forest(steps, ABC, "y", "fold", make, grid, [1, 4, 12])
    rows = res.fold_metrics.collect()
    assert len(rows) == 2 * 3 * 3 and res.grid_metrics.count() == 6
    assert res.best["mtry"] == 3 and all(r["rmse"] < 1.6 for r in rows if r["mtry"] == 3 and r["n_trees"] == 12)
    # a prefix is the same forest with fewer trees
    vec = models.assemble(steps, ABC)
    model = make(grid[0]).setNumTrees(12).fit(vec.where("fold <> 2"))
    nested = tune.nested_forest_metrics(model, vec.where("fold = 2"), "y", [4, 12])
    whole = model.transform(vec.where("fold = 2")).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert nested[12][0] == pytest.approx(whole, rel=1e-9)


def test_forests_of_all_settings_and_folds_grow_by_the_same_jobs(steps, monkeypatch, tmp_path):
    """No fit per setting and fold; bags, feature draws, repeated candidates and small nodes give MLlib's trees."""
    from pyspark.ml.regression import RandomForestRegressor

    cols = [*ABC, "d"]
    odd = steps.withColumn("c", F.when(F.col("key") % 3 == 0, 0.05).when(F.col("key") % 3 == 1, 0.05 + 2.0 ** -56).otherwise(F.col("c")))
    odd.where("key < 700").withColumn("d", (F.col("key") % 5).cast("double")).write.parquet(str(tmp_path / "rows"))
    rows = steps.sparkSession.read.parquet(str(tmp_path / "rows"))
    grid = [{"mtry": 4, "min_node": 1}, {"mtry": 4, "min_node": 30}, {"mtry": 2, "min_node": 3}]
    make = lambda s: models.forest(cols, "y", mtry=int(s["mtry"]), min_node=int(s["min_node"]), max_depth=4)
    vec = models.assemble(rows, cols)
    own = {(i, f): tune.nested_forest_metrics(make(g).setNumTrees(9).fit(vec.where(F.col("fold") != f)), vec.where(F.col("fold") == f), "y", [1, 9])
           for i, g in enumerate(grid) for f in (1, 2, 3)}
    fits, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    monkeypatch.setattr(tune, "cut_lineage", lambda df: df)               # the bags depend on how the rows lie
    monkeypatch.setattr(foresthist, "BLOCK", 64)
    monkeypatch.setattr(foresthist, "JOB_BYTES", 100_000)                 # several jobs a level
    arrow, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", steps.sparkSession.conf
    before = conf.get(arrow)
    conf.set(arrow, "40")                                                 # several blocks a partition
    try:
        res = tune.tune_forest(rows, cols, "y", "fold", make, grid, [1, 9])
    finally:
        conf.set(arrow, before)
    got = {(r["grid_id"], r["fold"]): (r["rmse"], r["rsquared"], r["mae"]) for r in res.fold_metrics.collect()}
    assert not fits and len(got) == 3 * 2 * 3
    for (i, f), metrics in own.items():
        assert got[(2 * i, f)] == pytest.approx(metrics[1], rel=1e-9) and got[(2 * i + 1, f)] == pytest.approx(metrics[9], rel=1e-9)


def test_forests_of_a_comparison_share_rows_and_bags(steps, monkeypatch, tmp_path):
    steps.write.parquet(str(tmp_path / "rows"))
    steps, made, rows, written = steps.sparkSession.read.parquet(str(tmp_path / "rows")), [], foresthist._rows, []
    monkeypatch.setattr(foresthist, "_rows", lambda *a: made.append(1) or rows(*a))
    monkeypatch.setattr(tune, "cut_lineage", lambda df: written.append(1) or df)      # the bags depend on how the rows lie
    of = lambda mtry, node: (lambda s: models.forest(ABC, "y", mtry=mtry, min_node=node, max_depth=3))
    settings = [of("all", 5), of(2, 4)]
    alone = [tune.tune_forest(steps, ABC, "y", "fold", m, [{}], [2, 4]).fold_metrics.collect() for m in settings]
    assert (len(made), len(written)) == (2, 2)
    shared = foresthist.Shared()
    both = [tune.tune_forest(steps, ABC, "y", "fold", m, [{}], [2, 4], shared=shared).fold_metrics.collect() for m in settings]
    assert (len(made), len(written)) == (3, 3)
    for a, b in zip(alone, both):
        assert [r["rmse"] for r in b] == pytest.approx([r["rmse"] for r in a], rel=1e-9)
    with pytest.raises(ValueError, match="other features"):
        tune.tune_forest(steps, ABC[:2], "y", "fold", settings[0], [{}], [2], shared=shared)
    (_, blocks), = shared.blocks.values()
    shared.release()
    assert not blocks.is_cached and not shared.blocks


@pytest.mark.parametrize("seed,mean", [(2, 1.0), (2 ** 40 + 5, 0.5)])
def test_bootstrap_counts_are_those_of_mllibs_generator(spark, seed, mean):
    own = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(mean)
    own.reseedRandomGenerator(seed)
    draws = foresthist.PoissonCounts(seed, mean)
    assert [*draws.take(3), *draws.take(900), *draws.take(97)] == list(own.sample(1000))


def test_feature_draws_are_mllibs_with_two_calls_of_the_jvm_each(spark, monkeypatch):
    longs, random = spark._jvm.java.util.Random(5), spark._jvm.org.apache.spark.util.random.XORShiftRandom
    own = []
    for _ in range(40):
        r, kept = random(longs.nextLong()), [0, 1, 2]
        for item in range(3, 8):
            place = int(r.nextDouble() * (item + 1))
            if place < 3:
                kept[place] = item
        own.append(kept)
    subsets, calls, client = foresthist._Subsets(spark, 5, 8), [], spark.sparkContext._gateway._gateway_client
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **k: calls.append(command) or send(command, *a, **k))
    assert [subsets.get(3, i) for i in range(40)] == own
    assert len([c for c in calls if not c.startswith("m\n")]) <= 2 * 40          # m: the JVM frees an object


@pytest.mark.parametrize("level", [0, 2, 6])
def test_histograms_are_those_of_the_rows_that_reach_a_node(level):
    rng = np.random.default_rng(level)
    n, n_bins, first = 3000, 8, 2 ** level - 1
    fold, y = rng.integers(1, 4, n).astype(np.int32), rng.normal(size=n)
    bins, counts = rng.integers(0, n_bins, (1, 3, n)).astype(np.uint8), rng.poisson(1.0, (1, n)).astype(np.uint8)
    tree = foresthist._Tree(level + 1)
    for node in range(first):
        if node % 5 or not node:                                          # the others are leaves
            tree.feature[node], tree.split[node], tree.inner[node] = rng.integers(0, 3), rng.integers(2, 5), True
    reached = foresthist._place(tree.shape(), bins[0], level)
    some = [node for node in range(first, 2 * first + 1) if np.any(reached == node)][::-2]
    full = [node for node in range(first, 2 * first + 1) if np.any(reached == node)]
    halves = [(a[:1500], a[1500:]) for a in (fold, y)]
    at = int(np.sum(fold[:1500] != 2))
    blocks = [(halves[0][h], halves[1][h], bins[:, :, 1500 * h:1500 * (h + 1)].copy(), counts, np.array([at * h])) for h in (0, 1)]
    got = dict(foresthist._histograms({0: {0: [(tree.shape(), some), (tree.shape(), full)]}}, [2], level, n_bins)(iter(blocks)))
    drawn = np.zeros(n)
    drawn[fold != 2] = counts[0, :np.sum(fold != 2)]
    for c, nodes in enumerate((some, full)):
        assert got[(0, 0, c)].shape == (3, 3, len(nodes), n_bins)
        for k, v in enumerate((drawn, drawn * y, drawn * y * y)):
            for j in range(3):
                plain = [[v[(reached == node) & (bins[0, j] == b)].sum() for b in range(n_bins)] for node in nodes]
                assert got[(0, 0, c)][k, j] == pytest.approx(np.array(plain), abs=1e-9)


def test_boosting_paths_share_one_fit(steps):
    make = lambda s: models.boosted(ABC, "y", depth=int(s["depth"]), shrinkage=0.5, min_node=5, subsample=1.0)
    res = tune.boosting_paths(steps, ABC, "y", "fold", make, [{"depth": 1}, {"depth": 2}], [1, 5, 12])
    got = {(r["depth"], r["n_trees"], r["fold"]): r["rmse"] for r in res.fold_metrics.collect()}
    assert len(got) == 18 and res.best["n_trees"] in (5, 12) and got[(2.0, 12.0, 1)] < min(1.6, got[(2.0, 1.0, 1)])
    vec = models.assemble(steps, ABC)
    short = make({"depth": 2}).setMaxIter(5).fit(vec.where("fold <> 3")).transform(vec.where("fold = 3"))
    rmse = short.agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert got[(2.0, 5.0, 3)] == pytest.approx(rmse, rel=1e-6)
    path = tune.boost_path(steps, ABC, "y", "fold", lambda: make({"depth": 2}).setMaxIter(3))
    assert path.count() == 9 and path.columns == ["model", "fold", "n_trees", "rmse"]


def test_boosting_paths_serve_all_settings_and_folds_by_the_same_jobs(steps, monkeypatch):
    """No fit per setting and fold; drawn rows, repeated candidates and small nodes give MLlib's losses."""
    from pyspark.ml.regression import GBTRegressor

    rows = steps.withColumn("c", F.when(F.col("key") % 3 == 0, 0.05).when(F.col("key") % 3 == 1, 0.05 + 2.0 ** -56).otherwise(F.col("c")))
    make = lambda s: models.boosted(ABC, "y", depth=int(s["depth"]), shrinkage=0.3, min_node=1, subsample=0.5)
    vec = models.assemble(rows, ABC)
    own = {(d, f): make({"depth": d}).setMaxIter(4).fit(vec.where(F.col("fold") != f))
           .evaluateEachIteration(vec.where(F.col("fold") == f), "squared") for d in (1, 3) for f in (1, 2, 3)}
    fits, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    monkeypatch.setattr(tune, "cut_lineage", lambda df: df)               # the draws depend on how the rows lie
    res = tune.boosting_paths(rows, ABC, "y", "fold", make, [{"depth": 1}, {"depth": 3}], [1, 2, 3, 4])
    got = {(int(r["depth"]), r["fold"], int(r["n_trees"])): r["rmse"] for r in res.fold_metrics.collect()}
    assert not fits and len(got) == 2 * 3 * 4
    for (d, f), losses in own.items():
        assert [got[(d, f, m + 1)] ** 2 for m in range(4)] == pytest.approx(losses, rel=1e-9)


@pytest.mark.parametrize("subsample", [0.5, 1.0])
def test_boosting_paths_hold_a_row_once_and_on_disk_only(steps, monkeypatch, tmp_path, subsample):
    """Blocks serve all folds; neither they nor the predictions stay in memory, and settings whose predictions are too
    many grow one after the other: the losses are still MLlib's."""
    from pyspark import RDD

    steps.where("key < 900").write.parquet(str(tmp_path / "rows"))
    rows = steps.sparkSession.read.parquet(str(tmp_path / "rows"))
    make = lambda s: models.boosted(ABC, "y", depth=int(s["depth"]), shrinkage=0.3, min_node=2, subsample=subsample)
    vec = models.assemble(rows, ABC)
    own = {(d, f): make({"depth": d}).setMaxIter(3).fit(vec.where(F.col("fold") != f))
           .evaluateEachIteration(vec.where(F.col("fold") == f), "squared") for d in (1, 6) for f in (1, 2, 3)}
    levels, held, persist, grown, paths = [], [], RDD.persist, [], boosthist._paths
    monkeypatch.setattr(RDD, "persist", lambda self, level: levels.append(level) or held.append(persist(self, level)) or held[-1])
    monkeypatch.setattr(boosthist, "_paths", lambda blocks, *a: grown.append(sum(len(b[1]) for b in blocks.collect())) or paths(blocks, *a))
    monkeypatch.setattr(boosthist, "BLOCK", 64)
    monkeypatch.setattr(boosthist, "PREDICTED", 1)
    monkeypatch.setattr(tune, "cut_lineage", lambda df: df)               # the draws depend on how the rows lie
    arrow, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", steps.sparkSession.conf
    before = conf.get(arrow)
    conf.set(arrow, "50")                                                 # batches and blocks do not end together
    try:
        res = tune.boosting_paths(rows, ABC, "y", "fold", make, [{"depth": 1}, {"depth": 6}], [1, 2, 3])
    finally:
        conf.set(arrow, before)
    got = {(int(r["depth"]), r["fold"], int(r["n_trees"])): r["rmse"] for r in res.fold_metrics.collect()}
    assert grown == [900, 900] and levels and not any(level.useMemory for level in levels)
    assert not any(rdd.is_cached for rdd in held)                         # given back
    for (d, f), losses in own.items():
        assert [got[(d, f, m + 1)] ** 2 for m in range(3)] == pytest.approx(losses, rel=1e-9)


def test_a_boosted_label_that_is_not_finite_is_an_error(steps):
    bad = steps.withColumn("y", F.when(F.col("key") == 7, float("nan")).otherwise(F.col("y")))
    with pytest.raises(Exception, match="NaN"):
        tune.boosting_paths(bad, ABC, "y", "fold", lambda s: models.boosted(ABC, "y", depth=1), [{}], [1])


def test_mllib_tuning_keeps_metrics_and_retries_a_failed_fit(steps):
    failed = []

    class Flaky:
        def __init__(self, est):
            self.est = est

        def fit(self, df):
            if not failed:
                failed.append(1)
                raise RuntimeError("lost")
            return self.est.fit(df)

    res = tune.tune_mllib(steps, ABC, "y", "fold", lambda s: Flaky(models.forest(ABC, "y", num_trees=5, max_depth=int(s["d"]))),
                          [{"d": 1}, {"d": 3}], key="key")
    assert failed and res.best["d"] == 3 and res.fits is None
    assert res.oof.count() == 1200 and res.oof.select("key").distinct().count() == 1200
    imp = models.feature_importance(models.forest(ABC, "y", num_trees=5, max_depth=3, mtry=3).fit(models.assemble(steps, ABC)),
                                    ABC, "f", steps.sparkSession)
    order = [r["variable"] for r in imp.orderBy(F.desc("importance")).collect()]
    assert order == ["a", "b", "c"]


def test_a_missing_predictor_is_an_error_not_a_dropped_row(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "x double, y double")
    with pytest.raises(Exception, match="null|NULL"):
        models.assemble(df, ["x"]).collect()


def test_chained_impute_query_imputes_a_written_table(spark, tmp_path, monkeypatch):
    """The query's table is read twice by the imputer; joins and sums behind it run once."""
    from tabreg.plans import q_models

    orders = [(i, "FOP"[i % 3], f"{i % 5 + 1}-X") for i in range(60)]
    lines = [(i, 1000.0 + 7 * i + j, 0.01 * (i % 9), 0.01 * (i % 7), float(i % 11 + j)) for i in range(60) for j in range(2)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_discount double, l_tax double, l_quantity double"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, real = [], impute.chained_impute
    monkeypatch.setattr(impute, "chained_impute", lambda df, *a, **k: seen.extend(df.inputFiles()) or real(df, *a, **k))
    got = q_models.chained_impute(spark, str(tmp_path)).first()
    assert seen and not any("lineitem" in f or "orders" in f for f in seen)
    assert got["n"] == 60 and got["n_imputed_avg_tax"] == sum(i % 7 == 0 for i in range(60))
    assert all(got[f"n_outside_{c}"] == 0 and got[f"n_left_{c}"] == 0 for c in ("avg_tax", "sum_qty", "log_ext", "prio"))
