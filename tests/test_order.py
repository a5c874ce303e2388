import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.operators import quantiles
from tabreg.operators.order import with_group_rank, with_hash_rank
from tabreg.operators.quantiles import exact_quantiles, quantiles_wide


def _np_q(x, p):
    return float(np.quantile(np.asarray(x, dtype=float), p))   # numpy default = type 7


def _type7(x, p):
    x, h = np.sort(x), (len(x) - 1) * p
    lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
    return lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo)


def test_exact_quantiles_match_type7(spark):
    rng = np.random.default_rng(1)
    g = rng.integers(0, 3, 2000)
    v = rng.normal(size=2000).round(3)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for k in range(3):
        for p in probs:
            assert got[(k, p)] == pytest.approx(_np_q(v[g == k], p), abs=1e-12)


def test_quantiles_hot_group_and_ties(spark):
    # one group holds most rows and most values tie: still exact
    rows = [(0, float(i % 5)) for i in range(3000)] + [(1, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g int, v double")
    w = {r["g"]: r for r in quantiles_wide(df, "v", [0.25, 0.5, 0.9], ["a", "b", "c"], ["g"]).collect()}
    x0 = np.array([v for g, v in rows if g == 0])
    assert w[0]["a"] == pytest.approx(_np_q(x0, 0.25))
    assert w[0]["c"] == pytest.approx(_np_q(x0, 0.9))
    assert w[1]["b"] == pytest.approx(4.5)


def test_group_rank_dense_and_partition_independent(spark):
    df = spark.range(0, 5000).withColumn("g", (F.col("id") % 4).cast("int"))
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    a = with_group_rank(df, ["g"], order, "r", "n", num_partitions=3).select("id", "r", "n")
    b = with_group_rank(df.repartition(7), ["g"], order, "r", "n", num_partitions=11).select("id", "r", "n")
    ra = {r["id"]: (r["r"], r["n"]) for r in a.collect()}
    rb = {r["id"]: (r["r"], r["n"]) for r in b.collect()}
    assert ra == rb
    per = a.join(df, "id").groupBy("g").agg(F.min("r").alias("lo"), F.max("r").alias("hi"),
                                            F.countDistinct("r").alias("k"), F.first("n").alias("n")).collect()
    for r in per:
        assert (r["lo"], r["hi"], r["k"], r["n"]) == (1, 1250, 1250, 1250)


def test_global_rank_without_groups(spark):
    df = spark.range(0, 100).withColumn("v", (F.col("id") * 37 % 100).cast("double"))
    r = with_group_rank(df, [], ["v", "id"], "r", "n").collect()
    assert sorted(x["r"] for x in r) == list(range(1, 101))
    assert all(x["r"] == x["v"] + 1 for x in r)


def test_hot_group_is_spread_over_tasks(spark):
    """A group holding most of the rows is ranked exactly and split over several tasks."""
    from tabreg.operators.order import _rank_core
    df = spark.range(0, 6000).withColumn("g", F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(0))
    ranked, stats = _rank_core(df, ["g"], [F.md5(F.col("id").cast("string")), F.col("id")], "r", 8)
    hot_tasks = stats.where("g = 0").select("_tr_pid").distinct().count()
    assert hot_tasks >= 4
    hot = ranked.where("g = 0").select("r").collect()
    assert sorted(x["r"] for x in hot) == list(range(1, len(hot) + 1))


def test_approx_quantiles_close(spark):
    from tabreg.operators.quantiles import quantile_table
    df = spark.range(0, 20000).withColumn("v", (F.col("id") * 7919 % 20000).cast("double"))
    ex = {r["prob"]: r["quantile"] for r in quantile_table(df, "v", [0.1, 0.5, 0.9]).collect()}
    ap = {r["prob"]: r["quantile"] for r in quantile_table(df, "v", [0.1, 0.5, 0.9], method="approx").collect()}
    for p in ex:
        assert abs(ex[p] - ap[p]) <= 20000 / 10000 * 2


def test_rank_exact_when_aqe_merges_ranges(spark):
    """Without an explicit count the sort uses the session's partitions and AQE may merge
    neighbouring ranges; positions must stay exact."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(0, 3000).withColumn("g", (F.col("id") % 3).cast("int"))
        r = with_group_rank(df, ["g"], [F.md5(F.col("id").cast("string")), F.col("id")], "r", "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    by = {}
    for x in r:
        by.setdefault(x["g"], []).append(x["r"])
    assert all(sorted(v) == list(range(1, 1001)) for v in by.values())


def test_release_materialized(spark):
    from tabreg.session import _WRITTEN, cut_lineage, release_materialized
    release_materialized(spark)
    t = cut_lineage(spark.range(10))
    assert t.count() == 10 and len(_WRITTEN) == 1
    assert release_materialized(spark) == 1 and not _WRITTEN


def test_salted_top_k_matches_brute_force(spark):
    import random
    from tabreg.operators.order import top_k_rows, top_n_with_ties
    rnd = random.Random(5)
    rows = [("hot", f"l{i}", rnd.randint(1, 40)) for i in range(3000)] + \
           [("cold", f"m{i}", rnd.randint(1, 5)) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, level string, n int")
    got = {(r["g"], r["level"]) for r in top_k_rows(df, ["g"], [F.col("n").desc(), F.col("level")], 4).collect()}
    want = set()
    for g in ("hot", "cold"):
        sub = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:4]
        want |= {(r[0], r[1]) for r in sub}
    assert got == want
    tied = {(r["g"], r["level"]) for r in top_n_with_ties(df, "n", 3, ["g"]).collect()}
    want_t = set()
    for g in ("hot", "cold"):
        vals = sorted((r[2] for r in rows if r[0] == g), reverse=True)
        thr = vals[2] if len(vals) >= 3 else min(vals)
        want_t |= {(r[0], r[1]) for r in rows if r[0] == g and r[2] >= thr}
    assert tied == want_t


@pytest.mark.parametrize("accuracy, window_rows", [(1000, 100_000), (20, 40), (20, 5)])
def test_quantiles_by_brackets_and_pieces(spark, monkeypatch, accuracy, window_rows):
    """Brackets of a coarse sketch, narrowed piece by piece; hot values, NULL groups, NaN, infinities."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "WINDOW_ROWS", window_rows)
    monkeypatch.setattr(quantiles, "PIECES", 8)
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.lognormal(0, 6, 3000), np.full(2500, 7.0), -rng.lognormal(0, 6, 1500), [np.inf, -np.inf, 0.0]])
    rows = [("hot", float(x)) for x in vals] + [(None, float(x)) for x in rng.normal(size=300)]
    rows += [("one", 5.0), ("none", None), ("nan", 1.0), ("nan", float("nan")), ("nan", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.003, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert len(got) == 4 * len(probs)
    for g in ("hot", None, "one"):
        x = np.array([v for k, v in rows if k == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(_type7(x, p), rel=1e-12), (g, p)
    assert got[("nan", 0.5)] == 2.0 and np.isnan(got[("nan", 1.0)])
    alone = {r["prob"]: r["quantile"] for r in exact_quantiles(df.where("g = 'hot'"), "v", probs).collect()}
    assert all(alone[p] == got[("hot", p)] for p in probs)
    assert exact_quantiles(df.limit(0), "v", probs).count() == 0


def test_quantiles_count_again_where_a_bracket_is_wrong(spark, monkeypatch):
    sketch = quantiles._sketch

    def wrong(vals, by, inner):
        return sketch(vals, by, inner).withColumn("_lo", F.when(F.col("g") == 1, F.array(F.lit(3.0))).otherwise(F.col("_lo"))) \
            .withColumn("_hi", F.when(F.col("g") == 1, F.array(F.lit(4.0))).otherwise(F.col("_hi")))

    monkeypatch.setattr(quantiles, "_sketch", wrong)
    df = spark.range(6001).selectExpr("id % 3 g", "cast(id as double) v")
    got = {r["g"]: r["quantile"] for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {0: 3000.0, 1: 2999.5, 2: 3000.5}


def test_bracket_counts_spread_out_counted_values_not_rows(spark):
    """Rows below a bracket, inside and above; a value is spread over the positions after it was counted."""
    nan = float("nan")
    rows = [("a", float(i % 40)) for i in range(400)] + [(None, float(i % 7)) for i in range(70)] + [("a", nan)] * 3
    vals = spark.createDataFrame(rows, "g string, _v double").repartition(3)
    groups = spark.createDataFrame([("a", [0.0, 10.0, 11.0, 39.0], [0.0, 12.0, 14.0, nan]), (None, [2.0, 2.0, 6.0, 6.0], [2.0, 3.0, 6.0, 6.0])],
                                   "g string, _lo array<double>, _hi array<double>")
    counts = quantiles._bracket_counts(vals, groups, ["g"], [0.1, 0.2, 0.5, 0.9])
    got = {(r["g"], r["_i"], repr(r["_v"])): r["_c"] for r in counts.collect()}
    want: dict = {}
    top = lambda x: np.inf if np.isnan(x) else x
    for g, lo, hi in groups.collect():
        for _, v in (r for r in rows if r[0] == g):
            for i in range(4):
                if top(v) <= top(hi[i]):
                    key = (g, i, repr(v if top(v) >= lo[i] else None))
                    want[key] = want.get(key, 0) + 1
    assert got == want
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Generate", 1)[1]


def test_quantile_plan_has_no_range_sort(spark):
    df = spark.range(10000).selectExpr("id % 3 g", "cast(id * 7919 % 10007 as double) v")
    plan = exact_quantiles(df, "v", [0.25, 0.5], ["g"])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("rank_rows", [200_000, 50])
def test_hash_rank_equals_group_rank(spark, monkeypatch, rank_rows):
    from tabreg.operators import order
    monkeypatch.setattr(order, "RANK_ROWS", rank_rows)
    rows = [(i, 0 if i % 3 else None if i % 5 == 0 else i % 7) for i in range(4000)] + [(5, 0), (5, 0)]
    df = spark.createDataFrame(rows, "id long, g int").repartition(6)
    h = F.md5(F.concat_ws("|", F.lit("s"), F.col("id").cast("string")))
    got = with_hash_rank(df, ["g"], h, ["id"], "r", "n").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["r"], r["id"], r["n"]))
    import hashlib
    for g, found in by.items():
        want = sorted((hashlib.md5(f"s|{i}".encode()).hexdigest(), i) for i, k in rows if k == g)
        assert [i for _, i, _ in sorted(found)] == [i for _, i in want]
        assert sorted(r for r, _, _ in found) == list(range(1, len(want) + 1))
        assert {n for _, _, n in found} == {len(want)}
    assert sorted(r["r"] for r in with_hash_rank(df, [], h, ["id"], "r").collect()) == list(range(1, len(rows) + 1))
    assert "rangepartitioning" not in with_hash_rank(df, ["g"], h, ["id"], "r")._jdf.queryExecution().toString()
