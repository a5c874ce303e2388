"""Property tests (hypothesis): reconciliation is idempotent, fills only touch NULL cells,
a fitted recipe gives the same table every time it is applied."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tabreg.operators import clean, matrix, missing
from tabreg.sources.codebook import Codebook

CB = Codebook(ordered={"q": ["NA", "Po", "Fa", "TA", "Gd", "Ex"]}, unordered={"u": ["A", "B", "C"]})
VALUES_Q = st.sampled_from(["NA", "Po", "Fa", "TA", "Gd", "Ex", "xx", "", None])
VALUES_U = st.sampled_from(["A", "B", "C", "NA", "zz", None])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(VALUES_Q, VALUES_U), min_size=1, max_size=30))
def test_reconcile_idempotent(spark, rows):
    df = spark.createDataFrame([(i, q, u) for i, (q, u) in enumerate(rows)], "id int, q string, u string")
    once = clean.reconcile(df, CB, rank_suffix=None)
    twice = clean.reconcile(once, CB, rank_suffix=None)
    a = sorted(once.collect())
    assert a == sorted(twice.collect())
    assert all(r["q"] in CB.levels("q") + [None] and r["u"] in CB.levels("u") + [None] for r in a)


NUM = st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(NUM, NUM, NUM), min_size=1, max_size=30))
def test_fills_touch_only_null_cells(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, c double")
    out = missing.fill_all_missing_with(df, ["a", "b"], {"a": 0.0}, {"b": "min"})
    out = missing.conditional_fill(out, "c", out["a"] == 0.0, missing.global_extreme(df, "c"))
    before = {r["id"]: r for r in df.collect()}
    for r in out.collect():
        for c in ("a", "b", "c"):
            if before[r["id"]][c] is not None:
                assert r[c] == before[r["id"]][c]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.floats(0.1, 50), st.floats(-5, 5)), min_size=5, max_size=40))
def test_recipe_applied_twice_is_equal(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, x double, y double")
    rec = matrix.Recipe([matrix.BoxCox(["x"], lambdas=[-1.0, 0.0, 0.5, 1.0]),
                         matrix.Standardize(["x", "y"])]).fit(df)
    assert sorted(rec.transform(df).collect()) == sorted(rec.transform(df).collect())
