"""End to end on a generated housing table: clean -> explore -> model -> scored CSV."""

from pyspark.sql import functions as F

from tabreg.plans import housing
from tabreg.sources import io

from housing_fixture import write


def test_three_stages(spark, tmp_path):
    tr, te = write(tmp_path)
    d = housing.clean_homes(spark, tr, te).cache()
    rows = {r["Id"]: r for r in d.collect()}
    assert len(rows) == 500
    assert rows[1]["Alley"] == "NA"                       # 'NA' is a level of Alley
    assert rows[2]["MSZoning"] == "C" and rows[2]["Exterior2nd"] == "WdShing"
    assert rows[15]["Exterior2nd"] == "BrkFace"
    assert rows[4]["TotalBsmtSF"] == 0.0 and rows[4]["BsmtFullBath"] == 0.0
    assert rows[6]["MasVnrType"] == "None" and rows[6]["MasVnrArea"] == 0.0
    assert rows[8]["GarageArea"] == 0.0 and rows[8]["GarageYrBlt"] == min(
        r["GarageYrBlt"] for r in rows.values() if r["Id"] not in (8, 9))
    assert rows[10]["GarageYrBlt"] == 2007.0
    assert (rows[12]["CondRoad"], rows[12]["CondPos"], rows[12]["Cond"]) == (1, 1, -1)
    assert (rows[13]["CondRoad"], rows[14]["CondRoad"], rows[14]["Cond"]) == (2, 0, 0)
    # every predictor is complete after imputation; only the unlabelled label is missing
    left = d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in d.columns]).first().asDict()
    assert {k: v for k, v in left.items() if v} == {"SalePrice": 100}
    train, test, report = housing.explore_homes(d)
    assert {r["Id"] for r in report.collect()} >= {16}
    assert train.where("Id in (16, 17)").count() == 0
    t = {r["Id"]: r for r in train.collect()}
    assert t[11]["YearRemodAdd"] == t[11]["YearBuilt"] and t[12]["YearRemodAdd"] == 1951.0
    assert t[15]["AbvGrdSFperRm"] is None
    scored, res = housing.model_homes(train, test, folds=5,
                                      grid=[{"alpha": a, "lam": l} for a in (0.0, 0.5) for l in (0.0, 0.01)], linear=True)
    assert scored.count() == 100
    hold = res["holdout"].first()
    assert hold["rmse"] < 0.2 and hold["rsquared"] > 0.6
    assert scored.agg(F.min("SalePrice")).first()[0] > 0
    table = {r["model"]: r for r in res["comparison"].collect()}
    assert set(table) == {"elnet", "ols", "step"} and all(r["holdout_rmse"] < 0.3 for r in table.values())
    assert len(res["candidate"].fold_rmse) == 5
    assert len(housing.enet_grid()) == 100
    out = str(tmp_path / "scored")
    io.write_scored(scored, out, "Id", "SalePrice", order_by_key=True)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["Id", "SalePrice"] and back.count() == 100


def test_label_as_predictor_keeps_test_label_missing(spark, tmp_path):
    tr, te = write(tmp_path, n_train=200, n_test=50, seed=3)
    d = housing.clean_homes(spark, tr, te, label_as_predictor=True, sequential_pair_fill=True)
    rows = {r["Id"]: r for r in d.collect()}
    assert sum(r["SalePrice"] is None for r in rows.values()) == 50
    assert rows[6]["MasVnrType"] == "None"          # sequential: type filled first ...
    assert rows[6]["MasVnrArea"] is not None        # ... area then comes from the imputation
