"""Unit fixtures for the cleaning traps (T1, T3, T5, T7, T9, T15) and missing-value fills."""

from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators import clean, missing
from tabreg.sources import io
from tabreg.sources.codebook import Codebook, amend_from_data, codebook_from_frame

CB = Codebook(ordered={"Electrical": ["FuseP", "FuseF", "FuseA", "Mix", "SBrkr"],
                       "BsmtCond": ["NA", "Po", "Fa", "TA", "Gd", "Ex"]},
              unordered={"Alley": ["Grvl", "Pave", "NA"], "Utilities": ["AllPub", "NoSwr", "NoSeWa", "ELO"]})


def test_reconcile_na_code_rule(spark):
    rows = [(1, "NA", "NA", "NA", "AllPub"), (2, "SBrkr", "Gd", "Pave", "NoSewr"), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "Id int, Electrical string, BsmtCond string, Alley string, Utilities string")
    out = {r["Id"]: r for r in clean.reconcile(df, CB).collect()}
    assert out[1]["Electrical"] is None            # 'NA' not a level -> missing
    assert out[1]["BsmtCond"] == "NA" and out[1]["BsmtCond_rank"] == 1   # 'NA' is a level
    assert out[1]["Alley"] == "NA"
    assert out[2]["Utilities"] is None             # spelling outside the codebook
    assert out[2]["Electrical_rank"] == 5
    assert out[3]["Alley"] is None


def test_violations_report_before_coercion(spark):
    df = spark.createDataFrame([("NoSewr",), ("AllPub",), ("NoSewr",), (None,)], "Utilities string")
    v = clean.codebook_violations(df, CB.to_frame(spark), ["Utilities"]).collect()
    assert [(r["column"], r["value"], r["n"]) for r in v] == [("Utilities", "NoSewr", 2)]


def test_isin_is_never_null(spark):
    df = spark.createDataFrame([("Artery", "PosN"), ("Feedr", "Feedr"), (None, None)], "c1 string, c2 string")
    out = df.select(X.member_count(["c1", "c2"], ["Artery", "Feedr"]).alias("road"),
                    X.signed_indicator(["c1", "c2"], ["Artery", "Feedr"], ["PosN", "PosA"]).alias("s")).collect()
    assert [(r["road"], r["s"]) for r in out] == [(1, -1), (2, -1), (0, 0)]


def test_recode_first_match_and_try_cast(spark):
    df = spark.createDataFrame([("Wd Shng", "12"), ("CmentBd", "NA"), ("Other", "x")], "e string, n string")
    out = clean.recode_values(df, "e", {"Wd Shng": "WdShing", "CmentBd": "CemntBd", "Brk Cmn": "BrkFace"})
    out = clean.to_number(out, ["n"]).collect()
    assert [r["e"] for r in out] == ["WdShing", "CemntBd", "Other"]
    assert [r["n"] for r in out] == [12.0, None, None]


def test_paired_fill_intent_vs_sequential(spark):
    df = spark.createDataFrame([(None, None), (None, 198.0), ("Stone", 10.0)], "vtype string, area double")
    a = missing.paired_fill(df, ["vtype", "area"], {"vtype": "None", "area": 0.0}).collect()
    b = missing.paired_fill(df, ["vtype", "area"], {"vtype": "None", "area": 0.0}, sequential=True).collect()
    assert (a[0]["vtype"], a[0]["area"]) == ("None", 0.0)
    assert (b[0]["vtype"], b[0]["area"]) == ("None", None)      # T3: coded behaviour
    assert a[1]["vtype"] is None and a[1]["area"] == 198.0       # T4: stays for imputation


def test_joint_fill_and_global_min(spark):
    df = spark.createDataFrame([(None, None, None), (1.0, None, 1999.0), (None, None, 1950.0)],
                               "area double, cars double, yr double")
    out = missing.fill_all_missing_with(df, ["area", "cars", "yr", "yr"], {"area": 0.0, "cars": 0.0},
                                        {"yr": "min"}).collect()
    assert (out[0]["area"], out[0]["cars"], out[0]["yr"]) == (0.0, 0.0, 1950.0)
    assert out[1]["cars"] is None and out[2]["area"] is None


def test_missing_share_and_pattern(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, 4.0), (4.0, 5.0)], "a double, b double")
    ms = {r["variable"]: r["missing_share"] for r in missing.missing_share(df).collect()}
    assert ms == {"a": 0.25, "b": 0.5}
    pat = missing.missing_pattern(df, ["a", "b"]).collect()
    pats = {(r["a"], r["b"]): r["n_rows"] for r in pat if r["is_margin"] == 0}
    assert pats == {(0, 1): 1, (1, 1): 1, (0, 0): 2}
    margin = [r for r in pat if r["is_margin"] == 1][0]
    assert (margin["a"], margin["b"], margin["n_missing_cols"]) == (1, 2, 3)


def test_outlier_report_and_filter_are_not_complements(spark):
    df = spark.createDataFrame([(6000.0, 5.0, 1000.0), (5999.0, 14.0, 50.0), (10.0, 3.0, 100000.0), (1.0, 1.0, 1.0)],
                               "total double, rooms double, lot double")
    report, keep = clean.complement_rules({"big_total": ("total", 6000), "many_rooms": ("rooms", 14)})
    rep = clean.rule_report(df, report).collect()
    assert sorted(tuple(r["fired"]) for r in rep) == [("big_total",), ("many_rooms",)]
    kept = clean.rule_filter(df, keep + [F.col("lot") < 100000]).count()
    assert kept == 1                               # the extra rule removes the lot outlier too


def test_csv_reads_na_as_text(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("Id,1stFlrSF,Alley\n1,800,NA\n2,,Pave\n")
    df = io.read_text_csv(spark, str(p))
    df = clean.rename_columns(df, {"1stFlrSF": "X1stFlrSF"})
    rows = df.orderBy("Id").collect()
    assert rows[0]["Alley"] == "NA" and rows[1]["X1stFlrSF"] is None
    assert clean.lead_then_sorted(df, ["Id"]).columns == ["Id", "Alley", "X1stFlrSF"]


def test_codebook_roundtrip_and_amend(spark):
    f = CB.to_frame(spark)
    assert codebook_from_frame(f).levels("BsmtCond") == CB.levels("BsmtCond")
    data = spark.createDataFrame([(1, "1Fam"), (2, "Duplex"), (3, "1Fam"), (4, "TwnhsE")], "Id int, BldgType string")
    am = amend_from_data(f, data, "BldgType", order_by="Id")
    got = [r["level"] for r in am.where("column = 'BldgType'").orderBy("rank").collect()]
    assert got == ["1Fam", "Duplex", "TwnhsE"]
    assert CB.rename_level("Utilities", "NoSwr", "NoSewr").levels("Utilities")[1] == "NoSewr"
    assert CB.relevel("Electrical", ["Mix"]).levels("Electrical")[0] == "Mix"


def test_snapshot_roundtrip_prunes_by_set(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 10.0), (2, "test", None), (3, "train", 12.0)],
                               "Id long, Set string, SalePrice double")
    path = str(tmp_path / "snap")
    io.write_snapshot(df, path, partition_by=["Set"])
    back = io.read_snapshot(spark, path)
    tr = back.where(F.col("Set") == "train")
    assert sorted(r["Id"] for r in tr.collect()) == [1, 3]
    plan = tr._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Set" in plan
    assert missing.restore_label(back, "SalePrice", "Set").where("Set = 'test'").first()["SalePrice"] is None


def test_imputed_pairs_view(spark):
    from tabreg.operators import impute
    df = spark.createDataFrame([(i, float(i), None if i % 4 == 0 else float(2 * i)) for i in range(1, 41)],
                               "key long, x double, y double")
    out = impute.chained_impute(df, "key", ["y"], {"y": ["x"]}, min_node=2, max_depth=4)
    pairs = impute.imputed_pairs(out, "x", "y").collect()
    assert sum(r["imputed"] for r in pairs) == 10 and all(r["y"] is not None for r in pairs)
