"""The three stages of the house-price analysis, composed from the library's operators.

``clean_homes``    raw CSVs -> reconciled, derived, filled, imputed table (stage 1)
``explore_homes``  clean table -> features, log label, outlier filter, train / test (stage 2)
``model_homes``    train / test -> split and folds, elastic net tuned with its recipe inside the
                   folds, hold-out metrics, refit on all labelled rows, scored table (stage 3)
``linear_homes``   least squares and stepwise selection on the collapsed factors

Columns absent from the input are skipped, so the same code runs on the full table and on
the small generated fixtures of the tests. Every step is a Spark projection, aggregate or
join; only level lists, p x p matrices and scalars reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.operators import clean, compare, evaluate, features, impute, matrix, missing, models, split, tune
from tabreg.operators.foldrecipe import FoldRecipe
from tabreg.sources import housing as H
from tabreg.sources import io
from tabreg.sources.codebook import Codebook
from tabreg.session import cut_lineage


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


# -- stage 1 ------------------------------------------------------------------------------

def clean_homes(spark: SparkSession, train_path: str, test_path: str, impute_missing: bool = True,
                sequential_pair_fill: bool = False, label_as_predictor: bool = False) -> DataFrame:
    """Stage 1. ``sequential_pair_fill`` reproduces the chained assignment of the veneer pair
    (area stays missing); ``label_as_predictor`` lets the label (with the unlabelled rows'
    labels imputed, then reset) predict other columns, as the original imputation did."""
    tr = io.tag_set(io.read_text_csv(spark, train_path), "train", H.SET_COL)
    te = io.tag_set(io.read_text_csv(spark, test_path), "test", H.SET_COL, label=H.LABEL)
    d = io.union_by_name([clean.rename_columns(tr, H.DIGIT_RENAMES), clean.rename_columns(te, H.DIGIT_RENAMES)])
    d = clean.lead_then_sorted(d, [H.SET_COL, H.KEY, H.LABEL])
    d = clean.to_number(d, _present(d, [H.KEY, H.LABEL, *H.NUMERIC]))
    d = d.withColumn(H.KEY, F.col(H.KEY).cast("long"))
    for col, mapping in H.VALUE_RECODES.items():
        if col in d.columns:
            d = clean.recode_values(d, col, mapping)
    cb = H.codebook()
    for col in H.LEVELS_FROM_DATA:                     # levels taken from the data (small distinct)
        if col in d.columns:
            lv = [r[0] for r in d.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(H.KEY).alias("k"))
                  .orderBy("k").select(col).collect()]
            cb = cb.with_levels(col, lv, "unordered")
    cols = _present(d, cb.columns)
    d = clean.reconcile(d, Codebook({c: cb.levels(c) for c in cols if cb.kind(c) == "ordered"},
                                    {c: cb.levels(c) for c in cols if cb.kind(c) == "unordered"}),
                        cols, fills={c: v for c, v in H.EXPLICIT_MISSING.items() if c in cols}, rank_suffix=None)
    if {"Condition1", "Condition2"} <= set(d.columns):
        cc = ["Condition1", "Condition2"]
        d = features.add_features(d, {"CondRoad": X.member_count(cc, H.ROAD), "CondRail": X.member_count(cc, H.RAIL),
                                      "CondPos": X.member_count(cc, H.POSITIVE),
                                      "Cond": X.signed_indicator(cc, H.ROAD + H.RAIL, H.POSITIVE)})
    if "GarageYrBlt" in d.columns:
        d = d.withColumn("GarageYrBlt", X.replace_value("GarageYrBlt", *H.GARAGE_YEAR_FIX))
    if set(H.BASEMENT_JOINT) <= set(d.columns):
        d = missing.fill_when_all_missing(d, H.BASEMENT_JOINT, H.BASEMENT_FILL)
    if set(H.VENEER_PAIR) <= set(d.columns):
        d = missing.paired_fill(d, list(H.VENEER_PAIR), H.VENEER_PAIR, sequential=sequential_pair_fill)
    if set(H.GARAGE_JOINT) <= set(d.columns):
        d = missing.fill_all_missing_with(d, H.GARAGE_JOINT, {"GarageArea": 0.0, "GarageCars": 0.0},
                                          {"GarageYrBlt": "min"})
        if set(H.GARAGE_CODES_NONE) <= set(d.columns):
            cond = X.all_of([F.col("GarageArea") == 0, F.col("GarageCars") == 0] +
                            [F.col(c) == "NA" for c in H.GARAGE_CODES_NONE])
            d = missing.conditional_fill(d, "GarageYrBlt", cond, missing.global_extreme(d, "GarageYrBlt"))
    if impute_missing:
        d = _impute(d, cb, label_as_predictor)
    return missing.restore_label(d, H.LABEL, H.SET_COL, "test")


def _impute(d: DataFrame, cb: Codebook, label_as_predictor: bool = False) -> DataFrame:
    skip = {H.SET_COL, H.KEY} | (set() if label_as_predictor else {H.LABEL})
    cols = [c for c in d.columns if c not in skip]
    incomplete = missing.columns_with_missing(d, cols)
    if not incomplete:
        return d
    cat = [c for c in incomplete if c in cb.columns]
    num_all = [c for c in cols if c in H.NUMERIC or c in ("CondRoad", "CondRail", "CondPos", "Cond", H.LABEL)]
    ranked = d.withColumns({f"{c}__r": F.array_position(F.array(*[F.lit(v) for v in cb.levels(c)]), F.col(c))
                            .cast("double") for c in cols if c in cb.columns})
    pred_cols = num_all + [f"{c}__r" for c in cols if c in cb.columns]
    sel = missing.impute_predictors(ranked, pred_cols, mincor=0.1)
    chosen: dict[str, list[str]] = {}
    # a complete ordered factor predicts by its rank, any other factor as itself: an incomplete one as
    # completed so far
    as_rank = {f"{c}__r" for c in cb.columns if _ordered(c) and c not in incomplete}
    for r in sel.where("selected").collect():                  # (target, predictor) names only
        p = r["predictor"] if r["predictor"] in as_rank else r["predictor"].removesuffix("__r")
        chosen.setdefault(r["target"].removesuffix("__r"), []).append(p)
    out = impute.chained_impute(ranked, H.KEY, incomplete, chosen, categorical=cat, seed=H.IMPUTE_SEED)
    return out.drop(*[c for c in out.columns if c.endswith("__r") or c.endswith("_imputed")])


# -- stage 2 ------------------------------------------------------------------------------

def explore_homes(d: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (train after the outlier filter, test, outlier report)."""
    if {"YearRemodAdd", "YearBuilt"} <= set(d.columns):
        d = d.withColumn("YearRemodAdd", X.floor_fallback("YearRemodAdd", H.REMODEL_FLOOR, "YearBuilt"))
    d = features.add_features(d, {new: X.equals_flag(src, lvl, val) for new, src, lvl, val in H.COLLAPSE_FLAGS
                                  if src in d.columns})
    feats = {}
    if {"TotalBsmtSF", "GrLivArea"} <= set(d.columns):
        feats["TotalSF"] = F.col("TotalBsmtSF") + F.col("GrLivArea")
    if {"BsmtFullBath", "BsmtHalfBath", "FullBath", "HalfBath"} <= set(d.columns):
        feats["TotalBath"] = X.weighted_sum({"BsmtFullBath": 1, "BsmtHalfBath": 0.5, "FullBath": 1, "HalfBath": 0.5})
    if {"GrLivArea", "TotRmsAbvGrd"} <= set(d.columns):
        feats["AbvGrdSFperRm"] = X.safe_ratio("GrLivArea", "TotRmsAbvGrd")
    if "TotalBsmtSF" in d.columns:
        feats["HasBsmt"] = X.presence_flag("TotalBsmtSF")
    if "GarageArea" in d.columns:
        feats["HasGarage"] = X.presence_flag("GarageArea")
    d = features.add_features(d, feats)
    d = features.log_label(d, H.LABEL, H.LOG_LABEL)
    d = clean.lead_then_sorted(d, [H.SET_COL, H.KEY, H.LABEL, H.LOG_LABEL])
    train = d.where(F.col(H.SET_COL) == "train").drop(H.SET_COL)
    test = d.where(F.col(H.SET_COL) == "test").drop(H.SET_COL)
    rules = {k: v for k, v in H.OUTLIER_RULES.items() if v[0] in train.columns}
    report_rules, keep = clean.complement_rules(rules)
    report = clean.rule_report(train, report_rules).select(H.KEY, H.LABEL, *[c for c, _ in rules.values()], "fired")
    extra = [F.col(H.FILTER_EXTRA[0]) < H.FILTER_EXTRA[1]] if H.FILTER_EXTRA[0] in train.columns else []
    return clean.rule_filter(train, keep + extra), test, report


# -- stage 3 ------------------------------------------------------------------------------

def collapse_levels(d: DataFrame) -> tuple[DataFrame, dict]:
    """Level merges and top-1 lumping (fitted on the pooled table, as the original does);
    returns the table and the kept levels of every lumped column."""
    for col, groups in H.LEVEL_MERGES.items():
        if col in d.columns:
            d = features.merge_levels(d, col, groups)
    lump = _present(d, H.LUMP_TOP1)
    kept: dict = {}
    if lump:
        lm = features.LevelLumper(lump, n=1).fit(d)
        d, kept = lm.transform(d), lm.levels()
    return d.drop(*_present(d, H.DROP_FOR_MODEL)), kept


def _ordered(column: str) -> bool:
    """Columns whose levels come from the data are unordered, whatever the codebook says."""
    return column in H.ORDERED_LEVELS and column not in H.LEVELS_FROM_DATA


def _encoded(d: DataFrame, levels: dict[str, list[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """Factors as contrasts (level lists of the codebook, or of ``levels`` where merged), and the names
    of the numeric predictors. A factor value outside of its level list is an error; a derived ratio
    without a value (a division by 0) counts as 0."""
    cb = H.codebook()
    text = [c for c, t in d.dtypes if t == "string" and c != H.SET_COL]
    ordinal = [c for c in text if _ordered(c)]
    nominal = [c for c in text if c not in ordinal]
    known = {c: cb.levels(c) for c in ordinal}
    known |= {c: cb.levels(c) for c in nominal if c in cb.columns and c not in H.LEVELS_FROM_DATA and levels is None}
    known |= {c: v for c, v in (levels or {}).items() if c in ordinal}
    enc = features.ContrastEncoder(nominal=nominal, ordinal=ordinal, levels=known).fit(d)
    # the encoded table is wide (one expression per contrast column): materialise it once, so the
    # split, the folds and every Gram pass start from a plain scan
    unknown = {c: F.count_if(F.col(c).isNull() | ~F.col(c).isin(lv)) for c, lv in {**enc.nominal, **enc.ordinal}.items() if lv}
    if unknown:
        bad = {c: n for c, n in d.agg(*[e.alias(c) for c, e in unknown.items()]).first().asDict().items() if n}
        if bad:
            raise ValueError(f"values outside of the level lists: {bad}")
    wide = cut_lineage(enc.transform(d))
    num = [c for c, t in wide.dtypes if t in ("double", "int", "bigint") and c not in (H.KEY, H.LABEL, H.LOG_LABEL)]
    return wide.fillna(0.0, subset=num), num


def enet_grid() -> list[dict]:
    g = H.GRID_ENET
    return tune.param_grid(alpha=[float(x) for x in np.linspace(g["alpha_from"], g["alpha_to"], g["n_alpha"])],
                           lam=[float(x) for x in np.linspace(g["lam_from"], g["lam_to"], g["n_lam"])])


PEN_RECIPE = FoldRecipe(("zv", "center", "scale"))
OLS_RECIPE = FoldRecipe(("nzv", "lincomb", "corr", "boxcox", "center", "scale"), corr_cut=H.CORR_CUTOFF)


def split_homes(labelled: DataFrame, folds: int = H.FOLDS) -> DataFrame:
    """``(key, fold)`` of the labelled rows: fold 1..k of the 80 % part, NULL for the hold-out."""
    a = cut_lineage(split.stratified_split(labelled, H.KEY, H.LOG_LABEL, p=H.SPLIT_P, seed=H.SPLIT_SEED).select(H.KEY, "split"))
    tr80 = split.keep_rows(labelled.select(H.KEY, H.LOG_LABEL), a, H.KEY, F.col("split") == "train")
    fo = split.stratified_folds(tr80, H.KEY, H.LOG_LABEL, k=folds, seed=H.SPLIT_SEED).select(H.KEY, "fold")
    return cut_lineage(a.join(fo, H.KEY, "left").select(H.KEY, "fold"))


def _labelled(train: DataFrame, test: DataFrame, collapse: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """Encoded labelled and unlabelled rows with their predictors, factors as they are or collapsed."""
    d, levels = io.union_by_name([train, test]), None
    if collapse:
        d, lumped = collapse_levels(d)
        cb = H.codebook()
        levels = {c: features.merged_level_order(cb.levels(c), H.LEVEL_MERGES.get(c, {})) for c in d.columns if _ordered(c)}
        for c, lv in H.RELEVELS.items():
            if c in levels:
                levels[c] = [*lv, *[v for v in levels[c] if v not in lv]]
        for c, keep in lumped.items():      # a lumped ordered factor: kept levels, then Other
            if c in levels:
                levels[c] = [v for v in levels[c] if v in keep] + ["Other"]
    wide, num = _encoded(d, levels)
    return wide.where(F.col(H.LOG_LABEL).isNotNull()), wide.where(F.col(H.LOG_LABEL).isNull()), num


def linear_homes(train: DataFrame, test: DataFrame, folds: DataFrame) -> tuple[list[compare.Candidate], DataFrame]:
    """Least squares and stepwise selection on the collapsed factors with the whole recipe refitted
    in every fold; the candidates and the encoded hold-out rows."""
    lab, _, num = _labelled(train, test, collapse=True)
    lab = cut_lineage(lab.join(folds, H.KEY))
    tr80, ho20 = lab.where(F.col("fold").isNotNull()), lab.where(F.col("fold").isNull())
    return [compare.linear(kind, tr80, num, H.LOG_LABEL, "fold", [{"lam": 0.0}], kind, OLS_RECIPE) for kind in ("ols", "step")], ho20


def model_homes(train: DataFrame, test: DataFrame, folds: int = H.FOLDS, grid: list[dict] | None = None,
                linear: bool = False):
    """The winner's flow: the labelled rows are split 80 : 20 before anything is fitted; an elastic net on
    the factors as they are (not collapsed) is tuned on stratified folds of the 80 % part with zero
    variance, centring and scaling refitted in each fold, checked on the 20 %, refitted with its best
    setting on all labelled rows, and scores the others. Returns (scored test table, results dict);
    ``linear`` adds the comparison with least squares and stepwise selection on the same folds."""
    lab, unl, num = _labelled(train, test, collapse=False)
    assigned = split_homes(lab, folds)
    lab = cut_lineage(lab.join(assigned, H.KEY))
    tr80, ho20 = lab.where(F.col("fold").isNotNull()), lab.where(F.col("fold").isNull())
    grid = enet_grid() if grid is None else grid
    elnet = compare.linear("elnet", tr80, num, H.LOG_LABEL, "fold", grid, "enet", PEN_RECIPE)
    spec = models.LinearSpec("enet", lam=float(elnet.best["lam"]), alpha=float(elnet.best["alpha"]))
    hold = evaluate.regression_metrics(elnet.predict(ho20), "pred", H.LOG_LABEL)
    constant = set(matrix.zero_variance_columns(lab, num))
    used = [c for c in num if c not in constant]
    fit_all = models.fit_linear(lab, used, H.LOG_LABEL, spec)
    scored = unl.select(F.col(H.KEY), F.exp(models.linear_expr(fit_all)).alias(H.LABEL))
    res = {"candidate": elnet, "holdout": hold, "features": used, "fit": fit_all, "coefficients": fit_all.as_dict()}
    if linear:
        others, ho20_linear = linear_homes(train, test, assigned)
        both = [compare.comparison([elnet], ho20, H.LOG_LABEL), compare.comparison(others, ho20_linear, H.LOG_LABEL)]
        res["comparison"] = evaluate.stack(both).orderBy(F.desc("holdout_rmse"))
    return scored, res
