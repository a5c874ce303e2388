"""Generated housing-shaped CSV fixtures (no row of any real data set): a labelled and an
unlabelled file with the edge rows listed in FIXTURES.md section 3."""

import csv

import numpy as np

COLUMNS = ["Id", "MSZoning", "LotFrontage", "LotArea", "Street", "Alley", "Neighborhood", "BldgType",
           "Condition1", "Condition2", "OverallQual", "YearBuilt", "YearRemodAdd", "Exterior2nd", "ExterQual",
           "MasVnrType", "MasVnrArea", "BsmtQual", "BsmtCond", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF",
           "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath", "Heating", "Electrical", "1stFlrSF", "GrLivArea",
           "FullBath", "HalfBath", "KitchenQual", "TotRmsAbvGrd", "Functional", "GarageType", "GarageYrBlt",
           "GarageFinish", "GarageCars", "GarageArea", "GarageQual", "GarageCond", "LandContour", "LandSlope",
           "MiscFeature", "Utilities"]


def _row(i, rng):
    q = int(rng.integers(3, 10))
    liv = float(rng.integers(700, 2800))
    bsmt = float(rng.integers(0, 1500))
    yb = int(rng.integers(1900, 2009))
    hood = ["NAmes", "CollgCr", "OldTown", "Edwards", "Somerst", "NridgHt"][int(rng.integers(0, 6))]
    r = {"Id": str(i), "MSZoning": ["RL", "RM", "FV"][int(rng.integers(0, 3))], "LotFrontage": str(int(rng.integers(40, 120))),
         "LotArea": str(int(rng.integers(3000, 20000))), "Street": "Pave", "Alley": ["NA", "Grvl", "Pave"][int(rng.integers(0, 3))],
         "Neighborhood": hood, "BldgType": ["1Fam", "TwnhsE", "Duplex"][int(rng.integers(0, 3))],
         "Condition1": ["Norm", "Feedr", "Artery", "PosN", "RRAn"][int(rng.integers(0, 5))], "Condition2": "Norm",
         "OverallQual": str(q), "YearBuilt": str(yb), "YearRemodAdd": str(max(yb, int(rng.integers(1950, 2010)))),
         "Exterior2nd": ["VinylSd", "HdBoard", "Wd Sdng", "MetalSd"][int(rng.integers(0, 4))],
         "ExterQual": ["TA", "Gd", "Ex", "Fa"][int(rng.integers(0, 4))],
         "MasVnrType": ["None", "BrkFace", "Stone"][int(rng.integers(0, 3))], "MasVnrArea": str(int(rng.integers(0, 400))),
         "BsmtQual": ["TA", "Gd", "Ex", "NA"][int(rng.integers(0, 4))], "BsmtCond": ["TA", "Gd", "Fa"][int(rng.integers(0, 3))],
         "BsmtFinSF1": str(int(bsmt * 0.5)), "BsmtFinSF2": "0", "BsmtUnfSF": str(int(bsmt * 0.5)), "TotalBsmtSF": str(int(bsmt)),
         "BsmtFullBath": str(int(rng.integers(0, 2))), "BsmtHalfBath": "0", "Heating": ["GasA", "GasA", "GasW"][int(rng.integers(0, 3))],
         "Electrical": ["SBrkr", "SBrkr", "FuseA"][int(rng.integers(0, 3))], "1stFlrSF": str(int(liv * 0.6)), "GrLivArea": str(int(liv)),
         "FullBath": str(int(rng.integers(1, 3))), "HalfBath": str(int(rng.integers(0, 2))),
         "KitchenQual": ["TA", "Gd", "Ex"][int(rng.integers(0, 3))], "TotRmsAbvGrd": str(int(rng.integers(4, 11))),
         "Functional": ["Typ", "Typ", "Min1"][int(rng.integers(0, 3))], "GarageType": ["Attchd", "Detchd"][int(rng.integers(0, 2))],
         "GarageYrBlt": str(yb), "GarageFinish": ["Unf", "RFn", "Fin"][int(rng.integers(0, 3))],
         "GarageCars": str(int(rng.integers(1, 4))), "GarageArea": str(int(rng.integers(200, 900))),
         "GarageQual": "TA", "GarageCond": "TA", "LandContour": ["Lvl", "Lvl", "Bnk"][int(rng.integers(0, 3))],
         "LandSlope": ["Gtl", "Gtl", "Mod"][int(rng.integers(0, 3))], "MiscFeature": ["NA", "NA", "Shed"][int(rng.integers(0, 3))],
         "Utilities": "AllPub"}
    price = np.exp(10.5 + 0.0004 * liv + 0.09 * q + 0.0002 * bsmt + 0.002 * (yb - 1950) + rng.normal(0, 0.08))
    return r, float(price)


def _edges(r, i):
    """Apply the edge rows of FIXTURES.md section 3 by row id."""
    if i == 1:
        r.update(Electrical="NA", Alley="NA", LotFrontage="NA")
    if i == 2:
        r.update(MSZoning="C (all)", Exterior2nd="Wd Shng")
    if i == 3:
        r.update(Exterior2nd="CmentBd", Utilities="NoSewr")
    if i == 4:
        r.update(BsmtFinSF1="", BsmtFinSF2="", BsmtUnfSF="", TotalBsmtSF="", BsmtFullBath="", BsmtHalfBath="")
    if i == 5:
        r.update(BsmtFullBath="", TotalBsmtSF="")
    if i == 6:
        r.update(MasVnrType="NA", MasVnrArea="NA")
    if i == 7:
        r.update(MasVnrType="NA", MasVnrArea="198")
    if i == 8:
        r.update(GarageArea="", GarageCars="", GarageYrBlt="")
    if i == 9:
        r.update(GarageYrBlt="NA", GarageArea="0", GarageCars="0", GarageType="NA", GarageFinish="NA",
                 GarageQual="NA", GarageCond="NA")
    if i == 10:
        r.update(GarageYrBlt="2207")
    if i == 11:
        r.update(YearRemodAdd="1950")
    if i == 12:
        r.update(YearRemodAdd="1951", Condition1="Artery", Condition2="PosN")
    if i == 13:
        r.update(Condition1="Feedr", Condition2="Feedr")
    if i == 14:
        r.update(Condition1="", Condition2="")
    if i == 15:
        r.update(TotRmsAbvGrd="0", Exterior2nd="Brk Cmn")
    if i == 16:
        r.update(GrLivArea="4500", TotRmsAbvGrd="14")
    if i == 17:
        r.update(LotArea="150000")
    return r


def write(tmp_path, n_train=400, n_test=100, seed=7):
    rng = np.random.default_rng(seed)
    tr, te = tmp_path / "train.csv", tmp_path / "test.csv"
    with open(tr, "w", newline="") as ft, open(te, "w", newline="") as fe:
        wt = csv.writer(ft)
        we = csv.writer(fe)
        wt.writerow(COLUMNS + ["SalePrice"])
        we.writerow(COLUMNS)
        for i in range(1, n_train + n_test + 1):
            r, price = _row(i, rng)
            r = _edges(r, i)
            if i <= n_train:
                wt.writerow([r[c] for c in COLUMNS] + [f"{price:.0f}"])
            else:
                we.writerow([r[c] for c in COLUMNS])
    return str(tr), str(te)
