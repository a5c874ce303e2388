"""Fixed values of the house-price analysis this library re-expresses.

Everything below is data that must equal the original analysis for equal results: level
lists, spelling fixes, level merges, rule thresholds, seeds. They are stated plainly, in
the original order. No logic lives here; the operators take these as parameters.
"""

from __future__ import annotations

from tabreg.sources.codebook import Codebook

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must match the original analysis)
# ---------------------------------------------------------------------------------------

KEY = "Id"
LABEL = "SalePrice"
LOG_LABEL = "logSalePrice"
SET_COL = "Set"

# raw headers that start with a digit, and their new names
DIGIT_RENAMES = {"1stFlrSF": "X1stFlrSF", "2ndFlrSF": "X2ndFlrSF", "3SsnPorch": "X3SsnPorch"}

# ordered factors, lowest level first
ORDERED_LEVELS = {
    "BsmtCond": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "BsmtExposure": ["NA", "No", "Mn", "Av", "Gd"],
    "BsmtFinType1": ["NA", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "BsmtFinType2": ["NA", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "BsmtQual": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "Electrical": ["FuseP", "FuseF", "FuseA", "Mix", "SBrkr"],
    "ExterQual": ["Po", "Fa", "TA", "Gd", "Ex"],
    "ExterCond": ["Po", "Fa", "TA", "Gd", "Ex"],
    "Fence": ["NA", "MnWw", "MnPrv", "GdWo", "GdPrv"],
    "FireplaceQu": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "Functional": ["Sal", "Sev", "Maj2", "Maj1", "Mod", "Min2", "Min1", "Typ"],
    "GarageCond": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "GarageFinish": ["NA", "Unf", "RFn", "Fin"],
    "GarageQual": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "HeatingQC": ["Po", "Fa", "TA", "Gd", "Ex"],
    "KitchenQual": ["Po", "Fa", "TA", "Gd", "Ex"],
    "PoolQC": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
}

# unordered factors
UNORDERED_LEVELS = {
    "Alley": ["Grvl", "Pave", "NA"],
    "BldgType": ["1Fam", "2FmCon", "Duplx", "TwnhsE", "TwnhsI"],
    "CentralAir": ["N", "Y"],
    "Condition1": ["Artery", "Feedr", "Norm", "RRNn", "RRAn", "PosN", "PosA", "RRNe", "RRAe"],
    "Condition2": ["Artery", "Feedr", "Norm", "RRNn", "RRAn", "PosN", "PosA", "RRNe", "RRAe"],
    "Exterior1st": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing"],
    "Exterior2nd": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing"],
    "Foundation": ["BrkTil", "CBlock", "PConc", "Slab", "Stone", "Wood"],
    "GarageType": ["2Types", "Attchd", "Basment", "BuiltIn", "CarPort", "Detchd", "NA"],
    "Heating": ["Floor", "GasA", "GasW", "Grav", "OthW", "Wall"],
    "HouseStyle": ["1Story", "1.5Fin", "1.5Unf", "2Story", "2.5Fin", "2.5Unf", "SFoyer", "SLvl"],
    "LandSlope": ["Gtl", "Mod", "Sev"],
    "LotConfig": ["Inside", "Corner", "CulDSac", "FR2", "FR3"],
    "LandContour": ["Lvl", "Bnk", "HLS", "Low"],
    "LotShape": ["Reg", "IR1", "IR2", "IR3"],
    "MasVnrType": ["BrkCmn", "BrkFace", "CBlock", "Stone", "None"],
    "MoSold": ["1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12"],
    "MiscFeature": ["Elev", "Gar2", "Othr", "Shed", "TenC", "NA"],
    "MSSubClass": ["20", "30", "40", "45", "50", "60", "70", "75", "80", "85", "90", "120", "150",
                   "160", "180", "190"],
    "MSZoning": ["A", "C", "FV", "I", "RH", "RL", "RP", "RM"],
    "Neighborhood": ["Blmngtn", "Blueste", "BrDale", "BrkSide", "ClearCr", "CollgCr",
                     "Crawfor", "Edwards", "Gilbert", "IDOTRR", "MeadowV", "Mitchel",
                     "Names", "NoRidge", "NPkVill", "NridgHt", "NWAmes", "OldTown",
                     "SWISU", "Sawyer", "SawyerW", "Somerst", "StoneBr", "Timber",
                     "Veenker"],
    "PavedDrive": ["Y", "P", "N"],
    "RoofMatl": ["ClyTile", "CompShg", "Membran", "Metal", "Roll", "Tar&Grv", "WdShake", "WdShngl"],
    "RoofStyle": ["Flat", "Gable", "Gambrel", "Hip", "Mansard", "Shed"],
    "SaleCondition": ["Normal", "Abnorml", "AdjLand", "Alloca", "Family", "Partial"],
    "SaleType": ["WD", "CWD", "VWD", "New", "COD", "Con", "ConLw", "ConLI", "ConLD", "Oth"],
    "Street": ["Grvl", "Pave"],
    "Utilities": ["AllPub", "NoSwr", "NoSeWa", "ELO"],
}

# codebook amendments: one level renamed, one column's levels taken from the data
LEVEL_RENAMES = [("Neighborhood", "Names", "NAmes")]
LEVELS_FROM_DATA = ["BldgType"]

# numeric predictors
NUMERIC = ["BedroomAbvGr", "BsmtFinSF1", "BsmtFinSF2", "BsmtFullBath", "BsmtHalfBath", "BsmtUnfSF",
           "EnclosedPorch", "Fireplaces", "FullBath", "GarageArea", "GarageCars", "GarageYrBlt",
           "GrLivArea", "HalfBath", "KitchenAbvGr", "LotArea", "LotFrontage", "LowQualFinSF",
           "MasVnrArea", "MiscVal", "OpenPorchSF", "OverallCond", "OverallQual", "PoolArea",
           "ScreenPorch", "TotalBsmtSF", "TotRmsAbvGrd", "WoodDeckSF", "X1stFlrSF", "X2ndFlrSF",
           "X3SsnPorch", "YearBuilt", "YearRemodAdd", "YrSold"]

# value fixes before validation
VALUE_RECODES = {
    "Exterior2nd": {"Wd Shng": "WdShing", "CmentBd": "CemntBd", "Brk Cmn": "BrkFace"},
    "MSZoning": {"C (all)": "C"},
}

# missing -> explicit level
EXPLICIT_MISSING = {"BsmtCond": "NA", "BsmtQual": "NA", "Fence": "NF", "MiscFeature": "None", "PoolQC": "NP"}

# derived condition counters and sign
ROAD = ["Artery", "Feedr"]
RAIL = ["RRNn", "RRAn", "RRNe", "RRAe"]
POSITIVE = ["PosN", "PosA"]

# single-value fix and fills
GARAGE_YEAR_FIX = (2207, 2007)
BASEMENT_JOINT = ["BsmtFullBath", "BsmtHalfBath", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "BsmtUnfSF",
                  "TotalBsmtSF"]
BASEMENT_FILL = {"BsmtFullBath": 0.0, "BsmtHalfBath": 0.0, "BsmtFinSF1": 0.0, "BsmtFinSF2": 0.0,
                 "BsmtUnfSF": 0.0, "TotalBsmtSF": 0.0}
VENEER_PAIR = {"MasVnrType": "None", "MasVnrArea": 0.0}
GARAGE_JOINT = ["GarageArea", "GarageCars", "GarageYrBlt"]
GARAGE_CODES_NONE = ["GarageCond", "GarageFinish", "GarageQual", "GarageType"]

IMPUTE_SEED = 1970
REMODEL_FLOOR = 1950

# collapse flags: (new column, source, level, value when equal)
COLLAPSE_FLAGS = [("HasAlley", "Alley", "NA", 0), ("IsFunctional", "Functional", "Typ", 1),
                  ("GasHeating", "Heating", "GasA", 1), ("LvlLand", "LandContour", "Lvl", 1),
                  ("GtlSlope", "LandSlope", "Gtl", 1), ("HasMiscFtr", "MiscFeature", "NA", 0)]

# outlier rules (column, threshold): report rows at or above, keep rows below; the filter
# also needs LotArea below its threshold
OUTLIER_RULES = {"TotalSF": ("TotalSF", 6000), "GrLivArea": ("GrLivArea", 4000),
                 "TotalBsmtSF": ("TotalBsmtSF", 6000), "X1stFlrSF": ("X1stFlrSF", 4000),
                 "TotRmsAbvGrd": ("TotRmsAbvGrd", 14)}
FILTER_EXTRA = ("LotArea", 100000)

# level merges {column: {new: [old, ...]}}, lumping (n most frequent kept) and re-levels
LEVEL_MERGES = {
    "BldgType": {"T_1": ["TwnhsE", "1Fam"], "D_T_2": ["2fmCon", "Duplex", "Twnhs"]},
    "BsmtFinType1": {"Rec2BLQ": ["Rec", "BLQ"], "LwQALQ": ["LwQ", "ALQ"]},
    "BsmtFinType2": {"Rec2BLQ": ["Rec", "BLQ"], "LwQALQ": ["LwQ", "ALQ"]},
    "Electrical": {"Other": ["FuseP", "FuseF", "FuseA", "Mix"]},
    "ExterCond": {"Po_Fa": ["Po", "Fa"], "Ta_Ex": ["TA", "Gd", "Ex"]},
    "Exterior1st": {"VinalSdP": ["VinylSd", "Stone", "ImStucc"], "HdBoardP": ["HdBoard", "CBlock", "AsphShn", "BrkComm"]},
    "Exterior2nd": {"WdSdngP": ["Wd Sdng", "WdShing", "Stucco"], "HdBoardP": ["HdBoard", "ImStucc"]},
    "ExterQual": {"Fa_TA": ["Fa", "TA"]},
    "Fence": {"NA_GP": ["NA", "GdPrv"], "M_M_G": ["MnWw", "MnPrv", "GdWo"]},
    "FireplaceQu": {"NA_Fa": ["NA", "Po", "Fa"]},
    "Foundation": {"CBlockP": ["CBlock", "Stone"]},
    "GarageCond": {"NA_Fa": ["NA", "Po", "Fa"], "TA_Ex": ["TA", "Gd", "Ex"]},
    "GarageFinish": {"NA_Unf": ["NA", "Unf"]},
    "GarageQual": {"Po_Fa": ["Po", "Fa"], "Gd_Ex": ["Gd", "Ex"]},
    "GarageType": {"CarPortP": ["CarPort", "NA"]},
    "HouseStyle": {"Story2P": ["2Story", "2.5Fin"]},
    "LotShape": {"IR": ["IR1", "IR2", "IR3"]},
    "MSZoning": {"C_P": ["C", "RH", "RM"]},
    "Neighborhood": {"A1": ["NoRidge", "NridgHt", "StoneBr"],
                     "A2": ["Veenker", "Timber", "Somerst", "ClearCr"],
                     "A3": ["Crawfor", "CollgCr", "Gilbert"],
                     "A4": ["NWAmes", "Blmngtn", "SawyerW"],
                     "A5": ["NAmes", "NPkVill", "Blueste", "Sawyer", "SWISU", "Mitchel"],
                     "A6": ["OldTown", "BrkSide", "Edwards", "BrDale", "MeadowV", "IDOTRR"]},
}
LUMP_TOP1 = ["Alley", "Functional", "Heating", "LandContour", "LandSlope", "MiscFeature"]
RELEVELS = {"BsmtFinType1": ["NA", "Rec2BLQ", "LwQALQ", "Unf", "GLQ"],
            "BsmtFinType2": ["NA", "Rec2BLQ", "LwQALQ", "Unf", "GLQ"]}
DROP_FOR_MODEL = ["SalePrice", "Condition1", "Condition2", "CondRoad", "CondRail", "CondPos"]

SPLIT_SEED = 12345
SPLIT_P = 0.80
FOLDS = 10
NZV_FREQ_CUT_EXPLORE = 99 / 5
NZV_UNIQUE_CUT = 10
CORR_CUTOFF = 0.90
SCREEN_CUTOFF = 0.5

# tuning grids (lambda sequences as in the original: 100 evenly spaced points)
GRID_RIDGE = {"alpha": [0.0], "lam_from": 0.0, "lam_to": 0.5, "n": 100}
GRID_LASSO = {"alpha": [1.0], "lam_from": 0.0, "lam_to": 0.025, "n": 100}
GRID_ENET = {"alpha_from": 0.0, "alpha_to": 0.25, "n_alpha": 10, "lam_from": 0.0, "lam_to": 0.05, "n_lam": 10}

# ---------------------------------------------------------------------------------------


def codebook() -> Codebook:
    cb = Codebook({k: list(v) for k, v in ORDERED_LEVELS.items()},
                  {k: list(v) for k, v in UNORDERED_LEVELS.items()})
    for col, old, new in LEVEL_RENAMES:
        cb = cb.rename_level(col, old, new)
    return cb
