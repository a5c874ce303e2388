"""Chained tree imputation with donor draws.

For every incomplete column, in order: fit a decision tree (MLlib, ``leafCol``) on the rows
where the column is observed, using the current (already completed) predictors; send every
row to its leaf; a missing cell takes the value of an observed *donor* in the same leaf.
Before the sweep each column gets an initial fill drawn from all of its observed values.

No predictor is left out. A predictor that is imputed itself enters as completed so far; any
other one keeps its gaps as information: a text column gets a level of its own for them, a
numeric one a value below all others and an indicator.

The donor draw is exact and reproducible without collecting a leaf anywhere: observed rows
are numbered inside their leaf by ``md5(seed|column|key)`` (ranks by hash prefix; a leaf holding
a third of the rows is spread over many tasks); a missing row picks slot
``pmod(xxhash64(seed, column, key), n_leaf) + 1`` and the donor is an equi-join on
``(leaf, slot)`` (J7). Where a leaf has few donors for many gaps, each donor is repeated under as
many salts as keep a join key below ``DRAWS_PER_KEY`` rows. Only missing rows are joined; observed
ones pass. Lineage is cut after every column (the narrow working table is written as Parquet to
the shared checkpoint folder and read back).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tabreg.operators.order import null_safe, small_side, with_hash_rank
from tabreg.session import cut_lineage

DRAWS_PER_KEY = 100_000


def donor_draw(df: DataFrame, key: str, target: str, group_cols: Sequence[str] = (), seed: int = 1970,
               out: str | None = None) -> DataFrame:
    """Fill NULLs of ``target`` with a reproducible draw from the observed values of the
    same group (all rows when ``group_cols`` is empty). Groups without any observed value
    stay NULL. Adds ``out`` (default ``target``) and a boolean ``<target>_imputed``. ``df`` is read
    several times and must give the same rows each time."""
    by = list(group_cols)
    out = out or target
    gap = F.col(target).isNull()
    flag = f"{target}_imputed"
    columns = [*dict.fromkeys([*df.columns, flag, out])]
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(target), F.col(key).cast("string")))
    ranked = with_hash_rank(df.where(~gap).select(key, *by, F.col(target).alias("_donor")), by, order, [key], "_slot")
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n_gap") / F.col("_n_donor") / DRAWS_PER_KEY)).cast("int")
    sizes = cut_lineage(df.groupBy(*by).agg(F.count_if(~gap).alias("_n_donor"), F.count_if(gap).alias("_n_gap"))
                        .where((F.col("_n_donor") > 0) & (F.col("_n_gap") > 0)).withColumn("_salts", salts))
    if by:
        donors, gaps = null_safe(ranked, small_side(sizes), by), null_safe(df.where(gap), small_side(sizes), by, "left")
    else:
        one = sizes.select(F.struct("_n_donor", "_salts")).scalar()
        donors, gaps = (d.withColumn("_s", one).select(*d.columns, "_s.*") for d in (ranked, df.where(gap)))
    donors = donors.select(*by, "_slot", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), "_donor")
    hashed = lambda tag, n: F.pmod(F.xxhash64(F.lit(str(seed)), F.lit(tag), F.col(key)), n)
    gaps = (gaps.withColumn("_slot", hashed(target, F.col("_n_donor")) + 1)
            .withColumn("_salt", hashed(f"salt of {target}", F.col("_salts")).cast("int")))
    # a group without donors has no slot: its rows pass without a join key
    drawn = null_safe(gaps.where(F.col("_slot").isNotNull()), donors, [*by, "_slot", "_salt"], "left")
    none = gaps.where(F.col("_slot").isNull()).withColumn("_donor", F.lit(None).cast(df.schema[target].dataType))
    parts = [df.where(~gap).withColumn(flag, F.lit(False)).withColumn(out, F.col(target))]
    parts += [p.withColumn(flag, F.col("_donor").isNotNull()).withColumn(out, F.col("_donor")) for p in (drawn, none)]
    return parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns))


def with_gaps_as_information(df: DataFrame, cols: Sequence[str], max_bins: int) -> tuple[DataFrame, dict[str, list[str]]]:
    """Columns of ``cols`` as complete tree inputs: ``{column: [input columns]}``. A text column
    becomes the index of its level, with one more for a gap (a categorical input up to ``max_bins``
    levels, beyond that the order by frequency); a numeric column with gaps a value below all others
    and an indicator; a complete numeric column stays."""
    inputs: dict[str, list[str]] = {}
    texts = [c for c in cols if isinstance(df.schema[c].dataType, StringType)]
    numbers = [c for c in cols if c not in texts]
    if numbers:
        r = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n|{c}") for c in numbers],
                   *[F.min(F.col(c).cast("double")).alias(f"lo|{c}") for c in numbers],
                   *[F.max(F.col(c).cast("double")).alias(f"hi|{c}") for c in numbers]).first()
        for c in numbers:
            inputs[c] = [c]
            if r[f"n|{c}"]:
                lo, hi = r[f"lo|{c}"] or 0.0, r[f"hi|{c}"] or 0.0
                inputs[c] = [f"_in_{c}", f"_gap_{c}"]
                df = df.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(lo - max(1.0, hi - lo))),
                                     f"_gap_{c}": F.col(c).isNull().cast("double")})
    for c in texts:
        model = StringIndexer(inputCol=c, outputCol=f"_ix_{c}", handleInvalid="keep").fit(df)
        df = model.transform(df)
        inputs[c] = [f"_ix_{c}"]
        if len(model.labels) + 1 > max_bins:                      # without the nominal attribute: a number
            df = df.withColumn(f"_rk_{c}", F.col(f"_ix_{c}") + F.lit(0.0))
            inputs[c] = [f"_rk_{c}"]
    return df, inputs


def leaf_of_rows(cur: DataFrame, target: str, predictors: Sequence[str], categorical: bool, seed: int, min_node: int,
                 max_depth: int, max_bins: int) -> DataFrame:
    """``cur`` with ``_leaf``: the leaf of a tree for ``_orig_<target>`` fitted on its observed rows."""
    base, inputs = with_gaps_as_information(cur, predictors, max_bins)
    vec = VectorAssembler(inputCols=[i for c in predictors for i in inputs[c]], outputCol="_feat", handleInvalid="error")
    base = vec.transform(base)
    train = base.where(F.col(f"_orig_{target}").isNotNull())
    made = dict(featuresCol="_feat", leafCol="_leaf", minInstancesPerNode=min_node, maxDepth=max_depth, maxBins=max_bins,
                seed=seed)
    if categorical:
        index = StringIndexer(inputCol=f"_orig_{target}", outputCol="_lab", handleInvalid="error").fit(train)
        model = DecisionTreeClassifier(labelCol="_lab", **made).fit(index.transform(train))
    else:
        model = DecisionTreeRegressor(labelCol=f"_orig_{target}", **made).fit(train)
    return model.transform(base).select(*cur.columns, "_leaf")


def chained_impute(df: DataFrame, key: str, targets: Sequence[str],
                   predictors: Mapping[str, Sequence[str]] | None = None, categorical: Sequence[str] = (),
                   seed: int = 1970, min_node: int = 5, max_depth: int = 10, max_bins: int = 256,
                   sweeps: int = 1) -> DataFrame:
    """I6 + I7: returns ``df`` with every target completed and ``<target>_imputed`` flags
    (I9: the observed-vs-imputed review table is a filter on those flags).

    ``predictors[t]`` lists predictor columns (numeric or text, complete or not) for target ``t``
    (e.g. the selected rows of ``missing.impute_predictors``); by default the columns given in
    ``predictors['*']``. Text targets and those in
    ``categorical`` use a classification tree. A column without any observed value stays NULL."""
    predictors = dict(predictors or {})
    # work on the narrow projection the imputation needs (key, targets, predictors); the
    # completed columns are joined back to the full table once at the end
    of = {t: [c for c in predictors.get(t, predictors.get("*", [])) if c != t and c in df.columns] for t in targets}
    used = [c for c in df.columns if c != key and (c in targets or any(c in v for v in of.values()))]
    cur = cut_lineage(df.select(key, *used, *[F.col(t).alias(f"_orig_{t}") for t in targets]))
    empty = cur.agg(*[F.count(f"_orig_{t}").alias(t) for t in targets]).first() if targets else {}
    live = [t for t in targets if empty[t]]
    # initial fill: a draw from all observed values. ``donor_draw`` reads its input several
    # times, so the plan is cut after every column (else it grows geometrically)
    for t in live:
        cur = cut_lineage(donor_draw(cur, key, t, (), seed).drop(f"{t}_imputed"))
    for _ in range(sweeps):
        for t in live:
            if not of[t]:
                continue
            as_class = t in categorical or isinstance(df.schema[t].dataType, StringType)
            leafs = leaf_of_rows(cur, t, of[t], as_class, seed, min_node, max_depth, max_bins)
            # a leaf without observed rows keeps the draw it has
            leafs = cut_lineage(leafs.withColumnRenamed(t, "_prev").withColumn(t, F.col(f"_orig_{t}")))
            filled = donor_draw(leafs, key, t, ["_leaf"], seed)
            cur = cut_lineage(filled.withColumn(t, F.coalesce(F.col(t), F.col("_prev"))).select(*cur.columns))
    done = cur.select(key, *targets, *[(F.col(f"_orig_{t}").isNull() & F.col(t).isNotNull()).alias(f"{t}_imputed") for t in targets])
    rest = [c for c in df.columns if c not in targets]
    return df.select(*rest).join(done, key, "inner").select(*df.columns, *[f"{t}_imputed" for t in targets])


def imputed_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(x, y, imputed)`` pairs for an observed-vs-imputed scatter of ``y`` over ``x``."""
    return df.select(x, y, F.col(f"{y}_imputed").alias("imputed"))
