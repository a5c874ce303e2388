"""Exact type-7 quantiles without sorting the values.

Two scans of the input, whatever the number of columns, groups or positions:

1. one aggregate gives every group's count, extremes and, for every inner position, a bracket
   of two values from a mergeable sketch whose rank error is bounded by 1 / ``ACCURACY``;
2. every value is compared with its group's brackets. Values below a bracket are only counted,
   values inside are counted by distinct value, so equal values are one row and ties cost nothing.

What is left are about 4 / ``ACCURACY`` of the distinct values a position. A bracket that still
holds more than ``WINDOW_ROWS`` of them is cut at 256 of its own quantiles and only the pieces
with the wanted ranks stay, until it is small; then a window over at most ``WINDOW_ROWS`` rows
adds the counts up to the rank. The counts prove the brackets: where a rank lies outside of its
bracket, its group is counted again between its extremes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.operators.order import null_safe, small_side
from tabreg.session import cut_lineage

ACCURACY = 1000           # of the sketch: rank error at most n / ACCURACY
WINDOW_ROWS = 100_000     # distinct values of a bracket that one window task adds up
PIECES = 256


def _sketch(vals: DataFrame, by: list[str], inner: list[float]) -> DataFrame:
    """One row per group: ``_n, _min, _max`` and the brackets ``_lo, _hi`` of the inner positions."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    if inner:
        near = [p for x in inner for p in (max(x - 2 / ACCURACY, 0.0), min(x + 2 / ACCURACY, 1.0))]
        aggs.append(F.percentile_approx("_v", near, ACCURACY).alias("_q"))
    out = vals.groupBy(*by).agg(*aggs)
    if not inner:
        return out
    # in a group of fewer rows than the sketch resolves, or next to an end, the bracket reaches the end
    h = lambda x: (F.col("_n") - 1) * F.lit(x) + 1
    few = F.col("_n") <= 2 * ACCURACY
    lo = [F.when(few | (F.floor(h(x)) <= 1), F.col("_min")).otherwise(F.col("_q")[2 * i]) for i, x in enumerate(inner)]
    hi = [F.when(few | (F.ceil(h(x)) >= F.col("_n")), F.col("_max")).otherwise(F.col("_q")[2 * i + 1])
          for i, x in enumerate(inner)]
    return out.withColumns({"_lo": F.sort_array(F.array(*lo)), "_hi": F.sort_array(F.array(*hi))}).drop("_q")


def _bracket_counts(vals: DataFrame, groups: DataFrame, by: list[str], inner: list[float]) -> DataFrame:
    """``(group..., _i, _v, _c)``: per position the rows of every value in its bracket, and one row
    with a NULL value for the rows below. ``_lo`` and ``_hi`` ascend with the position."""
    brackets = groups.select(*by, "_lo", "_hi")
    if by:
        near = null_safe(vals, small_side(brackets), by)
    else:                                                       # one row: a scalar, not a join
        near = vals.withColumn("_b", brackets.select(F.struct("_lo", "_hi")).scalar()).select("_v", "_b.*")
    # the brackets of the positions are in order: those that begin at or below a value come first, and of them those that
    # end before it, so two numbers a value say which hold it and which lie above; rows in no bracket meet in few groups
    v, k, none = F.col("_v"), len(inner), F.lit(None).cast("double")
    begun = sum((F.col("_lo")[i] <= v).cast("int") for i in range(k))
    over = sum((F.col("_hi")[i] < v).cast("int") for i in range(k))
    placed = near.select(*by, "_v", begun.alias("_begun"), over.alias("_over"))
    held = F.col("_over") < F.col("_begun")
    cells = placed.select(*by, "_begun", F.when(held, F.col("_over")).alias("_over"), F.when(held, v).alias("_v")).groupBy(
        *by, "_begun", "_over", "_v").agg(F.count(F.lit(1)).alias("_c"))
    at = lambda first, last, value: F.transform(F.sequence(first, last), lambda i: F.struct(i.alias("_i"), value.alias("_v")))
    empty = F.array().cast("array<struct<_i:int,_v:double>>")
    hits = F.concat(F.when(F.col("_over").isNotNull(), at(F.col("_over"), F.col("_begun") - 1, v)).otherwise(empty),
                    F.when(F.col("_begun") < k, at(F.col("_begun"), F.lit(k - 1), none)).otherwise(empty))
    hit = cells.select(*by, "_c", F.explode(hits).alias("_h"))
    return hit.select(*by, "_h.*", "_c").groupBy(*by, "_i", "_v").agg(F.sum("_c").alias("_c"))


def _narrowed(counts: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    """Cut the brackets that hold too many distinct values until none does."""
    key = [*by, "_i"]
    while True:
        sizes = counts.where(F.col("_v").isNotNull()).groupBy(*key).agg(
            F.count(F.lit(1)).alias("_m"),
            F.percentile_approx("_v", [k / PIECES for k in range(1, PIECES)], 4 * PIECES).alias("_cuts"))
        wide = cut_lineage(sizes.where(F.col("_m") > WINDOW_ROWS).drop("_m"))
        if wide.isEmpty():
            return counts
        # piece of a value: number of cuts below it; the rows below the bracket are piece -1
        held = null_safe(counts, small_side(wide), key, "left")
        piece = F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
        held = held.withColumn("_piece", F.when(F.col("_cuts").isNotNull(), piece))
        totals = held.where(F.col("_piece").isNotNull()).groupBy(*key, "_piece").agg(F.sum("_c").alias("_c"))
        w = Window.partitionBy(*key).orderBy("_piece")          # at most PIECES + 1 rows
        totals = totals.withColumn("_to", F.sum("_c").over(w)).withColumn("_from", F.col("_to") - F.col("_c"))
        placed = null_safe(totals, ranks, key)
        wanted = ((F.col("_r0") > F.col("_from")) & (F.col("_r0") <= F.col("_to"))) | (
            (F.col("_r1") > F.col("_from")) & (F.col("_r1") <= F.col("_to")))
        placed = cut_lineage(placed.select(*key, "_piece", "_c", wanted.alias("_wanted")))
        first = placed.groupBy(*key).agg(F.min(F.when(F.col("_wanted"), F.col("_piece"))).alias("_first"))
        marks = cut_lineage(null_safe(placed, first, key))
        below = (marks.where(F.col("_piece") < F.col("_first")).groupBy(*key).agg(F.sum("_c").alias("_c"))
                 .select(*key, F.lit(None).cast("double").alias("_v"), "_c"))
        kept = null_safe(held.where(F.col("_piece") >= 0),
                         small_side(marks.where(F.col("_piece") >= F.col("_first")).select(*key, "_piece", "_wanted")),
                         [*key, "_piece"]).where("_wanted")
        # a piece between the two wanted ranks' pieces cannot exist: the ranks are neighbours
        counts = cut_lineage(held.where(F.col("_cuts").isNull()).select(*key, "_v", "_c")
                             .unionByName(kept.select(*key, "_v", "_c")).unionByName(below))


def _proven(counts: DataFrame, vals: DataFrame, groups: DataFrame, ranks: DataFrame, by: list[str],
            inner: list[float]) -> DataFrame:
    """``counts`` with the groups whose ranks are not inside their brackets counted anew."""
    key = [*by, "_i"]
    held = counts.groupBy(*key).agg(F.sum(F.when(F.col("_v").isNull(), F.col("_c"))).alias("_below"), F.sum("_c").alias("_all"))
    inside = (F.col("_r0") > F.coalesce("_below", F.lit(0))) & (F.col("_r1") <= F.coalesce("_all", F.lit(0)))
    wrong = cut_lineage(null_safe(ranks, held, key, "left").where(~inside).select(*key))
    if wrong.isEmpty():
        return counts
    if not by:
        bad, good = groups, counts.limit(0)
    else:
        bad = null_safe(groups, wrong.select(*by).distinct(), by, "left_semi")
        good = null_safe(counts, wrong.select(*by).distinct(), by, "left_anti")
    whole = cut_lineage(bad.withColumns({"_lo": F.array(*[F.col("_min")] * len(inner)),
                                         "_hi": F.array(*[F.col("_max")] * len(inner))}))
    return cut_lineage(good.unionByName(_bracket_counts(vals, whole, by, inner)))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Type-7 quantiles of ``value_col`` per group, long form ``(group..., prob, quantile)``.

    NULL values are ignored and a group without a value gives no row; a NULL group is a group of
    its own; NaN counts as the largest value. ``df`` is read twice and must give the same rows
    both times."""
    by, probs = list(group_cols), [float(p) for p in probs]
    inner = sorted({p for p in probs if 0.0 < p < 1.0})
    vals = df.where(F.col(value_col).isNotNull()).select(*by, F.col(value_col).cast("double").alias("_v"))
    groups = cut_lineage(_sketch(vals, by, inner).where(F.col("_n") > 0))
    ends = [F.struct(F.lit(p).alias("prob"), F.col("_min" if p <= 0 else "_max").alias("quantile"))
            for p in dict.fromkeys(probs) if not 0.0 < p < 1.0]
    out = groups.select(*by, F.explode(F.array(*ends)).alias("_e")).select(*by, "_e.*") if ends else None
    if not inner:
        return out
    h = (F.col("_n") - 1) * F.col("prob") + 1
    ranks = groups.select(*by, "_n", F.posexplode(F.array(*[F.lit(p) for p in inner])).alias("_i", "prob")).select(
        *by, "_i", "prob", h.alias("_h"), F.floor(h).alias("_r0"), F.ceil(h).alias("_r1"))
    key = [*by, "_i"]
    counts = cut_lineage(_bracket_counts(vals, groups, by, inner))
    counts = _narrowed(_proven(counts, vals, groups, ranks, by, inner), ranks, by)
    w = Window.partitionBy(*key).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = null_safe(counts.withColumn("_to", F.sum("_c").over(w)), small_side(ranks), key)
    at = lambda r: F.min(F.when(F.col("_to") >= F.col(r), F.col("_v")))
    lo, hi = F.col("_q0"), F.col("_q1")
    between = (found.groupBy(*key, "prob", "_h", "_r0").agg(at("_r0").alias("_q0"), at("_r1").alias("_q1"))
               .select(*by, "prob", F.when(lo == hi, lo).otherwise(lo + (F.col("_h") - F.col("_r0")) * (hi - lo)).alias("quantile")))
    return between if out is None else out.unionByName(between)


def quantiles_wide(df: DataFrame, value_col: str, probs: Sequence[float], names: Sequence[str],
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles pivoted to one column per probability (small result)."""
    long = exact_quantiles(df, value_col, probs, group_cols)
    aggs = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(nm) for p, nm in zip(probs, names)]
    return long.groupBy(*group_cols).agg(*aggs)


def quantile_table(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                   method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Long ``(group..., prob, quantile)``: ``method="exact"`` is the type-7 order statistic;
    ``"approx"`` is Spark's mergeable sketch alone (``percentile_approx``, relative rank error
    1/accuracy, one scan, bounded memory per group)."""
    if method == "exact":
        return exact_quantiles(df, value_col, probs, group_cols)
    group_cols = list(group_cols)
    arr = F.percentile_approx(F.col(value_col).cast("double"), [float(p) for p in probs], accuracy)
    agg = df.groupBy(*group_cols).agg(arr.alias("_qa"))
    zipped = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("_qa").alias("quantile"))
    return agg.select(*group_cols, F.explode(zipped).alias("_z")).select(*group_cols, "_z.prob", "_z.quantile")

