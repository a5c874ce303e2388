"""Relating columns to each other and to a label (A11 correlation matrix, A12 screen,
A13 one-way ANOVA, A14 Tukey HSD, W5 compact letters, J4 letters on detail rows,
J6 pairwise level differences, A15 simple linear fit).

All factors are handled in one melted job: per (factor, level) sufficient statistics by a
partial aggregate, then a second aggregate per factor. HSD letters are computed on the
small per-level table with windows (a sweep), not by pairing levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.functions import exprs as X
from tabreg.operators.order import small_side, with_group_rank
from tabreg.operators.profile import melt
from tabreg.session import cut_lineage


def corr_matrix(df: DataFrame, cols: Sequence[str], nulls: str = "complete") -> DataFrame:
    """Long form ``(var_x, var_y, r)`` of all pairs of ``cols`` from one pass.

    ``nulls="complete"`` uses pairwise-complete rows; ``nulls="propagate"`` gives NULL for
    any pair touching a column with a missing value (as a plain ``cor`` does). The
    pass builds the pairwise-complete moment matrix with a few matrix products per task,
    so p columns cost p^2 numbers, not p^2 aggregate expressions.
    """
    from tabreg.operators.matrix import corr_from_moments, pairwise_moments
    cols = list(cols)
    r = corr_from_moments(pairwise_moments(df, cols))
    r = r.withColumn("r", F.when(F.col("var_x") == F.col("var_y"), F.lit(1.0)).otherwise(F.col("r")))
    if nulls == "propagate":
        counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
        complete = [c for c in cols if counts[c] == counts["_n"]]
        r = r.withColumn("r", F.when(F.col("var_x").isin(complete) & F.col("var_y").isin(complete), F.col("r")))
    return r.select("var_x", "var_y", "r")


def corr_screen(df: DataFrame, cols: Sequence[str], label: str, threshold: float = 0.5) -> DataFrame:
    """``(variable, r)`` for columns whose |corr with label| >= threshold, largest
    r first. One aggregate."""
    others = [c for c in cols if c != label]
    wide = df.agg(*[X.safe_corr(c, label).alias(c) for c in others])
    long = wide.unpivot([], others, "variable", "r")
    return long.where(F.abs("r") >= threshold).orderBy(F.desc("r"))


def level_stats(df: DataFrame, label: str, factors: Sequence[str]) -> DataFrame:
    """Per (variable, level): n, mean and sample variance of the label; one melted
    partial aggregate over all factors."""
    m = melt(df.where(F.col(label).isNotNull()), factors, "string", keep=[label])
    m = m.where(F.col("value").isNotNull())
    return m.groupBy("variable", F.col("value").alias("level")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("mean"),
        F.coalesce(F.var_samp(F.col(label).cast("double")), F.lit(0.0)).alias("var"))


def anova_oneway(df: DataFrame, label: str, factors: Sequence[str],
                 with_p: bool = False) -> DataFrame:
    """One-way ANOVA of ``label`` on each factor:
    ``(variable, k, n, df_between, df_within, ss_between, ss_within, ms_between,
    ms_within, f)`` and optionally ``p`` (F upper tail, a pandas UDF on the k-row table)."""
    return anova_from_levels(level_stats(df, label, factors), with_p)


def anova_from_levels(ls: DataFrame, with_p: bool = False) -> DataFrame:
    """The ANOVA table from per-level ``(variable, level, n, mean, var)`` statistics."""
    g = ls.groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_grand"))
    j = ls.join(g, "variable")
    out = j.groupBy("variable", "k", F.col("n_total").alias("n_all")).agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_grand"), 2)).alias("ss_between"),
        F.sum((F.col("n") - 1) * F.col("var")).alias("ss_within"))
    out = (out.withColumnRenamed("n_all", "n")
              .withColumn("df_between", (F.col("k") - 1).cast("long"))
              .withColumn("df_within", (F.col("n") - F.col("k")).cast("long"))
              .withColumn("ms_between", F.try_divide(F.col("ss_between"), F.col("df_between")))
              .withColumn("ms_within", F.try_divide(F.col("ss_within"), F.col("df_within")))
              .withColumn("f", F.try_divide(F.col("ms_between"), F.col("ms_within")))
              .select("variable", F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"),
                      "df_between", "df_within", "ss_between", "ss_within", "ms_between", "ms_within", "f"))
    if with_p:
        out = out.withColumn("p", _f_sf_udf(F.col("f"), F.col("df_between").cast("double"),
                                            F.col("df_within").cast("double")))
    return out


@F.pandas_udf(T.DoubleType())
def _f_sf_udf(f, d1, d2):
    import pandas as pd
    from tabreg.functions.stats import f_sf
    return pd.Series([f_sf(a, b, c) if pd.notna(a) and c > 0 else None for a, b, c in zip(f, d1, d2)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def _qtukey_udf(p, k, dfw):
    import pandas as pd
    from tabreg.functions.stats import qtukey
    return pd.Series([qtukey(float(a), int(b), float(c)) if b >= 2 and c > 0 else None
                      for a, b, c in zip(p, k, dfw)], dtype="float64")


def _with_reach(df: DataFrame, label: str, factors: Sequence[str], alpha: float, q: float | None) -> DataFrame:
    """``(variable, level, n, mean, var, hsd, position, reach)``: positions by mean (desc), then level
    name, and the number of levels whose mean is at least the level's mean less HSD."""
    # one pass over the rows; everything after works on this small per-level table,
    # materialised once so the windows and joins below do not re-read the data
    ls = cut_lineage(level_stats(df, label, factors))
    av = anova_from_levels(ls)
    hm = ls.groupBy("variable").agg((F.count(F.lit(1)) / F.sum(1.0 / F.col("n"))).alias("n_h"))
    av = av.join(hm, "variable")
    qcol = F.lit(float(q)) if q is not None else _qtukey_udf(
        F.lit(1.0 - alpha), F.col("k").cast("double"), F.col("df_within").cast("double"))
    av = av.withColumn("hsd", qcol * F.sqrt(F.col("ms_within") / F.col("n_h"))).select("variable", "hsd")
    lv = ls.join(av, "variable")
    # position by mean (desc), then level name: the distributed exact rank, so not even a
    # factor with very many levels is ordered in one task
    lv = with_group_rank(lv, ["variable"], [F.col("mean").desc(), F.col("level")], rank_col="position")
    # reach_i = #{levels j: mean_j >= mean_i - HSD}. Merge the means (kind 0) with the probe
    # values mean_i - HSD (kind 1) in one order (value desc, means first on ties); a probe's
    # rank there counts the means before it plus the probes before it, and the probes come
    # in position order, so reach = rank - position.
    ev = (lv.select("variable", F.col("mean").alias("v"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("pos"))
            .unionByName(lv.select("variable", (F.col("mean") - F.col("hsd")).alias("v"), F.lit(1).alias("kind"),
                                   F.col("position").alias("pos"))))
    ev = with_group_rank(ev, ["variable"], [F.col("v").desc(), F.col("kind"), F.col("pos")], rank_col="_r")
    rc = ev.where(F.col("kind") == 1).select("variable", F.col("pos").alias("position"),
                                              (F.col("_r") - F.col("pos")).alias("reach"))
    return lv.join(rc, ["variable", "position"])


def _count_before(levels: DataFrame, events: DataFrame) -> DataFrame:
    """``(variable, position, _cnt)``: for every level position how many events (kind 0, at place
    ``p``) sort at or before it."""
    pts = levels.select("variable", F.col("position").alias("p"), F.lit(1).alias("kind"))
    r = with_group_rank(events.unionByName(pts), ["variable"], [F.col("p"), F.col("kind")], rank_col="_r")
    return r.where(F.col("kind") == 1).select("variable", F.col("p").alias("position"), (F.col("_r") - F.col("p")).alias("_cnt"))


def hsd_groups(df: DataFrame, label: str, factors: Sequence[str], alpha: float = 0.05,
               q: float | None = None) -> DataFrame:
    """A14 + W5: Tukey HSD compact letters per factor level.

    HSD = q * sqrt(MS_within / n_h), n_h = harmonic mean of the level sizes, q the
    studentized-range quantile at ``1 - alpha`` for (k, df_within) -- or the given ``q``.
    Levels sorted by mean (desc) share a letter when their means differ by at most HSD.
    Returns ``(variable, level, n, mean, position, hsd, groups)``.

    The letters come from exact ranks over the per-level table (no window, no pairs):
    reach_i = number of levels with mean >= mean_i - HSD (ranks in a merged, sorted stream
    of level means and probe values); an interval [i, reach_i] gets a letter when it reaches
    further than every earlier one; a level's label is the run of letters whose intervals
    cover it (interval starts and ends both increase, so counts of starts and ends before
    a position give the run).
    """
    lv = _with_reach(df, label, factors, alpha, q)
    # reach never decreases along the positions, so interval [i, reach_i] reaches further than
    # every earlier one exactly when reach_i > reach_(i-1): a lag by an equi-join
    prev = lv.select("variable", (F.col("position") + 1).alias("position"), F.col("reach").alias("_prev"))
    lv = cut_lineage(lv.join(prev, ["variable", "position"], "left")
                       .withColumn("_kept", F.col("reach") > F.coalesce(F.col("_prev"), F.lit(0))).drop("_prev"))
    # last letter of j = number of kept intervals starting at or before j
    starts = lv.where("_kept").select("variable", F.col("position").alias("p"), F.lit(0).alias("kind"))
    # first letter of j = 1 + number of kept intervals ending before j (end + 1 <= j)
    ends = lv.where("_kept").select("variable", (F.col("reach") + 1).alias("p"), F.lit(0).alias("kind"))
    lv = (lv.join(_count_before(lv, starts).withColumnRenamed("_cnt", "_last"), ["variable", "position"])
            .join(_count_before(lv, ends).withColumnRenamed("_cnt", "_closed"), ["variable", "position"]))
    first = F.col("_closed") + 1
    letters = F.transform(F.sequence(first.cast("int"), F.col("_last").cast("int")),
                          lambda i: F.when(i <= 26, F.chr(i + 96)).when(i <= 52, F.chr(i + 38))
                                     .otherwise(F.concat(F.lit("["), i.cast("string"), F.lit("]"))))
    return lv.select("variable", "level", F.col("n").cast("long").alias("n"), "mean",
                     F.col("position").cast("int").alias("position"), "hsd",
                     F.array_join(letters, "").alias("groups"))


def label_rows(df: DataFrame, groups: DataFrame, factor: str) -> DataFrame:
    """Put each level's letters on the detail rows of one factor. The letters table has
    one row per level; it is broadcast when its counted rows allow it."""
    g = groups.where(F.col("variable") == factor).select(F.col("level").alias(factor), "groups")
    return df.join(small_side(cut_lineage(g)), factor, "left")


def hsd_intervals(df: DataFrame, label: str, factors: Sequence[str], q: float | None = None,
                  alpha: float = 0.05) -> DataFrame:
    """J6 in one row a level: levels stand in order of their means, so those that differ from a level
    by more than HSD are the first ``n_above`` positions and the positions from ``first_below`` on.

    ``(variable, level, n, mean, hsd, position, n_above, first_below, n_below)``; ``first_below`` is
    NULL where no lower level differs. All k(k-1)/2 verdicts of a factor from k rows;
    ``hsd_pairs`` writes them out on demand."""
    lv = cut_lineage(_with_reach(df, label, factors, alpha, q))
    k = lv.groupBy("variable").agg(F.count(F.lit(1)).alias("_k"))
    # level j above differs from level i when j's reach ends before i
    ends = lv.select("variable", (F.col("reach") + 1).alias("p"), F.lit(0).alias("kind"))
    lv = lv.join(_count_before(lv, ends).withColumnRenamed("_cnt", "n_above"), ["variable", "position"]).join(k, "variable")
    below = F.col("_k") - F.col("reach")
    return lv.select("variable", "level", F.col("n").cast("long").alias("n"), "mean", "hsd",
                     F.col("position").cast("int").alias("position"), F.col("n_above").cast("long").alias("n_above"),
                     F.when(below > 0, F.col("reach") + 1).cast("int").alias("first_below"), below.cast("long").alias("n_below"))


def hsd_pairs(df: DataFrame, label: str, factors: Sequence[str], q: float | None = None,
              alpha: float = 0.05) -> DataFrame:
    """J6 on demand: pairwise differences of level means per factor with the HSD verdict, k(k-1)/2
    rows a factor (``hsd_intervals`` holds the same verdicts in k rows).

    This pairs *levels* (the per-level table, k rows per factor), never data rows.
    ``(variable, level_a, level_b, diff, hsd, significant)`` with mean_a > mean_b, or
    equal means ordered by level name."""
    g = hsd_groups(df, label, factors, alpha=alpha, q=q).select("variable", "level", "mean", "hsd", "position")
    a = g.select("variable", F.col("level").alias("level_a"), F.col("mean").alias("mean_a"),
                 F.col("position").alias("pa"), "hsd")
    b = g.select("variable", F.col("level").alias("level_b"), F.col("mean").alias("mean_b"),
                 F.col("position").alias("pb"))
    j = a.join(b, "variable").where(F.col("pa") < F.col("pb"))
    return j.select("variable", "level_a", "level_b", (F.col("mean_a") - F.col("mean_b")).alias("diff"),
                    "hsd", ((F.col("mean_a") - F.col("mean_b")) > F.col("hsd")).alias("significant"))


def simple_fit(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.95) -> DataFrame:
    """Least-squares line of ``y`` on each ``x`` (pairwise complete rows):
    ``(variable, n, slope, intercept, r2, sxx, mean_x, sigma)`` from ``regr_*`` aggregates
    in one pass. ``fit_band`` gives the confidence band."""
    aggs = []
    for x in xs:
        yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
        aggs += [F.regr_count(yc, xc).alias(f"{x}|n"), F.regr_slope(yc, xc).alias(f"{x}|slope"),
                 F.regr_intercept(yc, xc).alias(f"{x}|intercept"), F.regr_r2(yc, xc).alias(f"{x}|r2"),
                 F.regr_sxx(yc, xc).alias(f"{x}|sxx"), F.regr_syy(yc, xc).alias(f"{x}|syy"),
                 F.regr_avgx(yc, xc).alias(f"{x}|mean_x")]
    wide = df.agg(*aggs)
    recs = []
    for x in xs:
        c = lambda s: F.col(f"`{x}|{s}`")
        sse = c("syy") * (1 - c("r2"))
        recs.append(F.struct(F.lit(x).alias("variable"), c("n").cast("long").alias("n"), c("slope").alias("slope"),
                             c("intercept").alias("intercept"), c("r2").alias("r2"), c("sxx").alias("sxx"),
                             c("mean_x").alias("mean_x"),
                             F.sqrt(F.try_divide(sse, c("n") - 2)).alias("sigma")))
    return wide.select(F.explode(F.array(*recs)).alias("_s")).select("_s.*")


@F.pandas_udf(T.DoubleType())
def _t_ppf_udf(p, dof):
    import pandas as pd
    from tabreg.functions.stats import t_ppf
    return pd.Series([t_ppf(float(a), float(b)) if b > 0 else None for a, b in zip(p, dof)], dtype="float64")


def fit_band(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.95, points: int = 80) -> DataFrame:
    """The line of ``simple_fit`` with its confidence band at ``points`` evenly spaced values from
    the smallest to the largest x: ``(variable, x, fit, lower, upper)``, the band
    ``t(level, n - 2) * sigma * sqrt(1/n + (x - mean_x)^2 / sxx)``. NULL bounds where n < 3 or x is
    constant."""
    fits = simple_fit(df, y, xs)
    ends = df.where(F.col(y).isNotNull()).agg(*[F.struct(F.min(F.col(x).cast("double")).alias("lo"),
                                                         F.max(F.col(x).cast("double")).alias("hi")).alias(x) for x in xs])
    ends = ends.select(F.explode(F.array(*[F.struct(F.lit(x).alias("variable"), F.col(f"`{x}`.lo").alias("lo"),
                                                    F.col(f"`{x}`.hi").alias("hi")) for x in xs])).alias("_e")).select("_e.*")
    at = fits.join(ends, "variable").withColumn("_t", _t_ppf_udf(F.lit(0.5 + level / 2), (F.col("n") - 2).cast("double")))
    at = at.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("_i") / F.lit(float(max(1, points - 1)))
    at = at.withColumn("x", x).withColumn("fit", F.col("intercept") + F.col("slope") * F.col("x"))
    half = F.col("_t") * F.col("sigma") * F.sqrt(1 / F.col("n") + F.try_divide(F.pow(F.col("x") - F.col("mean_x"), 2), F.col("sxx")))
    return at.select("variable", "x", "fit", (F.col("fit") - half).alias("lower"), (F.col("fit") + half).alias("upper"))
