"""Exact ranks without a single-partition window.

``row_number().over(Window.partitionBy(g).orderBy(x))`` puts a whole group into one task;
with a hot group (a third of all rows) that task holds a third of the data. Here a group is
instead split over many tasks by a range-partitioned sort on ``(group, order, tiebreak)``,
each row gets its position inside its task, and a tiny table of per-task, per-group counts
turns that into the position inside the group. Exact, one shuffle for the sort, one Parquet
materialisation of the (narrow) sorted rows in the shared checkpoint folder, plus a join
against a table of at most ``#tasks + #groups`` rows, broadcast when its count allows. Callers project to the few columns
they need first. Where the order is a hash (splits, folds, donor slots), ``with_hash_rank`` needs
no range sort and no copy of the rows. Quantiles are in ``quantiles``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.session import cut_lineage


BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame) -> DataFrame:
    """``df`` hinted for a broadcast if it has at most ``BROADCAST_ROWS`` (narrow) rows, else as
    it is: a small table joined to data rows then costs no shuffle of the rows, and one on a
    key with few values does not gather a whole key in one task."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` where NULL equals NULL (a NULL group is a group); ``cols`` stay once."""
    if not cols:
        raise ValueError("no join columns")
    r = right.withColumnsRenamed({c: f"_ns_{c}" for c in cols})
    cond = None
    for c in cols:
        eq = F.col(c).eqNullSafe(F.col(f"_ns_{c}"))
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, how).drop(*[f"_ns_{c}" for c in cols])


def _rank_core(df: DataFrame, group_cols: list[str], order_exprs: list[Column], rank_col: str,
               num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    sort_keys = [F.col(g) for g in group_cols] + order_exprs
    # The range partition count is the session's shuffle partition count (sized for the
    # cluster) and AQE may merge neighbouring ranges; either way the task ids and positions
    # below are taken from the partitions as finally read. The tagged rows are written once
    # to the shared checkpoint folder, so the per-task positions and the offsets computed
    # from them come from one and the same run (an input that arrives from a shuffle has no
    # fixed row order, and a re-run could cut other range bounds), and a lost executor
    # cannot make them disagree.
    ranged = (df.repartitionByRange(int(num_partitions), *sort_keys) if num_partitions
              else df.repartitionByRange(*sort_keys))
    tagged = cut_lineage(ranged.sortWithinPartitions(*sort_keys)
                               .withColumn("_tr_pid", F.spark_partition_id())
                               .withColumn("_tr_mid", F.monotonically_increasing_id()))
    stats = (tagged.groupBy("_tr_pid", *group_cols)
                   .agg(F.min("_tr_mid").alias("_tr_first"), F.count(F.lit(1)).alias("_tr_n")))
    w_before = (Window.partitionBy(*[F.col(g) for g in group_cols]).orderBy("_tr_pid")
                .rowsBetween(Window.unboundedPreceding, -1))
    stats = cut_lineage(stats.withColumn("_tr_off", F.coalesce(F.sum("_tr_n").over(w_before), F.lit(0))))
    ranked = (tagged.join(small_side(stats.drop("_tr_n")), on=["_tr_pid", *group_cols], how="inner")
                    .withColumn(rank_col, F.col("_tr_mid") - F.col("_tr_first") + F.col("_tr_off") + 1)
                    .drop("_tr_pid", "_tr_mid", "_tr_first", "_tr_off"))
    return ranked, stats


def with_group_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                    rank_col: str = "rank", size_col: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row inside its group, by ``order_cols`` ascending.

    ``order_cols`` must be deterministic and give a total order inside a group (end with a
    unique key); ties are otherwise numbered in an arbitrary but fixed order.
    ``size_col`` adds the group size (from the small count table, not a window over rows).
    """
    group_cols = list(group_cols)
    order_exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranked, stats = _rank_core(df, group_cols, order_exprs, rank_col, num_partitions)
    if size_col:
        sizes = stats.groupBy(*group_cols).agg(F.sum("_tr_n").alias(size_col))
        if group_cols:
            ranked = ranked.join(small_side(sizes), on=group_cols, how="inner")
        else:  # one global size: a scalar subquery, not a join
            ranked = ranked.withColumn(size_col, sizes.select(size_col).scalar())
    return ranked


RANK_ROWS = 200_000      # rows of a (group, hash prefix) that one window task numbers


def with_hash_rank(df: DataFrame, group_cols: Sequence[str], order_hash: Column, ties: Sequence[str | Column],
                   rank_col: str = "rank", size_col: str | None = None) -> DataFrame:
    """Like ``with_group_rank`` for an order that starts with a hex hash (``order_hash``, then
    ``ties``): hash prefixes are even by construction, so nothing is sorted over ranges.

    Counts per (group, prefix) give every prefix its first position; the rows are exchanged once,
    on (group, prefix), and numbered inside. The prefix is as long as keeps a (group, prefix) below
    ``RANK_ROWS`` rows. A NULL group is a group; ``df`` is read twice and must give the same rows
    both times."""
    group_cols = list(group_cols)
    tagged = df.withColumn("_hr_h", order_hash)
    digits = 3
    while True:
        prefix = F.substring("_hr_h", 1, digits)
        counts = cut_lineage(tagged.groupBy(*group_cols, prefix.alias("_hr_p")).agg(F.count(F.lit(1)).alias("_hr_n")))
        most = counts.agg(F.max("_hr_n")).first()[0] or 0
        if most <= RANK_ROWS or digits >= 32:
            break
        digits = min(32, digits + max(1, math.ceil(math.log(most / RANK_ROWS, 16))))
    w = Window.partitionBy(*group_cols)
    before = F.coalesce(F.sum("_hr_n").over(w.orderBy("_hr_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_hr_off", before)
    if size_col:
        offsets = offsets.withColumn(size_col, F.sum("_hr_n").over(w))
    offsets = cut_lineage(offsets.drop("_hr_n"))
    order = [F.col("_hr_h"), *[F.col(c) if isinstance(c, str) else c for c in ties]]
    inside = F.row_number().over(Window.partitionBy(*group_cols, "_hr_p").orderBy(*order))
    ranked = tagged.withColumn("_hr_p", prefix).withColumn("_hr_i", inside)
    return (null_safe(ranked, small_side(offsets), [*group_cols, "_hr_p"])
            .withColumn(rank_col, F.col("_hr_i") + F.col("_hr_off")).drop("_hr_h", "_hr_p", "_hr_i", "_hr_off"))


# -- top-k without a single-task window ----------------------------------------------------

def _salt(df: DataFrame, buckets: int):
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(int(buckets)))


def top_k_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
               salt_buckets: int = 64) -> DataFrame:
    """The first ``k`` rows of every group under a total ``order`` (``row_number() <= k``).

    Two stages: inside each (group, salt) bucket -- 1/``salt_buckets`` of a group -- keep the
    first k; the global first k are among those candidates, and the final window sees at
    most ``salt_buckets * k`` rows per group. Exact; a huge group never lands in one task."""
    by = list(by)
    salted = df.withColumn("_tk_s", _salt(df, salt_buckets))
    w1 = Window.partitionBy(*[F.col(b) for b in by], F.col("_tk_s")).orderBy(*order)
    cand = salted.withColumn("_tk_r", F.row_number().over(w1)).where(F.col("_tk_r") <= k).drop("_tk_r", "_tk_s")
    w2 = Window.partitionBy(*[F.col(b) for b in by]).orderBy(*order) if by else Window.orderBy(*order)
    return cand.withColumn("_tk_r", F.row_number().over(w2)).where(F.col("_tk_r") <= k).drop("_tk_r")


def top_n_with_ties(df: DataFrame, value: str, n: int, by: Sequence[str] = (), salt_buckets: int = 64) -> DataFrame:
    """Rows whose ``rank()`` by ``value`` (descending) is at most ``n`` in their group, ties
    kept. ``rank <= n`` holds exactly when the value reaches the group's n-th largest value;
    that threshold comes from the salted top-n candidates, then one filter keeps the rows."""
    by = list(by)
    # salt on the whole row: rows sharing a value (a long tail of equal counts) still
    # spread over the buckets
    nth = top_k_rows(df, by, [F.col(value).desc()], n, salt_buckets).select(*by, value)
    w = Window.partitionBy(*[F.col(b) for b in by]) if by else Window.partitionBy()
    thr = (nth.withColumn("_tn_c", F.count(F.lit(1)).over(w))
              .groupBy(*by).agg(F.min(value).alias("_tn_v"), F.max("_tn_c").alias("_tn_c")))
    # fewer than n rows in a group: every row is kept
    thr = thr.withColumn("_tn_v", F.when(F.col("_tn_c") >= n, F.col("_tn_v")))
    if by:
        j = df.join(thr, by, "left")
    else:
        j = df.withColumn("_tn_v", thr.select("_tn_v").scalar())
    return j.where(F.col("_tn_v").isNull() | (F.col(value) >= F.col("_tn_v"))).drop("_tn_v", "_tn_c")
