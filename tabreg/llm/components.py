"""Connected components of an edge table, and grouped reading of sorted partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node reachable, for the nodes of ``edges`` (long
    columns ``a, b``; order, repeats and loops do not matter).

    Alternates the large star (a node's larger neighbours go to its smallest neighbour) and the
    small star (its smaller neighbours do) until the edges stay the same. Every round is written
    to the shared folder; the minima are joined from a table of their own, so a hub's rows can
    be split over tasks.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    e = cut_lineage(edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct())
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (now["n"], now["s"]) == state or not now["n"]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        state = now["n"], now["s"]
        sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = cut_lineage(sym.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")))
        large = cut_lineage(sym.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .distinct())
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` (integer) columns, from batches in that order."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(keys)])
        starts = np.concatenate([[0], np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        for lo, hi in zip(starts[:-1], starts[1:]):
            key = tuple(cols[:, lo])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each of n places over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new
