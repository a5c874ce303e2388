"""Boosting paths of many settings and folds, grown side by side (ML9, X3, X5).

Gradient boosting with squared loss as MLlib's ``GBTRegressor`` does it: features cut into at most
``maxBins`` bins, trees grown level by level from sums per (node, feature, bin), rows drawn anew for every
tree. One job per tree level serves ALL settings and folds, where a fit per (setting, fold) needs jobs of
its own for every level of each of its trees.

* The rows lie in Spark as blocks, once for all folds: labels, folds, the bins by every fold's split candidates and
  the draws. A task adds up the histograms of its blocks (numpy), a shuffle adds them up by (setting, fold), the
  driver sees sums, never rows.
* Beside every block lies one of predictions, one for each setting, fold and row. Only these are written anew, once per
  tree; they hold the held-out rows too, so every iteration's loss comes with the next tree.
* Both lie on the executors' disks and pass through memory a block at a time.
  Settings whose predictions would exceed ``PREDICTED`` bytes together grow one after the other.

The draws are those of MLlib (``rand`` over the training rows in their stored order), and so are the split
candidates (from a sample of about 10,000 training rows where there are more) and the rounding of the gains:
the paths are those of a ``GBTRegressor`` fit on each fold's training rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 14            # rows of a block
PREDICTED = 4 << 30        # bytes of predictions that are held at once
SAMPLE = 10_000            # rows that give the split candidates, as in MLlib
REDUCE_BYTES = 8 << 20     # histograms a reducer adds up, where cores are left
BITS = 32                  # draws kept in one integer
MASKED = 5                 # tree levels whose nodes are compared one by one


def supports(est) -> bool:
    """Whether the estimator is plain squared-loss boosting: anything else needs MLlib's own fit."""
    return (isinstance(est, GBTRegressor) and est.getLossType() == "squared" and est.getFeatureSubsetStrategy() == "all"
            and est.getImpurity() == "variance" and est.getMinWeightFractionPerNode() == 0.0 and est.getMaxBins() <= 256
            and 1 <= est.getMaxDepth() <= 10 and not (est.isDefined("weightCol") and est.getWeightCol())
            and not (est.isDefined("validationIndicatorCol") and est.getValidationIndicatorCol()))


def thresholds(values: np.ndarray, n: float, max_bins: int) -> np.ndarray:
    """Split candidates of one feature: between all neighbours where the bins allow it, else about equal counts.
    Of the ``n`` rows expected in a sample, those not among its non-zero ``values`` count as zeros, as in MLlib."""
    v, c = np.unique(values[values != 0.0], return_counts=True)
    c, zeros = c.astype(float), n - c.sum()
    if len(v) == 0:
        return np.zeros(0)
    if zeros > np.finfo(float).eps * c.sum() * 100:
        at = np.searchsorted(v, 0.0)
        v, c = np.insert(v, at, 0.0), np.insert(c, at, zeros)
    mid = (v[:-1] + v[1:]) / 2.0
    if len(mid) < max_bins:
        return mid
    seen, stride, out = np.cumsum(c), n / max_bins, []
    target = stride
    for i in range(1, len(v)):              # about SAMPLE values at most
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


def _candidates(data: DataFrame, fold_col: str, sizes: Mapping, max_bins: int, seed: int) -> dict:
    """``{fold: [thresholds of each feature]}`` from the fold's training rows; of more than SAMPLE rows, from the
    sample that MLlib's fit draws (``RDD.sample`` with the fit's seed)."""
    spark, total, out = data.sparkSession, sum(sizes.values()), {}
    for f, held_out in sizes.items():
        n, required = total - held_out, max(max_bins * max_bins, SAMPLE)
        rows = data.where(F.col(fold_col) != f).select("features")
        if required < n:
            drawn = rows._jdf.toJavaRDD().sample(False, required / n, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
            rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
        x = np.array([r[0] for r in rows.select(vector_to_array("features")).collect()])          # about SAMPLE rows
        out[f] = [thresholds(x[:, j], required / n * n if required < n else float(n), max_bins) for j in range(x.shape[1])]
    return out


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray], held_out: bool) -> np.ndarray:
    """The bin of every value, by feature: the number of candidates below it. Neighbouring values can round to
    one candidate twice; a training value equal to it goes where a binary search meets it, as in MLlib."""
    bins = np.empty(x.shape[::-1], np.uint8)
    for j, c in enumerate(cuts):
        bins[j] = at = np.searchsorted(c, x[:, j], side="left")
        if not held_out and len(np.unique(c)) < len(c):
            same = np.append(c, np.nan)[at] == x[:, j]
            bins[j, same] = np.array([_met(c, v) for v in c])[at[same]]
    return bins


def _met(c: np.ndarray, value: float) -> int:
    low, high = 0, len(c) - 1
    while c[mid := (low + high) // 2] != value:
        low, high = (mid + 1, high) if c[mid] < value else (low, mid - 1)
    return mid


def _blocks(cuts: Mapping, n_bags: int):
    """Rows (fold, label, features, draws) of a partition to blocks for all folds. A fold's training rows take the
    partition's draws in order; a block holds the window of draws its folds are at."""
    folds = sorted(cuts)
    kinds = pa.schema([("fold", pa.binary()), ("y", pa.binary()), ("bins", pa.binary()), ("bags", pa.binary()), ("begin", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows, window, taken, start = [], 0, np.zeros((n_bags, 0), np.uint32), np.zeros(len(folds), np.int64), 0

        def packed(t: pa.Table) -> pa.RecordBatch:
            nonlocal window, taken, start
            fold, y = t["fold"].to_numpy().astype(np.int32), t["y"].to_numpy()
            x = t["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
            if not (np.isfinite(y).all() and np.isfinite(x).all()):
                raise ValueError("a label or feature is NaN or infinite")
            until = taken + np.array([np.sum(fold != f) for f in folds])
            if n_bags:
                new = np.stack([t[f"bag{i}"].to_numpy() for i in range(n_bags)]).astype(np.uint32)
                window, start = np.concatenate([window[:, taken.min() - start:], new], axis=1), int(taken.min())
            bins = np.empty((len(folds), x.shape[1], len(y)), np.uint8)
            for i, f in enumerate(folds):
                held_out = fold == f
                bins[i] = _binned(x, cuts[f], False)
                bins[i][:, held_out] = _binned(x[held_out], cuts[f], True)
            used = np.ascontiguousarray(window[:, :int(until.max()) - start])
            part = [fold.tobytes(), y.astype(float).tobytes(), bins.tobytes(), used.tobytes(), (taken - start).tobytes()]
            taken = until
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in part], schema=kinds)

        for b in batches:
            kept, rows = [*kept, b], rows + b.num_rows
            if rows >= BLOCK:
                t = pa.Table.from_batches(kept)
                for at in range(0, rows - BLOCK + 1, BLOCK):
                    yield packed(t.slice(at, BLOCK))
                kept, rows = t.slice(rows - rows % BLOCK).to_batches(), rows % BLOCK
        if rows:
            yield packed(pa.Table.from_batches(kept))

    return run


def _alone(rdd):
    """The RDD with every block pickled on its own, so that RDDs of blocks can be zipped as they are."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _training(data: DataFrame, fold_col: str, label: str, cuts: Mapping, trees: int, rate: float, seed: int):
    """All rows as an RDD of blocks ``(fold, y, bins[fold, feature, row], bags[32 trees, draw], first draw of each fold)``."""
    n_bags, draws, n_folds = -(-trees // BITS) if rate < 1 else 0, [], len(cuts)
    for i in range(n_bags):
        drawn = [F.when(F.rand(seed + m + 1) < rate, F.lit(1 << (m % BITS)).cast("long")).otherwise(F.lit(0).cast("long"))
                 for m in range(i * BITS, min(trees, (i + 1) * BITS))]
        draws.append(sum(drawn[1:], drawn[0]).alias(f"bag{i}"))
    rows = data.where(F.col(fold_col).isNotNull()).select(
        F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array("features").alias("x"), *draws)

    def block(r):
        y = np.frombuffer(r["y"])
        return (np.frombuffer(r["fold"], np.int32), y, np.frombuffer(r["bins"], np.uint8).reshape(n_folds, -1, len(y)),
                np.frombuffer(r["bags"], np.uint32).reshape(n_bags, len(r["bags"]) // (4 * max(n_bags, 1))), np.frombuffer(r["begin"], np.int64))

    return _alone(rows.mapInArrow(_blocks(cuts, n_bags), "fold binary, y binary, bins binary, bags binary, begin binary").rdd.map(block))


class _Tree:
    """A binary tree in heap order; ``feature`` is -1 at a leaf. A row goes left up to bin ``split``."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.split, self.value, self.impurity = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        self.open = [0]                     # nodes of the current level that may be split

    def depth(self) -> int:
        return int(self.feature.size).bit_length() - 1

    def ends(self, depth: int) -> np.ndarray:
        """The value of a row at every place ``codes`` gives at ``depth``: that of the leaf above, which all rows leave to the left."""
        node = np.zeros(2 ** depth, np.int64)
        for d in range(depth):
            node = np.where(self.feature[node] >= 0, 2 * node + 1 + (np.arange(2 ** depth) >> (depth - 1 - d) & 1), node)
        return self.value[node]

    def codes(self, bins: np.ndarray, level: int) -> np.ndarray:
        """The place within ``level`` of every row; below a leaf, rows go left."""
        n = bins.shape[1]
        code = np.zeros(n, np.uint8)
        for d in range(min(level, MASKED)):
            right, first = np.zeros(n, bool), 2 ** d - 1
            for node in np.flatnonzero(self.feature[first:2 * first + 1] >= 0) + first:
                right |= (code == node - first) & (bins[self.feature[node]] > self.split[node])
            code = code + code + right
        code, flat, at = code.astype(np.int64), bins.reshape(-1), np.arange(n) if level > MASKED else None
        for d in range(MASKED, level):
            here = slice(2 ** d - 1, 2 ** (d + 1) - 1)
            feature = self.feature[here].take(code)
            code += code + ((feature >= 0) & (flat.take(np.maximum(feature, 0) * n + at) > self.split[here].take(code)))
        return code


def _histograms(trees: Mapping, folds: Sequence[int], first: bool, m: int, level: int, n_bins: int, losses: bool):
    """Sums of one tree level: ``((setting, fold), [count, sum, squares] per feature, open node and bin)``, and with ``losses``
    ``((setting, fold, "loss"), held-out squared error)``. A block comes with its predictions ``[setting, fold, row]``."""
    def run(blocks):
        found = {}
        for (fold, y, bins, bags, begin), pred in blocks:
            draws = (bags[m // BITS] >> np.uint32(m % BITS) & np.uint32(1)).astype(bool) if len(bags) else None
            for i, f in enumerate(folds):
                training = fold != f
                if losses:
                    held_out = np.flatnonzero(~training)
                    if len(held_out):
                        for g in range(len(pred)):
                            found[(g, f, "loss")] = found.get((g, f, "loss"), 0.0) + np.array([np.sum((y[held_out] - pred[g, i][held_out]) ** 2)])
                open_ = [(g, tree) for (g, f2), tree in trees.items() if f2 == f and tree.open]
                if not open_:
                    continue
                drawn = np.flatnonzero(training)
                if draws is not None:
                    drawn = drawn.compress(draws[begin[i]:begin[i] + len(drawn)])
                some, y_d = bins[i].take(drawn, axis=1), y[drawn]
                for g, tree in open_:
                    slots = np.full(2 ** level, len(tree.open), np.int64)
                    slots[np.asarray(tree.open) + 1 - 2 ** level] = np.arange(len(tree.open))
                    slot = slots.take(tree.codes(some, level))
                    x, target = some, y_d if first else 2.0 * (y_d - pred[g, i].take(drawn))     # the negative gradient
                    inside = np.flatnonzero(slot < len(tree.open)) if len(tree.open) < 2 ** level else drawn
                    if len(inside) < len(slot):
                        x, target, slot = some.take(inside, axis=1), target[inside], slot[inside]
                    slot, size = slot * n_bins, len(tree.open) * n_bins
                    both, totals = np.empty(len(target), complex), np.zeros((len(x), size), complex)
                    both.real, both.imag = target, target * target          # sum and squares are added up in one go
                    h = np.empty((3, len(x), len(tree.open), n_bins))
                    for j in range(len(x)):
                        at = slot + x[j]
                        h[0, j] = np.bincount(at, minlength=size).reshape(-1, n_bins)
                        np.add.at(totals[j], at, both)
                    h[1], h[2] = totals.real.reshape(h[1].shape), totals.imag.reshape(h[2].shape)
                    if (g, f) in found:
                        found[(g, f)] += h
                    else:
                        found[(g, f)] = h
        return iter(found.items())

    return run


def _updated(trees: Mapping, folds: Sequence[int], weights: Mapping):
    """The predictions of a block with the trees of an iteration."""
    ends = {key: tree.ends(tree.depth()) for key, tree in trees.items()}

    def run(item):
        (_, _, bins, _, _), pred = item
        pred = pred.copy()
        for (g, f), tree in trees.items():
            i = folds.index(f)
            pred[g, i] += weights[g] * ends[(g, f)].take(tree.codes(bins[i], tree.depth()))
        return pred
    return run


def _variance(h: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return (h[2] - h[1] * h[1] / h[0]) / h[0]


def _split(tree: _Tree, h: np.ndarray, cuts: Sequence[np.ndarray], depth: int, min_node: int, min_gain: float) -> None:
    """Split every open node at its best candidate; ties go to the first feature and the lowest bin. The gain is
    rounded as MLlib rounds it, so that splits of a node into the same rows by other features tie alike."""
    up_to = np.cumsum(h, axis=3)
    left, right = up_to[..., :-1], up_to[..., -1:] - up_to[..., :-1]                 # [count, sum, squares], feature, node, bin
    if tree.open[0] == 0:
        root = left[:, 0, 0, 0] + right[:, 0, 0, 0]
        if not root[0]:
            tree.open = []
            return
        tree.value[0], tree.impurity[0] = root[1] / root[0], _variance(root)
    allowed = (np.arange(left.shape[3])[None, None, :] < np.array([len(c) for c in cuts])[:, None, None]) \
        & (left[0] >= max(min_node, 1)) & (right[0] >= max(min_node, 1))
    n, left_var, right_var = left[0] + right[0], _variance(left), _variance(right)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = tree.impurity[tree.open][None, :, None] - left[0] / n * left_var - right[0] / n * right_var
    gain = np.where(allowed & (gain >= min_gain) & (gain > 0), gain, -np.inf)
    following = []
    for i, node in enumerate(tree.open):
        j, b = np.unravel_index(np.argmax(gain[:, i]), gain[:, i].shape)
        if gain[j, i, b] == -np.inf:
            continue
        tree.feature[node], tree.split[node] = j, np.searchsorted(cuts[j], cuts[j][b], side="right") - 1
        for child, side, var in ((2 * node + 1, left, left_var), (2 * node + 2, right, right_var)):
            tree.value[child], tree.impurity[child] = side[1, j, i, b] / side[0, j, i, b], var[j, i, b]
            if child + 1 < 2 ** depth and abs(tree.impurity[child]) >= np.finfo(float).eps:
                following.append(child)
    tree.open = following


def paths(data: DataFrame, fold_col: str, label: str, sizes: Mapping, estimators: Sequence[GBTRegressor], iterations: int) -> dict:
    """``{(setting, fold): held-out mean squared error after every iteration}``. ``data`` has a ``features`` vector,
    ``sizes`` is the number of rows of every fold; the estimators share seed, subsampling rate and bins."""
    est = estimators[0]
    max_bins, rate, seed = est.getMaxBins(), est.getSubsamplingRate(), est.getSeed()
    cuts = _candidates(data, fold_col, sizes, max_bins, seed)
    blocks = _training(data, fold_col, label, cuts, iterations, rate, seed).persist(StorageLevel.DISK_ONLY)
    together = max(1, PREDICTED // (8 * len(sizes) * max(1, sum(sizes.values()))))
    out = {}
    try:
        for g in range(0, len(estimators), together):
            found = _paths(blocks, cuts, sizes, estimators[g:g + together], iterations)
            out |= {(g + i, f): losses for (i, f), losses in found.items()}
    finally:
        blocks.unpersist()
    return out


def _paths(blocks, cuts: Mapping, sizes: Mapping, estimators: Sequence[GBTRegressor], iterations: int) -> dict:
    """The paths of settings that grow side by side."""
    folds, n_settings, sc = sorted(cuts), len(estimators), blocks.context
    n_bins = 1 + max(1, *(len(c) for fold_cuts in cuts.values() for c in fold_cuts))
    depth = [e.getMaxDepth() for e in estimators]
    n_tasks, cell = blocks.getNumPartitions(), 24 * n_bins * len(cuts[folds[0]])
    out = {(g, f): [] for g in range(n_settings) for f in sizes}
    rows = blocks.map(lambda b: (b, np.zeros((n_settings, len(folds), len(b[1])))))      # with their predictions
    held = last = None

    def sums(trees, first, m, level, losses):
        sent = n_tasks * cell * sum(len(t.open) for t in trees.values())
        reducers = max(1, min(sc.defaultParallelism, sent // REDUCE_BYTES))
        return dict(rows.mapPartitions(_histograms(trees, folds, first, m, level, n_bins, losses))
                    .reduceByKey(lambda a, b: a + b, reducers).collect())

    def keep_losses(got):
        for g, f in out:
            out[(g, f)].append(float(got[(g, f, "loss")][0]) / sizes[f])

    try:
        for m in range(iterations):
            trees, level = {(g, f): _Tree(depth[g]) for g, f in out}, 0
            while any(t.open for t in trees.values()):
                got = sums(trees, m == 0, m, level, level == 0 and m > 0)
                if level == 0 and m > 0:
                    keep_losses(got)
                    if last is not None:
                        last.unpersist()
                for (g, f), t in trees.items():
                    if t.open and (g, f) in got:
                        _split(t, got[(g, f)], cuts[f], depth[g], estimators[g].getMinInstancesPerNode(),
                               estimators[g].getMinInfoGain())
                    else:
                        t.open = []
                level += 1
            weights = {g: 1.0 if m == 0 else e.getStepSize() for g, e in enumerate(estimators)}
            last, held = held, _alone(rows.map(_updated(trees, folds, weights))).persist(StorageLevel.DISK_ONLY)
            rows = blocks.zip(held)
        keep_losses(sums({}, False, iterations - 1, 0, True))
    finally:
        for predictions in (last, held):
            if predictions is not None:
                predictions.unpersist()
    return out
