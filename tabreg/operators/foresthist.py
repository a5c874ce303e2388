"""Forests of many settings and folds, grown side by side (ML7, ML8, X3).

Bagged regression trees as MLlib's ``RandomForestRegressor`` grows them: features cut into at most ``maxBins``
bins, bootstrap counts per row and tree, trees grown level by level from sums per (node, feature, bin), for every
node a drawn subset of the features. One pass per tree level serves ALL settings and folds, where a fit per
(setting, fold) needs a job of its own for every level.

* The rows lie in Spark as blocks, once for all folds: labels, folds, the bins by every fold's split candidates
  and the bootstrap counts. Tasks add up the histograms of their blocks (numpy), a shuffle adds them up, the
  reducers pick the splits; the driver sees splits, never rows or histograms.
* Settings share the bags, so nodes that were reached by the same splits hold the same rows: their histogram is
  made once for all settings.
* A job takes as many trees as keep a task's histograms within ``JOB_BYTES``.

Bags, feature subsets, split candidates and gains are those of MLlib's fit on each fold's training rows in their
stored order: the trees are the same.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.operators.boosthist import _binned, _candidates, _variance

BLOCK = 1 << 16            # rows of a block
JOB_BYTES = 128 << 20      # histograms of one task
REDUCE_BYTES = 8 << 20     # histograms a reducer adds up, where cores are left
MASKED = 4                 # tree levels whose nodes are compared one by one
EPSILON = float(np.finfo(float).eps)


def supports(est, n_features: int) -> bool:
    """Whether the estimator is a plain forest whose levels fit MLlib's ``maxMemoryInMB`` (there MLlib splits a level
    at once, which fixes the order of the feature draws): anything else needs MLlib's own fit."""
    if not isinstance(est, RandomForestRegressor):
        return False
    nodes = est.getNumTrees() * 2 ** (est.getMaxDepth() - 1)
    return (est.getBootstrap() and est.getImpurity() == "variance" and est.getMinWeightFractionPerNode() == 0.0 and est.getMaxBins() <= 256
            and 1 <= est.getMaxDepth() <= 10 and est.getNumTrees() > 1 and est.getSubsamplingRate() <= 1.0
            and (est.getFeatureSubsetStrategy() == "all" or est.getFeatureSubsetStrategy().isdigit() and int(est.getFeatureSubsetStrategy()) > 0)
            and nodes * n_features * est.getMaxBins() * 24 <= est.getMaxMemoryInMB() << 20
            and not (est.isDefined("weightCol") and est.getWeightCol()))


# -- bootstrap counts ----------------------------------------------------------------------

class PoissonCounts:
    """The Poisson draws of MLlib's bags: Well19937c words, two to a uniform, uniforms multiplied up to exp(-mean).
    A word needs the one before it and words 70 to 623 steps back, so all but one term is worked out 70 words at a time,
    side by side in one large integer."""

    def __init__(self, seed: int, mean: float):
        v = [seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF]
        for i in range(2, 624):
            signed = v[i - 2] - (v[i - 2] >> 31 << 32)
            v.append((1812433253 * (signed ^ (signed >> 30)) + i) & 0xFFFFFFFF)
        self.past, self.last, self.stop = np.array(v[:0:-1], "<u4").tobytes(), v[0], math.exp(-mean)
        every = sum(1 << 32 * i for i in range(70))
        self.masks = [every * m for m in (0x1F, 0x7FFFFF, 0x7FFFFFFF, 0x80000000, 0xFFFFFE00, 0xFFE00000, 0x7FF, 0xFE000000)]
        self.uniforms, self.counts = np.zeros(0), np.zeros(0, np.uint8)

    def _words(self, chunks: int) -> np.ndarray:
        low_5, low_23, low_31, top, from_9, from_21, low_11, from_25 = self.masks
        x, out, last = bytearray(self.past), array("I"), self.last
        for i in range(len(x), len(x) + 280 * chunks, 280):
            a, b, c, d, e = [int.from_bytes(x[i - 4 * back:i - 4 * back + 280], "little") for back in (70, 449, 179, 623, 622)]
            a ^= a >> 27 & low_5
            b ^= (c >> 9 & low_23) ^ (b >> 1 & low_31)
            both = a ^ b
            known = (d & top) ^ (e & low_31) ^ (a << 9 & from_9) ^ (b << 21 & from_21) ^ (both >> 21 & low_11)
            z = array("I", [last])
            z.extend([last := (last & 0x7FFFFF) << 9 ^ last >> 21 ^ (last & 127) << 4 ^ k
                      for k in memoryview(known.to_bytes(280, "little")).cast("I").tolist()])
            out += z[1:]
            before = int.from_bytes(z[:-1].tobytes(), "little")
            x += (before ^ (before << 25 & from_25) ^ both).to_bytes(280, "little")
        self.past, self.last, out = bytes(x[-len(self.past):]), last, np.array(out, np.uint32)
        out ^= (out << 7) & 0xE46E1700
        out ^= (out << 15) & 0x9B868000
        return out

    def take(self, n: int) -> np.ndarray:
        """The next ``n`` draws."""
        parts, have = [self.counts], len(self.counts)
        while have < n:
            words = self._words(int(min(max((n - have) * 4 // 70, 8), 4096))).astype(np.int64) >> 6
            u = np.concatenate([self.uniforms, ((words[::2] << 26) | words[1::2]) * 2.0 ** -52])
            count, product, at, k = np.zeros(len(u), np.int64), u, np.arange(len(u)), 0
            while len(at):                      # how many factors from every position on keep the product up
                up = product >= self.stop
                at, product, k = at[up], product[up], k + 1
                count[at] = k
                fits = at + k < len(u)
                at, product = at[fits], product[fits] * u[at[fits] + k]
            following, starts, i = (np.arange(len(u)) + count + 1).tolist(), [], 0
            while i < len(u) and following[i] <= len(u):
                starts.append(i)
                i = following[i]
            self.uniforms = u[i:]
            parts.append(count[starts].astype(np.uint8))
            have += len(starts)
        drawn = np.concatenate(parts)
        self.counts = drawn[n:]
        return drawn[:n]


class _Subsets:
    """The features tried at the i-th node that MLlib takes up: a reservoir sample seeded by the fit's i-th long."""

    def __init__(self, spark, seed: int, n_features: int):
        self.hashed = getattr(getattr(spark._jvm.org.apache.spark.util.random, "XORShiftRandom$"), "MODULE$").hashSeed
        self.n, self.drawn, self.found = n_features, [], {}
        self.longs = spark._jvm.java.util.Random(seed)

    def _uniforms(self, state: int) -> list[float]:
        """The doubles of MLlib's XORShiftRandom, worked out here: a call of the JVM takes longer than all of them."""
        state, words = state & 0xFFFFFFFFFFFFFFFF, []
        for _ in range(2 * (self.n - 1)):
            state ^= state << 21 & 0xFFFFFFFFFFFFFFFF
            state ^= state >> 35
            state ^= state << 4 & 0xFFFFFFFFFFFFFFFF
            words.append(state)
        return [(((a & 0x3FFFFFF) << 27) + (b & 0x7FFFFFF)) * 2.0 ** -53 for a, b in zip(words[::2], words[1::2])]

    def get(self, k: int, i: int) -> list[int]:
        while len(self.drawn) <= i:
            self.drawn.append(self._uniforms(self.hashed(self.longs.nextLong())))
        if (k, i) not in self.found:
            kept = list(range(k))
            for item, u in zip(range(k, self.n), self.drawn[i]):
                place = int(u * (item + 1))
                if place < k:
                    kept[place] = item
            self.found[(k, i)] = kept
        return self.found[(k, i)]


# -- rows ----------------------------------------------------------------------------------

def _blocks(cuts: Mapping, n_trees: int, mean: float, seed: int):
    """Rows (fold, label, features) of a partition to blocks for all folds. A fold's training rows take the
    partition's draws in order, ``n_trees`` a row; a block holds the window of draws its folds are at."""
    folds = sorted(cuts)
    kinds = pa.schema([("fold", pa.binary()), ("y", pa.binary()), ("bins", pa.binary()), ("counts", pa.binary()), ("begin", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = PoissonCounts(seed + TaskContext.get().partitionId() + 1, mean)
        kept, rows, window, taken, start = [], 0, np.zeros((0, n_trees), np.uint8), np.zeros(len(folds), np.int64), 0

        def pack() -> pa.RecordBatch:
            nonlocal window, start, taken
            t = pa.Table.from_batches(kept)
            fold, y = t["fold"].to_numpy().astype(np.int32), t["y"].to_numpy()
            x = t["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
            if not (np.isfinite(y).all() and np.isfinite(x).all()):
                raise ValueError("a label or feature is NaN or infinite")
            until = taken + np.array([np.sum(fold != f) for f in folds])
            window = window[taken.min() - start:]
            start = int(taken.min())
            new = int(until.max()) - start - len(window)
            if new > 0:
                window = np.concatenate([window, draws.take(new * n_trees).reshape(new, n_trees)])
            bins = np.empty((len(folds), x.shape[1], len(y)), np.uint8)
            for i, f in enumerate(folds):
                bins[i], held_out = _binned(x, cuts[f], False), fold == f
                bins[i][:, held_out] = _binned(x[held_out], cuts[f], True)
            part = [fold.tobytes(), y.astype(float).tobytes(), bins.tobytes(), np.ascontiguousarray(window.T).tobytes(), (taken - start).tobytes()]
            taken = until
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in part], schema=kinds)

        for b in batches:
            kept, rows = [*kept, b], rows + b.num_rows
            if rows >= BLOCK:
                yield pack()
                kept, rows = [], 0
        if rows:
            yield pack()

    return run


def _rows(data: DataFrame, fold_col: str, label: str, cuts: Mapping, n_trees: int, mean: float, seed: int):
    """All rows as an RDD of blocks ``(fold, y, bins[fold, feature, row], counts[tree, draw], first draw of each fold)``."""
    rows = data.where(F.col(fold_col).isNotNull()).select(
        F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array("features").alias("x"))
    n_folds = len(cuts)

    def block(r):
        y = np.frombuffer(r["y"])
        return (np.frombuffer(r["fold"], np.int32), y, np.frombuffer(r["bins"], np.uint8).reshape(n_folds, -1, len(y)),
                np.frombuffer(r["counts"], np.uint8).reshape(n_trees, -1), np.frombuffer(r["begin"], np.int64))

    return rows.mapInArrow(_blocks(cuts, n_trees, mean, seed), "fold binary, y binary, bins binary, counts binary, begin binary").rdd.map(block)


# -- trees ---------------------------------------------------------------------------------

class _Tree:
    """A binary tree in heap order; a row goes left up to bin ``split``, a leaf keeps it. ``paths`` names the rows of
    every open node by the splits that lead there."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.split, self.inner = np.zeros(size, np.int64), np.full(size, 255, np.uint8), np.zeros(size, bool)
        self.value, self.impurity, self.paths = np.zeros(size), np.zeros(size), {0: ()}

    def shape(self) -> tuple:
        return self.feature, self.split, self.inner

    def grow(self, node: int, feature: int, split: int, sides: Sequence[tuple], depth: int) -> list[int]:
        path = self.paths.pop(node)
        self.feature[node], self.split[node], self.inner[node], following = feature, split, True, []
        for side, (value, impurity) in enumerate(sides):
            child = 2 * node + 1 + side
            self.value[child], self.impurity[child] = value, impurity
            if child + 1 < 2 ** depth and abs(impurity) >= EPSILON:
                self.paths[child] = (*path, feature, split, side)
                following.append(child)
        return following


def _place(shape: tuple, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node every row has reached after at most ``depth`` splits."""
    feature, split, inner = shape
    n, flat = bins.shape[1], bins.reshape(-1)
    ids = np.arange(len(feature))
    child = np.stack([np.where(inner, 2 * ids + 1, ids), np.where(inner, 2 * ids + 2, ids)], axis=1).reshape(-1)
    offset, at, node = feature * n, np.arange(n), np.zeros(n, np.int64)
    for _ in range(depth):
        value = flat.take(offset.take(node) + at)
        node = child.take(2 * node + (value > split.take(node)))
    return node


def _codes(shape: tuple, bins: np.ndarray, level: int, nodes: Sequence[int]) -> np.ndarray:
    """The place within ``level`` of every row whose node there is one of ``nodes``; the other rows are at other places."""
    feature, split, _ = shape
    ways, n = np.asarray(nodes) + 1, bins.shape[1]
    code = np.zeros(n, np.uint8)
    for d in range(min(level, MASKED)):
        right = np.zeros(n, bool)
        for node in np.unique(ways >> (level - d)) - 1:
            right |= (code == node + 1 - 2 ** d) & (bins[feature[node]] > split[node])
        code = code + code + right
    code, flat, at = code.astype(np.int64), bins.reshape(-1), np.arange(n)
    for d in range(MASKED, level):
        here = slice(2 ** d - 1, 2 ** (d + 1) - 1)
        row = (feature[here] * n).take(code)
        row += at
        right = flat.take(row) > split[here].take(code)
        code += code
        code += right
    return code


def _histograms(jobs: Mapping, folds: Sequence[int], level: int, n_bins: int):
    """``jobs``: fold position -> tree -> [(shape, nodes)]. Sums ``((fold position, tree, shape number), [count, sum, squares]
    per feature, node and bin)``."""
    def run(blocks):
        found, room, room_2 = {}, np.empty(0, complex), np.empty(0)
        for fold, y, bins, counts, begin in blocks:
            for i, trees in jobs.items():
                training = np.flatnonzero(fold != folds[i])
                if not len(training):
                    continue
                y_f, bins_f = y[training], bins[i].take(training, axis=1)
                for t, shapes in trees.items():
                    count = counts[t, begin[i]:begin[i] + len(training)]
                    drawn = np.flatnonzero(count)
                    some, w, y_d = bins_f.take(drawn, axis=1), count[drawn].astype(float), y_f[drawn]
                    wy = w * y_d
                    first, squares = np.empty(len(drawn), complex), wy * y_d       # count and sum are added up in one go
                    first.real, first.imag = w, wy
                    for c, (shape, nodes) in enumerate(shapes):
                        if not len(nodes):
                            continue
                        slots = np.full(2 ** level, len(nodes) * n_bins, np.int64)
                        slots[np.asarray(nodes) + 1 - 2 ** level] = np.arange(len(nodes)) * n_bins
                        slot = slots.take(_codes(shape, some, level, nodes))
                        x, one, two = some, first, squares
                        inside = np.flatnonzero(slot < len(nodes) * n_bins)
                        if len(inside) < 0.75 * len(slot):          # else the other rows go to a node of their own
                            x, one, two, slot = x.take(inside, axis=1), one[inside], two[inside], slot[inside]
                        size = (len(x), (len(nodes) + 1) * n_bins)
                        if len(room) < size[0] * size[1]:
                            room, room_2 = np.empty(size[0] * size[1], complex), np.empty(size[0] * size[1])
                        ones, twos = (a[:size[0] * size[1]].reshape(size) for a in (room, room_2))
                        ones.fill(0.0)
                        twos.fill(0.0)
                        for j in range(len(x)):
                            at = slot + x[j]
                            np.add.at(ones[j], at, one)
                            np.add.at(twos[j], at, two)
                        key = (i, t, c)
                        if key in found:
                            for total, part in zip(found[key], (ones, twos)):
                                total += part
                        else:
                            found[key] = ones.copy(), twos.copy()
        for key in list(found):
            ones, twos = (a.reshape(len(a), -1, n_bins)[:, :-1] for a in found.pop(key))
            yield key, np.stack([ones.real, ones.imag, twos])

    return run


def _splits(cuts: Mapping, folds: Sequence[int], wanted: Mapping):
    """The best split of every wanted node from its histogram. ``wanted``: key of the histogram -> [(slot, node, impurity or
    None, [(setting, node, features or None, min_node, min_gain)])]. Ties go to the first feature tried and the lowest bin."""
    def run(item):
        key, h = item
        fold_cuts, out = cuts[folds[key[0]]], []
        up_to = np.cumsum(h, axis=3)
        left, right = up_to[..., :-1], up_to[..., -1:] - up_to[..., :-1]
        n, left_var, right_var = left[0] + right[0], _variance(left), _variance(right)
        sizes = np.array([len(c) for c in fold_cuts])
        candidate, least = np.arange(left.shape[3])[None, :] < sizes[:, None], np.minimum(left[0], right[0])
        with np.errstate(divide="ignore", invalid="ignore"):
            left_part, right_part = left[0] / n * left_var, right[0] / n * right_var
        for slot, root, asked in wanted[key]:
            for g, node, impurity, features, min_node, min_gain in asked:
                order = np.arange(len(sizes)) if features is None else np.array(features)
                top = None
                if root:
                    first = next((j for j in order if sizes[j]), order[0])
                    total = left[:, first, slot, 0] + right[:, first, slot, 0]
                    impurity = float(_variance(total))
                    top = (float(total[1] / total[0]), impurity)
                gain = impurity - left_part[order, slot] - right_part[order, slot]
                ok = candidate[order] & (least[order, slot] >= max(min_node, 1)) & (gain >= min_gain) & (gain > 0)
                gain = np.where(ok, gain, -np.inf)
                k, b = np.unravel_index(np.argmax(gain), gain.shape)
                best = None
                if gain[k, b] > -np.inf:
                    j = int(order[k])
                    sides = [(float(s[1, j, slot, b] / s[0, j, slot, b]), float(v[j, slot, b])) for s, v in ((left, left_var), (right, right_var))]
                    best = (j, int(np.searchsorted(fold_cuts[j], fold_cuts[j][b], side="right")) - 1, sides)
                out.append((g, key[0], key[1], node, top, best))
        return out

    return run


def _in_order(trees: Sequence[int], shift: int = 0) -> list[int]:
    """The order in which MLlib goes through the trees of a level: that of its hash map."""
    if len(trees) <= 4 and not shift:
        return sorted(trees, key=lambda t: (t & 15, t))
    places: dict = {}
    for t in trees:
        h = (t + ~(t << 9)) & 0xFFFFFFFF
        h ^= h >> 14
        h = (h + (h << 4)) & 0xFFFFFFFF
        places.setdefault((h ^ (h >> 10)) >> shift & 31, []).append(t)
    alone = [places[p][0] for p in sorted(places) if len(places[p]) == 1]
    return alone + [t for p in sorted(places) if len(places[p]) > 1 for t in _in_order(places[p], shift + 5)]


# -- scores --------------------------------------------------------------------------------

def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments [n, mean p, mean y, S_pp, S_yy, S_py, squared errors, absolute errors] of two sets of rows together."""
    n, dp, dy = a[..., 0] + b[..., 0], b[..., 1] - a[..., 1], b[..., 2] - a[..., 2]
    share, both = b[..., 0] / n, a[..., 0] * b[..., 0] / n
    out = a + b
    out[..., 1], out[..., 2] = a[..., 1] + dp * share, a[..., 2] + dy * share
    out[..., 3] += dp * dp * both
    out[..., 4] += dy * dy * both
    out[..., 5] += dp * dy * both
    return out


def _moments(shapes: Mapping, folds: Sequence[int], counts: Sequence[int], depth: int, n_settings: int):
    """``shapes``: fold position -> tree -> [(shape, values, settings)]. The held-out rows' moments by fold, of every setting
    and tree count."""
    def run(blocks):
        found = {}
        for fold, y, bins, _, _ in blocks:
            for i, trees in shapes.items():
                held_out = np.flatnonzero(fold == folds[i])
                if not len(held_out):
                    continue
                y_f, bins_f = y[held_out], bins[i].take(held_out, axis=1)
                total, out = np.zeros((n_settings, len(y_f))), np.empty((n_settings, len(counts), 8))
                for t in range(max(counts)):
                    for shape, value, settings in trees[t]:
                        node = _place(shape, bins_f, depth)
                        for g, v in zip(settings, value):
                            total[g] += v[node]
                    if t + 1 in counts:
                        p = total / float(t + 1)
                        mp, my, e = p.mean(axis=1), y_f.mean(), p - y_f
                        dp, dy = p - mp[:, None], y_f - my
                        out[:, counts.index(t + 1)] = np.stack(
                            [np.full(n_settings, float(len(y_f))), mp, np.full(n_settings, my), (dp * dp).sum(1),
                             np.full(n_settings, (dy * dy).sum()), (dp * dy).sum(1), (e * e).sum(1), np.abs(e).sum(1)], axis=1)
                found[i] = _merged(found[i], out) if i in found else out
        return iter(found.items())

    return run


def _score(m: np.ndarray) -> tuple:
    n, _, _, pp, yy, py, squares, absolute = (float(v) for v in m)
    r = py / math.sqrt(pp * yy) if pp * yy > 0 else None
    return math.sqrt(squares / n), None if r is None else r * r, absolute / n


# -- all together --------------------------------------------------------------------------

class Shared:
    """The assembled rows and the blocks with their bags, for several tunings of one table, until ``release``. Other
    work runs beside them, so they lie on disk only."""

    def __init__(self):
        self.source = self.data = self.sizes = None
        self.blocks: dict = {}                       # (seed, rate, bins, trees) -> (split candidates, blocks)

    def release(self) -> None:
        for _, blocks in self.blocks.values():
            blocks.unpersist()
        self.blocks = {}


def scores(data: DataFrame, fold_col: str, label: str, sizes: Mapping, estimators: Sequence[RandomForestRegressor],
           counts: Sequence[int], shared: Shared | None = None) -> dict:
    """``{(setting, fold): {tree count: (rmse, rsquared, mae)}}`` on the held-out rows. ``data`` has a ``features`` vector,
    ``sizes`` is the number of rows of every fold; the estimators share seed, subsampling rate, bins and number of trees.
    The blocks stay in ``shared`` for the next call with the same bags."""
    est, spark = estimators[0], data.sparkSession
    n_trees, seed, folds = est.getNumTrees(), est.getSeed(), sorted(sizes)
    held, bags = shared or Shared(), (seed, est.getSubsamplingRate(), est.getMaxBins(), n_trees)
    if bags not in held.blocks:
        cuts = _candidates(data, fold_col, sizes, est.getMaxBins(), seed)
        level = StorageLevel.DISK_ONLY if shared else StorageLevel.MEMORY_AND_DISK
        held.blocks[bags] = cuts, _rows(data, fold_col, label, cuts, n_trees, est.getSubsamplingRate(), seed).persist(level)
    cuts, blocks = held.blocks[bags]
    n_features = len(cuts[folds[0]])
    n_bins = 1 + max(1, *(len(c) for fold_cuts in cuts.values() for c in fold_cuts))
    depths = [e.getMaxDepth() for e in estimators]
    limits = [(e.getMinInstancesPerNode(), e.getMinInfoGain()) for e in estimators]
    tried = [n_features if e.getFeatureSubsetStrategy() == "all" else min(int(e.getFeatureSubsetStrategy()), n_features) for e in estimators]
    subsets = _Subsets(spark, seed, n_features)
    n_tasks, cores = blocks.getNumPartitions(), spark.sparkContext.defaultParallelism
    every = [(g, i) for g in range(len(estimators)) for i in range(len(folds))]
    trees = {(g, i, t): _Tree(depths[g]) for g, i in every for t in range(n_trees)}
    opened = {key: [(t, 0) for t in reversed(range(n_trees))] for key in every}     # MLlib's stack, its top first
    drawn = dict.fromkeys(every, 0)

    def level_jobs(level):
        """Histograms of a level, each set of rows once: (fold position, tree) -> shapes with their nodes, and who asks."""
        jobs, wanted, shape_no, node_no = {}, {}, {}, {}
        for g, i in every:
            for t, node in opened[(g, i)]:
                features = None
                if tried[g] < n_features:
                    features = subsets.get(tried[g], drawn[(g, i)])
                    drawn[(g, i)] += 1
                tree = trees[(g, i, t)]
                ask = (g, node, tree.impurity[node], features, *limits[g])
                at = (i, t, tree.paths[node])
                if at not in node_no:
                    shapes = jobs.setdefault((i, t), [])
                    if (g, i, t) not in shape_no:
                        shape_no[(g, i, t)] = len(shapes)
                        shapes.append((tree.shape(), []))
                    c = shape_no[(g, i, t)]
                    asked = []
                    node_no[at] = asked
                    wanted.setdefault((i, t, c), []).append((len(shapes[c][1]), level == 0, asked))
                    shapes[c][1].append(node)
                node_no[at].append(ask)
        return jobs, wanted

    def best_splits(level):
        jobs, wanted = level_jobs(level)
        cell, batch, size = 24 * n_bins * n_features, {}, 0
        out = []

        def submit():
            keys = [(i, t, c) for i, per_tree in batch.items() for t, shapes in per_tree.items() for c in range(len(shapes))]
            reducers = max(1, min(cores, n_tasks * size // REDUCE_BYTES))
            found = blocks.mapPartitions(_histograms(batch, folds, level, n_bins)).reduceByKey(lambda a, b: a + b, reducers)
            out.extend(found.flatMap(_splits(cuts, folds, {k: wanted[k] for k in keys})).collect())

        for (i, t), shapes in sorted(jobs.items(), key=lambda job: job[0]):
            bytes_ = cell * sum(len(nodes) for _, nodes in shapes)
            if batch and size + bytes_ > JOB_BYTES:
                submit()
                batch, size = {}, 0
            batch.setdefault(i, {})[t] = shapes
            size += bytes_
        if batch:
            submit()
        return out

    try:
        level = 0
        while any(opened.values()):
            found = {(g, i, t, node): (top, best) for g, i, t, node, top, best in best_splits(level)}
            for g, i in every:
                taken_up, pushed = {}, []
                for t, node in opened[(g, i)]:
                    taken_up.setdefault(t, []).append(node)
                for t in _in_order(list(taken_up)):
                    tree = trees[(g, i, t)]
                    for node in taken_up[t]:
                        top, best = found.get((g, i, t, node), (None, None))
                        if top:
                            tree.value[0], tree.impurity[0] = top
                        if best:
                            pushed += [(t, child) for child in tree.grow(node, *best, depths[g])]
                        else:
                            tree.paths.pop(node)
                opened[(g, i)] = pushed[::-1]
            level += 1
        grown: dict = {}
        for (g, i, t), tree in trees.items():
            same = grown.setdefault(i, {}).setdefault(t, {}).setdefault(tuple(a.tobytes() for a in tree.shape()), (tree.shape(), [], []))
            same[1].append(tree.value)
            same[2].append(g)
        shapes = {i: {t: list(s.values()) for t, s in per_tree.items()} for i, per_tree in grown.items()}
        moments = dict(blocks.mapPartitions(_moments(shapes, folds, list(counts), max(depths), len(estimators)))
                       .reduceByKey(_merged, max(1, min(cores, len(folds)))).collect())
    finally:
        if shared is None:
            held.release()
    return {(g, f): {m: _score(moments[i][g, k]) for k, m in enumerate(counts)}
            for g in range(len(estimators)) for i, f in enumerate(folds)}
