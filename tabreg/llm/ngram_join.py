"""Similarity join on word n-grams: an LSH forest of MinHash prefixes, then exact Jaccard.

Equal texts are one class. Every class has a MinHash signature of ``trees`` sequences; a tree
holds the classes in the order of its sequence, and classes that share a prefix of the current
depth are a subtree of candidates. The depth is the longest at which a pair at the threshold is
caught with the target probability (a formula of the depth and the number of trees: it does not
depend on the data, and the recall is that of the formula, not a measured one). A pair is verified
in the first tree that catches it, in blocks of classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, parallelism, release_tables, text_or_empty, trimmed
from tabreg.llm.components import connected_components, groups, roots

WORD = re.compile(r"\w+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct 48-bit hashes of the word n-grams of each text (lower case, runs of
    letters, digits and underscores). Fewer than n words are one gram; no word, no gram."""
    words = [WORD.findall(t.lower()) for t in texts]
    flat = np.array([w for ws in words for w in ws], dtype=object)
    h = pd.util.hash_array(flat, categorize=True) if len(flat) else np.zeros(0, np.uint64)
    out, at = [], 0
    for ws in words:
        own, at = h[at:at + len(ws)], at + len(ws)
        size = min(n, len(own))
        gram = own[:len(own) - size + 1].copy() if size else own
        for k in range(1, size):
            gram = _mix(gram * GOLDEN + own[k:len(own) - size + 1 + k])
        out.append(np.unique(gram >> np.uint64(16)))
    return out


def packed_grams(grams: np.ndarray) -> bytes:
    """The 48-bit hashes as six bytes each."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_grams(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def text_slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and, beyond one row, ``size`` bytes of text: the words of a
    slice are Python objects, so a run of long texts must not be held at once."""
    bytes_ = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, n in enumerate(bytes_):
        if i > lo and (i - lo == rows or held + n > size):
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), 2 ** 32 - 1, np.uint32)
    for lo in range(0, len(grams), 1024):
        x = (grams[lo:lo + 1024, None] * a + b) >> np.uint64(32)
        low = np.minimum(low, x.min(axis=0).astype(np.uint32))
    return low


def caught(j: np.ndarray | float, depth: int, trees: int):
    """Probability that a pair of Jaccard index j shares a prefix of the depth in some tree."""
    return 1.0 - (1.0 - j ** depth) ** trees


def start_depth(threshold: float, trees: int, recall: float, longest: int) -> int:
    depth = longest
    while depth > 1 and caught(threshold, depth, trees) < recall:
        depth -= 1
    return depth


def _earlier(left: np.ndarray, right: np.ndarray, tree: int) -> np.ndarray:
    """Pairs that an earlier tree has caught."""
    seen = np.zeros((len(left), len(right)), bool)
    for t in range(tree):
        seen |= left[:, t][:, None] == right[:, t][None, :]
    return seen


def _open_pairs(table: pa.Table, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that this subtree block has to look at. Columns: tree, key, bi, bj,
    own block, node, keys."""
    tree, bi, bj = (table.column(c)[0].as_py() for c in (0, 2, 3))
    block = np.asarray(table.column("block"))
    keys = np.asarray(table.column("keys").combine_chunks().flatten()).reshape(-1, trees)
    if bi == bj:
        new = ~_earlier(keys, keys, tree)
        return np.nonzero(np.triu(new, 1))
    i, j = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
    x, y = np.nonzero(~_earlier(keys[i], keys[j], tree))
    return i[x], j[y]


def _common(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs: one by one, or by products of 0/1 matrices
    over the grams that at least two texts share where there are many pairs."""
    if len(left) <= 8 * len(grams):
        return np.array([len(np.intersect1d(grams[i], grams[j], assume_unique=True)) for i, j in zip(left, right)], np.int64)
    flat = np.concatenate(grams)
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    use = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[use]]
    owner = owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(grams), len(grams)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        i, j = np.searchsorted(column, (lo, lo + 4096))
        x = np.zeros((len(grams), 4096), np.float32)
        x[owner[i:j], column[i:j] - lo] = 1.0
        total += x @ x.T
    return total[left, right].astype(np.int64)


def near_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, trees: int = 16, longest: int = 8,
                 recall: float = 0.999, block: int = 256, id_col: str = "doc_id", text_col: str = "text",
                 broadcast_rows: int = 500_000) -> DataFrame:
    """Classes of near copies, one row per distinct (id, text): ``id, h, rows, class_id,
    n_links, keep``.

    ``h`` is the md5 of the text, ``rows`` how many input rows have this id and text,
    ``class_id`` the smallest id reachable over links (equal texts, or a Jaccard index of the
    word n-grams of at least ``threshold``), ``n_links`` the number of other rows linked
    directly, ``keep`` true for one row of each class: the smallest id (null last), then the
    smallest h. A null text is empty; texts without a word are linked to equal texts only; null
    ids take part, and a class of null ids has a null class_id; other columns are ignored; an
    empty table gives no row.

    Equal texts are never expanded. Subtrees of more than ``block`` classes are compared block
    against block, each pair of blocks in its own group; pairs stay inside the tasks, which give
    one row per class and block. Texts are read twice; the second pass keeps only classes with
    an open pair (their list is broadcast up to ``broadcast_rows`` rows, else joined by a shuffle).
    """
    spark = docs.sparkSession
    depth = deepest = start_depth(threshold, trees, recall, longest)
    draw = np.random.default_rng(20)
    a = draw.integers(1, 2 ** 63, trees * deepest, dtype=np.uint64) | np.uint64(1)
    b = draw.integers(0, 2 ** 63, trees * deepest, dtype=np.uint64)
    text = text_or_empty(docs[text_col])
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.md5(F.encode(text, "UTF-8")).alias("h"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 2):
                grams = shingles(part.column(2).to_pylist(), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(g) for g in grams], pa.int64()),
                     pa.array([signature(g, a, b).tobytes() for g in grams], pa.binary())],
                    names=["id", "h", "size", "sig"])

    signed = cut_lineage(rows.mapInArrow(trimmed(sign), "id long, h string, size long, sig binary"))
    classes = signed.groupBy("h").agg(F.count("*").alias("copies"), F.first("size").alias("size"),
                                      F.first("sig").alias("sig"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    each = cut_lineage(signed.groupBy("id", "h").agg(F.count("*").alias("rows")))
    release_tables(signed)
    while True:
        links, found, expected = _links(spark, rows, classes, n, threshold, trees, depth, deepest, block, broadcast_rows)
        if depth == 1 or not expected or found / expected >= recall:
            break
        depth -= 1
    label = cut_lineage(connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    own = (classes.select("h", "node", "copies").join(n_links, "node", "left").join(label, "node", "left")
           .select("h", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "node").alias("label")))
    own = cut_lineage(own)
    release_tables(classes, label, links)
    named = cut_lineage(each.join(own, "h"))
    release_tables(each, own)
    each = named
    first = (each.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("first"),
                                       F.min("id").alias("class_id")))
    first = cut_lineage(first)
    return (each.join(first, "label")
            .select("id", "h", "rows", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"),
                    (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))).alias("keep")))


def _links(spark, rows: DataFrame, classes: DataFrame, n: int, threshold: float, trees: int, depth: int, deepest: int,
           block: int, broadcast_rows: int) -> tuple[DataFrame, float, float]:
    """``node, links, root`` of the classes with a link, and the recall's two sums."""
    width = 4 * deepest
    prefix = [F.xxhash64(F.lit(t), F.substring("sig", t * width + 1, 4 * depth)) for t in range(trees)]
    keyed = classes.filter("size > 0").select("node", "h", "copies", F.array(*prefix).alias("keys"))
    tries = keyed.select("node", F.posexplode("keys").alias("tree", "key"))
    full = cut_lineage(tries.groupBy("tree", "key").agg(F.count("*").alias("m")).filter("m > 1"))
    members = tries.join(full, ["tree", "key"])
    n_blocks = F.ceil(F.col("m") / block).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    members = members.select("tree", "key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                             "block", "node")
    members = cut_lineage(members)
    release_tables(full)
    key_of = cut_lineage(keyed.join(members.select("node").distinct(), "node", "left_semi"))
    place = ["tree", "key", "bi", "bj"]
    parts = parallelism(spark)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(parts, *place).sortWithinPartitions(*place, "node")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 4):
            if table.num_rows > 1:
                left, right = _open_pairs(table, trees)
                if len(left):
                    yield from table.take(np.unique(np.concatenate([left, right]))).drop(["keys"]).combine_chunks().to_batches()

    kind = "tree int, key long, bi int, bj int, block int, node long"
    work = members.join(key_of.select("node", "keys"), "node").select(*place, "block", "node", "keys")
    work = cut_lineage(dealt(work).mapInArrow(trimmed(find), kind))
    release_tables(members)

    needed = cut_lineage(key_of.join(work.select("node").distinct(), "node", "left_semi"))
    release_tables(key_of)
    small = needed.select("h", "node")
    small = F.broadcast(small) if needed.count() <= broadcast_rows else small

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([packed_grams(g) for g in shingles(part.column(1).to_pylist(), n)], pa.binary())],
                    names=["node", "grams"])

    texts = rows.select("h", "text").join(small, "h").select("node", "text")
    grams = texts.mapInArrow(trimmed(gram), "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    payload = cut_lineage(needed.select("node", "copies", "keys").join(grams, "node"))
    release_tables(needed)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 4):
            left, right = _open_pairs(table, trees)
            sets = [unpacked_grams(g.as_py()) for g in table.column("grams")]
            size = np.array([len(s) for s in sets])
            able = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right]) - 1e-9
            left, right = left[able], right[able]
            if not len(left):
                continue
            both = _common(sets, left, right)
            j = both / (size[left] + size[right] - both)
            near = j >= threshold - 1e-12
            left, right, weight = left[near], right[near], 1.0 / caught(j[near], depth, trees)
            if not len(left):
                continue
            m, copies = len(sets), np.asarray(table.column("copies"))
            add = lambda at, w: np.bincount(at, weights=w, minlength=m)
            links = add(left, copies[right]) + add(right, copies[left])
            hit = np.flatnonzero(links)
            node = np.asarray(table.column("node"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[hit]), pa.array(links[hit].astype(np.int64)), pa.array(node[roots(m, left, right)[hit]]),
                 pa.array(add(left, np.ones(len(left)))[hit]), pa.array(add(left, weight)[hit])],
                names=["node", "links", "root", "found", "expected"])

    check = work.join(payload, "node").select(*place, "block", "node", "keys", "copies", "grams")
    links = cut_lineage(dealt(check).mapInArrow(trimmed(verify), "node long, links long, root long, found double, expected double"))
    release_tables(work, payload)
    sums = links.agg(F.sum("found").alias("f"), F.sum("expected").alias("e")).first()
    return links, sums["f"] or 0.0, sums["e"] or 0.0


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 500_000,
             **options) -> DataFrame:
    """The rows of ``docs`` with all columns, one row of each class of near copies."""
    near = cut_lineage(near_classes(docs, id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows, **options))
    gone = near.filter(~F.col("keep")).select(F.col("id").alias("__id"), F.col("h").alias("__h"))
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    h = F.md5(F.encode(text_or_empty(docs[text_col]), "UTF-8"))
    kept = docs.join(gone, docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (h == F.col("__h")), "left_anti")
    if not near.filter("keep AND rows > 1").limit(1).count():
        return kept
    names = [f"__{i}" for i in range(len(docs.columns))]            # repeated rows: any one of them
    kept = kept.toDF(*names).withColumn("__h", F.md5(F.encode(text_or_empty(names[docs.columns.index(text_col)]), "UTF-8")))
    kept = kept.dropDuplicates([names[docs.columns.index(id_col)], "__h"]).drop("__h")
    return kept.toDF(*docs.columns)
