"""Exact ranked lexical search of an item table against a document table by dual trees.

Documents and items are sparse vectors over the items' terms: a document's coordinate is its
integer share of the term (frequency damped by the document's length), an item's is the term's
weight times its repeats, and the score is the inner product. Every task builds a hierarchy
over a block of its documents, whose nodes hold the largest value of every coordinate below
them; a hierarchy over the items does the same. A pair of nodes is bounded by the inner product
of its maxima, as no coordinate is negative. The traversal starts at the two roots and drops a
pair whose bound cannot displace the weakest k-th result of the node's items; what is left at
the leaves is scored. Each task ends with the k best documents of every item, and two stages of
ranking join them.

Integers stay exact: below 2^53 the products run in doubles, which then hold every partial sum,
else in 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, parallelism, text_or_empty

#: Bytes of UTF-8 outside terms become spaces, ASCII capitals small letters.
TERM_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() and not 0x41 <= b <= 0x5A else b + 32 if 0x41 <= b <= 0x5A else 32
                   for b in range(256))
K = 20
CELLS = 2_000_000        # of a dense block: documents (or items) times distinct item terms
ITEM_LEAF, DOC_LEAF = 8, 8
EXACT = 2.0 ** 53


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order, with repeats."""
    return text.translate(TERM_BYTES).split()


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, Counter]]]:
    """Items in blocks whose dense matrix (items x distinct terms) stays below ``CELLS``; an item
    that is larger on its own is a block of its own. The driver holds one block at a time."""
    block, vocabulary = [], set()
    for item, text in items.select(items[item_col].cast("long"), text_or_empty(items[text_col]).cast("binary")).toLocalIterator():
        counts = Counter(terms_of(bytes(text)))
        if not counts:
            continue
        if block and (len(block) + 1) * len(vocabulary | counts.keys()) > CELLS:
            yield block
            block, vocabulary = [], set()
        block.append((item, counts))
        vocabulary |= counts.keys()
    if block:
        yield block


def item_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms array<int>, tfs array<int>`` of every whole text: number of all its terms,
    and places and frequencies of those in ``vocabulary``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.get
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                counts = Counter(map(place, words))
                counts.pop(None, None)
                n.append(len(words))
                terms += counts.keys()
                tfs += counts.values()
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def document_frequencies(vectors: DataFrame, size: int) -> dict[int, int]:
    """Documents holding each of the ``size`` terms, summed in every task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], names=["term", "df"])

    found = vectors.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df"))
    return dict(map(tuple, found.collect()))


def damped(tf: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """Coordinates of term frequencies in documents of ``n`` terms, in whole numbers."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        m = np.array([75 + 25 * int(x) * documents // all_terms for x in n], np.int64)
    else:
        m = 75 + 25 * n * documents // all_terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class MaxTree:
    """A hierarchy over the rows of a matrix without negative entries. Nodes are runs of
    ``order``; ``top`` holds the largest value of every coordinate in the node. A node is split
    around two of its rows that point apart, where the split leaves an eighth on either side, else
    at the median between them. ``scale`` weighs the coordinates for the splits alone."""

    def __init__(self, rows: np.ndarray, leaf: int, scale: np.ndarray | None = None):
        self.order = np.arange(len(rows))
        self.lo, self.hi, self.kids, self.top = [], [], [], []
        points = rows.astype(np.float64) if scale is None else rows * scale.astype(np.float64)
        points /= np.maximum(np.sqrt(np.einsum("ij,ij->i", points, points)), 1e-300)[:, None]
        self._node(rows, points, 0, len(rows), leaf)
        self.top = np.array(self.top)

    def _node(self, rows: np.ndarray, points: np.ndarray, lo: int, hi: int, leaf: int) -> int:
        me = len(self.lo)
        held = self.order[lo:hi]
        self.lo.append(lo)
        self.hi.append(hi)
        self.top.append(rows[held].max(axis=0))
        self.kids.append(())
        if hi - lo > leaf:
            inside = points[held]
            one = inside[(inside @ inside.sum(axis=0)).argmin()]       # the row farthest from the middle
            two = inside[(inside @ one).argmin()]
            side = inside @ (two - one)
            near = side < 0
            for _ in range(2):                                         # two steps of 2-means
                if near.all() or not near.any():
                    break
                side = inside @ (inside[~near].mean(axis=0) - inside[near].mean(axis=0))
                side -= (side[near].mean() + side[~near].mean()) / 2
                near = side < 0
            by_side = np.argsort(side, kind="stable")
            self.order[lo:hi] = held[by_side]
            cut = int(near.sum())
            mid = lo + (cut if (hi - lo) // 8 < cut < (hi - lo) - (hi - lo) // 8 else (hi - lo) // 2)
            self.kids[me] = (self._node(rows, points, lo, mid, leaf), self._node(rows, points, mid, hi, leaf))
        return me


class Search:
    """The ``k`` best documents of every item so far: ``score`` and ``id`` by item, best first;
    a score of 0 is an empty place."""

    def __init__(self, weights: np.ndarray, k: int):
        self.items = MaxTree(weights, ITEM_LEAF)
        self.weights = weights[self.items.order]
        self.k = k
        self.score = np.zeros((len(weights), k), weights.dtype)
        self.id = np.full((len(weights), k), np.iinfo(np.int64).max)
        self.scored = 0

    def block(self, rows: np.ndarray, ids: np.ndarray) -> None:
        """Search the documents with these coordinates and ids."""
        if not len(rows):
            return
        tree = MaxTree(rows, DOC_LEAF, self.items.top[0])
        rows, ids = rows[tree.order], ids[tree.order]
        items, least = self.items, [ids[lo:hi].min() for lo, hi in zip(tree.lo, tree.hi)]
        stack = [(0, 0, items.top[0] @ tree.top[0])]
        while stack:
            i, d, bound = stack.pop()
            lo, hi = items.lo[i], items.hi[i]
            weakest = self.score[lo:hi, -1].min()
            if bound < weakest or bound <= 0 or (bound == weakest and least[d] > self.id[lo:hi, -1].max()):
                continue
            left, right = items.kids[i], tree.kids[d]
            if not left and not right:
                self._leaves(lo, hi, rows[tree.lo[d]:tree.hi[d]], ids[tree.lo[d]:tree.hi[d]])
            elif not left or (right and tree.hi[d] - tree.lo[d] >= hi - lo):
                bounds = tree.top[list(right)] @ items.top[i]
                stack += [(i, right[j], bounds[j]) for j in np.argsort(bounds)]     # the best one on top
            else:
                bounds = items.top[list(left)] @ tree.top[d]
                stack += [(left[j], d, bounds[j]) for j in np.argsort(bounds)]

    def _leaves(self, lo: int, hi: int, rows: np.ndarray, ids: np.ndarray) -> None:
        scores = self.weights[lo:hi] @ rows.T
        self.scored += scores.size
        worst, last = self.score[lo:hi, -1:], self.id[lo:hi, -1:]
        better = (scores > worst) | ((scores == worst) & (scores > 0) & (ids[None, :] < last))
        for at in np.flatnonzero(better.any(axis=1)):
            new = better[at]
            score = np.concatenate([self.score[lo + at], scores[at, new]])
            id_ = np.concatenate([self.id[lo + at], ids[new]])
            best = np.lexsort((id_, -score))[:self.k]
            self.score[lo + at], self.id[lo + at] = score[best], id_[best]

    def results(self) -> Iterator[tuple[int, int, int]]:
        """(place of the item, id, score) of all results."""
        for at, place in enumerate(self.items.order):
            for score, id_ in zip(self.score[at], self.id[at]):
                if score > 0:
                    yield int(place), int(id_), int(score)


def best_in_tasks(vectors: DataFrame, weights: np.ndarray, documents: int, all_terms: int, k: int) -> DataFrame:
    """``place, id, score, task``: every task's ``k`` best documents of every item."""
    size = weights.shape[1]
    width = max(1, CELLS // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        search = Search(weights, k)
        for batch in batches:
            ids, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            offsets = np.asarray(batch.column(2).offsets)
            terms, tfs = (batch.column(c).values.to_numpy() for c in (2, 3))
            for lo in range(0, len(ids), width):
                hi = min(lo + width, len(ids))
                cut, counts = slice(offsets[lo], offsets[hi]), np.diff(offsets[lo:hi + 1])
                rows = np.zeros((hi - lo, size), weights.dtype)
                of = np.repeat(np.arange(hi - lo), counts)
                rows[of, terms[cut]] = damped(tfs[cut].astype(np.int64), n[lo:hi][of], documents, all_terms)
                search.block(rows, ids[lo:hi])
        places, ids, scores = map(list, zip(*found)) if (found := list(search.results())) else ([], [], [])
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64()),
                                          pa.array([task] * len(ids), pa.int32())], names=["place", "id", "score", "task"])

    return vectors.mapInArrow(run, "place int, id long, score long, task int")


def search_block(docs: DataFrame, block: list[tuple[int, Counter]], k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))))}
    vectors = cut_lineage(item_vectors(docs, vocabulary, id_col, text_col))
    documents, all_terms = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(vectors, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))]
    dense = np.zeros((len(block), len(vocabulary)), np.int64)
    for row, (_, counts) in enumerate(block):
        for term, n in counts.items():
            dense[row, vocabulary[term]] = n * weight[vocabulary[term]]
    if 1_000_000 * float(dense.max(axis=0).sum()) < EXACT:       # no coordinate reaches a million
        dense = dense.astype(np.float64)
    held = vectors.filter(F.size("terms") > 0).withColumn("id", F.coalesce("id", F.lit((1 << 63) - 1)))
    found = best_in_tasks(held, dense, documents, all_terms, k)
    salts = max(1, math.isqrt(parallelism(spark)))
    order = [F.col("score").desc(), F.col("id").asc()]
    first = (found.withColumn("salt", F.col("task") % salts)
             .withColumn("rank", F.row_number().over(Window.partitionBy("place", "salt").orderBy(*order)))
             .filter(F.col("rank") <= k))
    ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order)))
              .filter(F.col("rank") <= k))
    items = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "place int, item_id long")
    return ranked.join(items, "place").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, id_col, score``: the ``k`` best documents of every item, all documents
    searched; equal scores by ascending id.

    Null and empty texts have no terms, so such a document is no result (nor part of the counts)
    and such an item has none. A null document id counts and is returned as the largest id,
    2^63 - 1; a repeated document row is a result of its own, a repeated item row repeats its
    results. Whole texts of any length; other columns are ignored whatever their names; an empty
    table on either side gives no rows."""
    found = None
    for block in item_blocks(items, item_col, item_text_col):
        part = cut_lineage(search_block(docs, block, k, id_col, text_col))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item_id long, rank int, `{id_col}` long, score long")
    return found


def sql(k: int = K) -> str:
    """DuckDB SQL of ``search`` over documents and benchmark."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT doc_id, {terms} AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS nd, sum(len(terms))::BIGINT AS al FROM d),
m AS (SELECT doc_id, terms, 75 + (25 * len(terms) * nd) // al AS m FROM d, s WHERE len(terms) > 0),
q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
f AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(terms) AS term FROM m)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term),
r AS (SELECT item_id, doc_id, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term) GROUP BY item_id, doc_id HAVING score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= {k}"""
