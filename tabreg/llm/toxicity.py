"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Training texts choose the terms whose document counts differ between the labels; examples are
indexed by those terms in blocks, each posting list with the largest weight per block. A text's
nearest examples are found block by block, in the order of the bound that the block maxima give,
until no block left can hold a nearer one, so the result is exact. The nearest examples vote
with their cosine; an isotonic fit on the training texts' votes (no text votes on itself) turns
the vote into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, text_or_empty, trimmed

WORD = re.compile(r"\w+")
BINS = 1000


@dataclass
class Settings:
    """``examples``: bound on the examples per label (in the order of a hash of the text);
    ``terms``: bound on the vocabulary, ``least_g2``: likelihood ratio a term must reach;
    ``prior``: weight of the vote "not toxic" that every text gets besides its neighbours;
    ``broadcast_rows``: up to so many labels are broadcast, more are joined by a shuffle."""

    examples: int = 4000
    terms: int = 512
    least_g2: float = 30.0
    least_docs: int = 3
    neighbours: int = 15
    block: int = 64
    prior: float = 0.5
    broadcast_rows: int = 1_000_000


@dataclass
class BlockMaxIndex:
    """Posting lists by term over examples in blocks, with block maxima."""

    block: int
    hashes: list[str]
    ids: np.ndarray
    labels: np.ndarray
    postings: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    places: dict[str, list[int]] = field(default_factory=dict)

    @classmethod
    def build(cls, vectors: list[dict[int, float]], hashes, ids, labels, block: int) -> BlockMaxIndex:
        """Examples are put in the order of their heaviest term, so blocks are alike inside."""
        order = sorted(range(len(vectors)), key=lambda i: (max(vectors[i], key=lambda t: (vectors[i][t], -t)), hashes[i]))
        index = cls(block, [hashes[i] for i in order], np.array([ids[i] for i in order], dtype=object),
                    np.array([labels[i] for i in order], dtype=float))
        for at, h in enumerate(index.hashes):
            index.places.setdefault(h, []).append(at)
        lists: dict[int, tuple[list[int], list[float]]] = {}
        for at, i in enumerate(order):
            for t, w in vectors[i].items():
                where, weight = lists.setdefault(t, ([], []))
                where.append(at)
                weight.append(w)
        for t, (where, weight) in lists.items():
            at, w = np.array(where), np.array(weight)
            blocks, first = np.unique(at // block, return_index=True)
            index.postings[t] = at, w
            index.bounds[t] = blocks, np.maximum.reduceat(w, first)
        return index

    def nearest(self, query: dict[int, float], k: int, not_hash: str | None = None) -> list[tuple[float, int]]:
        """The k examples of the largest cosine above 0, as (cosine, place); ties to the first place."""
        terms = [t for t in query if t in self.postings]
        if not terms:
            return []
        bound = np.zeros(-(-len(self.hashes) // self.block))
        for t in terms:
            blocks, most = self.bounds[t]
            bound[blocks] += query[t] * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        first = order[:-(-k // self.block)]                   # the most promising blocks set the bar
        at = np.concatenate([self.postings[t][0] for t in terms])
        w = np.concatenate([query[t] * self.postings[t][1] for t in terms])
        found = self._best(at, w, first, k, not_hash)
        rest = order[len(first):]
        if len(found) >= k:
            rest = rest[bound[rest] >= found[k - 1][0] - 1e-12]
        return sorted(found + self._best(at, w, rest, k, not_hash), key=lambda x: (-x[0], x[1]))[:k]

    def _best(self, at: np.ndarray, w: np.ndarray, blocks: np.ndarray, k: int,
              not_hash: str | None) -> list[tuple[float, int]]:
        """The best k of the examples in the blocks, from the query's postings that lie in them."""
        if not len(blocks):
            return []
        chosen = np.zeros(-(-len(self.hashes) // self.block), bool)
        chosen[blocks] = True
        if not chosen.all():
            use = np.repeat(chosen, self.block)[at]
            at, w = at[use], w[use]
        score = np.bincount(at, weights=w, minlength=len(self.hashes))
        if not_hash is not None:
            score[self.places.get(not_hash, [])] = 0.0
        places = np.flatnonzero(score > 0)
        if len(places) > k:                                   # all that reach the k-th score, ties included
            places = places[score[places] >= np.partition(score[places], len(places) - k)[len(places) - k]]
        places = places[np.lexsort((places, -score[places]))]
        return [(float(score[p]), int(p)) for p in places[:k]]


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    settings: Settings
    calibrated: np.ndarray = field(default_factory=lambda: np.arange(BINS + 1) / BINS)

    def vector(self, text: str) -> dict[int, float]:
        known = self.terms
        counts = Counter(known[w] for w in WORD.findall(text.lower()) if w in known)
        weights = {t: (1.0 + np.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = sum(w * w for w in weights.values()) ** 0.5
        return {t: w / norm for t, w in weights.items()}

    def vote(self, text: str, not_hash: str | None = None) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(self.vector(text), self.settings.neighbours, not_hash)
        total = sum(s for s, _ in near)
        return sum(s * self.index.labels[i] for s, i in near) / (total + self.settings.prior), near

    def score(self, vote: float) -> float:
        return float(self.calibrated[int(round(vote * BINS))])


def in_training(id_: Column) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text leaves 0 or 2 modulo 3."""
    return F.coalesce(F.crc32(F.encode(id_.cast("string"), "UTF-8")) % 3 != 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, settings: Settings, id_col: str, text_col: str,
                   label_col: str) -> DataFrame:
    """Labelled training texts, each distinct text once: ``id, h, toxic, text``. Labels other
    than 0 and 1 are ignored; of several labels of an id or text the larger counts."""
    y = (labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("toxic"))
         .filter(F.col("toxic").isin(0, 1) & in_training(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic")))
    y = cut_lineage(y)
    y = F.broadcast(y) if y.count() <= settings.broadcast_rows else y
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    rows = rows.filter(in_training(F.col("id"))).join(y, "id")
    rows = rows.withColumn("h", F.md5(F.encode("text", "UTF-8")))
    best = rows.groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id"), F.first("text").alias("text"))
    return cut_lineage(best.select("id", "h", "toxic", "text"))


def term_counts(train: DataFrame) -> DataFrame:
    """Document counts by label of every term of the training texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = (Counter(), Counter())
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                n[y].update(set(WORD.findall(text.as_py().lower())))
            words = list(n[0] | n[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())] + [pa.array([n[y][w] for w in words], pa.int64()) for y in (0, 1)],
                names=["term", "n0", "n1"])

    each = train.select("text", "toxic").mapInArrow(trimmed(count), "term string, n0 long, n1 long")
    return each.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn terms, examples and calibration from the labelled training rows.

    Term and document counts cover all training texts; the driver holds at most ``terms``
    terms, ``2 * examples`` example vectors and ``BINS + 1`` vote counts. Without labels, or
    without a telling term, every text gets the share of toxic training texts (0 if none).
    """
    train = training_texts(docs, labels, settings, id_col, text_col, label_col)
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    if not n0 or not n1:
        share = 1.0 if n1 else 0.0
        empty = BlockMaxIndex(settings.block, [], np.array([]), np.array([]))
        return Model({}, np.zeros(0), empty, settings, np.full(BINS + 1, share))
    a, b = F.col("n1"), F.col("n0")
    share = (a + b) / F.lit(n0 + n1)
    part = lambda seen, expected: F.when(seen > 0, 2 * seen * F.ln(seen / expected)).otherwise(F.lit(0.0))
    g2 = (part(a, share * n1) + part(b, share * n0) + part(F.lit(n1) - a, (1 - share) * n1)
          + part(F.lit(n0) - b, (1 - share) * n0))
    telling = (term_counts(train).filter((a + b >= settings.least_docs) & (a + b < n0 + n1)).withColumn("g2", g2)
               .filter(F.col("g2") >= settings.least_g2).orderBy(F.desc("g2"), "term").limit(settings.terms).collect())
    terms = {r["term"]: i for i, r in enumerate(telling)}
    idf = np.array([np.log((n0 + n1 + 1) / (r["n0"] + r["n1"] + 1)) + 1 for r in telling])
    empty = BlockMaxIndex(settings.block, [], np.array([]), np.array([]))
    model = Model(terms, idf, empty, settings)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(i, h, y, v) for i, h, y, t in zip(*(c.to_pylist() for c in batch.columns)) if (v := model.vector(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.int32()), pa.array([list(g[3]) for g in got], pa.list_(pa.int32())),
                 pa.array([list(g[3].values()) for g in got], pa.list_(pa.float64()))],
                names=["id", "h", "toxic", "t", "w"])

    found = train.select("id", "h", "toxic", "text").mapInArrow(trimmed(vectors), "id long, h string, toxic int, t array<int>, w array<double>")
    found = cut_lineage(found)
    rows = [r for y in (0, 1) for r in found.filter(F.col("toxic") == y).orderBy("h").limit(settings.examples).collect()]
    model.index = BlockMaxIndex.build([dict(zip(r["t"], r["w"])) for r in rows], [r["h"] for r in rows],
                                      [r["id"] for r in rows], [r["toxic"] for r in rows], settings.block)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = [round(model.vote(t, h)[0] * BINS) for h, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32()), batch.column(1)], names=["vote", "toxic"])

    counted = (train.select("h", "toxic", "text").mapInArrow(trimmed(votes), "vote int, toxic int")
               .groupBy("vote").agg(F.count("*").alias("n"), F.sum("toxic").alias("s")).collect())
    model.calibrated = isotonic({r["vote"]: (r["n"], r["s"]) for r in counted})
    return model


def isotonic(counts: dict[int, tuple[int, int]]) -> np.ndarray:
    """Rising step function through the shares of toxic votes per bin (pooling violators);
    bins without a vote take the value of the nearest bin below, or the first."""
    pools: list[list[float]] = []                      # first bin, texts, toxic texts
    for v in sorted(counts):
        pools.append([v, *map(float, counts[v])])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1][1] += last[1]
            pools[-1][2] += last[2]
    out = np.zeros(BINS + 1)
    for i, (v, n, s) in enumerate(pools):
        out[0 if i == 0 else int(v):] = s / n
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, evidence`` of every whole text, one row per input row; evidence lists
    the nearest examples (id, cosine, label). A null text is empty: it has no neighbour and gets
    the calibrated score of the vote 0. Null ids stay, other columns are ignored. One pass
    without a shuffle; the model goes to the tasks with the function (its size is bounded)."""
    kind = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = [], []
            for text in batch.column(1):
                vote, near = model.vote(text.as_py())
                scores.append(model.score(vote))
                evidence.append([{"id": model.index.ids[i], "cosine": s, "toxic": int(model.index.labels[i])}
                                 for s, i in near])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                                             names=[id_col, "score", "evidence"])

    rows = docs.select(docs[id_col].cast("long").alias(id_col), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(trimmed(each), f"`{id_col}` long, score double, "
                                 "evidence array<struct<id:long,cosine:double,toxic:int>>")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below the threshold, with all columns as they are."""
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(model.vote(t.as_py() or "")[0]) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(trimmed(each), docs.schema)
