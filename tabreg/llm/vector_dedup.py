"""Near copies among embeddings: a navigable small-world graph per shard, exact verification.

Vectors of a label are dealt to shards of bounded size; every shard builds a hierarchical
graph. Each shard's vectors query every shard of their label. A search walks the graph from its
entry with a beam and goes on while what it meets is near the threshold; an audit compares a
stated number of queries per pair of shards with a full scan, and the beam is doubled until the
audit's recall is reached (a beam as wide as the shard that still fails is replaced by the scan).
Links are verified by the cosine in double precision.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, parallelism
from tabreg.llm.components import connected_components, roots


class SmallWorld:
    """Hierarchical navigable small-world graph over unit vectors, by cosine."""

    def __init__(self, vectors: np.ndarray, links: list[dict[int, list[int]]], entry: int, degree: int):
        self.v, self.links, self.entry, self.degree = vectors, links, entry, degree

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 12, beam: int = 48, seed: int = 7) -> SmallWorld:
        n = len(vectors)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int)
        graph = cls(vectors, [{} for _ in range(int(level.max()) + 1 if n else 1)], 0, degree)
        if n:
            top = int(level[0])
            for k in range(top + 1):
                graph.links[k][0] = []
        for i in range(1, n):
            q, at = vectors[i], [graph.entry]
            for k in range(top, int(level[i]), -1):
                at = [graph.search(q, at, 1, k)[0][1]]
            for k in range(min(top, int(level[i])), -1, -1):
                near = graph.search(q, at, beam, k)
                at = [j for _, j in near]
                graph.links[k][i] = graph._spread([j for _, j in near], degree, [s for s, _ in near])
                for j in graph.links[k][i]:
                    back = graph.links[k][j]
                    back.append(i)
                    most = degree * (2 if k == 0 else 1)
                    if len(back) > most + degree // 2:        # pruned now and then, not on every edge
                        sims = vectors[back] @ vectors[j]
                        order = np.argsort(-sims, kind="stable")
                        graph.links[k][j] = graph._spread([back[o] for o in order], most, sims[order])
            for k in range(top + 1, int(level[i]) + 1):
                graph.links[k][i] = []
            if level[i] > top:
                top, graph.entry = int(level[i]), i
        return graph

    def _spread(self, near: list[int], most: int, sims) -> list[int]:
        """Neighbours in different directions: nearest first, each nearer to the point than to
        those taken; the rest fills up the list."""
        if len(near) <= most:
            return list(near)
        own = self.v[near] @ self.v[near].T
        taken: list[int] = []
        rest: list[int] = []
        cover = np.full(len(near), -2.0)
        for p in range(len(near)):
            if cover[p] < sims[p]:
                taken.append(p)
                if len(taken) == most:
                    break
                np.maximum(cover, own[p], out=cover)
            else:
                rest.append(p)
        return [near[p] for p in taken + rest[:most - len(taken)]]

    def search(self, q: np.ndarray, at: list[int], beam: int, layer: int, reach: float = 2.0) -> list[tuple[float, int]]:
        """The best ``beam`` points found, and all found at ``reach`` or more, best first."""
        links, v = self.links[layer], self.v
        seen = set(at)
        first = list(zip((v[at] @ q).tolist(), at))
        todo = [(-s, j) for s, j in first]
        heapq.heapify(todo)
        best = first[:]
        heapq.heapify(best)
        far: list[tuple[float, int]] = []                    # near ones that the beam has dropped
        while len(best) > beam:
            far.append(heapq.heappop(best))
        while todo:
            s, j = heapq.heappop(todo)
            if len(best) >= beam and -s < best[0][0] and -s < reach:
                break
            new = [x for x in links[j] if x not in seen]
            if not new:
                continue
            seen.update(new)
            for s, x in zip((v[new] @ q).tolist(), new):
                if len(best) < beam:
                    heapq.heappush(best, (s, x))
                    heapq.heappush(todo, (-s, x))
                elif s > best[0][0]:
                    out = heapq.heappushpop(best, (s, x))
                    if out[0] >= reach:
                        far.append(out)
                    heapq.heappush(todo, (-s, x))
                elif s >= reach:
                    far.append((s, x))
                    heapq.heappush(todo, (-s, x))
        return sorted(best + [f for f in far if f[0] >= reach], reverse=True)

    def near(self, q: np.ndarray, threshold: float, beam: int, slack: float = 0.01, own: int | None = None) -> list[int]:
        """Points of cosine ``threshold`` or more that a beam search finds."""
        at = [self.entry]
        for k in range(len(self.links) - 1, 0, -1):
            at = [self.search(q, at, 1, k)[0][1]]
        if own is not None and own not in at:
            at.append(own)
        return [j for s, j in self.search(q, at, beam, 0, threshold - slack) if s >= threshold]

    def to_bytes(self) -> bytes:
        arrays = {"v": self.v, "head": np.array([self.entry, self.degree, len(self.links)])}
        for k, layer in enumerate(self.links):
            nodes = np.array(sorted(layer), dtype=np.int32)
            arrays[f"n{k}"] = nodes
            arrays[f"c{k}"] = np.array([len(layer[i]) for i in nodes], dtype=np.int32)
            arrays[f"l{k}"] = np.array([j for i in nodes for j in layer[i]], dtype=np.int32)
        out = io.BytesIO()
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> SmallWorld:
        z = np.load(io.BytesIO(raw), allow_pickle=False)
        entry, degree, layers = (int(x) for x in z["head"])
        links = []
        for k in range(layers):
            ends = np.cumsum(z[f"c{k}"])
            flat = z[f"l{k}"].tolist()
            links.append({i: flat[e - c:e] for i, c, e in zip(z[f"n{k}"].tolist(), z[f"c{k}"].tolist(), ends.tolist())})
        return cls(z["v"], links, entry, degree)


def audited_pairs(graph: SmallWorld, queries: np.ndarray, threshold: float, beam: int, audit: int, recall: float,
                  same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs at the threshold or above; the beam widens until the audit passes."""
    n = len(graph.v)
    sample = np.unique(np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int)) if len(queries) else []
    own = lambda i: i if same else None
    truth = {i: set(np.flatnonzero(graph.v @ queries[i] >= threshold).tolist()) for i in sample}
    total = sum(map(len, truth.values()))
    while True:
        hit = sum(len(truth[i] & set(graph.near(queries[i], threshold, beam, own=own(i)))) for i in sample)
        if hit >= recall * total or beam >= n:
            break
        beam = min(n, beam * 2)
    if hit < recall * total:                                   # the graph leaves points out of reach
        parts = [np.nonzero(queries[lo:lo + 256] @ graph.v.T >= threshold) for lo in range(0, len(queries), 256)]
        return (np.concatenate([p[0] + 256 * k for k, p in enumerate(parts)]), np.concatenate([p[1] for p in parts]))
    left, right = [], []
    for i, q in enumerate(queries):
        found = graph.near(q, threshold, beam, own=own(i))
        left += [i] * len(found)
        right += found
    return np.array(left, np.int64), np.array(right, np.int64)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, capacity: int = 8192, degree: int = 12, beam: int = 48,
                 audit: int = 64, recall: float = 0.999, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", broadcast_rows: int = 500_000) -> DataFrame:
    """``id_col, n_links, component_id, kept``, one row per input row.

    Rows link when their labels are equal and not null, their vectors have the same length and
    their cosine is at least ``threshold``. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, link with nothing (``n_links`` 0, the
    component is the row's own id, ``kept`` true). Equal vectors of a label are indexed once and
    counted; repeated rows are separate rows that link with each other. Other columns are
    ignored; an empty table gives no row. A pair of shards is one task's work and gives one row
    per vector class; a shard holds at most about ``capacity`` vectors.
    """
    spark = vectors.sparkSession
    raw = vectors[vector_col].cast("array<double>")
    v = F.transform(raw, lambda x: x + F.lit(0.0))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    able = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
            & F.exists("v", lambda x: x != 0))
    key = F.md5(F.concat_ws(",", F.col("v").cast("array<string>")))
    rows = cut_lineage(rows.select("id", "label", F.when(able, F.col("v")).alias("v"), F.when(able, key).alias("h")))
    classes = (rows.filter("h IS NOT NULL").groupBy("label", "h").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")))
    classes = cut_lineage(classes.withColumn("dim", F.size("v")).withColumn("node", F.monotonically_increasing_id()))
    counts = cut_lineage(classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / capacity).cast("int").alias("shards")))
    few = counts.count() <= broadcast_rows
    dealt = (classes.join(F.broadcast(counts) if few else counts, ["label", "dim"])
             .withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")))

    def index(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        x = np.asarray(table.column("v").combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)
        x = x / np.abs(x).max(axis=1, keepdims=True)          # keeps tiny and huge vectors in range
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        graph = SmallWorld.build(x, degree, beam)
        return pa.table([pa.array([table.column("grp")[0].as_py()], pa.int64()), pa.array([table.column("shard")[0].as_py()], pa.int32()),
                         pa.array([np.asarray(table.column("node")).tobytes()], pa.binary()),
                         pa.array([np.asarray(table.column("copies")).tobytes()], pa.binary()),
                         pa.array([graph.to_bytes()], pa.binary())], names=["grp", "shard", "nodes", "copies", "graph"])

    group = F.xxhash64("label", "dim").alias("grp")           # labels that collide only share queries of one length
    graphs = cut_lineage(dealt.select(group, "shard", "node", "copies", "dim", "v", "label").groupBy("label", "dim", "shard")
                         .applyInArrow(lambda t: index(t), "grp long, shard int, nodes binary, copies binary, graph binary"))
    names = graphs.select("grp", "shard")
    pairs = (names.select("grp", F.col("shard").alias("a")).join(names.select("grp", F.col("shard").alias("b")), "grp")
             .filter("a <= b"))
    side = lambda s: graphs.select("grp", F.col("shard").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("nodes", "copies", "graph")])
    work = pairs.join(side("a"), ["grp", "a"]).join(side("b"), ["grp", "b"])
    work = work.repartition(parallelism(spark), "grp", "a", "b")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}
                yield from one(row)

    def one(row: dict) -> Iterator[pa.RecordBatch]:
        same = row["a"] == row["b"]
        ga = SmallWorld.from_bytes(row["a_graph"])
        gb = ga if same else SmallWorld.from_bytes(row["b_graph"])
        na, ca = np.frombuffer(row["a_nodes"], np.int64), np.frombuffer(row["a_copies"], np.int64)
        nb, cb = np.frombuffer(row["b_nodes"], np.int64), np.frombuffer(row["b_copies"], np.int64)
        i, j = audited_pairs(gb, ga.v, threshold, beam, audit, recall, same)
        if same:
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
            i, j = i[i < j], j[i < j]
        else:
            y, x = audited_pairs(ga, gb.v, threshold, beam, audit, recall, False)
            i, j = np.concatenate([i, x]), np.concatenate([j, y])
        code = np.unique(i * len(nb) + j)                     # either direction may have found a pair
        i, j = code // max(len(nb), 1), code % max(len(nb), 1)
        node, copies = (na, ca) if same else (np.concatenate([na, nb]), np.concatenate([ca, cb]))
        j = j if same else j + len(na)
        m = len(node)
        links = np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
        hit = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[hit]), pa.array(links[hit].astype(np.int64)), pa.array(node[roots(m, i, j)[hit]])],
            names=["node", "links", "root"])

    links = cut_lineage(work.mapInArrow(link, "node long, links long, root long"))
    label = cut_lineage(connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    total = links.groupBy("node").agg(F.sum("links").alias("links"))
    own = (classes.select("label", "h", "node", "rep", "copies").join(total, "node", "left")
           .join(label.select("node", F.col("label").alias("comp")), "node", "left")
           .select("label", "h", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                   F.coalesce("comp", "node").alias("comp")))
    own = cut_lineage(own)
    first = own.groupBy("comp").agg(F.min("rep").alias("component_id"))
    own = cut_lineage(own.join(first, "comp").select("label", "h", (F.col("links") + F.col("copies") - 1).alias("n_links"),
                                                     "component_id"))
    return (rows.select("id", "label", "h").join(own, ["label", "h"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept")))
