"""Packing documents into fixed-length training sequences by cutting-stock column generation.

A document longer than a sequence is cut into whole sequences and a rest; every piece falls
into a length class. The histogram of classes (at most ``sequence / width`` rows) is all the
linear program sees: its columns are patterns (counts per class that fit one sequence),
priced by a knapsack over the class prices until no pattern improves by more than ``gap``.
Patterns are used as often as the rounded-down solution says, the few left-over pieces by
best fit, and pieces take their places by their exact rank within the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, text_or_empty
from tabreg.llm.tokens import encoder


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of items (any number of each) within the capacity, and the counts.
    ``sizes`` ascending."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            value = prices[:k] + best[c - sizes[:k]]
            i = int(value.argmax())
            if value[i] > best[c] + 1e-12:
                best[c], choice[c] = value[i], i
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[capacity]), counts


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A basic solution to start from: knapsacks over the classes still alive, at prices that
    favour long pieces, each used until a class is exhausted. In the order of exhaustion the
    patterns form a triangular table, so they are a basis; column j exhausts class j."""
    m = len(sizes)
    columns, use, left, alive = np.zeros((m, m)), np.zeros(m), demand.astype(float), np.ones(m, bool)
    prices = sizes / capacity * (1.0 + 0.2 * sizes / capacity)
    while alive.any():
        at = np.flatnonzero(alive)
        _, counts = knapsack(sizes[at], prices[at], capacity)
        pattern = np.zeros(m)
        pattern[at] = counts
        some = at[counts > 0]
        ratio = left[some] / pattern[some]
        out = some[int(ratio.argmin())]
        columns[:, out], use[out] = pattern, ratio.min()
        left = np.maximum(left - use[out] * pattern, 0.0)
        alive[out] = False
    return columns, use


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
                      max_columns: int = 600) -> list[tuple[np.ndarray, float]]:
    """Patterns with their fractional use: minimise the number of sequences so that every
    class's demand is covered. Simplex over the columns found so far, starting from a
    greedy basis. Prices are smoothed towards the best dual point seen
    (first the classes' sizes), and the search stops when the value is within ``1 + gap`` of
    the bound that the priced dual point proves, or after ``max_columns`` columns."""
    m = len(sizes)
    if not m:
        return []
    columns, use = greedy_basis(sizes, demand, capacity)
    inverse, cost = np.linalg.inv(columns), np.ones(m)
    centre, pull = sizes / capacity, 0.9
    bound = float(centre @ demand)                          # sizes are a feasible dual point
    for step in range(max_columns):
        if step % 250 == 249:                               # sheds what rounding has piled up
            inverse = np.linalg.inv(columns)
            use = np.maximum(inverse @ demand, 0.0)
        price = cost @ inverse
        value = float(cost @ use)
        if value <= bound * (1.0 + gap):
            break
        worst = int(price.argmin())
        if price[worst] < -1e-9:                            # covering more than the demand pays
            column, c = -np.eye(m)[worst], 0.0
        else:
            c, weight = 1.0, pull
            while True:
                tried = weight * centre + (1.0 - weight) * np.maximum(price, 0.0)
                worth, column = knapsack(sizes, tried, capacity)
                if (proven := float(tried @ demand) / max(worth, 1.0)) > bound:
                    bound, centre = proven, tried / max(worth, 1.0)
                if price @ column > 1.0 + 1e-9 or weight < 1e-3:
                    break
                weight = weight / 2 if weight > 0.05 else 0.0
            if price @ column <= 1.0 + 1e-9:                # the prices are optimal
                break
        move = inverse @ column
        ratio = np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1.0), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        much = ratio[out]
        use = np.maximum(use - much * move, 0.0)
        use[out] = much
        row = inverse[out] / move[out]
        inverse = inverse - np.outer(move, row)
        inverse[out] = row
        columns[:, out], cost[out] = column, c
    return [(columns[:, j], float(use[j])) for j in range(m) if cost[j] and use[j] > 1e-9]


def best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Left-over pieces, longest first, each into the fullest sequence that still takes it."""
    room: dict[int, list[np.ndarray]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[i])):
            fit = min((r for r in room if r >= sizes[i]), default=0)
            pattern = room[fit].pop() if fit else np.zeros(len(sizes))
            if fit and not room[fit]:
                del room[fit]
            pattern[i] += 1
            room.setdefault((fit or capacity) - int(sizes[i]), []).append(pattern)
    return [p for r in sorted(room) for p in room[r]]


def plan_patterns(histogram: dict[int, int], capacity: int, gap: float = 1e-3) -> list[tuple[dict[int, int], int]]:
    """Whole patterns ``({class: count}, times)`` that place every piece exactly once."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[s] for s in sizes], dtype=np.float64)
    out: list[tuple[dict[int, int], int]] = []

    def take(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        some = pattern > 0
        times = int(min(times, (left[some] // pattern[some]).min()))
        if times > 0:
            out.append(({int(s): int(c) for s, c in zip(sizes[some], pattern[some])}, times))
            left = left - pattern * times

    for pattern, use in sorted(column_generation(sizes, left.copy(), capacity, gap), key=lambda p: -p[1]):
        take(pattern, int(use + 1e-6))
    for pattern in best_fit(sizes, left, capacity):
        take(pattern, 1)
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per class, in rank order: first rank of a pattern's share, pieces per sequence, first
    sequence, first slot in the sequence (longest pieces first)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for pattern, times in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            rank = used.get(size, 0)
            rows.setdefault(size, []).append((rank, pattern[size], first, slot))
            used[size] = rank + pattern[size] * times
            slot += pattern[size]
        first += times
    return {size: np.array(r, dtype=np.int64) for size, r in rows.items()}


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int, width: int,
                  id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document with its ids and its running number within (task, class)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen, uid = np.zeros(sequence // width + 2, np.int64), part << 36
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                doc, start, length, total, classes, run, uids, ids = ([] for _ in range(8))
                some = batch.slice(lo, 256)
                for d, text in zip(some.column(0).to_pylist(), some.column(1)):
                    all_ids = enc.encode(text.as_py()) + end
                    n = len(all_ids) // 4
                    for at in range(0, n, sequence):
                        size = min(sequence, n - at)
                        k = -(-size // width)
                        doc.append(d), start.append(at), length.append(size), total.append(n)
                        classes.append(k), run.append(seen[k]), uids.append(uid)
                        ids.append(all_ids[4 * at:4 * (at + size)])
                        seen[k] += 1
                        uid += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(doc), pa.int32()), pa.array(uids, pa.int64()), pa.array(doc, pa.int64()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(classes, pa.int32()), pa.array(run, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "uid", "doc_id", "start", "length", "doc_tokens", "class", "run", "ids"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(cut, "part int, uid long, doc_id long, start long, length long, doc_tokens long, "
                                "class int, run long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int = 2048, width: int = 4,
         gap: float = 1e-3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document; one row per piece: ``doc_id, start, length, doc_tokens,
    sequence_id, offset, ids`` (little-endian unsigned 32-bit ids of the piece).

    A null text is empty and is packed as its end id alone; repeated rows are packed as often
    as they occur; a null id stays null; other columns are ignored; an empty table gives no
    row. Documents of at most one sequence are never cut. A sequence's padding is at most its
    pattern's slack plus ``width - 1`` ids a piece. What reaches the driver is the class
    histogram (``sequence / width`` rows). Every piece is written once; ranks within a class
    are running numbers of the task that cut it plus the counts of the tasks before, so no
    class has to meet in one task.
    """
    if sequence % width:
        raise ValueError("sequence must be a multiple of width")
    pieces = cut_lineage(cut_documents(docs, tokenizer_path, end_id, sequence, width, id_col, text_col),
                         compression="zstd")
    counts = cut_lineage(pieces.groupBy("class", "part").agg(F.count("*").alias("n")))
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan_patterns(histogram, sequence // width, gap))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.select("part", "class", "run", "uid", "length").join(base, ["class", "part"])
              .select("uid", "length", "class", (F.col("base") + F.col("run")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, length, kind, rank = (np.asarray(batch.column(c)) for c in range(4))
            seq, slot = np.zeros(len(uid), np.int64), np.zeros(len(uid), np.int64)
            for k in np.unique(kind):
                at = np.flatnonzero(kind == k)
                rows = table[int(k)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                offset = rank[at] - row[:, 0]
                seq[at], slot[at] = row[:, 2] + offset // row[:, 1], row[:, 3] + offset % row[:, 1]
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(length), pa.array(seq), pa.array(slot)],
                                             names=["uid", "length", "sequence_id", "slot"])

    placed = ranked.mapInArrow(place, "uid long, length long, sequence_id long, slot long")
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("uid", "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("offset"))
    return (pieces.select("uid", "doc_id", "start", "length", "doc_tokens", "ids").join(placed, "uid")
            .select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"))
