"""Interaction audit of five text filters: what each removes in every order.

A document fails A (under 200 words), B (distinct words under half of its words), C (ASCII
capitals over a fiftieth of its code points), D (one of ``#$%&*|``) or E (its text is
identical to that of a smaller id). A to D come from one pass over the whole texts; E comes
from radix tries:

* every task inserts its texts, in blocks of bounded size, into a compressed trie whose
  terminals hold the smallest id; all other copies are decided there and leave their text behind;
* the remaining texts are range-partitioned by prefixes that are as long as their weight asks
  for: the prefixes that weigh more than a share of the table are counted at four times the
  length, until none is left or the texts end;
* each range goes into one compressed trie, whose traversal gives the duplicate flags.

The documents are then counted by (part, set of failed filters), at most 32 rows a part, from
which all 120 orders follow. No document-level row meets the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, parallelism, text_or_empty

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
MIN_WORDS, MARKS = 200, b"#$%&*|"
CAPITALS = bytes(range(0x41, 0x5B))
CONTINUATION = bytes(range(0x80, 0xC0))       # UTF-8 bytes that start no code point
FIRST_PREFIX, LONGER = 8, 4                   # bytes of the shortest prefix, factor of the next
BLOCK_BYTES = 32 << 20
ROW = "id long, part string, mask int, copies long"


class Node:
    __slots__ = ("label", "children", "least", "held")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.least: int | None = None          # smallest id of the text that ends here
        self.held: list | None = None          # what is known of the rows with that id


def shared_length(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class RadixTrie:
    """A compressed trie of byte strings; an edge holds a run of bytes without a branch."""

    def __init__(self):
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made where it is missing."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            k = shared_length(child.label, text, at)
            middle = Node(child.label[:k])
            child.label = child.label[k:]
            middle.children[child.label[0]] = child
            node.children[text[at]] = middle
            node, at = middle, at + k
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every text with its node, in byte order."""
        stack = [(b"", self.root)]
        while stack:
            text, node = stack.pop()
            if node.held is not None:
                yield text, node
            stack += [(text + node.children[b].label, node.children[b]) for b in sorted(node.children, reverse=True)]


def text_mask(text: bytes) -> int:
    """Failed filters A to D of a UTF-8 text. ``bytes.split`` cuts at space and bytes 9 to 13."""
    words = text.split()
    mask = BIT["A"] if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < 50 * len(words):
        mask |= BIT["B"]
    if 100 * (len(text) - len(text.translate(None, CAPITALS))) > 2 * len(text.translate(None, CONTINUATION)):
        mask |= BIT["C"]
    if len(text.translate(None, MARKS)) != len(text):
        mask |= BIT["D"]
    return mask


class _Rows:
    """Columns of a batch under way."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.size = schema, [[] for _ in schema], 0

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.size += 64 + (len(values[-1] or b"") if isinstance(values[-1], (bytes, type(None))) else 0)

    def batches(self, at_least: int) -> Iterator[pa.RecordBatch]:
        if self.size >= max(at_least, 1):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
            self.columns, self.size = [[] for _ in self.schema], 0


_FLAGGED = pa.schema([("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("copies", pa.int64())])
_LOCAL = pa.schema([*_FLAGGED, ("text", pa.binary())])


def local_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``id, part, text`` to ``id, part, mask, copies, text``. A row keeps its text where
    its id is the block's smallest of that text (rows that repeat id, part and text become one
    with their count); the others are decided: later copies fail E, rows without an id never do."""
    out = _Rows(_LOCAL)

    def emit(trie: RadixTrie) -> None:
        for text, node in trie.terminals():
            mask, parts = node.held
            for part, copies in parts.items():
                out.add(node.least, part, mask, copies, text)

    trie, held = RadixTrie(), 0
    for batch in batches:
        for i in range(batch.num_rows):
            id_, part, text = (batch.column(c)[i].as_py() for c in range(3))
            node = trie.terminal(text)
            if node.held is None:
                node.held = [text_mask(text), {}]
                held += len(text) + 200
            mask, parts = node.held
            if id_ is None:
                out.add(None, part, mask, 1, None)
            elif node.least is None or id_ < node.least:
                for p, copies in parts.items():
                    out.add(node.least, p, mask | BIT["E"], copies, None)
                node.least, node.held[1] = id_, {part: 1}
            elif id_ == node.least:
                parts[part] = parts.get(part, 0) + 1
            else:
                out.add(id_, part, mask | BIT["E"], 1, None)
            yield from out.batches(8 << 20)
            if held >= BLOCK_BYTES:
                emit(trie)
                yield from out.batches(0)
                trie, held = RadixTrie(), 0
    emit(trie)
    yield from out.batches(0)


def range_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``id, part, mask, copies, text`` of one range of texts to ``id, part, mask, copies``:
    all rows but those of the text's smallest id fail E. A copy of a held text takes no memory."""
    out, trie = _Rows(_FLAGGED), RadixTrie()
    for batch in batches:
        for i in range(batch.num_rows):
            id_, part, mask, copies, text = (batch.column(c)[i].as_py() for c in range(5))
            node = trie.terminal(text)
            if node.least is None or id_ < node.least:
                for row in node.held or []:
                    out.add(node.least, row[0], row[1] | BIT["E"], row[2])
                node.least, node.held = id_, [(part, mask, copies)]
            elif id_ == node.least:
                known = {(p, m): c for p, m, c in node.held}
                known[part, mask] = known.get((part, mask), 0) + copies
                node.held = [(p, m, c) for (p, m), c in known.items()]
            else:
                out.add(id_, part, mask | BIT["E"], copies)
        yield from out.batches(4 << 20)
    for _, node in trie.terminals():
        for part, mask, copies in node.held:
            out.add(node.least, part, mask, copies)
        yield from out.batches(4 << 20)
    yield from out.batches(0)


def _prefix(length: int) -> Column:
    return F.substring("text", 1, length)


def with_prefix_lengths(texts: DataFrame, target: int) -> DataFrame:
    """``texts`` (binary column ``text``) with ``length``: bytes of the prefix that places the row.

    A prefix whose rows weigh more than ``target`` bytes is heavy, and its longer rows go on to
    a prefix four times as long. Of one length at most (weight of the table / target) prefixes
    are heavy, which bounds the broadcast table of their 64-bit hashes (a collision only
    lengthens a prefix)."""
    longest = texts.agg(F.max(F.length("text"))).first()[0] or 0
    length, placed = FIRST_PREFIX, texts.withColumn("length", F.lit(FIRST_PREFIX)).withColumn("heavy", F.lit(True))
    while length < longest:
        open_ = F.col("heavy") & (F.length("text") > length)
        found = cut_lineage(
            placed.filter(open_).groupBy(_prefix(length).alias("p")).agg(F.sum(F.length("text") + F.lit(64)).alias("w"))
            .filter(F.col("w") > target).select(F.xxhash64("p").alias("h")).distinct())
        if found.isEmpty():
            break
        placed = placed.join(F.broadcast(found), open_ & (F.xxhash64(_prefix(length)) == F.col("h")), "left")
        length *= LONGER
        placed = (placed.withColumn("heavy", F.col("h").isNotNull()).drop("h")
                  .withColumn("length", F.when(F.col("heavy"), F.lit(length)).otherwise(F.col("length"))))
    return placed.drop("heavy")


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``id, part, mask, copies``: the failed filters of all rows as a bit set (A = 1, B = 2, C = 4,
    D = 8, E = 16). Rows that agree in id, part and text may come as one with their count.

    A null text is the empty text, a null part the empty string. A row fails E when a row with a
    smaller id has the same text; rows that repeat an id do not fail by each other, and a row
    without an id neither fails E nor makes another fail. Other columns are ignored whatever
    their names; an empty table gives no rows."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       text_or_empty(docs[text_col]).cast("binary").alias("text"))
    local = cut_lineage(rows.mapInArrow(local_flags, ROW + ", text binary"))
    texts = local.filter(F.col("text").isNotNull())
    n = parallelism(docs.sparkSession)
    weight = texts.agg(F.sum(F.length("text") + F.lit(64))).first()[0] or 0
    placed = with_prefix_lengths(texts, max(1, weight // (4 * n)))
    ranged = placed.repartitionByRange(n, F.expr("substring(text, 1, length)"))
    flagged = ranged.select("id", "part", "mask", "copies", "text").mapInArrow(range_flags, ROW)
    return flagged.unionByName(local.filter(F.col("text").isNull()).drop("text"))


def labelled_cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of every part and set of failed filters, and those
    with a label of quality 1 and of toxicity 1 (where an id has several labels, any counts)."""
    rows = cut_lineage(rows)
    marks = labels.filter((F.col("quality") == 1) | (F.col("toxic") == 1)).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    none = F.lit(0).cast("long")
    counted = rows.groupBy("part", "mask").agg(F.sum("copies").alias("n")).select(
        "part", "mask", "n", none.alias("good"), none.alias("toxic"))
    marked = rows.join(marks, "id").select("part", "mask", none.alias("n"), (F.col("copies") * F.col("good")).alias("good"),
                                           (F.col("copies") * F.col("toxic")).alias("toxic"))
    return counted.unionByName(marked).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit_orders(cells: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the cells of a part: ``kept``,
    ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``
    (what the step's filter removes, summed over all orders: a document that fails m filters goes
    to each of them in 120 / m orders)."""
    sets = range(1 << len(FILTERS))
    wide = cells.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in sets]).alias(c)
        for c in ("n", "good", "toxic")])
    orders = ",".join("".join(p) for p in itertools.permutations(FILTERS))
    steps = (wide.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))
    bit = lambda letter: f"shiftleft(1, locate({letter}, '{FILTERS}') - 1)"
    steps = (steps.withColumn("own", F.expr(bit("substr(filter_order, step, 1)")))
             .withColumn("before", F.expr(f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (b, f) -> b | {bit('f')})")))
    every = f"sequence(0, {len(sets) - 1})"
    total = lambda column, test, times="1": F.expr(
        f"aggregate({every}, 0L, (s, m) -> s + if({test}, {column}[m] * {times}, 0L))")
    here = "(m & own) <> 0 and (m & before) = 0"
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("n", "(m & (own | before)) = 0").alias("kept"), total("n", here).alias("removed"),
        total("n", "(m & own) <> 0 and (m & before) <> 0").alias("redundant"), F.expr("n[own]").alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
        total("n", "(m & own) <> 0", "(120 div bit_count(m))").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """The audit of all rows of ``docs`` (``failed_filters`` states the odd cases), 600 rows a part;
    an empty table gives no rows, rows of ``labels`` without a document or an id do not count."""
    return audit_orders(labelled_cells(failed_filters(docs, id_col, text_col, part_col), labels))


def sql() -> str:
    """DuckDB SQL of ``audit`` over documents and labels."""
    return r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT doc_id, part,
        (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
      + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
      + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
      + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
      + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(a, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT p.a || q.a || r.a || s.a || t.a AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
      FROM x p, x q, x r, x s, x t
      WHERE p.b + q.b + r.b + s.b + t.b = 31 AND (p.b | q.b | r.b | s.b | t.b) = 31),
k AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step))
SELECT part, filter_order, step::INTEGER AS step,
       sum(CASE WHEN (mask & (own | before)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & before) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & before) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & before) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & before) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN (mask & own) <> 0 THEN n * (120 // bit_count(mask::INTEGER)) ELSE 0 END)::BIGINT AS shapley
FROM c, k GROUP BY part, filter_order, step"""
