"""Document fingerprints by winnowing, with DataFrame functions only.

Words (runs of letters and digits, lower case) are hashed to integers below a prime; a k-gram's
rolling hash is the polynomial of its word hashes modulo that prime; every window of
``window`` k-grams keeps its smallest hash, the rightmost of equal ones. Any shared run of
``window + k - 1`` words leaves a common hash. Windows and k-grams are built by doubling:
shifting an array against itself, so a text of n words costs O(n log(k + window)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabreg.llm.base import parallelism, text_or_empty

PRIME = (1 << 31) - 1
BASE = 1_000_003
REACH = (1 << 31) - 1        # a hash and its reversed position share one long


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != F.lit(""))


def _zip(left: Column, right: Column, shift: int, join) -> Column:
    """``join(left[i], right[i + shift])`` for every i where both exist."""
    cut = F.least(F.size(left), F.size(right) - F.lit(shift))
    return F.when(cut > 0, F.zip_with(F.slice(left, F.lit(1), F.greatest(cut, F.lit(0))),
                                      F.slice(right, F.lit(shift + 1), F.greatest(cut, F.lit(0))), join)
                  ).otherwise(F.array().cast("array<long>"))


def _append(n_words: int):
    """Rolling hash of a gram followed by a gram of ``n_words`` words."""
    power = F.lit(pow(BASE, n_words, PRIME))
    return lambda a, b: F.pmod(a * power + b, F.lit(PRIME))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = 3, window: int = 4) -> DataFrame:
    """Add ``out``: the selected ``hash << 31 | (2^31 - 1 - position)`` of the text, in order of
    position. Fewer than k words make one gram of all words; fewer than ``window`` grams make
    one window; no words give an empty array."""
    tmp = f"__{out}"
    n_words = F.size(F.col(f"{tmp}_w"))
    df = df.withColumn(f"{tmp}_w", F.transform(words(F.col(text)), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    # k-gram hashes by doubling: a gram of a + b words from a gram of a words and the gram of b after it
    size, grams = 1, {1: f"{tmp}_w"}
    while size * 2 <= k:
        name = f"{tmp}_g{size * 2}"
        df = df.withColumn(name, _zip(F.col(grams[size]), F.col(grams[size]), size, _append(size)))
        size *= 2
        grams[size] = name
    have, current = size, grams[size]
    for part in sorted((p for p in grams if (k - size) & p), reverse=True):
        name = f"{tmp}_h{have + part}"
        df = df.withColumn(name, _zip(F.col(current), F.col(grams[part]), have, _append(part)))
        have, current = have + part, name
    short = F.aggregate(F.col(f"{tmp}_w"), F.lit(0).cast("long"),
                        lambda a, b: F.pmod(a * F.lit(BASE) + b, F.lit(PRIME)))
    df = df.withColumn(f"{tmp}_p", F.when(n_words >= k, F.transform(
        F.col(current), lambda h, i: F.shiftleft(h, 31).bitwiseOR(F.lit(REACH).cast("long") - i.cast("long"))))
        .when(n_words > 0, F.array(F.shiftleft(short, 31).bitwiseOR(F.lit(REACH).cast("long"))))
        .otherwise(F.array().cast("array<long>")))
    # window minima by doubling; the packed position makes the rightmost of equal hashes smallest
    size, current = 1, f"{tmp}_p"
    while size < window:
        step = min(size, window - size)
        name = f"{tmp}_m{size + step}"
        df = df.withColumn(name, _zip(F.col(current), F.col(current), step, lambda a, b: F.least(a, b)))
        size, current = size + step, name
    least = F.array_min(F.col(f"{tmp}_p"))
    df = df.withColumn(out, F.when(F.size(current) > 0, F.array_distinct(F.col(current)))
                       .when(F.size(f"{tmp}_p") > 0, F.array(least)).otherwise(F.array().cast("array<long>")))
    return df.drop(*[c for c in df.columns if c.startswith(tmp)])


def hashes(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: F.shiftrightunsigned(x, 31))


def positions(fingerprint: Column) -> Column:
    """Word positions of the selected grams."""
    return F.transform(fingerprint, lambda x: F.lit(REACH).cast("long") - x.bitwiseAND(F.lit(REACH).cast("long")))


def as_text(hash_array: Column) -> Column:
    return F.array_join(F.transform(hash_array, lambda x: F.lower(F.hex(x))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two hash arrays; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    any_ = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(any_ > 0, both / any_).otherwise(F.lit(1.0))


def reached(value: Column, edges: list[int]) -> Column:
    """How many of the ascending edges the value reaches. The edges are literal arrays searched in two
    levels, so a row meets about twice the root of their number, and no expression grows with them."""
    if not edges:
        return F.lit(0)
    step = max(1, round(len(edges) ** 0.5))
    # text literals that the optimiser folds into one array each
    lists = ";".join(",".join(map(str, edges[i:i + step])) for i in range(0, len(edges), step))
    groups = F.transform(F.split(F.lit(lists), ";"), lambda g: F.split(g, ",").cast("array<long>"))
    heads = F.split(F.lit(",".join(map(str, edges[::step]))), ",").cast("array<long>")
    at_least = lambda array: F.size(F.filter(array, lambda e: e <= value))
    group = at_least(heads)
    return F.when(group > 0, (group - 1) * step + at_least(F.element_at(groups, group))).otherwise(F.lit(0))


def id_ranges(ids: DataFrame, blocks: int) -> list[tuple[int, int]]:
    """Smallest and largest id of at most ``blocks`` ranges of about equal rows, ascending: two
    numbers a range reach the driver."""
    ranged = ids.filter("id IS NOT NULL").select("id").repartitionByRange(blocks, "id")
    ends = ranged.groupBy(F.spark_partition_id()).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    return sorted((r["lo"], r["hi"]) for r in ends.collect())


def with_next(docs: DataFrame, columns: list[str], blocks: int | None = None, add=lambda rows: rows) -> DataFrame:
    """The rows of ``docs`` (long ``id``, string ``text``) with ``next_<c>`` for each of ``columns``
    (of ``docs`` or added by ``add``): the value of the next row in descending id order, and the
    first row's after the last. Null ids come last, rows of equal id in the order of a hash of
    their text.

    Rows are dealt once, by ranges of the id; the first rows of the range below are dealt to the
    range above as well, so every row meets its successor."""
    spark = docs.sparkSession
    ranges = id_ranges(docs, blocks or parallelism(spark))
    block = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(reached(F.col("id"), [lo for lo, _ in ranges[1:]]))
    rows = docs.withColumn("block", block.cast("int"))
    tops = {i: hi for i, (_, hi) in enumerate(ranges)}
    if docs.filter("id IS NULL").limit(1).count():
        tops[-1] = None
    order = sorted(tops, reverse=True)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first block's first row ends the last block
    marks = spark.createDataFrame([(b, tops[b], before[b]) for b in order], "block int, top long, before int")
    led = rows.join(F.broadcast(marks), "block")              # at most one row a range
    first = led.filter(F.col("id").eqNullSafe(F.col("top")))
    both = (led.select(*docs.columns, "block", F.lit(0).alias("role"))
            .unionByName(first.select(*docs.columns, F.col("before").alias("block"), F.lit(1).alias("role"))))
    run = Window.partitionBy("block").orderBy("role", F.col("id").desc_nulls_last(), F.xxhash64("text"), "text")
    return (add(both).withColumns({f"next_{c}": F.lead(c).over(run) for c in columns}).filter("role = 0")
            .drop("block", "role"))


def with_next_text(docs: DataFrame, id_col: str, text_col: str, blocks: int | None = None) -> DataFrame:
    """``id, text, next_text`` of all rows, see ``with_next``; a null text is empty."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    return with_next(rows, ["text"], blocks)


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                      window: int = 4) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text replaces the last floor(n/2) code points by the first as many (or all) of
    the next row's text. Returns the id, ``n_chars, edited_text, fingerprint,
    edited_fingerprint, next_fingerprint`` (packed arrays, see ``hashes`` and ``positions``).
    A null text is empty, a null id orders last, rows of equal id by a hash of their text, repeated
    rows stay; other columns are ignored whatever their names, an empty table gives no row. A very
    long text is one row throughout.
    """
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    rows = with_next(rows, ["text", "fingerprint"], add=lambda r: with_fingerprint(r, "text", "fingerprint", k, window))
    half = (F.length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited_text", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                                F.substring(F.col("next_text"), F.lit(1), half)))
    rows = with_fingerprint(rows, "edited_text", "edited_fingerprint", k, window)
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_text", "fingerprint", "edited_fingerprint",
                       "next_fingerprint")
