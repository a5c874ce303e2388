"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair draws a hash number u in (0, 1); a record goes to the shard with the
largest ``-weight / ln(u)``. A pair's draw does not depend on the other shards, so when a
shard is added only the records that it wins move, and when one goes only its records move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, text_or_empty

DIGITS = 8          # hex digits of md5 a draw uses: four draws from one digest


def _number(digest: Column, shard: int) -> Column:
    """u of a (key, shard) pair: one of the four 32-bit numbers of ``md5(key|shard div 4)``."""
    part = F.conv(F.substring(digest, shard % 4 * DIGITS + 1, DIGITS), 16, 10).cast("double")
    return (part + F.lit(0.5)) / F.lit(float(16 ** DIGITS))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard of a key (string) among ``len(weights)`` shards; a shard of weight 0 gets nothing,
    ties go to the smallest shard."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    digests = {b: F.md5(F.concat(key, F.lit(f"|{b}"))) for b in range((len(weights) + 3) // 4)}
    scored = [F.struct((F.lit(-float(w)) / F.ln(_number(digests[s // 4], s))).alias("score"), F.lit(-s).alias("shard"))
              for s, w in enumerate(weights) if w > 0]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["shard"]).cast("int")


def shard_records(df: DataFrame, weights: list[float], grown: list[float] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", prefix: int = 2) -> DataFrame:
    """Shard of every row, its place there, and its shard among the ``grown`` weights.

    Returns ``id_col, size, text_crc32, shard, slot`` and, with ``grown``, ``grown_shard``.
    ``size`` is the UTF-8 bytes of the text (null: none) plus 16. The key is the id as text; a
    null id is keyed by the size and checksum of its text, so that rows without an id still
    spread. Slots run from 0 without gaps in each shard, in the order of the key's md5: rows are
    ranked among those that share the first ``prefix`` hex digits and placed after the prefixes
    before, so no shard has to meet in one task. The offsets are a table of
    ``len(weights) * 16 ** prefix`` rows. Rows of equal key share a shard. Other columns are
    ignored (the text is read once, a narrow table is kept); an empty table gives no row.
    """
    text = F.encode(text_or_empty(df[text_col]), "UTF-8")
    rows = df.select(df[id_col].alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                     F.crc32(text).alias("crc"))
    key = F.coalesce(F.col("id").cast("string"), F.concat_ws("|", F.lit("null"), F.col("size"), F.col("crc")))
    rows = rows.withColumn("key", key)
    at = rendezvous(F.col("key"), weights)
    rows = rows.select("id", "size", "crc", at.alias("shard"), F.md5("key").alias("h"),
                       *([rendezvous(F.col("key"), grown).alias("grown_shard")] if grown else []))
    rows = cut_lineage(rows.withColumn("bucket", F.substring("h", 1, prefix)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("h", "id", "size", "crc")
    ranked = rows.withColumn("rn", F.row_number().over(inside))
    return (ranked.join(F.broadcast(base), ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("base") + F.col("rn") - 1).cast("long").alias("slot"),
                    *(["grown_shard"] if grown else [])))


def sql(shards: int) -> str:
    """The registered query in SQL, for shards of equal weight."""
    def best(n: int) -> str:
        draws = ", ".join(f"{{'u': ('0x' || substr(m{s // 4}, {s % 4 * DIGITS + 1}, {DIGITS}))::BIGINT, 's': {-s}}}" for s in range(n))
        return f"(-list_max([{draws}])['s'])::INTEGER"

    table = list(range(256))                              # the checksum's table, by its rule
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    digests = ", ".join(f"md5(key || '|{b}') AS m{b}" for b in range((shards + 4) // 4))
    return f"""WITH keyed AS (SELECT *, {digests} FROM (SELECT doc_id,
        coalesce(doc_id::VARCHAR, concat_ws('|', 'null', size, text_crc32)) AS key, size, text_crc32 FROM (SELECT doc_id,
          strlen(text) + 16 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) a) b) c),
      placed AS (SELECT doc_id, key, size, text_crc32, {best(shards)} AS shard, {best(shards + 1)} AS grown_shard FROM keyed)
      SELECT doc_id, size, text_crc32, 'key' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM placed"""
