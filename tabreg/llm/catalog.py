"""One registered query per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import (byte_bpe, filter_audit, mixing, ngram_join, packing, ranked_search, secret_scan, sharding, token_counts,
                        toxicity, vector_dedup, wavelet, winnow)
from tabreg.llm.base import scratch_path, table, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file, by the parameter package that lists them."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as wavelet-matrix files of token ids, read back."""
    path = scratch_path(spark)
    wavelet.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=2)
    return wavelet.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal weight, and their shard among 41."""
    out = sharding.shard_records(table(spark, sf_dir, "documents"), [1.0] * 40, [1.0] * 41)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under the vocabulary and scores of a public file."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents and of their edited texts."""
    out = winnow.fingerprint_pairs(table(spark, sf_dir, "documents"))
    places = F.array_join(winnow.positions(F.col("fingerprint")).cast("array<string>"), " ")
    out = out.withColumn("positions", places)
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        out = out.withColumn(name, winnow.hashes(F.col(name)))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        winnow.as_text(F.col("fingerprint")).alias("fingerprint"),
        winnow.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        winnow.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        winnow.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "positions")


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents, one row per document."""
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    each = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        F.col("id").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(F.encode(secret_scan.as_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence")


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: five-word shingles, Jaccard index 0.8 or more."""
    out = ngram_join.near_classes(table(spark, sf_dir, "documents"))
    each = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(F.col("id").alias("doc_id"), "class_id", "n_links",
                       (F.col("keep") & (F.col("copy") == 1)).alias("kept"))


@query
def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all embeddings of a label: cosine 0.98 or more."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and sampling decision of every document: half of all tokens, under tempered
    targets of source, language and topic."""
    docs = table(spark, sf_dir, "documents")
    margins = mixing.document_margins(docs)
    cells = mixing.calibrated(docs, margins, mixing.POWERS, mixing.SHARE, tolerance=1e-8)
    rows = mixing.assigned(docs.withColumn("topic", margins["topic"]), margins, cells)
    return rows.select("doc_id", "source", "lang", "topic", mixing.count_tokens(text_or_empty("text")).alias("tokens"),
                       F.round("__probability", 5).alias("probability"), F.col("__kept").alias("kept"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under the ranks of a public file, and the bytes they decode to."""
    import public_tokenizers

    path, pattern = tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    out = byte_bpe.decode(ids, path, pattern)
    return out.select("doc_id", "n_tokens",
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in every order, by source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op1_mixing"] = mixing.sql()
SQL["op12_filter_audit"] = filter_audit.sql()
SQL["op13_ranked_search"] = ranked_search.sql()
SQL["op3_shards"] = sharding.sql(40)
