"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns them
again (the last one returns the packed pieces); ``run`` writes every stage's rows as Parquet
and reads them back as the next stage's ``docs``. SQL cannot express the nearest-neighbour
scores, the MinHash candidates or the tokenizer, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds the stages against brute force.

In every stage a null text counts as the empty text and stays null where it is kept, null ids,
sources and languages are values of their own, repeated rows are treated alike, other columns
pass through whatever their names, texts of any length are read whole, and an empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import catalog, mixing, ngram_join, packing, secret_scan, toxicity
from tabreg.llm.base import cut_lineage, table, text_or_empty

TOXIC_FROM = 0.7
MARK = "[SECRET]"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is 0.7 or more go; all others stay as they are. The score is learned
    from the labelled training rows among ``docs``. An empty or null text scores by the calibrated
    vote 0, equal texts score alike (ties between neighbours go to the first example), without
    labels of both kinds every text has the share of toxic ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_FROM)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies (five-word shingles, Jaccard index 0.8) stays: the
    smallest id (null last), of equal ids the smallest hash of the text. Empty and null texts
    are copies of each other, texts without a word only of equal texts; of repeated rows one stays."""
    return ngram_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span becomes a mark, overlapping spans one mark; all rows stay, repeated ones
    too, a null text stays null, ``n_chars`` follows a changed text. A long text with n matches
    takes n log n steps."""
    out = secret_scan.redact(docs, MARK, changed="__changed")
    n = F.when(F.col("__changed"), F.length(text_or_empty("text")).cast("long")).otherwise(F.col("n_chars").cast("long"))
    return out.withColumn("n_chars", n).drop("__changed")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are sampled by their probabilities, calibrated to half of all tokens: a cell too small
    for its target is kept whole, texts without a token are kept. The draw is a hash of the id (of
    the text where the id is null), so repeated rows share it and a probability that ties with a
    draw does not keep the row."""
    margins = mixing.document_margins(docs)
    cells = mixing.calibrated(docs, margins, mixing.POWERS, mixing.SHARE)
    return mixing.assigned(docs, margins, cells).filter("__kept").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids, one row per piece, with its ids. Null and empty texts are the end id
    alone, texts longer than a sequence are cut, repeated rows are documents of their own."""
    return packing.pack(docs, catalog.tokenizer("word_bpe_49k.json"), end_id=1)


STAGES = [("toxicity", reject_toxic), ("near_duplicates", one_of_each_group), ("secrets", redact_secrets),
          ("mixing", mix_to_targets), ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
