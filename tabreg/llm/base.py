"""Shared pieces of the operators: reading tables, scratch tables, hash numbers in [0, 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.session import cut_lineage, release_tables, scratch_path  # noqa: F401
from tabreg.sources.tables import table  # noqa: F401


def trimmed(run):
    """``run`` for ``mapInArrow``, after which the worker gives unused memory back: Spark keeps its
    Python workers for the next stages, where their free but unreturned memory would only be held."""
    def with_return(batches):
        yield from run(batches)
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):                     # another C library
            pass

    return with_return


def text_or_empty(text: str | Column) -> Column:
    """A null text counts as the empty text."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def parallelism(spark: SparkSession) -> int:
    """Number of partitions for an explicit repartitioning: the session's shuffle setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hex_uniform(text: Column, digits: int = 13) -> Column:
    """The first hex digits of the md5 of a string as a number in [0, 1); the same in any
    engine with md5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("double") / F.lit(float(16 ** digits))


def long_id(df: DataFrame, column: str) -> Column:
    return df[column].cast("long")
