"""Sources and sinks.

S1  CSV scan with every column as text; only the empty string is missing, ``"NA"`` stays text.
S2  tag a source with its set name, add a missing label where the file has none.
S3  columnar snapshot write (Parquet, optionally partitioned by the set tag).
S4  snapshot read.
S5  scored-file sink: header, key and prediction, no index column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text_csv(spark: SparkSession, path: str | Sequence[str],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Read CSV with a header, every column as a string.

    Without ``columns`` the header decides the names (no type inference: inference reads
    the data twice and guesses). Spark's default ``nullValue`` is the empty string, so
    ``""`` becomes NULL and the text ``NA`` stays a value.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def tag_set(df: DataFrame, set_name: str, set_col: str = "set",
            label: str | None = None) -> DataFrame:
    """Add the literal set tag; add ``label`` as a NULL double when the source lacks it."""
    out = df.withColumn(set_col, F.lit(set_name))
    if label is not None and label not in df.columns:
        out = out.withColumn(label, F.lit(None).cast("double"))
    return out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name (U1/U2); columns missing in one frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   mode: str = "overwrite") -> None:
    """Parquet snapshot between stages; a ``partition_by`` on the set tag lets a later
    reader prune to one set."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_scored(df: DataFrame, path: str, key: str, prediction: str,
                 out_names: tuple[str, str] | None = None, order_by_key: bool = False,
                 mode: str = "overwrite") -> None:
    """Write ``key, prediction`` as CSV with a header and no index column.

    Output is one file per task; ``order_by_key`` sorts globally (a range shuffle) only
    when a sorted file set is asked for.
    """
    names = out_names or (key, prediction)
    out = df.select(F.col(key).alias(names[0]), F.col(prediction).alias(names[1]))
    if order_by_key:
        out = out.orderBy(names[0])
    out.write.mode(mode).option("header", True).csv(path)
