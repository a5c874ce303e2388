"""Scoring rows as they arrive (ML13 on a stream).

A fitted recipe (``matrix.FittedRecipe``) and a linear fit are pure projections, so the
same expressions apply to a streaming DataFrame: no state, no shuffle, no watermark. The
sink writes ``key, prediction`` with its progress in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabreg.functions.linalg import LinearFit
from tabreg.operators.models import linear_expr
from tabreg.session import checkpoint_dir


def score_stream(stream: DataFrame, fit: LinearFit, key: str, recipe=None, back_transform: bool = True,
                 out: str = "prediction") -> DataFrame:
    """Streaming ``(key, prediction)``; ``recipe`` is applied first when given."""
    df = recipe.transform(stream) if recipe is not None else stream
    pred = linear_expr(fit)
    if back_transform:
        pred = F.exp(pred)
    return df.select(F.col(key), pred.alias(out))


def write_scored_stream(scored: DataFrame, path: str, name: str = "scored",
                        fmt: str = "parquet") -> StreamingQuery:
    """Append the scored rows to ``path``; progress is kept under the shared checkpoint folder."""
    ckpt = f"{checkpoint_dir(scored.sparkSession).rstrip('/')}/stream-{name}"
    return (scored.writeStream.format(fmt).option("path", path).option("checkpointLocation", ckpt)
                  .outputMode("append").start())
