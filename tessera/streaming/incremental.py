"""Incremental form of the additive vector statistics (Structured Streaming).

The reference has no streaming operators.  The per-position sums and counts (A7) and the Gram
sums of the covariance kernel (M2) are additive, so a stream of new vectors can keep them up to
date in ``update`` mode with Spark's own state store -- no custom state logic.  Mean / variance /
covariance are read off the running sums exactly as in the batch operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vec import to_double_array


def running_position_sums(stream: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """Streaming aggregate (by..., pos) -> E, NE, S2 (``update`` or ``complete`` output mode)."""
    e = stream.select(*by, F.posexplode(to_double_array(vec)).alias("pos", "x"))
    return e.groupBy(*by, "pos").agg(F.sum("x").alias("E"), F.count("x").alias("NE"), F.sum(F.col("x") * F.col("x")).alias("S2"))


def finish_position_stats(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E, NE, mean, var from running sums (batch DataFrame, e.g. the memory sink's table)."""
    mean = F.try_divide(F.col("E"), F.col("NE").cast("double"))
    return sums.select(*by, "pos", "E", "NE", mean.alias("mean"), (F.try_divide(F.col("S2"), F.col("NE").cast("double")) - mean * mean).alias("var"))


def start_position_stats(stream: DataFrame, query_name: str, checkpoint: str, vec: str = "v", by: Sequence[str] = ()):
    """Start the running sums into an in-memory table named ``query_name`` (complete mode)."""
    return (
        running_position_sums(stream, vec, by)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .start()
    )
