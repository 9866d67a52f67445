"""Global order without a single-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.  These helpers give
the same answers (global row numbers, global running sums) with the work spread out:

1. range-partition on a *total* order (the caller includes a unique key, so even one hot value is
   split across partitions) and sort within partitions;
2. checkpoint into the shared checkpoint folder, so partition contents are fixed for the two
   passes below and survive executor loss;
3. per-partition counts / totals: one small row per partition;
4. offsets = running sum over those few rows (bounded by the partition count, not the data);
5. broadcast-join the offsets back by partition id and add the local position / running sum.

Local running sums are computed per partition in Arrow batches (``mapInPandas``), where rows
already arrive in sorted order; local row numbers come from ``monotonically_increasing_id``
(which encodes partition id and in-partition position) and stay JVM-side.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_LOW = (1 << 33) - 1


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn", partitions: int | None = None) -> DataFrame:
    """1-based row number in the given total order (include a unique key in ``order``)."""
    r = _ranged(df, order, partitions).withColumn("_mid", F.monotonically_increasing_id())
    r = r.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW)))
    counts = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    ).fillna(0, ["_off"])
    out = r.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_loc") + F.lit(1))
    return out.drop("_mid", "_pid", "_loc", "_off")


def global_cumsum(
    df: DataFrame,
    order: Sequence[Column],
    cols: Sequence[str],
    suffix: str = "_cum",
    partitions: int | None = None,
) -> DataFrame:
    """Running sums of ``cols`` (inclusive) in a global total order, spread over partitions."""
    r = _ranged(df, order, partitions)
    pid = F.spark_partition_id()
    totals = r.groupBy(pid.alias("_pid")).agg(*[F.sum(F.col(c).cast("double")).alias(f"_t{i}") for i, c in enumerate(cols)])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t{i}").over(w), F.lit(0.0)).alias(f"_o{i}") for i in range(len(cols))])

    cum_names = [f"{c}{suffix}" for c in cols]
    # The partition id is taken by ``spark_partition_id()`` in the child's own projection: inside a
    # Union, TaskContext.partitionId() would be the union's (offset) index instead.
    tagged = r.withColumn("_pid", pid)
    schema = T.StructType(
        list(tagged.schema.fields) + [T.StructField(f"_l{i}", T.DoubleType()) for i in range(len(cols))]
    )

    def local(it):
        run = np.zeros(len(cols))
        for pdf in it:
            pdf = pdf.copy()
            for i, c in enumerate(cols):
                v = pd.to_numeric(pdf[c], errors="coerce").fillna(0.0).to_numpy(dtype=np.float64)
                cs = np.cumsum(v) + run[i]
                if len(v):
                    run[i] = cs[-1]
                pdf[f"_l{i}"] = cs
            yield pdf

    loc = tagged.mapInPandas(local, schema)
    out = loc.join(F.broadcast(offsets), "_pid")
    out = out.select(
        *[F.col(f.name) for f in r.schema.fields],
        *[(F.col(f"_o{i}") + F.col(f"_l{i}")).alias(cum_names[i]) for i in range(len(cols))],
    )
    return out
