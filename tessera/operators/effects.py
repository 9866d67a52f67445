"""Two-way effects on a (row x col) table with holes: which key explains more of the variation?

Input is long: (row, col, value) with missing cells absent or NULL.  Means are NaN-means (NULLs
skipped).  Group means are computed with ``groupBy`` (partial aggregation) and joined back on the
key -- not with ``avg() over (partition by key)``, which would put a hot key into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def remove_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """value - mean(value by key); rows keep their other columns."""
    m = df.groupBy(key).agg(F.avg(value).alias("_m"))
    return df.join(m, key).withColumn(value, F.col(value) - F.col("_m")).drop("_m")


def effect_rms(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Total RMS, RMS after removing the row-key means or the col-key means, and the reductions."""
    t = df.where(F.col(value).isNotNull()).select(row, col, F.col(value).cast("double").alias("_v"))
    mr = t.groupBy(row).agg(F.avg("_v").alias("_mr"))
    mc = t.groupBy(col).agg(F.avg("_v").alias("_mc"))
    j = t.join(mr, row).join(mc, col)
    sq = lambda c: c * c
    a = j.agg(
        F.sqrt(F.avg(sq(F.col("_v")))).alias("rms_total"),
        F.sqrt(F.avg(sq(F.col("_v") - F.col("_mr")))).alias(f"rms_minus_{row}"),
        F.sqrt(F.avg(sq(F.col("_v") - F.col("_mc")))).alias(f"rms_minus_{col}"),
    )
    return a.select(
        "*",
        (F.col("rms_total") - F.col(f"rms_minus_{row}")).alias(f"reduction_{row}"),
        (F.col("rms_total") - F.col(f"rms_minus_{col}")).alias(f"reduction_{col}"),
    )


def alternating_means(df: DataFrame, row: str, col: str, value: str, rounds: int = 5) -> DataFrame:
    """Alternately remove row-key means then col-key means; RMS after every half step.

    Output (round, step, rms) with round 0 / step 'initial' first.

    The cells never change: after any number of steps a cell is v - a[row] - b[col], so only the two offset
    tables are kept. Cells are summed up once to (row, col, n, s, q). A half step reads them once, with
    the other side's offsets, for a = (sum of v - sum of n b) / (sum of n) by row key (or the same for b), and
    checkpoints that table of keys. Keys that are NULL are a key of their own. The RMS follows from sums over the offset tables alone:
    sum of (v - a - b)^2 = Q - 2 sum(a S) - 2 sum(b S) + sum(n a^2) + sum(n b^2) + 2 sum(a X), with X = sum of n b
    by key, which the half step has anyway.
    """
    t = df.where(F.col(value).isNotNull()).select(F.col(row).alias("_r"), F.col(col).alias("_c"), F.col(value).cast("double").alias("_v"))
    cells = cut_lineage(t.groupBy("_r", "_c").agg(F.count("_v").alias("n"), F.sum("_v").alias("s"), F.sum(F.col("_v") * F.col("_v")).alias("q")))
    sums = [cells.agg(F.lit(0).alias("k"), *[F.lit(0.0).alias(c) for c in ("aS", "na2", "aX")], F.sum("q").alias("q"), F.sum("n").alias("n"))]
    other = None  # the other side's offsets
    for k in range(1, 2 * rounds + 1):
        mine, theirs = ("_r", "_c") if k % 2 else ("_c", "_r")
        met = cells.withColumn("a", F.lit(0.0)) if other is None else cells.join(other.select(F.col(theirs).alias("_key"), "a"), F.col(theirs).eqNullSafe(F.col("_key")))
        g = met.groupBy(mine).agg(F.sum("n").alias("n"), F.sum("s").alias("S"), F.sum(F.col("n") * F.col("a")).alias("X"))
        other = cut_lineage(g.withColumn("a", (F.col("S") - F.col("X")) / F.col("n")))
        sums.append(other.agg(
            F.lit(k).alias("k"), F.sum(F.col("a") * F.col("S")).alias("aS"),
            F.sum(F.col("n") * F.col("a") * F.col("a")).alias("na2"), F.sum(F.col("a") * F.col("X")).alias("aX"),
        ))
    steps = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sums)
    before, all_ = Window.orderBy("k"), Window.partitionBy()  # of 2 rounds + 1 rows
    last = lambda c: F.coalesce(F.lag(c).over(before), F.lit(0.0))
    steps = steps.select("k", "aX", F.max("q").over(all_).alias("q"), F.max("n").over(all_).alias("n"), (F.col("aS") + last("aS")).alias("aS"), (F.col("na2") + last("na2")).alias("na2"))
    square = F.col("q") - 2 * F.col("aS") + F.col("na2") + 2 * F.col("aX")
    step = F.when(F.col("k") == 0, "initial").when(F.col("k") % 2 == 1, f"minus_{row}").otherwise(f"minus_{col}")
    return steps.select(F.ceil(F.col("k") / 2).cast("int").alias("round"), step.alias("step"), F.sqrt(F.greatest(square, F.lit(0.0)) / F.col("n")).alias("rms"))
