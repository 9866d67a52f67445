"""Missing-value-aware mean and covariance (the reference's one distributed kernel).

Definition kept from the reference (not ``covar_pop``):
    X = [1, v] with missing entries -> 0, M = defined-mask of [1, v]
    S = sum X^T X,  N = sum M^T M           (pairwise defined counts)
    E = S[0, 1:], NE = N[0, 1:], Mean = E / NE   (marginal means)
    O = S[1:, 1:], NO = N[1:, 1:],  Cov = O / NO - Mean Mean^T
Divide by n, not n-1; the result may be indefinite.  Values are cast to double before any product.

Physical plan
-------------
1. ``mapInPandas``: each task folds its Arrow batches into one (d+1)x(d+1) pair (S, N) per group
   with two BLAS products per batch, and emits only the upper triangle once, at the end.
2. ``groupBy(group, i, j).sum``: the shuffle carries tasks x groups x (d+1)(d+2)/2 rows -- it does
   not grow with the number of vectors, and a hot group is spread over all its tasks.
3. The summed triangle is checkpointed (it is tiny), then Mean and Cov are read off it with two
   small equi-joins on i and j -- the expensive pass runs once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vec import to_double_array
from ..session import cut_lineage


#: Bytes of partial matrices a task holds before it hands them on.
MAX_PARTIAL_BYTES = 128 << 20


def gram_partials(df: DataFrame, vec: str = "v", by: Sequence[str] = (), max_bytes: int = MAX_PARTIAL_BYTES) -> DataFrame:
    """Per task and group: upper triangle of S = X0^T X0 and N = M^T M with X0 = [1, v].

    With many groups a task hands on what it has whenever ``max_bytes`` are reached, so a group may
    have several partial triangles from one task; they are summed like those of other tasks."""
    by = list(by)
    src = df.select(*by, to_double_array(vec).alias("_v"))
    key_fields = [src.schema[k] for k in by]
    schema = T.StructType(
        key_fields
        + [
            T.StructField("i", T.IntegerType()),
            T.StructField("j", T.IntegerType()),
            T.StructField("s", T.DoubleType()),
            T.StructField("n", T.LongType()),
        ]
    )

    def emit(acc):
        for k, (S, N) in acc.items():
            iu, ju = np.triu_indices(S.shape[0])
            out = {name: [k[t]] * len(iu) for t, name in enumerate(by)}
            out.update({"i": iu.astype(np.int32), "j": ju.astype(np.int32), "s": S[iu, ju], "n": np.rint(N[iu, ju]).astype(np.int64)})
            yield pd.DataFrame(out)

    def fold(it):
        acc: dict = {}
        held = 0
        for pdf in it:
            if pdf.empty:
                continue
            groups = pdf.groupby(by, sort=False, dropna=False) if by else [((), pdf)]
            for key, part in groups:
                rows = [r for r in part["_v"] if r is not None]
                if not rows:
                    continue
                X = np.array([np.asarray(r, dtype=np.float64) if not isinstance(r, list) else np.array(r, dtype=np.float64) for r in rows])
                if X.dtype == object:
                    X = np.array([[np.nan if e is None else e for e in r] for r in rows], dtype=np.float64)
                defined = ~np.isnan(X)
                X0 = np.hstack([np.ones((X.shape[0], 1)), np.where(defined, X, 0.0)])
                M = np.hstack([np.ones((X.shape[0], 1)), defined.astype(np.float64)])
                S = X0.T @ X0
                N = M.T @ M
                k = key if isinstance(key, tuple) else (key,)
                if k in acc:
                    acc[k][0] += S
                    acc[k][1] += N
                else:
                    acc[k] = [S, N]
                    held += S.nbytes + N.nbytes
                if held >= max_bytes:
                    yield from emit(acc)
                    acc, held = {}, 0
        yield from emit(acc)

    return src.mapInPandas(fold, schema)


def gram_sums(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """Summed upper triangle (by..., i, j, s, n); i, j index the augmented vector [1, v]."""
    return gram_partials(df, vec, by).groupBy(*by, "i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def covariance(df: DataFrame, vec: str = "v", by: Sequence[str] = (), full: bool = True) -> DataFrame:
    """Long covariance (by..., i, j, O, NO, cov) with 0-based positions; full square when ``full``."""
    # The summed triangle is small (groups x (d+1)(d+2)/2 rows) and is read four times below (O,
    # two mean lookups, the mirror); without this checkpoint each read would re-run the scan and
    # the Python Gram stage (Python stages are not shared by exchange reuse).
    return covariance_of(cut_lineage(gram_sums(df, vec, by)), by, full)


def principal_sums(g: DataFrame, positions: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """The Gram sums of the vectors cut to ``positions`` (renumbered in that order), read off the stored sums ``g``."""
    wanted = F.array(*[F.lit(int(p)) for p in positions])
    # row 0 is the augmenting 1 and stays; array_position counts from 1 and gives 0 for what isn't wanted
    place = lambda c: F.when(F.col(c) == 0, F.lit(0)).otherwise(F.array_position(wanted, F.col(c) - 1).cast("int"))
    a, b = place("i"), place("j")
    kept = g.where(((F.col("i") == 0) | (a > 0)) & ((F.col("j") == 0) | (b > 0)))
    return kept.select(*by, F.least(a, b).alias("i"), F.greatest(a, b).alias("j"), "s", "n")


def covariance_of(g: DataFrame, by: Sequence[str] = (), full: bool = True) -> DataFrame:
    """``covariance`` from stored Gram sums."""
    by = list(by)
    mean = g.where(F.col("i") == 0).select(
        *by, (F.col("j") - 1).alias("_p"), F.try_divide(F.col("s"), F.col("n").cast("double")).alias("_m")
    ).where(F.col("_p") >= 0)
    o = g.where(F.col("i") > 0).select(*by, (F.col("i") - 1).alias("i"), (F.col("j") - 1).alias("j"), F.col("s").alias("O"), F.col("n").alias("NO"))
    c = o
    for side in ("i", "j"):  # a NULL key is a group like any other
        m = mean.select(*[F.col(k).alias(f"_by_{k}") for k in by], F.col("_p").alias("_at"), F.col("_m").alias(f"_m{side}"))
        same = F.col(side) == F.col("_at")
        for k in by:
            same &= F.col(k).eqNullSafe(F.col(f"_by_{k}"))
        c = c.join(m, same).drop("_at", *[f"_by_{k}" for k in by])
    c = c.select(*by, "i", "j", "O", "NO", (F.try_divide(F.col("O"), F.col("NO").cast("double")) - F.col("_mi") * F.col("_mj")).alias("cov"))
    if full:
        c = c.unionByName(c.where(F.col("i") != F.col("j")).select(*by, F.col("j").alias("i"), F.col("i").alias("j"), "O", "NO", "cov"))
    return c


def mean_vector(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """(by..., pos, E, NE, mean) from the first row of the Gram sums."""
    g = gram_sums(df, vec, by)
    return g.where((F.col("i") == 0) & (F.col("j") > 0)).select(
        *by, (F.col("j") - 1).alias("pos"), F.col("s").alias("E"), F.col("n").alias("NE"),
        F.try_divide(F.col("s"), F.col("n").cast("double")).alias("mean"),
    )
