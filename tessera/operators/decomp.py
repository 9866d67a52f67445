"""Bases, PCA, decomposition and reconstruction.

* ``fourier_basis`` builds the 9-vector orthonormal sine/cosine basis on d points as a table
  ``(k, pos, u)``; it is generated from a rule, so nothing is read to the driver.
* ``pca`` eigen-decomposes each group's d x d covariance in ``applyInPandas`` (one small matrix
  per group, bounded by d^2, never by the data); eigenpairs descending, sign fixed so the largest
  |entry| of each vector is positive.
* ``decompose`` projects every vector on a basis in Arrow batches (BLAS per batch).  The basis
  and mean are model parameters of bounded size (k x d), shipped once per task as a broadcast;
  their size is checked.

Decomposition definition (the reference's code is lost; this is ours, see SURVEY 2.12):
    r0 = v - mu, missing entries of v -> 0 in r0;  c_k = r0 . u_k;  r_k = r0 - sum_{i<=k} c_i u_i
    total_var = sum of v^2 over defined entries; res_mean = |r0|^2/total_var; res_k = |r_k|^2/total_var
    total_var = 0 -> residuals NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vec import to_double_array

# Broadcast guard: a basis/mean shipped to every task must stay small.
MAX_PARAM_ENTRIES = 4_000_000


def fourier_rows(d: int, harmonics: int = 4) -> np.ndarray:
    """Rows: const, sin x, cos x, sin 2x, cos 2x, ... on x = 2 pi pos / d, orthonormal."""
    x = 2 * math.pi * np.arange(d) / d
    c = math.sqrt(2.0 / d)
    rows = [np.full(d, math.sqrt(1.0 / d))]
    for h in range(1, harmonics + 1):
        rows.append(np.sin(h * x) * c)
        rows.append(np.cos(h * x) * c)
    return np.vstack(rows)


def fourier_basis(spark: SparkSession, d: int, harmonics: int = 4) -> DataFrame:
    """Basis table (k int, pos int, u double) built on the executors from ``range``."""
    return fourier_at(spark.range(d).select(F.col("id").cast("int").alias("pos")), d, harmonics)


def fourier_at(positions: DataFrame, d: int, harmonics: int = 4) -> DataFrame:
    """The entries (k, pos, u) of the d-point basis at the rows of ``positions`` (column pos)."""
    x = F.lit(2 * math.pi) * F.col("pos") / F.lit(float(d))
    c = F.lit(math.sqrt(2.0 / d))
    cols = [F.struct(F.lit(0).alias("k"), F.lit(math.sqrt(1.0 / d)).alias("u"))]
    for h in range(1, harmonics + 1):
        cols.append(F.struct(F.lit(2 * h - 1).alias("k"), (F.sin(F.lit(float(h)) * x) * c).alias("u")))
        cols.append(F.struct(F.lit(2 * h).alias("k"), (F.cos(F.lit(float(h)) * x) * c).alias("u")))
    return positions.select("pos", F.explode(F.array(*cols)).alias("e")).select(F.col("e.k").alias("k"), "pos", F.col("e.u").alias("u"))


def basis_gram(basis: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Gram matrix G[k, l] = sum_pos u_k u_l of a long basis (equals I for an orthonormal set)."""
    a = basis.select(*by, F.col("k").alias("k"), "pos", F.col("u").alias("_a"))
    b = basis.select(*by, F.col("k").alias("l"), "pos", F.col("u").alias("_b"))
    return a.join(b, list(by) + ["pos"]).groupBy(*by, "k", "l").agg(F.sum(F.col("_a") * F.col("_b")).alias("g"))


def defined_gram(cells: DataFrame, basis: DataFrame, by: Sequence[str], value: str = "v") -> DataFrame:
    """(by..., k, l, g): Gram matrix of a long basis over the defined cells (by..., pos, value) of each group.

    A group whose cells are all there n times has g = n on the diagonal and 0 beside it; holes show as
    departures from that. Cells are counted by (group, pos) before they meet the d x k basis, so a hot
    group gives d rows. Groups without a defined cell give no row; repeated cells count as often as they occur.
    """
    counts = cells.where(F.col(value).isNotNull()).groupBy(*by, "pos").agg(F.count(F.lit(1)).alias("_n"))
    pairs = basis.select("pos", "k", F.col("u").alias("_a")).join(basis.select("pos", F.col("k").alias("l"), F.col("u").alias("_b")), "pos")
    return counts.join(pairs, "pos").groupBy(*by, "k", "l").agg(F.sum(F.col("_n") * F.col("_a") * F.col("_b")).alias("g"))


def pca(cov: DataFrame, by: Sequence[str] = (), value: str = "cov", undefined: float | None = None) -> DataFrame:
    """Eigenpairs of each group's covariance: (by..., k, eigval, pos, u), k = 0 is the largest.

    A covariance is undefined (NULL, or no row) where no vector has both positions; that raises, unless ``undefined``
    says what to take for it."""
    by = list(by)
    src = cov.select(*by, "i", "j", F.col(value).alias("_c"))
    key_fields = [src.schema[k] for k in by]
    schema = T.StructType(
        key_fields
        + [
            T.StructField("k", T.IntegerType()),
            T.StructField("eigval", T.DoubleType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("u", T.DoubleType()),
        ]
    )

    def eig(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(max(pdf["i"].max(), pdf["j"].max())) + 1
        C = np.full((d, d), np.nan)
        C[pdf["i"].to_numpy(), pdf["j"].to_numpy()] = pdf["_c"].to_numpy(dtype=np.float64)
        if np.isnan(C).any():
            if undefined is None:
                raise ValueError("some positions are never defined together: pass undefined= for their covariance")
            C[np.isnan(C)] = undefined
        C = (C + C.T) / 2.0  # exact symmetry (input is the full square)
        w, V = np.linalg.eigh(C)
        order = np.argsort(-w, kind="stable")
        w, V = w[order], V[:, order]
        for k in range(d):
            if V[np.argmax(np.abs(V[:, k])), k] < 0:
                V[:, k] = -V[:, k]
        kk, pp = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
        out = {name: [pdf[name].iloc[0]] * (d * d) for name in by}
        out.update({"k": kk.ravel().astype(np.int32), "eigval": w[kk.ravel()], "pos": pp.ravel().astype(np.int32), "u": V.T.ravel()})
        return pd.DataFrame(out)

    if by:
        return src.groupBy(*by).applyInPandas(eig, schema)
    return src.groupBy(F.lit(0).alias("_g")).applyInPandas(eig, schema)


def variance_explained(eig: DataFrame, by: Sequence[str] = (), value: str = "eigval", order: str = "k") -> DataFrame:
    """Cumulative share of a spectrum: cum/total, a leading 0 row (k = -1), and percent.

    The spectrum is one row per component (bounded by d per group), so the running sum is a
    window over at most d rows per group.
    """
    from pyspark.sql import Window

    by = list(by)
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(*by)
    s = eig.select(*by, F.col(order).alias("k"), F.col(value).alias("_l")).distinct()
    frac = F.sum("_l").over(w) / F.sum("_l").over(tot)
    body = s.select(*by, "k", frac.alias("explained"))
    lead = s.select(*by).distinct().select(*by, F.lit(-1).cast("int").alias("k"), F.lit(0.0).alias("explained"))
    out = lead.unionByName(body.select(*by, F.col("k").cast("int").alias("k"), "explained"))
    return out.withColumn("percent", F.col("explained") * 100.0)


def _check_params(basis: np.ndarray, mean: np.ndarray | None) -> None:
    size = basis.size + (0 if mean is None else mean.size)
    if size > MAX_PARAM_ENTRIES:
        raise ValueError(f"basis + mean hold {size} entries; above {MAX_PARAM_ENTRIES}, use a grouped basis table")


def decompose(
    df: DataFrame,
    basis: np.ndarray,
    mean: np.ndarray | None = None,
    vec: str = "v",
    keep: Sequence[str] | None = None,
    with_arrays: bool = False,
) -> DataFrame:
    """Append total_var, res_mean, coeff_1..coeff_k, res_1..res_k (Arrow batches, one pass, no shuffle)."""
    U = np.asarray(basis, dtype=np.float64)
    k, d = U.shape
    mu = np.zeros(d) if mean is None else np.asarray(mean, dtype=np.float64)
    _check_params(U, mu)
    keep = list(keep) if keep is not None else [c for c in df.columns if c != vec]
    src = df.select(*keep, to_double_array(vec).alias("_v"))
    fields = [src.schema[c] for c in keep] + [T.StructField("total_var", T.DoubleType()), T.StructField("res_mean", T.DoubleType())]
    fields += [T.StructField(f"coeff_{i + 1}", T.DoubleType()) for i in range(k)]
    fields += [T.StructField(f"res_{i + 1}", T.DoubleType()) for i in range(k)]
    if with_arrays:
        fields += [T.StructField("coeffs", T.ArrayType(T.DoubleType()))]
    schema = T.StructType(fields)
    sc = df.sparkSession.sparkContext
    bU, bmu = sc.broadcast(U), sc.broadcast(mu)

    def run(it):
        U_, mu_ = bU.value, bmu.value
        for pdf in it:
            if pdf.empty:
                continue
            X = np.array([[np.nan if e is None else e for e in r] if r is not None else [np.nan] * d for r in pdf["_v"]], dtype=np.float64)
            defined = ~np.isnan(X)
            total = np.where(defined, X, 0.0)
            total = (total * total).sum(axis=1)
            R = np.where(defined, X - mu_, 0.0)
            C = R @ U_.T
            res = np.empty((len(X), k + 1))
            res[:, 0] = (R * R).sum(axis=1)
            cur = R.copy()
            for i in range(k):
                cur -= np.outer(C[:, i], U_[i])
                res[:, i + 1] = (cur * cur).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                norm = np.where(total[:, None] > 0, res / total[:, None], np.nan)
            out = pdf[keep].copy()
            out["total_var"] = total
            out["res_mean"] = norm[:, 0]
            for i in range(k):
                out[f"coeff_{i + 1}"] = C[:, i]
            for i in range(k):
                out[f"res_{i + 1}"] = norm[:, i + 1]
            if with_arrays:
                out["coeffs"] = list(C)
            yield out

    res = src.mapInPandas(run, schema)
    # NaN produced for total_var = 0 becomes NULL (library rule)
    return res.select(*[F.nanvl(F.col(f.name), F.lit(None)).alias(f.name) if f.name.startswith("res_") else F.col(f.name) for f in schema.fields])


def decompose_long(dec: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Wide decomposition -> (keys..., k, coeff, residual) with k = 0 the mean-only residual."""
    items = [F.struct(F.lit(0).alias("k"), F.lit(None).cast("double").alias("coeff"), F.col("res_mean").alias("residual"))]
    items += [F.struct(F.lit(i).alias("k"), F.col(f"coeff_{i}").alias("coeff"), F.col(f"res_{i}").alias("residual")) for i in range(1, k + 1)]
    return dec.select(*keys, F.explode(F.array(*items)).alias("e")).select(*keys, "e.k", "e.coeff", "e.residual")


def reconstruct(coeffs: DataFrame, basis: DataFrame, keys: Sequence[str], upto: int, mean: DataFrame | None = None) -> DataFrame:
    """w_k(pos) = mu(pos) + sum_{i<=upto} c_i u_i(pos) from long coefficient and basis tables.

    ``coeffs``: (keys..., k, coeff) with k 1-based; ``basis``: (k, pos, u) with k 0-based (row k-1);
    ``mean``: (pos, mean).  Spark picks the joins by measured size.
    """
    c = coeffs.where(F.col("k").between(1, upto)).select(*keys, (F.col("k") - 1).alias("k"), "coeff")
    j = c.join(basis, "k")
    w = j.groupBy(*keys, "pos").agg(F.sum(F.col("coeff") * F.col("u")).alias("w"))
    if mean is not None:
        w = w.join(mean.select("pos", F.col("mean").alias("_mu")), "pos").select(
            *keys, "pos", (F.col("w") + F.coalesce(F.col("_mu"), F.lit(0.0))).alias("w")
        )
    return w


def reconstruct_rows(dec: DataFrame, basis: np.ndarray, upto: int, mean: Sequence[float | None] | None = None, out: str = "w") -> DataFrame:
    """``dec`` (one row per series, coeff_1 ..) with w_k = mu + sum_{i<=upto} c_i u_i as an array, computed
    in the row: nothing is exploded or shuffled. ``basis`` is k x d, ``mean`` has d entries (NULL: 0)."""
    d = basis.shape[1]
    rows = [F.array(*[F.lit(float(x)) for x in basis[i]]) for i in range(upto)]
    base = F.array(*[F.lit(float(x or 0.0)) for x in (mean if mean is not None else [0.0] * d)])

    def at(p):
        total = base[p]
        for i, u in enumerate(rows):
            total = total + F.coalesce(F.col(f"coeff_{i + 1}"), F.lit(0.0)) * u[p]
        return total

    return dec.withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(d - 1)), at))
