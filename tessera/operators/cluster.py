"""Centroids, nearest-centroid assignment, Lloyd steps, k-means fits and quantisation reports.

Nearest-centroid join without a cross join: the codebook (k x d, size-checked) is broadcast once
per task and every Arrow batch of points is scored against it, one centre after the other; ties go to
the lowest centroid index (``np.argmin``).  New centroids are a ``groupBy(cluster, pos)`` average
(partial aggregation), so one huge cluster is averaged across all tasks that hold its points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash60, uniform
from ..functions.vec import to_double_array
from ..session import cut_lineage

MAX_CODEBOOK_ENTRIES = 4_000_000  # k * d shipped to each task


def group_means(df: DataFrame, group: str, vec: str = "x") -> DataFrame:
    """(group, pos, mean) -- NULL-aware per-position means of each group's vectors."""
    e = df.select(group, F.posexplode(to_double_array(vec)).alias("pos", "_x"))
    return e.groupBy(group, "pos").agg(F.avg("_x").alias("mean"))


def codebook(means: DataFrame, group: str, pos: str = "pos", value: str = "mean") -> tuple[np.ndarray, np.ndarray]:
    """Collect a (k x d) codebook; k x d is bounded by the caller's k and the vector width."""
    rows = means.select(group, pos, value).limit(MAX_CODEBOOK_ENTRIES + 1).collect()
    if len(rows) > MAX_CODEBOOK_ENTRIES:
        raise ValueError(f"codebook exceeds {MAX_CODEBOOK_ENTRIES} entries")
    ids = sorted({r[0] for r in rows})
    d = max(r[1] for r in rows) + 1
    if len(ids) * d > MAX_CODEBOOK_ENTRIES:
        raise ValueError(f"codebook {len(ids)}x{d} exceeds {MAX_CODEBOOK_ENTRIES} entries")
    idx = {c: i for i, c in enumerate(ids)}
    C = np.zeros((len(ids), d))
    for g, p, v in rows:
        C[idx[g], p] = 0.0 if v is None else v
    return np.array(ids), C


def _matrix(col: pd.Series, d: int) -> np.ndarray:
    """Rows of ``d`` numbers as one array; missing vectors and vectors of another length are NaN or an error."""
    if not col.isna().any():
        return np.concatenate(col.to_numpy()).astype(np.float64, copy=False).reshape(len(col), d)
    out = np.full((len(col), d), np.nan)
    there = col.notna().to_numpy()
    if there.any():
        out[there] = np.concatenate(col[there].to_numpy()).astype(np.float64, copy=False).reshape(-1, d)
    return out


def score_matrix(df: DataFrame, centres: np.ndarray, vec: str = "x", keep: Sequence[str] | None = None, out: str = "scores") -> DataFrame:
    """scores[c] = -||x - centre_c||^2 for every centre, as ``array<double>`` (Arrow batches)."""
    C = np.asarray(centres, dtype=np.float64)
    if C.size > MAX_CODEBOOK_ENTRIES:
        raise ValueError("codebook too large to broadcast")
    keep = list(keep) if keep is not None else [c for c in df.columns if c != vec]
    src = df.select(*keep, to_double_array(vec).alias("_x"))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    bC = df.sparkSession.sparkContext.broadcast(C)

    def run(it):
        Cv = bC.value
        for pdf in it:
            if pdf.empty:
                continue
            X = _matrix(pdf["_x"], Cv.shape[1])
            D = np.empty((X.shape[0], Cv.shape[0]))
            for j in range(Cv.shape[0]):  # one centre at a time: no batch x k x d temporary
                diff = X - Cv[j]
                D[:, j] = (diff * diff).sum(axis=1)
            o = pdf[keep].copy()
            o[out] = list(-D)
            yield o

    return src.mapInPandas(run, schema)


def assign_nearest(df: DataFrame, centres: np.ndarray, vec: str = "x", keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``cluster`` (index of the nearest centre, ties -> lowest) and ``d2`` (squared distance)."""
    C = np.asarray(centres, dtype=np.float64)
    if C.size > MAX_CODEBOOK_ENTRIES:
        raise ValueError("codebook too large to broadcast")
    keep = list(keep) if keep is not None else [c for c in df.columns if c != vec]
    src = df.select(*keep, to_double_array(vec).alias("_x"))
    schema = T.StructType(
        [src.schema[c] for c in keep] + [T.StructField("cluster", T.IntegerType()), T.StructField("d2", T.DoubleType())]
    )
    bC = df.sparkSession.sparkContext.broadcast(C)

    def run(it):
        Cv = bC.value
        for pdf in it:
            if pdf.empty:
                continue
            X = _matrix(pdf["_x"], Cv.shape[1])
            D = np.zeros((X.shape[0], Cv.shape[0]))
            for j in range(Cv.shape[0]):  # exact per-centre sums (no |x|^2 - 2x.c + |c|^2 cancellation)
                diff = X - Cv[j]
                D[:, j] = (diff * diff).sum(axis=1)
            o = pdf[keep].copy()
            k = D.argmin(axis=1)
            o["cluster"] = k.astype(np.int32)
            o["d2"] = D[np.arange(len(k)), k]
            yield o

    return src.mapInPandas(run, schema)


def moved_centres(points: DataFrame, centres: np.ndarray, vec: str = "x") -> DataFrame:
    """Centres after one Lloyd step as a table (cid, pos, centre): the means of the points assigned to each; a centre
    without points stays (its numbers are added by a left-over join against k x d rows)."""
    a = assign_nearest(points, centres, vec, keep=[vec])
    means = group_means(a.select(F.col("cluster").alias("cid"), vec), "cid", vec).withColumnRenamed("mean", "centre")
    k, d = np.asarray(centres).shape
    old = [(int(c), int(p), float(centres[c, p])) for c in range(k) for p in range(d)]
    book = points.sparkSession.createDataFrame(old, "cid int, pos int, centre double")
    return means.unionByName(book.join(means.select("cid", "pos"), ["cid", "pos"], "left_anti"))


def lloyd_step(points: DataFrame, centres: np.ndarray, vec: str = "x", key: str = "vec_id") -> tuple[np.ndarray, DataFrame]:
    """One Lloyd iteration: assign, then move centres to cluster means (empty cluster keeps its centre)."""
    a = assign_nearest(points, centres, vec, keep=[key, vec])
    means = group_means(a.select("cluster", vec), "cluster", vec)
    new = np.array(centres, dtype=np.float64, copy=True)
    for r in means.limit(MAX_CODEBOOK_ENTRIES).collect():  # k x d rows
        new[r["cluster"], r["pos"]] = r["mean"]
    return new, a


def lloyd(points: DataFrame, centres: np.ndarray, steps: int, vec: str = "x", key: str = "vec_id") -> np.ndarray:
    """``steps`` Lloyd steps; only the k x d centres come back between steps."""
    for _ in range(steps):
        centres, _ = lloyd_step(points, centres, vec, key)
    return centres


def matched_centres(found: DataFrame, true: DataFrame) -> DataFrame:
    """Each found centre (cid, pos, centre) with the nearest true one (label, pos, mean; ties: the smaller label) and their
    distance. Both are codebooks, so the pairs of one position are at most k^2."""
    j = found.join(true, "pos").groupBy("cid", "label").agg(F.sum(F.pow(F.col("centre") - F.col("mean"), 2)).alias("_d2"))
    best = j.groupBy("cid").agg(F.min(F.struct(F.bround("_d2", 9).alias("d2"), "label")).alias("_b"))
    return best.select("cid", F.col("_b.label").alias("label"), F.sqrt("_b.d2").alias("distance"))


def kmeans_errors(assigned: DataFrame, d: int) -> DataFrame:
    """RMS over all coordinates sqrt(sum d2 / (n d)) and per-point RMSE sqrt(sum d2 / n)."""
    return assigned.agg(
        F.sqrt(F.sum("d2") / (F.count(F.lit(1)) * F.lit(float(d)))).alias("rms_coord"),
        F.sqrt(F.sum("d2") / F.count(F.lit(1))).alias("rmse_point"),
        F.count(F.lit(1)).alias("n"),
    )


def hash_order(key: str, seed: int = 0):
    """Deterministic pseudo-random order by the shared 60-bit hash (same in DuckDB)."""
    return hash60(key, seed)


def first_k_by_hash(points: DataFrame, k: int, key: str = "vec_id", vec: str = "x", seed: int = 0) -> np.ndarray:
    """k starting centres: the first k rows in hash order (a top-k, not a full sort)."""
    rows = points.orderBy(hash_order(key, seed), F.col(key)).limit(k).select(to_double_array(vec).alias("_x")).collect()
    return np.array([r["_x"] for r in rows], dtype=np.float64)


def kmeans_fit(points: DataFrame, k: int, vec: str = "x", seeds: Sequence[int] = (1, 2, 3), init: str = "k-means||", max_iter: int = 20):
    """Spark ML k-means over several seeds; keep the least training cost (scikit-learn's n_init)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = points.select("*", array_to_vector(to_double_array(vec)).alias("_features"))
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, initMode=init, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(data)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost, s)
    return best


def quantisation_report(points: DataFrame, assigned: DataFrame, k: int, vec: str = "x", digits: int = 3) -> DataFrame:
    """Distinct vectors before (rounded) and after (k codes), distortion, bits per vector = log2 k."""
    before = points.select(F.transform(to_double_array(vec), lambda x: F.bround(x, digits)).alias("_r")).distinct().count()
    return assigned.agg(
        F.lit(before).cast("long").alias("distinct_before"),
        F.countDistinct("cluster").alias("distinct_after"),
        F.sqrt(F.sum("d2") / F.count(F.lit(1))).alias("rmse"),
        F.lit(math.log2(k)).alias("bits"),
    )


def nearest_of(points: DataFrame, centres: DataFrame, vec: str = "x", block_entries: int = MAX_CODEBOOK_ENTRIES) -> DataFrame:
    """``points`` with ``cluster`` and ``d2`` lowered to the nearest of ``centres`` (cid bigint, c array<double>).

    For codebooks of any size: the centres are split into blocks of about ``block_entries`` numbers by the hash of their
    id, the points meet one broadcast block after the other, and the least (distance, id) is kept, so only one
    block is held at a time. Points that come with ``cluster`` and ``d2`` keep them where they are nearer; so a
    growing set of centres needs only its new ones.
    """
    if not {"cluster", "d2"} <= set(points.columns):
        points = points.withColumn("cluster", F.lit(None).cast("bigint")).withColumn("d2", F.lit(float("inf")))
    keep = [c for c in points.columns if c not in (vec, "cluster", "d2")]
    points = points.select(*keep, to_double_array(vec).alias(vec), "cluster", "d2")
    size = centres.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("c")).alias("d")).first()
    # half of the limit, as hashing doesn't cut evenly
    blocks = max(1, math.ceil(2 * size["k"] * (size["d"] or 0) / block_entries))
    context = points.sparkSession.sparkContext
    for b in range(blocks if size["k"] else 0):
        block = centres.where(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == b).select("cid", "c").orderBy("cid").toArrow()
        if not block.num_rows:
            continue
        C = block["c"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1)
        shared = context.broadcast((block["cid"].to_numpy(), C))

        def lower(batches, shared=shared):
            import pyarrow as pa

            ids, C = shared.value
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                at = batch.schema.get_field_index(vec)
                X = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                none = np.iinfo(np.int64).max
                best = batch.column(at + 1).fill_null(none).to_numpy(zero_copy_only=False).copy()
                d2 = batch.column(at + 2).to_numpy(zero_copy_only=False).copy()
                for cid, c in zip(ids, C):
                    diff = X - c
                    d = (diff * diff).sum(axis=1)
                    nearer = (d < d2) | ((d == d2) & (cid < best))
                    d2[nearer], best[nearer] = d[nearer], cid
                cols = [batch.column(k) for k in range(at + 1)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(best, mask=best == none), pa.array(d2)], names=batch.schema.names)

        points = points.mapInArrow(lower, points.schema)
    return points


def centre_curve(points: DataFrame, vec: str = "x", key: str = "vec_id", fraction: float = 0.1, rounds: int = 12, seed: int = 7):
    """Centres picked in rounds with probability ~ d^2 / sum d^2 (the k-means|| scheme), up to about ``fraction`` of all points.

    Returns (number of centres, mean distance of points to their nearest centre) after each round: the curve
    used to estimate intrinsic dimension. The number of centres grows by a constant factor from round to round. Centres
    stay a table; every round compares the points with that round's new centres only and keeps the least
    distance as a column (one checkpoint of the points each round). Picks are by a hash of (key, round), so runs
    are deterministic. The last round's picks are compared too: the curve ends at the full set.
    """
    n = points.count()
    if not n:
        return []
    target = max(1, math.ceil(fraction * n))
    state = points.select(key, to_double_array(vec).alias(vec))
    new = state.orderBy(hash_order(key, seed), F.col(key)).limit(1)
    count, curve = 1, []
    for r in range(rounds + 1):
        state = cut_lineage(nearest_of(state, new.select(F.hash(key).cast("bigint").alias("cid"), F.col(vec).alias("c")), vec))
        tot = state.agg(F.sum("d2").alias("s"), F.avg(F.sqrt("d2")).alias("m")).first()
        curve.append((count, float(tot["m"] or 0.0)))
        if r == rounds or not tot["s"]:
            break
        want = max(1.0, target ** ((r + 1) / rounds) - count)
        new = cut_lineage(state.where(uniform(key, 1000 * seed + r + 1) < F.lit(want) * F.col("d2") / F.lit(float(tot["s"]))).select(key, vec))
        count += new.count()
    return curve


def intrinsic_dimension(curve: Sequence[tuple[int, float]]) -> float | None:
    """(ln N1 - ln N2) / (ln d2 - ln d1) with N1 at 10 % and N2 at the end of the curve."""
    if len(curve) < 2:
        return None
    n1 = int(0.1 * len(curve))
    n2 = len(curve) - 1
    (N1, d1), (N2, d2) = curve[n1], curve[n2]
    if d1 <= 0 or d2 <= 0 or d1 == d2:
        return None
    return (math.log(N1) - math.log(N2)) / (math.log(d2) - math.log(d1))
