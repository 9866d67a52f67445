"""Clustering and quantisation queries on ``embeddings``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.hashing import hash60_sql
from ..functions.rounding import rnd
from ..operators import cluster
from ..session import cut_lineage
from . import standins as S
from .registry import register
from .sqltext import VECS, rnd_sql

K = 10

# first K rows in hash order as the starting centres
_INIT = f"""
{VECS},
init AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY {hash60_sql('vec_id')}, vec_id) - 1 AS INTEGER) AS cid
         FROM embeddings ORDER BY {hash60_sql('vec_id')}, vec_id LIMIT {K}),
c0 AS (SELECT i.cid, v.pos, v.x AS m FROM init i JOIN vlong v ON v.vec_id = i.vec_id)
"""


def _assign_sql(points: str, cents: str, out: str) -> str:
    return f"""
{out}_d AS (SELECT p.vec_id, c.cid, sum((p.x - c.m) * (p.x - c.m)) AS d2 FROM {points} p JOIN {cents} c ON c.pos = p.pos GROUP BY 1, 2),
{out} AS (SELECT vec_id, cid AS cluster, d2 FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS r FROM {out}_d) WHERE r = 1)"""


def _move_sql(assign: str, cents: str, out: str) -> str:
    return f"""
{out}_m AS (SELECT a.cluster AS cid, v.pos, avg(v.x) AS m FROM {assign} a JOIN vlong v ON v.vec_id = a.vec_id GROUP BY 1, 2),
{out} AS (SELECT c.cid, c.pos, coalesce(n.m, c.m) AS m FROM {cents} c LEFT JOIN {out}_m n ON n.cid = c.cid AND n.pos = c.pos)"""


def _points(spark, sf):
    return S.vectors(spark, sf)


def _init(spark, sf):
    return cluster.first_k_by_hash(_points(spark, sf), K)


@register("nearest_centroid", f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')} SELECT vec_id, cluster, {rnd_sql('d2', 9)} AS d2 FROM a1")
def nearest_centroid(spark, sf):
    """Argmin over a broadcast codebook (no cross join); ties -> lowest centre index."""
    a = cluster.assign_nearest(_points(spark, sf), _init(spark, sf), keep=["vec_id"])
    return a.select("vec_id", "cluster", rnd("d2", 9).alias("d2"))


@register(
    "kmeans_error",
    f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')} SELECT {rnd_sql('sqrt(sum(d2) / (count(*) * 64))', 9)} AS rms_coord, "
    f"{rnd_sql('sqrt(sum(d2) / count(*))', 9)} AS rmse_point, count(*) AS n FROM a1",
)
def kmeans_error(spark, sf):
    """A24 (RMS over all coordinates) and A25 (per-point RMSE), both kept and named apart."""
    a = cluster.assign_nearest(_points(spark, sf), _init(spark, sf), keep=["vec_id"])
    e = cluster.kmeans_errors(a, 64)
    return e.select(rnd("rms_coord", 9).alias("rms_coord"), rnd("rmse_point", 9).alias("rmse_point"), "n")


@register("kmeans_step", f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')}, {_move_sql('a1', 'c0', 'c1')} SELECT cid, pos, {rnd_sql('m', 9)} AS centre FROM c1")
def kmeans_step(spark, sf):
    """One Lloyd step (C2/A23): assign, then cluster means; an empty cluster keeps its centre."""
    return _rounded(cluster.moved_centres(_points(spark, sf), _init(spark, sf)))


def _rounded(centres):
    return centres.select("cid", "pos", rnd("centre", 9).alias("centre"))


def _lloyd_sql(steps: int, first: str = "c0", prefix: str = "") -> str:
    """CTEs of ``steps`` Lloyd steps from the centres ``first``; the last ones are {prefix}c{steps}."""
    out, cents = [], first
    for i in range(1, steps + 1):
        a, c = f"{prefix}a{i}", f"{prefix}c{i}"
        out += [_assign_sql("vlong", cents, a), _move_sql(a, cents, c).replace(f"\n{c} AS (", f"\n{c} AS MATERIALIZED (")]
        cents = c
    return ", ".join(out)


@register(
    "kmeans_two_steps",
    f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')}, {_move_sql('a1', 'c0', 'c1')}, {_assign_sql('vlong', 'c1', 'a2')}, "
    f"{_move_sql('a2', 'c1', 'c2')} SELECT cid, pos, {rnd_sql('m', 9)} AS centre FROM c2",
)
def kmeans_two_steps(spark, sf):
    pts = _points(spark, sf)
    return _rounded(cluster.moved_centres(pts, cluster.lloyd(pts, _init(spark, sf), 1)))


@register("kmeans_ten_steps", f"WITH {_INIT}, {_lloyd_sql(10)} SELECT cid, pos, {rnd_sql('m', 9)} AS centre FROM c10")
def kmeans_ten_steps(spark, sf):
    """C2 over its ten steps."""
    pts = _points(spark, sf)
    return _rounded(cluster.moved_centres(pts, cluster.lloyd(pts, _init(spark, sf), 9)))


@register(
    "matched_centres",
    f"""WITH {_INIT}, {_lloyd_sql(3)},
t AS (SELECT CAST(label AS INTEGER) AS label, pos, avg(x) AS m FROM vlong GROUP BY 1, 2),
p AS (SELECT c.cid, t.label, round_even(sum((c.m - t.m) * (c.m - t.m)), 9) AS d2 FROM c3 c JOIN t ON t.pos = c.pos GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY d2, label) AS r FROM p)
SELECT cid, label, {rnd_sql('sqrt(d2)', 6)} AS distance FROM r WHERE r = 1""",
)
def matched_centres(spark, sf):
    """After three Lloyd steps, each centre's nearest mean of a label and the distance between them."""
    pts = _points(spark, sf)
    found = cluster.moved_centres(pts, cluster.lloyd(pts, _init(spark, sf), 2))
    true = cluster.group_means(pts.select(F.col("label").cast("int").alias("label"), "x"), "label")
    return cluster.matched_centres(found, true).select("cid", "label", rnd("distance", 6).alias("distance"))


_STARTS = {
    "spread": (f"ORDER BY {hash60_sql('vec_id')}, vec_id", ""),
    "one_label": (f"ORDER BY {hash60_sql('vec_id')}, vec_id", "WHERE label = 0"),
}


def _start_sql(name: str) -> str:
    order, only = _STARTS[name]
    return f"""
{name}_i AS (SELECT vec_id, CAST(row_number() OVER ({order}) - 1 AS INTEGER) AS cid FROM embeddings {only} {order} LIMIT {K}),
{name}_c0 AS MATERIALIZED (SELECT i.cid, v.pos, v.x AS m FROM {name}_i i JOIN vlong v ON v.vec_id = i.vec_id),
{_lloyd_sql(3, f'{name}_c0', f'{name}_')}, {_assign_sql('vlong', f'{name}_c3', f'{name}_end')}"""


@register(
    "kmeans_bad_start",
    f"WITH {VECS}, " + ", ".join(_start_sql(n) for n in _STARTS) + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS start, {rnd_sql('sqrt(sum(d2) / count(*))', 9)} AS rmse_point, count(DISTINCT cluster) AS n_used, count(*) AS n FROM {n}_end"
        for n in _STARTS
    ),
)
def kmeans_bad_start(spark, sf):
    """C3, the "bad init" run: three Lloyd steps from centres drawn among all points, and from ones of a single label."""
    pts = _points(spark, sf)
    out = None
    for name, start in (("spread", pts), ("one_label", pts.where(F.col("label") == 0))):
        end = cluster.assign_nearest(pts, cluster.lloyd(pts, cluster.first_k_by_hash(start, K), 3), keep=["vec_id"])
        row = end.agg(F.sqrt(F.sum("d2") / F.count(F.lit(1))).alias("e"), F.countDistinct("cluster").alias("n_used"), F.count(F.lit(1)).alias("n"))
        row = row.select(F.lit(name).alias("start"), rnd("e", 9).alias("rmse_point"), "n_used", "n")
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "vq_decode",
    f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')} SELECT a1.vec_id, a1.cluster, list({rnd_sql('c0.m', 9)} ORDER BY c0.pos) AS decoded "
    "FROM a1 JOIN c0 ON c0.cid = a1.cluster GROUP BY 1, 2",
)
def vq_decode(spark, sf):
    """Replace each point by its code's centre: the codebook stays a table, joined on the code."""
    pts = _points(spark, sf)
    book = _first_k(pts)
    a = cluster.nearest_of(pts.select("vec_id", "x"), book)
    decoded = book.select(F.col("cid").alias("cluster"), F.transform("c", lambda x: F.bround(x, 9) + F.lit(0.0)).alias("decoded"))
    return a.join(decoded, "cluster").select("vec_id", F.col("cluster").cast("int").alias("cluster"), "decoded")


def _first_k(pts):
    """The starting centres as a table (cid, c), kept as written."""
    first = pts.orderBy(cluster.hash_order("vec_id"), "vec_id").limit(K)
    number = F.row_number().over(Window.orderBy(cluster.hash_order("vec_id"), "vec_id")) - 1  # of K rows
    return cut_lineage(first.select(number.cast("bigint").alias("cid"), F.col("x").alias("c")))


@register(
    "vq_random_codebook",
    f"""WITH {VECS},
book AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY {hash60_sql('vec_id', 1)}, vec_id) - 1 AS INTEGER) AS cid
         FROM embeddings ORDER BY {hash60_sql('vec_id', 1)}, vec_id LIMIT {K + 1}),
cb AS (SELECT b.cid, v.pos, v.x AS m FROM book b JOIN vlong v ON v.vec_id = b.vec_id),
{_assign_sql('vlong', 'cb', 'a1')}
SELECT cluster, count(*) AS n FROM a1 GROUP BY 1""",
)
def vq_random_codebook(spark, sf):
    """A random codebook of k+1 rows (hash-picked with another seed); code usage counts."""
    pts = _points(spark, sf)
    C = cluster.first_k_by_hash(pts, K + 1, seed=1)
    a = cluster.assign_nearest(pts, C, keep=["vec_id"])
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@register(
    "vq_report",
    f"""WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')},
before AS (SELECT count(*) AS n FROM (SELECT DISTINCT list(round_even(x, 3) ORDER BY pos) FROM vlong GROUP BY vec_id))
SELECT (SELECT n FROM before) AS distinct_before, count(DISTINCT cluster) AS distinct_after,
       {rnd_sql('sqrt(sum(d2) / count(*))', 9)} AS rmse, {rnd_sql(f'log2({K})', 12)} AS bits FROM a1""",
)
def vq_report(spark, sf):
    """Distinct vectors before and after quantisation, distortion, bits per vector."""
    pts = _points(spark, sf)
    a = cluster.assign_nearest(pts, _init(spark, sf), keep=["vec_id"])
    r = cluster.quantisation_report(pts, a, K, digits=3)
    return r.select("distinct_before", "distinct_after", rnd("rmse", 9).alias("rmse"), rnd("bits", 12).alias("bits"))


@register("kmeans_fit")
def kmeans_fit(spark, sf):
    """Spark ML k-means (k-means||), best of three seeds by training cost; centres as a table."""
    model, cost, seed = cluster.kmeans_fit(_points(spark, sf), K, seeds=(1, 2, 3))
    rows = [(i, p, float(v)) for i, c in enumerate(model.clusterCenters()) for p, v in enumerate(c)]
    cent = spark.createDataFrame(rows, "cid int, pos int, centre double")
    return cent.withColumn("cost", F.lit(float(cost))).withColumn("seed", F.lit(seed))


@register("vq_encode")
def vq_encode(spark, sf):
    """C4: fit the codebook on all rows (Spark ML k-means is distributed), then label every row."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    pts = _points(spark, sf).select("vec_id", array_to_vector("x").alias("features"))
    m = KMeans(k=K, seed=1).fit(pts)
    return m.transform(pts).select("vec_id", F.col("prediction").alias("code"))


@register("elbow_curve")
def elbow_curve(spark, sf):
    """Training cost and per-point RMSE for k = 1..8 (one row per k)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    raw = _points(spark, sf)
    pts = raw.select(array_to_vector("x").alias("features")).cache()
    n = pts.count()
    # k = 1 (Spark ML needs k >= 2): the cost is the total squared distance to the global mean
    mean = cluster.codebook(cluster.group_means(raw.withColumn("_g", F.lit(0)), "_g"), "_g")[1]
    c1 = cluster.assign_nearest(raw, mean, keep=["vec_id"]).agg(F.sum("d2")).first()[0]
    rows = [(1, float(c1), float(np.sqrt(c1 / n)))]
    for k in range(2, 9):
        m = KMeans(k=k, seed=1, maxIter=20).fit(pts)
        rows.append((k, float(m.summary.trainingCost), float(np.sqrt(m.summary.trainingCost / n))))
    pts.unpersist()
    return spark.createDataFrame(rows, "k int, cost double, rmse double")


@register(
    "elbow_first",
    f"""WITH {VECS}, mu AS (SELECT pos, avg(x) AS m FROM vlong GROUP BY pos),
t AS (SELECT count(DISTINCT vec_id) AS n, sum((x - m) * (x - m)) AS cost FROM vlong JOIN mu USING (pos))
SELECT 1 AS k, {rnd_sql('cost', 6)} AS cost, {rnd_sql('sqrt(cost / n)', 9)} AS rmse FROM t""",
)
def elbow_first(spark, sf):
    """C7 at k = 1: the total squared distance to the global mean, by the same assignment as all other k."""
    pts = _points(spark, sf)
    mean = cluster.codebook(cluster.group_means(pts.withColumn("_g", F.lit(0)), "_g"), "_g")[1]
    a = cluster.assign_nearest(pts, mean, keep=["vec_id"]).agg(F.sum("d2").alias("cost"), F.count(F.lit(1)).alias("n"))
    return a.select(F.lit(1).alias("k"), rnd("cost", 6).alias("cost"), rnd(F.sqrt(F.col("cost") / F.col("n")), 9).alias("rmse"))


@register(
    "cluster_contingency",
    f"""WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')}
SELECT a1.cluster, CAST(e.label AS INTEGER) AS label, count(*) AS n FROM a1 JOIN embeddings e ON e.vec_id = a1.vec_id GROUP BY 1, 2""",
)
def cluster_contingency(spark, sf):
    """How many points of each label every cluster holds."""
    a = cluster.assign_nearest(_points(spark, sf), _init(spark, sf), keep=["label"])
    return a.groupBy("cluster", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def hungarian_max(M: np.ndarray) -> list[tuple[int, int]]:
    """Best one-to-one matching maximising the total of a small square matrix."""
    k = M.shape[0]
    # O(k^3) potentials method on the cost matrix -M
    C = M.max() - M
    u = np.zeros(k + 1); v = np.zeros(k + 1); p = np.zeros(k + 1, dtype=int); way = np.zeros(k + 1, dtype=int)
    for i in range(1, k + 1):
        p[0] = i; j0 = 0
        minv = np.full(k + 1, np.inf); used = np.zeros(k + 1, dtype=bool)
        while True:
            used[j0] = True; i0 = p[j0]; delta = np.inf; j1 = 0
            for j in range(1, k + 1):
                if not used[j]:
                    cur = C[i0 - 1, j - 1] - u[i0] - v[j]
                    if cur < minv[j]:
                        minv[j] = cur; way[j] = j0
                    if minv[j] < delta:
                        delta = minv[j]; j1 = j
            for j in range(k + 1):
                if used[j]:
                    u[p[j]] += delta; v[j] -= delta
                else:
                    minv[j] -= delta
            j0 = j1
            if p[j0] == 0:
                break
        while True:
            j1 = way[j0]; p[j0] = p[j1]; j0 = j1
            if j0 == 0:
                break
    return [(p[j] - 1, j - 1) for j in range(1, k + 1)]


@register("cluster_label_errors")
def cluster_label_errors(spark, sf):
    """Contingency (cluster x label) on Spark; best one-to-one match of the k x k table on the
    driver; label errors under that match."""
    pts = _points(spark, sf)
    a = cluster.assign_nearest(pts, _init(spark, sf), keep=["vec_id", "label"])
    cont = a.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n")).collect()  # <= k x labels cells
    labels = sorted({r["label"] for r in cont})
    side = max(K, len(labels))
    M = np.zeros((side, side))  # padded by empty clusters or labels
    for r in cont:
        M[r["cluster"], labels.index(r["label"])] = r["n"]
    match = hungarian_max(M)
    total = M.sum()
    correct = sum(M[i, j] for i, j in match)
    rows = [(int(i), int(labels[j]), int(M[i, j])) for i, j in match if i < K and j < len(labels)]
    out = spark.createDataFrame(rows, "cluster int, label int, n_matched int")
    return out.withColumn("label_error", F.lit(float(1 - correct / total)))


@register(
    "nearest_in_blocks",
    f"WITH {_INIT}, {_assign_sql('vlong', 'c0', 'a1')} SELECT vec_id, CAST(cluster AS BIGINT) AS cluster, {rnd_sql('d2', 9)} AS d2 FROM a1",
)
def nearest_in_blocks(spark, sf):
    """J5 for codebooks of any size: the codebook is a table whose blocks meet the points one after the other (here
    three centres a block), merged by the least (distance, centre)."""
    pts = _points(spark, sf)
    a = cluster.nearest_of(pts.select("vec_id", "x"), _first_k(pts), block_entries=6 * 64)
    return a.select("vec_id", "cluster", rnd("d2", 9).alias("d2"))


@register("intrinsic_dim")
def intrinsic_dim(spark, sf):
    """C9 in rounds (k-means|| style picks) up to a tenth of the points, then (ln N1 - ln N2) / (ln d2 - ln d1)."""
    curve = cluster.centre_curve(_points(spark, sf))
    dim = cluster.intrinsic_dimension(curve)
    rows = [(i, n, d) for i, (n, d) in enumerate(curve)]
    return spark.createDataFrame(rows, "round int, n_centres int, mean_dist double").withColumn("dimension", F.lit(dim).cast("double"))
