"""Covariance, PCA, Fourier basis, decomposition, reconstruction and feature rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.rounding import rnd, sig
from ..operators import decomp, gram, stats
from ..session import cut_lineage
from . import standins as S
from .registry import register
from .sqltext import EVENT_SERIES, SERIES, VECS, rnd_sql, sig_sql

K_FOURIER = 9


def _fourier_sql(name: str, positions: str, d: str, harmonics: int = 4, limit_k: int | None = None) -> str:
    """DuckDB text for a Fourier basis table ``name(k, pos, u)`` over ``positions`` (cols pos, d)."""
    parts = [f"SELECT 0 AS k, pos, sqrt(1e0 / {d}) AS u FROM {positions}"]
    for h in range(1, harmonics + 1):
        parts.append(f"SELECT {2 * h - 1} AS k, pos, sin({h} * 2 * pi() * pos / {d}) * sqrt(2e0 / {d}) AS u FROM {positions}")
        parts.append(f"SELECT {2 * h} AS k, pos, cos({h} * 2 * pi() * pos / {d}) * sqrt(2e0 / {d}) AS u FROM {positions}")
    body = " UNION ALL ".join(parts)
    if limit_k is not None:
        body = f"SELECT * FROM ({body}) WHERE k < {limit_k}"
    return f"{name} AS ({body})"


def _series_mean(series):
    """Per-position NaN-mean of the series as a NumPy vector (d values: a bounded collect)."""
    m = stats.position_stats(series).select("pos", "mean").collect()
    out = np.zeros(max(r["pos"] for r in m) + 1)
    for r in m:
        out[r["pos"]] = r["mean"] if r["mean"] is not None else 0.0
    return out


# ---------------------------------------------------------------- covariance (M2)

_COV_SQL = f"""
WITH {SERIES},
mu AS (SELECT pos, avg(v) AS m FROM series GROUP BY pos),
pairs AS (
  SELECT a.pos AS i, b.pos AS j, sum(a.v * b.v) AS o, count(a.v * b.v) AS n
  FROM series a JOIN series b ON a.station = b.station AND a.yr = b.yr GROUP BY 1, 2)
SELECT p.i, p.j, p.n AS "NO", {sig_sql('p.o', 8)} AS "O", {sig_sql('p.o / p.n - mi.m * mj.m', 8)} AS cov
FROM pairs p JOIN mu mi ON mi.pos = p.i JOIN mu mj ON mj.pos = p.j
"""


@register("covariance", _COV_SQL)
def covariance(spark, sf):
    c = gram.covariance(S.nation_year_series(spark, sf))
    return c.select("i", "j", "NO", sig("O", 8).alias("O"), sig("cov", 8).alias("cov"))


@register(
    "covariance_by_group",
    f"""
WITH {EVENT_SERIES},
mu AS (SELECT event_type, pos, avg(v) AS m FROM eseries GROUP BY 1, 2),
pairs AS (
  SELECT a.event_type, a.pos AS i, b.pos AS j, sum(a.v * b.v) AS o, count(a.v * b.v) AS n
  FROM eseries a JOIN eseries b ON a.user_id = b.user_id AND a.event_type = b.event_type GROUP BY 1, 2, 3)
SELECT p.event_type, p.i, p.j, p.n AS "NO", {sig_sql('p.o / p.n - mi.m * mj.m', 7)} AS cov
FROM pairs p JOIN mu mi ON mi.event_type = p.event_type AND mi.pos = p.i
             JOIN mu mj ON mj.event_type = p.event_type AND mj.pos = p.j
WHERE p.n > 0
""",
)
def covariance_by_group(spark, sf):
    """M1: all groups (event types) in one job -- one scan, one shuffle, no driver loop."""
    c = gram.covariance(S.user_event_series(spark, sf), by=["event_type"])
    return c.where(F.col("NO") > 0).select("event_type", "i", "j", "NO", sig("cov", 7).alias("cov"))


@register(
    "position_stats_by_group",
    f"""
WITH {EVENT_SERIES}
SELECT event_type, pos, {sig_sql('sum(v)', 11)} AS E, count(v) AS NE, {sig_sql('avg(v)', 11)} AS mean
FROM eseries GROUP BY 1, 2
""",
)
def position_stats_by_group(spark, sf):
    s = stats.position_stats(S.user_event_series(spark, sf), by=["event_type"])
    return s.select("event_type", "pos", sig("E", 11).alias("E"), "NE", sig("mean", 11).alias("mean"))


# ---------------------------------------------------------------- PCA (M3)


@register("pca_eigen")
def pca_eigen(spark, sf):
    """Eigenpairs of the nation-year covariance, descending, sign-fixed (rows-only check + pytest)."""
    return decomp.pca(gram.covariance(S.nation_year_series(spark, sf)))


@register(
    "pca_trace",
    f"""
WITH {SERIES}
SELECT {sig_sql('sum(var)', 8)} AS trace FROM (
  SELECT pos, sum(v * v) / count(v) - (sum(v) / count(v)) * (sum(v) / count(v)) AS var FROM series GROUP BY pos)
""",
)
def pca_trace(spark, sf):
    """Sum of eigenvalues from the eigen-solver = sum of per-position variances."""
    e = decomp.pca(gram.covariance(S.nation_year_series(spark, sf))).select("k", "eigval").distinct()
    return e.agg(sig(F.sum("eigval"), 8).alias("trace"))


@register(
    "variance_explained",
    f"""
WITH {SERIES},
spec AS (SELECT pos, sum(v * v) / count(v) - (sum(v) / count(v)) * (sum(v) / count(v)) AS var FROM series GROUP BY pos),
ranked AS (SELECT CAST(row_number() OVER (ORDER BY var DESC, pos) - 1 AS INTEGER) AS k, var FROM spec),
body AS (SELECT k, sum(var) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(var) OVER () AS explained FROM ranked)
SELECT k, {rnd_sql('explained', 9)} AS explained, {rnd_sql('explained * 100', 7)} AS percent FROM body
UNION ALL SELECT -1, 0.0, 0.0
""",
)
def variance_explained(spark, sf):
    """W7 on the per-position variance spectrum (sorted descending); leading 0 row at k = -1."""
    spec = stats.position_stats(S.nation_year_series(spark, sf)).select("pos", "var")
    ranked = spec.select((F.row_number().over(Window.orderBy(F.desc("var"), "pos")) - 1).cast("int").alias("k"), "var")
    ve = decomp.variance_explained(ranked, value="var")
    return ve.select("k", rnd("explained", 9).alias("explained"), rnd("percent", 7).alias("percent"))


# ---------------------------------------------------------------- Fourier basis (M5, M6)

_POS_SQL = "P AS (SELECT DISTINCT pos FROM cell), D AS (SELECT pos, count(*) OVER () AS d FROM P)"


def _observed_basis(spark, sf):
    """The basis at the months that occur, from the table of those; d is their number."""
    months = cut_lineage(S.nation_year_cells(spark, sf).select("pos").distinct())
    return decomp.fourier_at(months, months.count())


@register(
    "fourier_basis",
    f"""
WITH {SERIES}, {_POS_SQL}, {_fourier_sql('basis', 'D', 'd')}
SELECT CAST(k AS INTEGER) AS k, CAST(pos AS INTEGER) AS pos, {rnd_sql('u', 9)} AS u FROM basis
""",
)
def fourier_basis(spark, sf):
    """9-vector orthonormal basis on the positions observed in the nation-year cells."""
    return _observed_basis(spark, sf).select("k", "pos", rnd("u", 9).alias("u"))


@register(
    "basis_gram",
    f"""
WITH {SERIES}, {_POS_SQL}, {_fourier_sql('basis', 'D', 'd')}
SELECT CAST(a.k AS INTEGER) AS k, CAST(b.k AS INTEGER) AS l, {rnd_sql('sum(a.u * b.u)', 9)} AS g
FROM basis a JOIN basis b ON a.pos = b.pos GROUP BY a.k, b.k
""",
)
def basis_gram(spark, sf):
    return decomp.basis_gram(_observed_basis(spark, sf)).select("k", "l", rnd("g", 9).alias("g"))


_BASIS12 = _fourier_sql("basis0", "(SELECT CAST(range AS INTEGER) AS pos, 12 AS d FROM range(12))", "d")


@register(
    "basis_gram_by_station",
    f"""
WITH {SERIES}, {_BASIS12}
SELECT s.station, CAST(a.k AS INTEGER) AS k, CAST(b.k AS INTEGER) AS l, {rnd_sql('sum(a.u * b.u)', 8)} AS g
FROM series s JOIN basis0 a ON a.pos = s.pos JOIN basis0 b ON b.pos = s.pos WHERE s.v IS NOT NULL GROUP BY s.station, a.k, b.k
""",
)
def basis_gram_by_station(spark, sf):
    """M6 on the data: the basis' Gram matrix over the defined cells of each station's series."""
    basis = decomp.fourier_basis(spark, S.NATION_YEAR_D)
    g = decomp.defined_gram(S.nation_year_cells(spark, sf), basis, ["station"])
    return g.select("station", "k", "l", rnd("g", 8).alias("g"))


# ---------------------------------------------------------------- decomposition (M7, M8, M9)


def _decompose_sql(select: str) -> str:
    coeff_cols = ", ".join(f"max(CASE WHEN k = {i} THEN c END) AS coeff_{i}" for i in range(1, K_FOURIER + 1))
    res_cols = ", ".join(f"max(CASE WHEN k = {i} THEN rr END) AS res_{i}" for i in range(1, K_FOURIER + 1))
    return f"""
WITH {SERIES},
mu AS (SELECT pos, avg(v) AS m FROM series GROUP BY pos),
{_fourier_sql('basis0', '(SELECT CAST(range AS INTEGER) AS pos, 12 AS d FROM range(12))', 'd')},
basis AS (SELECT k + 1 AS k, pos, u FROM basis0),
r0 AS (SELECT s.station, s.yr, s.pos, s.v, CASE WHEN s.v IS NULL THEN 0e0 ELSE s.v - mu.m END AS r
       FROM series s JOIN mu ON s.pos = mu.pos),
tot AS (SELECT station, yr, sum(coalesce(v * v, 0e0)) AS total_var, sum(r * r) AS rr0 FROM r0 GROUP BY 1, 2),
coef AS (SELECT station, yr, k, sum(r * u) AS c FROM r0 JOIN basis ON r0.pos = basis.pos GROUP BY 1, 2, 3),
contrib AS (SELECT coef.station, coef.yr, basis.pos, coef.k,
                   sum(coef.c * basis.u) OVER (PARTITION BY coef.station, coef.yr, basis.pos ORDER BY coef.k) AS cum
            FROM coef JOIN basis ON coef.k = basis.k),
resid AS (SELECT r0.station, r0.yr, contrib.k, sum((r0.r - contrib.cum) * (r0.r - contrib.cum)) AS rr
          FROM r0 JOIN contrib ON r0.station = contrib.station AND r0.yr = contrib.yr AND r0.pos = contrib.pos
          GROUP BY 1, 2, 3),
ck AS (SELECT c.station, c.yr, c.k, c.c, r.rr / t.total_var AS rr FROM coef c
       JOIN resid r ON r.station = c.station AND r.yr = c.yr AND r.k = c.k
       JOIN tot t ON t.station = c.station AND t.yr = c.yr),
wide AS (SELECT t.station, t.yr, t.total_var, t.rr0 / t.total_var AS res_mean, {coeff_cols}, {res_cols}
         FROM tot t JOIN ck ON ck.station = t.station AND ck.yr = t.yr
         GROUP BY t.station, t.yr, t.total_var, t.rr0)
{select}
"""


def _decomposed(spark, sf):
    # the series table (keys x d) is read twice -- mean vector, then projection -- so it is
    # checkpointed once instead of re-running the orders x customer scan
    series = cut_lineage(S.nation_year_series(spark, sf))
    U = decomp.fourier_rows(S.NATION_YEAR_D)
    return decomp.decompose(series, U, _series_mean(series), keep=["station", "yr"])


_WIDE_OUT = ["station", "yr", "total_var", "res_mean"] + [f"coeff_{i}" for i in range(1, K_FOURIER + 1)] + [
    f"res_{i}" for i in range(1, K_FOURIER + 1)
]


# Coefficients and residuals that are zero but for summation noise (a series of one month, say) have no
# significant digits: noise is cut off first, far below the eight digits kept of the others.
_NOISE = {"coeff": 5, "res": 12}


def _out(name: str, kind: str | None = None):
    floor = _NOISE.get(kind or name.split("_")[0])
    return sig(name if floor is None else rnd(name, floor), 8)


def _out_sql(name: str) -> str:
    floor = _NOISE.get(name.split("_")[0])
    return sig_sql(name if floor is None else rnd_sql(name, floor), 8)


@register(
    "decompose",
    _decompose_sql("SELECT station, yr, " + ", ".join(f"{_out_sql(c)} AS {c}" for c in _WIDE_OUT[2:]) + " FROM wide"),
)
def decompose(spark, sf):
    d = _decomposed(spark, sf)
    return d.select("station", "yr", *[_out(c).alias(c) for c in _WIDE_OUT[2:]])


@register(
    "decompose_long",
    _decompose_sql(
        "SELECT station, yr, 0 AS k, CAST(NULL AS DOUBLE) AS coeff, "
        + _out_sql("res_mean")
        + " AS residual FROM wide UNION ALL "
        + " UNION ALL ".join(
            f"SELECT station, yr, {i} AS k, {_out_sql(f'coeff_{i}')}, {_out_sql(f'res_{i}')} FROM wide" for i in range(1, K_FOURIER + 1)
        )
    ),
)
def decompose_long(spark, sf):
    lg = decomp.decompose_long(_decomposed(spark, sf), ["station", "yr"], K_FOURIER)
    return lg.select("station", "yr", "k", _out("coeff").alias("coeff"), _out("residual", "res").alias("residual"))


@register(
    "filter_residual",
    _decompose_sql(
        "SELECT station, yr, " + sig_sql("res_2", 8) + " AS res_2 FROM wide WHERE res_2 < (SELECT median(res_2) FROM wide)"
    ),
)
def filter_residual(spark, sf):
    """Keep vectors whose residual after 2 basis vectors is under the data's median residual."""
    d = _decomposed(spark, sf)
    # the median from a distributed rank, so no task holds all values; a scalar, so the cut is a filter
    keyed = d.select("res_2", F.concat_ws(":", "station", "yr").alias("key"))
    found = stats.exact_quantiles(keyed, "res_2", "key", [0.5]).first()
    return d.where(F.col("res_2") < F.lit(found["value"] if found else None)).select("station", "yr", sig("res_2", 8).alias("res_2"))


_RECON_K = 3


@register(
    "reconstruct",
    f"""
WITH {SERIES},
mu AS (SELECT pos, avg(v) AS m FROM series GROUP BY pos),
{_fourier_sql('basis0', '(SELECT CAST(range AS INTEGER) AS pos, 12 AS d FROM range(12))', 'd')},
r0 AS (SELECT s.station, s.yr, s.pos, CASE WHEN s.v IS NULL THEN 0e0 ELSE s.v - mu.m END AS r
       FROM series s JOIN mu ON s.pos = mu.pos),
coef AS (SELECT station, yr, k, sum(r * u) AS c FROM r0 JOIN basis0 b ON r0.pos = b.pos WHERE k < {_RECON_K} GROUP BY 1, 2, 3),
w AS (SELECT coef.station, coef.yr, b.pos, sum(coef.c * b.u) AS w FROM coef JOIN basis0 b ON coef.k = b.k GROUP BY 1, 2, 3)
SELECT w.station, w.yr, w.pos, {sig_sql('w.w + mu.m', 8)} AS w FROM w JOIN mu ON mu.pos = w.pos
""",
)
def reconstruct(spark, sf):
    """M9: w_3 = mu + sum_{i<=3} c_i u_i on the Fourier basis, in the row."""
    w = _reconstructed(spark, sf).select("station", "yr", F.posexplode("w").alias("pos", "w"))
    return w.select("station", "yr", "pos", sig("w", 8).alias("w"))


def _reconstructed(spark, sf):
    mean = {r["pos"]: r["mean"] for r in stats.position_stats(S.nation_year_series(spark, sf)).select("pos", "mean").collect()}  # d rows
    U = decomp.fourier_rows(S.NATION_YEAR_D)
    return decomp.reconstruct_rows(_decomposed(spark, sf), U, _RECON_K, [mean.get(p) for p in range(S.NATION_YEAR_D)])


@register(
    "reconstruct_error",
    f"""
WITH {SERIES},
mu AS (SELECT pos, avg(v) AS m FROM series GROUP BY pos),
{_fourier_sql('basis0', '(SELECT CAST(range AS INTEGER) AS pos, 12 AS d FROM range(12))', 'd')},
r0 AS (SELECT s.station, s.yr, s.pos, CASE WHEN s.v IS NULL THEN 0e0 ELSE s.v - mu.m END AS r
       FROM series s JOIN mu ON s.pos = mu.pos),
coef AS (SELECT station, yr, k, sum(r * u) AS c FROM r0 JOIN basis0 b ON r0.pos = b.pos WHERE k < {_RECON_K} GROUP BY 1, 2, 3),
w AS (SELECT coef.station, coef.yr, b.pos, sum(coef.c * b.u) AS w FROM coef JOIN basis0 b ON coef.k = b.k GROUP BY 1, 2, 3)
SELECT s.station, s.yr, {sig_sql('sqrt(sum((w.w + mu.m - s.v) * (w.w + mu.m - s.v)))', 7)} AS error
FROM w JOIN mu ON mu.pos = w.pos JOIN series s ON s.station = w.station AND s.yr = w.yr AND s.pos = w.pos
WHERE s.v IS NOT NULL GROUP BY 1, 2
""",
)
def reconstruct_error(spark, sf):
    """M9: the norm of w_3 - v over the defined positions of each series."""
    series = S.nation_year_series(spark, sf)
    both = _reconstructed(spark, sf).select("station", "yr", "w").join(series, ["station", "yr"])
    squares = F.zip_with("w", "v", lambda w, v: F.when(v.isNotNull(), (w - v) * (w - v)).otherwise(F.lit(0.0)))
    return both.select("station", "yr", sig(F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)), 7).alias("error"))


@register(
    "denoise",
    f"""
WITH {EVENT_SERIES},
{_fourier_sql('basis0', '(SELECT CAST(range AS INTEGER) AS pos, 31 AS d FROM range(31))', 'd')},
coef AS (SELECT user_id, event_type, k, sum(coalesce(v, 0e0) * u) AS c FROM eseries JOIN basis0 b ON eseries.pos = b.pos GROUP BY 1, 2, 3)
SELECT user_id, event_type, b.pos, {rnd_sql('sum(c * u)', 6)} AS w FROM coef JOIN basis0 b ON coef.k = b.k GROUP BY 1, 2, 3
""",
)
def denoise(spark, sf):
    """Project the (noisy, sparse) user-event series on a 31-point Fourier basis and rebuild it."""
    series = S.user_event_series(spark, sf)
    U = decomp.fourier_rows(S.USER_EVENT_D)
    dec = decomp.decompose(series, U, None, keep=["user_id", "event_type"])
    w = decomp.reconstruct_rows(dec, U, U.shape[0])
    return w.select("user_id", "event_type", F.posexplode("w").alias("pos", "w")).withColumn("w", rnd("w", 6))


def _on_components(spark, sf, count: int):
    """M7 on the first eigenvectors of the data covariance (count x 12 numbers, a bounded collect)."""
    series = cut_lineage(S.nation_year_series(spark, sf))
    eig = decomp.pca(gram.covariance(series)).where(F.col("k") < count)
    U = np.zeros((count, S.NATION_YEAR_D))
    for r in eig.select("k", "pos", "u").collect():
        U[r["k"], r["pos"]] = r["u"]
    return decomp.decompose(series, U, _series_mean(series), keep=["station", "yr"])


@register("decompose_pca")
def decompose_pca(spark, sf):
    """M7 on the top-3 eigenvectors of the data covariance; ``decompose_pca_energy`` checks all twelve."""
    return _on_components(spark, sf, 3)


@register(
    "decompose_pca_energy",
    f"""
WITH {SERIES},
mu AS (SELECT pos, avg(v) AS m FROM series GROUP BY pos)
SELECT station, yr, {rnd_sql('sum(CASE WHEN v IS NULL THEN 0e0 ELSE (v - m) * (v - m) END) / sum(coalesce(v * v, 0e0))', 9)} AS energy, 0e0 AS residual
FROM series s JOIN mu ON mu.pos = s.pos GROUP BY station, yr
""",
)
def decompose_pca_energy(spark, sf):
    """M7 on all eigenvectors: the coefficients' squares add up to the centred series' (as a share of its total), and
    nothing is left after the last component."""
    d = _on_components(spark, sf, S.NATION_YEAR_D)
    squares = sum((F.col(f"coeff_{k}") * F.col(f"coeff_{k}") for k in range(1, S.NATION_YEAR_D + 1)), F.lit(0.0))
    return d.select("station", "yr", rnd(squares / F.col("total_var"), 9).alias("energy"), rnd(F.abs(f"res_{S.NATION_YEAR_D}"), 9).alias("residual"))


@register(
    "mean_std_band",
    f"""
WITH {SERIES},
st AS (SELECT pos, avg(v) AS mean, sum(v * v) / count(v) - avg(v) * avg(v) AS var FROM series GROUP BY pos)
SELECT pos, {sig_sql('mean', 8)} AS mean, {sig_sql('sqrt(greatest(var, 0))', 8)} AS std,
       {sig_sql('mean - sqrt(greatest(var, 0))', 8)} AS low, {sig_sql('mean + sqrt(greatest(var, 0))', 8)} AS high
FROM st
""",
)
def mean_std_band(spark, sf):
    b = stats.mean_std_band(S.nation_year_series(spark, sf))
    return b.select("pos", *[sig(c, 8).alias(c) for c in ("mean", "std", "low", "high")])


# ---------------------------------------------------------------- feature rows

_F64 = decomp.fourier_rows(64, harmonics=5)[:10]


@register(
    "feature_rows",
    f"""
WITH {VECS},
{_fourier_sql('b64', '(SELECT CAST(range AS INTEGER) AS pos, 64 AS d FROM range(64))', 'd', harmonics=5, limit_k=10)},
proj AS (SELECT vec_id, k, sum(x * u) AS p FROM vlong JOIN b64 ON vlong.pos = b64.pos GROUP BY 1, 2),
st AS (SELECT vec_id, any_value(label) AS label, stddev_pop(x) AS rmse, max(x) - min(x) AS peak2peak FROM vlong GROUP BY 1)
SELECT st.vec_id, {", ".join(f"{rnd_sql(f'max(CASE WHEN k = {i} THEN p END)', 9)} AS f_{i + 1}" for i in range(10))},
       {rnd_sql('any_value(rmse)', 9)} AS rmse, {rnd_sql('any_value(peak2peak)', 9)} AS peak2peak,
       CAST(any_value(label) % 2 AS INTEGER) AS label
FROM st JOIN proj ON st.vec_id = proj.vec_id GROUP BY st.vec_id
""",
)
def feature_rows(spark, sf):
    """10 projections, rmse (population std of entries), peak-to-peak, binary label: one select."""
    x = S.vectors(spark, sf)
    proj = [rnd(V.dot("x", V.lit_vector(u)), 9).alias(f"f_{i + 1}") for i, u in enumerate(_F64)]
    return x.select(
        "vec_id", *proj, rnd(V.vec_std("x"), 9).alias("rmse"), rnd(V.peak_to_peak("x"), 9).alias("peak2peak"),
        (F.col("label") % 2).cast("int").alias("label"),
    )


@register(
    "class_projections",
    f"""
WITH {VECS},
{_fourier_sql('b64', '(SELECT CAST(range AS INTEGER) AS pos, 64 AS d FROM range(64))', 'd', harmonics=5, limit_k=10)}
SELECT vec_id, label, {rnd_sql('sum(CASE WHEN k = 1 THEN x * u END)', 9)} AS p2, {rnd_sql('sum(CASE WHEN k = 2 THEN x * u END)', 9)} AS p3
FROM vlong JOIN b64 ON vlong.pos = b64.pos WHERE label IN (0, 1) GROUP BY vec_id, label
""",
)
def class_projections(spark, sf):
    """Per class (labels 0 and 1), projections on basis vectors 2 and 3."""
    x = S.vectors(spark, sf).where(F.col("label").isin(0, 1))
    return x.select(
        "vec_id", "label",
        rnd(V.dot("x", V.lit_vector(_F64[1])), 9).alias("p2"),
        rnd(V.dot("x", V.lit_vector(_F64[2])), 9).alias("p3"),
    )
