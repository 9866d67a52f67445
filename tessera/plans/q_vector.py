"""Vector-function queries (F3-F15, F22, F24, J6, M15, M16) and the byte codec on table data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec
from ..functions import vec as V
from ..functions.hashing import hash60, hash60_sql, uniform_sql
from ..functions.rounding import rnd
from ..operators import decomp
from ..operators.ordered import global_row_number
from . import standins as S
from .q_decomp import _fourier_sql
from .registry import register
from .sqltext import EVENT_SERIES, VECS, rnd_sql


def _arr_round(c, digits=9):
    return F.transform(c, lambda x: F.bround(x, digits) + F.lit(0.0))


@register("fill_missing", f"WITH {EVENT_SERIES} SELECT user_id, event_type, list({rnd_sql('coalesce(v, 0)', 9)} ORDER BY pos) AS v FROM eseries GROUP BY 1, 2")
def fill_missing(spark, sf):
    s = S.user_event_series(spark, sf)
    return s.select("user_id", "event_type", _arr_round(V.fill_missing("v")).alias("v"))


@register(
    "nanmean_variants",
    f"""WITH {EVENT_SERIES}
SELECT user_id, event_type, {rnd_sql('avg(v)', 9)} AS nanmean,
       CASE WHEN count(v) = count(*) THEN {rnd_sql('avg(v)', 9)} END AS mean,
       {rnd_sql('sum(coalesce(v, 0)) / count(*)', 9)} AS zero_filled_mean
FROM eseries GROUP BY 1, 2""",
)
def nanmean_variants(spark, sf):
    """NaN-mean, plain mean (missing if any entry is missing), zero-filled mean."""
    s = S.user_event_series(spark, sf)
    return s.select(
        "user_id", "event_type", rnd(V.nanmean("v"), 9).alias("nanmean"), rnd(V.plain_mean("v"), 9).alias("mean"),
        rnd(V.zero_filled_mean("v"), 9).alias("zero_filled_mean"),
    )


_B64 = _fourier_sql("b64", "(SELECT CAST(range AS INTEGER) AS pos, 64 AS d FROM range(64))", "d", harmonics=1)
_U64 = decomp.fourier_rows(64, harmonics=1)


@register(
    "project_basis",
    f"WITH {VECS}, {_B64} SELECT vec_id, list({rnd_sql('c', 9)} ORDER BY k) AS coeffs FROM "
    "(SELECT vec_id, k, sum(x * u) AS c FROM vlong JOIN b64 ON b64.pos = vlong.pos GROUP BY 1, 2) GROUP BY vec_id",
)
def project_basis(spark, sf):
    """coefficients on k = 3 basis vectors as one array per row (literal basis, Column form)."""
    x = S.vectors(spark, sf)
    return x.select("vec_id", _arr_round(V.project("x", _U64)).alias("coeffs"))


@register(
    "linear_map",
    f"""WITH {VECS}, {_B64},
w AS (SELECT vec_id, pos AS k, x AS w FROM vlong WHERE pos < 3)
SELECT w.vec_id, list({rnd_sql('s', 9)} ORDER BY pos) AS mapped FROM (
  SELECT w.vec_id, b64.pos, sum(w.w * b64.u) AS s FROM w JOIN b64 ON b64.k = w.k GROUP BY 1, 2) w GROUP BY w.vec_id""",
)
def linear_map(spark, sf):
    """sum_k w_k u_k with weights = the first three entries of each vector."""
    x = S.vectors(spark, sf)
    return x.select("vec_id", _arr_round(V.linear_combination(F.slice("x", 1, 3), _U64)).alias("mapped"))


@register("vector_norm", f"WITH {VECS} SELECT vec_id, {rnd_sql('sqrt(sum(x * x))', 12)} AS norm FROM vlong GROUP BY 1")
def vector_norm(spark, sf):
    return S.vectors(spark, sf).select("vec_id", rnd(V.norm("x"), 12).alias("norm"))


@register("vector_std", f"WITH {VECS} SELECT vec_id, {rnd_sql('stddev_pop(x)', 12)} AS rmse FROM vlong GROUP BY 1")
def vector_std(spark, sf):
    return S.vectors(spark, sf).select("vec_id", rnd(V.vec_std("x"), 12).alias("rmse"))


@register("peak_to_peak", f"WITH {VECS} SELECT vec_id, {rnd_sql('max(x) - min(x)', 12)} AS peak2peak FROM vlong GROUP BY 1")
def peak_to_peak(spark, sf):
    return S.vectors(spark, sf).select("vec_id", rnd(V.peak_to_peak("x"), 12).alias("peak2peak"))


@register(
    "minmax_scale",
    f"SELECT event_id, {rnd_sql('(value - (SELECT min(value) FROM events)) / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events))', 12)} AS scaled FROM events",
)
def minmax_scale(spark, sf):
    """(v - min) / (max - min); the two scalars come from one aggregate."""
    e = S.table(spark, sf, "events", "event_id", "value")
    lo, hi = e.agg(F.min("value"), F.max("value")).first()
    return e.select("event_id", rnd(F.try_divide(F.col("value") - F.lit(lo), F.lit(hi - lo)), 12).alias("scaled"))


@register(
    "reshape_grid",
    f"WITH {VECS} SELECT vec_id, CAST(pos // 8 AS INTEGER) AS row, CAST(pos % 8 AS INTEGER) AS col, x AS value FROM vlong",
)
def reshape_grid(spark, sf):
    """64 -> 8 x 8 (row = pos div 8, col = pos mod 8)."""
    x = S.vectors(spark, sf).select("vec_id", F.posexplode("x").alias("pos", "value"))
    return x.select("vec_id", (F.col("pos") / 8).cast("int").alias("row"), (F.col("pos") % 8).cast("int").alias("col"), "value")


# random pairs (J6): pair i joins rows a(i), b(i) picked by integer hashing of i
_PAIR_A = f"{hash60_sql('i', 1)} % n"
_PAIR_B = f"{hash60_sql('i', 2)} % n"

_PAIRS_SQL = f"""
{VECS},
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM embeddings),
n AS (SELECT count(*) AS n FROM ids),
pairs AS (SELECT i, {_PAIR_A} AS ia, {_PAIR_B} AS ib FROM range((SELECT n FROM n)) t(i), n),
pv AS (SELECT p.i, a.vec_id AS a_id, b.vec_id AS b_id FROM pairs p JOIN ids a ON a.idx = p.ia JOIN ids b ON b.idx = p.ib)
"""


def _pair_ids(spark, sf):
    """(i, a_id, b_id): only the ids are ranked, vectors are fetched by id afterwards."""
    ids = global_row_number(S.vectors(spark, sf).select("vec_id"), [F.col("vec_id")], "rn").select((F.col("rn") - 1).alias("idx"), "vec_id")
    n = ids.count()
    p = spark.range(n).select(
        F.col("id").alias("i"), F.pmod(hash60("id", 1), F.lit(n)).alias("ia"), F.pmod(hash60("id", 2), F.lit(n)).alias("ib")
    )
    a = ids.select(F.col("idx").alias("ia"), F.col("vec_id").alias("a_id"))
    b = ids.select(F.col("idx").alias("ib"), F.col("vec_id").alias("b_id"))
    return p.join(a, "ia").join(b, "ib").select("i", "a_id", "b_id")


def _pairs(spark, sf):
    x = S.vectors(spark, sf)
    a = x.select(F.col("vec_id").alias("a_id"), F.col("x").alias("xa"))
    b = x.select(F.col("vec_id").alias("b_id"), F.col("x").alias("xb"))
    return _pair_ids(spark, sf).join(a, "a_id").join(b, "b_id")


@register("random_pairs", f"WITH {_PAIRS_SQL} SELECT i, a_id, b_id FROM pv")
def random_pairs(spark, sf):
    """N pairs of rows picked by hashing the pair number; two equi-joins on dense row ids."""
    return _pair_ids(spark, sf)


@register(
    "pair_distance",
    f"WITH {_PAIRS_SQL} SELECT pv.i, {rnd_sql('sqrt(sum((a.x - b.x) * (a.x - b.x)))', 12)} AS dist FROM pv "
    "JOIN vlong a ON a.vec_id = pv.a_id JOIN vlong b ON b.vec_id = pv.b_id AND b.pos = a.pos GROUP BY pv.i",
)
def pair_distance(spark, sf):
    return _pairs(spark, sf).select("i", rnd(V.distance("xa", "xb"), 12).alias("dist"))


@register(
    "pair_dot",
    f"WITH {_PAIRS_SQL} SELECT pv.i, {rnd_sql('sum(a.x * b.x)', 12)} AS dot FROM pv "
    "JOIN vlong a ON a.vec_id = pv.a_id JOIN vlong b ON b.vec_id = pv.b_id AND b.pos = a.pos GROUP BY pv.i",
)
def pair_dot(spark, sf):
    return _pairs(spark, sf).select("i", rnd(V.dot("xa", "xb"), 12).alias("dot"))


_DIMS = (2, 8, 32, 64)


@register(
    "dimension_concentration",
    f"""WITH {_PAIRS_SQL},
dims AS (SELECT * FROM (VALUES {", ".join(f"({d})" for d in _DIMS)}) t(d)),
nr0 AS (SELECT d.d, v.vec_id, sqrt(sum(v.x * v.x)) AS nrm FROM vlong v, dims d WHERE v.pos < d.d GROUP BY 1, 2),
pd0 AS (SELECT d.d, pv.i, sqrt(sum((a.x - b.x) * (a.x - b.x))) AS dist, sum(a.x * b.x) AS dot FROM pv
        JOIN vlong a ON a.vec_id = pv.a_id JOIN vlong b ON b.vec_id = pv.b_id AND b.pos = a.pos, dims d WHERE a.pos < d.d GROUP BY 1, 2),
nr AS (SELECT d, avg(nrm) AS mn, stddev_pop(nrm) AS sn FROM nr0 GROUP BY d),
pd AS (SELECT d, avg(dist) AS md, stddev_pop(dist) AS sd, avg(dot) AS mp, stddev_pop(dot) AS sp FROM pd0 GROUP BY d)
SELECT CAST(d AS INTEGER) AS d, {rnd_sql('mn', 12)} AS mean_norm, {rnd_sql('sn', 9)} AS std_norm, {rnd_sql('sn / mn', 9)} AS spread,
       {rnd_sql('md', 9)} AS mean_dist, {rnd_sql('sd', 9)} AS std_dist, {rnd_sql('mp', 9)} AS mean_dot, {rnd_sql('sp', 9)} AS std_dot
FROM nr JOIN pd USING (d)""",
)
def dimension_concentration(spark, sf):
    """Norms, pair distances and pair dot products of the same points in growing dimension (prefixes of the
    vector): running sums inside the row give all prefixes from one scan and one set of pairs."""
    at = F.array(*[F.lit(d) for d in _DIMS])
    cut = lambda terms: V.prefix_sums(terms, _DIMS)
    square = lambda x: F.transform(x, lambda a: a * a)
    norms = S.vectors(spark, sf).select(F.explode(F.arrays_zip(at.alias("d"), cut(square("x")).alias("q"))).alias("e"))
    n = norms.groupBy(F.col("e.d").alias("d")).agg(F.avg(F.sqrt("e.q")).alias("mn"), F.stddev_pop(F.sqrt("e.q")).alias("sn"))
    diff, dot = F.zip_with("xa", "xb", lambda a, b: (a - b) * (a - b)), F.zip_with("xa", "xb", lambda a, b: a * b)
    pairs = _pairs(spark, sf).select(F.explode(F.arrays_zip(at.alias("d"), cut(diff).alias("q"), cut(dot).alias("p"))).alias("e"))
    p = pairs.groupBy(F.col("e.d").alias("d")).agg(
        F.avg(F.sqrt("e.q")).alias("md"), F.stddev_pop(F.sqrt("e.q")).alias("sd"), F.avg("e.p").alias("mp"), F.stddev_pop("e.p").alias("sp")
    )
    return n.join(p, "d").select(
        "d", rnd("mn", 12).alias("mean_norm"), rnd("sn", 9).alias("std_norm"), rnd(F.col("sn") / F.col("mn"), 9).alias("spread"),
        rnd("md", 9).alias("mean_dist"), rnd("sd", 9).alias("std_dist"), rnd("mp", 9).alias("mean_dot"), rnd("sp", 9).alias("std_dot"),
    )


_DIRECTIONS, _WIDTH = 5, 64


@register(
    "random_projection",
    f"""WITH {VECS},
g AS (SELECT CAST(i // {_WIDTH} AS INTEGER) AS dir, CAST(i % {_WIDTH} AS INTEGER) AS pos,
             sqrt(-2 * ln({uniform_sql('i', 17)})) * cos(2 * pi() * {uniform_sql('i', 18)}) AS g FROM range({_DIRECTIONS * _WIDTH}) t(i))
SELECT vec_id, dir, {rnd_sql('sum(x * g)', 6)} AS proj FROM vlong JOIN g ON g.pos = vlong.pos GROUP BY 1, 2""",
)
def random_projection(spark, sf):
    """Projections on 5 Gaussian directions (Box-Muller on the shared hash, so they don't depend on
    the partitioning), computed in the row without a shuffle."""
    import hashlib
    import math

    def unit(i: int, seed: int) -> float:
        return (float(int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], 16)) + 0.5) / float(1 << 60)

    g = [math.sqrt(-2 * math.log(unit(i, 17))) * math.cos(2 * math.pi * unit(i, 18)) for i in range(_DIRECTIONS * _WIDTH)]
    x = S.vectors(spark, sf)
    one = lambda d: F.struct(F.lit(d).alias("dir"), V.dot("x", V.lit_vector(g[d * _WIDTH : (d + 1) * _WIDTH])).alias("p"))
    e = x.select("vec_id", F.explode(F.array(*[one(d) for d in range(_DIRECTIONS)])).alias("e"))
    return e.select("vec_id", "e.dir", rnd("e.p", 6).alias("proj"))


@register(
    "f16_roundtrip",
    f"""WITH {VECS},
h AS (SELECT vec_id, x, pow(2e0, greatest(floor(log2(abs(x))), -14) - 10) AS step FROM vlong),
r AS (SELECT vec_id, CASE WHEN x = 0 THEN 0e0 ELSE abs(x - round_even(x / step, 0) * step) END AS err FROM h)
SELECT vec_id, {rnd_sql('max(err)', 12)} AS max_abs_err, true AS decoders_agree FROM r GROUP BY vec_id""",
)
def f16_roundtrip(spark, sf):
    """F1/F2 on table data: pack each vector as float16 bytes, decode with Column expressions and
    with the Arrow decoder; both columns and the largest round-trip error per row."""
    x = S.vectors(spark, sf)
    packed = x.select("vec_id", "x", codec.encode_packed("x", "<f2").alias("b"))
    d = packed.select("vec_id", "x", codec.decode_f16("b").alias("col_decoded"), codec.decode_packed("b", "<f2").alias("arrow_decoded"))
    err = F.array_max(F.zip_with("x", "col_decoded", lambda a, b: F.abs(a - b)))
    same = F.aggregate(F.zip_with("col_decoded", "arrow_decoded", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, v: s + v) == F.size("x")
    return d.select("vec_id", rnd(err, 12).alias("max_abs_err"), same.alias("decoders_agree"))


@register(
    "scale_to_max",
    f"""WITH {VECS}, m AS (SELECT vec_id, max(x) AS mx FROM vlong GROUP BY vec_id)
SELECT v.vec_id, list({rnd_sql('CASE WHEN mx <> 0 THEN x / mx * 2e-1 END', 9)} ORDER BY v.pos) AS scaled
FROM vlong v JOIN m USING (vec_id) GROUP BY v.vec_id""",
)
def scale_to_max(spark, sf):
    """F16: every vector scaled to a maximum of 0.2, the range of the basis vectors it is shown with."""
    return S.vectors(spark, sf).select("vec_id", F.transform(V.scale_to_max("x", 0.2), lambda v: rnd(v, 9)).alias("scaled"))
