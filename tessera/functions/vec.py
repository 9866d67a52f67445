"""Vector math as Spark Column expressions over ``array<double>``.

Missing entries are NULL (never NaN) inside this library.  Every function here is a pure Column
expression, so it runs JVM-side next to the scan; none of them pulls data to Python.

Conventions
-----------
* ``dot``/``sq_dist`` skip positions where either side is NULL (NumPy ``nan_to_num`` semantics).
* ``argmax``/``topk_desc`` break ties by the lowest index (``np.argmax`` semantics).
* Zero denominators give NULL, never an error (ANSI mode is on by default in Spark 4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_double_array(arr: ColumnOrName) -> Column:
    """Cast any numeric array (e.g. ``array<float>``) to ``array<double>`` before multiplying."""
    return _c(arr).cast("array<double>")


def nan_to_null(arr: ColumnOrName) -> Column:
    """NaN -> NULL inside an array (the single missing-value rule of this library)."""
    return F.transform(to_double_array(arr), lambda x: F.nanvl(x, F.lit(None).cast("double")))


def fill_missing(arr: ColumnOrName, value: float = 0.0) -> Column:
    """Missing (NULL or NaN) -> ``value`` (``np.nan_to_num`` for the missing part)."""
    return F.transform(to_double_array(arr), lambda x: F.coalesce(F.nanvl(x, F.lit(value)), F.lit(value)))


def n_missing(arr: ColumnOrName) -> Column:
    return F.size(F.filter(_c(arr), lambda x: x.isNull()))


def n_defined(arr: ColumnOrName) -> Column:
    return F.size(F.filter(_c(arr), lambda x: x.isNotNull()))


def vsum(arr: ColumnOrName) -> Column:
    """Sum of defined entries (0.0 for an empty or all-missing array)."""
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def nanmean(arr: ColumnOrName) -> Column:
    """Mean over defined entries; NULL when nothing is defined."""
    return F.try_divide(vsum(arr), n_defined(arr).cast("double"))


def plain_mean(arr: ColumnOrName) -> Column:
    """Mean that is missing as soon as one entry is missing (``np.mean`` with NaN)."""
    return F.when(n_missing(arr) > 0, F.lit(None).cast("double")).otherwise(
        F.try_divide(vsum(arr), F.size(_c(arr)).cast("double"))
    )


def zero_filled_mean(arr: ColumnOrName) -> Column:
    """Mean with missing entries counted as 0 (``np.mean(np.nan_to_num(x))``)."""
    return F.try_divide(vsum(arr), F.size(_c(arr)).cast("double"))


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Inner product; positions missing on either side contribute 0."""
    prod = F.zip_with(to_double_array(a), to_double_array(b), lambda x, y: x * y)
    return vsum(prod)


def sq_norm(a: ColumnOrName) -> Column:
    return F.aggregate(to_double_array(a), F.lit(0.0), lambda acc, x: acc + F.coalesce(x * x, F.lit(0.0)))


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(sq_norm(a))


def sq_dist(a: ColumnOrName, b: ColumnOrName) -> Column:
    diff = F.zip_with(to_double_array(a), to_double_array(b), lambda x, y: x - y)
    return sq_norm(diff)


def distance(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.sqrt(sq_dist(a, b))


def vec_std(arr: ColumnOrName) -> Column:
    """Population standard deviation of the entries of one vector (``np.std``)."""
    a = to_double_array(arr)
    m = nanmean(a)
    var = F.try_divide(
        F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.coalesce((x - m) * (x - m), F.lit(0.0))),
        n_defined(a).cast("double"),
    )
    return F.sqrt(var)


def peak_to_peak(arr: ColumnOrName) -> Column:
    return F.array_max(_c(arr)) - F.array_min(_c(arr))


def scale(arr: ColumnOrName, factor: ColumnOrName | float) -> Column:
    f = factor if isinstance(factor, Column) else F.lit(float(factor)) if not isinstance(factor, str) else F.col(factor)
    return F.transform(to_double_array(arr), lambda x: x * f)


def add(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.zip_with(to_double_array(a), to_double_array(b), lambda x, y: x + y)


def sub(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.zip_with(to_double_array(a), to_double_array(b), lambda x, y: x - y)


def prefix(arr: ColumnOrName, n: int) -> Column:
    """First ``n`` entries (used to study the same points in growing dimension)."""
    return F.slice(_c(arr), 1, n)


def prefix_sums(terms: Column, ends: Sequence[int]) -> Column:
    """Sums of the first n entries for every n in ``ends`` (ascending), from one running sum over the array."""
    ends = list(ends)
    step = lambda acc, x: F.struct(
        (acc["i"] + 1).alias("i"), (acc["s"] + x).alias("s"),
        F.when((acc["i"] + 1).isin(ends), F.concat(acc["out"], F.array(acc["s"] + x))).otherwise(acc["out"]).alias("out"),
    )
    zero = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(terms, zero, step, lambda acc: acc["out"])


def scale_to_max(arr: ColumnOrName, top: ColumnOrName | float) -> Column:
    """The vector times ``top`` over its maximum; all NULL if that is 0. Missing entries stay missing."""
    a = to_double_array(arr)
    t = top if isinstance(top, Column) else F.col(top) if isinstance(top, str) else F.lit(float(top))
    return F.transform(a, lambda x: F.try_divide(x, F.array_max(a)) * t)


def lit_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def lit_matrix(rows: Sequence[Sequence[float]]) -> Column:
    return F.array(*[lit_vector(r) for r in rows])


def project(arr: ColumnOrName, basis_rows: Sequence[Sequence[float]]) -> Column:
    """Coefficients ``[v . u_k for k]`` for a small literal basis (rows are the vectors u_k)."""
    return F.array(*[dot(arr, lit_vector(u)) for u in basis_rows])


def linear_combination(weights: ColumnOrName, basis_rows: Sequence[Sequence[float]]) -> Column:
    """``sum_k w_k u_k`` for a small literal basis; returns an array of the basis length."""
    d = len(basis_rows[0])
    w = to_double_array(weights)
    return F.array(
        *[
            F.aggregate(
                F.zip_with(w, lit_vector([row[p] for row in basis_rows]), lambda x, y: x * y),
                F.lit(0.0),
                lambda acc, x: acc + F.coalesce(x, F.lit(0.0)),
            )
            for p in range(d)
        ]
    )


def softmax(arr: ColumnOrName) -> Column:
    a = to_double_array(arr)
    mx = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - mx))
    s = vsum(ex)
    return F.transform(ex, lambda x: x / s)


def normalize_sum(arr: ColumnOrName, guard: float = 1e-4) -> Column:
    """Divide by (sum + guard), the vote-share normalisation."""
    a = to_double_array(arr)
    s = vsum(a)
    return F.transform(a, lambda x: x / (s + F.lit(guard)))


def sigmoid(x: ColumnOrName) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def argmax(arr: ColumnOrName) -> Column:
    """0-based index of the largest entry; ties -> lowest index."""
    return (F.array_position(_c(arr), F.array_max(_c(arr))) - F.lit(1)).cast("int")


def argmin(arr: ColumnOrName) -> Column:
    return (F.array_position(_c(arr), F.array_min(_c(arr))) - F.lit(1)).cast("int")


def topk_desc(arr: ColumnOrName, k: int) -> Column:
    """Indices of the k largest entries, best first; ties -> lowest index first."""
    a = to_double_array(arr)
    keyed = F.transform(a, lambda x, i: F.struct((-x).alias("s"), i.alias("i")))
    return F.slice(F.transform(F.array_sort(keyed), lambda e: e["i"].cast("int")), 1, k)


def simplex_xy(p: ColumnOrName) -> Column:
    """Map three shares to the plane: x = p . (0, 1, .5), y = p . (0, 0, .87)."""
    a = to_double_array(p)
    x = dot(a, lit_vector(SIMPLEX_A))
    y = dot(a, lit_vector(SIMPLEX_B))
    return F.struct(x.alias("x"), y.alias("y"))


# Corner coordinates of the vote-share triangle.
SIMPLEX_A = (0.0, 1.0, 0.5)
SIMPLEX_B = (0.0, 0.0, 0.87)
