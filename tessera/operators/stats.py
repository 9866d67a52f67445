"""Aggregations over series / vector tables and plain tables.

Every aggregate here is a Spark ``groupBy`` with partial (map-side) aggregation, so a hot key is
absorbed before the shuffle.  Vector tables are flattened with ``posexplode`` inside the same
stage as the partial aggregate; the shuffle carries at most (groups x d) partial rows per task.
NaN never reaches an aggregate: missing entries are NULL, so ``avg`` is the NaN-mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vec import n_missing, to_double_array
from .ordered import global_row_number


def _entries(df: DataFrame, vec: str, by: Sequence[str]) -> DataFrame:
    return df.select(*by, F.posexplode(to_double_array(vec)).alias("pos", "x"))


def position_stats(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """Per position: E = sum, NE = count of defined, mean = E/NE, var = O_ii/NO_ii - mean^2 (M2 diagonal)."""
    e = _entries(df, vec, by)
    g = e.groupBy(*by, "pos").agg(
        F.sum("x").alias("E"),
        F.count("x").alias("NE"),
        F.sum(F.col("x") * F.col("x")).alias("_S2"),
    )
    mean = F.try_divide(F.col("E"), F.col("NE").cast("double"))
    return g.select(
        *by,
        "pos",
        "E",
        "NE",
        mean.alias("mean"),
        (F.try_divide(F.col("_S2"), F.col("NE").cast("double")) - mean * mean).alias("var"),
    )


def mean_std_band(df: DataFrame, vec: str = "v", by: Sequence[str] = (), width: float = 1.0) -> DataFrame:
    """Per position: mean, std = sqrt(max(var, 0)), and the band mean +- width*std."""
    s = position_stats(df, vec, by)
    std = F.sqrt(F.greatest(F.col("var"), F.lit(0.0)))
    return s.select(
        *by, "pos", "mean", std.alias("std"), (F.col("mean") - std * width).alias("low"), (F.col("mean") + std * width).alias("high")
    )


def overall_dist(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population std over all defined entries of all vectors."""
    e = _entries(df, vec, by)
    return e.groupBy(*by).agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std"),
    )


def missing_per_vector(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """Exact histogram of the number of missing entries per vector."""
    return (
        df.select(*by, n_missing(vec).alias("n_missing"))
        .groupBy(*by, "n_missing")
        .agg(F.count(F.lit(1)).alias("n_vectors"))
    )


def extreme_percentiles(
    df: DataFrame,
    value: str,
    key: str,
    divisors: Sequence[int] = (100, 1000),
    method: str = "exact",
) -> DataFrame:
    """Bottom / top 1/p values: L = floor(n/p); low = (L+1)-th smallest, high = max(L,1)-th largest.

    ``exact`` ranks with a distributed global row number (``key`` makes the order total);
    ``approx`` uses ``percentile_approx`` (a sketch, constant memory per task).
    The reference's slips (bottom 0.1 % stored as bottom 1 %, top = minimum when L = 0) are not kept.
    """
    vals = df.select(F.col(value).cast("double").alias("x"), F.col(key).alias("_k")).where(F.col("x").isNotNull())
    if method == "approx":
        ps: list[float] = []
        for p in divisors:
            ps += [1.0 / p, 1.0 - 1.0 / p]
        q = vals.agg(F.percentile_approx("x", ps, 100000).alias("q"), F.count("x").alias("n"))
        cols = [F.col("n")]
        for i, p in enumerate(divisors):
            cols += [F.col("q")[2 * i].alias(f"low{p}"), F.col("q")[2 * i + 1].alias(f"high{p}")]
        return q.select(*cols)
    n = vals.count()
    ranked = global_row_number(vals, [F.col("x"), F.col("_k")], "rn")
    aggs = [F.lit(n).cast("long").alias("n")]
    for p in divisors:
        L = n // p
        lo_rank, hi_rank = L + 1, n - max(L, 1) + 1
        aggs += [
            F.max(F.when(F.col("rn") == lo_rank, F.col("x"))).alias(f"low{p}"),
            F.max(F.when(F.col("rn") == hi_rank, F.col("x"))).alias(f"high{p}"),
        ]
    wanted = sorted({n // p + 1 for p in divisors} | {n - max(n // p, 1) + 1 for p in divisors})
    return ranked.where(F.col("rn").isin(wanted)).agg(*aggs)


def group_count(df: DataFrame, keys: Sequence[str], counted: str | None = None, name: str = "n") -> DataFrame:
    """``count(col)`` (skips NULL) or ``count(*)`` per key."""
    c = F.count(counted) if counted else F.count(F.lit(1))
    return df.groupBy(*keys).agg(c.alias(name))


def group_count_mean(df: DataFrame, keys: Sequence[str], counted: str, averaged: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(counted).alias("n"), F.avg(averaged).alias("mean"))


def mean_std_ratio(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key mean/std (sample std, n-1; NULL for one-row groups), then the max and min ratio."""
    g = df.groupBy(key).agg(F.try_divide(F.avg(value), F.stddev_samp(value)).alias("ratio"))
    return g.agg(F.max("ratio").alias("max_ratio"), F.min("ratio").alias("min_ratio"), F.count("ratio").alias("n_groups"))


def box_stats(df: DataFrame, key: str, value: str, accuracy: int = 100000) -> DataFrame:
    """Approximate quartiles per key (a sketch per group, constant memory) and whiskers at 1.5 IQR.

    For exact quartiles use ``box_stats_exact`` (distributed ranks; Spark's own ``percentile``
    would buffer one group's values in one task, which a hot group cannot afford).
    """
    q = F.percentile_approx(F.col(value), [0.25, 0.5, 0.75], accuracy)
    g = df.groupBy(key).agg(q.alias("q"), F.min(value).alias("_mn"), F.max(value).alias("_mx"), F.count(value).alias("n"))
    iqr = F.col("q")[2] - F.col("q")[0]
    base = g.select(
        key,
        "n",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        (F.col("q")[0] - F.lit(1.5) * iqr).alias("_lo"),
        (F.col("q")[2] + F.lit(1.5) * iqr).alias("_hi"),
    )
    # whiskers: most extreme data points inside the fences (one more grouped pass, joined by key)
    fences = df.join(base.select(key, "_lo", "_hi"), key)
    w = fences.groupBy(key).agg(
        F.min(F.when(F.col(value) >= F.col("_lo"), F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= F.col("_hi"), F.col(value))).alias("whisker_high"),
        F.count(F.when((F.col(value) < F.col("_lo")) | (F.col(value) > F.col("_hi")), 1)).alias("n_outliers"),
    )
    return base.drop("_lo", "_hi").join(w, key)


def bounding_box(df: DataFrame, lat: str, lon: str, margin: float = 0.0) -> DataFrame:
    b = df.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))
    return b.select(
        "*",
        ((F.col("lat_min") + F.col("lat_max")) / 2).alias("lat_center"),
        ((F.col("lon_min") + F.col("lon_max")) / 2).alias("lon_center"),
        (F.col("lat_min") - margin).alias("lat_lo"),
        (F.col("lat_max") + margin).alias("lat_hi"),
    )


def null_fraction(df: DataFrame, row: str, col: str, value: str, by: str) -> DataFrame:
    """Fraction of missing cells per ``by`` over the full (row x col) grid, without building the grid.

    missing(by=x) = 1 - (#defined cells with by=x) / (#distinct values of the other key).
    """
    other = col if by == row else row
    total = df.select(other).distinct().count()  # one scalar: size of the other key's domain
    defined = F.countDistinct(F.when(F.col(value).isNotNull(), F.col(other)))  # 0 for a key whose cells are all missing
    return df.groupBy(by).agg((F.lit(1.0) - defined / F.lit(float(total))).alias("null_fraction"))


def histogram(df: DataFrame, value: str, bins: int = 50, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width bins over [lo, hi] (default: min and max), all of them, empty ones with n = 0; the
    maximum goes into the last bin, values outside count nowhere (``np.histogram``)."""
    x = F.col(value).cast("double")
    rng = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo = float(rng["lo"]) if lo is None else lo
    hi = float(rng["hi"]) if hi is None else hi
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.where(x.between(lo, hi)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = every.join(counts, "bin", "left")
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"), F.coalesce("c", F.lit(0)).cast("long").alias("n"))



def distinct_rounded(df: DataFrame, value: str, digits: int = 2) -> DataFrame:
    return df.select(F.bround(F.col(value).cast("double"), digits).alias("value")).distinct()


def empirical_cdf(df: DataFrame, value: str, key: str) -> DataFrame:
    """i-th smallest value gets i/(n+1), plus a leading point (min, 0).  Distributed global rank."""
    vals = df.select(F.col(value).cast("double").alias("x"), F.col(key).alias("_k")).where(F.col("x").isNotNull())
    n = vals.count()
    r = global_row_number(vals, [F.col("x"), F.col("_k")], "i")
    pts = r.select(F.col("i").cast("long").alias("i"), F.col("x").alias("value"), (F.col("i") / F.lit(float(n + 1))).alias("p"))
    lead = r.where(F.col("i") == 1).select(F.lit(0).cast("long").alias("i"), F.col("x").alias("value"), F.lit(0.0).alias("p"))
    return lead.unionByName(pts)


def variance_distance(a: DataFrame, b: DataFrame, pos: str = "pos", var: str = "var") -> DataFrame:
    """L1 distance between two variance vectors (long form), joined on position."""
    j = a.select(pos, F.col(var).alias("_a")).join(b.select(pos, F.col(var).alias("_b")), pos)
    return j.agg(F.sum(F.abs(F.col("_a") - F.col("_b"))).alias("l1"))


def rms(c: Column) -> Column:
    return F.sqrt(F.avg(c * c))


def exact_quantiles(df: DataFrame, value: str, key: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles (``quantile_cont``) per group without buffering a group.

    Rows get a distributed global rank in (group, value, key) order; each group's first rank and
    size come from a grouped aggregate; only the <= 2 rows per quantile that are needed are kept.
    Output: (by..., q, value).
    """
    by = list(by)
    vals = df.select(*by, F.col(value).cast("double").alias("_x"), F.col(key).alias("_k")).where(F.col("_x").isNotNull())
    ranked = global_row_number(vals, [*[F.col(b) for b in by], F.col("_x"), F.col("_k")], "_rn")
    g = ranked.groupBy(*by).agg(F.min("_rn").alias("_first"), F.count(F.lit(1)).alias("_n"))
    targets = g.select(
        *by,
        "_first",
        F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), ((F.col("_n") - 1) * F.lit(float(q))).alias("h")) for q in qs])).alias("t"),
    ).select(*by, "_first", "t.q", "t.h")
    targets = targets.select(
        *by, "q", (F.col("h") - F.floor("h")).alias("_frac"),
        (F.col("_first") + F.floor("h")).alias("_lo"), (F.col("_first") + F.ceil("h")).alias("_hi"),
    )
    need = targets.select(*by, F.explode(F.array("_lo", "_hi")).alias("_rn")).distinct()
    picked = ranked.join(need, by + ["_rn"], "left_semi").select(*by, "_rn", "_x")
    lo = picked.withColumnRenamed("_rn", "_lo").withColumnRenamed("_x", "_xlo")
    hi = picked.withColumnRenamed("_rn", "_hi").withColumnRenamed("_x", "_xhi")
    out = targets.join(lo, by + ["_lo"]).join(hi, by + ["_hi"])
    return out.select(*by, "q", (F.col("_xlo") + (F.col("_xhi") - F.col("_xlo")) * F.col("_frac")).alias("value"))


def box_stats_exact(df: DataFrame, key: str, value: str, row_key: str) -> DataFrame:
    """Box statistics per group from ``exact_quantiles``: q1, median, q3, whiskers at 1.5 IQR."""
    q = exact_quantiles(df, value, row_key, [0.25, 0.5, 0.75], [key])
    wide = q.groupBy(key).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    fences = wide.select(key, "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    x = F.col(value)
    w = df.select(key, x.alias("_x")).join(fences, key).groupBy(key, "q1", "median", "q3").agg(
        F.count("_x").alias("n"),
        F.min(F.when(F.col("_x") >= F.col("_lo"), F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= F.col("_hi"), F.col("_x"))).alias("whisker_high"),
        F.count(F.when((F.col("_x") < F.col("_lo")) | (F.col("_x") > F.col("_hi")), 1)).alias("n_outliers"),
    )
    return w
