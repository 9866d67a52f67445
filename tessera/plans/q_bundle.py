"""The statistics bundle by group and principal components of chosen columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import rnd, sig
from ..operators import bundle, decomp, gram, series
from ..session import cut_lineage
from . import standins as S
from .q_relational import PRICE_LONG, price_wide
from .registry import register
from .sqltext import EVENT_SERIES, SERIES, rnd_sql, sig_sql


@register(
    "stat_by_group",
    f"""
WITH {EVENT_SERIES},
pv AS (SELECT event_type, sum(v * v) / count(v) - (sum(v) / count(v)) * (sum(v) / count(v)) AS var FROM eseries GROUP BY event_type, pos),
tr AS (SELECT event_type, sum(var) AS trace FROM pv GROUP BY 1),
d AS (SELECT event_type, v, row_number() OVER (PARTITION BY event_type ORDER BY v) AS rn, count(*) OVER (PARTITION BY event_type) AS n
      FROM eseries WHERE v IS NOT NULL),
x AS (SELECT event_type, any_value(n) AS n, avg(v) AS mean, sqrt(sum(v * v) / count(v) - avg(v) * avg(v)) AS std,
       max(CASE WHEN rn = n // 100 + 1 THEN v END) AS low100, max(CASE WHEN rn = n - greatest(n // 100, 1) + 1 THEN v END) AS high100,
       max(CASE WHEN rn = n // 1000 + 1 THEN v END) AS low1000, max(CASE WHEN rn = n - greatest(n // 1000, 1) + 1 THEN v END) AS high1000
      FROM d GROUP BY 1),
m AS (SELECT event_type, count(*) AS n_vectors, sum(miss) / count(*) AS mean_missing FROM (
      SELECT event_type, user_id, count(*) - count(v) AS miss FROM eseries GROUP BY 1, 2) GROUP BY 1)
SELECT event_type, n_vectors, n, {rnd_sql('mean_missing', 9)} AS mean_missing, {sig_sql('mean', 9)} AS mean, {sig_sql('std', 8)} AS std,
       {sig_sql('trace', 7)} AS var_sum, {sig_sql('trace', 7)} AS trace, {", ".join(f"{sig_sql(c, 9)} AS {c}" for c in ("low100", "high100", "low1000", "high1000"))}
FROM x JOIN tr USING (event_type) JOIN m USING (event_type)
""",
)
def stat_by_group(spark, sf):
    """M1: the whole statistics bundle of every event type from one pass over the series: moments, missing
    counts, variances, principal components (their eigenvalues' sum) and extreme percentiles."""
    b = bundle.bundle(cut_lineage(S.user_event_series(spark, sf)), by=["event_type"])
    var = b.positions().groupBy("event_type").agg(sig(F.sum("var"), 7).alias("var_sum"))
    # positions that no user has together count as uncorrelated; the trace doesn't depend on it
    eig = b.pca(undefined=0.0).select("event_type", "k", "eigval").distinct()
    trace = eig.groupBy("event_type").agg(sig(F.sum("eigval"), 7).alias("trace"))
    gone = b.missing().groupBy("event_type").agg(rnd(F.sum(F.col("n_missing") * F.col("n_vectors")) / F.sum("n_vectors"), 9).alias("mean_missing"))
    names = ("low100", "high100", "low1000", "high1000")
    far = b.extremes().select("event_type", *[sig(c, 9).alias(c) for c in names])
    out = b.overall().select("event_type", "n_vectors", "n", sig("mean", 9).alias("mean"), sig("std", 8).alias("std"))
    for part in (gone, var, trace, far):
        out = out.join(part, "event_type")
    return out


@register(
    "pca_residual",
    f"""
WITH {SERIES}, d AS (SELECT DISTINCT pos FROM series)
SELECT CAST(pos AS INTEGER) AS k, CAST(0 AS DOUBLE) AS residual, CAST(1 AS DOUBLE) AS norm, CAST(0 AS DOUBLE) AS overlap FROM d
""",
)
def pca_residual(spark, sf):
    """M3, checked by what defines it: |Cov u - lambda u| over the trace, |u|, and the largest dot product with another
    eigenvector, for each eigenpair."""
    cov = cut_lineage(gram.covariance(S.nation_year_series(spark, sf)).select("i", "j", "cov"))
    eig = cut_lineage(decomp.pca(cov))
    trace = eig.select("k", "eigval").distinct().agg(F.sum("eigval")).first()[0]  # one number
    image = cov.join(eig.select("k", F.col("pos").alias("j"), "u"), "j").groupBy("k", F.col("i").alias("pos")).agg(F.sum(F.col("cov") * F.col("u")).alias("cu"))
    off = image.join(eig, ["k", "pos"]).groupBy("k").agg(
        rnd(F.max(F.abs(F.col("cu") - F.col("eigval") * F.col("u"))) / F.lit(trace), 9).alias("residual"),
        rnd(F.sqrt(F.sum(F.col("u") * F.col("u"))), 9).alias("norm"),
    )
    across = decomp.basis_gram(eig).where("k <> l").groupBy("k").agg(rnd(F.max(F.abs("g")), 9).alias("overlap"))
    return off.join(across, "k")


_SUBSET_SQL = "WHERE name LIKE 'test/%\\_D' ESCAPE '\\'"


@register(
    "pca_subset",
    f"""
WITH {PRICE_LONG},
names AS (SELECT DISTINCT name FROM plong {_SUBSET_SQL}),
periods AS (SELECT DISTINCT period FROM plong),
v AS (SELECT n.name, p.period, coalesce(l.value, 0) AS x FROM names n CROSS JOIN periods p LEFT JOIN plong l ON l.name = n.name AND l.period = p.period)
SELECT count(*) AS n_columns, {sig_sql('sum(var)', 7)} AS trace, {sig_sql('sum(var)', 7)} AS var_sum FROM (
  SELECT name, avg(x * x) - avg(x) * avg(x) AS var FROM v GROUP BY name)
""",
)
def pca_subset(spark, sf):
    """Principal components of the test columns alone, from the Gram sums of all columns (their principal
    submatrix): the vectors aren't read again."""
    wide = price_wide(spark, sf)
    cols = series.select_by_pattern(wide)
    g = cut_lineage(gram.gram_sums(series.row_to_vector(wide, cols, keep=["period"])))
    sub = gram.covariance_of(gram.principal_sums(g, [k for k, c in enumerate(cols) if c.startswith("test/")]))
    eig = decomp.pca(sub).select("k", "eigval").distinct().agg(F.count("*").alias("n_columns"), sig(F.sum("eigval"), 7).alias("trace"))
    var = sub.where("i = j").agg(sig(F.sum("cov"), 7).alias("var_sum"))
    return eig.select("*", F.lit(1).alias("_one")).join(var.withColumn("_one", F.lit(1)), "_one").drop("_one")
