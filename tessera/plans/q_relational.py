"""Scans, filters, joins, group counts, reshapes, windows and the two-way effect study."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.hashing import hash60, hash60_sql
from ..functions import vec as V
from ..functions.rounding import rnd, sig
from ..operators import effects, ordered, series, stats
from ..operators.relational import lookup_fallback, lookup_strict, lookup_unmatched, top_both_ends
from ..operators.relational import ranked_slices as ranked_slices_of
from . import standins as S
from .q_decomp import _decompose_sql, _decomposed
from .registry import register
from .sqltext import EVENT_SERIES, PRICES, SECTOR, SERIES, rnd_sql, sig_sql

# ---------------------------------------------------------------- scans and filters


@register(
    "scan_parquet_count",
    """
SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL
SELECT 'lineitem', count(*) FROM lineitem UNION ALL
SELECT 'events', count(*) FROM events UNION ALL
SELECT 'embeddings', count(*) FROM embeddings
""",
)
def scan_parquet_count(spark, sf):
    parts = [S.table(spark, sf, t).groupBy().count().select(F.lit(t).alias("tbl"), F.col("count").alias("n")) for t in ("orders", "lineitem", "events", "embeddings")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("filter_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf):
    """Equality filter; shows in the scan's PushedFilters."""
    e = S.table(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    return e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@register(
    "filter_sql_params",
    """
SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = (SELECT min(n_name) FROM nation) AND year(o_orderdate) = 1997
""",
)
def filter_sql_params(spark, sf):
    """Bound parameters (no string formatting): name and year passed as named SQL arguments."""
    name = S.table(spark, sf, "nation", "n_name").agg(F.min("n_name")).first()[0]
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {o} JOIN {c} ON o_custkey = c_custkey "
        "JOIN {n} ON c_nationkey = n_nationkey WHERE n_name = :name AND o_orderdate >= :first AND o_orderdate < :after",
        args={"name": name, "first": datetime(1997, 1, 1), "after": datetime(1998, 1, 1)},  # a range prunes the scan, year() can't
        o=S.table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        c=S.table(spark, sf, "customer", "c_custkey", "c_nationkey"),
        n=S.table(spark, sf, "nation", "n_nationkey", "n_name"),
    )


@register(
    "filter_year_min",
    f"""
WITH {SERIES}
SELECT station, yr, CAST(count(v) AS INTEGER) AS n_defined FROM series WHERE yr > 1997 GROUP BY 1, 2
""",
)
def filter_year_min(spark, sf):
    s = S.nation_year_series(spark, sf, since=datetime(1998, 1, 1))  # the year cut as a date range on the scan
    return s.select("station", "yr", V.n_defined("v").alias("n_defined"))


@register(
    "date_range_slice",
    """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'
""",
)
def date_range_slice(spark, sf):
    """Closed range with bounds parsed from the '%b-%d-%Y' style: both ends included."""
    lo = F.to_timestamp(F.lit("Jan-1-1996"), "MMM-d-yyyy").cast("timestamp_ntz")
    hi = F.to_timestamp(F.lit("Mar-31-1996"), "MMM-d-yyyy").cast("timestamp_ntz")
    li = S.table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    return li.where(F.col("l_shipdate").between(lo, hi))


@register(
    "filter_missing_le",
    f"""
WITH {EVENT_SERIES}
SELECT user_id, event_type, CAST(count(*) - count(v) AS INTEGER) AS n_missing FROM eseries
GROUP BY 1, 2 HAVING count(*) - count(v) <= 20
""",
)
def filter_missing_le(spark, sf):
    s = S.user_event_series(spark, sf).select("user_id", "event_type", V.n_missing("v").alias("n_missing"))
    return s.where(F.col("n_missing") <= 20)


_LABEL_SET = (3, 5, 8)


@register(
    "label_subset",
    "SELECT vec_id, label, CAST(CASE label WHEN 3 THEN 0 WHEN 5 THEN 1 WHEN 8 THEN 2 END AS INTEGER) AS idx "
    "FROM embeddings WHERE label IN (3, 5, 8)",
)
def label_subset(spark, sf):
    m = F.create_map(*[x for i, l in enumerate(_LABEL_SET) for x in (F.lit(l), F.lit(i))])
    e = S.table(spark, sf, "embeddings", "vec_id", "label").where(F.col("label").isin(*_LABEL_SET))
    return e.select("vec_id", "label", m[F.col("label")].cast("int").alias("idx"))


# wide price table: one row per period, columns '<split>/<brand>_P' and '_D'
def _split_of(brand):
    """Brands whose number is a multiple of 5 form the test split."""
    num = F.regexp_extract(brand, r"#(\d+)$", 1).cast("int")
    return F.when(num % 5 == 0, F.lit("test")).otherwise(F.lit("train"))


def _price_long(spark, sf):
    p = S.brand_month_prices(spark, sf)
    lr = series.log_ratio(p, "brand", "period", "price")
    base = F.concat(_split_of(F.col("brand")), F.lit("/"), F.col("brand"))
    return lr.select(
        "period",
        F.explode(
            F.array(
                F.struct(F.concat(base, F.lit("_P")).alias("name"), F.col("price").alias("value")),
                F.struct(F.concat(base, F.lit("_D")).alias("name"), F.col("log_ratio").alias("value")),
            )
        ).alias("e"),
    ).select("period", "e.name", "e.value")


#: Names that may become columns of the price table; more is an error.
_MAX_PRICE_COLUMNS = 4_000


def price_wide(spark, sf):
    """Pivot of the long price table; its columns are the names that occur, checked against ``_MAX_PRICE_COLUMNS``."""
    lg = _price_long(spark, sf)
    names = sorted(r["name"] for r in lg.select("name").distinct().limit(_MAX_PRICE_COLUMNS + 1).collect())
    if len(names) > _MAX_PRICE_COLUMNS:
        raise ValueError(f"more than {_MAX_PRICE_COLUMNS} price columns")
    return series.pivot_wide(lg, "period", "name", "value", names)


PRICE_LONG = f"""
{PRICES},
lr AS (SELECT a.brand, a.period, a.price,
              CASE WHEN b.price > 0 AND a.price > 0 THEN ln(a.price / b.price) END AS log_ratio
       FROM prices a LEFT JOIN prices b ON a.brand = b.brand AND a.period = b.period + 1),
named AS (SELECT *, CASE WHEN CAST(regexp_extract(brand, '#(\\d+)$', 1) AS INTEGER) % 5 = 0 THEN 'test' ELSE 'train' END
                    || '/' || brand AS base FROM lr),
plong AS (SELECT period, base || '_P' AS name, price AS value FROM named
          UNION ALL SELECT period, base || '_D', log_ratio FROM named)
"""


@register(
    "partition_columns",
    f"""
WITH {PRICE_LONG},
names AS (SELECT DISTINCT name FROM plong WHERE name LIKE '%\\_D' ESCAPE '\\')
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN name LIKE 'train/%' THEN 0 ELSE 1 END, name) AS INTEGER) AS ord, name
FROM names
""",
)
def partition_columns(spark, sf):
    """`_D` columns: train first, then test, each sorted by name, from the long table (no pivot is needed for names)."""
    names = _price_long(spark, sf).where(F.col("name").endswith("_D")).select("name").distinct()
    order = [F.when(F.col("name").startswith("train/"), 0).otherwise(1), F.col("name")]
    return ordered.global_row_number(names, order, "ord").select(F.col("ord").cast("int").alias("ord"), "name")


@register(
    "decode_names",
    f"""
WITH {PRICE_LONG}
SELECT DISTINCT name, regexp_extract(name, '^(train|test)/(.*)_([PD])$', 1) AS split,
       regexp_extract(name, '^(train|test)/(.*)_([PD])$', 2) AS ticker,
       regexp_extract(name, '^(train|test)/(.*)_([PD])$', 3) AS kind
FROM plong
""",
)
def decode_names(spark, sf):
    names = _price_long(spark, sf).select("name").distinct()
    sp, tk, kd = series.decode_column_name(F.col("name"))
    return names.select("name", sp.alias("split"), tk.alias("ticker"), kd.alias("kind"))


@register(
    "unpivot_prices",
    f"""
WITH {PRICE_LONG}
SELECT period, name, {sig_sql('value', 9)} AS value FROM plong WHERE value IS NOT NULL
""",
)
def unpivot_prices(spark, sf):
    """H2: the wide price table back to long form by ``unpivot`` (missing cells dropped)."""
    wide = price_wide(spark, sf)
    cols = [c for c in wide.columns if c != "period"]
    lg = series.unpivot_wide(wide, ["period"], cols, "name", "value")
    return lg.where(F.col("value").isNotNull()).select("period", "name", sig("value", 9).alias("value"))


@register(
    "row_to_vector",
    f"""
WITH {PRICE_LONG},
names AS (SELECT DISTINCT name FROM plong WHERE name LIKE '%\\_D' ESCAPE '\\'),
ordered AS (SELECT name, row_number() OVER (ORDER BY CASE WHEN name LIKE 'train/%' THEN 0 ELSE 1 END, name) AS o FROM names),
periods AS (SELECT DISTINCT period FROM plong)
SELECT p.period, list({rnd_sql('coalesce(CASE WHEN isnan(l.value) THEN 0 ELSE l.value END, 0)', 9)} ORDER BY o.o) AS v
FROM periods p CROSS JOIN ordered o LEFT JOIN plong l ON l.period = p.period AND l.name = o.name
GROUP BY p.period
""",
)
def row_to_vector(spark, sf):
    """H3: each period's `_D` columns (train first, sorted) as one vector, missing -> 0."""
    wide = price_wide(spark, sf)
    cols = series.select_by_pattern(wide)
    out = series.row_to_vector(wide, cols, keep=["period"])
    return out.select("period", F.transform("v", lambda x: F.bround(x, 9) + F.lit(0.0)).alias("v"))


@register(
    "encode_labels",
    f"""
WITH {SECTOR}
SELECT brand, sector, CAST(dense_rank() OVER (ORDER BY sector) - 1 AS INTEGER) AS sector_id,
       CAST(CASE WHEN sector = 'ECONOMY' THEN 0 ELSE 1 END AS INTEGER) AS is_other
FROM sector
""",
)
def encode_labels(spark, sf):
    """Name -> number through a small code table (dense rank over distinct sectors), and a 0/1 encode."""
    sec = S.brand_sector(spark, sf)
    codes = ordered.global_row_number(sec.select("sector").distinct(), [F.col("sector")], "_rn")
    codes = codes.select("sector", (F.col("_rn") - 1).cast("int").alias("sector_id"))
    return sec.join(codes, "sector").select(
        "brand", "sector", "sector_id", F.when(F.col("sector") == "ECONOMY", 0).otherwise(1).cast("int").alias("is_other")
    )


@register(
    "unit_scale",
    f"""
SELECT event_id, {rnd_sql("CASE WHEN event_type IN ('click', 'view') THEN value / 10 ELSE value END", 9)} AS value
FROM events
""",
)
def unit_scale(spark, sf):
    e = S.table(spark, sf, "events", "event_id", "event_type", "value")
    v = F.when(F.col("event_type").isin("click", "view"), F.col("value") / 10).otherwise(F.col("value"))
    return e.select("event_id", rnd(v, 9).alias("value"))


# ---------------------------------------------------------------- joins


@register(
    "join_station_left",
    f"""
WITH {SERIES}
SELECT k.station, k.yr, n.n_name AS name, r.r_name AS region
FROM (SELECT DISTINCT station, yr FROM series) k
LEFT JOIN nation n ON n.n_nationkey = k.station LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""",
)
def join_station_left(spark, sf):
    """Facts left-joined with the station dimension (the dimension's clashing columns dropped first)."""
    dim = S.station_dim(spark, sf).select("station", "name", "region")
    return S.nation_year_series(spark, sf).select("station", "yr").join(dim, "station", "left")


@register(
    "lookup_fallback",
    """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'doc-' || CAST(d.doc_id AS VARCHAR)) AS tag,
       l.doc_id IS NOT NULL AS known
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""",
)
def lookup_fallback_q(spark, sf):
    docs = S.table(spark, sf, "documents", "doc_id")
    labels = S.table(spark, sf, "labels", "doc_id", "quality")
    return lookup_fallback(docs, labels, "doc_id", F.col("quality").cast("string"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), "tag")


@register(
    "lookup_counts",
    """
SELECT CAST(count_if(l.doc_id IS NOT NULL) AS BIGINT) AS n_known, CAST(count_if(l.doc_id IS NULL) AS BIGINT) AS n_unknown
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""",
)
def lookup_counts(spark, sf):
    f = lookup_fallback_q(spark, sf)
    return f.agg(F.count_if(F.col("known")).alias("n_known"), F.count_if(~F.col("known")).alias("n_unknown"))


@register(
    "lookup_strict",
    """
WITH u AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) = 1)
SELECT d.doc_id, l.quality, l.toxic FROM documents d JOIN u ON u.doc_id = d.doc_id JOIN labels l ON l.doc_id = d.doc_id
""",
)
def lookup_strict_q(spark, sf):
    docs = S.table(spark, sf, "documents", "doc_id")
    return lookup_strict(docs, S.table(spark, sf, "labels", "doc_id", "quality", "toxic"), "doc_id")


@register(
    "lookup_unmatched",
    """
WITH u AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) = 1)
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.doc_id = d.doc_id)
""",
)
def lookup_unmatched_q(spark, sf):
    docs = S.table(spark, sf, "documents", "doc_id")
    return lookup_unmatched(docs, S.table(spark, sf, "labels", "doc_id"), "doc_id")


# ---------------------------------------------------------------- group counts and distributions


@register("group_count_ordered", "SELECT event_type, count(event_type) AS n FROM events GROUP BY event_type")
def group_count_ordered(spark, sf):
    e = S.table(spark, sf, "events", "event_type")
    return stats.group_count(e, ["event_type"], "event_type").orderBy(F.desc("n"), "event_type")


@register("topn_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def topn_count(spark, sf):
    """Order by count, first n, with a key tie-break (TakeOrderedAndProject)."""
    e = S.table(spark, sf, "events", "event_type")
    return stats.group_count(e, ["event_type"]).orderBy(F.desc("n"), "event_type").limit(3)


@register(
    "group_count_mean",
    f"""
SELECT c_nationkey, c_mktsegment, count(c_custkey) AS n, {sig_sql('avg(c_acctbal)', 9)} AS mean
FROM customer GROUP BY 1, 2
""",
)
def group_count_mean(spark, sf):
    c = S.table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    g = stats.group_count_mean(c, ["c_nationkey", "c_mktsegment"], "c_custkey", "c_acctbal")
    return g.select("c_nationkey", "c_mktsegment", "n", sig("mean", 9).alias("mean"))


@register(
    "overall_dist",
    f"""
WITH {EVENT_SERIES}
SELECT event_type, count(v) AS n, {sig_sql('avg(v)', 9)} AS mean,
       {sig_sql('sqrt(sum(v * v) / count(v) - avg(v) * avg(v))', 8)} AS std
FROM eseries GROUP BY event_type
""",
)
def overall_dist(spark, sf):
    d = stats.overall_dist(S.user_event_series(spark, sf), by=["event_type"])
    return d.select("event_type", "n", sig("mean", 9).alias("mean"), sig("std", 8).alias("std"))


@register(
    "missing_per_vector",
    f"""
WITH {EVENT_SERIES}
SELECT CAST(n_missing AS INTEGER) AS n_missing, count(*) AS n_vectors
FROM (SELECT user_id, event_type, count(*) - count(v) AS n_missing FROM eseries GROUP BY 1, 2) GROUP BY 1
""",
)
def missing_per_vector(spark, sf):
    return stats.missing_per_vector(S.user_event_series(spark, sf))


@register(
    "extreme_percentiles",
    """
WITH r AS (SELECT value, row_number() OVER (ORDER BY value, event_id) AS rn, count(*) OVER () AS n FROM events)
SELECT any_value(n) AS n,
       max(CASE WHEN rn = n // 100 + 1 THEN value END) AS low100,
       max(CASE WHEN rn = n - greatest(n // 100, 1) + 1 THEN value END) AS high100,
       max(CASE WHEN rn = n // 1000 + 1 THEN value END) AS low1000,
       max(CASE WHEN rn = n - greatest(n // 1000, 1) + 1 THEN value END) AS high1000
FROM r
""",
)
def extreme_percentiles(spark, sf):
    e = S.table(spark, sf, "events", "event_id", "value")
    return stats.extreme_percentiles(e, "value", "event_id")


@register(
    "mean_std_ratio",
    f"""
SELECT {sig_sql('max(r)', 9)} AS max_ratio, {sig_sql('min(r)', 9)} AS min_ratio, count(r) AS n_groups
FROM (SELECT user_id, avg(value) / stddev_samp(value) AS r FROM events GROUP BY user_id)
""",
)
def mean_std_ratio(spark, sf):
    e = S.table(spark, sf, "events", "user_id", "value")
    r = stats.mean_std_ratio(e, "user_id", "value")
    return r.select(sig("max_ratio", 9).alias("max_ratio"), sig("min_ratio", 9).alias("min_ratio"), "n_groups")


@register(
    "box_stats",
    f"""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.event_type, {sig_sql('any_value(f.q1)', 9)} AS q1, {sig_sql('any_value(f.median)', 9)} AS median,
       {sig_sql('any_value(f.q3)', 9)} AS q3, count(e.value) AS n,
       {sig_sql('min(CASE WHEN e.value >= f.lo THEN e.value END)', 9)} AS whisker_low,
       {sig_sql('max(CASE WHEN e.value <= f.hi THEN e.value END)', 9)} AS whisker_high,
       count(CASE WHEN e.value < f.lo OR e.value > f.hi THEN 1 END) AS n_outliers
FROM events e JOIN f ON e.event_type = f.event_type GROUP BY f.event_type
""",
)
def box_stats(spark, sf):
    """Exact quartiles by distributed rank (no per-group value buffer), whiskers at 1.5 IQR."""
    e = S.table(spark, sf, "events", "event_id", "event_type", "value")
    b = stats.box_stats_exact(e, "event_type", "value", "event_id")
    return b.select(
        "event_type", *[sig(c, 9).alias(c) for c in ("q1", "median", "q3")], "n",
        sig("whisker_low", 9).alias("whisker_low"), sig("whisker_high", 9).alias("whisker_high"), "n_outliers",
    )


_DU = "du AS (SELECT CAST(day(ts) AS INTEGER) AS day, user_id, sum(value) AS v FROM events GROUP BY 1, 2)"


def _day_user(spark, sf):
    e = S.table(spark, sf, "events", "ts", "user_id", "value")
    return e.groupBy(F.dayofmonth("ts").cast("int").alias("day"), "user_id").agg(F.sum("value").alias("v"))


@register(
    "null_fraction",
    f"""
WITH {_DU}
SELECT 'user' AS axis, CAST(user_id AS BIGINT) AS id, {rnd_sql('1 - count(*) / (SELECT count(DISTINCT day) FROM du)', 9)} AS null_fraction
FROM du GROUP BY user_id
UNION ALL
SELECT 'day', CAST(day AS BIGINT), {rnd_sql('1 - count(*) / (SELECT count(DISTINCT user_id) FROM du)', 9)} FROM du GROUP BY day
""",
)
def null_fraction(spark, sf):
    """Missing share per user and per day of the (day x user) table, without materialising the grid."""
    du = _day_user(spark, sf)
    a = stats.null_fraction(du, "day", "user_id", "v", by="user_id").select(F.lit("user").alias("axis"), F.col("user_id").cast("long").alias("id"), "null_fraction")
    b = stats.null_fraction(du, "day", "user_id", "v", by="day").select(F.lit("day").alias("axis"), F.col("day").cast("long").alias("id"), "null_fraction")
    return a.unionByName(b).select("axis", "id", rnd("null_fraction", 9).alias("null_fraction"))


@register(
    "effect_rms",
    f"""
WITH {_DU},
mr AS (SELECT day, avg(v) AS m FROM du GROUP BY day),
mc AS (SELECT user_id, avg(v) AS m FROM du GROUP BY user_id),
a AS (SELECT sqrt(avg(du.v * du.v)) AS t, sqrt(avg((du.v - mr.m) * (du.v - mr.m))) AS r,
             sqrt(avg((du.v - mc.m) * (du.v - mc.m))) AS c
      FROM du JOIN mr ON mr.day = du.day JOIN mc ON mc.user_id = du.user_id)
SELECT {sig_sql('t', 8)} AS rms_total, {sig_sql('r', 8)} AS rms_minus_day, {sig_sql('c', 8)} AS rms_minus_user_id,
       {sig_sql('t - r', 6)} AS reduction_day, {sig_sql('t - c', 6)} AS reduction_user_id FROM a
""",
)
def effect_rms(spark, sf):
    r = effects.effect_rms(_day_user(spark, sf), "day", "user_id", "v")
    return r.select(
        sig("rms_total", 8).alias("rms_total"), sig("rms_minus_day", 8).alias("rms_minus_day"),
        sig("rms_minus_user_id", 8).alias("rms_minus_user_id"),
        sig("reduction_day", 6).alias("reduction_day"), sig("reduction_user_id", 6).alias("reduction_user_id"),
    )


def _alternating_sql(rounds: int = 5) -> str:
    ctes = [_DU, "t0 AS (SELECT day, user_id, v FROM du)"]
    sel = [f"SELECT 0 AS round, 'initial' AS step, {sig_sql('sqrt(avg(v * v))', 8)} AS rms FROM t0"]
    prev = "t0"
    for r in range(1, rounds + 1):
        a, b = f"t{r}a", f"t{r}b"
        ctes.append(f"{a} AS (SELECT p.day, p.user_id, p.v - m.m AS v FROM {prev} p JOIN (SELECT day, avg(v) AS m FROM {prev} GROUP BY day) m ON m.day = p.day)")
        ctes.append(f"{b} AS (SELECT p.day, p.user_id, p.v - m.m AS v FROM {a} p JOIN (SELECT user_id, avg(v) AS m FROM {a} GROUP BY user_id) m ON m.user_id = p.user_id)")
        sel.append(f"SELECT {r}, 'minus_day', {sig_sql('sqrt(avg(v * v))', 8)} FROM {a}")
        sel.append(f"SELECT {r}, 'minus_user_id', {sig_sql('sqrt(avg(v * v))', 8)} FROM {b}")
        prev = b
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(sel)


@register("alternating_means", _alternating_sql())
def alternating_means(spark, sf):
    a = effects.alternating_means(_day_user(spark, sf), "day", "user_id", "v", rounds=5)
    return a.select("round", "step", sig("rms", 8).alias("rms"))


@register(
    "histogram",
    """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin FROM events, r),
n AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(g.i AS INTEGER) AS bin, round_even(lo + g.i * (hi - lo) / 50, 9) + 0.0 AS "left", coalesce(n, 0) AS n
FROM range(50) g(i) CROSS JOIN r LEFT JOIN n ON n.bin = g.i
""",
)
def histogram(spark, sf):
    h = stats.histogram(S.table(spark, sf, "events", "value"), "value", bins=50)
    return h.select("bin", rnd("left", 9).alias("left"), "n")


@register("distinct_rounded", "SELECT DISTINCT round_even(value, 1) + 0.0 AS value FROM events")
def distinct_rounded(spark, sf):
    return stats.distinct_rounded(S.table(spark, sf, "events", "value"), "value", 1).select((F.col("value") + F.lit(0.0)).alias("value"))


@register(
    "empirical_cdf",
    f"""
WITH r AS (SELECT value, row_number() OVER (ORDER BY value, event_id) AS i, count(*) OVER () AS n FROM events)
SELECT CAST(i AS BIGINT) AS i, value, {rnd_sql('i / (n + 1)', 12)} AS p FROM r
UNION ALL SELECT 0, min(value), 0.0 FROM events
""",
)
def empirical_cdf(spark, sf):
    """W2 over the whole events table, ranked without a single-task window."""
    c = stats.empirical_cdf(S.table(spark, sf, "events", "event_id", "value"), "value", "event_id")
    return c.select("i", "value", rnd("p", 12).alias("p"))


# ---------------------------------------------------------------- returns, smoothing


@register(
    "log_ratio",
    f"""
WITH {PRICE_LONG}
SELECT brand, period, {sig_sql('log_ratio', 8)} AS log_ratio FROM lr
""",
)
def log_ratio(spark, sf):
    lr = series.log_ratio(S.brand_month_prices(spark, sf), "brand", "period", "price")
    return lr.select("brand", "period", sig("log_ratio", 8).alias("log_ratio"))


@register(
    "log_ratio_telescopes",
    f"""
WITH {PRICE_LONG},
ends AS (SELECT brand, min(period) AS t0, max(period) AS t1 FROM prices GROUP BY brand)
SELECT e.brand, {rnd_sql('sum(lr.log_ratio)', 9)} AS sum_log_ratio,
       {rnd_sql('ln(max(CASE WHEN lr.period = e.t1 THEN lr.price END) / max(CASE WHEN lr.period = e.t0 THEN lr.price END))', 9)} AS log_total
FROM ends e JOIN lr ON lr.brand = e.brand GROUP BY e.brand
""",
)
def log_ratio_telescopes(spark, sf):
    """sum of ln ratios over (t0, t1] and ln(p(t1)/p(t0)); equal when no period is missing."""
    lr = series.log_ratio(S.brand_month_prices(spark, sf), "brand", "period", "price")
    ends = lr.groupBy("brand").agg(F.min("period").alias("t0"), F.max("period").alias("t1"))
    j = lr.join(ends, "brand")
    return j.groupBy("brand").agg(
        rnd(F.sum("log_ratio"), 9).alias("sum_log_ratio"),
        rnd(F.log(F.max(F.when(F.col("period") == F.col("t1"), F.col("price"))) / F.max(F.when(F.col("period") == F.col("t0"), F.col("price")))), 9).alias("log_total"),
    )


@register(
    "smooth_series",
    f"""
WITH {EVENT_SERIES},
s AS (SELECT user_id, event_type, pos,
             avg(v) OVER (PARTITION BY user_id, event_type ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS s
      FROM eseries)
SELECT user_id, event_type, list({rnd_sql('s', 9)} ORDER BY pos) AS v_s20 FROM s GROUP BY 1, 2
""",
)
def smooth_series(spark, sf):
    s = series.smooth_series(S.user_event_series(spark, sf))
    return s.select("user_id", "event_type", F.transform("v_s20", lambda x: F.bround(x, 9) + F.lit(0.0)).alias("v_s20"))


def _hourly(spark, sf):
    e = S.table(spark, sf, "events", "event_type", "ts")
    cells = e.select("event_type", ((F.dayofmonth("ts") - 1) * 24 + F.hour("ts")).cast("int").alias("pos"), F.lit(1.0).alias("one"))
    return series.build_series(cells, ["event_type"], "pos", "one", 744)


@register(
    "multiscale_smooth",
    f"""
WITH cell AS (SELECT event_type, CAST((day(ts) - 1) * 24 + hour(ts) AS INTEGER) AS pos, CAST(count(*) AS DOUBLE) AS v
              FROM events GROUP BY 1, 2),
g AS (SELECT t.event_type, CAST(p.range AS INTEGER) AS pos, c.v FROM (SELECT DISTINCT event_type FROM cell) t
      CROSS JOIN range(744) p LEFT JOIN cell c ON c.event_type = t.event_type AND c.pos = p.range),
w AS (SELECT event_type, pos, v,
             avg(v) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS s1,
             avg(v) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 50 PRECEDING AND 49 FOLLOWING) AS s2
      FROM g)
SELECT event_type, pos, {rnd_sql('CASE WHEN pos < 10 THEN v WHEN pos < 100 THEN s1 WHEN pos + 50 <= 744 THEN s2 END', 9)} AS s
FROM w
""",
)
def multiscale_smooth(spark, sf):
    """W6 on each event type's 744-hour (31 days) count series (scales 10 and 100 inside the array)."""
    h = _hourly(spark, sf).select("event_type", series.multiscale_smooth(F.col("v")).alias("s"))
    return h.select("event_type", F.posexplode("s").alias("pos", "s")).select("event_type", "pos", rnd("s", 9).alias("s"))


# ---------------------------------------------------------------- ranks, top-k, slices


@register(
    "topk_both_ends",
    """
SELECT * FROM (SELECT 'low' AS end_, event_id, value FROM events ORDER BY value, event_id LIMIT 12)
UNION ALL SELECT * FROM (SELECT 'high', event_id, value FROM events ORDER BY value DESC, event_id LIMIT 12)
""",
)
def topk_both_ends(spark, sf):
    e = S.table(spark, sf, "events", "event_id", "value")
    return top_both_ends(e, "value", "event_id", 12)


@register(
    "ranked_slices",
    """
WITH r AS (SELECT event_id, value, row_number() OVER (ORDER BY value DESC, event_id) AS rn FROM events)
SELECT CAST(rn AS BIGINT) AS rn, event_id, value FROM r
WHERE rn BETWEEN 1 AND 4 OR rn BETWEEN 501 AND 504 OR rn BETWEEN 1001 AND 1004
""",
)
def ranked_slices(spark, sf):
    """Ranks 1-4, 501-504 and 1001-1004 from the top: a top-1004, then its ranks."""
    e = S.table(spark, sf, "events", "event_id", "value")
    r = ranked_slices_of(e, [F.desc("value"), F.col("event_id")], [(1, 4), (501, 504), (1001, 1004)])
    return r.select("rn", "event_id", "value")


@register(
    "best_worst_fit",
    _decompose_sql(
        "SELECT * FROM (SELECT 'best' AS end_, station, yr, "
        + sig_sql("res_3", 8)
        + " AS res_3 FROM wide ORDER BY res_3, station, yr LIMIT 5) UNION ALL SELECT * FROM (SELECT 'worst', station, yr, "
        + sig_sql("res_3", 8)
        + " FROM wide ORDER BY res_3 DESC, station, yr LIMIT 5)"
    ),
)
def best_worst_fit(spark, sf):
    d = _decomposed(spark, sf).select("station", "yr", "res_3")
    lo = d.orderBy("res_3", "station", "yr").limit(5).select(F.lit("best").alias("end_"), "station", "yr", "res_3")
    hi = d.orderBy(F.desc("res_3"), "station", "yr").limit(5).select(F.lit("worst").alias("end_"), "station", "yr", "res_3")
    return lo.unionByName(hi).select("end_", "station", "yr", sig("res_3", 8).alias("res_3"))


# ---------------------------------------------------------------- reshape (H1, H5)

#: Stations that may become columns; more is an error.
_MAX_STATIONS = 1000
#: The keys of the nation table, since a view's columns must be named in its text.
_STATION_COLUMNS = ", ".join(f'max(CASE WHEN station = {k} THEN v END) AS "{k}"' for k in range(25))


@register(
    "pivot_year_station",
    f"""
WITH {SERIES}, tot AS (SELECT yr, station, {sig_sql('sum(v)', 11)} AS v FROM series GROUP BY 1, 2)
SELECT yr, {_STATION_COLUMNS} FROM tot GROUP BY yr
""",
)
def pivot_year_station(spark, sf):
    """Year x station table of annual totals; duplicates would raise.  Columns: the stations of the
    dimension table, at most ``_MAX_STATIONS``."""
    s = S.nation_year_series(spark, sf).select("yr", "station", sig(V.vsum("v"), 11).alias("v"))
    stations = S.table(spark, sf, "nation", "n_nationkey").distinct().limit(_MAX_STATIONS + 1)
    names = sorted(r["n_nationkey"] for r in stations.collect())
    if len(names) > _MAX_STATIONS:
        raise ValueError(f"more than {_MAX_STATIONS} stations can't become columns")
    p = series.pivot_wide(s, "yr", "station", "v", names)
    return p.select("yr", *[F.col(f"`{c}`").alias(str(c)) for c in names])


@register(
    "build_series",
    f"""
WITH {SERIES}
SELECT station, yr, list({sig_sql('v', 9)} ORDER BY pos) AS v FROM series GROUP BY 1, 2
""",
)
def build_series(spark, sf):
    s = S.nation_year_series(spark, sf)
    return s.select("station", "yr", F.transform("v", lambda x: sig(x, 9)).alias("v"))


# ---------------------------------------------------------------- append


@register(
    "stratified_union",
    f"""
SELECT label, vec_id FROM (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY {hash60_sql('vec_id')}, vec_id) AS r
  FROM embeddings WHERE label IN (0, 1)) WHERE r <= 20
""",
)
def stratified_union(spark, sf):
    """Two per-class samples appended (``unionByName``); each is a distributed top-n over the hash order."""
    e = S.table(spark, sf, "embeddings", "vec_id", "label")
    parts = []
    for lab in (0, 1):
        h = hash60("vec_id")
        parts.append(e.where(F.col("label") == lab).orderBy(h, "vec_id").limit(20).select("label", "vec_id"))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- map layer


@register(
    "map_layer",
    f"""
WITH {SERIES},
tot AS (SELECT station, yr, sum(v) AS total FROM series GROUP BY 1, 2),
st AS (SELECT station, count(*) AS n, avg(total) AS mean FROM tot GROUP BY 1),
mm AS (SELECT min(mean) AS lo, max(mean) AS hi FROM st)
SELECT st.station, n.n_name AS name, st.n, CAST(floor(1200 * sqrt(st.n)) AS INTEGER) AS radius,
       {rnd_sql('(st.mean - mm.lo) / (mm.hi - mm.lo)', 9)} AS color
FROM st JOIN nation n ON n.n_nationkey = st.station, mm
""",
)
def map_layer(spark, sf):
    """Per station: count, radius = int(1200 sqrt(count)), min-max scaled mean as the colour value."""
    s = S.nation_year_series(spark, sf).select("station", "yr", V.vsum("v").alias("total"))
    st = s.groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.avg("total").alias("mean"))
    lo, hi = st.agg(F.min("mean"), F.max("mean")).first()
    dim = S.station_dim(spark, sf).select("station", "name")
    return st.join(dim, "station").select(
        "station", "name", "n", F.floor(F.lit(1200.0) * F.sqrt("n")).cast("int").alias("radius"),
        rnd(F.try_divide(F.col("mean") - F.lit(lo), F.lit(hi - lo)), 9).alias("color"),
    )


@register(
    "bounding_box",
    f"""
WITH c AS (SELECT c_nationkey, avg(c_acctbal) / 100 AS lat, CAST(count(*) AS DOUBLE) AS lon FROM customer GROUP BY 1)
SELECT {sig_sql('min(lat)', 9)} AS lat_min, {sig_sql('max(lat)', 9)} AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
       {sig_sql('(min(lat) + max(lat)) / 2', 9)} AS lat_center, (min(lon) + max(lon)) / 2 AS lon_center FROM c
""",
)
def bounding_box(spark, sf):
    b = stats.bounding_box(S.station_dim(spark, sf), "lat", "lon")
    return b.select(
        sig("lat_min", 9).alias("lat_min"), sig("lat_max", 9).alias("lat_max"), "lon_min", "lon_max",
        sig("lat_center", 9).alias("lat_center"), "lon_center",
    )


@register(
    "coeff_vs_attribute",
    _decompose_sql(
        ", c AS (SELECT c_nationkey AS station, avg(c_acctbal) / 100 AS lat FROM customer GROUP BY 1), "
        "m AS (SELECT station, avg(coeff_1) AS c1 FROM wide GROUP BY 1) "
        f"SELECT {sig_sql('corr(m.c1, c.lat)', 7)} AS corr, {sig_sql('regr_slope(m.c1, c.lat)', 7)} AS slope "
        "FROM m JOIN c ON c.station = m.station"
    ),
)
def coeff_vs_attribute(spark, sf):
    """Relation of a station's mean first coefficient and a station attribute."""
    d = _decomposed(spark, sf).groupBy("station").agg(F.avg("coeff_1").alias("c1"))
    j = d.join(S.station_dim(spark, sf).select("station", "lat"), "station")
    return j.agg(sig(F.corr("c1", "lat"), 7).alias("corr"), sig(F.regr_slope("c1", "lat"), 7).alias("slope"))
