"""Shared DuckDB CTE text for the oracle queries (same stand-ins as ``standins.py``)."""

from ..functions.rounding import rnd_sql, sig_sql

__all__ = ["SERIES", "EVENT_SERIES", "PRICES", "SECTOR", "VECS", "rnd_sql", "sig_sql"]

# nation x year -> 12 monthly sums of o_totalprice, long form with holes (NULL v)
SERIES = """
cell AS (
  SELECT c_nationkey AS station, CAST(year(o_orderdate) AS INTEGER) AS yr,
         CAST(month(o_orderdate) AS INTEGER) - 1 AS pos, CAST(sum(o_totalprice) AS DOUBLE) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
keys AS (SELECT DISTINCT station, yr FROM cell),
series AS (
  SELECT k.station, k.yr, CAST(p.pos AS INTEGER) AS pos, c.v
  FROM keys k CROSS JOIN (SELECT range AS pos FROM range(12)) p
  LEFT JOIN cell c ON c.station = k.station AND c.yr = k.yr AND c.pos = p.pos)
"""

# user x event_type -> 31 daily sums of value, long form with holes
EVENT_SERIES = """
ecell AS (
  SELECT user_id, event_type, CAST(day(ts) AS INTEGER) - 1 AS pos, CAST(sum(value) AS DOUBLE) AS v
  FROM events GROUP BY 1, 2, 3),
ekeys AS (SELECT DISTINCT user_id, event_type FROM ecell),
eseries AS (
  SELECT k.user_id, k.event_type, CAST(p.pos AS INTEGER) AS pos, c.v
  FROM ekeys k CROSS JOIN (SELECT range AS pos FROM range(31)) p
  LEFT JOIN ecell c ON c.user_id = k.user_id AND c.event_type = k.event_type AND c.pos = p.pos)
"""

# brand x month -> mean unit price
PRICES = """
prices AS (
  SELECT p_brand AS brand, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS period,
         avg(l_extendedprice / l_quantity) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
"""

# brand -> most common p_type (ties: smallest name)
SECTOR = """
sector AS (
  SELECT brand, sector FROM (
    SELECT p_brand AS brand, p_type AS sector,
           row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS r
    FROM part GROUP BY p_brand, p_type) WHERE r = 1)
"""

# embeddings in long form, doubles
VECS = """
vlong AS (
  SELECT vec_id, label, CAST(u.pos AS INTEGER) - 1 AS pos, CAST(u.x AS DOUBLE) AS x
  FROM embeddings, LATERAL (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos) u)
"""
