"""Statistics queries over the series stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import rnd, sig
from ..operators import stats
from . import standins as S
from .registry import register
from .sqltext import SERIES, rnd_sql, sig_sql


@register(
    "position_stats",
    f"""
WITH {SERIES}
SELECT pos, {sig_sql('sum(v)', 11)} AS E, count(v) AS NE,
       {sig_sql('sum(v) / count(v)', 11)} AS mean,
       {sig_sql('sum(v * v) / count(v) - (sum(v) / count(v)) * (sum(v) / count(v))', 11)} AS var
FROM series GROUP BY pos
""",
)
def position_stats(spark, sf):
    s = stats.position_stats(S.nation_year_series(spark, sf))
    return s.select("pos", sig("E", 11).alias("E"), "NE", sig("mean", 11).alias("mean"), sig("var", 11).alias("var"))
