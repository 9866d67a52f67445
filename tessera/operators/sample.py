"""Deterministic sampling and splitting by a shared 60-bit hash of (seed, key).

Reproducible in SQL engines, stable under re-partitioning and task retries (unlike ``rand()``), and
computed row by row with no shuffle. Different seeds give independent draws.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import cut, hash60


def hash_key(key: str, seed: int = 0) -> Column:
    return hash60(key, seed)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose hash falls below the fraction of its span: about ``fraction`` of the rows, however small."""
    return df.where(hash60(key, seed) < F.lit(cut(fraction)))


def split_edges(parts: Mapping[str, float]) -> list[tuple[str, int]]:
    """(name, exclusive upper hash value) for consecutive shares that sum to 1."""
    edge, out = 0.0, []
    for name, share in parts.items():
        edge += share
        out.append((name, cut(edge)))
    return out


def hash_split(df: DataFrame, key: str, parts: Mapping[str, float], seed: int = 0) -> DataFrame:
    """Add ``split``: consecutive ranges of the hash per named part (shares sum to 1)."""
    *first, (last, _) = split_edges(parts)
    expr = None
    for name, edge in first:
        cond = hash60(key, seed) < F.lit(edge)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr.otherwise(F.lit(last)) if expr is not None else F.lit(last))


def fold_column(df: DataFrame, key: str, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    return df.withColumn(name, F.pmod(hash60(key, seed), F.lit(k)).cast("int"))


def shuffle_take(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """First n rows of a seeded shuffle: a TakeOrderedAndProject on (hash, key)."""
    return df.orderBy(hash60(key, seed), F.col(key)).limit(n)


def bernoulli(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own Bernoulli sample (``df.sample``), for when reproducibility across engines is not needed."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
