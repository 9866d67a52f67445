"""Lookups and ordered slices over plain tables.

Dimension joins are written as plain equi-joins: Spark/AQE broadcast the dimension when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and fall back to a shuffle join
(with AQE skew splitting) when it is not -- the size check is Spark's, not a guess of ours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import global_row_number

#: Ranks up to this one are taken by a top-k: each task keeps that many rows, one task merges them.
MAX_TOP = 100_000


def lookup_fallback(facts: DataFrame, dim: DataFrame, key: str, found: Column, fallback: Column, out: str) -> DataFrame:
    """Left join; ``out`` = found value, else the fallback; ``known`` flags a match. A key that stands
    more than once in the dimension gives its first row in the order of all columns, once."""
    rest = [c for c in dim.columns if c != key]
    d = dim.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first")) if rest else dim.select(key).distinct()
    d = d.select(key, *([F.col(f"_first.{c}").alias(c) for c in rest]), F.lit(True).alias("_hit"))
    j = facts.join(d, key, "left")
    return j.select(*facts.columns, F.coalesce(found, fallback).alias(out), F.coalesce(F.col("_hit"), F.lit(False)).alias("known"))


def _unique_keys(dim: DataFrame, key: str) -> DataFrame:
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 1).select(key)


def lookup_strict(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keep facts whose key matches exactly one dimension row (semi join on unique keys, then join)."""
    ok = facts.join(_unique_keys(dim, key), key, "left_semi")
    return ok.join(dim, key)


def lookup_unmatched(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The report side of a strict lookup: facts with zero or several matches (left anti)."""
    return facts.join(_unique_keys(dim, key), key, "left_anti")


def top_both_ends(df: DataFrame, value: str, key: str, k: int, label: str = "end_") -> DataFrame:
    """Lowest and highest k rows by ``value`` (ties by ``key``): two distributed TakeOrdered plans."""
    cols = [c for c in df.columns]
    lo = df.orderBy(F.col(value).asc(), F.col(key).asc()).limit(k).select(F.lit("low").alias(label), *cols)
    hi = df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k).select(F.lit("high").alias(label), *cols)
    return lo.unionByName(hi)


def ranked_slices(df: DataFrame, order: Sequence[Column], slices: Sequence[tuple[int, int]], name: str = "rn") -> DataFrame:
    """Rows whose rank in ``order`` (total, from 1) lies in one of the slices (first, last), with the rank as ``name``. Where
    the last wanted rank is at most ``MAX_TOP`` only that many rows are ordered, otherwise all are ranked over partitions."""
    last = max(b for _, b in slices)
    if last <= MAX_TOP:
        r = df.orderBy(*order).limit(last).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    else:
        r = global_row_number(df, order, name)
    keep = F.lit(False)
    for a, b in slices:
        keep = keep | F.col(name).between(a, b)
    return r.where(keep)
