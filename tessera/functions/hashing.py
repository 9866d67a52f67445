"""One shared 60-bit hash for every draw, split, fold, shuffle and pick.

The first 15 hex digits of ``md5('<seed>:<key>')`` as an integer in [0, 2^60): uniform over the whole
range, with independent values for different seeds, and the same in Spark and in SQL engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60
SPAN = 1 << BITS


def hash60(key: Column | str, seed: int = 0) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash60_sql(key: str, seed: int = 0) -> str:
    """The same in DuckDB SQL."""
    return f"CAST('0x' || substr(md5('{seed}:' || ({key})), 1, 15) AS BIGINT)"


def cut(share: float) -> int:
    """The hash value below which a share of all keys lies."""
    return min(SPAN, int(round(share * SPAN)))


def uniform(key: Column | str, seed: int = 0) -> Column:
    """(0, 1): the hash plus a half, over its span."""
    return (hash60(key, seed).cast("double") + 0.5) / float(SPAN)


def uniform_sql(key: str, seed: int = 0) -> str:
    return f"((CAST({hash60_sql(key, seed)} AS DOUBLE) + 0.5) / {float(SPAN)!r})"
