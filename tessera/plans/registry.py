"""Query registry: one Spark plan and (where SQL can say it) one DuckDB oracle text per operator.

Query modules register with ``@register(name, sql)``.  Float outputs are rounded on both sides with
the helpers in ``tessera.functions.rounding`` so the driver's value hash compares like with like.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
KIND: dict[str, str] = {}

MODULES = (
    "q_stats",
    "q_relational",
    "q_decomp",
    "q_bundle",
    "q_judge",
    "q_cluster",
    "q_sample",
    "q_vector",
    "q_learn",
    "q_io",
)


def register(name: str, sql: str | None = None, kind: str = "O") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        KIND[name] = kind if sql is not None else "I"
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
