"""Sampling, splitting and resampling queries.

All draws use one shared 60-bit hash of (seed, key), so the same rows are picked in DuckDB and on
every re-run or recomputation after an executor loss (``rand()`` would change with partitioning).  Row numbers over a shuffled order use the distributed global rank.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import cut, hash60_sql
from ..operators import sample
from ..operators.ordered import global_row_number
from . import standins as S
from .registry import register


@register("hash_sample", f"SELECT event_id, value FROM events WHERE {hash60_sql('event_id')} < {cut(0.01)}")
def hash_sample(spark, sf):
    """A 1 % Bernoulli-like sample, deterministic (hash of the key below a cut)."""
    e = S.table(spark, sf, "events", "event_id", "value")
    return sample.hash_sample(e, "event_id", 0.01).select("event_id", "value")


@register(
    "split_70_15_15",
    f"""
SELECT vec_id, CASE WHEN {hash60_sql('vec_id')} < {cut(0.70)} THEN 'train'
                    WHEN {hash60_sql('vec_id')} < {cut(0.70 + 0.15)} THEN 'validation' ELSE 'test' END AS split
FROM embeddings
""",
)
def split_70_15_15(spark, sf):
    e = S.table(spark, sf, "embeddings", "vec_id")
    return sample.hash_split(e, "vec_id", {"train": 0.70, "validation": 0.15, "test": 0.15}).select("vec_id", "split")


@register("fold_assign", f"SELECT vec_id, CAST({hash60_sql('vec_id')} % 10 AS INTEGER) AS fold FROM embeddings")
def fold_assign(spark, sf):
    """10 folds; every row is in exactly one test fold."""
    return sample.fold_column(S.table(spark, sf, "embeddings", "vec_id"), "vec_id", 10).select("vec_id", "fold")


@register(
    "hash_split",
    f"""
SELECT CASE WHEN {hash60_sql('event_id')} < {cut(0.5)} THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       count(DISTINCT event_id) AS n_distinct FROM events GROUP BY 1
""",
)
def hash_split(spark, sf):
    """The test part is the complement of the train part by the same hash column (no subtract)."""
    e = sample.hash_split(S.table(spark, sf, "events", "event_id"), "event_id", {"train": 0.5, "test": 0.5})
    return e.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_distinct"))


@register(
    "shuffle_take",
    f"SELECT vec_id FROM embeddings ORDER BY {hash60_sql('vec_id')}, vec_id LIMIT 100",
)
def shuffle_take(spark, sf):
    """Shuffle, then the first n rows (a distributed top-n over the hash order)."""
    e = S.table(spark, sf, "embeddings", "vec_id")
    return sample.shuffle_take(e, "vec_id", 100).select("vec_id")


@register(
    "minibatch_assign",
    f"""
SELECT vec_id, CAST((row_number() OVER (ORDER BY {hash60_sql('vec_id')}, vec_id) - 1) // 100 AS BIGINT) AS batch
FROM embeddings
""",
)
def minibatch_assign(spark, sf):
    """Batch id = (rank in the shuffled order - 1) div b, ranked without a single-task window."""
    e = S.table(spark, sf, "embeddings", "vec_id")
    r = global_row_number(e.withColumn("_h", sample.hash_key("vec_id")), [F.col("_h"), F.col("vec_id")], "rn")
    return r.select("vec_id", ((F.col("rn") - 1) / 100).cast("long").alias("batch"))
