"""Readers, sinks and bundle tables.

Readers always take an explicit schema when one is known (no inference pass over the data).
Sinks overwrite atomically per path and partition by the keys later queries filter on, so
partition pruning replaces the reference's one-file-per-state layout.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV/TSV with a header.  With ``schema=None`` types are inferred (an extra pass: avoid at scale)."""
    r = spark.read.option("header", header).option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small local rows with an explicit schema (fixtures, lookup tables)."""
    return spark.createDataFrame(list(rows), schema)


def missing_marker_to_null(df: DataFrame, column: str, marker: float = -999.9) -> DataFrame:
    """A sentinel such as -999.9 (missing elevation) -> NULL, for that column only."""
    return df.withColumn(column, F.when(F.col(column) == F.lit(marker), F.lit(None)).otherwise(F.col(column)))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink replacing old output; partitioned by the given keys (pruned on read).

    Rows of a key are brought together first, so a key gets few files and not one from each task; the
    rebalancing splits a hot key over several tasks by its measured size.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- statistics bundle as three tables


def save_stat_tables(scalars: DataFrame | None, vectors: DataFrame | None, matrices: DataFrame | None, path: str) -> None:
    """stat_scalar(group, name, value), stat_vector(group, name, pos, value),
    stat_matrix(group, name, i, j, value) -- each a parquet table partitioned by name."""
    for tbl, df in (("stat_scalar", scalars), ("stat_vector", vectors), ("stat_matrix", matrices)):
        if df is not None:
            write_table(df, f"{path.rstrip('/')}/{tbl}", ["name"])


def load_stat_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The stat tables present under ``path`` (a bundle may hold only some of the three)."""
    out = {}
    for t in ("stat_scalar", "stat_vector", "stat_matrix"):
        try:
            out[t] = spark.read.parquet(f"{path.rstrip('/')}/{t}")
        except AnalysisException as e:  # the same answer from every file system
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return out


def save_pca_bundle(eig: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """PCA output (by..., k, eigval, pos, u) as two tables: basis(k, pos, u) and eigval(k, eigval)."""
    p = path.rstrip("/")
    write_table(eig.select(*by, "k", "pos", "u"), f"{p}/basis", list(by))
    write_table(eig.select(*by, "k", "eigval").distinct(), f"{p}/eigval", list(by))


def load_pca_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    p = path.rstrip("/")
    return spark.read.parquet(f"{p}/basis"), spark.read.parquet(f"{p}/eigval")


#: Entries of a basis that ``basis_matrix`` collects at most.
MAX_BASIS_ENTRIES = 4_000_000


def basis_matrix(basis: DataFrame, k: int | None = None) -> np.ndarray:
    """Collect a (k x d) basis table (at most ``MAX_BASIS_ENTRIES`` entries) into a NumPy matrix for ``decompose``."""
    b = basis if k is None else basis.where(F.col("k") < k)
    rows = b.select("k", "pos", "u").limit(MAX_BASIS_ENTRIES + 1).collect()
    if len(rows) > MAX_BASIS_ENTRIES:
        raise ValueError(f"basis exceeds {MAX_BASIS_ENTRIES} entries")
    kk = max(r["k"] for r in rows) + 1
    d = max(r["pos"] for r in rows) + 1
    U = np.zeros((kk, d))
    for r in rows:
        U[r["k"], r["pos"]] = r["u"]
    return U


def scalars_table(spark: SparkSession, group: str, values: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(group, k, float(v)) for k, v in values.items()], "group string, name string, value double")
