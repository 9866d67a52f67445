"""Whole ensembles in one pass: all trees' votes, margins after every boosting round, predictions at every depth.

A fitted tree model is read from its own saved form into flat node tables (feature, threshold, children,
prediction, class counts). They are the size of the model, not of the data, and bounded by ``MAX_NODES``. Each task
walks its Arrow batches down all trees at once, so one scan of the rows serves every tree, round and depth,
where ``model.trees[i].transform`` needs a scan for each.

Only continuous features: a tree that splits on categories is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, ensure_checkpoint_dir

MAX_NODES = 2_000_000


@dataclass
class NodeTables:
    """Nodes of all trees one after the other; ``root`` and ``weight`` by tree, children -1 at leaves."""

    root: np.ndarray
    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    share: np.ndarray  # class shares of the training rows of each node
    depth: int

    def steps(self, x: np.ndarray, tree: int) -> Iterator[np.ndarray]:
        """The node of every row after 0, 1, ... ``depth`` steps down; a row stays at its leaf."""
        node = np.full(len(x), self.root[tree])
        rows = np.arange(len(x))
        yield node
        for _ in range(self.depth):
            down = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            node = np.where(self.left[node] >= 0, down, node)
            yield node

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        for node in self.steps(x, tree):
            pass
        return node

    def node_counts(self, depths: Sequence[int], tree: int = 0) -> list[int]:
        """Number of nodes of the tree cut at each depth, twin leaves of one prediction merged (as the learner does)."""

        def count(node: int, left: int) -> tuple[int, float | None]:
            """(nodes, the prediction if it is a leaf)"""
            if left == 0 or self.left[node] < 0:
                return 1, self.prediction[node]
            (n, a), (m, b) = count(self.left[node], left - 1), count(self.right[node], left - 1)
            return (1, a) if a is not None and a == b else (n + m + 1, None)

        return [count(int(self.root[tree]), d)[0] for d in depths]


def node_tables(spark: SparkSession, model) -> NodeTables:
    """Node tables of a fitted tree, forest or boosted model, through its saved form in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.withColumn("treeID", F.lit(0))
    split = F.col("split")
    nodes = nodes.select(
        "treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", split["featureIndex"].alias("feature"),
        F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"), split["numCategories"].alias("categories"),
    )
    rows = sorted(nodes.limit(MAX_NODES + 1).collect(), key=lambda r: (r.treeID, r.id))
    delete_folder(spark, path)
    if len(rows) > MAX_NODES:
        raise ValueError(f"the model has more than {MAX_NODES} nodes")
    if any(r.leftChild >= 0 and r.categories >= 0 for r in rows):
        raise ValueError("splits on categories aren't supported")
    tree = np.array([r.treeID for r in rows])
    root = np.flatnonzero(np.diff(tree, prepend=-1))
    base = np.repeat(root, np.diff(np.append(root, len(rows))))  # ids count from 0 in each tree
    left, right = (np.array([getattr(r, c) for r in rows]) for c in ("leftChild", "rightChild"))
    stats = np.array([r.impurityStats for r in rows], float)
    leaf = left < 0
    level = np.zeros(len(rows), int)
    for k in np.flatnonzero(~leaf):  # parents come before their children
        level[base[k] + left[k]] = level[base[k] + right[k]] = level[k] + 1
    return NodeTables(
        root, np.array(getattr(model, "treeWeights", [1.0] * len(root)), float), np.where(leaf, 0, [r.feature for r in rows]),
        np.array([0.0 if r.leftChild < 0 else r.threshold for r in rows]), np.where(leaf, -1, base + left), np.where(leaf, -1, base + right),
        np.array([r.prediction for r in rows]), stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300), int(level.max(initial=0)),
    )


def _walked(df: DataFrame, tables: NodeTables, features: str, keep: Sequence[str], outputs: dict, make) -> DataFrame:
    """``keep`` and the arrays ``make(tables, x)`` gives for the rows of ``x``, one pass over ``df``."""
    src = df.select(*keep, vector_to_array(features).alias("_x"))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in outputs])
    shared = df.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(len(keep)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cols = [batch.column(k) for k in range(len(keep))]
            for y in make(shared.value, x):
                at = pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32())
                cols.append(pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(y).ravel())))
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *outputs])

    return src.mapInArrow(run, schema)


def forest_votes(df: DataFrame, model, features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., votes, probability): every tree's own prediction, and the class shares averaged over the trees."""

    def make(tables: NodeTables, x: np.ndarray):
        leaves = [tables.leaves(x, t) for t in range(len(tables.root))]
        yield np.stack([tables.prediction[n] for n in leaves], axis=1)
        yield sum(tables.share[n] for n in leaves) / len(leaves)

    return _walked(df, node_tables(df.sparkSession, model), features, keep, {"votes": 0, "probability": 0}, make)


def staged_margins(df: DataFrame, model, features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., margins): the log-odds margin of a boosted model after each of its rounds, from one fit."""

    def make(tables: NodeTables, x: np.ndarray):
        parts = [w * tables.prediction[tables.leaves(x, t)] for t, w in enumerate(tables.weight)]
        yield 2 * np.cumsum(np.stack(parts, axis=1), axis=1)

    return _walked(df, node_tables(df.sparkSession, model), features, keep, {"margins": 0}, make)


def staged_errors(margins: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """(by..., round, logloss, error) of each boosting round (from 1) of ``staged_margins`` with 0/1 labels."""
    e = margins.select(*by, F.col(label).cast("double").alias("_y"), F.posexplode("margins").alias("_at", "_m"))
    s = F.when(F.col("_y") > 0, -F.col("_m")).otherwise(F.col("_m"))
    # ln(1 + e^s) without overflow
    loss = F.greatest(s, F.lit(0.0)) + F.log1p(F.exp(-F.abs(s)))
    wrong = ((F.col("_m") > 0) != (F.col("_y") > 0)).cast("double")
    return e.groupBy(*by, (F.col("_at") + 1).alias("round")).agg(F.avg(loss).alias("logloss"), F.avg(wrong).alias("error"))


def depth_predictions(df: DataFrame, tables: NodeTables, depths: Sequence[int], features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., by_depth): the prediction of the one tree cut at each of ``depths``, from one walk down each path."""
    wanted = list(depths)

    def make(tables: NodeTables, x: np.ndarray):
        path = [tables.prediction[n] for n in tables.steps(x, 0)]
        yield np.stack([path[min(d, tables.depth)] for d in wanted], axis=1)

    return _walked(df, tables, features, keep, {"by_depth": 0}, make)


def depth_errors(predicted: DataFrame, depths: Sequence[int], label: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., depth, error) of ``depth_predictions``."""
    at = F.array(*[F.lit(int(d)) for d in depths])
    e = predicted.select(*by, label.cast("double").alias("_y"), F.explode(F.arrays_zip(at.alias("d"), F.col("by_depth").alias("p"))).alias("e"))
    return e.groupBy(*by, F.col("e.d").alias("depth")).agg(F.avg((F.col("e.p") != F.col("_y")).cast("double")).alias("error"))
