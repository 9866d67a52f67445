"""Thin helpers around ``pyspark.ml`` for the reference's tree, linear and neural classifiers.

Spark ML trains distributed (tree learners aggregate split statistics per partition; L-BFGS and
GD aggregate gradients per partition), so these helpers only prepare features, pick parameters
and turn models into tables.  Semantics notes:

* Spark's GBT raw prediction is half the log-odds margin: margin = 2 * raw[1].
* ``evaluateEachIteration`` log-loss is twice the usual mean -ln p; we halve it.
* Spark forests average class probabilities over trees; per-tree hard votes come from
  ``model.trees[i]`` and are counted separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_features(df: DataFrame, cols: Sequence[str] | str, out: str = "features") -> DataFrame:
    """array column, or a list of numeric columns -> ML vector column."""
    if isinstance(cols, str):
        return df.withColumn(out, array_to_vector(F.col(cols).cast("array<double>")))
    return df.withColumn(out, array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])))


def gbt_margins(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Boosted-tree margin (log-odds) per row: 2 * rawPrediction[1]."""
    p = model.transform(df)
    return p.select(*keep, (F.lit(2.0) * vector_to_array("rawPrediction")[1]).alias("margin"))


def gbt_learning_curve(model, train: DataFrame, test: DataFrame, label: str = "label") -> list[tuple[int, float, float]]:
    """(round, train log-loss, test log-loss) with Spark's doubled log-loss halved."""
    tr = model.evaluateEachIteration(train)
    te = model.evaluateEachIteration(test)
    return [(i + 1, float(a) / 2.0, float(b) / 2.0) for i, (a, b) in enumerate(zip(tr, te))]


def error_rate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    r = pred.agg(F.avg((F.col(label).cast("double") != F.col(prediction)).cast("double"))).first()[0]
    return float(r) if r is not None else float("nan")


def mlp(layers: Sequence[int], iters: int, features: str, label: str, solver: str = "l-bfgs", step: float = 0.03, start=None, seed: int = 1):
    """A multilayer perceptron learner; ``start``: a fitted (or reloaded) model whose weights training goes on from."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    est = MultilayerPerceptronClassifier(layers=list(layers), solver=solver, stepSize=step, maxIter=iters, seed=seed, featuresCol=features, labelCol=label)
    return est if start is None else est.setInitialWeights(start.weights)


def mlp_trace(train: DataFrame, parts: dict[str, DataFrame], layers: Sequence[int], rate: float, segments: int, steps: int, features: str, label: str) -> list[tuple]:
    """(rate, step, error of each part ...) after 0, ``steps``, 2 x ``steps`` ... steps of gradient descent.

    One run in warm-started segments: each goes on from the weights of the one before (Spark's step size falls with
    the root of the step's number within a segment, so a segment begins at the full rate again). The row at step 0 is that of the seed's own
    weights, the same for all rates."""
    rows, model = [], None
    for k in range(segments + 1):
        model = mlp(layers, steps if k else 0, features, label, "gd", rate, model).fit(train)
        rows.append((rate, k * steps, *(error_rate(model.transform(p), label) for p in parts.values())))
    return rows
