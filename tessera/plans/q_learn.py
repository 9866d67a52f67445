"""Learning queries (T1-T16, R5): Spark ML fits on table-derived features; rows-only checks.

Features: the 13-column feature rows of ``embeddings`` (10 projections, rmse, peak-to-peak) for
the binary task (label % 2), and the raw 64-vector for the 10-class task.  Splits are hash splits.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.hashing import cut
from ..functions.rounding import rnd
from ..operators import decomp, judge, learn, sample, trees
from ..session import cut_lineage
from . import standins as S
from .registry import register

_F64 = decomp.fourier_rows(64, harmonics=5)[:10]
FEATURE_NAMES = [f"proj_{i + 1}" for i in range(10)] + ["rmse", "peak2peak"]


def features(spark, sf):
    x = S.vectors(spark, sf)
    cols = [V.dot("x", V.lit_vector(u)).alias(f"proj_{i + 1}") for i, u in enumerate(_F64)]
    f = x.select("vec_id", "x", (F.col("label") % 2).cast("double").alias("label"), F.col("label").cast("double").alias("label10"), *cols,
                 V.vec_std("x").alias("rmse"), V.peak_to_peak("x").alias("peak2peak"))
    f = learn.with_features(f, FEATURE_NAMES)
    return sample.hash_split(f, "vec_id", {"train": 0.7, "test": 0.3})


def _gbt(max_iter=20, depth=3):
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(maxDepth=depth, stepSize=0.3, maxIter=max_iter, seed=1)


@register("gbt_margin")
def gbt_margin(spark, sf):
    """Boosted trees (depth 3, step 0.3) on the train split; log-odds margins for the test split."""
    f = features(spark, sf)
    m = _gbt().fit(f.where("split = 'train'"))
    return learn.gbt_margins(m, f.where("split = 'test'"), ["vec_id", "label"])


@register("gbt_early_stop")
def gbt_early_stop(spark, sf):
    """Rounds stop once the validation error no longer falls (``validationIndicatorCol``)."""
    f = features(spark, sf).where("split = 'train'")
    f = f.withColumn("validation", sample.hash_key("vec_id", 5) < cut(0.3))
    gbt = _gbt(max_iter=100).setParams(validationIndicatorCol="validation")  # validationTol: 0.01
    m = gbt.fit(f)
    te = features(spark, sf).where("split = 'test'")
    return spark.createDataFrame([(100, m.getNumTrees, learn.error_rate(m.transform(te)))], "max_rounds int, rounds int, test_error double")


@register("gbt_learning_curve")
def gbt_learning_curve(spark, sf):
    """Train / test log-loss and error after every round of one fit, and the best round (least test log-loss)."""
    f = features(spark, sf)
    m = _gbt(max_iter=30).fit(f.where("split = 'train'"))
    curve = trees.staged_errors(trees.staged_margins(f, m, keep=["split", "label"]), by=["split"])
    side = lambda name: curve.where(F.col("split") == name).select("round", F.col("logloss").alias(f"{name}_logloss"), F.col("error").alias(f"{name}_error"))
    both = cut_lineage(side("train").join(side("test"), "round"))  # a row for each round
    best = both.agg(F.min_by("round", F.struct("test_logloss", "round"))).first()[0]
    return both.withColumn("best_round", F.lit(best))


@register("gbt_depth_sweep")
def gbt_depth_sweep(spark, sf):
    """Depth 1..5, test error of each boosted model."""
    f = features(spark, sf)
    tr, te = f.where("split = 'train'"), f.where("split = 'test'")
    rows = [(d, learn.error_rate(_gbt(10, d).fit(tr).transform(te))) for d in range(1, 6)]
    return spark.createDataFrame(rows, "depth int, test_error double")


@register("feature_importance")
def feature_importance(spark, sf):
    """T4: importances joined with feature names (Spark's are gain-based)."""
    f = features(spark, sf)
    m = _gbt().fit(f.where("split = 'train'"))
    imp = m.featureImportances.toArray()
    rows = [(i, FEATURE_NAMES[i], float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "idx int, feature string, importance double")


@register("multiclass_margins")
def multiclass_margins(spark, sf):
    """T5: one-vs-rest boosted trees over 10 labels; one raw score per class, top-1 prediction."""
    from pyspark.ml.classification import OneVsRest

    f = learn.with_features(features(spark, sf), "x", "vx")
    ovr = OneVsRest(classifier=_gbt(max_iter=5), featuresCol="vx", labelCol="label10")
    m = ovr.fit(f.where("split = 'train'"))
    from pyspark.ml.functions import vector_to_array

    p = m.transform(f.where("split = 'test'"))
    return p.select("vec_id", "label10", vector_to_array("rawPrediction").alias("scores"), "prediction")


DEPTHS = range(1, 30)


def _tree(depth):
    from pyspark.ml.classification import DecisionTreeClassifier

    return DecisionTreeClassifier(maxDepth=depth, featuresCol="vx", labelCol="label10", seed=1)


@register("tree_depth_sweep")
def tree_depth_sweep(spark, sf):
    """Decision tree depth 1..29: train error, test error, node count, all from one tree of depth 29: a row's
    prediction at depth d is that of the node its path reaches there."""
    f = learn.with_features(features(spark, sf), "x", "vx")
    tables = trees.node_tables(spark, _tree(max(DEPTHS)).fit(f.where("split = 'train'")))
    p = trees.depth_predictions(f, tables, DEPTHS, "vx", ["split", "label10"])
    e = trees.depth_errors(p, DEPTHS, F.col("label10"), ["split"]).groupBy("depth").agg(
        F.max(F.when(F.col("split") == "train", F.col("error"))).alias("train_error"),
        F.max(F.when(F.col("split") == "test", F.col("error"))).alias("test_error"),
    )
    counts = F.create_map(*[F.lit(x) for pair in zip(DEPTHS, tables.node_counts(DEPTHS)) for x in pair])
    return e.withColumn("num_nodes", counts[F.col("depth")])


@register("tree_cv")
def tree_cv(spark, sf):
    """10-fold cross-validated error by depth (fold column = the hash fold of R3)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    f = sample.fold_column(learn.with_features(features(spark, sf), "x", "vx"), "vec_id", 10)
    dt = DecisionTreeClassifier(featuresCol="vx", labelCol="label10", seed=1)
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [2, 4, 6, 8]).build()
    ev = MulticlassClassificationEvaluator(labelCol="label10", metricName="accuracy")
    cv = CrossValidator(estimator=dt, estimatorParamMaps=grid, evaluator=ev, foldCol="fold", numFolds=10, parallelism=2).fit(f)
    rows = [(int(pm[dt.maxDepth]), float(1 - a)) for pm, a in zip(grid, cv.avgMetrics)]
    return spark.createDataFrame(rows, "depth int, cv_error double")


#: (trees, depth) of the two forests.
FORESTS = ((7, 2), (100, 8))


def _forest(spark, sf, n_trees=7, depth=2):
    from pyspark.ml.classification import RandomForestClassifier

    f = learn.with_features(features(spark, sf), "x", "vx")
    m = RandomForestClassifier(numTrees=n_trees, maxDepth=depth, featuresCol="vx", labelCol="label10", seed=1).fit(f.where("split = 'train'"))
    return m, f


def _both_forests(spark, sf):
    """(n_trees, vec_id, label10, votes, probability, prediction) of the test rows under both forests: one pass each."""
    parts = []
    for n, depth in FORESTS:
        m, f = _forest(spark, sf, n, depth)
        v = trees.forest_votes(f.where("split = 'test'"), m, "vx", ["vec_id", "label10"])
        # the first of the largest
        best = (F.array_position("probability", F.array_max("probability")) - 1).cast("double")
        parts.append(v.select(F.lit(n).alias("n_trees"), "*", best.alias("prediction")))
    return parts[0].unionByName(parts[1])


@register("forest_fit")
def forest_fit(spark, sf):
    """Random forests (7 trees of depth 2, 100 of depth 8); test predictions and class probabilities."""
    return _both_forests(spark, sf).select("n_trees", "vec_id", "label10", "prediction", "probability")


@register("forest_votes")
def forest_votes(spark, sf):
    """Each tree's hard vote beside the forest's prediction (tree -1), long form, for both forests; all trees
    of a forest vote in one pass."""
    v = _both_forests(spark, sf).select("n_trees", "vec_id", F.posexplode(F.concat(F.array("prediction"), "votes")).alias("tree", "vote"))
    return v.withColumn("tree", F.col("tree") - 1)


@register(
    "linear_fit",
    "SELECT round_even(regr_slope(l_extendedprice, l_quantity), 6) + 0.0 AS slope, "
    "round_even(regr_intercept(l_extendedprice, l_quantity), 4) + 0.0 AS intercept, count(*) AS n FROM lineitem",
)
def linear_fit(spark, sf):
    """Least-squares line, closed form (one feature): the minimiser of sum e^2 / (2n)."""
    li = S.table(spark, sf, "lineitem", "l_extendedprice", "l_quantity")
    return li.agg(
        rnd(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        rnd(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
        F.count(F.lit(1)).alias("n"),
    )


@register(
    "linear_fit_ml",
    "SELECT round_even(slope, 4) + 0.0 AS slope, round_even(intercept, 2) + 0.0 AS intercept, "
    "round_even(sqrt(avg((l_extendedprice - slope * l_quantity - intercept) ** 2)), 2) + 0.0 AS rmse FROM lineitem, "
    "(SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem) GROUP BY slope, intercept",
)
def linear_fit_ml(spark, sf):
    """T12 with ``ml.LinearRegression`` (normal equations), the form for many features."""
    from pyspark.ml.regression import LinearRegression

    li = learn.with_features(S.table(spark, sf, "lineitem", "l_extendedprice", "l_quantity"), ["l_quantity"])
    m = LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal").fit(li)
    out = spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept), float(m.summary.rootMeanSquaredError))], "slope double, intercept double, rmse double")
    return out.select(rnd("slope", 4).alias("slope"), rnd("intercept", 2).alias("intercept"), rnd("rmse", 2).alias("rmse"))


@register("logistic_fit")
def logistic_fit(spark, sf):
    """Multinomial logistic regression with L2 (Spark does not penalise the intercept)."""
    from pyspark.ml.classification import LogisticRegression

    f = learn.with_features(features(spark, sf), "x", "vx")
    m = LogisticRegression(family="multinomial", regParam=0.01, maxIter=50, featuresCol="vx", labelCol="label10").fit(f.where("split = 'train'"))
    rows = [("train", learn.error_rate(m.transform(f.where("split = 'train'")), "label10")),
            ("test", learn.error_rate(m.transform(f.where("split = 'test'")), "label10"))]
    return spark.createDataFrame(rows, "split string, error double")


@register("mlp_fit")
def mlp_fit(spark, sf):
    """Two hidden sigmoid layers, softmax output (64-32-32-10)."""
    f = learn.with_features(features(spark, sf), "x", "vx")
    m = learn.mlp([64, 32, 32, 10], 100, "vx", "label10").fit(f.where("split = 'train'"))
    rows = [("train", learn.error_rate(m.transform(f.where("split = 'train'")), "label10")),
            ("test", learn.error_rate(m.transform(f.where("split = 'test'")), "label10"))]
    return spark.createDataFrame(rows, "split string, error double")


RATES, SEGMENTS, STEPS = (0.1, 0.01, 0.001), 3, 100


@register("rate_sweep")
def rate_sweep(spark, sf):
    """Gradient descent at step sizes 0.1, 0.01, 0.001; train and test error after every 100 steps."""
    f = learn.with_features(features(spark, sf), "x", "vx").select("split", "vx", "label10").cache()
    parts = {s: f.where(F.col("split") == s) for s in ("train", "test")}
    rows = [r for rate in RATES for r in learn.mlp_trace(parts["train"], parts, [64, 16, 10], rate, SEGMENTS, STEPS, "vx", "label10")]
    f.unpersist()
    return spark.createDataFrame(rows, "rate double, step int, train_error double, test_error double")


@register("pipeline_estimator")
def pipeline_estimator(spark, sf):
    """T16 + S10: a Pipeline (features -> classifier) fit, saved to and reloaded from the shared
    checkpoint folder, then evaluated."""
    import uuid

    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from ..session import ensure_checkpoint_dir

    f = learn.with_features(features(spark, sf), "x", "vx")
    pipe = Pipeline(stages=[LogisticRegression(maxIter=30, featuresCol="vx", labelCol="label10")])
    model = pipe.fit(f.where("split = 'train'"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    acc = MulticlassClassificationEvaluator(labelCol="label10", metricName="accuracy").evaluate(loaded.transform(f.where("split = 'test'")))
    return spark.createDataFrame([(float(acc),)], "test_accuracy double")


SPLITS, ROUNDS = 10, (10, 100)


@register("margin_stability")
def margin_stability(spark, sf):
    """Ten random splits x (10, 100) rounds: errors of both classes against the margin's threshold on the split's own
    test rows. One fit of 100 rounds for each split also gives the margins after 10; fits run side by side."""
    from concurrent.futures import ThreadPoolExecutor

    f0 = cut_lineage(features(spark, sf).drop("split", "x"))

    def one(seed):
        f = sample.hash_split(f0, "vec_id", {"train": 0.7, "test": 0.3}, seed=seed)
        m = _gbt(max_iter=max(ROUNDS)).fit(f.where("split = 'train'"))
        margins = trees.staged_margins(f.where("split = 'test'"), m, keep=["label"])
        rounds = F.array(*[F.struct(F.lit(r).alias("rounds"), F.element_at("margins", r).alias("margin")) for r in ROUNDS])
        return margins.select(F.lit(seed).alias("seed"), F.col("label").cast("int").alias("y"), F.explode(rounds).alias("e"))

    with ThreadPoolExecutor(4) as pool:
        parts = list(pool.map(one, range(SPLITS)))
    scored = cut_lineage(reduce(DataFrame.unionByName, parts).select("seed", "e.rounds", "y", F.col("e.margin").alias("score")))
    wrong = ((F.col("score") > 0) != (F.col("y") > 0)).cast("double")
    whole = scored.groupBy("seed", "rounds").agg(F.avg(wrong).alias("test_error"))
    return judge.threshold_errors(scored, "y", "score", 1, by=["seed", "rounds"]).join(whole, ["seed", "rounds"])
