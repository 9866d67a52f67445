"""Judging predictions and scores: top-k, confusion tables, ROC, threshold errors, bootstrap bands.

Everything that walks a sorted list of scores uses ``global_cumsum`` (range-partitioned running
sums) instead of a window with no partition key, and counts per distinct score first, so the
rows that reach the running sum are (distinct scores), already pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash60
from ..functions.vec import topk_desc
from .ordered import global_cumsum


def topk_classes(df: DataFrame, scores: str = "scores", k: int = 5) -> DataFrame:
    """Append top1 and ``topk`` (best first; ties -> lowest index)."""
    t = topk_desc(scores, k)
    return df.withColumn("topk", t).withColumn("top1", F.col("topk")[0])


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    wrong = (F.col(pred) != F.col(label)).cast("double")
    return df.agg(F.avg(wrong).alias("error"), (F.lit(1.0) - F.avg(wrong)).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def topk_accuracy(df: DataFrame, label: str, topk: str = "topk", k: int = 5) -> DataFrame:
    """For i = 1..k: share of rows whose label is among the first i predictions (cumulative)."""
    pos = F.array_position(F.col(topk), F.col(label))
    cols = [F.avg(((pos >= 1) & (pos <= i)).cast("double")).alias(f"a{i}") for i in range(1, k + 1)]
    a = df.agg(*cols)
    return a.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"a{i}").alias("accuracy")) for i in range(1, k + 1)])).alias("e")).select("e.i", "e.accuracy")


def dense_grid(spark: SparkSession, labels: Sequence[int], a: str, b: str) -> DataFrame:
    """All (a, b) label pairs, generated from ``range(k*k)`` (k = number of labels; no join)."""
    k = len(labels)
    lab = F.array(*[F.lit(int(x)) for x in labels])
    g = spark.range(k * k)
    return g.select(lab[(F.col("id") / k).cast("int")].alias(a), lab[(F.col("id") % k).cast("int")].alias(b))


#: The grid has the square of this many cells at most.
MAX_LABELS = 500


def confusion_matrix(df: DataFrame, true: str, pred: str, labels: Sequence[int] | None = None, max_labels: int = MAX_LABELS) -> DataFrame:
    """Counts per (true, pred), zeros filled on the k x k grid of ``labels``, by default all labels in
    the data (more than ``max_labels`` raise). With given labels: their sub-matrix."""
    if labels is None:
        found = df.select(F.explode(F.array(F.col(true), F.col(pred))).alias("l")).where("l is not null").distinct()
        labels = sorted(r["l"] for r in found.limit(max_labels + 1).collect())
        if len(labels) > max_labels:
            raise ValueError(f"more than {max_labels} labels")
    c = df.groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    grid = dense_grid(df.sparkSession, labels, "true_label", "pred_label")
    return grid.join(c, ["true_label", "pred_label"], "left").select("true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def second_choice_confusion(df: DataFrame, label: str, topk: str = "topk") -> DataFrame:
    """Cell (top1, true) + 1 for every row whose second choice is the true label."""
    s = df.where(F.col(topk)[1] == F.col(label))
    return s.groupBy(F.col(topk)[0].alias("top1"), F.col(label).alias("true_label")).agg(F.count(F.lit(1)).alias("n"))


def label_diagnostics(df: DataFrame, label: str, topk: str = "topk") -> DataFrame:
    """Four questions on the predictions; ties are all returned.

    pair       : most mutually confused pair a<b, count = C2[a,b] + C2[b,a] (second-choice table)
    diffuse    : label s with most rows where top1 != s and top2 = s
    never_top1 : labels present in the data that are never the top prediction
    most_missed: label with the most rows where top1 != label
    """
    c2 = second_choice_confusion(df, label, topk)
    sym = c2.select(F.least("top1", "true_label").alias("a"), F.greatest("top1", "true_label").alias("b"), "n").where(F.col("a") != F.col("b"))
    pairs = sym.groupBy("a", "b").agg(F.sum("n").alias("n"))
    best_pair = pairs.join(pairs.agg(F.max("n").alias("n")), "n").select(F.lit("pair").alias("question"), "a", F.col("b").cast("int").alias("b"), "n")

    diff = df.where((F.col(topk)[1] == F.col(label)) & (F.col(topk)[0] != F.col(label))).groupBy(F.col(label).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    best_diff = diff.join(diff.agg(F.max("n").alias("n")), "n").select(F.lit("diffuse").alias("question"), "a", F.lit(None).cast("int").alias("b"), "n")

    labels = df.select(F.col(label).alias("a")).distinct()
    top1 = df.select(F.col(topk)[0].alias("a")).distinct()
    never = labels.join(top1, "a", "left_anti").select(F.lit("never_top1").alias("question"), "a", F.lit(None).cast("int").alias("b"), F.lit(0).cast("long").alias("n"))

    missed = df.where(F.col(topk)[0] != F.col(label)).groupBy(F.col(label).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    best_missed = missed.join(missed.agg(F.max("n").alias("n")), "n").select(F.lit("most_missed").alias("question"), "a", F.lit(None).cast("int").alias("b"), "n")
    return best_pair.unionByName(best_diff).unionByName(never).unionByName(best_missed)


def _roc_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row for each distinct score, descending: its counts of both classes, the counts down to it, and all counts
    (one row, read from the ordered table's checkpoint, so scores are evaluated once)."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )
    cum = global_cumsum(per, [F.desc("threshold")], ["pos", "neg"])
    tot = cum.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    return cum.join(F.broadcast(tot))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC over every distinct score, descending: (threshold, fpr, tpr); all points kept, plus (0, 0).
    A rate without its class is NULL."""
    pts = _roc_steps(df, label, score).select(
        "threshold", F.try_divide("neg_cum", "_N").alias("fpr"), F.try_divide("pos_cum", "_P").alias("tpr")
    )
    lead = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return lead.unionByName(pts)


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the ROC of scored rows. Each distinct score adds its step in fpr times the mean tpr before and
    after it; both follow from its own and its running counts, so points need not be paired."""
    mean_tpr = F.try_divide(F.col("pos_cum") - F.col("pos") / 2, F.col("_P"))
    return _roc_steps(df, label, score).agg(F.sum(F.try_divide("neg", "_N") * mean_tpr).alias("auc"))


def roc_auc(roc: DataFrame) -> DataFrame:
    """Trapezoid area under given ROC points (pairs of consecutive points joined by rank)."""
    pts = roc.where(F.col("threshold").isNotNull())
    ranked = global_cumsum(pts.withColumn("_one", F.lit(1.0)), [F.desc("threshold")], ["_one"]).withColumnRenamed("_one_cum", "_r")
    prev = ranked.select((F.col("_r") + 1).alias("_r"), F.col("fpr").alias("_f0"), F.col("tpr").alias("_t0"))
    j = ranked.join(prev, "_r", "left").select(
        ((F.col("fpr") - F.coalesce("_f0", F.lit(0.0))) * (F.col("tpr") + F.coalesce("_t0", F.lit(0.0))) / 2).alias("_area")
    )
    return j.agg(F.sum("_area").alias("auc"))


def roc_thresholds(roc: DataFrame, hi_tpr: float = 0.95, lo_tpr: float = 0.6) -> DataFrame:
    """Lower cut: highest threshold with tpr > hi_tpr; upper cut: lowest threshold with tpr < lo_tpr;
    both also divided by the range of the thresholds."""
    pts = roc.where(F.col("threshold").isNotNull())
    return pts.agg(
        F.max(F.when(F.col("tpr") > hi_tpr, F.col("threshold"))).alias("thr_lower"),
        F.min(F.when(F.col("tpr") < lo_tpr, F.col("threshold"))).alias("thr_upper"),
        (F.max("threshold") - F.min("threshold")).alias("_range"),
    ).select(
        "thr_lower", "thr_upper",
        F.try_divide(F.col("thr_lower"), F.col("_range")).alias("thr_lower_norm"),
        F.try_divide(F.col("thr_upper"), F.col("_range")).alias("thr_upper_norm"),
    )


def threshold_errors(df: DataFrame, label: str, score: str, digits: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """For every distinct rounded score t (the thresholds): err1 = share of class 1 with score <= t,
    err0 = share of class 0 with score > t.

    Rows are counted by rounded score, those above their rounded score apart: scores <= t are all rows rounded to at
    most t but for those that t itself was rounded down to. So one running sum over the thresholds is enough, without
    a join. With ``by`` the running sums are windows in each group, bounded by its score range / 10^-digits. A missing
    score counts in its class's total and gives a NULL threshold that no score reaches.
    """
    by = list(by)
    s = df.select(*by, F.col(label).alias("_y"), F.col(score).cast("double").alias("_s")).withColumn("_t", F.bround("_s", digits))
    one, other = (F.col("_y") == 1).cast("double"), (F.col("_y") != 1).cast("double")
    known, above = F.col("_s").isNotNull(), F.col("_s") > F.col("_t")
    per = s.groupBy(*by, "_t").agg(
        F.sum(one).alias("_P"), F.sum(other).alias("_N"),
        F.sum(F.when(known, one).otherwise(0.0)).alias("p"), F.sum(F.when(known, other).otherwise(0.0)).alias("q"),
        F.sum(F.when(above, one).otherwise(0.0)).alias("_p_up"), F.sum(F.when(above, other).otherwise(0.0)).alias("_q_up"),
    )
    if by:
        group = Window.partitionBy(*by)
        run = group.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
        cum = per.select(
            *by, "_t", "_p_up", "_q_up", F.sum("p").over(run).alias("p_cum"), F.sum("q").over(run).alias("q_cum"),
            F.sum("_P").over(group).alias("_P"), F.sum("_N").over(group).alias("_N"),
        )
    else:
        cum = global_cumsum(per, [F.col("_t")], ["p", "q"])
        tot = cum.agg(F.sum("_P").alias("_P"), F.sum("_N").alias("_N"))  # one row, from the checkpoint
        cum = cum.drop("_P", "_N").join(F.broadcast(tot))
    return cum.select(
        *by, F.col("_t").alias("threshold"),
        F.try_divide(F.col("p_cum") - F.col("_p_up"), F.col("_P")).alias("err1"),
        (F.lit(1.0) - F.try_divide(F.col("q_cum") - F.col("_q_up"), F.col("_N"))).alias("err0"),
    )


def error_bins(errors: DataFrame, n_bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Per class and bin = min(floor(err * n), n-1): first and last threshold, over the threshold range.
    An empty bin gives no row."""
    by = list(by)
    rng = errors.groupBy(*by).agg((F.max("threshold") - F.min("threshold")).alias("_range"))
    long = errors.select(
        *by, "threshold", F.explode(F.array(F.struct(F.lit(1).alias("cls"), F.col("err1").alias("err")), F.struct(F.lit(0).alias("cls"), F.col("err0").alias("err")))).alias("e")
    ).select(*by, "threshold", "e.cls", "e.err")
    b = F.least(F.floor(F.col("err") * n_bins), F.lit(n_bins - 1)).cast("int")
    g = long.groupBy(*by, "cls", b.alias("bin")).agg(F.min("threshold").alias("t_min"), F.max("threshold").alias("t_max"))
    g = g.join(rng, by) if by else g.join(F.broadcast(rng))  # without groups: one row
    return g.select(*by, "cls", "bin", F.try_divide(F.col("t_min"), F.col("_range")).alias("lo"), F.try_divide(F.col("t_max"), F.col("_range")).alias("hi"))


def abstain_stats(df: DataFrame, label: str, score: str, lo: Column | float, hi: Column | float) -> DataFrame:
    """Accuracy with abstention between lo and hi (strict): overall, upper side, lower side, abstain rate."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    up = F.col(score) > hi_c
    down = F.col(score) < lo_c
    a = df.agg(
        F.sum((up & (F.col(label) == 1)).cast("double")).alias("_tp"),
        F.sum((down & (F.col(label) == 0)).cast("double")).alias("_tn"),
        F.sum(up.cast("double")).alias("_nu"),
        F.sum(down.cast("double")).alias("_nd"),
        F.count(F.lit(1)).alias("_n"),
    )
    return a.select(
        F.try_divide(F.col("_tp") + F.col("_tn"), F.col("_nu") + F.col("_nd")).alias("accuracy"),
        F.try_divide("_tp", "_nu").alias("accuracy_upper"),
        F.try_divide("_tn", "_nd").alias("accuracy_lower"),
        (F.lit(1.0) - (F.col("_nu") + F.col("_nd")) / F.col("_n")).alias("abstain"),
    )


def bootstrap_draws(spark: SparkSession, n_rows: int, replicates: int = 200, size: int = 500, seed: int = 0) -> DataFrame:
    """(rep, draw, idx): ``size`` row indices in [0, n_rows) per replicate, with replacement, from
    the shared 60-bit hash of the draw number (reproducible in SQL).  Generated on the executors from ``range``."""
    r = spark.range(replicates * size)
    idx = F.pmod(hash60("id", seed), F.lit(n_rows))
    return r.select((F.col("id") / size).cast("int").alias("rep"), (F.col("id") % size).cast("int").alias("draw"), idx.cast("long").alias("idx"))


def normalize_votes(counts: Column, guard: float = 1e-4) -> Column:
    from ..functions.vec import normalize_sum

    return normalize_sum(counts, guard)
