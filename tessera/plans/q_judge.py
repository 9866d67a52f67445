"""Judging queries on the nearest-mean score matrix.

Score matrix: scores[c] = -||x - mean(label c)||^2 for the 10 label means of ``embeddings``,
rounded to 9 decimals on both sides so ranks and ties agree across engines.  Binary task:
y = label % 2, score = mean odd-label score - mean even-label score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash60_sql
from ..functions import vec as V
from ..functions.rounding import rnd
from ..operators import cluster, judge, stats
from ..operators.ordered import global_row_number
from . import standins as S
from .registry import register
from .sqltext import VECS, rnd_sql

SCORES = f"""
{VECS},
means AS (SELECT label AS c, pos, avg(x) AS m FROM vlong GROUP BY 1, 2),
sc AS (SELECT v.vec_id, v.label, m.c, round_even(-sum((v.x - m.m) * (v.x - m.m)), 9) + 0.0 AS s
       FROM vlong v JOIN means m ON v.pos = m.pos GROUP BY 1, 2, 3),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) AS r FROM sc),
pred AS (SELECT vec_id, any_value(label) AS label, max(CASE WHEN r = 1 THEN c END) AS top1,
                list(c ORDER BY r) FILTER (WHERE r <= 5) AS topk FROM rk GROUP BY vec_id),
bin AS (SELECT vec_id, CAST(any_value(label) % 2 AS INTEGER) AS y,
               round_even(avg(CASE WHEN c % 2 = 1 THEN s END) - avg(CASE WHEN c % 2 = 0 THEN s END), 9) + 0.0 AS score
        FROM sc GROUP BY vec_id)
"""


def scored(spark, sf):
    """(vec_id, label, scores, topk, top1) -- codebook = label means (10 x 64, a bounded collect)."""
    x = S.vectors(spark, sf)
    _, C = cluster.codebook(cluster.group_means(x, "label"), "label")
    sc = cluster.score_matrix(x, C, keep=["vec_id", "label"])
    sc = sc.select("vec_id", "label", F.transform("scores", lambda s: F.bround(s, 9) + F.lit(0.0)).alias("scores"))
    return judge.topk_classes(sc, "scores", 5)


def binary(spark, sf):
    s = scored(spark, sf)
    odd = sum((F.col("scores")[i] for i in range(1, 10, 2)), F.lit(0.0)) / 5
    even = sum((F.col("scores")[i] for i in range(0, 10, 2)), F.lit(0.0)) / 5
    return s.select("vec_id", (F.col("label") % 2).cast("int").alias("y"), rnd(odd - even, 9).alias("score"))


@register("nearest_mean_scores", f"WITH {SCORES} SELECT vec_id, any_value(label) AS label, list(s ORDER BY c) AS scores FROM sc GROUP BY vec_id")
def nearest_mean_scores(spark, sf):
    return scored(spark, sf).select("vec_id", "label", "scores")


@register("topk_classes", f"WITH {SCORES} SELECT vec_id, label, CAST(top1 AS INTEGER) AS top1, CAST(topk AS INTEGER[]) AS topk FROM pred")
def topk_classes(spark, sf):
    return scored(spark, sf).select("vec_id", "label", "top1", "topk")


@register(
    "accuracy",
    f"WITH {SCORES} SELECT {rnd_sql('avg(CAST(top1 <> label AS DOUBLE))', 12)} AS error, "
    f"{rnd_sql('1 - avg(CAST(top1 <> label AS DOUBLE))', 12)} AS accuracy, count(*) AS n FROM pred",
)
def accuracy(spark, sf):
    a = judge.accuracy(scored(spark, sf), "label", "top1")
    return a.select(rnd("error", 12).alias("error"), rnd("accuracy", 12).alias("accuracy"), "n")


@register(
    "topk_accuracy",
    f"""WITH {SCORES}
SELECT CAST(i.range AS INTEGER) AS i,
       {rnd_sql('avg(CAST(coalesce(list_position(p.topk, p.label), 0) BETWEEN 1 AND i.range AS DOUBLE))', 12)} AS accuracy
FROM pred p, range(1, 6) i GROUP BY i.range""",
)
def topk_accuracy(spark, sf):
    a = judge.topk_accuracy(scored(spark, sf), "label", "topk", 5)
    return a.select("i", rnd("accuracy", 12).alias("accuracy"))


@register(
    "confusion_matrix",
    f"""WITH {SCORES},
labs AS (SELECT label AS l FROM pred UNION SELECT top1 FROM pred),
grid AS (SELECT CAST(a.l AS INTEGER) AS true_label, CAST(b.l AS INTEGER) AS pred_label FROM labs a, labs b)
SELECT g.true_label, g.pred_label, count(p.vec_id) AS n
FROM grid g LEFT JOIN pred p ON p.label = g.true_label AND p.top1 = g.pred_label GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    """Counts on the grid of all labels in the data."""
    return judge.confusion_matrix(scored(spark, sf), "label", "top1")


@register(
    "confusion_submatrix",
    f"WITH {SCORES} SELECT CAST(a.l AS INTEGER) AS true_label, CAST(b.l AS INTEGER) AS pred_label, count(p.vec_id) AS n "
    "FROM (VALUES (3), (5), (8)) a(l) CROSS JOIN (VALUES (3), (5), (8)) b(l) LEFT JOIN pred p ON p.label = a.l AND p.top1 = b.l GROUP BY 1, 2",
)
def confusion_submatrix(spark, sf):
    """A18 for chosen labels: their square of the confusion table."""
    return judge.confusion_matrix(scored(spark, sf), "label", "top1", (3, 5, 8))


@register(
    "confusion_second",
    f"WITH {SCORES} SELECT CAST(topk[1] AS INTEGER) AS top1, label AS true_label, count(*) AS n FROM pred WHERE topk[2] = label GROUP BY 1, 2",
)
def confusion_second(spark, sf):
    return judge.second_choice_confusion(scored(spark, sf), "label", "topk")


@register(
    "label_diagnostics",
    f"""WITH {SCORES},
c2 AS (SELECT topk[1] AS top1, label AS t, count(*) AS n FROM pred WHERE topk[2] = label GROUP BY 1, 2),
pairs AS (SELECT least(top1, t) AS a, greatest(top1, t) AS b, sum(n) AS n FROM c2 WHERE top1 <> t GROUP BY 1, 2),
diff AS (SELECT label AS a, count(*) AS n FROM pred WHERE topk[2] = label AND topk[1] <> label GROUP BY 1),
missed AS (SELECT label AS a, count(*) AS n FROM pred WHERE topk[1] <> label GROUP BY 1)
SELECT 'pair' AS question, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CAST(n AS BIGINT) AS n FROM pairs WHERE n = (SELECT max(n) FROM pairs)
UNION ALL SELECT 'diffuse', a, NULL, n FROM diff WHERE n = (SELECT max(n) FROM diff)
UNION ALL SELECT 'never_top1', l.label, NULL, 0 FROM (SELECT DISTINCT label FROM pred) l
          WHERE l.label NOT IN (SELECT DISTINCT top1 FROM pred)
UNION ALL SELECT 'most_missed', a, NULL, n FROM missed WHERE n = (SELECT max(n) FROM missed)""",
)
def label_diagnostics(spark, sf):
    return judge.label_diagnostics(scored(spark, sf), "label", "topk")


_ROC_SQL = f"""
{SCORES},
per AS (SELECT score AS threshold, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS neg
        FROM bin GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM per),
roc AS (SELECT threshold, sum(neg) OVER (ORDER BY threshold DESC) / (SELECT N FROM tot) AS fpr,
               sum(pos) OVER (ORDER BY threshold DESC) / (SELECT P FROM tot) AS tpr FROM per)
"""


@register(
    "roc_curve",
    f"WITH {_ROC_SQL} SELECT threshold, {rnd_sql('fpr', 12)} AS fpr, {rnd_sql('tpr', 12)} AS tpr FROM roc "
    "UNION ALL SELECT NULL, 0.0, 0.0",
)
def roc_curve(spark, sf):
    r = judge.roc_points(binary(spark, sf), "y", "score")
    return r.select("threshold", rnd("fpr", 12).alias("fpr"), rnd("tpr", 12).alias("tpr"))


@register(
    "roc_auc",
    f"""WITH {_ROC_SQL},
pts AS (SELECT fpr, tpr, lag(fpr, 1, 0) OVER (ORDER BY threshold DESC) AS f0, lag(tpr, 1, 0) OVER (ORDER BY threshold DESC) AS t0 FROM roc)
SELECT {rnd_sql('sum((fpr - f0) * (tpr + t0) / 2)', 9)} AS auc FROM pts""",
)
def roc_auc(spark, sf):
    return judge.auc(binary(spark, sf), "y", "score").select(rnd("auc", 9).alias("auc"))


@register(
    "roc_thresholds",
    f"""WITH {_ROC_SQL},
a AS (SELECT max(CASE WHEN tpr > 0.95 THEN threshold END) AS lo, min(CASE WHEN tpr < 0.6 THEN threshold END) AS hi,
             max(threshold) - min(threshold) AS r FROM roc)
SELECT lo AS thr_lower, hi AS thr_upper, {rnd_sql('lo / r', 9)} AS thr_lower_norm, {rnd_sql('hi / r', 9)} AS thr_upper_norm FROM a""",
)
def roc_thresholds(spark, sf):
    t = judge.roc_thresholds(judge.roc_points(binary(spark, sf), "y", "score"))
    return t.select("thr_lower", "thr_upper", rnd("thr_lower_norm", 9).alias("thr_lower_norm"), rnd("thr_upper_norm", 9).alias("thr_upper_norm"))


_THR_SQL = f"""
{SCORES},
th AS (SELECT DISTINCT round_even(score, 2) AS t FROM bin),
tot AS (SELECT sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS P, sum(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS N FROM bin),
te AS (SELECT th.t AS threshold,
              (SELECT count(*) FROM bin WHERE y = 1 AND score <= th.t) / (SELECT P FROM tot) AS err1,
              1 - (SELECT count(*) FROM bin WHERE y <> 1 AND score <= th.t) / (SELECT N FROM tot) AS err0
       FROM th)
"""


@register("threshold_errors", f"WITH {_THR_SQL} SELECT threshold, {rnd_sql('err1', 12)} AS err1, {rnd_sql('err0', 12)} AS err0 FROM te")
def threshold_errors(spark, sf):
    """Oracle uses the direct (thresholds x rows) definition; Spark uses bucketed running sums."""
    e = judge.threshold_errors(binary(spark, sf), "y", "score", 2)
    return e.select("threshold", rnd("err1", 12).alias("err1"), rnd("err0", 12).alias("err0"))


@register(
    "error_bins",
    f"""WITH {_THR_SQL},
r AS (SELECT max(threshold) - min(threshold) AS r FROM te),
lg AS (SELECT threshold, 1 AS cls, err1 AS err FROM te UNION ALL SELECT threshold, 0, err0 FROM te)
SELECT cls, CAST(least(floor(err * 20), 19) AS INTEGER) AS bin, {rnd_sql('min(threshold) / any_value(r.r)', 9)} AS lo,
       {rnd_sql('max(threshold) / any_value(r.r)', 9)} AS hi
FROM lg, r GROUP BY 1, 2""",
)
def error_bins(spark, sf):
    e = judge.threshold_errors(binary(spark, sf), "y", "score", 2)
    b = judge.error_bins(e, 20)
    return b.select("cls", "bin", rnd("lo", 9).alias("lo"), rnd("hi", 9).alias("hi"))


@register(
    "abstain_stats",
    f"""WITH {SCORES},
q AS (SELECT quantile_cont(score, 0.25) AS lo, quantile_cont(score, 0.75) AS hi FROM bin),
a AS (SELECT sum(CASE WHEN score > hi AND y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score < lo AND y = 0 THEN 1 ELSE 0 END) AS tn,
             sum(CASE WHEN score > hi THEN 1 ELSE 0 END) AS nu, sum(CASE WHEN score < lo THEN 1 ELSE 0 END) AS nd, count(*) AS n FROM bin, q)
SELECT {rnd_sql('(tp + tn) / (nu + nd)', 12)} AS accuracy, {rnd_sql('tp / nu', 12)} AS accuracy_upper,
       {rnd_sql('tn / nd', 12)} AS accuracy_lower, {rnd_sql('1 - (nu + nd) / n', 12)} AS abstain FROM a""",
)
def abstain_stats(spark, sf):
    """Abstain between the exact lower and upper quartile of the score."""
    b = binary(spark, sf)
    q = {r["q"]: r["value"] for r in stats.exact_quantiles(b, "score", "vec_id", [0.25, 0.75]).collect()}
    a = judge.abstain_stats(b, "y", "score", q[0.25], q[0.75])
    return a.select(*[rnd(c, 12).alias(c) for c in ("accuracy", "accuracy_upper", "accuracy_lower", "abstain")])


_BOOT_IDX = f"{hash60_sql('x')} % n"


@register(
    "bootstrap_counts",
    f"""WITH {SCORES},
rows_ AS (SELECT vec_id, y, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM bin),
n AS (SELECT count(*) AS n FROM rows_),
d AS (SELECT CAST(x // 500 AS INTEGER) AS rep, {_BOOT_IDX} AS idx FROM range(200 * 500) t(x), n)
SELECT d.rep, count(*) AS n_draws, count(DISTINCT d.idx) AS n_distinct, CAST(sum(r.y) AS BIGINT) AS n_pos
FROM d JOIN rows_ r ON r.idx = d.idx GROUP BY d.rep""",
)
def bootstrap_counts(spark, sf):
    """200 replicates x 500 draws with replacement, joined to dense row ids."""
    b = binary(spark, sf)
    ranked = global_row_number(b, [F.col("vec_id")], "rn").select((F.col("rn") - 1).alias("idx"), "y")
    n = b.count()
    d = judge.bootstrap_draws(spark, n, 200, 500)
    j = d.join(ranked, "idx")
    return j.groupBy("rep").agg(F.count(F.lit(1)).alias("n_draws"), F.countDistinct("idx").alias("n_distinct"), F.sum("y").cast("long").alias("n_pos"))


@register(
    "bootstrap_band",
    f"""WITH {SCORES},
rows_ AS (SELECT y, score, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM bin),
n AS (SELECT count(*) AS n FROM rows_),
d AS (SELECT CAST(x // 500 AS INTEGER) AS rep, {_BOOT_IDX} AS idx FROM range(200 * 500) t(x), n),
samp AS (SELECT d.rep, r.y, r.score FROM d JOIN rows_ r ON r.idx = d.idx),
th AS (SELECT DISTINCT rep, round_even(score, 2) AS t FROM samp),
tot AS (SELECT rep, count(*) FILTER (WHERE y = 1) AS P, count(*) FILTER (WHERE y <> 1) AS N FROM samp GROUP BY rep),
te AS (SELECT th.rep, th.t AS threshold, count(*) FILTER (WHERE s.y = 1 AND s.score <= th.t) / any_value(tot.P) AS err1,
              1 - count(*) FILTER (WHERE s.y <> 1 AND s.score <= th.t) / any_value(tot.N) AS err0
       FROM th JOIN samp s ON s.rep = th.rep JOIN tot ON tot.rep = th.rep GROUP BY th.rep, th.t),
width AS (SELECT rep, max(threshold) - min(threshold) AS r FROM te GROUP BY rep),
lg AS (SELECT rep, threshold, 1 AS cls, err1 AS err FROM te UNION ALL SELECT rep, threshold, 0, err0 FROM te),
bins AS (SELECT lg.rep, cls, CAST(least(floor(err * 20), 19) AS INTEGER) AS bin, min(threshold) / any_value(r) AS lo,
                max(threshold) / any_value(r) AS hi FROM lg JOIN width ON width.rep = lg.rep GROUP BY 1, 2, 3)
SELECT cls, bin, {rnd_sql('min(lo)', 9)} AS lo, {rnd_sql('max(hi)', 9)} AS hi, count(*) AS n_reps FROM bins GROUP BY 1, 2""",
)
def bootstrap_band(spark, sf):
    """Per replicate threshold errors -> error bins; band = min of lows, max of highs per bin. Only the ids are ranked;
    the drawn ones (at most replicates x size) meet their scores by id."""
    b = binary(spark, sf)
    ids = global_row_number(S.vectors(spark, sf).select("vec_id"), [F.col("vec_id")], "rn")
    d = judge.bootstrap_draws(spark, ids.count(), 200, 500).join(ids.select((F.col("rn") - 1).alias("idx"), "vec_id"), "idx")
    samp = d.select("rep", "vec_id").join(b, "vec_id").select("rep", "y", "score")
    e = judge.threshold_errors(samp, "y", "score", 2, by=["rep"])
    bins = judge.error_bins(e, 20, by=["rep"])
    band = bins.groupBy("cls", "bin").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n_reps"))
    return band.select("cls", "bin", rnd("lo", 9).alias("lo"), rnd("hi", 9).alias("hi"), "n_reps")


# ---------------------------------------------------------------- vote tables

_VOTE_LABELS = (3, 5, 8)
_SEG = 8


def votes(spark, sf):
    """(vec_id, label, preds): one vote in the array for each voter; voter j uses dims [8j, 8j+8) and picks the nearest of the label-3/5/8 means there."""
    x = S.vectors(spark, sf)
    m = cluster.group_means(x.where(F.col("label").isin(*_VOTE_LABELS)), "label")
    ids, C = cluster.codebook(m, "label")
    items = []
    for j in range(64 // _SEG):
        seg = F.slice("x", j * _SEG + 1, _SEG)
        d2 = [F.bround(V.sq_dist(seg, V.lit_vector(C[i, j * _SEG:(j + 1) * _SEG])), 9) for i in range(len(ids))]
        best = F.when((d2[0] <= d2[1]) & (d2[0] <= d2[2]), F.lit(int(ids[0]))).when(d2[1] <= d2[2], F.lit(int(ids[1]))).otherwise(F.lit(int(ids[2])))
        items.append(best)
    return x.select("vec_id", "label", F.array(*items).alias("preds"))


_VOTES_SQL = f"""
{VECS},
m AS (SELECT label AS c, pos, avg(x) AS m FROM vlong WHERE label IN (3, 5, 8) GROUP BY 1, 2),
d AS (SELECT v.vec_id, v.label, v.pos // 8 AS voter, m.c, round_even(sum((v.x - m.m) * (v.x - m.m)), 9) AS d2
      FROM vlong v JOIN m ON m.pos = v.pos GROUP BY 1, 2, 3, 4),
votes AS (SELECT vec_id, label, CAST(voter AS INTEGER) AS voter, c AS pred FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id, voter ORDER BY d2, c) AS r FROM d) WHERE r = 1),
vc AS (SELECT vec_id, any_value(label) AS label, count(*) FILTER (WHERE pred = 3) AS v3,
              count(*) FILTER (WHERE pred = 5) AS v5, count(*) FILTER (WHERE pred = 8) AS v8 FROM votes GROUP BY vec_id)
"""


def vote_counts_df(spark, sf):
    v = votes(spark, sf)  # counted inside the row: no shuffle
    count = lambda c: F.size(F.filter("preds", lambda p: p == c)).cast("long").alias(f"v{c}")
    return v.select("vec_id", "label", *[count(c) for c in _VOTE_LABELS])


@register("vote_counts", f"WITH {_VOTES_SQL} SELECT vec_id, label, v3, v5, v8 FROM vc")
def vote_counts(spark, sf):
    return vote_counts_df(spark, sf)


@register(
    "normalize_votes",
    f"WITH {_VOTES_SQL} SELECT vec_id, [{', '.join(rnd_sql(f'v{c} / (v3 + v5 + v8 + 1e-4)', 12) for c in _VOTE_LABELS)}] AS shares FROM vc",
)
def normalize_votes(spark, sf):
    c = vote_counts_df(spark, sf)
    shares = V.normalize_sum(F.array(*[F.col(f"v{c}").cast("double") for c in _VOTE_LABELS]))
    return c.select("vec_id", F.transform(shares, lambda x: F.bround(x, 12) + F.lit(0.0)).alias("shares"))


@register(
    "simplex_points",
    f"""WITH {_VOTES_SQL}, sh AS (SELECT vec_id, v3 / (v3 + v5 + v8 + 1e-4) AS p1, v5 / (v3 + v5 + v8 + 1e-4) AS p2, v8 / (v3 + v5 + v8 + 1e-4) AS p3 FROM vc)
SELECT vec_id, {rnd_sql('p2 * 1.0 + p3 * 0.5', 9)} AS x, {rnd_sql('p3 * 0.87', 9)} AS y FROM sh""",
)
def simplex_points(spark, sf):
    c = vote_counts_df(spark, sf)
    shares = V.normalize_sum(F.array(*[F.col(f"v{c}").cast("double") for c in _VOTE_LABELS]))
    p = c.select("vec_id", V.simplex_xy(shares).alias("p"))
    return p.select("vec_id", rnd("p.x", 9).alias("x"), rnd("p.y", 9).alias("y"))


@register(
    "plurality_strict",
    f"""WITH {_VOTES_SQL}
SELECT vec_id, CAST(CASE WHEN v3 > v5 AND v3 > v8 THEN 3 WHEN v5 > v3 AND v5 > v8 THEN 5 WHEN v8 > v3 AND v8 > v5 THEN 8 END AS INTEGER) AS plurality
FROM vc""",
)
def plurality_strict(spark, sf):
    """Strict plurality of three shares; ties give NULL."""
    c = vote_counts_df(spark, sf)
    p = (
        F.when((F.col("v3") > F.col("v5")) & (F.col("v3") > F.col("v8")), 3)
        .when((F.col("v5") > F.col("v3")) & (F.col("v5") > F.col("v8")), 5)
        .when((F.col("v8") > F.col("v3")) & (F.col("v8") > F.col("v5")), 8)
    )
    return c.select("vec_id", p.cast("int").alias("plurality"))


@register(
    "plurality_mistakes",
    f"""WITH {_VOTES_SQL}
SELECT vec_id, label, CAST(CASE WHEN v3 >= v5 AND v3 >= v8 THEN 3 WHEN v5 >= v8 THEN 5 ELSE 8 END AS INTEGER) AS plurality
FROM vc WHERE label IN (3, 5, 8) AND label <> CASE WHEN v3 >= v5 AND v3 >= v8 THEN 3 WHEN v5 >= v8 THEN 5 ELSE 8 END""",
)
def plurality_mistakes(spark, sf):
    """Hard-vote plurality (argmax, ties -> lowest label) among rows of the three labels; mistakes only."""
    c = vote_counts_df(spark, sf).where(F.col("label").isin(*_VOTE_LABELS))
    arr = F.array(*[F.col(f"v{c}") for c in _VOTE_LABELS])
    lab = F.array(*[F.lit(c) for c in _VOTE_LABELS])
    p = lab[V.argmax(arr)]
    return c.select("vec_id", "label", p.cast("int").alias("plurality")).where(F.col("plurality") != F.col("label"))


@register(
    "softmax_xent",
    f"""WITH {SCORES},
mx AS (SELECT vec_id, max(s) AS m FROM sc GROUP BY 1),
z AS (SELECT sc.vec_id, sum(exp(sc.s - mx.m)) AS z FROM sc JOIN mx ON mx.vec_id = sc.vec_id GROUP BY 1),
p AS (SELECT sc.vec_id, exp(sc.s - mx.m) / z.z AS p FROM sc JOIN mx ON mx.vec_id = sc.vec_id JOIN z ON z.vec_id = sc.vec_id WHERE sc.c = sc.label)
SELECT {rnd_sql('-avg(ln(p))', 9)} AS xent, count(*) AS n FROM p""",
)
def softmax_xent(spark, sf):
    """Softmax over the score vector; cross-entropy = -mean ln p[label] (natural log)."""
    s = scored(spark, sf).select("label", V.softmax("scores").alias("p"))
    return s.agg(rnd(-F.avg(F.log(F.element_at("p", F.col("label") + 1))), 9).alias("xent"), F.count(F.lit(1)).alias("n"))


@register(
    "affine_sigmoid",
    f"""WITH {VECS}
SELECT vec_id, {rnd_sql('1 / (1 + exp(-(sum(x * (CASE WHEN pos % 2 = 0 THEN 0.5 ELSE -0.25 END)) + 0.1)))', 12)} AS out
FROM vlong GROUP BY vec_id""",
)
def affine_sigmoid(spark, sf):
    """sigmoid(x . w + b) with fixed weights (w alternates 0.5, -0.25; b = 0.1)."""
    w = [0.5 if i % 2 == 0 else -0.25 for i in range(64)]
    x = S.vectors(spark, sf)
    return x.select("vec_id", rnd(V.sigmoid(V.dot("x", V.lit_vector(w)) + F.lit(0.1)), 12).alias("out"))
