"""Operators against NumPy / brute force on small fixtures (FIXTURES parts B and C)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import cluster, decomp, effects, gram, judge, ordered, stats
from tessera.plans import standins as S
from tessera.plans.q_cluster import hungarian_max


def test_covariance_rule_b10(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([2.0, None],), ([None, 1.0],), ([4.0, 5.0],)], "v array<double>")
    c = {(r["i"], r["j"]): r["cov"] for r in gram.covariance(df).collect()}
    assert c[(0, 1)] == pytest.approx(11 - (7 / 3) * (8 / 3))
    assert c[(1, 0)] == pytest.approx(c[(0, 1)])


def test_covariance_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 6))
    df = spark.createDataFrame([(list(map(float, r)),) for r in X], "v array<double>").repartition(4)
    c = gram.covariance(df).toPandas()
    M = np.zeros((6, 6))
    M[c["i"], c["j"]] = c["cov"]
    assert np.allclose(M, np.cov(X.T, bias=True), atol=1e-10)


def test_pca_rank_two_c1(spark):
    rng = np.random.default_rng(1)
    V = 2 * (rng.random((2, 10)) - 0.5)
    X = (2 * (rng.random((1000, 2)) - 0.5)) @ V
    df = spark.createDataFrame([(list(map(float, r)),) for r in X], "v array<double>").repartition(4)
    eig = decomp.pca(gram.covariance(df)).select("k", "eigval").distinct().orderBy("k").toPandas()
    lam = eig["eigval"].to_numpy()
    assert np.all(np.diff(lam) <= 1e-12)  # descending
    assert np.all(np.abs(lam[2:]) < 1e-10) and lam[1] > 1e-3


def test_pca_orthonormal_and_sign(spark):
    series = S.nation_year_series(spark, SF_SMALL)
    e = decomp.pca(gram.covariance(series)).toPandas()
    d = e["pos"].max() + 1
    U = np.zeros((d, d))
    U[e["k"], e["pos"]] = e["u"]
    assert np.allclose(U @ U.T, np.eye(d), atol=1e-9)
    for k in range(d):
        assert U[k, np.argmax(np.abs(U[k]))] > 0


def test_fourier_gram_b9(spark):
    g = decomp.basis_gram(decomp.fourier_basis(spark, 365)).toPandas()
    G = np.zeros((9, 9))
    G[g["k"], g["l"]] = g["g"]
    assert np.allclose(G, np.eye(9), atol=1e-9)
    assert np.allclose(decomp.fourier_rows(365) @ decomp.fourier_rows(365).T, np.eye(9), atol=1e-9)


def test_decompose_invariants(spark):
    series = S.nation_year_series(spark, SF_SMALL)
    U = decomp.fourier_rows(12)
    d = decomp.decompose(series, U, np.zeros(12), keep=["station", "yr"]).toPandas()
    res = d[["res_mean"] + [f"res_{i}" for i in range(1, 10)]].to_numpy()
    assert np.all(np.diff(res, axis=1) <= 1e-12)
    assert np.all(res >= -1e-12)
    # a complete orthonormal basis leaves nothing
    Q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(12, 12)))
    full = decomp.decompose(series, Q.T, None, keep=["station", "yr"]).toPandas()
    assert np.all(np.abs(full["res_12"]) < 1e-10)


def test_denoise_c5(spark):
    U = decomp.fourier_rows(365)
    rng = np.random.default_rng(3)
    f = 2 * U[1] - 4 * U[5] + 0.3 * rng.normal(size=365) * np.sqrt(1 / 365)
    df = spark.createDataFrame([(1, list(map(float, f)))], "id int, v array<double>")
    r = decomp.decompose(df, U, None, keep=["id"]).first()
    assert r["coeff_2"] == pytest.approx(2, abs=0.1)
    assert r["coeff_6"] == pytest.approx(-4, abs=0.1)


def test_cdf_b11(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 2.0)], "k int, v double")
    got = sorted((r["i"], r["value"], r["p"]) for r in stats.empirical_cdf(df, "v", "k").collect())
    assert got == [(0, 1.0, 0.0), (1, 1.0, 0.25), (2, 2.0, 0.5), (3, 3.0, 0.75)]


def test_global_rank_and_cumsum_match_window(spark):
    e = S.table(spark, SF_SMALL, "events", "event_id", "value")
    w = Window.orderBy("value", "event_id")
    want = e.select("event_id", F.row_number().over(w).alias("rn"), F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs")).toPandas()
    got_rn = ordered.global_row_number(e, [F.col("value"), F.col("event_id")], "rn").select("event_id", "rn").toPandas()
    got_cs = ordered.global_cumsum(e, [F.col("value"), F.col("event_id")], ["value"]).select("event_id", "value_cum").toPandas()
    m = want.merge(got_rn, on="event_id", suffixes=("", "_g")).merge(got_cs, on="event_id")
    assert (m["rn"] == m["rn_g"]).all()
    assert np.allclose(m["cs"], m["value_cum"])


def test_exact_quantiles_match_numpy(spark):
    e = S.table(spark, SF_SMALL, "events", "event_id", "event_type", "value")
    q = stats.exact_quantiles(e, "value", "event_id", [0.25, 0.5, 0.75], ["event_type"]).toPandas()
    pdf = e.toPandas()
    for _, r in q.iterrows():
        vals = pdf.loc[pdf.event_type == r["event_type"], "value"].to_numpy()
        assert r["value"] == pytest.approx(np.quantile(vals, r["q"]))


def test_missing_filter_c9(spark):
    def vec(n_missing):
        return [None] * n_missing + [1.0] * (365 - n_missing)

    df = spark.createDataFrame([(i, vec(m)) for i, m in enumerate([0, 50, 51, 365])], "id int, v array<double>")
    from tessera.functions.vec import n_missing, nanmean

    kept = df.where(n_missing("v") <= 50).count()
    assert kept == 2
    r = df.where(F.col("id") == 3).select(nanmean("v").alias("m")).first()
    assert r["m"] is None
    ps = stats.position_stats(df.where(F.col("id") == 3))
    assert ps.where(F.col("mean").isNotNull()).count() == 0


def test_threshold_errors_brute_force(spark):
    rng = np.random.default_rng(4)
    s = np.round(rng.normal(size=200), 3)
    y = (rng.random(200) < 0.5).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": s, "y": y}))
    got = judge.threshold_errors(df, "y", "score", 2).toPandas().sort_values("threshold")
    # thresholds: half-even rounding of each double's shortest decimal form (what ``bround`` does;
    # np.round multiplies first and can land on the other side of a tie)
    from decimal import ROUND_HALF_EVEN, Decimal

    th = sorted({float(Decimal(repr(float(v))).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)) + 0.0 for v in s})
    e1 = [1 - np.sum(s[y == 1] > t) / np.sum(y == 1) for t in th]
    e0 = [1 - np.sum(s[y == 0] <= t) / np.sum(y == 0) for t in th]
    assert np.allclose(got["threshold"], th)
    assert np.allclose(got["err1"], e1) and np.allclose(got["err0"], e0)


def test_roc_brute_force(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.normal(size=300), 2)
    y = (rng.random(300) < 0.4).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": s, "y": y}))
    r = judge.roc_points(df, "y", "score").where(F.col("threshold").isNotNull()).toPandas().sort_values("threshold", ascending=False)
    for _, row in r.iterrows():
        t = row["threshold"]
        assert row["tpr"] == pytest.approx(np.sum((s >= t) & (y == 1)) / np.sum(y == 1))
        assert row["fpr"] == pytest.approx(np.sum((s >= t) & (y == 0)) / np.sum(y == 0))
    auc = judge.roc_auc(judge.roc_points(df, "y", "score")).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc == pytest.approx(want)


def test_second_choice_confusion_b4_b5(spark):
    rows = [(3, [2, 3]), (2, [0, 3]), (3, [2, 3]), (1, [1, 2]), (0, [3, 0]), (2, [2, 0]), (2, [3, 2])]
    df = spark.createDataFrame(rows, "label int, topk array<int>")
    got = {(r["top1"], r["true_label"]): r["n"] for r in judge.second_choice_confusion(df, "label").collect()}
    assert got == {(2, 3): 2, (3, 0): 1, (3, 2): 1}
    one = spark.createDataFrame([(3, [2, 3])], "label int, topk array<int>")
    assert {(r["top1"], r["true_label"]): r["n"] for r in judge.second_choice_confusion(one, "label").collect()} == {(2, 3): 1}


def test_line_fit_b7(spark):
    x = [3.3, 4.4, 5.5, 6.71, 6.93, 4.168, 9.779, 6.182, 7.59, 2.167, 7.042, 10.791, 5.313, 7.997, 5.654, 9.27, 3.1]
    y = [1.7, 2.76, 2.09, 3.19, 1.694, 1.573, 3.366, 2.596, 2.53, 1.221, 2.827, 3.465, 1.65, 2.904, 2.42, 2.94, 1.3]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double")
    r = df.agg(F.regr_slope("y", "x").alias("a"), F.regr_intercept("y", "x").alias("b")).first()
    a, b = np.polyfit(x, y, 1)
    assert r["a"] == pytest.approx(a) and r["b"] == pytest.approx(b)


def test_nearest_centroid_and_lloyd_c2(spark):
    rng = np.random.default_rng(6)
    pts = np.vstack([rng.normal((2, 0), 0.25, (150, 2)), rng.normal((1, 0.5), 0.25, (50, 2)), rng.normal((-0.5, 0.5), 0.25, (50, 2))])
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(pts)], "vec_id int, x array<double>")
    C = pts[[0, 160, 220]]
    a = cluster.assign_nearest(df, C, keep=["vec_id"]).toPandas().sort_values("vec_id")
    d = ((pts[:, None, :] - C[None]) ** 2).sum(axis=2)
    assert (a["cluster"].to_numpy() == d.argmin(axis=1)).all()
    for _ in range(10):
        C, _ = cluster.lloyd_step(df, C)
    want = np.array([(2, 0), (1, 0.5), (-0.5, 0.5)])
    assert all(np.min(np.linalg.norm(C - w, axis=1)) < 0.3 for w in want)


def test_alternating_means_rms_never_rises(spark):
    e = S.table(spark, SF_SMALL, "events", "ts", "user_id", "value")
    du = e.groupBy(F.dayofmonth("ts").alias("day"), "user_id").agg(F.sum("value").alias("v"))
    r = effects.alternating_means(du, "day", "user_id", "v", rounds=3).toPandas().sort_values(["round", "step"], key=lambda c: c if c.name == "round" else c.map({"initial": 0, "minus_day": 1, "minus_user_id": 2}))
    assert np.all(np.diff(r["rms"].to_numpy()) <= 1e-9)


def test_hungarian_matches_brute_force():
    import itertools

    rng = np.random.default_rng(7)
    for k in (3, 6, 10):
        M = rng.integers(0, 50, size=(k, k)).astype(float)
        got = sum(M[i, j] for i, j in hungarian_max(M))
        if k <= 8:
            best = max(sum(M[i, p[i]] for i in range(k)) for p in itertools.permutations(range(k)))
            assert got == best
        assert sorted(j for _, j in hungarian_max(M)) == list(range(k))


def test_basis_over_defined_cells(spark):
    U = decomp.fourier_rows(12)
    months = [2, 3, 5, 11]
    at = {(r.k, r.pos): r.u for r in decomp.fourier_at(spark.createDataFrame([(m,) for m in months], "pos int"), 12).collect()}
    assert set(at) == {(k, m) for k in range(9) for m in months}
    assert all(abs(u - U[k, m]) < 1e-12 for (k, m), u in at.items())

    # "a" has all months twice, "b" a few once and a hole, "c" holes only
    cells = [("a", m, 1.0) for m in range(12)] * 2 + [("b", m, 2.0) for m in months] + [("b", 0, None), ("c", 1, None)]
    cells = spark.createDataFrame(cells, "station string, pos int, v double")
    got = {(r.station, r.k, r.l): r.g for r in decomp.defined_gram(cells, decomp.fourier_basis(spark, 12), ["station"]).collect()}
    assert {s for s, _, _ in got} == {"a", "b"} and len(got) == 2 * 81
    for k in range(9):
        for l in range(9):
            assert abs(got["a", k, l] - 2 * (k == l)) < 1e-12
            assert abs(got["b", k, l] - sum(U[k, m] * U[l, m] for m in months)) < 1e-12
