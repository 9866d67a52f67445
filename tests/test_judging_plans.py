"""Judging with one running sum, slices of a ranking, centres as tables, and sinks, against plain definitions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster, judge, relational
from tessera.sources import io

SCORES = [0.004, 0.006, 0.005, 0.014, 0.016, 0.016, -0.004, -0.006, 1.0, None, 0.01, 0.01]
LABELS = [1, 0, 1, 1, 0, 1, 0, 1, 0, 1, 0, 1]


def scored(spark):
    rows = [(k % 2, LABELS[k % 12], SCORES[k % 12]) for k in range(36)]
    return spark.createDataFrame(rows, "g int, y int, s double"), rows


def errors_of(rows):
    """The definition: every rounded score against all rows."""
    out = {}
    for t in {None if s is None else round(s, 2) + 0.0 for _, _, s in rows}:
        low = [y for _, y, s in rows if t is not None and s is not None and s <= t]
        n1, n0 = sum(y == 1 for _, y, _ in rows), sum(y != 1 for _, y, _ in rows)
        out[t] = (sum(y == 1 for y in low) / n1, 1 - sum(y != 1 for y in low) / n0)
    return out


def same(got, want):
    assert set(got) == set(want)
    for t, pair in want.items():
        assert got[t] == pytest.approx(pair, abs=1e-12)


def test_threshold_errors_equal_the_definition(spark):
    df, rows = scored(spark)
    got = {None if r.threshold is None else r.threshold + 0.0: (r.err1, r.err0) for r in judge.threshold_errors(df, "y", "s").collect()}
    same(got, errors_of(rows))


def test_threshold_errors_by_group(spark):
    df, rows = scored(spark)
    out = judge.threshold_errors(df, "y", "s", by=["g"]).collect()
    for g in (0, 1):
        got = {None if r.threshold is None else r.threshold + 0.0: (r.err1, r.err0) for r in out if r.g == g}
        same(got, errors_of([r for r in rows if r[0] == g]))
    assert judge.threshold_errors(df.limit(0), "y", "s", by=["g"]).count() == 0


def test_area_is_the_share_of_ordered_pairs(spark):
    df, rows = scored(spark)
    df, rows = df.where("s is not null"), [r for r in rows if r[2] is not None]
    pos, neg = [s for _, y, s in rows if y == 1], [s for _, y, s in rows if y != 1]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert judge.auc(df, "y", "s").first()["auc"] == pytest.approx(want)
    assert judge.roc_auc(judge.roc_points(df, "y", "s")).first()["auc"] == pytest.approx(want)
    assert judge.auc(df.where("y = 1"), "y", "s").first()["auc"] is None


def test_error_bins_without_groups_and_of_nothing(spark):
    e = spark.createDataFrame([(0.0, 0.0, 1.0), (2.0, 1.0, 0.0)], "threshold double, err1 double, err0 double")
    got = {(r.cls, r.bin): (r.lo, r.hi) for r in judge.error_bins(e, 4).collect()}
    assert got == {(1, 0): (0.0, 0.0), (1, 3): (1.0, 1.0), (0, 3): (0.0, 0.0), (0, 0): (1.0, 1.0)}
    assert judge.error_bins(e.limit(0), 4).count() == 0


@pytest.mark.parametrize("top", [100_000, 3])
def test_slices_by_top_k_and_by_full_ranking(spark, monkeypatch, top):
    monkeypatch.setattr(relational, "MAX_TOP", top)
    df = spark.range(50).select("id", (F.col("id") % 5).alias("v")).repartition(7)
    got = relational.ranked_slices(df, [F.desc("v"), F.col("id")], [(1, 2), (11, 12), (50, 60)])
    order = sorted(range(50), key=lambda k: (-(k % 5), k))
    assert {(r.rn, r.id) for r in got.collect()} == {(r, order[r - 1]) for r in (1, 2, 11, 12, 50)}


def test_a_centre_without_points_stays(spark):
    x = np.array([[0.0, 0.0], [0.0, 2.0], [9.0, 9.0]])
    pts = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "vec_id bigint, x array<double>")
    c = np.array([[0.0, 1.0], [8.0, 8.0], [99.0, 99.0]])
    got = {(r.cid, r.pos): r.centre for r in cluster.moved_centres(pts, c).collect()}
    assert got == {(0, 0): 0.0, (0, 1): 1.0, (1, 0): 9.0, (1, 1): 9.0, (2, 0): 99.0, (2, 1): 99.0}
    assert np.array_equal(cluster.lloyd(pts, c, 3), [[0, 1], [9, 9], [99, 99]])


def test_matched_centres(spark):
    found = spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.0), (1, 0, 5.0), (1, 1, 0.0)], "cid int, pos int, centre double")
    true = spark.createDataFrame([(7, 0, 1.0), (7, 1, 0.0), (8, 0, 9.0), (8, 1, 0.0)], "label int, pos int, mean double")
    got = {r.cid: (r.label, r.distance) for r in cluster.matched_centres(found, true).collect()}
    assert got == {0: (7, 1.0), 1: (7, 4.0)}  # 1 is as far from both labels
    assert cluster.matched_centres(found, true.limit(0)).count() == 0


def test_missing_vectors_are_far_from_nothing(spark):
    pts = spark.createDataFrame([(0, [1.0, 2.0]), (1, None)], "vec_id bigint, x array<double>")
    rows = {r.vec_id: r.d2 for r in cluster.assign_nearest(pts, np.zeros((1, 2)), keep=["vec_id"]).collect()}
    assert rows[0] == 5.0
    assert rows[1] is None or math.isnan(rows[1])


def test_sink_brings_a_key_together(spark, tmp_path):
    import glob

    df = spark.range(0, 2000, 1, 8).select((F.col("id") % 3).alias("k"), "id")
    io.write_table(df, str(tmp_path / "t"), ["k"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2000
    assert len(glob.glob(f"{tmp_path}/t/k=0/*.parquet")) < 8


def test_load_of_a_partial_bundle_needs_no_local_path(spark, tmp_path):
    one = io.scalars_table(spark, "g", {"a": 1.0})
    io.save_stat_tables(one, None, None, f"file:{tmp_path}/b")
    assert set(io.load_stat_tables(spark, f"file:{tmp_path}/b")) == {"stat_scalar"}
    assert io.load_stat_tables(spark, f"file:{tmp_path}/none") == {}
