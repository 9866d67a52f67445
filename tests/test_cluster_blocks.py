"""Large codebooks block by block, and the curve of centres, against plain NumPy and known dimensions."""

import numpy as np
import pytest

from tessera.operators import cluster


def frame(spark, x):
    return spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id bigint, x array<double>").repartition(4)


@pytest.mark.parametrize("entries", [4_000_000, 40, 1])
def test_blocks_equal_the_broadcast_path(spark, entries):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (300, 4))  # many ties
    c = rng.integers(0, 3, (25, 4)).astype(float)
    pts = frame(spark, x)
    book = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(c)], "cid bigint, c array<double>")
    want = {r.vec_id: (r.cluster, r.d2) for r in cluster.assign_nearest(pts, c, keep=["vec_id"]).collect()}
    got = {r.vec_id: (r.cluster, r.d2) for r in cluster.nearest_of(pts, book, block_entries=entries).collect()}
    assert got == want


def test_only_new_centres_are_needed(spark):
    rng = np.random.default_rng(2)
    pts = frame(spark, rng.random((100, 3)))
    book = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(rng.random((20, 3)))], "cid bigint, c array<double>")
    whole = {r.vec_id: (r.cluster, r.d2) for r in cluster.nearest_of(pts, book).collect()}
    half = cluster.nearest_of(cluster.nearest_of(pts, book.where("cid >= 10")), book.where("cid < 10"))
    assert {r.vec_id: (r.cluster, r.d2) for r in half.collect()} == whole
    none = cluster.nearest_of(pts, book.limit(0)).first()
    assert none.cluster is None and none.d2 == float("inf")


@pytest.mark.parametrize("dim", [1, 2])
def test_known_dimensions(spark, dim):
    rng = np.random.default_rng(3)
    x = np.zeros((4000, 5))
    x[:, :dim] = rng.random((4000, dim))
    x = x @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    curve = cluster.centre_curve(frame(spark, x), rounds=10)
    assert 0.07 * 4000 < curve[-1][0] < 0.13 * 4000
    assert [n for n, _ in curve] == sorted(n for n, _ in curve) and curve[-1][1] < curve[0][1]
    assert cluster.intrinsic_dimension(curve) == pytest.approx(dim, rel=0.25)


def test_no_points(spark):
    assert cluster.centre_curve(frame(spark, np.zeros((0, 2)))) == []
