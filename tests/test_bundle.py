"""The statistics bundle, principal sums, additive offsets and the small vector functions against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vec as V
from tessera.operators import bundle as B
from tessera.operators import decomp, effects, gram
from tessera.sources import io

D = 5


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    rows = []
    for k in range(600):
        v = rng.normal(size=D) * 10.0 ** rng.integers(-3, 4)
        v[rng.random(D) < 0.3] = np.nan
        rows.append(("hot" if k % 3 else "cold" if k % 2 else None, [None if np.isnan(x) else float(x) for x in v]))
    rows += [("gone", [None] * D), ("hot", None)]
    return rows


@pytest.fixture(scope="module")
def found(spark, data):
    return B.bundle(spark.createDataFrame(data, "g string, v array<double>").repartition(4), by=["g"])


def entries(data, g):
    return np.array([[np.nan if x is None else x for x in v] for k, v in data if k == g and v is not None], float)


@pytest.mark.parametrize("g", ["hot", "cold", None])
def test_all_parts_of_a_group(found, data, g):
    x = entries(data, g)
    here = lambda df: [r for r in df.collect() if r.g == g]
    (o,) = here(found.overall())
    flat = np.sort(x[~np.isnan(x)])
    assert (o.n_vectors, o.n) == (len(x), len(flat)) and np.isclose(o["mean"], flat.mean()) and np.isclose(o["std"], flat.std())
    assert {r.pos: r.NE for r in here(found.positions())} == dict(enumerate((~np.isnan(x)).sum(axis=0).tolist()))
    assert np.allclose([r.var for r in sorted(here(found.positions()), key=lambda r: r.pos)], np.nanvar(x, axis=0))
    assert {r.n_missing: r.n_vectors for r in here(found.missing())} == dict(zip(*(a.tolist() for a in np.unique(np.isnan(x).sum(axis=1), return_counts=True)), strict=True))
    (e,) = here(found.extremes((7, 100)))
    n = len(flat)
    assert (e.low7, e.high7, e.low100, e.high100) == (flat[n // 7], flat[n - n // 7], flat[n // 100], flat[n - n // 100])


def test_extremes_with_ties_and_one_value(spark):
    rows = [("a", [0.0, -0.0, 1.0])] * 50 + [("a", [0.0, 5.0, -5.0])] + [("b", [2.0, None, None])]
    got = {r.g: r for r in B.bundle(spark.createDataFrame(rows, "g string, v array<double>"), by=["g"]).extremes((100,)).collect()}
    assert (got["a"].low100, got["a"].high100) == (0.0, 5.0) and (got["b"].low100, got["b"].high100) == (2.0, 2.0)


def test_components_by_group(found, data):
    eig = found.pca(undefined=0.0).where("g = 'hot'").select("k", "eigval").distinct().collect()
    trace = np.nanvar(entries(data, "hot"), axis=0).sum()
    assert np.isclose(sum(r.eigval for r in eig), trace)


def test_state_is_handed_on_at_the_byte_limit(spark, data):
    """Many small states are added up to the same sums."""
    df = spark.createDataFrame(data, "g string, v array<double>").coalesce(1)
    whole = {tuple(r)[:4]: r.n for r in B.states(df, "v", ["g"]).collect()}
    assert whole == {tuple(r)[:4]: r.n for r in B.states(df, "v", ["g"], max_bytes=1).collect()}


def test_one_scan(spark, tmp_path, data):
    spark.createDataFrame(data, "g string, v array<double>").write.parquet(f"{tmp_path}/v")
    plan = B.states(spark.read.parquet(f"{tmp_path}/v"), "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_tables_can_be_saved(spark, found, tmp_path):
    io.save_stat_tables(*found.tables(), str(tmp_path))
    t = io.load_stat_tables(spark, str(tmp_path))
    assert set(t) == {"stat_scalar", "stat_vector", "stat_matrix"}
    assert t["stat_vector"].where("`group` = 'hot' AND name = 'NE'").count() == D


def test_undefined_covariance_raises(spark):
    rows = [([1.0, None],), ([2.0, None],), ([None, 3.0],)]
    cov = gram.covariance(spark.createDataFrame(rows, "v array<double>"))
    with pytest.raises(Exception, match="never defined together"):
        decomp.pca(cov).collect()
    assert len(decomp.pca(cov, undefined=0.0).collect()) == 4


@pytest.mark.parametrize("positions", [[0, 2, 3], [4, 1], [3]])
def test_principal_sums_equal_the_sums_of_cut_vectors(spark, data, positions):
    df = spark.createDataFrame([r for r in data if r[1]], "g string, v array<double>")
    cut = df.select(F.array(*[F.col("v")[p] for p in positions]).alias("v"))
    want = {(r.i, r.j): (r.s, r.n) for r in gram.gram_sums(cut).collect()}
    got = {(r.i, r.j): (r.s, r.n) for r in gram.principal_sums(gram.gram_sums(df), positions).collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_offsets_equal_removing_means_from_every_cell(spark):
    rng = np.random.default_rng(2)
    rows = [(int(r), int(c), float(v)) for r, c, v in zip(rng.integers(0, 12, 400), rng.zipf(1.5, 400) % 9, rng.normal(3, 2, 400), strict=True)]
    rows += [(1, 1, None)]
    got = {(r["round"], r["step"]): r.rms for r in effects.alternating_means(spark.createDataFrame(rows, "r int, c int, v double"), "r", "c", "v", 3).collect()}
    cells = np.array(rows[:-1])
    v = cells[:, 2].copy()
    want = {(0, "initial"): np.sqrt((v * v).mean())}
    for k in range(1, 4):
        for side, name in ((0, "minus_r"), (1, "minus_c")):
            for key in np.unique(cells[:, side]):
                v[cells[:, side] == key] -= v[cells[:, side] == key].mean()
            want[k, name] = np.sqrt((v * v).mean())
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)


def test_prefix_sums_and_scaling(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([0.0, -1.0, -2.0, None],)], "v array<double>")
    assert [r[0] for r in df.select(V.prefix_sums(F.col("v"), [1, 3, 4])).collect()] == [[1.0, 6.0, 10.0], [0.0, -3.0, None]]
    assert [r[0] for r in df.select(V.scale_to_max("v", 0.2)).collect()] == [pytest.approx([0.05, 0.1, 0.15, 0.2]), [None] * 4]
