"""Draws by the shared hash, complete results and errors for what used to be dropped."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import SPAN, hash60, hash60_sql, uniform
from tessera.operators import judge, sample, series, stats

N = 50_000


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(N).withColumnRenamed("id", "k").cache()


def test_hash_equals_sql_and_spans_its_range(keys):
    import duckdb

    got = {r.k: r.h for r in keys.where("k < 100").select("k", hash60("k", 3).alias("h")).collect()}
    want = dict(duckdb.sql(f"SELECT i, {hash60_sql('i', 3)} FROM range(100) t(i)").fetchall())
    assert got == want
    low, high = keys.select(F.min(hash60("k")), F.max(hash60("k"))).first()
    assert low < SPAN / 1000 and high > SPAN * 0.999
    mean = keys.select(F.avg(uniform("k", 9))).first()[0]
    assert abs(mean - 0.5) < 0.01


def test_seeds_are_independent(keys):
    a = sample.hash_split(keys, "k", {"train": 0.7, "test": 0.3}, seed=0).withColumnRenamed("split", "a")
    both = sample.hash_split(a, "k", {"train": 0.7, "test": 0.3}, seed=1)
    differ = both.where("a <> split").count() / N
    assert abs(differ - 0.42) < 0.01


def test_small_fractions_and_shuffles_cover_all_keys(keys):
    assert 1 <= sample.hash_sample(keys, "k", 0.0004).count() <= 60
    assert sample.hash_sample(keys, "k", 1.0).count() == N
    taken = [r.k for r in sample.shuffle_take(keys, "k", 200).collect()]
    assert min(taken) < N * 0.05 and max(taken) > N * 0.95


def test_bootstrap_draws_reach_all_rows(spark):
    d = judge.bootstrap_draws(spark, 10**12, 4, 500).agg(F.max("idx"), F.countDistinct("idx")).first()
    assert d[0] > 0.99 * 10**12 and d[1] == 2000


def test_a_position_out_of_range_is_an_error(spark):
    for pos in (12, -1, None):
        cells = spark.createDataFrame([("a", 3, 1.0), ("a", pos, 2.0)], "s string, pos int, v double")
        with pytest.raises(Exception, match="outside 0..11"):
            series.build_series(cells, ["s"], "pos", "v", 12).collect()


def test_histogram_has_all_bins(spark):
    h = stats.histogram(spark.createDataFrame([(0.0,), (10.0,)], "x double"), "x", bins=5).orderBy("bin").collect()
    assert [(r.bin, r.left, r.n) for r in h] == [(0, 0.0, 1), (1, 2.0, 0), (2, 4.0, 0), (3, 6.0, 0), (4, 8.0, 1)]
    inner = stats.histogram(spark.createDataFrame([(-5.0,), (1.0,), (99.0,)], "x double"), "x", bins=2, lo=0.0, hi=4.0).orderBy("bin").collect()
    assert [r.n for r in inner] == [1, 0]


def test_a_key_without_any_value_is_fully_missing(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, None)], "s string, t int, v double")
    got = {r.s: r.null_fraction for r in stats.null_fraction(df, "s", "t", "v", by="s").collect()}
    assert got == {"a": 0.5, "b": 1.0}


def test_confusion_takes_its_labels_from_the_data(spark):
    df = spark.createDataFrame([(0, 0), (12, 12), (12, 0)], "y int, p int")
    got = {(r.true_label, r.pred_label): r.n for r in judge.confusion_matrix(df, "y", "p").collect()}
    assert got == {(0, 0): 1, (0, 12): 0, (12, 0): 1, (12, 12): 1}
    with pytest.raises(ValueError):
        judge.confusion_matrix(df, "y", "p", max_labels=1)


def test_roc_of_one_class_and_of_nothing(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    rows = judge.roc_points(one, "y", "s").collect()
    assert len(rows) == 3 and rows[-1].fpr is None
    assert judge.roc_points(one.limit(0), "y", "s").count() == 1


def test_a_cluster_without_a_checkpoint_folder_is_told(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
