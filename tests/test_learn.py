"""Invariants of the learning queries on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.plans import q_learn


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: E.queries()[name](spark, SF_SMALL).collect()


@pytest.fixture(scope="module")
def majority(spark):
    """Test error of always guessing the more frequent class."""
    te = q_learn.features(spark, SF_SMALL).where("split = 'test'")
    ones, n = te.selectExpr("sum(label)", "count(*)").first()
    return min(ones, n - ones) / n


def test_learning_curve(run):
    rows = sorted(run("gbt_learning_curve"))
    assert [r["round"] for r in rows] == list(range(1, 31))
    assert rows[-1].train_logloss < rows[0].train_logloss
    best = min(rows, key=lambda r: r.test_logloss)["round"]
    assert {r.best_round for r in rows} == {best}


def test_early_stop(run):
    (r,) = run("gbt_early_stop")
    assert 0 < r.rounds < r.max_rounds and 0 <= r.test_error <= 1


def test_margins_cover_the_test_rows(spark, run):
    rows = run("gbt_margin")
    assert len(rows) == q_learn.features(spark, SF_SMALL).where("split = 'test'").count()
    assert len({r.vec_id for r in rows}) == len(rows)


def test_importances_sum_to_one(run):
    rows = run("feature_importance")
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9 and min(r.importance for r in rows) >= 0


def test_cut_tree_equals_separate_fits(spark, run):
    from tessera.operators import learn

    rows = {r.depth: r for r in run("tree_depth_sweep")}
    assert sorted(rows) == list(range(1, 30))
    f = learn.with_features(q_learn.features(spark, SF_SMALL), "x", "vx").cache()
    for d in (1, 2, 4, 7, 10):
        m = q_learn._tree(d).fit(f.where("split = 'train'"))
        for split in ("train", "test"):
            assert learn.error_rate(m.transform(f.where(f"split = '{split}'")), "label10") == pytest.approx(rows[d][f"{split}_error"])
        assert rows[d].num_nodes == m.numNodes


def test_votes_equal_each_trees_own(spark):
    from pyspark.ml.functions import vector_to_array

    from tessera.operators import trees

    m, f = q_learn._forest(spark, SF_SMALL, 9, 4)
    test = f.where("split = 'test'")
    got = {r.vec_id: r for r in trees.forest_votes(test, m, "vx", ["vec_id"]).collect()}
    for t, tree in enumerate(m.trees):
        assert {r.vec_id: r.prediction for r in tree.transform(test).collect()} == {k: r.votes[t] for k, r in got.items()}
    for r in m.transform(test).select("vec_id", "prediction", vector_to_array("probability").alias("p")).collect():
        assert got[r.vec_id].probability == pytest.approx(r.p) and r.p[int(r.prediction)] == max(r.p)
    plan = trees.forest_votes(test, m, "vx", ["vec_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_staged_margins_equal_the_model(spark):
    from tessera.operators import learn, trees

    f = q_learn.features(spark, SF_SMALL)
    m = q_learn._gbt(max_iter=8).fit(f.where("split = 'train'"))
    test = f.where("split = 'test'")
    stages = trees.staged_margins(test, m, keep=["vec_id", "label"])
    own = {r.vec_id: r.margin for r in learn.gbt_margins(m, test, ["vec_id"]).collect()}
    assert {r.vec_id: pytest.approx(r.margins[-1]) for r in stages.collect()} == own
    curve = sorted(trees.staged_errors(stages).collect(), key=lambda r: r["round"])
    assert [r.logloss for r in curve] == pytest.approx([x / 2 for x in m.evaluateEachIteration(test)])
    assert curve[-1].error == pytest.approx(learn.error_rate(m.transform(test)))


def test_stability_curves(monkeypatch, spark, run):
    monkeypatch.setattr(q_learn, "SPLITS", 2)
    monkeypatch.setattr(q_learn, "ROUNDS", (2, 5))
    rows = run("margin_stability")
    assert {(r.seed, r.rounds) for r in rows} == {(s, n) for s in range(2) for n in (2, 5)}
    assert all(0 <= r.test_error <= 1 for r in rows)


def test_deeper_trees_fit_the_training_rows_better(run):
    rows = sorted(run("tree_depth_sweep"))
    assert rows[-1].train_error <= rows[0].train_error and rows[-1].num_nodes > rows[0].num_nodes
    assert all(0 <= r.test_error <= 1 for r in rows)


def test_depth_sweep_beats_or_meets_chance(run, majority):
    assert min(r.test_error for r in run("gbt_depth_sweep")) <= majority + 0.1


def test_saved_and_reloaded_pipeline_is_deterministic(run):
    assert run("pipeline_estimator") == run("pipeline_estimator")


def test_training_goes_on_where_a_saved_model_ended(spark, tmp_path):
    from pyspark.ml.classification import MultilayerPerceptronClassificationModel

    from tessera.operators import learn

    f = learn.with_features(q_learn.features(spark, SF_SMALL), "x", "vx").where("split = 'train'").cache()
    first = learn.mlp([64, 8, 10], 50, "vx", "label10").fit(f)
    first.write().save(f"{tmp_path}/m")
    again = learn.mlp([64, 8, 10], 50, "vx", "label10", start=MultilayerPerceptronClassificationModel.load(f"{tmp_path}/m")).fit(f)
    ended, went_on = first.summary().objectiveHistory, again.summary().objectiveHistory
    assert went_on[0] == pytest.approx(ended[-1]) and went_on[-1] < ended[-1] < ended[0]


def test_rate_trace(monkeypatch, run):
    monkeypatch.setattr(q_learn, "STEPS", 5)
    monkeypatch.setattr(q_learn, "SEGMENTS", 2)
    rows = {(r.rate, r.step): (r.train_error, r.test_error) for r in run("rate_sweep")}
    assert sorted(rows) == sorted((r, s) for r in q_learn.RATES for s in (0, 5, 10))
    assert len({rows[r, 0] for r in q_learn.RATES}) == 1
