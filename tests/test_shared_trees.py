import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.operators import nuisance, shared_trees
from decisionlake.plans import catalog, data
from decisionlake.spec import ACTIONS, DEFAULT
from tests.fixtures import frame, state

NONLINEAR = DEFAULT.indexed("nonlinear")


@pytest.fixture(scope="module")
def train(spark):
    """Few values a column, so that every cut between two of them is a candidate of Spark's trees as well."""
    draw = np.random.default_rng(4)
    return frame(spark, [
        {"patient_id": f"p{p:03d}", "time_step": i, "split": "train", "observed_clinician_action": ACTIONS[int(draw.integers(3))],
         **state(map_mm_hg=float(60 + draw.integers(9)), lactate_mmol_l=float(draw.integers(6)), age=int(50 + draw.integers(5)),
                 sex="FM"[int(draw.integers(2))], spo2=None if draw.random() < 0.2 else float(90 + 2 * draw.integers(4))),
         "reward": float(draw.normal())}
        for p in range(60) for i in range(8)
    ])


def config(trees, **options):
    return nuisance.RewardModelConfig("hist_gradient_boosting", max_iter=trees, learning_rate=0.3, min_samples_leaf=12, **options)


def cross_fit(train, trees, **options):
    rewards = {"ridge": nuisance.RIDGE, "nonlinear": config(trees, **options)}
    return nuisance.cross_fit(train, nuisance.CrossFitConfig(3, behavior=None, rewards=rewards))


def test_shared_trees_equal_models_fitted_one_by_one(train):
    rows = cross_fit(train, 4, l2_regularization=0.0).cache()
    model = nuisance.ActionRewardModel(config(4, l2_regularization=0.0)).fit(rows.filter("fold <> 1").select(*train.columns))
    again = model.predict_values(rows.filter("fold = 1"), "again").toPandas()
    assert np.allclose(again[NONLINEAR], again[DEFAULT.indexed("again")], atol=1e-9) and again[NONLINEAR].nunique().min() > 5


def test_values_do_not_depend_on_tasks_or_written_residuals(train, monkeypatch):
    def values():
        return cross_fit(train, 4).orderBy("patient_id", "time_step").select(*NONLINEAR).toPandas()

    whole = values()
    for name, value in (("LEAST_ROWS", 40), ("CHUNK_ROWS", 7), ("AT_ONCE", 3), ("FEW_TASKS", 2), ("WRITE_EVERY", 2)):
        monkeypatch.setattr(shared_trees, name, value)
    assert np.allclose(whole, values(), atol=1e-9)


def test_held_out_rewards_are_not_seen(train):
    before = cross_fit(train, 3).filter("fold = 1")
    held = before.select("patient_id", F.lit(9.0).alias("_more")).distinct()
    changed = train.join(held, "patient_id", "left").withColumn("reward", F.col("reward") + F.coalesce("_more", F.lit(0.0)))
    columns = ["patient_id", "time_step", *[F.round(c, 9).alias(c) for c in NONLINEAR]]
    after = cross_fit(changed.drop("_more"), 3).filter("fold = 1")
    assert before.select(*columns).exceptAll(after.select(*columns)).isEmpty()


def test_a_penalty_draws_values_to_the_mean_and_columns_of_many_values_are_cut_at_quantiles(train):
    wide = train.withColumn("heart_rate", F.expr("hash(patient_id, time_step) % 1000 / 7D"))
    spread = [cross_fit(wide, 2, l2_regularization=l2).agg(F.stddev("nonlinear_0")).first()[0] for l2 in (0.0, 50.0, 1e9)]
    assert spread[0] > spread[1] > spread[2] and np.isfinite(spread).all()
    assert len(shared_trees._places({float(v): 1 for v in range(60)})) == shared_trees.BINS - 1
    assert shared_trees._places({1.0: 3, 2.0: 1, 4.0: 9}).tolist() == [1.5, 3.0] and len(shared_trees._places({})) == 0


@pytest.mark.parametrize("name", ["cross_fit_estimates", "reward_model_comparison"])
def test_queries_fit_every_tree_of_the_model(spark, train, monkeypatch, name):
    """They take the boosted model as it is, not one of fewer trees."""
    asked = []
    monkeypatch.setattr(data, "trajectories", lambda *_: train)
    monkeypatch.setattr(data, "row_bound", lambda *_: 480)
    monkeypatch.setattr(nuisance.SharedTrees, "fit", lambda rows, folds, shared, c, **_: asked.append(c) or Unfitted())
    catalog.QUERIES[name](spark, "none").count()
    assert asked == [nuisance.RewardModelConfig("hist_gradient_boosting")] and asked[0].max_iter == 200


class Unfitted:
    def predict(self, df, stem):
        return df.withColumns({c: F.lit(0.0) for c in DEFAULT.indexed(stem)})
