import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from decisionlake.operators import nuisance
from decisionlake.operators.leaf_values import penalised, rates, with_leaves


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        array_to_vector(F.array(F.rand(1), F.rand(2), F.floor(F.rand(3) * 4).cast("double"))).alias("features"), "id"
    )
    x = vector_to_array("features")
    return df.withColumn("label", F.sin(x[0] * 7) + x[1] * x[2] + F.randn(5) / 5).cache()


def grown(rows, trees=9):
    return GBTRegressor(maxIter=trees, stepSize=0.1, maxDepth=4, minInstancesPerNode=5, seed=3).fit(rows)


def by_stages(leaves, y, weights, l2):
    """The same values, tree after tree over all rows."""
    told, values = np.full(len(y), y.mean()), []
    for t, weight in enumerate(weights):
        own = leaves[:, t]
        v = {leaf: (y - told)[own == leaf].sum() / ((own == leaf).sum() + l2) for leaf in np.unique(own)}
        told = told + weight * np.array([v[leaf] for leaf in own])
        values.append(v)
    return values, told


@pytest.mark.parametrize("at_once", [1, 4, 25])
@pytest.mark.parametrize("l2", [1.0, 30.0])
def test_leaf_values_equal_stage_by_stage_fits(rows, l2, at_once):
    model = grown(rows)
    mine = penalised(model, rows, l2, at_once=at_once)
    table = with_leaves(model, rows, "leaves").orderBy("id").toPandas()
    values, told = by_stages(np.array(table["leaves"].tolist()), table["label"].to_numpy(), rates(model), l2)
    for own, plain in zip(mine.values, values):
        assert all(abs(own[leaf] - v) < 1e-9 for leaf, v in plain.items())
    found = mine.transform(rows).orderBy("id").toPandas()
    assert list(found.columns) == ["id", "label", "prediction"]
    assert np.allclose(found["prediction"], told, atol=1e-9)


def test_without_a_penalty_the_model_stays_as_it_was(rows):
    model = grown(rows)
    mine = penalised(model, rows, 0.0).transform(rows).orderBy("id").toPandas()["prediction"]
    own = model.transform(rows).orderBy("id").toPandas()["prediction"]
    assert np.allclose(mine, own, atol=1e-8)


def test_a_penalty_draws_values_to_the_mean(rows):
    model = grown(rows, 3)
    spread = [penalised(model, rows, l2).transform(rows).agg(F.stddev("prediction")).first()[0] for l2 in (0.0, 20.0, 1e6)]
    assert spread[0] > spread[1] > spread[2] and spread[2] < 0.01


def test_refused_input_and_trees_without_a_split(spark, rows):
    with pytest.raises(ValueError, match="non-negative"):
        penalised(grown(rows, 2), rows, -1.0)
    with pytest.raises(ValueError, match="training rows"):
        penalised(grown(rows, 2), rows.limit(0), 1.0)
    with pytest.raises(ValueError, match="l2_regularization"):
        nuisance.RewardModelConfig("hist_gradient_boosting", l2_regularization=-0.5)
    same = rows.withColumn("label", F.lit(2.5))
    found = penalised(grown(same, 2), same, 1.0).transform(same)
    assert {r[0] for r in found.select("prediction").distinct().collect()} == {2.5}


def test_one_scan_of_pairs_for_many_trees(rows):
    """More trees than are counted at once: every block starts from the residuals of those before."""
    model = grown(rows, 12)
    one, many = (penalised(model, rows, 2.0, at_once=n) for n in (5, 12))
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(one.values, many.values))


def test_boosted_rewards_round_trip_with_their_leaves(spark, tmp_path):
    from tests.fixtures import training

    train = training(spark)
    config = nuisance.RewardModelConfig("hist_gradient_boosting", max_iter=3, min_samples_leaf=2, l2_regularization=5.0)
    model = nuisance.ActionRewardModel(config).fit(train)
    base = model.predict_values(train, "v").select("patient_id", "time_step", "v_0", "v_1", "v_2")
    model.save(spark, str(tmp_path / "m"))
    again = nuisance.ActionRewardModel.load(spark, str(tmp_path / "m"))
    assert again.config == config
    assert base.exceptAll(again.predict_values(train, "v").select(base.columns)).isEmpty()
