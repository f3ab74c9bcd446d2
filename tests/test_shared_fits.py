"""Fits of all folds from shared passes against one fit per fold, and their first-order conditions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.operators import features, nuisance, shared_fits
from decisionlake.operators.shared_fits import WHOLE, SharedFits
from decisionlake.spec import ACTIONS, DEFAULT
from tests.fixtures import frame, state
from tests.test_models_libraries import numpy_features

B = DEFAULT.indexed("b")


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(4)
    rows = [
        {"patient_id": f"p{i // 3:03d}", "time_step": i % 3, "split": "train", "observed_clinician_action": ACTIONS[int(rng.integers(3))],
         **state(map_mm_hg=60 + 20 * rng.random(), heart_rate=None if i % 9 == 4 else 70 + 30 * rng.random(), sex=[None, "F", "M"][i % 3],
                 lactate_mmol_l=None if rng.random() < 0.2 else 4 * rng.random()),
         "reward": float(rng.normal())}
        for i in range(240)]
    df = frame(spark, rows).withColumn("fold", (F.substring("patient_id", 2, 3).cast("int") % 3 + 1).cast("int"))
    return df.cache()


def test_ridge_of_every_fold_equals_normal_equations(folded):
    fits = SharedFits.fit(folded, [1, 2, 3], ridge={"ridge": 1.0}, row_bound=240)
    values = fits.predict(folded).toPandas()
    for side in (1, 2, 3):
        for i, action in enumerate(ACTIONS):
            train = folded.filter((F.col("fold") != side) & (F.col("observed_clinician_action") == action))
            x, y = numpy_features(train, None), train.toPandas()["reward"].to_numpy()
            xc, yc = x - x.mean(0), y - y.mean()
            w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
            own = fits.predict(train.withColumn("fold", F.lit(side))).toPandas()[f"ridge_{i}"].to_numpy()
            assert np.allclose(np.sort(own), np.sort(y.mean() + xc @ w), atol=1e-8)
    assert values[DEFAULT.indexed("ridge")].notna().all().all()


def test_behavior_of_every_fold_equals_a_single_fit(folded):
    fits = SharedFits.fit(folded, [WHOLE, 1, 2, 3], behavior={}, row_bound=240)
    assert fits.passes <= 10
    for side in (WHOLE, 2):
        train = folded.filter(F.col("fold") != side)
        single = SharedFits.fit(train.withColumn("fold", F.lit(9)), [WHOLE], behavior={}, row_bound=240)
        a = fits.predict(folded.withColumn("fold", F.lit(side))).select(*B).toPandas().to_numpy()
        b = single.predict(folded.withColumn("fold", F.lit(WHOLE))).select(*B).toPandas().to_numpy()
        assert np.abs(a - b).max() < 1e-8
        library = nuisance.BehaviorPolicyModel().fit(train.drop("fold"), row_bound=240).predict(folded.drop("fold")).select(*B).toPandas().to_numpy()
        assert np.abs(a - library).max() < 1e-4


def test_certificate_is_the_mean_in_the_data(folded):
    fits = SharedFits.fit(folded, [WHOLE, 2], behavior={"regularization_c": 0.5}, ridge={"ridge": 2.0}, row_bound=240)
    found = {(r.model, r.side, r.action, r.feature): r.moment for r in fits.certificate(folded).collect()}
    assert len(found) == 2 * 2 * 3 * len(fits.basis.names)
    for side in (WHOLE, 2):
        train = folded.filter(F.col("fold") != side)
        x, actions = numpy_features(train, None), train.toPandas()["observed_clinician_action"]
        for action in ACTIONS:
            assert abs(found["behavior", side, action, "1"] - (actions == action).mean()) < 1e-9
            part = train.filter(F.col("observed_clinician_action") == action)
            assert abs(found["ridge", side, action, "1"] - part.agg(F.avg("reward")).first()[0]) < 1e-9
            k = fits.basis.names.index("map_mm_hg") - 1
            assert abs(found["behavior", side, action, "map_mm_hg"] - (x[:, k] * (actions == action)).mean()) < 1e-8


def test_predictions_are_one_scan(folded, spark, tmp_path):
    folded.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    fits = SharedFits.fit(rows, [1, 2, 3], behavior={}, ridge={"ridge": 1.0}, row_bound=240)
    plan = fits.predict(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange hash" not in plan and "Python" not in plan


def test_wide_bases_are_fitted_one_by_one(folded, monkeypatch):
    train = folded.drop("fold").withColumn("next_6h_map_delta", F.lit(0.0))
    config = nuisance.CrossFitConfig(2, strategy="hash", rewards={"ridge": nuisance.RIDGE})
    shared = nuisance.cross_fit(train, config).orderBy("patient_id", "time_step").toPandas()
    monkeypatch.setattr(shared_fits, "MAX_BASIS", 3)
    assert SharedFits.fit(folded, [1], behavior={}) is None
    apart = nuisance.cross_fit(train, config).orderBy("patient_id", "time_step").toPandas()
    assert list(shared.columns) == list(apart.columns)
    assert np.allclose(shared[B], apart[B], atol=1e-4) and np.allclose(shared[DEFAULT.indexed("ridge")], apart[DEFAULT.indexed("ridge")], atol=1e-3)


def test_rows_that_cannot_be_fitted_are_refused(folded):
    with pytest.raises(ValueError, match="No rows of"):
        SharedFits.fit(folded.filter("observed_clinician_action <> 'iv_fluids'"), [1], ridge={"ridge": 1.0})
    with pytest.raises(ValueError, match="finite"):
        SharedFits.fit(folded.withColumn("map_mm_hg", F.lit(float("nan"))), [1], ridge={"ridge": 1.0})


def test_features_of_a_side_equal_a_fit_of_its_rows(folded):
    fits = SharedFits.fit(folded, [1, 2], ridge={"ridge": 1.0}, row_bound=240)
    train = folded.filter((F.col("fold") != 2) & (F.col("observed_clinician_action") == ACTIONS[1]))
    own, alone = fits.stats[2, 1].features(fits.basis), features.fit_features(train, row_bound=240)
    assert own.categorical == alone.categorical and [n for n, *_ in own.numeric] == [n for n, *_ in alone.numeric]
    assert [m for _, *m in own.numeric] == [pytest.approx(m, rel=1e-9) for _, *m in alone.numeric]
