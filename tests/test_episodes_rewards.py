import math

import pytest
from pyspark.sql import functions as F

from decisionlake.functions.reward import RewardSpec, compute_reward, require_finite_reward, with_reward
from decisionlake.operators import episodes, validate
from decisionlake.sources.trajectories import load_observation_columns, load_trajectories, nan_to_null, observations
from decisionlake.spec import ACTIONS, OBSERVATIONS, OUTCOMES, TrajectorySpec
from tests.fixtures import frame, outcomes, state


def one(spark, **changes):
    return frame(spark, [outcomes(**changes)]).select(compute_reward().alias("r")).first().r


@pytest.mark.parametrize("changes, expected", [
    ({}, 0.0),
    ({"next_6h_map_delta": 10.0}, 0.8),
    ({"next_6h_lactate_delta": 1.0}, -0.8),
    ({"next_6h_deterioration": 1}, -2.0),
    ({"adverse_hypotension_next_6h": 1}, -1.5),
    ({"adverse_fluid_overload_next_6h": 1}, -1.5),
    ({"adverse_tachyarrhythmia_next_6h": 1}, -1.5),
    ({"next_6h_map_delta": 1e3, "next_6h_lactate_delta": -1e3}, 1.6),
    ({"next_6h_map_delta": -1e3, "next_6h_lactate_delta": 1e3}, -1.6),
])
def test_reward(spark, changes, expected):
    assert math.isclose(one(spark, **changes), expected)


def test_missing_outcome_is_missing_reward_not_a_clipped_one(spark):
    df = frame(spark, [outcomes(next_6h_map_delta=None)])
    assert df.select(compute_reward().alias("r")).first().r is None
    with pytest.raises(ValueError):
        require_finite_reward(with_reward(df))


def test_supplied_reward_wins_and_bad_text_is_missing(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "reward string")
    assert [r.reward for r in with_reward(df).collect()] == [1.5, None]
    with pytest.raises(ValueError):
        with_reward(spark.createDataFrame([(1,)], "a int"))


def test_reward_function_can_be_injected(spark):
    df = frame(spark, [outcomes(next_6h_deterioration=1)])
    assert with_reward(df, RewardSpec(deterioration_penalty=5.0)).first().reward == -5.0
    assert with_reward(df, lambda d: F.lit(3.0)).first().reward == 3.0


def rows(spark):
    return frame(spark, [
        {"patient_id": p, "time_step": t, "terminal": end, "observed_clinician_action": a, **state(map_mm_hg=m), **outcomes()}
        for p, t, end, a, m in (("b", 0, 1, "maintain", 80.0), ("a", 3, 1, "iv_fluids", 62.0), ("a", 1, 0, "maintain", 60.0))
    ])


def test_transition_replay_orders_and_ends(spark):
    out = {(r.patient_id, r.time_step): r for r in episodes.logged_transitions(rows(spark), row_bound=3).collect()}
    first = out[("a", 1)]
    assert first.next_time_step == 3 and first.next_state.map_mm_hg == 62.0 and not first.done
    assert out[("a", 3)].next_state is None and out[("a", 3)].done
    assert set(first.state.asDict()) == set(OBSERVATIONS) and first.logged_transition


@pytest.mark.parametrize("change, said", [
    ({"time_step": 1}, "Duplicate transition"),
    ({"observed_clinician_action": "discharge"}, "Unknown logged action"),
    ({"terminal": 0}, "exactly one terminal"),
    ({"terminal": None}, "exactly one terminal"),
    ({"time_step": 0}, "exactly one terminal"),
])
@pytest.mark.parametrize("options", [{"row_bound": 3}, {"task_rows": 1}])
def test_replay_refuses_episodes_that_cannot_be(spark, change, said, options):
    broken = {"patient_id": "a", "time_step": 3, "terminal": 1, "observed_clinician_action": "iv_fluids", **state(), **outcomes(), **change}
    df = rows(spark).filter("NOT (patient_id = 'a' AND time_step = 3)").unionByName(frame(spark, [broken]).select(rows(spark).columns))
    with pytest.raises(Exception, match=said):
        episodes.logged_transitions(df, **options).collect()
    with pytest.raises(Exception, match=said):  # whatever columns are asked for
        episodes.logged_transitions(df, **options).groupBy("action").count().collect()
    assert episodes.logged_transitions(df, validated=True, **options).count() == 3


def test_replay_gate_takes_no_scan_of_its_own(spark, trajectories):
    plan = episodes.logged_transitions(trajectories, row_bound=10**6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "raise_error" in plan


def test_replay_never_carries_outcomes(spark):
    names = set(episodes.logged_transitions(rows(spark), row_bound=3).columns)
    assert not names & set(OUTCOMES)


def test_metadata_first_observation_and_unknown_patient(spark):
    df = rows(spark)
    meta = {r.patient_id: r for r in episodes.episode_metadata(df).collect()}
    assert meta["a"].episode_length == 2 and meta["a"].first_time_step == 1
    assert episodes.first_observations(df, "a").first().map_mm_hg == 60.0
    with pytest.raises(ValueError):
        episodes.first_observations(df, "zz")


def test_sampling_is_reproducible(spark, trajectories):
    pick = lambda seed: [r[0] for r in episodes.sample_episodes(trajectories.repartition(7), 5, seed).collect()]
    assert pick(1) == pick(1) and pick(1) != pick(2)


def test_sorted_episodes(spark):
    got = [tuple(r) for r in episodes.sort_episodes(rows(spark)).select("patient_id", "time_step").collect()]
    assert got == [("a", 1), ("a", 3), ("b", 0)]


@pytest.mark.parametrize("change, rule", [
    (lambda d: d.unionByName(d.limit(1)), "duplicate_key"),
    (lambda d: d.withColumn("observed_clinician_action", F.lit("other")), "unknown_action"),
    (lambda d: d.withColumn("terminal", F.lit(0)), "terminal_rule"),
    (lambda d: d.withColumn("terminal", F.lit(1)), "terminal_rule"),
    (lambda d: d.withColumn("terminal", F.when(F.col("time_step") == 1, 1).when(F.col("time_step") == 3, 0).otherwise(1)), "terminal_rule"),
    (lambda d: d.limit(0), "empty_table"),
    (lambda d: d.withColumn("patient_id", F.lit(None).cast("string")), "missing_patient"),
])
def test_gates_raise(spark, change, rule):
    validate.assert_trajectories(rows(spark))
    with pytest.raises(ValueError, match=rule):
        validate.assert_trajectories(change(rows(spark)))


def test_missing_columns_and_training_gate(spark):
    with pytest.raises(ValueError, match="age"):
        validate.assert_trajectories(rows(spark).drop("age"))
    df = rows(spark).withColumn("split", F.lit("train"))
    validate.assert_training(df)
    with pytest.raises(ValueError, match="these actions"):
        validate.assert_training(df, all_actions=True)
    with pytest.raises(ValueError, match="other splits"):
        validate.assert_training(df.withColumn("split", F.when(F.col("time_step") > 0, "train")))


def test_probability_tolerance(spark):
    df = spark.createDataFrame([(0.5, 0.3, 0.3), (0.6, 0.4, 1e-7), (0.2, 0.3, 0.5), (None, 0.5, 0.5), (1.2, -0.2, 0.0),
                                (float("nan"), 0.5, 0.5)], "x double, y double, z double")
    assert validate.probability_violations(df, ["x", "y", "z"], 1e-9).count() == 5
    assert validate.probability_violations(df, ["x", "y", "z"], 1e-6).count() == 4


def test_csv_missing_texts_and_nan(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("patient_id,time_step,map_mm_hg,lactate_mmol_l,handoff_note\n"
                "a,0,60.5,NA,hello\nb,1,NaN,,\nc,2,71,n/a,null\n")
    df = load_trajectories(spark, path)
    got = [tuple(r) for r in df.orderBy("time_step").collect()]
    assert got == [("a", 0, 60.5, None, "hello"), ("b", 1, None, None, None), ("c", 2, 71.0, None, None)]
    assert dict(df.dtypes)["time_step"] == "int" and dict(df.dtypes)["map_mm_hg"] == "double"
    assert nan_to_null(spark.createDataFrame([(float("nan"),)], "x double")).first().x is None


def test_observation_projection_has_no_post_action_columns(spark, trajectories):
    assert observations(trajectories).columns == list(OBSERVATIONS)
    with pytest.raises(ValueError):
        TrajectorySpec(observations=("a", "a"))
    with pytest.raises(ValueError):
        load_observation_columns([1])
    assert TrajectorySpec().actions == ACTIONS


def test_scan_is_pruned_and_partition_filtered(spark, trajectories):
    plan = with_reward(trajectories.filter("split = 'train'")).select("reward")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "heart_rate" not in plan
