"""Reports, case selection and prompts from one scan: equal to their sections, and planned as meant."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.functions.prompts import few_shot_messages
from decisionlake.operators import bias, explore, factual, metrics, policy, retrieval
from decisionlake.operators.factual import FactualRules
from decisionlake.spec import ACTIONS, DEFAULT, OBSERVATIONS
from tests.fixtures import frame, injected, state, training

B = ["b_0", "b_1", "b_2"]


def plan(df):
    """The physical plan; of a plan that has run its final form alone."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(df):
    return plan(df).count("FileScan parquet")


@pytest.fixture(scope="module")
def estimated(spark, tmp_path_factory):
    rows = injected(training(spark, 40)).withColumns({
        "fold": F.when(F.substring("patient_id", 2, 3).cast("int") < 3, None).otherwise(F.substring("patient_id", 4, 1).cast("int") % 3 + 1),
        "b_0": 0.2 + F.rand(1) / 2, "ridge_0": F.rand(2), "nonlinear_0": F.rand(3), "predicted": F.rand(4),
        "lactate_mmol_l": F.when(F.rand(5) > 0.2, F.rand(6) * 4),
        "vasopressor_active_pre_action": F.when(F.rand(7) > 0.1, (F.rand(8) * 2).cast("int")),
    }).withColumns({"b_1": (1 - F.col("b_0")) * 0.75, "b_2": (1 - F.col("b_0")) * 0.25})
    folder = str(tmp_path_factory.mktemp("estimates"))
    rows.write.parquet(folder, mode="overwrite")
    return spark.read.parquet(folder)


def values(df):
    out = {}
    for r in df.collect():
        key = tuple(r[d] for d in metrics.LONG[:6])
        assert key not in out
        out[key] = r["value"]
    return out


def same(got, want):
    got, want = values(got), values(want)
    assert set(got) == set(want)
    for key, v in want.items():
        assert (got[key] is None) == (v is None), key
        assert v is None or got[key] == pytest.approx(v, abs=1e-9), key


def test_behavior_report_equals_its_sections(estimated):
    df, fold = estimated.filter("fold IS NOT NULL"), F.coalesce(F.col("fold").cast("string"), F.lit("all"))
    ix = range(len(ACTIONS))
    long = lambda df, names, section, **d: metrics.to_long(df, names, section=section, model="m", **d)
    sections = [
        long(metrics.behavior_metrics(df, B, folds="fold"), ["rows", "log_loss", "multiclass_brier", "accuracy", "macro_f1"], "overall", fold=fold),
        long(metrics.top_label_ece(df, B, folds="fold"), ["top_label_ece"], "overall", fold=fold),
        long(metrics.fold_sizes(df), ["validation_rows", "validation_patients", "train_patients"], "folds", fold=F.col("fold")),
        long(metrics.action_rates(df, B), ["observed_rate", "mean_probability", "argmax_rate"], "action_rates", action=F.col("action")),
        long(metrics.one_vs_rest_ece(df, B), ["one_vs_rest_ece"], "per_action", action=F.col("action")),
        long(metrics.binary_brier(df, B), ["binary_brier"], "per_action", action=F.col("action")),
        long(metrics.logged_propensity(df, B, by_action=True), ["logged_count", "mean", "p05", "median"], "logged_propensity", action=F.col("action")),
        long(metrics.logged_propensity(df, B), ["min", "p01", "p05", "median", "mean"], "logged_propensity"),
        long(metrics.state_slice_behavior(df, B), ["rows", *[f"observed_{i}" for i in ix], *[f"predicted_{i}" for i in ix]], "low_pressure", slice=F.col("in_slice")),
    ]
    report = metrics.behavior_report(df, B, model="m", row_bound=200)
    same(report, metrics.union_long(sections))
    assert scans(report) <= 2 + 2  # two for means, bins and patients; two for quantiles
    empty = metrics.behavior_report(df.limit(0), B, row_bound=0).filter("value IS NOT NULL")
    assert empty.count() == 0


def test_reward_report_equals_its_sections(estimated):
    df, fold = estimated.filter("fold IS NOT NULL"), F.coalesce(F.col("fold").cast("string"), F.lit("all"))
    names = ["rows", "rmse", "mae", "r2", "actual_mean", "predicted_mean"]
    low = metrics.below("map_mm_hg", 65.0).alias("in_slice")
    long = lambda df, names, section, **d: metrics.to_long(df, names, section=section, model="m", **d)
    sections = [
        long(metrics.regression_metrics(df, "reward", "predicted", folds="fold"), names, "overall", fold=fold),
        long(metrics.regression_metrics(df, "reward", "predicted", [F.col("observed_clinician_action").alias("action")]), names, "per_action", action=F.col("action")),
        long(metrics.regression_metrics(df, "reward", "predicted", [low]), names, "low_pressure", slice=F.col("in_slice")),
        long(metrics.fold_sizes(df), ["validation_patients", "train_patients"], "folds", fold=F.col("fold")),
    ]
    report = metrics.reward_report(df, "predicted", model="m")
    same(report, metrics.union_long(sections))
    assert scans(report) == 2
    assert metrics.reward_report(df.limit(0), "predicted", model="m").count() == 0


def test_bias_report_equals_its_sections(estimated):
    df = estimated.filter("fold IS NOT NULL")
    ranked = bias.ranked_rows(df)
    model, action = F.col("model"), F.col("action")
    rates = [f"top_rate_{i}" for i in range(3)]
    maintain, sliced = bias.bias_maintain(ranked, 400), bias.bias_slices(ranked, 400)
    sections = [
        metrics.to_long(bias.bias_observed(df, 200), ["rows", "mean", "favorable_rate", "p10", "median", "p90"], section="observed_reward", action=action),
        metrics.to_long(bias.bias_global(ranked), ["top_action_rate", "mean_modeled_value"], section="global_rankings", model=model, action=action),
        metrics.to_long(bias.bias_propensity(ranked, 400), [*metrics.QUARTILE_NAMES, "below_support_rate"], section="top_action_propensity", model=model),
        metrics.to_long(bias.bias_agreement(df), ["rows", "top_action_agreement_rate", *[f"agreed_{r}" for r in rates]], section="model_agreement"),
        metrics.to_long(bias.bias_matrix(ranked), ["rows", *rates], section="logged_by_top", model=model, action=F.col("logged_action")),
        metrics.to_long(maintain, [c for c in maintain.columns if c != "model"], section="logged_first_action", model=model),
        metrics.to_long(sliced, [c for c in sliced.columns if c not in ("slice", "model")], section="state_slices", model=model, slice=F.col("slice")),
    ]
    same(bias.bias_report(df, row_bound=200), metrics.union_long(sections))
    assert scans(bias._bias_means(df, bias.MODELS, bias.DEFAULT)) == 1


def test_one_pass_groupings(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 4)], "g string, h string, v int")
    out = metrics.in_one_pass(df, [[], ["g"], ["g", "h"]], [F.sum("v").alias("s")])
    got = {(r["_set"], r["g"], r["h"]): r["s"] for r in out.collect()}
    assert got == {
        (0, None, None): 7, (1, "a", None): 3, (1, None, None): 4,
        (2, "a", "x"): 1, (2, "a", None): 2, (2, None, "x"): 4,
    }


def test_diverse_rows_in_one_scan(spark, tmp_path):
    rows = [
        {"patient_id": f"p{i:02d}", "time_step": 0, **state(
            map_mm_hg=None if i == 3 else 50.0 + i % 5, lactate_mmol_l=None if i in (7, 9, 11) else float(i % 4),
            vasopressor_active_pre_action=int(i in (0, 20)), iv_fluids_last_6h_ml=0.0)}
        for i in range(30)
    ]
    frame(spark, rows).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = explore.diverse_rows(df, 10)
    assert scans(out) == 1 and "WindowGroupLimit" in plan(out)
    picked = [(r["selection_reason"], r["patient_id"]) for r in out.orderBy("selection_order").collect()]
    assert picked == [
        ("lowest_map", "p00"), ("lowest_map", "p05"), ("map_near_65", "p04"), ("map_near_65", "p09"),
        ("highest_lactate", "p03"), ("highest_lactate", "p15"), ("missing_lactate", "p07"),
        ("vasopressor_active", "p20"), ("deterministic_fill", "p01"), ("deterministic_fill", "p02"),
    ]
    assert explore.diverse_rows(df.limit(0), 10).count() == 0


@pytest.fixture(scope="module")
def library(spark):
    return factual.factual_library(
        injected(training(spark, 30, lambda p, i: float(p))), FactualRules(max_examples_per_cell=5)).cache()


@pytest.mark.parametrize("n", [1, 2])
def test_few_shot_prompts_equal_those_of_joined_examples(spark, library, n):
    states = training(spark, 12).select("patient_id", "time_step", *OBSERVATIONS)
    got = policy.few_shot_requests(states, library, examples_per_cell=n, exclude="patient_id")
    found = retrieval.retrieve_examples(states, library, examples_per_cell=n, exclude="patient_id")
    want = few_shot_messages(states, found)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count() == 36


def test_few_shot_prompts_shuffle_no_states(spark, library, tmp_path):
    training(spark, 12).select("patient_id", "time_step", *OBSERVATIONS).write.parquet(str(tmp_path / "s"))
    states = spark.read.parquet(str(tmp_path / "s"))
    known = spark.createDataFrame(library.collect(), library.schema)
    shown = plan(policy.few_shot_requests(states, known, exclude="patient_id"))
    assert "SortMergeJoin" not in shown and "ShuffledHashJoin" not in shown
    assert shown.count("FileScan parquet") == 1 and shown.count("BroadcastHashJoin") == 6


def test_few_shot_prompts_keep_repeated_and_null_keys(spark, library):
    one = training(spark, 1).select("patient_id", "time_step", *OBSERVATIONS).limit(1)
    states = one.unionByName(one).unionByName(one.withColumn("patient_id", F.lit(None).cast("string")))
    built = policy.few_shot_requests(states, library, exclude="patient_id")
    texts = [r["messages"][1]["content"] for r in built.collect()]
    assert len(texts) == 3 and all(t.count('"observed_outcome_label"') == 6 for t in texts)
    assert policy.few_shot_requests(states.limit(0), library).count() == 0


def test_exclusion_that_empties_a_cell_fails_in_the_plan(spark, library):
    owner = library.first()["source_patient_id"]
    single = library.withColumn("source_patient_id", F.lit(owner))
    states = training(spark, 1).select("patient_id", "time_step", *OBSERVATIONS).withColumn("patient_id", F.lit(owner))
    ranked = retrieval.ranked_examples(states, single, exclude="patient_id")
    with pytest.raises(Exception, match="Not enough examples"):
        ranked.collect()
    with pytest.raises(ValueError):
        retrieval.ranked_examples(states, library, examples_per_cell=0)
    with pytest.raises(ValueError):
        retrieval.ranked_examples(states, library, examples_per_cell=6)


def plain_nearest(table, x, excluded, n):
    """Per cell the library ranks by distance, ties in library order, and those distances."""
    out = []
    for cell in dict.fromkeys(zip(table["action"], table["outcome_label"])):
        rows = [i for i in range(len(table["x"])) if (table["action"][i], table["outcome_label"][i]) == cell]
        for q, own in zip(x, excluded):
            far = [(float("inf") if table["patient"][i] == own else np.sqrt(sum((a - b) ** 2 for a, b in zip(q, table["x"][i]))), i) for i in rows]
            out += [(*cell, table["rank"][i], d) for d, i in sorted(far)[:n] if np.isfinite(d)]
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2])
def test_nearest_rows_are_taken_in_bounded_blocks(spark, n):
    r = np.random.default_rng(3)
    cells = [(a, label) for a in ACTIONS for label in factual.LABELS]
    size = 600
    table = {
        "action": [cells[i % 6][0] for i in range(size)], "outcome_label": [cells[i % 6][1] for i in range(size)],
        "rank": list(range(size)), "patient": [None if i % 50 == 0 else f"p{i % 40}" for i in range(size)],
        "x": r.integers(0, 3, (size, 4)).astype(float).tolist(),  # ties
    }
    known = spark.createDataFrame(
        list(zip(*table.values())), "action string, outcome_label string, library_rank bigint, source_patient_id string, _x array<double>")
    found = retrieval._Cells(known, DEFAULT)
    x, excluded = r.integers(0, 3, (2_000, 4)).astype(float), np.array([None if i % 30 == 0 else f"p{i % 60}" for i in range(2_000)], object)
    tracemalloc.start()
    got = list(found.nearest(x.reshape(-1), excluded, n))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20  # all distances at once are 9.6 MB
    some = [i for i in range(2_000) if i % 20 == 0]
    rows = [(a, label, rank[i], d[i]) for a, label, _, keep, rank, d in got for i in some if keep[i]]
    assert sorted(rows) == plain_nearest(table, x[some], excluded[some], n)
