import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.functions.vectors import argmax, pick
from decisionlake.operators import bias, contrastive, evaluate, explore, factual, metrics, nuisance, policy, retrieval
from decisionlake.operators.contrastive import ContrastiveRules
from decisionlake.operators.factual import FactualRules
from decisionlake.operators.features import fit_features, transform
from decisionlake.operators.folds import hash_fold, patient_folds, with_folds
from decisionlake.sources import sinks
from decisionlake.spec import ACTIONS, CATEGORICAL, DEFAULT, OBSERVATIONS, OUTCOMES
from tests.fixtures import frame, injected, state, training

B, RIDGE, NONLINEAR = (DEFAULT.indexed(s) for s in ("b", "ridge", "nonlinear"))


@pytest.fixture(scope="module")
def train(spark):
    return training(spark).cache()


def numpy_features(df, columns):
    """Impute, scale and one-hot by hand."""
    pdf = df.toPandas()
    out = []
    for c in DEFAULT.numeric:
        x = pdf[c].astype(float).to_numpy()
        x = np.where(np.isnan(x), np.nanmedian(x), x)
        sd = x.std()
        out.append((x - x.mean()) / (sd if sd else 1.0))
    for c in CATEGORICAL:
        for level in sorted(set(pdf[c].dropna())):
            out.append((pdf[c].fillna(pdf[c].mode()[0]) == level).astype(float).to_numpy())
    return np.array(out).T


def test_features_match_numpy(spark, train):
    df = train.withColumn("lactate_mmol_l", F.when(F.col("time_step") != 1, F.col("lactate_mmol_l"))).withColumn(
        "sex", F.when(F.col("heart_rate") > 84, "M").when(F.col("heart_rate") > 82, "F"))
    stats = fit_features(df)
    got = np.array(transform(df, stats).toPandas(), dtype=float)
    assert np.allclose(got, numpy_features(df, stats.names), atol=1e-12)
    unseen = transform(df.limit(1).withColumn("sex", F.lit("X")), stats).toPandas()
    assert unseen[["sex=F", "sex=M"]].to_numpy().sum() == 0
    assert "wbc_k_ul" not in fit_features(df.withColumn("wbc_k_ul", F.lit(None).cast("double"))).names


def softmax_fit(x, y, c=1.0):
    """Multinomial logistic by Newton-free gradient descent on the summed loss."""
    n, d = x.shape
    design, target = np.hstack([x, np.ones((n, 1))]), np.eye(3)[y]
    w = np.zeros((d + 1, 3))
    penalty = np.ones((d + 1, 1)) / c
    penalty[-1] = 0
    step = 1.0 / (np.linalg.norm(design, 2) ** 2 / 2 + 1 / c)
    velocity, last = w.copy(), w.copy()
    for i in range(20_000):
        z = design @ velocity
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w = velocity - step * (design.T @ (p - target) + penalty * velocity)
        velocity = w + i / (i + 3) * (w - last)
        last = w
    z = design @ w
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def noisy(spark, n=40):
    rng = np.random.default_rng(1)
    return frame(spark, [
        {"patient_id": f"p{i // 3:03d}", "time_step": i % 3, "split": "train",
         "observed_clinician_action": ACTIONS[int(rng.integers(3)) if i >= 3 else i],
         **state(map_mm_hg=60 + 20 * rng.random(), heart_rate=70 + 30 * rng.random(), sex="FM"[i % 2]),
         "reward": float(rng.normal())}
        for i in range(3 * n)])


def test_behavior_model_matches_closed_form(spark):
    df = noisy(spark).cache()
    got = nuisance.BehaviorPolicyModel().fit(df).predict(df).select(*B, "observed_clinician_action").toPandas()
    y = np.array([ACTIONS.index(a) for a in got["observed_clinician_action"]])
    assert np.allclose(got[B].to_numpy(), softmax_fit(numpy_features(df, None), y), atol=1e-4)
    assert np.allclose(got[B].sum(axis=1), 1.0, atol=1e-9)


def test_ridge_matches_closed_form_per_action(spark):
    df = noisy(spark).cache()
    values = nuisance.ActionRewardModel().fit(df).predict_values(df, "ridge").toPandas()
    for i, a in enumerate(ACTIONS):
        part = df.filter(F.col("observed_clinician_action") == a)
        x, y = numpy_features(part, None), part.toPandas()["reward"].to_numpy()
        # the intercept is not penalised
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
        fitted = y.mean() + xc @ w
        mine = values[values["observed_clinician_action"] == a][f"ridge_{i}"].to_numpy()
        assert np.allclose(np.sort(mine), np.sort(fitted), atol=2e-4)


def test_models_refuse_bad_input_and_unfitted_use(spark, train):
    with pytest.raises(RuntimeError):
        nuisance.BehaviorPolicyModel().predict(train)
    with pytest.raises(RuntimeError):
        nuisance.ActionRewardModel().predict_values(train)
    with pytest.raises(ValueError, match="other splits"):
        nuisance.BehaviorPolicyModel().fit(train.withColumn("split", F.lit("test")))
    with pytest.raises(ValueError, match="these actions"):
        nuisance.ActionRewardModel().fit(train.filter(F.col("observed_clinician_action") != "iv_fluids"))
    for bad in (dict(model_type="x"), dict(alpha=-1), dict(max_iter=0), dict(min_samples_leaf=0)):
        with pytest.raises(ValueError):
            nuisance.RewardModelConfig(**bad)


def test_models_ignore_post_action_columns_and_round_trip(spark, train, tmp_path):
    model = nuisance.ActionRewardModel().fit(train)
    base = model.predict_logged_values(train).select("patient_id", "time_step", "predicted")
    changed = model.predict_logged_values(train.withColumn("reward", F.lit(9.0)).withColumn("terminal", F.lit(1)))
    assert base.exceptAll(changed.select(base.columns)).isEmpty()
    model.save(spark, str(tmp_path / "m"))
    again = nuisance.ActionRewardModel.load(spark, str(tmp_path / "m")).predict_logged_values(train)
    assert base.exceptAll(again.select(base.columns)).isEmpty()


def test_cross_fit_holds_out_patients(spark, train):
    config = nuisance.CrossFitConfig(3, rewards={
        "ridge": nuisance.RIDGE,
        "nonlinear": nuisance.RewardModelConfig("hist_gradient_boosting", max_iter=2, min_samples_leaf=2)})
    rows = nuisance.cross_fit(train, config).cache()
    assert rows.count() == 36 and rows.select("patient_id", "fold").distinct().count() == 12
    assert {r[0] for r in rows.select("fold").distinct().collect()} == {1, 2, 3}
    held = rows.filter("fold = 1")
    stats = nuisance.BehaviorPolicyModel().fit(rows.filter("fold <> 1").select(*train.columns)).predict(
        held.select(*train.columns), "again")
    joined = stats.join(held, ["patient_id", "time_step"]).toPandas()
    assert np.allclose(joined[B].to_numpy(), joined[["again_0", "again_1", "again_2"]].to_numpy(), atol=1e-6)


def test_reward_comparison_has_every_cell(spark, train):
    models = {"ridge": nuisance.RIDGE, "strong": nuisance.RewardModelConfig(alpha=100.0)}
    deltas = nuisance.compare_reward_models(train, models, n_splits=2)[1].collect()
    assert len(deltas) == (1 + 3 + 1) * 3
    with pytest.raises(ValueError):
        nuisance.compare_reward_models(train, {"ridge": nuisance.RIDGE})
    with pytest.raises(ValueError):
        nuisance.compare_reward_models(train, models, baseline="x")


def test_folds_are_disjoint_balanced_and_seeded(spark, train):
    f = {r.patient_id: r.fold for r in patient_folds(train, 5).collect()}
    sizes = np.bincount(list(f.values()), minlength=6)[1:]
    assert len(f) == 12 and sizes.max() - sizes.min() <= 1
    assert f == {r.patient_id: r.fold for r in patient_folds(train.repartition(5), 5).collect()}
    assert f != {r.patient_id: r.fold for r in patient_folds(train, 5, seed=1).collect()}
    assert train.select(hash_fold(4).alias("f")).filter("f NOT BETWEEN 1 AND 4").isEmpty()
    for n in (1, 13):
        with pytest.raises(ValueError):
            with_folds(train, n)


def test_support_limit_is_inclusive(spark):
    df = spark.createDataFrame([(0.97, 0.02, 0.01), (0.8, 0.1, 0.1)], "b_0 double, b_1 double, b_2 double")
    mask = [m.alias(f"m{i}") for i, m in enumerate(nuisance.support_mask(B))]
    assert [tuple(r) for r in df.select(*mask).collect()] == [(True, True, False), (True, True, True)]
    values = nuisance.supported_values(df.withColumns({f"v_{i}": F.lit(1.0) for i in range(3)}), ["v_0", "v_1", "v_2"], B)
    assert values.first().v_2 is None


def test_argmax_first_wins(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, 2.0, 2.0), (None, 1.0, 0.0), (None, None, None)], "a double, b double, c double")
    assert [r.i for r in df.select(argmax(["a", "b", "c"]).alias("i")).collect()] == [0, 1, 1, None]
    assert df.select(pick(["a", "b", "c"], F.lit(1)).alias("x")).first().x == 1.0


ANY = dict(require_preferred_matches_logged=False, minimum_logged_reward=None)


def test_contrastive_fixture(spark, train):
    rules = ContrastiveRules(max_examples_per_action=5, **ANY)
    df = injected(train)
    out = contrastive.build_contrastive_examples(df, rules).collect()
    assert len(out) == 5
    assert {(r.preferred_action, r.near_negative_action) for r in out} == {("escalate_vasopressor", "iv_fluids")}
    funnel = contrastive.contrastive_funnel(contrastive.contrastive_stages(df, rules)).first()
    assert funnel.source_rows == 36 and funnel.logged_reward_clears_threshold == 36
    names = set(contrastive.build_contrastive_examples(df, rules).columns)
    assert not names & (set(OUTCOMES) | {"reward"})
    assert out[0].robust_advantage == pytest.approx(0.4)


@pytest.mark.parametrize("change, stage", [
    (dict(b=(0.9, 0.09, 0.01)), "agreed_preferred_action_is_supported"),
    (dict(b=(0.99, 0.005, 0.005)), "at_least_two_supported_actions"),
    (dict(nonlinear=(0.9, 0.3, 0.7)), "models_agree_on_preferred_action"),
    (dict(nonlinear=(0.0, 0.3, 1.7)), "value_disagreement_within_limit"),
    (dict(ridge=(0.0, 0.55, 0.6)), "both_advantages_clear_margin"),
])
def test_contrastive_stages_reject(spark, train, change, stage):
    staged = contrastive.contrastive_stages(injected(train, **change), ContrastiveRules(**ANY))
    assert contrastive.contrastive_funnel(staged).first()[stage] == 0


def test_contrastive_logged_requirement_and_readiness(spark, train):
    df, rules = injected(train), ContrastiveRules()
    staged = contrastive.contrastive_stages(df, rules)
    assert contrastive.contrastive_funnel(staged).first().preferred_matches_logged_action == 12
    candidates = contrastive.contrastive_candidates(staged, rules)
    ready = {r.action: r for r in contrastive.contrastive_readiness(
        candidates, contrastive.balance_candidates(candidates, rules), rules).collect()}
    assert ready["maintain"].selected_examples == 0 and ready["maintain"].underrepresented
    assert not ready["escalate_vasopressor"].underrepresented
    report = contrastive.contrastive_report(df, rules, row_bound=36)
    assert report.filter("metric = 'approved'").first().value == 0.0
    empty = contrastive.contrastive_report(injected(train, b=(1.0, 0.0, 0.0)), rules, row_bound=36)
    assert empty.filter("section = 'selected' AND metric = 'low_pressure_rows'").first().value == 0.0


def test_bias_report_of_constant_estimates(spark, train):
    long = bias.bias_report(injected(train), row_bound=36).cache()
    top = long.filter("section = 'global_rankings' AND action = 'escalate_vasopressor' AND metric = 'top_action_rate'")
    assert [r.value for r in top.collect()] == [1.0, 1.0]
    rows = {r.slice: r.value for r in long.filter("section = 'state_slices' AND model = 'ridge' AND metric = 'rows'").collect()}
    assert rows["lactate_above_2"] == 12 and rows["map_below_65"] == 5 and "lactate_missing" not in rows


def test_factual_fixture(spark):
    df = injected(training(spark, 30, lambda p, i: float(p)))
    rules = FactualRules(max_examples_per_cell=5, minimum_examples_per_cell=5)
    lib = factual.factual_library(df, rules)
    rows = lib.collect()
    assert len(rows) == 30 and "reward" not in lib.columns
    cells = [(r.action, r.outcome_label) for r in rows]
    assert cells[::5] == [(a, o) for a in ACTIONS for o in ("favorable", "unfavorable")]
    assert rows[0].source_patient_id == "p029" and rows[5].source_patient_id == "p000"
    assert not factual.factual_readiness(df, lib, rules).filter("insufficient").count()
    weak = injected(training(spark, 30, lambda p, i: float(p)), b=(0.79, 0.20, 0.01))
    lib2 = factual.factual_library(weak, rules)
    short = [r.action for r in factual.factual_readiness(weak, lib2, rules).filter("insufficient").collect()]
    assert short == ["escalate_vasopressor"] * 2


def test_tied_thresholds_put_a_row_in_both_cells(spark):
    df = injected(training(spark, 6, lambda p, i: 1.0))
    assert factual.factual_library(df).count() == 6 * 3 * 2
    salted = factual.factual_library(df, row_bound=None)
    assert salted.exceptAll(factual.factual_library(df, row_bound=1)).isEmpty()


@pytest.fixture(scope="module")
def library(spark):
    return factual.factual_library(
        injected(training(spark, 30, lambda p, i: float(p))), FactualRules(max_examples_per_cell=5)).cache()


def test_retrieval_matches_brute_force_in_one_block_and_many(spark, train, library):
    one = retrieval.nearest_examples(train, library, examples_per_cell=2, exclude="patient_id").cache()
    many = retrieval.nearest_examples(train, library, examples_per_cell=2, exclude="patient_id", block_rows=7)
    shown = ["patient_id", "time_step", "action", "outcome_label", "place", "library_rank", "retrieval_distance"]
    assert one.select(shown).exceptAll(many.select(shown)).isEmpty() and many.count() == one.count() == 36 * 12
    stats = retrieval.library_features(library)
    lib = library.orderBy("library_rank").toPandas()
    m = np.array(transform(library.orderBy("library_rank"), stats).toPandas(), dtype=float)
    q = train.filter("patient_id = 'p001' AND time_step = 2")
    d = np.linalg.norm(m - np.array(transform(q, stats).toPandas(), dtype=float), axis=1)
    d[lib["source_patient_id"] == "p001"] = np.inf
    got = one.filter("patient_id = 'p001' AND time_step = 2").toPandas()
    for (a, o), part in got.groupby(["action", "outcome_label"]):
        rows = np.flatnonzero((lib["action"] == a) & (lib["outcome_label"] == o))
        best = rows[np.argsort(d[rows], kind="stable")][:2]
        assert part.sort_values("place")["library_rank"].tolist() == lib["library_rank"].to_numpy()[best].tolist()
    retrieval.assert_complete(train, one, examples_per_cell=2)
    with pytest.raises(ValueError):
        retrieval.assert_complete(train, one, examples_per_cell=3)


def test_null_exclusion_excludes_nobody_and_records_hide_provenance(spark, train, library):
    open_ = retrieval.retrieve_examples(train, library, exclude=F.lit(None).cast("string"))
    assert open_.count() == 36 * 6
    records = retrieval.prompt_safe_records(open_)
    assert records.columns == ["state", "logged_action", "observed_outcome_label"]
    assert [f.name for f in records.schema["state"].dataType.fields] == list(OBSERVATIONS)
    with pytest.raises(ValueError):
        factual.assert_library(library.withColumn("action", F.lit("x")))
    with pytest.raises(ValueError):
        retrieval.nearest_examples(train, library, examples_per_cell=0)


def test_few_shot_policy_prompt(spark, train, library):
    from decisionlake.functions.prompts import FEW_SHOT_VERSION
    from decisionlake.sources.response_cache import Client

    pi = policy.FewShotPolicy(Client("m", FEW_SHOT_VERSION), None, library, version=FEW_SHOT_VERSION)
    obs = train.select("patient_id", "time_step", *OBSERVATIONS)
    text = pi.messages(obs).first().messages[1].content
    assert text.count('"observed_outcome_label"') == 6 and "source_patient_id" not in text


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([3, 1, 1], 300)
    p[0], p[1], p[2] = (1.0, 0.0, 0.0), (0.3, 0.3, 0.4), (0.30000000000000004, 0.3, 0.4)
    y = rng.integers(0, 3, 300)
    df = spark.createDataFrame(
        [(ACTIONS[k], *map(float, row), f"p{i % 30}", i % 2 + 1) for i, (k, row) in enumerate(zip(y, p))],
        "observed_clinician_action string, b_0 double, b_1 double, b_2 double, patient_id string, fold int")
    row = metrics.behavior_metrics(df, B, folds="fold").filter("fold IS NULL").first()
    top = p.argmax(1)
    assert row.log_loss == pytest.approx(-np.log(np.clip(p[np.arange(300), y], np.finfo(float).eps, 1)).mean())
    assert row.multiclass_brier == pytest.approx(((p - np.eye(3)[y]) ** 2).sum(1).mean())
    f1 = [2 * ((top == k) & (y == k)).sum() / max(1, (top == k).sum() + (y == k).sum()) for k in range(3)]
    assert row.macro_f1 == pytest.approx(np.mean(f1)) and row.accuracy == pytest.approx((top == y).mean())

    def ece(conf, hit):
        edges, out = np.linspace(0, 1, 11), 0.0
        for lo, hi in zip(edges, edges[1:]):
            inside = (conf >= lo) & ((conf <= hi) if hi == 1.0 else (conf < hi))
            if inside.any():
                out += inside.mean() * abs(hit[inside].mean() - conf[inside].mean())
        return out

    assert metrics.top_label_ece(df, B).first().top_label_ece == pytest.approx(ece(p.max(1), top == y))
    rest = {r.action: r.one_vs_rest_ece for r in metrics.one_vs_rest_ece(df, B).collect()}
    assert rest[ACTIONS[0]] == pytest.approx(ece(p[:, 0], y == 0))


def test_r2_of_constant_targets(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 1.0, 2.0)], "g string, y double, p double")
    assert {r.g: r.r2 for r in metrics.regression_metrics(df, "y", "p", ["g"]).collect()} == {"a": 1.0, "b": 0.0}


def test_empty_summaries_are_null(spark, train):
    row = metrics.reward_summary(train.limit(0), row_bound=0).first()
    assert row.rows == 0 and row["mean"] is None and row["median"] is None
    assert metrics.quantile_summary(train.limit(0), ["reward"], row_bound=0).first()["p25"] is None


def test_off_policy_values_match_numpy(spark, train):
    df = injected(train).withColumns({"pi_0": F.lit(0.1), "pi_1": F.lit(0.1), "pi_2": F.lit(0.8)})
    pdf = df.toPandas()
    a = np.array([ACTIONS.index(x) for x in pdf["observed_clinician_action"]])
    pi, b, m = np.array([0.1, 0.1, 0.8]), np.array([0.6, 0.25, 0.15]), np.array([0.0, 0.2, 0.6])
    w, r = np.minimum(pi[a] / b[a], 10.0), pdf["reward"].to_numpy()
    scored = evaluate.scored_rows(df, ["pi_0", "pi_1", "pi_2"], B, RIDGE)
    assert evaluate.dm_value(scored).first().dm_value == pytest.approx(pi @ m)
    assert evaluate.dr_value(scored).filter("clip = 10").first().dr_value == pytest.approx((pi @ m + w * (r - m[a])).mean())
    snips = evaluate.clipped_ips(scored).filter("clip = 10").first()
    assert snips.snips_value == pytest.approx((w * r).sum() / w.sum())
    ess = evaluate.weight_diagnostics(scored, clips=(2.0,)).filter("action = 'all'").first()
    w2 = np.minimum(pi[a] / b[a], 2.0)
    assert ess.ess == pytest.approx(w2.sum() ** 2 / (w2 ** 2).sum()) and ess.clipped_share == pytest.approx(1 / 3)
    ci = {x.score: x for x in evaluate.bootstrap_ci(scored, {"v": F.col("reward"), "zero": F.lit(0.0)}).collect()}
    assert ci["v"].lower < r.mean() < ci["v"].upper and ci["zero"].upper == 0.0
    entropy = evaluate.policy_entropy(df, ["pi_0", "pi_1", "pi_2"]).first().mean_entropy
    assert entropy == pytest.approx(-(pi * np.log(pi)).sum())
    certain = df.withColumns({"pi_0": F.lit(1.0), "pi_1": F.lit(0.0), "pi_2": F.lit(0.0)})
    assert evaluate.policy_entropy(certain, ["pi_0", "pi_1", "pi_2"]).first().mean_entropy == 0.0
    steps = evaluate.poisson_steps()
    assert steps[0] == pytest.approx(math.exp(-1)) and steps[-1] == pytest.approx(1.0, abs=1e-8)


def test_diverse_rows_priorities_and_fill(spark, train):
    out = explore.diverse_rows(train, 8).orderBy("selection_order").collect()
    assert len(out) == 8 and out[0].selection_reason == "lowest_map" and out[-1].selection_reason == "deterministic_fill"
    assert len({(r.patient_id, r.time_step) for r in out}) == 8
    assert explore.diverse_rows(train, 2).count() == 2
    with pytest.raises(ValueError):
        explore.diverse_rows(train, 0)


def test_sinks_round_trip(spark, train, library, tmp_path):
    sinks.write_library(library, str(tmp_path / "lib"))
    assert spark.read.csv(str(tmp_path / "lib"), header=True).count() == library.count()
    report = contrastive.contrastive_report(injected(train), ContrastiveRules(**ANY), row_bound=36)
    sinks.write_metrics(report, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == report.count()
    assert '"source_rows": 36.0' in sinks.metrics_json(report, ["section", "slice", "action", "metric"])
