"""One registered query per operator: ``name -> (spark, sf_dir) -> DataFrame``.

Doubles are shown with six decimals and integers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.functions.decisions import parse_decisions, probability_names, with_fallback
from decisionlake.functions.prompts import note_json, zero_shot_messages
from decisionlake.functions.reward import SAFETY_FIRST, RewardSpec, with_reward
from decisionlake.functions.vectors import action_index, action_name, argmax, pick, r6
from decisionlake.operators import bias, contrastive, episodes, evaluate, explore, factual, features
from decisionlake.operators import folds, metrics, nuisance, policy, retrieval, validate
from decisionlake.operators.shared_fits import SharedFits
from decisionlake.plans import data
from decisionlake.plans.data import B, CLIENT, NONLINEAR, PI, RHO, RIDGE
from decisionlake.sources import response_cache, sinks
from decisionlake.sources.trajectories import load_trajectories, observations
from decisionlake.spec import DEFAULT, OUTCOMES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = list(DEFAULT.key)
ACTION = DEFAULT.action
FIT_SPLITS = 5
BOOSTED_SMALL = nuisance.RewardModelConfig("hist_gradient_boosting", max_iter=3)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame) -> DataFrame:
    shown = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            shown.append(r6(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            shown.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            shown.append(F.col(f.name))
    return df.select(*shown)


def bounded(spark, sf):
    return {"row_bound": data.row_bound(spark, sf)}


# ------------------------------------------------------------- sources and projections


@query
def load_trajectories_table(spark, sf):
    return tidy(load_trajectories(spark, data.trajectories(spark, sf)))


@query
def trajectories_from_events(spark, sf):
    return tidy(data.build_trajectories(spark, sf))


@query
def observation_rows(spark, sf):
    return tidy(observations(data.trajectories(spark, sf), key=True))


@query
def response_cache_scan(spark, sf):
    return tidy(response_cache.read_cache(spark, data.response_cache_path(spark, sf), format="parquet"))


@query
def response_cache_new_records(spark, sf):
    """Requests that an append would add."""
    asked = data.requests(data.trajectories(spark, sf))
    keyed = response_cache.with_cache_key(asked, CLIENT)
    return response_cache.new_records(keyed, data.response_cache(spark, sf)).select("cache_key")


@query
def case_report(spark, sf):
    df = data.trajectories(spark, sf)
    cases = explore.diverse_rows(df, 24)
    decided = response_cache.cached_decisions(
        data.requests(cases).join(cases.select(*KEY, "selection_reason"), KEY),
        data.response_cache(spark, sf), CLIENT,
    )
    return sinks.case_report(decided, probability_names())


# ------------------------------------------------------------------------- validation


@query
def duplicate_transitions(spark, sf):
    return tidy(validate.duplicate_transitions(data.defective(spark, sf)))


@query
def unknown_actions(spark, sf):
    return tidy(validate.unknown_actions(data.defective(spark, sf)))


@query
def terminal_violations(spark, sf):
    return tidy(validate.terminal_violations(data.defective(spark, sf)))


@query
def split_violations(spark, sf):
    return tidy(validate.split_violations(data.defective(spark, sf)))


@query
def validation_report(spark, sf):
    return tidy(validate.validation_report(data.defective(spark, sf)))


@query
def probability_violations(spark, sf):
    df = data.estimates(spark, sf).withColumn(
        "b_0", F.when(data.k() == 13, F.col("b_0") + 1e-3).when(data.k() == 14, -F.col("b_0")).otherwise(F.col("b_0"))
    )
    return tidy(validate.probability_violations(df, B).select(*KEY, *B))


@query
def split_leakage(spark, sf):
    """Train patients also seen in a split that was cut by row instead of by patient."""
    df = data.trajectories(spark, sf).withColumn(
        "split", F.when(data.k() == 5, "validation").otherwise(F.col("split"))
    )
    return tidy(validate.split_leakage(df))


# --------------------------------------------------------------- rewards and episodes


@query
def reward(spark, sf):
    return tidy(with_reward(data.trajectories(spark, sf)).select(*KEY, "reward"))


@query
def reward_alt(spark, sf):
    return tidy(with_reward(data.trajectories(spark, sf), SAFETY_FIRST).select(*KEY, "reward"))


@query
def episode_metadata(spark, sf):
    return tidy(episodes.episode_metadata(data.trajectories(spark, sf)))


@query
def episode_first_observation(spark, sf):
    return tidy(episodes.first_observations(data.trajectories(spark, sf)))


@query
def episode_sample(spark, sf):
    return episodes.sample_episodes(data.trajectories(spark, sf), 20)


@query
def logged_transitions(spark, sf):
    t = episodes.logged_transitions(data.trajectories(spark, sf), **bounded(spark, sf))
    shown = ["map_mm_hg", "lactate_mmol_l", "previous_action"]
    return tidy(t.select(
        *KEY, "action", "reward", "next_time_step", "done", "logged_transition",
        *[F.col("state")[c].alias(c) for c in shown],
        *[F.col("next_state")[c].alias(f"next_{c}") for c in shown],
    ))


@query
def group_folds(spark, sf):
    df = data.trajectories(spark, sf).filter(F.col("split") == "train")
    return tidy(folds.patient_folds(df))


@query
def hash_folds(spark, sf):
    return tidy(data.trajectories(spark, sf).select(*KEY, folds.hash_fold().alias("fold")))


# --------------------------------------------------------------------------- features


@query
def feature_stats(spark, sf):
    return tidy(features.feature_stats(data.train(spark, sf), **bounded(spark, sf)))


@query
def standardized_features(spark, sf):
    stats = features.fit_features(data.train(spark, sf), **bounded(spark, sf))
    return tidy(features.transform(data.trajectories(spark, sf), stats, KEY))


# ----------------------------------------------------------------- estimates and models


@query
def support_mask(spark, sf):
    mask = nuisance.support_mask(B)
    return data.estimates(spark, sf).select(*KEY, *[m.alias(f"supported_{i}") for i, m in enumerate(mask)])


@query
def supported_values(spark, sf):
    return tidy(nuisance.supported_values(data.estimates(spark, sf), RIDGE, B).select(*KEY, *RIDGE))


@query
def logged_values(spark, sf):
    value = pick(RIDGE, action_index(ACTION, DEFAULT.actions))
    return tidy(data.estimates(spark, sf).select(*KEY, value.alias("logged_value")))


@query
def top_action(spark, sf):
    top = action_name(argmax(RIDGE), DEFAULT.actions)
    return data.estimates(spark, sf).select(*KEY, top.alias("top_action"))


def _train_rows(spark, sf):
    return data.trajectories(spark, sf).filter(F.col("split") == "train")


@query
def behavior_propensity(spark, sf):
    train = _train_rows(spark, sf)
    model = nuisance.BehaviorPolicyModel().fit(train, **bounded(spark, sf))
    rest = data.trajectories(spark, sf).filter(F.col("split") != "train")
    return tidy(model.predict(rest).select(*KEY, *B))


def _reward_model(spark, sf, config, stem):
    train = _train_rows(spark, sf)
    model = nuisance.ActionRewardModel(config).fit(train, **bounded(spark, sf))
    rest = data.trajectories(spark, sf).filter(F.col("split") != "train")
    return tidy(model.predict_values(rest, stem).select(*KEY, *DEFAULT.indexed(stem)))


@query
def reward_model_ridge(spark, sf):
    return _reward_model(spark, sf, nuisance.RIDGE, "ridge")


@query
def reward_model_gbt(spark, sf):
    return _reward_model(spark, sf, BOOSTED_SMALL, "nonlinear")


@query
def cross_fit_behavior(spark, sf):
    rows = nuisance.cross_fit_behavior(_train_rows(spark, sf), FIT_SPLITS, **bounded(spark, sf))
    return tidy(rows.select(*KEY, "fold", *B))


@query
def cross_fit_estimates(spark, sf):
    config = nuisance.CrossFitConfig(
        FIT_SPLITS, rewards={"ridge": nuisance.RIDGE, "nonlinear": nuisance.BOOSTED}
    )
    rows = nuisance.cross_fit(_train_rows(spark, sf), config, **bounded(spark, sf))
    return tidy(rows.select(*KEY, "fold", *B, *RIDGE, *NONLINEAR))


@query
def cross_fit_facts(spark, sf):
    """What SQL can state of a cross-fit: every training row once, its fold, and sound estimates."""
    config = nuisance.CrossFitConfig(FIT_SPLITS, rewards={"ridge": nuisance.RIDGE})
    rows = nuisance.cross_fit(_train_rows(spark, sf), config, **bounded(spark, sf))
    whole = F.abs(sum((F.col(b) for b in B), F.lit(0.0)) - 1.0) < 1e-9
    in_range = F.least(*[F.col(b) for b in B]) >= 0.0
    finite_values = F.greatest(*[F.abs(F.col(r)) for r in RIDGE]) < float("inf")
    return tidy(rows.select(
        *KEY, ACTION, "fold", (whole & in_range).alias("is_distribution"), finite_values.alias("has_finite_values")
    ))


@query
def cross_fit_certificates(spark, sf):
    """First-order conditions of the models on all rows (side 0) and of those without each fold."""
    folded = data.folded(spark, sf, FIT_SPLITS)
    fits = SharedFits.fit(folded, range(FIT_SPLITS + 1), behavior={}, ridge={"ridge": nuisance.RIDGE.alpha}, **bounded(spark, sf))
    return tidy(fits.certificate(folded))


def fitted_estimates(spark, sf):
    """Out-of-fold estimates of models fitted on the training rows, written once."""
    def build():
        config = nuisance.CrossFitConfig(FIT_SPLITS, rewards={"ridge": nuisance.RIDGE, "nonlinear": BOOSTED_SMALL})
        return nuisance.cross_fit(_train_rows(spark, sf), config, **bounded(spark, sf))

    return data._once(spark, sf, "fitted-estimates", build)


@query
def end_to_end_facts(spark, sf):
    """Fitted estimates through bias, contrastive examples, library, retrieval and evaluation.

    The numbers are those that hold whatever the models say: what the data alone give, and counts of
    results that contradict the estimates they came from.
    """
    rows, bound = fitted_estimates(spark, sf), bounded(spark, sf)
    action = action_index(ACTION, DEFAULT.actions)

    def fact(df, stage, metrics_, of=None):
        named = F.lit(None).cast("string") if of is None else F.col(of)
        return df.select(
            F.lit(stage).alias("stage"), named.alias("action"),
            F.inline(F.array(*[
                F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics_.items()
            ])),
        )

    report = bias.bias_report(rows, **bound).filter(
        (F.col("section") == "observed_reward") & F.col("metric").isin("rows", "mean")
    ).select(F.lit("observed_reward").alias("stage"), "action", "metric", "value")

    staged = contrastive.contrastive_stages(rows, RULES)
    counts = contrastive.contrastive_funnel(staged)
    names = counts.columns
    rising = sum((F.when(F.col(y) > F.col(x), 1).otherwise(0) for x, y in zip(names, names[1:])), F.lit(0))

    examples = contrastive.build_contrastive_examples(rows, RULES, **bound)
    unsound = (
        (F.col("preferred_action") == F.col("near_negative_action"))
        | (F.col("robust_advantage") < RULES.minimum_advantage)
        | (F.col("value_disagreement") > RULES.maximum_value_disagreement)
        | (F.col("preferred_propensity") < RULES.minimum_propensity)
        | (F.col("example_rank") > RULES.max_examples_per_action)
    )
    library = data._once(
        spark, sf, "fitted-library", lambda: factual.factual_library(rows, **bound).coalesce(1)
    )
    source = rows.select(
        F.col("patient_id").alias("source_patient_id"), F.col("time_step").alias("source_time_step"),
        F.col(ACTION).alias("_logged"), F.col("fold").alias("_fold"), pick(B, action).alias("_p"),
    )
    traced = library.join(source, ["source_patient_id", "source_time_step"], "left")
    faithful = (
        F.col("_logged").eqNullSafe(F.col("action")) & F.col("_fold").eqNullSafe(F.col("cross_fit_fold"))
        & F.col("_p").eqNullSafe(F.col("logged_action_propensity"))
    )
    found = retrieval.retrieve_examples(
        observations(data.trajectories(spark, sf), key=True), library, exclude="patient_id"
    )
    # with the logging policy itself every weight is one: doubly robust is direct plus the mean residual
    scored = evaluate.scored_rows(rows, B, B, RIDGE)
    robust = evaluate.dr_value(scored, (1.0,)).select("dr_value")
    plain = scored.agg(F.count("*").alias("rows"), (F.avg("dm") + F.avg("residual")).alias("expected"))
    held = metrics.side_by_side([], plain, robust)
    return tidy(metrics.union_long([
        report,
        fact(counts, "funnel", {"source_rows": F.col("source_rows"), "rising_stages": rising}),
        fact(examples.agg(F.count_if(unsound).alias("n")), "contrastive", {"unsound": F.col("n")}),
        fact(traced.agg(F.count_if(~faithful).alias("n"), F.count("*").alias("all"), F.count_distinct(
            "action", "outcome_label", "source_patient_id").alias("own")),
            "library", {"unfaithful": F.col("n"), "repeated_patients": F.col("all") - F.col("own")}),
        fact(found.agg(F.count("*").alias("n"), F.count_if(F.col("patient_id") == F.col("source_patient_id")).alias("own")),
             "retrieval", {"examples": F.col("n"), "own_patient": F.col("own")}),
        fact(held, "evaluation", {"rows": F.col("rows"), "gap": F.abs(F.col("dr_value") - F.col("expected"))}),
    ]))


@query
def behavior_report(spark, sf):
    return tidy(nuisance.cross_validate_behavior(_train_rows(spark, sf), FIT_SPLITS, **bounded(spark, sf)))


@query
def reward_model_report(spark, sf):
    models = {"ridge": nuisance.RIDGE}
    return tidy(nuisance.cross_validate_rewards(_train_rows(spark, sf), models, FIT_SPLITS, **bounded(spark, sf)))


@query
def reward_model_comparison(spark, sf):
    models = {"ridge": nuisance.RIDGE, "nonlinear": nuisance.BOOSTED}
    return tidy(nuisance.compare_reward_models(
        _train_rows(spark, sf), models, n_splits=FIT_SPLITS, **bounded(spark, sf))[1])


# ----------------------------------------------------------------------------- metrics


@query
def behavior_log_loss(spark, sf):
    return tidy(metrics.behavior_metrics(data.train(spark, sf), B, folds="fold").select("fold", "rows", "log_loss"))


@query
def behavior_brier(spark, sf):
    return tidy(metrics.behavior_metrics(data.train(spark, sf), B, folds="fold").select("fold", "multiclass_brier"))


@query
def behavior_accuracy(spark, sf):
    return tidy(metrics.behavior_metrics(data.train(spark, sf), B, folds="fold").select("fold", "accuracy"))


@query
def behavior_macro_f1(spark, sf):
    return tidy(metrics.behavior_metrics(data.train(spark, sf), B, folds="fold").select("fold", "macro_f1"))


@query
def top_label_ece(spark, sf):
    return tidy(metrics.top_label_ece(data.train(spark, sf), B, folds="fold").select("fold", "top_label_ece"))


@query
def one_vs_rest_ece(spark, sf):
    return tidy(metrics.one_vs_rest_ece(data.train(spark, sf), B))


@query
def binary_brier(spark, sf):
    return tidy(metrics.binary_brier(data.train(spark, sf), B))


@query
def logged_propensity_by_action(spark, sf):
    return tidy(metrics.logged_propensity(data.train(spark, sf), B, by_action=True, **bounded(spark, sf)))


@query
def logged_propensity(spark, sf):
    return tidy(metrics.logged_propensity(data.train(spark, sf), B, **bounded(spark, sf)))


@query
def action_rates(spark, sf):
    return tidy(metrics.action_rates(data.train(spark, sf), B))


@query
def state_slice_behavior(spark, sf):
    return tidy(metrics.state_slice_behavior(data.train(spark, sf), B))


def _with_prediction(df, values=RIDGE):
    return df.withColumn("predicted", pick(values, action_index(ACTION, DEFAULT.actions)))


@query
def reward_fit_metrics(spark, sf):
    return tidy(metrics.regression_metrics(
        _with_prediction(data.train(spark, sf)), "reward", "predicted", folds="fold"))


@query
def reward_fit_by_action(spark, sf):
    return tidy(metrics.regression_metrics(
        _with_prediction(data.train(spark, sf)), "reward", "predicted", [F.col(ACTION).alias("action")]))


@query
def fold_metrics(spark, sf):
    return tidy(metrics.fold_sizes(data.train(spark, sf)))


@query
def model_deltas(spark, sf):
    df = data.train(spark, sf)
    reports = metrics.union_long([
        metrics.reward_report(_with_prediction(df, v), "predicted", model=m)
        for m, v in (("ridge", RIDGE), ("nonlinear", NONLINEAR))
    ])
    return tidy(metrics.model_deltas(reports, "ridge"))


@query
def quantile_summary(spark, sf):
    return tidy(metrics.quantile_summary(
        data.train(spark, sf), ["reward", "lactate_mmol_l", "b_2"], [ACTION], **bounded(spark, sf)))


@query
def reward_summary(spark, sf):
    return tidy(metrics.reward_summary(data.train(spark, sf), by=[ACTION], **bounded(spark, sf)))


# -------------------------------------------------------------------------- contrastive

#: The formulas rarely agree closely, so the limits are wider than the defaults.
RULES = contrastive.ContrastiveRules()


@query
def contrastive_funnel(spark, sf):
    return tidy(contrastive.contrastive_funnel(contrastive.contrastive_stages(data.train(spark, sf), RULES)))


@query
def contrastive_candidates(spark, sf):
    staged = contrastive.contrastive_stages(data.train(spark, sf), RULES)
    return tidy(contrastive.contrastive_candidates(staged, RULES))


@query
def contrastive_examples(spark, sf):
    return tidy(contrastive.build_contrastive_examples(data.train(spark, sf), RULES, **bounded(spark, sf)))


@query
def contrastive_readiness(spark, sf):
    staged = contrastive.contrastive_stages(data.train(spark, sf), RULES)
    candidates = contrastive.contrastive_candidates(staged, RULES)
    selected = contrastive.balance_candidates(candidates, RULES, **bounded(spark, sf))
    return tidy(contrastive.contrastive_readiness(candidates, selected, RULES))


@query
def contrastive_report(spark, sf):
    return tidy(contrastive.contrastive_report(data.train(spark, sf), RULES, **bounded(spark, sf)))


# --------------------------------------------------------------------------------- bias


@query
def bias_observed(spark, sf):
    return tidy(bias.bias_observed(data.train(spark, sf), **bounded(spark, sf)))


def _ranked(spark, sf):
    return bias.ranked_rows(data.train(spark, sf)), 2 * data.row_bound(spark, sf)


@query
def bias_global(spark, sf):
    return tidy(bias.bias_global(_ranked(spark, sf)[0]))


@query
def bias_propensity(spark, sf):
    return tidy(bias.bias_propensity(*_ranked(spark, sf)))


@query
def bias_agreement(spark, sf):
    return tidy(bias.bias_agreement(data.train(spark, sf)))


@query
def bias_matrix(spark, sf):
    return tidy(bias.bias_matrix(_ranked(spark, sf)[0]))


@query
def bias_maintain(spark, sf):
    return tidy(bias.bias_maintain(*_ranked(spark, sf)))


@query
def bias_slices(spark, sf):
    return tidy(bias.bias_slices(*_ranked(spark, sf)))


@query
def bias_report(spark, sf):
    return tidy(bias.bias_report(data.train(spark, sf), **bounded(spark, sf)))


# ---------------------------------------------------------------- library and retrieval


@query
def reward_thresholds(spark, sf):
    return tidy(factual.reward_thresholds(data.train(spark, sf), **bounded(spark, sf)))


@query
def outcome_labels(spark, sf):
    df = data.train(spark, sf)
    thresholds = factual.reward_thresholds(df, **bounded(spark, sf))
    return tidy(factual.outcome_labels(df, thresholds).select(*KEY, "action", "outcome_label", "reward"))


@query
def factual_library(spark, sf):
    return tidy(factual.factual_library(data.train(spark, sf), **bounded(spark, sf)))


@query
def factual_readiness(spark, sf):
    df, bound = data.train(spark, sf), bounded(spark, sf)
    return tidy(factual.factual_readiness(df, factual.factual_library(df, **bound), **bound))


@query
def factual_report(spark, sf):
    df, bound = data.train(spark, sf), bounded(spark, sf)
    return tidy(factual.factual_report(df, factual.factual_library(df, **bound), **bound))


def library_table(spark, sf):
    """The written library: a few hundred rows that several operators read."""
    return data._once(
        spark, sf, "factual-library",
        lambda: factual.factual_library(data.train(spark, sf), **bounded(spark, sf)).coalesce(1),
    )


def _retrieved(spark, sf):
    """Nearest examples for every state, own patient excluded."""
    asked = data.trajectories(spark, sf)
    return asked, retrieval.retrieve_examples(asked, library_table(spark, sf), exclude="patient_id")


@query
def retrieve_examples(spark, sf):
    found = _retrieved(spark, sf)[1]
    return tidy(found.select(
        *KEY, "action", "outcome_label", "library_rank", "retrieval_distance",
        "source_patient_id", "source_time_step",
    ))


@query
def prompt_safe_records(spark, sf):
    records = retrieval.prompt_safe_records(library_table(spark, sf))
    return tidy(records.select("state.*", "logged_action", "observed_outcome_label"))


@query
def few_shot_messages(spark, sf):
    asked = observations(data.trajectories(spark, sf), key=True)
    built = policy.few_shot_requests(asked, library_table(spark, sf), exclude="patient_id")
    return built.select(*KEY, F.col("messages")[1]["content"].alias("user_content"))


# -------------------------------------------------------------- prompts and decisions


@query
def state_json(spark, sf):
    return data.requests(data.trajectories(spark, sf)).select(*KEY, "state_json")


@query
def handoff_note_json(spark, sf):
    """Whole document texts as notes."""
    docs = data.table(spark, sf, "documents")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), note_json("text").alias("note_json"))


@query
def zero_shot_messages_rows(spark, sf):
    """Messages with a note from the conversation turn of the same number as the patient."""
    turns = data.table(spark, sf, "conversations").filter(F.col("turn") == 0).select(
        F.col("conv_id").cast("bigint").alias("_uid"), F.col("text").alias("handoff_note"))
    df = observations(data.trajectories(spark, sf), key=True)
    noted = df.withColumn("_uid", data.uid()).join(turns, "_uid", "left").drop("_uid")
    built = zero_shot_messages(noted, keep=KEY, note="handoff_note")
    return built.select(
        *KEY,
        F.col("messages")[0]["role"].alias("first_role"),
        F.sha2(F.col("messages")[0]["content"], 256).alias("system_sha256"),
        F.col("messages")[1]["content"].alias("user_content"),
    )


@query
def cache_key(spark, sf):
    asked = data.requests(data.trajectories(spark, sf))
    return response_cache.with_cache_key(asked, CLIENT).select(*KEY, "cache_key")


def _looked_up(spark, sf):
    keyed = response_cache.with_cache_key(data.requests(data.trajectories(spark, sf)), CLIENT)
    return response_cache.lookup(keyed, data.response_cache(spark, sf), CLIENT)


@query
def cache_lookup(spark, sf):
    return _looked_up(spark, sf).select(*KEY, "cache_key", "cache_hit", "cache_error", "raw_response")


@query
def parsed_decisions(spark, sf):
    raw = data.trajectories(spark, sf).select(*KEY, data.responses().alias("raw_response"))
    return tidy(parse_decisions(raw).drop("raw_response"))


@query
def decision_fallback(spark, sf):
    raw = data.trajectories(spark, sf).select(*KEY, data.responses().alias("raw_response"))
    return tidy(with_fallback(parse_decisions(raw)).drop("raw_response"))


# ----------------------------------------------------------------------------- policies


@query
def policy_always_maintain(spark, sf):
    return policy.AlwaysFirst().predict(observations(data.trajectories(spark, sf), key=True))


def _zero_shot(spark, sf):
    pi = policy.PromptedPolicy(CLIENT, data.response_cache(spark, sf))
    return pi.predict(observations(data.trajectories(spark, sf), key=True))


@query
def policy_zero_shot(spark, sf):
    return tidy(_zero_shot(spark, sf).drop("raw_response"))


@query
def policy_diagnostics(spark, sf):
    return tidy(policy.policy_diagnostics(_zero_shot(spark, sf)))


@query
def chosen_action(spark, sf):
    return _zero_shot(spark, sf).select(*KEY, policy.chosen_action(probability_names()).alias("chosen_action"))


def rule_backend():
    """A stand-in model: reads the state from the prompt and answers by rule, or fails.

    A closure, so that it travels to the tasks by value.
    """
    def complete(messages, model_id, temperature):
        import json

        text = messages[-1]["content"]
        state = json.loads(text.split("<structured_state_json>")[1].split("</structured_state_json>")[0])
        if state["spo2"] == 95.0:
            raise RuntimeError("no answer")
        p = [0.2, 0.3, 0.5] if state["map_mm_hg"] < 65 else [0.8, 0.1, 0.1]
        return json.dumps({
            "prob_maintain": p[0], "prob_iv_fluids": p[1], "prob_escalate_vasopressor": p[2],
            "rationale": "pressure rule",
        })

    return complete


@query
def policy_with_backend(spark, sf):
    """Cache first, a rule-based backend for the misses, fallback for its errors."""
    import uuid

    from decisionlake.sources.storage import table_path

    pi = policy.PromptedPolicy(
        CLIENT, data.response_cache(spark, sf), backend=rule_backend(),
        cache_path=table_path(spark, "backend-cache", uuid.uuid4()),
    )
    asked = observations(data.trajectories(spark, sf), key=True)
    return tidy(pi.predict(asked).drop("raw_response"))


@query
def diverse_rows(spark, sf):
    return tidy(explore.diverse_rows(data.trajectories(spark, sf), 24))


@query
def outcome_describe(spark, sf):
    return tidy(explore.describe(data.trajectories(spark, sf), OUTCOMES, **bounded(spark, sf)))


@query
def outcome_rates(spark, sf):
    return tidy(explore.value_rates(data.trajectories(spark, sf), OUTCOMES[2:]))


@query
def means_by_action(spark, sf):
    return tidy(explore.means_by_action(data.trajectories(spark, sf)))


@query
def means_by_low_map_action(spark, sf):
    return tidy(explore.means_by_low_pressure_action(data.trajectories(spark, sf)))


@query
def outcome_correlation(spark, sf):
    return tidy(explore.correlations(data.trajectories(spark, sf), OUTCOMES))


@query
def null_rates_by_action(spark, sf):
    return tidy(explore.null_rates_by_action(data.trajectories(spark, sf)))


@query
def reward_and_outcomes_by_action(spark, sf):
    """Mean reward and outcomes of logged transitions per logged action and done flag."""
    t = episodes.logged_transitions(data.trajectories(spark, sf), **bounded(spark, sf))
    return tidy(t.groupBy("action", "done").agg(
        F.count("*").alias("transitions"),
        F.avg("reward").alias("mean_reward"),
        F.avg(F.col("next_state")["map_mm_hg"] - F.col("state")["map_mm_hg"]).alias("mean_pressure_change"),
    ))


# --------------------------------------------------------------------------- evaluation


def _scored(spark, sf, pi=PI):
    return evaluate.scored_rows(data.validation(spark, sf), pi, B, RIDGE)


@query
def dm_value(spark, sf):
    return tidy(evaluate.dm_value(_scored(spark, sf)))


@query
def clipped_ips(spark, sf):
    return tidy(evaluate.clipped_ips(_scored(spark, sf)))


@query
def dr_value(spark, sf):
    return tidy(evaluate.dr_value(_scored(spark, sf)))


@query
def weight_diagnostics(spark, sf):
    return tidy(evaluate.weight_diagnostics(_scored(spark, sf)))


@query
def bootstrap_ci(spark, sf):
    """Doubly robust values of two policies and their paired difference."""
    def score(pi):
        w = F.least(evaluate.importance_weight(pi, B), F.lit(evaluate.CLIPS[0]))
        modelled = pick(RIDGE, action_index(ACTION, DEFAULT.actions))
        return evaluate.direct_value(pi, RIDGE) + w * (F.col("reward") - modelled)

    first, second = score(PI), score(RHO)
    scores = {"first": first, "second": second, "difference": first - second}
    return tidy(evaluate.bootstrap_ci(data.validation(spark, sf), scores))


@query
def policy_entropy(spark, sf):
    return tidy(evaluate.policy_entropy(data.validation(spark, sf), PI))


@query
def policy_support(spark, sf):
    return tidy(evaluate.policy_support(data.validation(spark, sf), PI, B))


@query
def policy_state_slice(spark, sf):
    return tidy(evaluate.policy_state_slice(data.validation(spark, sf), PI))


@query
def policy_agreement(spark, sf):
    df = data.validation(spark, sf)
    other = df.select(*KEY, *[F.col(c).alias(p) for c, p in zip(RHO, PI)])
    return tidy(evaluate.policy_agreement(df, other, PI))


@query
def flip_rate(spark, sf):
    """Perturbations made here by formula: a harmless edit, lower pressure, an instruction."""
    df = data.validation(spark, sf)
    shifted = df.withColumns(data.policy_columns(F.col("map_mm_hg") - 3.0))
    told = F.when(data.k() % 3 == 0, 0.5).otherwise(0.0)
    instructed = df.withColumns({
        "pi_0": F.col("pi_0") * (1.0 - told) + told,
        "pi_1": F.col("pi_1") * (1.0 - told),
        "pi_2": F.col("pi_2") * (1.0 - told),
    })
    kinds = {"paraphrase": df, "pressure_conflict": shifted, "instruction": instructed}
    perturbed = None
    for name, frame in kinds.items():
        frame = frame.select(*KEY, F.lit(name).alias("kind"), *PI)
        perturbed = frame if perturbed is None else perturbed.unionByName(frame)
    return tidy(evaluate.flip_rate(df, perturbed, PI, values=RIDGE))


@query
def reward_sensitivity(spark, sf):
    rewards = {"default": RewardSpec(), "safety_first": SAFETY_FIRST}
    return tidy(evaluate.reward_sensitivity(
        data.validation(spark, sf), {"first": PI, "second": RHO}, B, rewards))


@query
def policy_actions_test(spark, sf):
    test = observations(data.trajectories(spark, sf).filter(F.col("split") == "test"), key=True)
    pi = policy.PromptedPolicy(CLIENT, data.response_cache(spark, sf))
    return tidy(policy.blinded_predictions(pi.predict(test), test, pi))
