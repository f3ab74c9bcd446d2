"""Contrastive examples: a supported, model-agreed preferred action and its near negative."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import (
    action_index, action_name, argmax, below, computed_once, count_if, pick, rate, total,
)
from decisionlake.operators.metrics import quantile_summary, to_long, union_long
from decisionlake.operators.scale import top_per_group
from decisionlake.operators.validate import assert_selection_source
from decisionlake.sources.storage import cut
from decisionlake.spec import DEFAULT, TrajectorySpec

# Stage names, in order.
STAGES = (
    "at_least_two_supported_actions",
    "models_agree_on_preferred_action",
    "agreed_preferred_action_is_supported",
    "value_disagreement_within_limit",
    "both_advantages_clear_margin",
    "preferred_matches_logged_action",
    "logged_reward_clears_threshold",
)
QUANTIFIED = ("robust_advantage", "preferred_propensity", "near_negative_propensity", "value_disagreement")


@dataclass(frozen=True)
class ContrastiveRules:
    minimum_propensity: float = 0.02
    minimum_advantage: float = 0.10
    maximum_value_disagreement: float = 0.50
    max_examples_per_action: int = 100
    require_preferred_matches_logged: bool = True
    minimum_logged_reward: float | None = 0.0
    minimum_examples_per_action: int = 10
    behavior: str = "b"
    models: tuple[str, str] = field(default=("ridge", "nonlinear"))

    def __post_init__(self):
        if not 0.0 <= self.minimum_propensity <= 1.0:
            raise ValueError("minimum_propensity is a probability.")
        if self.minimum_advantage < 0 or self.maximum_value_disagreement < 0:
            raise ValueError("Limits on advantage and disagreement cannot be below zero.")
        if self.max_examples_per_action <= 0 or self.minimum_examples_per_action <= 0:
            raise ValueError("Caps and minimum counts must be at least one.")
        if self.minimum_logged_reward is not None and not math.isfinite(self.minimum_logged_reward):
            raise ValueError("minimum_logged_reward takes a finite number, or None for no floor.")


def contrastive_stages(
    df: DataFrame, rules: ContrastiveRules = ContrastiveRules(), spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Add the compared actions and one cumulative boolean column per stage.

    The preferred action is the best of all actions and is then required to be supported;
    a limit that is met exactly passes.
    """
    b = spec.indexed(rules.behavior)
    first, second = (spec.indexed(m) for m in rules.models)
    supported = [F.col(p) >= F.lit(rules.minimum_propensity) for p in b]
    df = computed_once(df, {
        "_top": argmax(first),
        "_other": argmax(second),
        "_supported": total([s.cast("int") for s in supported]),
        "_logged": action_index(spec.action, spec.actions),
    })
    top = F.col("_top")
    average = [
        F.when(supported[i] & (top != i), (F.col(x) + F.col(y)) / 2.0)
        for i, (x, y) in enumerate(zip(first, second))
    ]
    df = computed_once(df, {
        "_negative": argmax(average),
        "_top_supported": pick([s.cast("double") for s in supported], top) == 1.0,
    })
    negative = F.col("_negative")
    df = computed_once(df, {
        "preferred_propensity": pick(b, top),
        "near_negative_propensity": pick(b, negative),
        **{f"{m}_preferred_value": pick(spec.indexed(m), top) for m in rules.models},
        **{f"{m}_near_negative_value": pick(spec.indexed(m), negative) for m in rules.models},
    })
    x, y = rules.models
    df = df.withColumns({
        "value_disagreement": F.greatest(
            F.abs(F.col(f"{x}_preferred_value") - F.col(f"{y}_preferred_value")),
            F.abs(F.col(f"{x}_near_negative_value") - F.col(f"{y}_near_negative_value")),
        ),
        **{f"{m}_advantage": F.col(f"{m}_preferred_value") - F.col(f"{m}_near_negative_value")
           for m in rules.models},
    })
    df = df.withColumn("robust_advantage", F.least(*[f"{m}_advantage" for m in rules.models]))
    matches = top == F.col("_logged")
    conditions = [
        F.col("_supported") >= 2,
        top == F.col("_other"),
        F.col("_top_supported"),
        F.col("value_disagreement") <= rules.maximum_value_disagreement,
        F.col("robust_advantage") >= rules.minimum_advantage,
        matches if rules.require_preferred_matches_logged else F.lit(True),
        F.lit(True) if rules.minimum_logged_reward is None
        else F.col(spec.reward) >= rules.minimum_logged_reward,
    ]
    passed, stages = F.lit(True), {}
    for name, condition in zip(STAGES, conditions):
        passed = passed & F.coalesce(condition, F.lit(False))
        stages[name] = passed
    return df.withColumns(stages | {"preferred_matches_logged": F.coalesce(matches, F.lit(False))})


def contrastive_funnel(staged: DataFrame) -> DataFrame:
    """``source_rows`` and the rows left after every stage, in one pass."""
    return staged.agg(
        F.count("*").alias("source_rows"), *[count_if(F.col(s)).alias(s) for s in STAGES]
    )


def contrastive_candidates(
    staged: DataFrame, rules: ContrastiveRules = ContrastiveRules(), spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Rows that pass every stage, without outcomes or rewards."""
    x, y = rules.models
    return staged.filter(F.col(STAGES[-1])).select(
        F.col(spec.patient).alias("source_patient_id"),
        F.col(spec.step).alias("source_time_step"),
        F.col("fold").alias("cross_fit_fold"),
        *spec.observations,
        action_name(F.col("_top"), spec.actions).alias("preferred_action"),
        action_name(F.col("_negative"), spec.actions).alias("near_negative_action"),
        F.col(spec.action).alias("logged_action"),
        "preferred_matches_logged",
        "preferred_propensity",
        "near_negative_propensity",
        f"{x}_preferred_value",
        f"{x}_near_negative_value",
        f"{y}_preferred_value",
        f"{y}_near_negative_value",
        f"{x}_advantage",
        f"{y}_advantage",
        "robust_advantage",
        "value_disagreement",
    )


def balance_candidates(
    candidates: DataFrame, rules: ContrastiveRules = ContrastiveRules(),
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """The best examples of each preferred action, in action order then rank."""
    order = [
        F.desc("robust_advantage"), F.desc("preferred_propensity"),
        "source_patient_id", "source_time_step",
    ]
    best = top_per_group(
        candidates, ["preferred_action"], order, rules.max_examples_per_action,
        salt=["source_patient_id", "source_time_step"], name="example_rank", row_bound=row_bound,
    )
    return best.orderBy(action_index("preferred_action", spec.actions), "example_rank")


def assert_contrastive_source(df: DataFrame, rules: ContrastiveRules, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    values = [v for m in rules.models for v in spec.indexed(m)]
    return assert_selection_source(df, spec.indexed(rules.behavior), values, spec=spec)


def build_contrastive_examples(
    df: DataFrame, rules: ContrastiveRules = ContrastiveRules(), *,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    assert_contrastive_source(df, rules, spec)
    staged = contrastive_stages(df, rules, spec)
    return balance_candidates(contrastive_candidates(staged, rules, spec), rules, row_bound, spec)


def action_table(df: DataFrame, spec: TrajectorySpec) -> DataFrame:
    """One row per canonical action."""
    return df.sparkSession.createDataFrame(
        [(i, a) for i, a in enumerate(spec.actions)], "action_order int, action string"
    )


def contrastive_readiness(
    candidates: DataFrame, selected: DataFrame, rules: ContrastiveRules = ContrastiveRules(),
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Counts per action before and after the cap; an action without rows shows zero."""
    before = candidates.groupBy(F.col("preferred_action").alias("action")).agg(
        F.count("*").alias("candidates_before_balance"))
    after = selected.groupBy(F.col("preferred_action").alias("action")).agg(
        F.count("*").alias("selected_examples"))
    counts = (
        action_table(candidates, spec).join(before, "action", "left").join(after, "action", "left")
        .fillna(0, ["candidates_before_balance", "selected_examples"])
    )
    return counts.withColumn(
        "underrepresented", F.col("selected_examples") < rules.minimum_examples_per_action
    ).drop("action_order")


def contrastive_report(
    df: DataFrame, rules: ContrastiveRules = ContrastiveRules(), *,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Thresholds, funnel, readiness and quantile summaries as one long frame."""
    assert_contrastive_source(df, rules, spec)
    staged = contrastive_stages(df, rules, spec)
    candidates = contrastive_candidates(staged, rules, spec)
    # at most the cap times the actions: written once, read by every section below
    selected = cut(balance_candidates(candidates, rules, row_bound, spec), "contrastive-selected")
    low = below(spec.pressure, spec.low_pressure)
    selected_bound = rules.max_examples_per_action * len(spec.actions)
    ready = contrastive_readiness(candidates, selected, rules, spec)
    thresholds = df.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in (
            ("minimum_propensity", rules.minimum_propensity),
            ("minimum_advantage", rules.minimum_advantage),
            ("maximum_value_disagreement", rules.maximum_value_disagreement),
            ("max_examples_per_action", rules.max_examples_per_action),
            ("require_preferred_matches_logged", rules.require_preferred_matches_logged),
            ("minimum_examples_per_action", rules.minimum_examples_per_action),
            ("minimum_logged_reward", rules.minimum_logged_reward),
        ) if v is not None],
        "name string, value double",
    )
    summary = quantile_summary(selected, QUANTIFIED, row_bound=selected_bound)
    return union_long([
        thresholds.selectExpr(
            "'thresholds' AS section", "CAST(NULL AS STRING) AS model", "CAST(NULL AS STRING) AS slice",
            "CAST(NULL AS STRING) AS action", "CAST(NULL AS STRING) AS fold", "name AS metric", "value"),
        to_long(contrastive_funnel(staged), ["source_rows", *STAGES], section="selection_stages"),
        to_long(ready.withColumn("under", F.col("underrepresented").cast("int")),
                ["candidates_before_balance", "selected_examples", "under"],
                section="readiness", action=F.col("action")),
        to_long(ready.agg((F.max(F.col("underrepresented").cast("int")) == 0).cast("int").alias("approved")),
                ["approved"], section="readiness"),
        to_long(
            selected.agg(
                rate(F.col("preferred_matches_logged")).alias("preferred_matches_logged_rate"),
                count_if(low).alias("low_pressure_rows"),
                F.coalesce(rate(low), F.lit(0.0)).alias("low_pressure_rate"),
            ),
            ["preferred_matches_logged_rate", "low_pressure_rows", "low_pressure_rate"],
            section="selected",
        ),
        to_long(df.agg(rate(low).alias("low_pressure_rate")), ["low_pressure_rate"], section="source"),
        to_long(summary, ["min", "p25", "median", "p75", "max"], section="quantiles",
                slice=F.col("variable")),
    ])
