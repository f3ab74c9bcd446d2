"""Factual outcome library: supported favorable and unfavorable examples of each action.

Labels are relative to the rewards seen under the same logged action. They are
associations, not statements about the best action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import action_index, below, pick, rate
from decisionlake.operators.metrics import quantile_summary, side_by_side, to_long, union_long
from decisionlake.operators.scale import group_quantiles, top_per_group
from decisionlake.operators.validate import assert_selection_source, require_columns
from decisionlake.sources.storage import cut
from decisionlake.spec import DEFAULT, TrajectorySpec

# The two labels, in library order.
LABELS = ("favorable", "unfavorable")


@dataclass(frozen=True)
class FactualRules:
    lower_reward_quantile: float = 0.25
    upper_reward_quantile: float = 0.75
    minimum_logged_propensity: float = 0.02
    max_examples_per_cell: int = 100
    minimum_examples_per_cell: int = 20
    behavior: str = "b"

    def __post_init__(self):
        if not 0.0 <= self.lower_reward_quantile < self.upper_reward_quantile <= 1.0:
            raise ValueError("The lower reward quantile must lie below the upper one, both within 0 and 1.")
        if not 0.0 <= self.minimum_logged_propensity <= 1.0:
            raise ValueError("minimum_logged_propensity is a probability.")
        if self.max_examples_per_cell <= 0 or self.minimum_examples_per_cell <= 0:
            raise ValueError("Caps and minimum counts must be at least one.")


def reward_thresholds(
    df: DataFrame, rules: FactualRules = FactualRules(), *, row_bound: int | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """``action, lower, upper, logged_rows`` over all rows of each action."""
    rows = df.select(F.col(spec.action).alias("action"), spec.reward)
    q = group_quantiles(
        rows, ["action"], [spec.reward],
        (rules.lower_reward_quantile, rules.upper_reward_quantile), row_bound=row_bound,
    ).select(
        "action",
        F.col(f"{spec.reward}_q")[0].alias("lower"),
        F.col(f"{spec.reward}_q")[1].alias("upper"),
    )
    return side_by_side(["action"], q, rows.groupBy("action").agg(F.count("*").alias("logged_rows")))


def outcome_labels(
    df: DataFrame, thresholds: DataFrame, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """One row per label a row earns; with tied thresholds a row earns both."""
    reward = F.col(spec.reward)
    # One row per action on the broadcast side.
    labelled = df.join(F.broadcast(thresholds), F.col(spec.action) == F.col("action"))
    return labelled.withColumn(
        "outcome_label",
        F.explode(F.array_compact(F.array(
            F.when(reward >= F.col("upper"), F.lit(LABELS[0])),
            F.when(reward <= F.col("lower"), F.lit(LABELS[1])),
        ))),
    ).drop("lower", "upper", "logged_rows")


def _order(spec: TrajectorySpec):
    """Best first for favorable, worst first for unfavorable; then support, then key."""
    signed = F.when(F.col("outcome_label") == LABELS[0], -F.col(spec.reward)).otherwise(F.col(spec.reward))
    return [signed, F.desc("logged_action_propensity"), spec.patient, spec.step]


def supported_candidates(
    df: DataFrame, thresholds: DataFrame, rules: FactualRules = FactualRules(),
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    propensity = pick(spec.indexed(rules.behavior), action_index(spec.action, spec.actions))
    supported = df.withColumn("logged_action_propensity", propensity).filter(
        F.col("logged_action_propensity") >= rules.minimum_logged_propensity
    )
    return outcome_labels(supported, thresholds, spec)


def one_per_patient(candidates: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    # Spark keeps one row per (cell, patient) and task before the shuffle.
    return top_per_group(
        candidates, ["action", "outcome_label", spec.patient], _order(spec), 1, name="_one"
    ).drop("_one")


def factual_library(
    df: DataFrame, rules: FactualRules = FactualRules(), *, row_bound: int | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """The capped library in cell order. Rewards are used to pick and then dropped.

    ``library_rank`` records that order, on which retrieval ties depend.
    """
    assert_selection_source(df, spec.indexed(rules.behavior), spec=spec)
    thresholds = reward_thresholds(df, rules, row_bound=row_bound, spec=spec)
    kept = one_per_patient(supported_candidates(df, thresholds, rules, spec), spec)
    best = top_per_group(
        kept, ["action", "outcome_label"], _order(spec), rules.max_examples_per_cell,
        salt=[spec.patient], name="_place", row_bound=row_bound,
    )
    cell = action_index("action", spec.actions) * len(LABELS) + F.when(
        F.col("outcome_label") == LABELS[0], 0
    ).otherwise(1)
    return best.select(
        F.col(spec.patient).alias("source_patient_id"),
        F.col(spec.step).alias("source_time_step"),
        F.col("fold").alias("cross_fit_fold"),
        *spec.observations,
        "action",
        "outcome_label",
        "logged_action_propensity",
        (cell * rules.max_examples_per_cell + F.col("_place") - 1).cast("bigint").alias("library_rank"),
    ).orderBy("library_rank")


def factual_readiness(
    df: DataFrame, library: DataFrame, rules: FactualRules = FactualRules(), *,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Counts per cell: labelled and supported rows, patients among them, selected rows."""
    thresholds = reward_thresholds(df, rules, row_bound=row_bound, spec=spec)
    cells = df.sparkSession.createDataFrame(
        [(a, label) for a in spec.actions for label in LABELS], "action string, outcome_label string"
    )
    keys = ["action", "outcome_label"]
    candidates = supported_candidates(df, thresholds, rules, spec).groupBy(*keys).agg(
        F.count("*").alias("candidates_after_support"),
        F.count_distinct(spec.patient).alias("candidates_after_patient_deduplication"),
    )
    selected = library.groupBy(*keys).agg(F.count("*").alias("selected_examples"))
    counts = ["candidates_after_support", "candidates_after_patient_deduplication", "selected_examples"]
    return (
        cells.join(candidates, keys, "left").join(selected, keys, "left").fillna(0, counts)
        .withColumn("insufficient", F.col("selected_examples") < rules.minimum_examples_per_cell)
    )


def factual_report(
    df: DataFrame, library: DataFrame, rules: FactualRules = FactualRules(), *,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Thresholds, cell counts, readiness and support of the library in the long layout."""
    low = below(spec.pressure, spec.low_pressure)
    library = cut(library, "factual-library")
    ready = factual_readiness(df, library, rules, row_bound=row_bound, spec=spec)
    cap = rules.max_examples_per_cell * len(spec.actions) * len(LABELS)
    return union_long([
        to_long(reward_thresholds(df, rules, row_bound=row_bound, spec=spec),
                ["lower", "upper", "logged_rows"], section="thresholds", action=F.col("action")),
        to_long(ready.withColumn("under", F.col("insufficient").cast("int")),
                ["candidates_after_support", "candidates_after_patient_deduplication",
                 "selected_examples", "under"],
                section="cells", action=F.col("action"), slice=F.col("outcome_label")),
        to_long(ready.agg((F.max(F.col("insufficient").cast("int")) == 0).cast("int").alias("approved")),
                ["approved"], section="readiness"),
        to_long(library.agg(F.count("*").alias("selected_rows"),
                            F.count_distinct("source_patient_id").alias("unique_source_patients"),
                            rate(low).alias("low_pressure_rate")),
                ["selected_rows", "unique_source_patients", "low_pressure_rate"], section="library"),
        to_long(df.agg(rate(low).alias("low_pressure_rate")), ["low_pressure_rate"], section="source"),
        to_long(quantile_summary(library, ["logged_action_propensity"], row_bound=cap),
                ["min", "p25", "median", "p75", "max"], section="logged_action_propensity"),
    ])


def assert_library(library: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Columns present, non-empty, actions and labels in their domains."""
    require_columns(library, [*spec.observations, "source_patient_id", "action", "outcome_label"])
    row = library.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.coalesce(F.col("action").isin(*spec.actions), F.lit(False))).alias("actions"),
        F.count_if(~F.coalesce(F.col("outcome_label").isin(*LABELS), F.lit(False))).alias("labels"),
    ).first()
    if row["rows"] == 0:
        raise ValueError("The library must be non-empty.")
    if row["actions"] or row["labels"]:
        raise ValueError("The library contains unknown actions or outcome labels.")
    return library
