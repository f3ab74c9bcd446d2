"""Validation gates: violation frames, one report, and ``assert_*`` that raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import count_if, finite, valid_probabilities
from decisionlake.spec import DEFAULT, TrajectorySpec

TRAIN = "train"


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def require_exactly(df: DataFrame, required: Sequence[str]) -> None:
    """Both missing and unexpected fields are errors."""
    missing = sorted(set(required) - set(df.columns))
    unexpected = sorted(set(df.columns) - set(required))
    if missing or unexpected:
        raise ValueError(f"Fields must match exactly: missing={missing}, unexpected={unexpected}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("There are no rows to learn from.")


def duplicate_transitions(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    return df.groupBy(*spec.key).agg(F.count("*").alias("copies")).filter("copies > 1")


def unknown_actions(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    return (
        df.filter(~F.col(spec.action).isin(*spec.actions))
        .groupBy(F.col(spec.action).alias("action"))
        .agg(F.count("*").alias("bad_rows"))
    )


def terminal_violations(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Patients without exactly one terminal row, or whose terminal row is not the last."""
    per_patient = df.filter(F.col(spec.patient).isNotNull()).groupBy(spec.patient).agg(
        F.coalesce(F.sum(spec.terminal), F.lit(0)).cast("bigint").alias("terminal_rows"),
        F.max(F.struct(F.col(spec.step), F.col(spec.terminal))).alias("_last"),
    )
    return per_patient.select(
        spec.patient,
        "terminal_rows",
        F.coalesce(F.col("_last")[spec.terminal], F.lit(0)).cast("bigint").alias("terminal_at_last_step"),
    ).filter((F.col("terminal_rows") != 1) | (F.col("terminal_at_last_step") != 1))


def split_violations(df: DataFrame, split: str = TRAIN, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    return (
        df.filter(~F.col(spec.split).eqNullSafe(split))
        .groupBy(spec.split)
        .agg(F.count("*").alias("bad_rows"))
    )


def probability_violations(
    df: DataFrame, columns: Sequence[str], tolerance: float = 1e-9, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Rows whose vector is not a distribution (1e-9 for models, 1e-6 for contexts)."""
    return df.filter(~valid_probabilities(list(columns), tolerance))


def validation_report(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """``rule, violations`` for every data rule; row rules share one pass."""
    action, split = F.col(spec.action), F.col(spec.split)
    rules = {
        "missing_patient": count_if(F.col(spec.patient).isNull()),
        "missing_action": count_if(action.isNull()),
        "missing_split": count_if(split.isNull()),
        "unknown_action": count_if(action.isNotNull() & ~action.isin(*spec.actions)),
        "not_train": count_if(split.isNotNull() & (split != TRAIN)),
        "empty_table": F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint"),
    }
    for i, name in enumerate(spec.actions):
        rules[f"absent_action_{name}"] = F.when(
            count_if(action == name) == 0, 1
        ).otherwise(0).cast("bigint")
    row = df.agg(*[c.alias(r) for r, c in rules.items()])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules
    ])).alias("e")).select("e.*")
    duplicates = duplicate_transitions(df, spec).agg(
        F.lit("duplicate_key").alias("rule"), F.count("*").alias("violations")
    )
    terminals = terminal_violations(df, spec).agg(
        F.lit("terminal_rule").alias("rule"), F.count("*").alias("violations")
    )
    return stacked.unionByName(duplicates).unionByName(terminals)


def _raise(problems: list[str]) -> None:
    if problems:
        raise ValueError("; ".join(problems))


def assert_trajectories(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Replay input: columns present, unique keys, known actions, one last terminal row."""
    require_columns(df, [*spec.key, spec.action, spec.terminal, *spec.observations, *spec.outcomes])
    checked = ("missing_patient", "unknown_action", "empty_table", "duplicate_key", "terminal_rule")
    report = validation_report(
        df if spec.split in df.columns else df.withColumn(spec.split, F.lit(TRAIN)), spec
    ).filter(F.col("rule").isin(*checked) & (F.col("violations") > 0))
    _raise([f"{r['rule']}: {r['violations']}" for r in report.collect()])
    return df


def assert_training(df: DataFrame, all_actions: bool = False, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Fit input: non-empty, train split only, known and present actions and patients."""
    require_columns(df, [*spec.key, spec.action, spec.split, *spec.observations])
    action, split = F.col(spec.action), F.col(spec.split)
    row = df.agg(
        F.count("*").alias("rows"),
        count_if(~split.eqNullSafe(F.lit(TRAIN))).alias("other_split"),
        count_if(action.isNull() | ~action.isin(*spec.actions)).alias("bad_action"),
        count_if(F.col(spec.patient).isNull()).alias("no_patient"),
        *[count_if(action == a).alias(f"has_{i}") for i, a in enumerate(spec.actions)],
    ).first()
    problems = []
    if row["rows"] == 0:
        problems.append("The input must be non-empty.")
    if row["other_split"]:
        problems.append("Rows of other splits than train are not allowed here.")
    if row["bad_action"]:
        problems.append("Some logged actions are NULL or not in the action set.")
    if row["no_patient"]:
        problems.append("Some rows have no patient.")
    absent = [a for i, a in enumerate(spec.actions) if row[f"has_{i}"] == 0]
    if all_actions and row["rows"] and absent:
        problems.append(f"No training row has these actions: {absent}")
    _raise(problems)
    return df


def assert_probabilities(
    df: DataFrame, columns: Sequence[str], tolerance: float = 1e-9, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    if not probability_violations(df, columns, tolerance, spec).isEmpty():
        raise ValueError("Every probability row must be finite, non-negative and sum to one.")
    return df


def assert_estimates(
    df: DataFrame, probabilities: Sequence[str], values: Sequence[str], fold: str = "fold"
) -> DataFrame:
    """Cross-fit context: distributions at 1e-6, finite values, a fold on every row."""
    bad_value = F.lit(False)
    for v in values:
        bad_value = bad_value | ~F.coalesce(finite(F.col(v)), F.lit(False))
    row = df.agg(
        count_if(~valid_probabilities(list(probabilities), 1e-6)).alias("p"),
        count_if(bad_value).alias("v"),
        count_if(F.col(fold).isNull() | (F.col(fold) < 1)).alias("f"),
    ).first()
    problems = []
    if row["p"]:
        problems.append(f"{row['p']} invalid probability rows")
    if row["v"]:
        problems.append(f"{row['v']} rows with non-finite values")
    if row["f"]:
        problems.append(f"{row['f']} rows without a fold")
    _raise(problems)
    return df


def assert_selection_source(
    df: DataFrame, probabilities: Sequence[str] = (), values: Sequence[str] = (), fold: str | None = "fold",
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """What libraries and bias reports are built from: training rows with finite rewards and valid
    out-of-fold estimates. A report on estimates without folds passes ``fold=None``."""
    require_columns(df, [spec.reward, *probabilities, *values])
    assert_training(df, spec=spec)
    checked = df if fold else df.withColumn("_fold", F.lit(1))
    assert_estimates(checked, probabilities, [spec.reward, *values], fold or "_fold")
    return df


def split_leakage(
    df: DataFrame, left: str = TRAIN, right: str = "validation", spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Patients present in both splits, from one scan and one combined shuffle."""
    flags = [F.max((F.col(spec.split) == s).cast("int")).alias(n) for n, s in (("_left", left), ("_right", right))]
    both = df.filter(F.col(spec.split).isin(left, right)).groupBy(spec.patient).agg(*flags)
    return both.filter("_left = 1 AND _right = 1").select(spec.patient)
