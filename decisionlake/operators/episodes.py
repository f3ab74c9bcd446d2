"""Episodes: the rows of one patient in step order, and replay of logged transitions.

A logged outcome stays with the logged action; nothing here steps with another action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.reward import RewardFunction, RewardSpec, with_reward
from decisionlake.operators.scale import TASK_ROWS, neighbours
from decisionlake.spec import DEFAULT, TrajectorySpec


def sort_episodes(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Global order by (patient, step): ranges, not hashes, so a long episode may span tasks."""
    return df.repartitionByRange(*spec.key).sortWithinPartitions(*spec.key)


def episode_metadata(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    noted = spec.note in df.columns
    return df.filter(F.col(spec.patient).isNotNull()).groupBy(spec.patient).agg(
        F.count("*").alias("episode_length"),
        F.min(spec.step).alias("first_time_step"),
        F.lit(noted).alias("handoff_note_available"),
    )


def first_observations(
    df: DataFrame, patient: str | None = None, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """First pre-action observation of every episode, or of one known patient."""
    df = df.filter(F.col(spec.patient).isNotNull())
    if patient is not None:
        df = df.filter(F.col(spec.patient) == patient)
        if df.isEmpty():
            raise ValueError(f"Unknown patient: {patient!r}")
    first = df.groupBy(spec.patient).agg(
        F.min(spec.step).alias(spec.step),
        F.min_by(F.struct(*spec.observations), spec.step).alias("_first"),
    )
    return first.select(*spec.key, "_first.*")


def sample_episodes(
    df: DataFrame, n: int, seed: int = 42, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """``n`` patients in the order of a seeded hash: reproducible on any partitioning."""
    patients = df.filter(F.col(spec.patient).isNotNull()).select(spec.patient).distinct()
    return patients.orderBy(
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(spec.patient))), spec.patient
    ).limit(n)


def _sound_transition(spec: TrajectorySpec) -> Column:
    """True, or an error: steps are unique, actions known, and the last row of an episode is its one terminal row."""
    following, terminal = F.col("_next"), F.coalesce(F.col(spec.terminal), F.lit(-1))
    patient = F.coalesce(F.col(spec.patient).cast("string"), F.lit("null"))
    problem = (
        F.when(following.isNotNull() & following[spec.step].eqNullSafe(F.col(spec.step)),
               F.concat(F.lit("Duplicate transition of patient "), patient))
        .when(F.col(spec.action).isNotNull() & ~F.col(spec.action).isin(*spec.actions),
              F.concat(F.lit("Unknown logged action: "), F.col(spec.action)))
        .when(~terminal.isin(0, 1) | ((terminal == 1) == following.isNotNull()),
              F.concat(F.lit("Each patient must have exactly one terminal transition, at the end; invalid patient "), patient))
    )
    return F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))


def logged_transitions(
    df: DataFrame,
    reward: RewardSpec | RewardFunction | None = None,
    *,
    row_bound: int | None = None,
    task_rows: int = TASK_ROWS,
    validated: bool = False,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """One row per logged transition: state, action, reward, next state, done.

    ``next_state`` is the next present row of the episode, whatever its step, and NULL
    at a terminal row. Unless the rows are ``validated`` already, the replay checks itself: each row is
    held against the next one of its episode, which its window brings along, and the query fails at the
    first row that no episode may have. That takes no further scan.
    """
    scored = with_reward(
        df.filter(F.col(spec.patient).isNotNull()), reward, "_reward", spec
    )
    linked = neighbours(
        scored,
        spec.patient,
        spec.step,
        ahead=("_next", (spec.step, *spec.observations)),
        row_bound=row_bound,
        task_rows=task_rows,
    )
    if not validated:
        linked = linked.filter(_sound_transition(spec))
    going_on = F.col(spec.terminal) != 1
    return linked.select(
        *spec.key,
        F.struct(*spec.observations).alias("state"),
        F.col(spec.action).alias("action"),
        F.col("_reward").alias("reward"),
        F.when(going_on, F.col("_next")[spec.step]).alias("next_time_step"),
        F.when(
            going_on & F.col("_next").isNotNull(),
            F.struct(*[F.col("_next")[c].alias(c) for c in spec.observations]),
        ).alias("next_state"),
        (F.col(spec.terminal) == 1).alias("done"),
        F.lit(True).alias("logged_transition"),
    )
