"""Off-policy evaluation of policies over logged rows.

A row carries the target policy's probabilities, behaviour probabilities and modelled
values. Modelled values of unlogged actions are estimates; the only observed reward used
is that of the logged action.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.functions.reward import RewardSpec
from decisionlake.functions.vectors import (
    action_index, argmax, as_columns, below, count_if, pick, rate, total,
)
from decisionlake.spec import DEFAULT, TrajectorySpec

CLIPS = (10.0, 20.0)


def direct_value(policy: Sequence[str], values: Sequence[str]) -> Column:
    """Expected modelled value of the policy in one state."""
    return total([p * v for p, v in zip(as_columns(policy), as_columns(values))])


def importance_weight(
    policy: Sequence[str], behavior: Sequence[str], spec: TrajectorySpec = DEFAULT
) -> Column:
    """Unclipped ratio of target to behaviour probability of the logged action."""
    a = action_index(spec.action, spec.actions)
    return pick(policy, a) / pick(behavior, a)


def scored_rows(
    df: DataFrame, policy: Sequence[str], behavior: Sequence[str], values: Sequence[str], *,
    reward: Column | str | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Add ``dm``, ``ratio``, ``observed`` and ``residual`` (observed minus modelled)."""
    observed = F.col(spec.reward) if reward is None else (F.col(reward) if isinstance(reward, str) else reward)
    modelled = pick(values, action_index(spec.action, spec.actions))
    return df.withColumns({
        "dm": direct_value(policy, values),
        "ratio": importance_weight(policy, behavior, spec),
        "observed": observed,
    }).withColumn("residual", F.col("observed") - modelled)


def _clipped(df: DataFrame, clips: Sequence[float]) -> DataFrame:
    """One row per (row, clip) with the weight ``w``."""
    return df.withColumn("clip", F.explode(F.array(*[F.lit(float(c)) for c in clips]))).withColumn(
        "w", F.least("ratio", "clip")
    )


def dm_value(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("rows"), F.avg("dm").alias("dm_value"))


def clipped_ips(scored: DataFrame, clips: Sequence[float] = CLIPS) -> DataFrame:
    """Clipped importance estimates, plain and self-normalised, per clip."""
    return _clipped(scored, clips).groupBy("clip").agg(
        F.avg(F.col("w") * F.col("observed")).alias("ips_value"),
        (F.sum(F.col("w") * F.col("observed")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("snips_value"),
    )


def dr_value(scored: DataFrame, clips: Sequence[float] = CLIPS) -> DataFrame:
    return _clipped(scored, clips).groupBy("clip").agg(
        F.avg(F.col("dm") + F.col("w") * F.col("residual")).alias("dr_value")
    )


def weight_diagnostics(
    scored: DataFrame, clips: Sequence[float] = CLIPS, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Effective sample size, largest weight and clipped share, overall and by action."""
    rows = _clipped(scored, clips).withColumn("action", F.col(spec.action))
    return rows.groupingSets([["clip", "action"], ["clip"]], "clip", "action").agg(
        F.count("*").alias("rows"),
        (F.sum("w") * F.sum("w") / F.nullif(F.sum(F.col("w") * F.col("w")), F.lit(0.0))).alias("ess"),
        F.max("ratio").alias("max_ratio"),
        rate(F.col("ratio") > F.col("clip")).alias("clipped_share"),
    ).withColumn("action", F.coalesce("action", F.lit("all")))


# -------------------------------------------------------------------------- bootstrap


def poisson_weight(seed: int, replicate: Column, patient: Column) -> Column:
    """A Poisson(1) count from a seeded hash: the same on any engine and partitioning."""
    text = F.concat(F.lit(f"{seed}:"), replicate.cast("string"), F.lit(":"), patient)
    u = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    out = F.lit(0)
    for i, step in enumerate(poisson_steps()):
        out = F.when(u >= F.lit(step), F.lit(i + 1)).otherwise(out)
    return out


def poisson_steps() -> list[float]:
    """Cumulative probabilities of 0..11 events at mean one."""
    steps, cumulative = [], 0.0
    for i in range(12):
        cumulative += math.exp(-1.0) / math.factorial(i)
        steps.append(cumulative)
    return steps


def bootstrap_means(
    scored: DataFrame, scores: Mapping[str, Column], *, replicates: int = 200, seed: int = 7,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Per replicate the weighted mean of each score over resampled patients.

    Patients, not rows, are resampled: rows are summed per patient first, and replicates
    are expanded from those sums and added up inside each task.
    """
    patients = scored.groupBy(spec.patient).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_{name}") for name, c in scores.items()]
    )
    expanded = patients.withColumn(
        "replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))
    ).withColumn("_w", poisson_weight(seed, F.col("replicate"), F.col(spec.patient)))
    weight = F.nullif(F.sum(F.col("_w") * F.col("_n")), F.lit(0))
    return expanded.groupBy("replicate").agg(*[
        (F.sum(F.col("_w") * F.col(f"_{name}")) / weight).alias(name) for name in scores
    ])


def bootstrap_ci(
    scored: DataFrame, scores: Mapping[str, Column], *, replicates: int = 200, seed: int = 7,
    level: float = 0.95, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """``score, mean, lower, upper`` by percentiles of the replicates.

    Pass two policies' scores and their difference together: they then share weights, and
    the difference is paired.
    """
    tail = (1.0 - level) / 2.0
    runs = bootstrap_means(scored, scores, replicates=replicates, seed=seed, spec=spec)
    long = runs.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("score"), F.col(n).alias("value")) for n in scores
    ])).alias("e")).select("e.*")
    # As many rows per score as replicates.
    return long.groupBy("score").agg(
        F.avg("value").alias("bootstrap_mean"),
        F.percentile("value", F.lit(tail)).alias("lower"),
        F.percentile("value", F.lit(1.0 - tail)).alias("upper"),
    )


# -------------------------------------------------------------------------- behaviour


def policy_entropy(df: DataFrame, policy: Sequence[str], spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Mean probability and chosen share per action, and mean entropy (0 ln 0 is 0)."""
    entropy = total([F.when(p > 0, -p * F.log(p)).otherwise(0.0) for p in as_columns(policy)])
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(entropy).alias("mean_entropy"),
        *[F.avg(p).alias(f"mean_probability_{i}") for i, p in enumerate(policy)],
        *[rate(argmax(policy) == i).alias(f"chosen_rate_{i}") for i in range(len(spec.actions))],
    )


def policy_support(
    df: DataFrame, policy: Sequence[str], behavior: Sequence[str], minimum: float = 0.02
) -> DataFrame:
    """Probability mass and chosen actions that the log barely supports."""
    weak = [b < minimum for b in as_columns(behavior)]
    mass = total([F.when(w, p).otherwise(0.0) for w, p in zip(weak, as_columns(policy))])
    chosen = pick(behavior, argmax(policy))
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(mass).alias("mean_weak_mass"),
        rate(chosen < minimum).alias("weak_choice_share"),
    )


def policy_state_slice(
    df: DataFrame, policy: Sequence[str], condition: Column | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    if condition is None:
        condition = below(spec.pressure, spec.low_pressure)
    return df.groupBy(F.coalesce(condition, F.lit(False)).alias("in_slice")).agg(
        F.count("*").alias("rows"),
        *[F.avg(p).alias(f"mean_probability_{i}") for i, p in enumerate(policy)],
        *[rate(argmax(policy) == i).alias(f"chosen_rate_{i}") for i in range(len(spec.actions))],
    )


def policy_agreement(
    left: DataFrame, right: DataFrame, policy: Sequence[str], key: Sequence[str] | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Chosen-action confusion of two policies over the same keys; every cell is present."""
    key = list(key or spec.key)
    chosen = argmax(policy)
    pairs = left.select(*key, chosen.alias("_l")).join(right.select(*key, chosen.alias("_r")), key)
    n = len(spec.actions)
    row = pairs.agg(
        F.count("*").alias("_n"),
        rate(F.col("_l") == F.col("_r")).alias("agreement_rate"),
        *[count_if((F.col("_l") == i) & (F.col("_r") == j)).alias(f"_{i}_{j}")
          for i in range(n) for j in range(n)],
    )
    return row.select(
        "agreement_rate",
        F.explode(F.array(*[
            F.struct(
                F.lit(spec.actions[i]).alias("left_action"),
                F.lit(spec.actions[j]).alias("right_action"),
                F.col(f"_{i}_{j}").alias("rows"),
            )
            for i in range(n) for j in range(n)
        ])).alias("e"),
    ).select("e.*", "agreement_rate")


def flip_rate(
    base: DataFrame, perturbed: DataFrame, policy: Sequence[str], *, kind: str = "kind",
    values: Sequence[str] | None = None, key: Sequence[str] | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Per perturbation kind: chosen-action flips, total-variation shift, value change."""
    key = list(key or spec.key)
    left = base.select(*key, argmax(policy).alias("_before"), *[F.col(p).alias(f"_{p}") for p in policy],
                       *(values or ()))
    right = perturbed.select(*key, kind, *policy)
    joined = right.join(left, key)
    shift = total([F.abs(F.col(p) - F.col(f"_{p}")) for p in policy]) / 2.0
    out = [
        F.count("*").alias("rows"),
        rate(argmax(policy) != F.col("_before")).alias("flip_rate"),
        F.avg(shift).alias("mean_total_variation"),
    ]
    if values:
        change = direct_value(policy, values) - direct_value([f"_{p}" for p in policy], values)
        out.append(F.avg(change).alias("mean_value_change"))
    return joined.groupBy(kind).agg(*out)


def reward_sensitivity(
    df: DataFrame, policies: Mapping[str, Sequence[str]], behavior: Sequence[str],
    rewards: Mapping[str, RewardSpec], clip: float = CLIPS[0], spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Self-normalised clipped value of each policy under each reward, with its rank."""
    ratios = {
        name: F.least(importance_weight(p, behavior, spec), F.lit(clip)) for name, p in policies.items()
    }
    cells = F.array(*[
        F.struct(
            F.lit(r).alias("reward_name"), F.lit(p).alias("policy"),
            reward.column(spec).alias("observed"), ratios[p].alias("w"),
        )
        for r, reward in rewards.items() for p in policies
    ])
    values = (
        df.select(F.explode(cells).alias("e")).select("e.*")
        .groupBy("reward_name", "policy")
        .agg((F.sum(F.col("w") * F.col("observed")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("snips_value"))
    )
    best = Window.partitionBy("reward_name").orderBy(F.desc("snips_value"), "policy")
    return values.withColumn("value_rank", F.row_number().over(best).cast("bigint"))
