"""Reward of a logged transition as a Column expression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import clip, finite
from decisionlake.spec import DEFAULT, TrajectorySpec


@dataclass(frozen=True)
class RewardSpec:
    """Weights of the reward; other specifications are other instances."""

    # Scales, clip and weights of the default reward.
    pressure_scale: float = 5.0
    lactate_scale: float = 0.5
    bound: float = 2.0
    pressure_weight: float = 0.4
    lactate_weight: float = 0.4
    deterioration_penalty: float = 2.0
    adverse_penalty: float = 1.5

    def column(self, spec: TrajectorySpec = DEFAULT) -> Column:
        pressure, lactate, deterioration, *adverse = spec.outcomes
        value = (
            F.lit(self.pressure_weight) * clip(F.col(pressure) / F.lit(self.pressure_scale), self.bound)
            - F.lit(self.lactate_weight) * clip(F.col(lactate) / F.lit(self.lactate_scale), self.bound)
            - F.lit(self.deterioration_penalty) * F.col(deterioration)
        )
        for event in adverse:
            value = value - F.lit(self.adverse_penalty) * F.col(event)
        return value


#: A variant that weighs harm more and physiology less, for sensitivity runs.
SAFETY_FIRST = RewardSpec(pressure_weight=0.2, lactate_weight=0.2,
                          deterioration_penalty=3.0, adverse_penalty=2.5)

RewardFunction = Callable[[DataFrame], Column]


def compute_reward(spec: TrajectorySpec = DEFAULT) -> Column:
    return RewardSpec().column(spec)


def with_reward(df: DataFrame, reward: RewardSpec | RewardFunction | None = None,
                name: str = "reward", spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Add the reward target.

    A supplied ``reward`` column wins when no specification is given; text in it that is
    not a number becomes NULL. Otherwise the specification, or any callable from
    frame to Column, is evaluated.
    """
    if reward is None and spec.reward in df.columns:
        return df.withColumn(name, F.col(spec.reward).try_cast("double"))
    if reward is None:
        reward = RewardSpec()
    if isinstance(reward, RewardSpec):
        missing = sorted(set(spec.outcomes) - set(df.columns))
        if missing:
            raise ValueError(f"Cannot compute rewards because outcome columns are missing: {missing}")
        return df.withColumn(name, reward.column(spec))
    return df.withColumn(name, reward(df))


def require_finite_reward(df: DataFrame, name: str = "reward") -> DataFrame:
    """Raise when any reward is missing or not finite."""
    if not df.filter(~F.coalesce(finite(F.col(name)), F.lit(False))).limit(1).isEmpty():
        raise ValueError("Rewards must be finite.")
    return df
