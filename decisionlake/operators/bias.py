"""Do the reward models favour an action whatever the state? Rankings against logged data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import (
    action_index, argmax, below, count_if, finite, pick, rate,
)
from decisionlake.operators.metrics import (
    QUARTILE_NAMES, columns, entries, in_one_pass, quantile_summary, reward_quantiles, reward_summary,
    side_by_side, to_long, union_long, unpivoted,
)
from decisionlake.operators.validate import assert_selection_source
from decisionlake.spec import DEFAULT, TrajectorySpec

MODELS = ("ridge", "nonlinear")
SUPPORT = 0.02


def ranked_rows(
    df: DataFrame, models: Sequence[str] = MODELS, behavior: str = "b", spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """One row per (row, model): its top action, that action's propensity, its margin.

    The margin is the best value of any other action minus the value of the first one.
    """
    b = spec.indexed(behavior)

    def view(model: str) -> Column:
        values = spec.indexed(model)
        top = argmax(values)
        rest = values[1:]
        best = F.greatest(*rest) if len(rest) > 1 else F.col(rest[0])
        return F.struct(
            F.lit(model).alias("model"),
            top.alias("top"),
            pick(b, top).alias("top_propensity"),
            (best - F.col(values[0])).alias("margin"),
            *[F.col(v).alias(f"value_{i}") for i, v in enumerate(values)],
        )

    kept = [spec.patient, spec.action, spec.pressure, spec.lactate, spec.vasopressor, spec.reward]
    return df.select(
        *kept, F.explode(F.array(*[view(m) for m in models])).alias("m")
    ).select(*kept, "m.*")


def bias_observed(
    df: DataFrame, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Reward summary per logged action."""
    return reward_summary(
        df.select(F.col(spec.action).alias("action"), spec.reward), spec.reward, ["action"], row_bound
    )


def _rates_per_action(grouped, spec: TrajectorySpec, keys: Sequence[str]) -> DataFrame:
    """Top-action rate and mean value, one row per (keys, action)."""
    wide = grouped.agg(*[
        F.struct(
            F.lit(a).alias("action"),
            rate(F.col("top") == i).alias("top_action_rate"),
            F.avg(f"value_{i}").alias("mean_modeled_value"),
        ).alias(f"_{i}")
        for i, a in enumerate(spec.actions)
    ])
    return wide.select(
        *keys, F.explode(F.array(*[f"_{i}" for i in range(len(spec.actions))])).alias("e")
    ).select(*keys, "e.*")


def bias_global(ranked: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    return _rates_per_action(ranked.groupBy("model"), spec, ["model"])


def bias_propensity(ranked: DataFrame, row_bound: int | None = None) -> DataFrame:
    """Support of the top action per model: quartiles and the share below 0.02."""
    q = quantile_summary(ranked, ["top_propensity"], ["model"], row_bound).drop("variable")
    low = ranked.groupBy("model").agg(
        rate(F.col("top_propensity") < SUPPORT).alias("below_support_rate")
    )
    return side_by_side(["model"], q, low)


def bias_agreement(
    df: DataFrame, models: Sequence[str] = MODELS, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Share of rows on which both models agree, and what they agree on."""
    rows = df.select(*[argmax(spec.indexed(m)).alias(m) for m in models])
    agreed = F.col(models[0]) == F.col(models[1])
    n = count_if(agreed)
    return rows.agg(
        F.count("*").alias("rows"),
        rate(agreed).alias("top_action_agreement_rate"),
        *[
            F.when(n == 0, 0.0).otherwise(
                count_if(agreed & (F.col(models[0]) == i)) / F.when(n != 0, n)
            ).alias(f"agreed_top_rate_{i}")
            for i in range(len(spec.actions))
        ],
    )


def bias_matrix(ranked: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Rates of the model's top action given the logged action."""
    return ranked.groupBy("model", F.col(spec.action).alias("logged_action")).agg(
        F.count("*").alias("rows"),
        *[rate(F.col("top") == i).alias(f"top_rate_{i}") for i in range(len(spec.actions))],
    )


def bias_maintain(
    ranked: DataFrame, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Rows logged with the first action: margin and proposed-action support per model."""
    rows = ranked.filter(F.col(spec.action) == spec.actions[0])
    means = rows.groupBy("model").agg(
        F.count("*").alias("rows"),
        *[rate(F.col("top") == i).alias(f"top_rate_{i}") for i in range(len(spec.actions))],
        rate(F.col("top_propensity") < SUPPORT).alias("below_support_rate"),
    )
    return side_by_side(["model"], means, _maintain_quantiles(rows, row_bound))


def _maintain_quantiles(rows: DataFrame, row_bound: int | None) -> DataFrame:
    q = quantile_summary(rows, ["margin", "top_propensity"], ["model"], row_bound)
    return q.groupBy("model").agg(*[
        F.max(F.when(F.col("variable") == v, F.col(n))).alias(f"{short}_{n}")
        for v, short in (("margin", "margin"), ("top_propensity", "propensity"))
        for n in QUARTILE_NAMES
    ])


def slice_families(spec: TrajectorySpec = DEFAULT) -> dict[str, dict[str, Column]]:
    """State slices by family; those of one family exclude each other."""
    pressure, lactate, drug = F.col(spec.pressure), F.col(spec.lactate), F.col(spec.vasopressor)
    measured = F.coalesce(finite(lactate), F.lit(False))
    return {
        "pressure": {
            "map_below_65": below(spec.pressure, 65.0),
            "map_65_to_75": (pressure >= 65.0) & (pressure < 75.0),
            "map_at_least_75": pressure >= 75.0,
        },
        "lactate": {
            "lactate_at_most_2": measured & (lactate <= 2.0),
            "lactate_above_2": measured & (lactate > 2.0),
            "lactate_missing": ~measured,
        },
        "vasopressor": {"vasopressor_inactive": drug == 0, "vasopressor_active": drug == 1},
    }


def state_slices(spec: TrajectorySpec = DEFAULT) -> dict[str, Column]:
    """Overlapping slices: a row is in one of each family."""
    return {label: cond for family in slice_families(spec).values() for label, cond in family.items()}


def _sliced(ranked: DataFrame, spec: TrajectorySpec) -> DataFrame:
    """Rows logged with the first action, once per slice that they are in."""
    slices = F.filter(
        F.array(*[
            F.when(F.coalesce(cond, F.lit(False)), F.lit(label))
            for label, cond in state_slices(spec).items()
        ]),
        lambda s: s.isNotNull(),
    )
    return (
        ranked.filter(F.col(spec.action) == spec.actions[0])
        .select("model", "top", "margin", spec.reward, F.explode(slices).alias("slice"))
    )


def _slice_quantiles(rows: DataFrame, row_bound: int | None, spec: TrajectorySpec) -> list[DataFrame]:
    keys = ["slice", "model"]
    # A row falls in one slice of each of the three families.
    bound = None if row_bound is None else 3 * row_bound
    margins = quantile_summary(rows, ["margin"], keys, bound).drop("variable")
    rewards = reward_quantiles(rows, spec.reward, keys, bound)
    return [
        margins.select(*keys, *[F.col(n).alias(f"margin_{n}") for n in QUARTILE_NAMES]),
        rewards.select(*keys, "p10", F.col("median").alias("reward_median"), "p90"),
    ]


def bias_slices(
    ranked: DataFrame, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Per state slice and model, over rows logged with the first action."""
    rows = _sliced(ranked, spec)
    keys = ["slice", "model"]
    means = rows.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.avg(spec.reward).alias("reward_mean"),
        rate(F.col(spec.reward) >= 0).alias("favorable_rate"),
        *[rate(F.col("top") == i).alias(f"top_rate_{i}") for i in range(len(spec.actions))],
    )
    return side_by_side(keys, means, *_slice_quantiles(rows, row_bound, spec))


def _bias_means(df: DataFrame, models: Sequence[str], spec: TrajectorySpec) -> DataFrame:
    """Every count, rate and mean of the report from one scan, in the long layout."""
    first, indexes = spec.actions[0], range(len(spec.actions))
    families = list(slice_families(spec).values())
    bands = [f"_band_{n}" for n in range(len(families))]
    keyed = {"_action": F.col(spec.action)}
    for band, family in zip(bands, families):
        keyed[band] = F.coalesce(*[F.when(cond, F.lit(label)) for label, cond in family.items()])
    tops = {f"_top_{m}": argmax(spec.indexed(m)) for m in models}
    rows = df.withColumns(keyed | tops).withColumns({
        f"_support_{m}": pick(spec.indexed("b"), F.col(f"_top_{m}")) for m in models
    })
    agreed = F.col(f"_top_{models[0]}") == F.col(f"_top_{models[1]}")
    sets = [[], ["_action"], *[["_action", band] for band in bands]]
    wide = in_one_pass(rows, sets, [
        F.count("*").alias("rows"), F.avg(spec.reward).alias("mean"),
        rate(F.col(spec.reward) >= 0).alias("favorable_rate"),
        rate(agreed).alias("top_action_agreement_rate"), count_if(agreed).alias("_agreed"),
        *[count_if(agreed & (F.col(f"_top_{models[0]}") == i)).alias(f"_agreed_{i}") for i in indexes],
        *[rate(F.col(f"_top_{m}") == i).alias(f"{m}_rate_{i}") for m in models for i in indexes],
        *[F.avg(v).alias(f"{m}_value_{i}") for m in models for i, v in enumerate(spec.indexed(m))],
        *[rate(F.col(f"_support_{m}") < SUPPORT).alias(f"{m}_low") for m in models],
    ])
    overall, logged = F.col("_set") == 0, F.col("_set") == 1
    action, band = F.col("_action"), F.coalesce(*bands)
    agreement = {
        f"agreed_top_rate_{i}": F.when(F.col("_agreed") == 0, 0.0)
        .otherwise(F.col(f"_agreed_{i}") / F.when(F.col("_agreed") != 0, F.col("_agreed")))
        for i in indexes
    }
    parts = [
        (logged, entries(columns("rows", "mean", "favorable_rate"), section="observed_reward", action=action)),
        (overall, entries(columns("rows", "top_action_agreement_rate") | agreement, section="model_agreement")),
    ]
    for m in models:
        rates = {f"top_rate_{i}": F.col(f"{m}_rate_{i}") for i in indexes}
        low = {"below_support_rate": F.col(f"{m}_low")}
        parts += [
            (overall, entries({"top_action_rate": F.col(f"{m}_rate_{i}"), "mean_modeled_value": F.col(f"{m}_value_{i}")},
                              section="global_rankings", model=m, action=a))
            for i, a in enumerate(spec.actions)
        ]
        parts += [
            (overall, entries(low, section="top_action_propensity", model=m)),
            (logged, entries(columns("rows") | rates, section="logged_by_top", model=m, action=action)),
            (logged & (action == first),
             entries(columns("rows") | rates | low, section="logged_first_action", model=m)),
            ((F.col("_set") > 1) & (action == first) & band.isNotNull(),
             entries({"rows": F.col("rows"), "reward_mean": F.col("mean"), "favorable_rate": F.col("favorable_rate")} | rates,
                     section="state_slices", model=m, slice=band)),
        ]
    return unpivoted(wide, parts)


def bias_report(
    df: DataFrame, models: Sequence[str] = MODELS, row_bound: int | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Every bias diagnostic in the long metric layout: one scan for the means, one per quantile frame.

    An empty table has no rows.
    """
    values = [v for m in models for v in spec.indexed(m)]
    assert_selection_source(df, spec.indexed("b"), values, "fold" if "fold" in df.columns else None, spec)
    ranked = ranked_rows(df, models, spec=spec)
    bound = None if row_bound is None else len(models) * row_bound
    observed = df.select(F.col(spec.action).alias("action"), spec.reward)
    kept = _maintain_quantiles(ranked.filter(F.col(spec.action) == spec.actions[0]), bound)
    sliced = _slice_quantiles(_sliced(ranked, spec), bound, spec)
    model = F.col("model")
    return union_long([
        _bias_means(df, models, spec),
        to_long(reward_quantiles(observed, spec.reward, ["action"], row_bound), ["p10", "median", "p90"],
                section="observed_reward", action=F.col("action")),
        to_long(quantile_summary(ranked, ["top_propensity"], ["model"], bound), QUARTILE_NAMES,
                section="top_action_propensity", model=model),
        to_long(kept, [c for c in kept.columns if c != "model"], section="logged_first_action", model=model),
        *[
            to_long(q, [c for c in q.columns if c not in ("slice", "model")],
                    section="state_slices", model=model, slice=F.col("slice"))
            for q in sliced
        ],
    ])
