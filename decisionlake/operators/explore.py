"""Exploration: case selection and descriptive tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.functions.vectors import below, rate
from decisionlake.operators.metrics import side_by_side
from decisionlake.operators.scale import group_quantiles
from decisionlake.spec import DEFAULT, TrajectorySpec

VITALS = ("map_mm_hg", "lactate_mmol_l", "heart_rate", "urine_output_6h_ml", "vasopressor_active_pre_action")
LABS = ("lactate_mmol_l", "urine_output_6h_ml", "creatinine_mg_dl")


def diverse_rows(df: DataFrame, limit: int = 12, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """A fixed priority of interesting states, two each, then rows in key order.

    A row keeps the first reason it qualifies for; ties follow the key order. Every reason takes a scan in which
    tasks keep their best few rows; no task sorts its input.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    pressure, lactate = F.col(spec.pressure), F.col(spec.lactate)
    fluids = F.col(spec.fluids)
    fill = "deterministic_fill"
    nothing = F.lit(0.0)
    # reason, condition, what to sort by first (descending where negated)
    branches = [
        ("lowest_map", pressure.isNotNull(), pressure),
        ("map_near_65", pressure.isNotNull(), F.abs(pressure - spec.low_pressure)),
        ("highest_lactate", lactate.isNotNull(), -lactate),
        ("missing_lactate", lactate.isNull(), nothing),
        ("vasopressor_active", F.col(spec.vasopressor) == 1, nothing),
        ("recent_iv_fluids", fluids > 0, -fluids),
        (fill, F.lit(True), nothing),
    ]
    most = limit + 2 * (len(branches) - 1)
    kept = []
    for priority, (reason, condition, order) in enumerate(branches):
        fits = df.filter(condition).select(
            *spec.key, *spec.observations, F.lit(priority).alias("_priority"), F.lit(reason).alias("selection_reason"),
            order.cast("double").alias("_order"),
        )
        kept.append(fits.orderBy("_order", *spec.key).limit(most if reason == fill else 2))
    flagged = reduce(DataFrame.unionByName, kept)
    best = Window.partitionBy("_priority").orderBy("_order", *spec.key)
    picked = flagged.withColumn("_rank", F.row_number().over(best))
    # At most a few dozen rows from here on.
    first = Window.partitionBy(*spec.key).orderBy("_priority", "_rank")
    unique = picked.withColumn("_seen", F.row_number().over(first)).filter("_seen = 1")
    place = Window.partitionBy(F.lit(0)).orderBy("_priority", "_rank")
    return (
        unique.withColumn("selection_order", F.row_number().over(place).cast("bigint"))
        .filter(F.col("selection_order") <= limit)
        .drop("_priority", "_order", "_rank", "_seen")
    )


def describe(df: DataFrame, columns: Sequence[str], row_bound: int | None = None) -> DataFrame:
    """``variable, count, mean, std, min, p25, median, p75, max`` with exact quantiles."""
    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("variable"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in columns
    ])
    moments = wide.select(F.explode(F.array(*columns)).alias("e")).select("e.*")
    q = group_quantiles(df, [], columns, (0.25, 0.5, 0.75), row_bound=row_bound).select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(f"{c}_q").alias("q")) for c in columns
        ])).alias("e")
    ).select("e.variable", *[
        F.try_element_at("e.q", F.lit(i + 1)).alias(n) for i, n in enumerate(("p25", "median", "p75"))
    ])
    return side_by_side(["variable"], moments, q)


def value_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of every value of each column, NULL included as a value."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("level")) for c in columns
    ])).alias("e")).select("e.*")
    counts = long.groupBy("variable", "level").agg(F.count("*").alias("rows"))
    # A few levels per column.
    everything = Window.partitionBy("variable")
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(everything))


def grouped_means(
    df: DataFrame, columns: Sequence[str], by: Sequence[str | Column], digits: int,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Rounded means; rows without a logged action belong to no group."""
    return (
        df.filter(F.col(spec.action).isNotNull())
        .groupBy(*by)
        .agg(*[(F.round(F.avg(c), digits) + F.lit(0.0)).alias(f"mean_{c}") for c in columns])
    )


def means_by_action(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Outcome means to three digits and vital means to two, in one pass."""
    rounded = [(c, 3) for c in spec.outcomes] + [(c, 2) for c in VITALS]
    return df.filter(F.col(spec.action).isNotNull()).groupBy(F.col(spec.action).alias("action")).agg(
        *[(F.round(F.avg(c), d) + F.lit(0.0)).alias(f"mean_{c}") for c, d in rounded]
    )


def means_by_low_pressure_action(df: DataFrame, spec: TrajectorySpec = DEFAULT) -> DataFrame:
    low = below(spec.pressure, spec.low_pressure).alias("low_map")
    return grouped_means(df, spec.outcomes, [low, F.col(spec.action).alias("action")], 3, spec)


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every unordered pair, pairwise complete, as rows."""
    wide = df.agg(*[
        F.struct(
            F.lit(a).alias("x"), F.lit(b).alias("y"),
            (F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), digits) + F.lit(0.0)).alias("r"),
        ).alias(f"_{i}")
        for i, (a, b) in enumerate(combinations(columns, 2))
    ])
    return wide.select(F.explode(F.array(*wide.columns)).alias("e")).select("e.*")


def null_rates_by_action(
    df: DataFrame, columns: Sequence[str] = LABS, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    return df.filter(F.col(spec.action).isNotNull()).groupBy(F.col(spec.action).alias("action")).agg(
        *[rate(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )
