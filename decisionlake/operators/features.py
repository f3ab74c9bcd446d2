"""Feature preparation: impute, scale and one-hot, fitted on a frame and applied as columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.prompts import sql_text
from decisionlake.operators.scale import QUANTILE_ROWS, group_quantiles, is_small
from decisionlake.spec import DEFAULT, TrajectorySpec

MAX_LEVELS = 10_000


@dataclass(frozen=True)
class FeatureStats:
    """What a fit keeps: ``(name, median, mean, scale)`` and ``(name, mode, levels)``.

    A column with no value in the fitted frame is dropped.
    """

    numeric: tuple[tuple[str, float, float, float], ...]
    categorical: tuple[tuple[str, str, tuple[str, ...]], ...]

    @property
    def names(self) -> list[str]:
        return [n for n, *_ in self.numeric] + [
            f"{n}={level}" for n, _, levels in self.categorical for level in levels
        ]

    def columns(self, scaled: bool = True) -> list[Column]:
        """Numeric block, then one indicator per level; an unknown level is all zeros."""
        # As SQL: one parse per feature instead of a dozen column calls.
        out = []
        for name, median, mean, scale in self.numeric:
            value = f"coalesce(CAST(`{name}` AS DOUBLE), {median!r}D)"
            out.append(f"({value} - ({mean!r}D)) / {scale!r}D AS `{name}`" if scaled else f"{value} AS `{name}`")
        for name, mode, levels in self.categorical:
            value = f"coalesce(`{name}`, {sql_text(mode)})"
            out += [
                f"CAST({value} = {sql_text(v)} AS DOUBLE) AS `{name}={v.replace('`', '``')}`" for v in levels
            ]
        return [F.expr(text) for text in out]


def fit_features(
    df: DataFrame, *, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT
) -> FeatureStats:
    """Exact medians first, then moments of the imputed columns; a few dozen numbers."""
    return fit_features_with(df, {}, row_bound=row_bound, spec=spec)[0]


def fit_features_with(
    df: DataFrame, also: dict[str, Column], *, row_bound: int | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> tuple[FeatureStats, dict]:
    """The fit, and further aggregates taken in its second pass."""
    if is_small(row_bound, QUANTILE_ROWS):
        known, categorical = _first_pass(df, spec)
    else:
        known, categorical = _medians(df, row_bound, spec), _levels(df, spec)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in known}
    moments = df.agg(
        F.count("*").alias("_rows"),
        *[F.avg(v).alias(f"{c}_mean") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}_sd") for c, v in filled.items()],
        *[c.alias(f"_also_{n}") for n, c in also.items()],
    ).first()
    numeric = tuple(
        (c, m, moments[f"{c}_mean"], _scale(moments[f"{c}_sd"], moments[f"{c}_mean"]))
        for c, m in known
    )
    return FeatureStats(numeric, categorical), {n: moments[f"_also_{n}"] for n in also}


def _first_pass(df: DataFrame, spec: TrajectorySpec) -> tuple[list, tuple]:
    """Medians and levels of a frame known to be small, in one aggregate."""
    row = df.agg(
        *[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in spec.numeric],
        *[F.mode(c, True).alias(f"{c}_mode") for c in spec.categorical],
        *[F.array_sort(F.collect_set(c)).alias(f"{c}_levels") for c in spec.categorical],
    ).first()
    categorical = tuple(
        (c, row[f"{c}_mode"], tuple(row[f"{c}_levels"])) for c in spec.categorical if row[f"{c}_levels"]
    )
    return [(c, row[c]) for c in spec.numeric if row[c] is not None], categorical


def _medians(df: DataFrame, row_bound: int | None, spec: TrajectorySpec) -> list:
    medians = group_quantiles(
        df.select(*[F.col(c).cast("double").alias(c) for c in spec.numeric]),
        [], spec.numeric, (0.5,), row_bound=row_bound,
    ).first()
    found = [(c, medians[f"{c}_q"][0]) for c in spec.numeric if medians[f"{c}_q"]]
    return [(c, m) for c, m in found if m is not None]


def _scale(deviation: float, mean: float) -> float:
    """A constant column keeps its unit; rounding noise counts as constant."""
    return 1.0 if deviation <= 1e-12 * abs(mean) else deviation


def _levels(df: DataFrame, spec: TrajectorySpec) -> tuple:
    if not spec.categorical:
        return ()
    counts = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in spec.categorical
        ])).alias("e"))
        .select("e.*")
        .filter(F.col("level").isNotNull())
        .groupBy("name", "level")
        .count()
        .limit(MAX_LEVELS + 1)
        .collect()
    )
    if len(counts) > MAX_LEVELS:
        raise ValueError(f"Categorical columns hold more than {MAX_LEVELS} levels.")
    out = []
    for c in spec.categorical:
        levels = sorted((r["level"], r["count"]) for r in counts if r["name"] == c)
        if levels:
            mode = max(levels, key=lambda item: item[1])[0]
            out.append((c, mode, tuple(level for level, _ in levels)))
    return tuple(out)


def feature_stats(
    df: DataFrame, *, row_bound: int | None = None, spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """The fitted numbers as rows ``feature, median, mean, scale, mode``."""
    stats = fit_features(df, row_bound=row_bound, spec=spec)
    rows = [(n, med, mean, sd, None) for n, med, mean, sd in stats.numeric]
    rows += [(n, None, None, None, mode) for n, mode, _ in stats.categorical]
    return df.sparkSession.createDataFrame(
        rows, "feature string, median double, mean double, scale double, mode string"
    )


def transform(
    df: DataFrame, stats: FeatureStats, keep: Sequence[str | Column] = (), scaled: bool = True
) -> DataFrame:
    """``keep`` columns followed by the feature columns."""
    return df.select(*keep, *stats.columns(scaled))


def vectorize(df: DataFrame, stats: FeatureStats, *, scaled: bool = True, name: str = "features") -> DataFrame:
    """Add the feature vector that Spark ML fits on."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(name, array_to_vector(F.array(*stats.columns(scaled))))
