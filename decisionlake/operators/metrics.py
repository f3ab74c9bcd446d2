"""Calibration, fit and slice metrics over rows that carry their own estimates.

A row has the logged action, a probability column per action and, for reward models, the
logged reward and its prediction. Each metric is one conditional aggregate; ``by`` adds
grouping columns and ``folds`` adds the per-fold rows next to the overall row in one pass.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.functions.vectors import (
    action_index, action_name, argmax, as_columns, below, count_if, pick, rate,
)
from decisionlake.operators.scale import group_quantiles
from decisionlake.spec import DEFAULT, TrajectorySpec

#: Bin edges as doubles: the upper edge of bin 2 is 0.30000000000000004.
EDGES = tuple(i * 0.1 for i in range(10)) + (1.0,)
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
QUARTILE_NAMES = ("min", "p25", "median", "p75", "max")


def side_by_side(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Put one-row-per-group frames next to each other; groups may be NULL or absent."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in stacked.columns if c not in keys]
    )


def bin_of(p: Column) -> Column:
    """Bin 0..9 with closed lower edges; the last bin is closed on both sides."""
    out = F.lit(9)
    for i in range(8, -1, -1):
        out = F.when(p < F.lit(EDGES[i + 1]), F.lit(i)).otherwise(out)
    return out


def _indexed(df: DataFrame, probabilities: Sequence[str], spec: TrajectorySpec) -> DataFrame:
    return df.withColumns({
        "_a": action_index(spec.action, spec.actions),
        "_top": argmax(probabilities),
        "_p": pick(probabilities, action_index(spec.action, spec.actions)),
    })


def _squared_error(probabilities: Sequence[str], action: Column) -> Column:
    out = F.lit(0.0)
    for i, p in enumerate(as_columns(probabilities)):
        hit = F.when(action == i, 1.0).otherwise(0.0)
        out = out + (p - hit) * (p - hit)
    return out


def _macro_f1(n: int) -> Column:
    out = F.lit(0.0)
    for i in range(n):
        hits = count_if((F.col("_top") == i) & (F.col("_a") == i))
        either = count_if(F.col("_top") == i) + count_if(F.col("_a") == i)
        out = out + F.when(either == 0, 0.0).otherwise(2.0 * hits / F.when(either != 0, either))
    return out / n


def behavior_metrics(
    df: DataFrame, probabilities: Sequence[str], *, folds: str | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Log loss, Brier, accuracy and macro-F1; with ``folds``, one more row per fold."""
    rows = _indexed(df, probabilities, spec)
    grouped = rows.rollup(folds) if folds else rows.groupBy()
    capped = F.greatest(F.least("_p", F.lit(1.0)), F.lit(sys.float_info.epsilon))
    return grouped.agg(
        F.count("*").alias("rows"),
        F.avg(-F.log(capped)).alias("log_loss"),
        F.avg(_squared_error(probabilities, F.col("_a"))).alias("multiclass_brier"),
        rate(F.col("_top") == F.col("_a")).alias("accuracy"),
        _macro_f1(len(spec.actions)).alias("macro_f1"),
    )


def top_label_ece(
    df: DataFrame, probabilities: Sequence[str], *, folds: str | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Expected calibration error of the top action: sum of |hits - confidence| per bin / rows."""
    rows = _indexed(df, probabilities, spec).withColumn("_c", F.greatest(*probabilities))
    keys = [folds] if folds else []
    bins = rows.groupBy(*keys, bin_of(F.col("_c")).alias("bin")).agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("_top") == F.col("_a"), 1.0).otherwise(0.0)).alias("hits"),
        F.sum("_c").alias("confidence"),
    )
    ece = (F.sum(F.abs(F.col("hits") - F.col("confidence"))) / F.sum("n")).alias("top_label_ece")
    if not folds:
        return bins.agg(ece)
    overall = bins.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("n", "hits", "confidence")])
    return bins.groupBy(folds).agg(ece).unionByName(
        overall.agg(ece).withColumn(folds, F.lit(None).cast(df.schema[folds].dataType))
    )


def _per_action(df: DataFrame, probabilities: Sequence[str], spec: TrajectorySpec) -> DataFrame:
    """One row per (row, action): the label, its probability, whether it was logged."""
    return df.select(
        F.explode(F.array(*[
            F.struct(
                F.lit(a).alias("action"),
                F.col(p).alias("p"),
                F.coalesce(F.col(spec.action) == a, F.lit(False)).alias("hit"),
            )
            for a, p in zip(spec.actions, probabilities)
        ])).alias("e")
    ).select("e.*")


def one_vs_rest_ece(
    df: DataFrame, probabilities: Sequence[str], spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    bins = _per_action(df, probabilities, spec).groupBy("action", bin_of(F.col("p")).alias("bin")).agg(
        F.count("*").alias("n"),
        F.sum(F.col("hit").cast("double")).alias("hits"),
        F.sum("p").alias("confidence"),
    )
    return bins.groupBy("action").agg(
        (F.sum(F.abs(F.col("hits") - F.col("confidence"))) / F.sum("n")).alias("one_vs_rest_ece")
    )


def binary_brier(
    df: DataFrame, probabilities: Sequence[str], spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    gap = F.col("p") - F.col("hit").cast("double")
    return _per_action(df, probabilities, spec).groupBy("action").agg(
        F.avg(gap * gap).alias("binary_brier")
    )


def logged_propensity(
    df: DataFrame, probabilities: Sequence[str], *, by_action: bool = False,
    row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Summary of the probability of the logged action, overall or per action."""
    rows = _indexed(df, probabilities, spec)
    keys = ["action"] if by_action else []
    means = rows.groupBy(*[F.col(spec.action).alias(k) for k in keys]).agg(
        F.count("*").alias("logged_count"), F.avg("_p").alias("mean")
    )
    return side_by_side(keys, means, _propensity_quantiles(rows, by_action, row_bound, spec))


def _propensity_quantiles(
    rows: DataFrame, by_action: bool, row_bound: int | None, spec: TrajectorySpec
) -> DataFrame:
    probs = (0.05, 0.5) if by_action else (0.0, 0.01, 0.05, 0.5)
    names = ("p05", "median") if by_action else ("min", "p01", "p05", "median")
    keys = ["action"] if by_action else []
    rows = rows.select(F.col(spec.action).alias("action"), "_p")
    return group_quantiles(rows, keys, ["_p"], probs, row_bound=row_bound).select(
        *keys, *[F.try_element_at("_p_q", F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    )


def action_rates(
    df: DataFrame, probabilities: Sequence[str], spec: TrajectorySpec = DEFAULT
) -> DataFrame:
    """Observed rate, mean predicted probability and arg-max rate per action."""
    row = _indexed(df, probabilities, spec).agg(*[
        F.struct(
            F.lit(a).alias("action"),
            F.coalesce(rate(F.col("_a") == i), F.lit(0.0)).alias("observed_rate"),
            F.avg(p).alias("mean_probability"),
            F.coalesce(rate(F.col("_top") == i), F.lit(0.0)).alias("argmax_rate"),
        ).alias(f"_{i}")
        for i, (a, p) in enumerate(zip(spec.actions, probabilities))
    ])
    return row.select(
        F.explode(F.array(*[F.col(f"_{i}") for i in range(len(spec.actions))])).alias("e")
    ).select("e.*")


def state_slice_behavior(
    df: DataFrame, probabilities: Sequence[str], condition: Column | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Observed rates and mean probabilities in the two halves of a state condition."""
    if condition is None:
        condition = below(spec.pressure, spec.low_pressure)
    return (
        _indexed(df, probabilities, spec)
        .groupBy(F.coalesce(condition, F.lit(False)).alias("in_slice"))
        .agg(
            F.count("*").alias("rows"),
            *[rate(F.col("_a") == i).alias(f"observed_{i}") for i in range(len(spec.actions))],
            *[F.avg(p).alias(f"predicted_{i}") for i, p in enumerate(probabilities)],
        )
    )


def _regression(actual: Column, predicted: Column) -> list[Column]:
    error = actual - predicted
    spread = F.var_pop(actual) * F.count(actual)
    residual = F.sum(error * error)
    return [
        F.count("*").alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread != 0, 1.0 - residual / F.when(spread != 0, spread))
        .otherwise(F.when(residual == 0, 1.0).otherwise(0.0)).alias("r2"),
        F.avg(actual).alias("actual_mean"),
        F.avg(predicted).alias("predicted_mean"),
    ]


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str | Column] = (),
    folds: str | None = None,
) -> DataFrame:
    """RMSE, MAE, R2 and means. R2 is one minus residual over total sum of squares."""
    grouped = df.rollup(folds) if folds else df.groupBy(*by)
    return grouped.agg(*_regression(F.col(actual), F.col(predicted)))


def fold_sizes(df: DataFrame, fold: str = "fold", spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """Rows and patients held out in each fold, and patients it was trained on."""
    # Folds are patient-disjoint, so the patients outside are total minus held out.
    sizes = df.groupBy(fold).agg(
        F.count("*").alias("validation_rows"),
        F.count_distinct(spec.patient).alias("validation_patients"),
    )
    # One row per fold, so a single window over them is enough.
    everyone = F.sum("validation_patients").over(Window.partitionBy(F.lit(0)))
    return sizes.withColumn("train_patients", everyone - F.col("validation_patients"))


def quantile_summary(
    df: DataFrame, values: Sequence[str], by: Sequence[str] = (), row_bound: int | None = None
) -> DataFrame:
    """Long ``..., variable, min, p25, median, p75, max``; all NULL for an empty input."""
    q = group_quantiles(df, list(by), list(values), QUARTILES, row_bound=row_bound)
    return q.select(
        *by,
        F.explode(F.array(*[
            F.struct(F.lit(v).alias("variable"), F.col(f"{v}_q").alias("q")) for v in values
        ])).alias("e"),
    ).select(
        *by, "e.variable",
        *[F.try_element_at("e.q", F.lit(i + 1)).alias(n) for i, n in enumerate(QUARTILE_NAMES)],
    )


def reward_summary(
    df: DataFrame, reward: str = "reward", by: Sequence[str] = (), row_bound: int | None = None
) -> DataFrame:
    """Rows, mean, share at or above zero, p10, median and p90 of a reward."""
    means = df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(reward).alias("mean"),
        rate(F.col(reward) >= 0).alias("favorable_rate"),
    )
    return side_by_side(list(by), means, reward_quantiles(df, reward, by, row_bound))


def reward_quantiles(
    df: DataFrame, reward: str = "reward", by: Sequence[str] = (), row_bound: int | None = None
) -> DataFrame:
    q = group_quantiles(df, list(by), [reward], (0.1, 0.5, 0.9), row_bound=row_bound)
    return q.select(*by, *[
        F.try_element_at(f"{reward}_q", F.lit(i + 1)).alias(n)
        for i, n in enumerate(("p10", "median", "p90"))
    ])


# --------------------------------------------------------------------- long reports

LONG = ("section", "model", "slice", "action", "fold", "metric", "value")


def to_long(df: DataFrame, metrics: Sequence[str], **dims: Column | str | None) -> DataFrame:
    """Melt a wide metric frame into the shared long layout."""
    named = {
        d: F.lit(None).cast("string") if dims.get(d) is None
        else (dims[d] if isinstance(dims[d], Column) else F.lit(dims[d])).cast("string")
        for d in LONG[:5]
    }
    return df.select(
        *[c.alias(d) for d, c in named.items()],
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ])).alias("e"),
    ).select(*LONG[:5], "e.metric", "e.value")


def union_long(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


_ENTRIES = "array<struct<section string, model string, slice string, action string, fold string, metric string, value double>>"


def entries(metrics: dict[str, Column], **dims: Column | str | None) -> Column:
    """The metrics of one section as an array of long rows."""
    named = [
        (F.lit(None) if dims.get(d) is None else dims[d] if isinstance(dims[d], Column) else F.lit(dims[d]))
        .cast("string").alias(d)
        for d in LONG[:5]
    ]
    return F.array(*[
        F.struct(*named, F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()
    ])


def columns(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def unpivoted(df: DataFrame, parts: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Long rows of a wide frame: of each ``(condition, entries)`` the entries where it holds."""
    none = F.array().cast(_ENTRIES)
    return df.select(F.inline(F.concat(*[
        F.when(condition, rows.cast(_ENTRIES)).otherwise(none) for condition, rows in parts
    ])))


def in_one_pass(df: DataFrame, sets: Sequence[Sequence[str]], aggregates: Sequence[Column]) -> DataFrame:
    """The aggregates of several groupings from one scan; ``_set`` is the grouping's number in ``sets``.

    Keys outside a row's grouping are NULL. An empty table has no rows, also where a grouping has no keys.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    absent = [sum(1 << i for i, k in enumerate(reversed(keys)) if k not in s) for s in sets]
    number = F.lit(None)
    for n, bits in enumerate(absent):
        number = F.when(F.col("_bits") == bits, n).otherwise(number)
    grouped = df.groupingSets([[F.col(k) for k in s] for s in sets], *keys)
    return grouped.agg(F.grouping_id().alias("_bits"), *aggregates).withColumn("_set", number).drop("_bits")


def _calibration_and_folds(
    rows: DataFrame, probabilities: Sequence[str], model: str, fold: str, spec: TrajectorySpec
) -> DataFrame:
    """Calibration errors and fold sizes from one scan of ``_indexed`` rows.

    A row becomes an entry per bin that it falls in and one for its patient; entries are counted in the
    map tasks before they are shuffled.
    """
    top, patient = -1, -2
    held = F.col(fold).cast("string")
    nothing = F.lit(None).cast("string")

    def entry(kind: int, of_fold: Column, p: Column | None, hit: Column, who: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), of_fold.alias("fold"),
            (F.lit(None).cast("int") if p is None else bin_of(p)).alias("bin"), who.alias("patient"),
            hit.cast("double").alias("hit"), (F.lit(0.0) if p is None else p).alias("p"),
        )

    right = F.coalesce(F.col("_top") == F.col("_a"), F.lit(False))
    logged = [F.coalesce(F.col("_a") == i, F.lit(False)) for i in range(len(spec.actions))]
    exploded = rows.select(F.inline(F.array(
        entry(top, held, F.greatest(*probabilities), right, nothing),
        entry(patient, held, None, F.lit(False), F.col(spec.patient).cast("string")),
        *[entry(i, nothing, F.col(p), logged[i], nothing) for i, p in enumerate(probabilities)],
    )))
    cells = exploded.groupBy("kind", "fold", "bin", "patient").agg(
        F.count("*").alias("n"), F.sum("hit").alias("hits"), F.sum("p").alias("confidence")
    )
    bins = in_one_pass(cells, [["kind", "fold", "bin"], ["kind", "bin"]], [
        F.count("patient").alias("patients"), *[F.sum(c).alias(c) for c in ("n", "hits", "confidence")]
    ])
    rates = bins.groupBy("kind", "fold", "_set").agg(
        F.sum("n").alias("validation_rows"), F.sum("patients").alias("validation_patients"),
        (F.sum(F.abs(F.col("hits") - F.col("confidence"))) / F.sum("n")).alias("ece"),
    )
    # a few rows per kind; folds are patient-disjoint, so the patients outside are total minus held out
    everyone = F.max(F.when(F.col("_set") == 1, F.col("validation_patients"))).over(Window.partitionBy("kind"))
    rates = rates.withColumn("train_patients", everyone - F.col("validation_patients"))
    kind, whole = F.col("kind"), F.col("_set") == 1
    return unpivoted(rates, [
        (kind == top, entries({"top_label_ece": F.col("ece")}, section="overall", model=model,
                              fold=F.coalesce("fold", F.lit("all")))),
        ((kind == patient) & ~whole,
         entries(columns("validation_rows", "validation_patients", "train_patients"),
                 section="folds", model=model, fold=F.col("fold"))),
        ((kind >= 0) & whole, entries({"one_vs_rest_ece": F.col("ece")}, section="per_action", model=model,
                                      action=action_name(kind, spec.actions))),
    ])


def behavior_report(
    df: DataFrame, probabilities: Sequence[str], *, model: str = "behavior",
    fold: str = "fold", row_bound: int | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Out-of-fold propensity diagnostics as one long frame.

    One scan gives every mean (overall, per fold, logged action and half of the states), one more the bins
    and the patients; quantiles have their own. An empty table has no means.
    """
    low = below(spec.pressure, spec.low_pressure)
    rows = _indexed(df, probabilities, spec)
    indexes = range(len(spec.actions))
    capped = F.greatest(F.least("_p", F.lit(1.0)), F.lit(sys.float_info.epsilon))
    keyed = rows.withColumns({
        "_fold": F.col(fold).cast("string"), "_action": F.col(spec.action), "_slice": F.coalesce(low, F.lit(False)),
    })
    gaps = [F.col(p) - F.coalesce(F.col("_a") == i, F.lit(False)).cast("double") for i, p in enumerate(probabilities)]
    wide = in_one_pass(keyed, [[], ["_fold"], ["_action"], ["_slice"]], [
        F.count("*").alias("rows"),
        F.avg(-F.log(capped)).alias("log_loss"),
        F.avg(_squared_error(probabilities, F.col("_a"))).alias("multiclass_brier"),
        rate(F.col("_top") == F.col("_a")).alias("accuracy"),
        _macro_f1(len(spec.actions)).alias("macro_f1"),
        F.avg("_p").alias("mean"),
        *[rate(F.col("_a") == i).alias(f"observed_{i}") for i in indexes],
        *[F.avg(p).alias(f"predicted_{i}") for i, p in enumerate(probabilities)],
        *[rate(F.col("_top") == i).alias(f"argmax_{i}") for i in indexes],
        *[F.avg(gap * gap).alias(f"brier_{i}") for i, gap in enumerate(gaps)],
    ])
    overall, per_fold, per_action, sliced = [F.col("_set") == n for n in range(4)]
    per_name = []
    for i, a in enumerate(spec.actions):
        per_name += [
            (overall, entries({
                "observed_rate": F.coalesce(F.col(f"observed_{i}"), F.lit(0.0)),
                "mean_probability": F.col(f"predicted_{i}"),
                "argmax_rate": F.coalesce(F.col(f"argmax_{i}"), F.lit(0.0)),
            }, section="action_rates", model=model, action=a)),
            (overall, entries({"binary_brier": F.col(f"brier_{i}")}, section="per_action", model=model, action=a)),
        ]
    means = unpivoted(wide, [
        (overall | per_fold,
         entries(columns("rows", "log_loss", "multiclass_brier", "accuracy", "macro_f1"),
                 section="overall", model=model, fold=F.coalesce("_fold", F.lit("all")))),
        *per_name,
        (per_action, entries({"logged_count": F.col("rows"), "mean": F.col("mean")},
                             section="logged_propensity", model=model, action=F.col("_action"))),
        (overall, entries(columns("mean"), section="logged_propensity", model=model)),
        (sliced, entries(columns("rows", *[f"observed_{i}" for i in indexes], *[f"predicted_{i}" for i in indexes]),
                         section="low_pressure", model=model, slice=F.col("_slice"))),
    ])
    return union_long([
        means,
        _calibration_and_folds(rows, probabilities, model, fold, spec),
        to_long(_propensity_quantiles(rows, True, row_bound, spec), ["p05", "median"],
                section="logged_propensity", model=model, action=F.col("action")),
        to_long(_propensity_quantiles(rows, False, row_bound, spec), ["min", "p01", "p05", "median"],
                section="logged_propensity", model=model),
    ])


def reward_report(
    df: DataFrame, predicted: str, *, model: str, reward: str = "reward", fold: str = "fold",
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Factual out-of-fold reward fit: overall, per fold, per action and by low pressure, in one scan.

    Only predictions of the logged action are scored; values of other actions are
    estimates that no logged outcome can validate. Fold sizes take a scan of their own, as patients are
    counted apart. An empty table has no rows.
    """
    names = ("rows", "rmse", "mae", "r2", "actual_mean", "predicted_mean")
    keyed = df.select(
        reward, predicted, F.col(fold).cast("string").alias("_fold"), F.col(spec.action).alias("_action"),
        below(spec.pressure, spec.low_pressure).alias("_slice"),
    )
    fit = in_one_pass(keyed, [[], ["_fold"], ["_action"], ["_slice"]], _regression(F.col(reward), F.col(predicted)))
    overall, per_fold, per_action, sliced = [F.col("_set") == n for n in range(4)]
    return union_long([
        unpivoted(fit, [
            (overall | per_fold, entries(columns(*names), section="overall", model=model,
                                         fold=F.coalesce("_fold", F.lit("all")))),
            (per_action, entries(columns(*names), section="per_action", model=model, action=F.col("_action"))),
            (sliced, entries(columns(*names), section="low_pressure", model=model, slice=F.col("_slice"))),
        ]),
        to_long(fold_sizes(df, fold, spec), ["validation_patients", "train_patients"],
                section="folds", model=model, fold=F.col(fold)),
    ])


def model_deltas(long: DataFrame, baseline: str) -> DataFrame:
    """Candidate minus baseline for RMSE, MAE and R2, cell by cell.

    Lower RMSE/MAE and higher R2 are better. Both sides are metric rows, not data.
    """
    cells = long.filter(F.col("metric").isin("rmse", "mae", "r2")).filter(
        (F.col("section") == "per_action")
        | ((F.col("section") == "overall") & (F.col("fold") == "all"))
        | ((F.col("section") == "low_pressure") & (F.col("slice") == "true"))
    ).select("section", "model", F.coalesce("action", F.lit("all")).alias("action"), "metric", "value")
    base = cells.filter(F.col("model") == baseline).select(
        "section", "action", "metric", F.col("value").alias("baseline_value")
    )
    return cells.filter(F.col("model") != baseline).join(base, ["section", "action", "metric"]).select(
        "model", "section", "action", "metric",
        (F.col("value") - F.col("baseline_value")).alias("delta"),
    )
