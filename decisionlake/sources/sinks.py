"""Write libraries, metrics and reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.vectors import action_name, argmax, r6
from decisionlake.spec import DEFAULT, TrajectorySpec


def write_library(df: DataFrame, path: str, *, format: str = "csv", mode: str = "overwrite") -> None:
    """A library holds a few hundred capped rows, so it is one file."""
    writer = df.coalesce(1).write.mode(mode)
    if format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(format).save(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long metric frame: tens of rows whatever the size of the data."""
    metrics.coalesce(1).write.mode(mode).json(path)


def metrics_json(metrics: DataFrame, levels: Sequence[str], value: str = "value") -> str:
    """Nested JSON with sorted keys from a long metric frame."""
    root: dict = {}
    for row in metrics.select(*levels, value).collect():
        names = [str(row[c]) for c in levels if row[c] is not None]
        node = root
        for name in names[:-1]:
            node = node.setdefault(name, {})
        node[names[-1]] = row[value]
    return json.dumps(root, indent=2, sort_keys=True)


def case_report(decisions: DataFrame, probabilities: Sequence[str], label: str = "selection_reason",
                spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """One JSON text per case: chosen action, six-decimal probabilities, rationale, flags."""
    return decisions.select(
        *[c for c in spec.key if c in decisions.columns],
        F.to_json(
            F.struct(
                F.col(label).alias("selection_reason"),
                action_name(argmax(probabilities), spec.actions).alias("chosen_action"),
                F.struct(*[r6(p).alias(a) for p, a in zip(probabilities, spec.actions)]).alias("probabilities"),
                "rationale",
                "cache_hit",
                "fallback_used",
                "failure_reason",
            ),
            {"ignoreNullFields": "false"},
        ).alias("case_json"),
    )
