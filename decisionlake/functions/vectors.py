"""Small column helpers shared by the operators.

A probability or value vector is kept as one flat column per action (``b_0, b_1, ...``):
flat doubles stay inside whole-stage codegen and are prunable one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_columns(values: Sequence[str | Column]) -> list[Column]:
    return [F.col(v) if isinstance(v, str) else v for v in values]


def total(values: Sequence[str | Column]) -> Column:
    """Left-to-right sum."""
    return reduce(lambda a, b: a + b, as_columns(values))


def r6(value: str | Column) -> Column:
    """Six decimals, without a negative zero."""
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col, 6) + F.lit(0.0)


def below(value: str | Column, limit: float) -> Column:
    """``value < limit`` where a missing value is False rather than unknown."""
    col = F.col(value) if isinstance(value, str) else value
    return F.coalesce(col < F.lit(limit), F.lit(False))


def clip(value: Column, bound: float) -> Column:
    """Clip to ``[-bound, bound]``, keeping NULL (least/greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.lit(bound), F.greatest(F.lit(-bound), value)))


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def argmax(values: Sequence[str | Column]) -> Column:
    """Zero-based position of the largest entry; the first one wins a tie."""
    # Each entry is named twice only: nested choices stay small after inlining.
    cols = as_columns(values)
    return (F.array_position(F.array(*cols), F.greatest(*cols)) - 1).cast("int")


def pick(values: Sequence[str | Column], index: Column) -> Column:
    """The entry at a zero-based position; NULL for a NULL position."""
    return F.get(F.array(*as_columns(values)), index)


def action_index(action: str | Column, actions: Sequence[str]) -> Column:
    """Position of a label in the canonical order; NULL for an unknown label."""
    col = F.col(action) if isinstance(action, str) else action
    out = F.lit(None).cast("int")
    for i in range(len(actions) - 1, -1, -1):
        out = F.when(col == F.lit(actions[i]), F.lit(i)).otherwise(out)
    return out


def action_name(index: Column, actions: Sequence[str]) -> Column:
    out = F.lit(None).cast("string")
    for i in range(len(actions) - 1, -1, -1):
        out = F.when(index == F.lit(i), F.lit(actions[i])).otherwise(out)
    return out


def rate(condition: Column) -> Column:
    """Share of rows where a condition holds (missing counts as not holding)."""
    return F.avg(F.when(F.coalesce(condition, F.lit(False)), 1.0).otherwise(0.0))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")),
                      F.lit(0).cast("bigint"))


def valid_probabilities(values: Sequence[str | Column], tolerance: float) -> Column:
    """Finite, non-negative and summing to one. Never NULL."""
    cols = as_columns(values)
    ok = reduce(lambda a, b: a & b, [finite(c) & (c >= 0) for c in cols])
    return F.coalesce(ok & (F.abs(total(cols) - 1.0) <= F.lit(tolerance)), F.lit(False))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later predicates and projections read instead of repeating.

    The optimizer inlines plain columns into every use, which multiplies nested choices
    past what code generation accepts; it does not inline the output of a generator.
    """
    return df.select(
        "*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    )
