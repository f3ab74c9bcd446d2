"""Leaf values of boosted trees with an L2 penalty, on trees that Spark ML has grown.

Spark's trees give a leaf the mean of what is left to explain; an L2 term makes it ``sum / (n + l2)``. The
trees stay as they are and only their leaf values are fitted again, tree after tree, as each one explains
what the ones before it leave.

A tree's sums of residuals need no scan of their own. With ``v[s, m]`` the values found so far, the sum in
leaf ``l`` of tree ``t`` is ``sum(y) - base * n - sum over s, m of weight[s] * v[s, m] * together[t, l, s, m]``,
where ``together`` counts the rows that two leaves share. One scan adds ``n``, ``sum(y)`` and these counts up
for ``AT_ONCE`` trees; what reaches the driver is bounded by the model, whatever the number of rows.

Every tree after Spark's first is grown on the gradient of the squared error, which is twice what is left,
and so counts with twice its weight here: a step size of ``rate / 2`` gives a learning rate of ``rate``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trees whose leaves are counted against each other in one scan.
AT_ONCE = 25


def _numbers(values: Sequence[float], kind: str) -> Column:
    """An array that is a constant of the plan, made by one expression."""
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class PenalisedTrees:
    """Grown trees, the value they start from, and their own leaf values in place of the model's."""

    model: GBTRegressionModel
    base: float
    values: tuple[tuple[float, ...], ...]

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the predicted value; ``features`` and the columns made on the way are dropped."""
        leaves = with_leaves(self.model, df, "_leaves")
        return leaves.withColumn(name, self.predicted("_leaves", len(self.values))).drop("_leaves")

    def predicted(self, leaves: str, trees: int) -> Column:
        """The value after the first ``trees`` trees."""
        if not trees:
            return F.lit(self.base)
        weights = rates(self.model)
        flat = [w * v for w, own in zip(weights[:trees], self.values) for v in own]
        begins = np.cumsum([1] + [len(own) for own in self.values[: trees - 1]]).tolist()
        at = F.zip_with(F.slice(leaves, 1, trees), _numbers(begins, "int"), lambda leaf, begin: leaf + begin)
        found = F.transform(at, lambda i: F.element_at(_numbers(flat, "double"), i))
        return F.aggregate(found, F.lit(self.base), lambda total, v: total + v)


def rates(model: GBTRegressionModel) -> list[float]:
    """The share of what is left that each tree explains."""
    first, *later = model.treeWeights
    return [first, *(2 * w for w in later)]


def with_leaves(model: GBTRegressionModel, df: DataFrame, name: str) -> DataFrame:
    """``df`` without ``features``, with the number of each row's leaf in every tree."""
    kept = [c for c in df.columns if c != "features"]
    found = model.copy().setLeafCol("_leaf").setPredictionCol("").transform(df)
    return found.select(*kept, vector_to_array("_leaf").cast("array<int>").alias(name))


def _together_task(first: int, trees: int, leaves: int):
    """Sums over a task's rows: ``i, n, y`` per leaf, then ``i, j, n`` per pair with an earlier tree's leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = trees * leaves
        many, total, both = np.zeros(size, np.int64), np.zeros(size), np.zeros((trees, leaves, size), np.int64)
        for batch in batches:
            rest = batch.column("rest").to_numpy()
            at = batch.column("leaves").flatten().to_numpy().reshape(batch.num_rows, -1)[:, first : first + trees].astype(np.int64)
            for t in range(trees):
                own = slice(t * leaves, (t + 1) * leaves)
                many[own] += np.bincount(at[:, t], minlength=leaves)
                total[own] += np.bincount(at[:, t], rest, minlength=leaves)
                for s in range(t):
                    pair = np.bincount(at[:, t] * leaves + at[:, s], minlength=leaves * leaves)
                    both[t, :, s * leaves : (s + 1) * leaves] += pair.reshape(leaves, leaves)
        i = np.flatnonzero(many)
        a, b = np.nonzero(both.reshape(size, size))
        columns = [np.concatenate([i, a]), np.concatenate([np.full(len(i), -1), b]),
                   np.concatenate([many[i], both.reshape(size, size)[a, b]]), np.concatenate([total[i], np.zeros(len(a))])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "n", "y"])

    return run


def penalised(model: GBTRegressionModel, rows: DataFrame, l2: float, *, at_once: int = AT_ONCE) -> PenalisedTrees:
    """``model`` with leaf values of penalty ``l2``, fitted on its training ``rows`` (features, label).

    Without a penalty these are the model's own values. Trees are taken in order, ``at_once`` in a scan;
    a leaf that no row reaches is worth 0. Raises when there are no rows.
    """
    if l2 < 0:
        raise ValueError("l2_regularization must be non-negative.")
    base = rows.agg(F.avg("label")).first()[0]
    if base is None:
        raise ValueError("Leaf values need training rows.")
    sizes = [(tree.numNodes + 1) // 2 for tree in model.trees]
    width, weights, values = max(sizes), rates(model), []
    placed = with_leaves(model, rows, "leaves")
    for first in range(0, len(sizes), at_once):
        trees = min(at_once, len(sizes) - first)
        known = PenalisedTrees(model, base, tuple(values))
        rest = placed.select("leaves", (F.col("label") - known.predicted("leaves", first)).alias("rest"))
        sums = rest.mapInArrow(_together_task(first, trees, width), "i bigint, j bigint, n bigint, y double")
        found = sums.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toPandas()
        alone, pairs = found[found["j"] < 0], found[found["j"] >= 0]
        n, y, both = np.zeros(trees * width), np.zeros(trees * width), np.zeros((trees * width, trees * width))
        n[alone["i"]], y[alone["i"]] = alone["n"], alone["y"]
        both[pairs["i"], pairs["j"]] = pairs["n"]
        explained = np.zeros(trees * width)
        for t in range(trees):
            own = slice(t * width, (t + 1) * width)
            left = y[own] - both[own, : t * width] @ explained[: t * width]
            value = np.where(n[own] > 0, left / np.maximum(n[own] + l2, 1e-300), 0.0)
            explained[own] = weights[first + t] * value
            values.append(tuple(value[: sizes[first + t]].tolist()))
    return PenalisedTrees(model, base, tuple(values))
