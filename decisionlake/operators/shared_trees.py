"""Boosted trees of every held-out fold and action, grown in shared passes over the rows.

A model of a cross-fit is a side (all folds but one) and an action. All models grow their trees at once: a pass over
the rows returns, for each model and each node of its newest level, the rows and residuals per bin of every
feature, and the driver picks the splits. A tree takes as many passes as it has levels, whatever the number of models.

Trees are those of ``nuisance.ActionRewardModel``: level by level, on the imputed and unscaled features of the model's own rows,
the first one in full and later ones at the learning rate, from the mean. Leaves are worth ``sum / (n + l2)`` and
later trees are grown on what these leave. Where a column has at most ``BINS`` values every place between two of them can be a
split; otherwise ``BINS - 1`` exact quantiles of the model's own rows.

Tasks hold their rows as bins and residuals, a byte per feature and eight per residual for each side that a row trains. The driver holds the
sums of a level, never rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.functions.vectors import action_index
from decisionlake.operators.features import FeatureStats
from decisionlake.operators.scale import left_out_quantiles
from decisionlake.operators.shared_fits import SharedFits, _groups, _inputs
from decisionlake.sources.storage import table_path
from decisionlake.spec import DEFAULT, TrajectorySpec

#: Bins of a feature, as many as Spark's own trees have.
BINS = 32
#: Columns with about so many values have them counted; others are cut at quantiles.
FEW_VALUES = 64
#: Rows that are kept together; fewest rows that are worth a task, and most of one.
CHUNK_ROWS, LEAST_ROWS, TASK_ROWS = 32_768, 10_000, 500_000
#: Rows whose bins are counted in one call.
AT_ONCE = 4_096
#: Trees after which residuals are written, so that no lineage grows longer.
WRITE_EVERY = 50
#: Tasks whose sums the driver adds up itself; more of them are added up by tasks first.
FEW_TASKS = 32

#: Side and action.
Model = tuple[int, int]
#: Split features (-1: none), cuts and values of the nodes, each node's children at twice its place plus one and two.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def _bins(batch: pa.RecordBatch, stats: FeatureStats, names: Sequence[str], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every feature (in the order of ``names``) and row."""
    out = np.zeros((len(names), batch.num_rows), np.uint8)
    at = {n: i for i, n in enumerate(names)}
    for name, median, *_ in stats.numeric:
        values = pc.fill_null(pc.cast(batch.column(name), pa.float64()), median).to_numpy(zero_copy_only=False)
        out[at[name]] = np.searchsorted(cuts[at[name]], values)
    for name, mode, levels in stats.categorical:
        values = pc.fill_null(pc.cast(batch.column(name), pa.string()), mode)
        for level in levels:
            out[at[f"{name}={level}"]] = pc.equal(values, level).to_numpy(zero_copy_only=False)
    return out


def _down(tree: Tree, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after some levels; a node without a split keeps its rows."""
    node, every = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    for _ in range(levels):
        feature, cut = tree[0][node], tree[1][node]
        right = bins[np.maximum(feature, 0), every] > cut
        node = np.where(feature >= 0, 2 * node + 1 + right, node)
    return node


def _chunks_task(models: dict[Model, tuple[FeatureStats, list, float]], names: Sequence[str], sides: Sequence[int]):
    """Rows of one fold and action together: their number, and bins and residuals for each side that they train."""

    def chunk(fold: int, action: int, parts: list[pa.RecordBatch]) -> bytes:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        target, own = rows.column("_target").to_numpy(zero_copy_only=False), {}
        for side in sides:
            if side != fold:
                stats, cuts, base = models[side, action]
                own[side, action] = (_bins(rows, stats, names, cuts), target - base)
        return pickle.dumps(own, protocol=5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[Model, list] = {}

        def emit(key):
            return pa.RecordBatch.from_arrays([pa.array([chunk(*key, held.pop(key))], pa.binary())], ["chunk"])

        for batch in batches:
            for fold, own in _groups(batch, "fold"):
                part = batch.take(pa.array(own))
                for action, at in _groups(part, "_action"):
                    parts = held.setdefault((fold, action), [])
                    parts.append(part.take(pa.array(at)))
                    if sum(p.num_rows for p in parts) >= CHUNK_ROWS:
                        yield emit((fold, action))
        for key in list(held):
            yield emit(key)

    return run


def _sums_task(trees: dict[Model, Tree], level: int, features: int):
    """``model -> [rows and residuals, node of the level, feature, bin]`` over a task's rows."""
    first, nodes = 2**level - 1, 2**level
    size, places = nodes * features * BINS, np.arange(features)[:, None] * BINS

    def run(chunks: Iterator[dict]) -> Iterator[tuple[Model, np.ndarray]]:
        totals: dict[Model, np.ndarray] = {}
        for chunk in chunks:
            for model, (bins, rest) in chunk.items():
                if model not in trees:
                    continue
                if level:
                    node = _down(trees[model], bins, level) - first
                    here = np.flatnonzero(node >= 0)
                    node, bins, rest = node[here], bins[:, here], rest[here]
                else:
                    node = np.zeros(len(rest), np.int64)
                own = totals.setdefault(model, np.zeros((2, size)))
                for a in range(0, len(rest), AT_ONCE):
                    part = slice(a, a + AT_ONCE)
                    at = (node[part] * (features * BINS) + places + bins[:, part]).ravel()
                    own[0] += np.bincount(at, minlength=size)
                    own[1] += np.bincount(at, np.tile(rest[part], features), size)
        yield from ((model, own.reshape(2, nodes, features, BINS)) for model, own in totals.items())

    return run


def _explained(chunk: dict, trees: dict[Model, Tree], depth: int) -> dict:
    return {m: (bins, rest - trees[m][2][_down(trees[m], bins, depth)]) for m, (bins, rest) in chunk.items()}


def _split(tree: Tree, sums: np.ndarray, level: int, least: int, l2: float) -> bool:
    """Take the best split of every node of a level, and the worth of the sides; true if any node was split."""
    first, any_split = 2**level - 1, False
    left = np.cumsum(sums, axis=3)[..., :-1]
    for node in range(sums.shape[1]):
        n, total = sums[0, node, 0].sum(), sums[1, node, 0].sum()
        if level == 0:
            tree[2][0] = total / max(n + l2, 1e-300)
        if n < 2 * least:
            continue
        ln, ls = left[0, node], left[1, node]
        rn, rs = n - ln, total - ls
        allowed = (ln >= least) & (rn >= least)
        gain = np.where(allowed, ls**2 / np.maximum(ln + l2, 1e-300) + rs**2 / np.maximum(rn + l2, 1e-300), -np.inf)
        # of splits alike but for rounding the first one, whatever the order of the sums
        feature, cut = np.unravel_index(np.argmax(gain >= gain.max() * (1 - 1e-9)), gain.shape)
        own = total**2 / (n + l2)
        if not gain[feature, cut] - own > 1e-12 * abs(own):
            continue
        any_split = True
        at = first + node
        tree[0][at], tree[1][at] = feature, cut
        tree[2][2 * at + 1] = ls[feature, cut] / max(ln[feature, cut] + l2, 1e-300)
        tree[2][2 * at + 2] = rs[feature, cut] / max(rn[feature, cut] + l2, 1e-300)
    return any_split


def _next(spark: SparkSession, state: RDD, grown: dict[Model, Tree], depth: int, write: bool) -> RDD:
    """What is left after the newest trees; nothing is computed yet."""
    out = state.map(lambda chunk: _explained(chunk, grown, depth)).persist(StorageLevel.MEMORY_AND_DISK)
    if write:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(table_path(spark, "residuals"))
        out.checkpoint()
    return out


def _places(counts: dict[float, int]) -> np.ndarray:
    """Cuts midway between neighbouring values: all, or those next to the quantiles."""
    values = np.array(sorted(counts))
    cuts = (values[1:] + values[:-1]) / 2
    if len(values) <= BINS:
        return cuts
    share = np.cumsum([counts[v] for v in values.tolist()]) / sum(counts.values())
    at = np.searchsorted(share, np.arange(1, BINS) / BINS)
    return cuts[np.unique(np.minimum(at, len(cuts) - 1))]


def _cuts(inputs: DataFrame, sides: Sequence[int], shared: SharedFits, row_bound: int, spec: TrajectorySpec) -> dict[Model, list[np.ndarray]]:
    """Where each feature can be split, from the rows of each side and action alone."""
    numeric = [n for n, _ in shared.basis.numeric]
    about = inputs.agg(*[F.approx_count_distinct(n).alias(n) for n in numeric]).first() if numeric else {}
    few = [n for n in numeric if about[n] <= FEW_VALUES]
    rest = [n for n in numeric if about[n] > FEW_VALUES]
    counted: dict = {}
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("v")) for n in few]))
        long = inputs.select("fold", "_action", pairs.alias("e")).select("fold", "_action", "e.*")
        for r in long.groupBy("fold", "_action", "name", "v").count().collect():
            counted.setdefault((r["name"], r["_action"]), []).append((r["fold"], r["v"], r["count"]))
    quantiles: dict = {}
    if rest:
        narrow = inputs.select("fold", "_action", *rest)
        shares = [k / BINS for k in range(1, BINS)]
        found = left_out_quantiles(narrow, "fold", sides, ["_action"], rest, shares, row_bound=row_bound).collect()
        quantiles = {(n, r["side"], r["_action"]): r[f"{n}_q"] for r in found for n in rest}
    out = {}
    for side in sides:
        for action in range(len(spec.actions)):
            medians, own = dict(zip(numeric, shared.stats[side, action].medians)), []
            for name in numeric:
                if name in few:
                    counts: dict[float, int] = {}
                    for fold, v, n in counted.get((name, action), []):
                        if fold != side:
                            v = medians[name] if v is None else v
                            counts[v] = counts.get(v, 0) + n
                    own.append(_places(counts))
                else:
                    own.append(np.unique(quantiles.get((name, side, action)) or []).astype(float))
            own += [np.array([0.5])] * (len(shared.basis.names) - 1 - len(numeric))
            out[side, action] = own
    return out


class SharedTrees:
    """Boosted trees of (side, action); a tree is an array of split features, cuts and values of its nodes."""

    def __init__(self, names: list[str], depth: int, spec: TrajectorySpec):
        self.names, self.depth, self.spec = names, depth, spec
        self.models: dict[Model, tuple[FeatureStats, list[np.ndarray], float]] = {}
        self.trees: dict[Model, list[Tree]] = {}
        self.passes = 0

    @classmethod
    def fit(cls, rows: DataFrame, sides: Sequence[int], shared: SharedFits, config, *, row_bound: int,
            spec: TrajectorySpec = DEFAULT) -> SharedTrees:
        """``shared`` has the features of each side and action; ``config`` is a ``RewardModelConfig`` of trees."""
        basis, actions, context = shared.basis, range(len(spec.actions)), rows.sparkSession.sparkContext
        out = cls(basis.names[1:], math.ceil(math.log2(config.max_leaf_nodes)), spec)
        inputs = _inputs(rows, basis, spec)
        found = {(r["fold"], r["_action"]): (r["n"], r["y"]) for r in inputs.groupBy("fold", "_action").agg(
            F.count("*").alias("n"), F.sum("_target").alias("y")).collect()}
        cuts = _cuts(inputs, sides, shared, row_bound, spec)
        for side in sides:
            for action in actions:
                n, y = (sum(x) for x in zip(*[v for (f, a), v in sorted(found.items()) if f != side and a == action]))
                out.models[side, action] = (shared.stats[side, action].features(basis), cuts[side, action], y / n)
                out.trees[side, action] = []
        tasks = max(min(context.defaultParallelism, -(-row_bound // LEAST_ROWS)), -(-row_bound // TASK_ROWS), 1)
        chunks = inputs.coalesce(tasks).mapInArrow(_chunks_task(out.models, out.names, list(sides)), "chunk binary")
        state = chunks.rdd.map(lambda row: pickle.loads(row["chunk"])).persist(StorageLevel.MEMORY_AND_DISK)
        before = None
        try:
            for t in range(config.max_iter):
                grown = out._grow(state, config, 1.0 if t == 0 else config.learning_rate)
                for model, tree in grown.items():
                    out.trees[model].append(tree)
                if before is not None:
                    before.unpersist()
                before, state = state, _next(rows.sparkSession, state, grown, out.depth, (t + 1) % WRITE_EVERY == 0)
        finally:
            state.unpersist()
            if before is not None:
                before.unpersist()
        return out

    def _grow(self, state: RDD, config, rate: float) -> dict[Model, Tree]:
        size = 2 ** (self.depth + 1) - 1
        trees = {m: (np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for m in self.trees}
        growing = dict(trees)
        for level in range(self.depth):
            if growing:
                sums = self._sums(state, growing, level)
                growing = {
                    m: tree for m, tree in growing.items()
                    if _split(tree, sums[m], level, config.min_samples_leaf, config.l2_regularization)
                }
        return {m: (feature, cut, rate * value) for m, (feature, cut, value) in trees.items()}

    def _sums(self, state: RDD, trees: dict[Model, Tree], level: int) -> dict[Model, np.ndarray]:
        self.passes += 1
        parts = state.mapPartitions(_sums_task(trees, level, len(self.names)))
        if state.getNumPartitions() > FEW_TASKS:
            parts = parts.reduceByKey(np.add, FEW_TASKS)
        totals: dict[Model, np.ndarray] = {}
        for model, own in parts.collect():
            totals[model] = totals[model] + own if model in totals else own
        return totals

    def predict(self, df: DataFrame, stem: str, side: str = "fold") -> DataFrame:
        """Add ``<stem>_i``, the value of every action by the trees of the side in a column."""
        names, models, trees, depth = self.names, self.models, self.trees, self.depth
        added, actions = self.spec.indexed(stem), range(len(self.spec.actions))
        schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in added)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = np.full((len(added), batch.num_rows), np.nan)
                for fold, at in _groups(batch, side):
                    part = batch.take(pa.array(at))
                    for action in actions:
                        stats, cuts, base = models[fold, action]
                        bins, total = _bins(part, stats, names, cuts), np.full(len(at), base)
                        for tree in trees[fold, action]:
                            total += tree[2][_down(tree, bins, depth)]
                        values[action, at] = total
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, values)], [*batch.schema.names, *added])

        return df.mapInArrow(run, schema)
