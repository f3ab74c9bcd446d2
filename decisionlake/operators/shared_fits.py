"""Ridge and logistic models of every held-out fold from shared passes over the rows.

All fits of a cross-fit see the same rows, each through its own medians, means, scales and modes.
Those are linear in a basis that depends on no fit: a one, the shifted value or zero and a mark for
a missing value of every numeric column, and the levels and a missing mark of every categorical one.

* The products of that basis and the reward are summed once per fold and action. A training side is the
  total without its fold, and gives the moments of the imputed features and the normal equations.
* The logistic model takes Newton steps for all sides at once: a pass over the rows returns loss,
  gradient and curvature of each side in the basis, at that side's own coefficients.
* Predictions read one row of coefficients per fold, all in one projection.

The driver holds sums of the basis' size squared per fold and action, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.functions.prompts import sql_text
from decisionlake.functions.vectors import action_index, computed_once
from decisionlake.operators.features import FeatureStats, _levels, _scale
from decisionlake.operators.scale import left_out_quantiles, without_part
from decisionlake.spec import DEFAULT, TrajectorySpec

#: Widest basis of which products are summed; wider ones are fitted one by one.
MAX_BASIS = 512
#: Tasks that add up the sums of other tasks.
ADDERS = 8
#: Side that holds nothing out.
WHOLE = 0


@dataclass(frozen=True)
class Basis:
    """What every fit shares: shifts of numeric columns and levels of categorical ones."""

    numeric: tuple[tuple[str, float], ...]
    categorical: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def names(self) -> list[str]:
        """Features in the order of the coefficients, the intercept first."""
        return ["1", *(n for n, _ in self.numeric), *(f"{n}={v}" for n, levels in self.categorical for v in levels)]

    @property
    def size(self) -> int:
        return 1 + 2 * len(self.numeric) + sum(len(levels) + 1 for _, levels in self.categorical)

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, self.size))
        out[:, 0], at, n = 1.0, 1, len(self.numeric)
        for name, shift in self.numeric:
            column = batch.column(name)
            missing = column.is_null().to_numpy(zero_copy_only=False)
            out[:, at] = np.where(missing, 0.0, column.fill_null(0.0).to_numpy(zero_copy_only=False) - shift)
            out[:, at + n] = missing
            at += 1
        at += n
        for name, levels in self.categorical:
            column = batch.column(name)
            for level in levels:
                out[:, at] = pa.compute.fill_null(pa.compute.equal(column, level), False).to_numpy(zero_copy_only=False)
                at += 1
            out[:, at] = column.is_null().to_numpy(zero_copy_only=False)
            at += 1
        return out

    def product(self, weights: str, start: int = 0) -> str:
        """The basis times an array column of weights, as SQL; ``start`` is where the weights begin."""
        n, terms, at = len(self.numeric), [f"{weights}[{start}]"], start + 1
        for i, (name, shift) in enumerate(self.numeric):
            value = f"CAST(`{name}` AS DOUBLE)"
            terms.append(f"CASE WHEN `{name}` IS NULL THEN {weights}[{at + n + i}] ELSE ({value} - ({shift!r}D)) * {weights}[{at + i}] END")
        at += 2 * n
        for name, levels in self.categorical:
            cases = " ".join(f"WHEN `{name}` = {sql_text(v)} THEN {weights}[{at + i}]" for i, v in enumerate(levels))
            terms.append(f"CASE WHEN `{name}` IS NULL THEN {weights}[{at + len(levels)}] {cases} ELSE 0D END")
            at += len(levels) + 1
        return " + ".join(terms)


@dataclass(frozen=True)
class Side:
    """The features of one fit: medians, means, scales and modes, and the map from the basis to them."""

    medians: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    modes: tuple[str | None, ...]
    rows: int
    known: tuple[bool, ...]
    levels: tuple[tuple[str, ...], ...]

    def features(self, basis: Basis) -> FeatureStats:
        """The same as a fit of this side alone keeps; columns without a value are left out."""
        numeric = zip([n for n, _ in basis.numeric], self.medians, self.means, self.scales)
        named = zip([n for n, _ in basis.categorical], self.modes, self.levels)
        return FeatureStats(
            tuple(x for x, known in zip(numeric, self.known) if known), tuple(x for x in named if x[2])
        )

    def map(self, basis: Basis) -> np.ndarray:
        n = len(basis.numeric)
        out = np.zeros((len(basis.names), basis.size))
        out[0, 0] = 1.0
        for i, (_, shift) in enumerate(basis.numeric):
            out[1 + i, [0, 1 + i, 1 + n + i]] = np.array([shift - self.means[i], 1.0, self.medians[i] - shift]) / self.scales[i]
        row, at = 1 + n, 1 + 2 * n
        for (_, levels), mode in zip(basis.categorical, self.modes):
            for i, level in enumerate(levels):
                out[row, at + i] = 1.0
                out[row, at + len(levels)] = level == mode
                row += 1
            at += len(levels) + 1
        return out


def basis_of(rows: DataFrame, spec: TrajectorySpec = DEFAULT) -> Basis:
    shifts = rows.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in spec.numeric]).first()
    levels = {name: found for name, _, found in _levels(rows, spec)}
    return Basis(
        tuple((c, float(shifts[c] or 0.0)) for c in spec.numeric), tuple((c, levels.get(c, ())) for c in spec.categorical)
    )


def _inputs(rows: DataFrame, basis: Basis, spec: TrajectorySpec, also: Sequence[str] = ()) -> DataFrame:
    return rows.select(
        *also, F.col("fold").cast("int").alias("fold"), action_index(spec.action, spec.actions).alias("_action"),
        F.col(spec.reward).cast("double").alias("_target") if spec.reward in rows.columns else F.lit(0.0).alias("_target"),
        *[F.col(n).cast("double").alias(n) for n, _ in basis.numeric], *[F.col(n).cast("string").alias(n) for n, _ in basis.categorical],
    )


_SUMS = "key int, part int, sums array<double>"


def _emitted(totals: dict, part: int) -> Iterator[pa.RecordBatch]:
    for key, sums in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int32()), pa.array([part], pa.int32()), pa.array([np.ravel(sums)], pa.list_(pa.float64()))],
            ["key", "part", "sums"],
        )


def _add_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict = {}
    for batch in batches:
        for key, sums in zip(batch.column("key").to_pylist(), batch.column("sums")):
            own = sums.values.to_numpy(zero_copy_only=False)
            totals[key] = totals[key] + own if key in totals else own.copy()
    yield from _emitted(totals, 0)


def _summed(inputs: DataFrame, task) -> dict[int, np.ndarray]:
    """Sums that tasks make under small keys, added up by a few tasks and then here."""
    parts = inputs.mapInArrow(task, _SUMS).repartition(ADDERS, "part").mapInArrow(_add_task, _SUMS)
    totals: dict[int, np.ndarray] = {}
    for row in parts.collect():
        totals[row["key"]] = totals.get(row["key"], 0.0) + np.array(row["sums"])
    return totals


def _groups(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    values = batch.column(name).to_numpy(zero_copy_only=False)
    for v in np.unique(values).tolist():
        yield int(v), np.flatnonzero(values == v)


def gram_blocks(rows: DataFrame, basis: Basis, spec: TrajectorySpec = DEFAULT) -> dict[tuple[int, int], np.ndarray]:
    """Sums of products of basis and reward per (fold, action): one pass."""
    width = len(spec.actions)

    def task(batches):
        from pyspark import TaskContext

        totals: dict = {}
        for batch in batches:
            z = np.column_stack([basis.matrix(batch), batch.column("_target").to_numpy(zero_copy_only=False)])
            for fold, own in _groups(batch, "fold"):
                for action, at in _groups(batch.take(pa.array(own)), "_action"):
                    part = z[own[at]]
                    totals[fold * width + action] = totals.get(fold * width + action, 0.0) + part.T @ part
        yield from _emitted(totals, TaskContext.get().partitionId())

    found = _summed(_inputs(rows, basis, spec), task)
    d = basis.size + 1
    return {divmod(key, width): sums.reshape(d, d) for key, sums in found.items()}


def _sided(rows: DataFrame, sides: Sequence[int]) -> DataFrame:
    """Every row once for each side that it trains."""
    return without_part(rows, "fold", sides)


def _medians(rows: DataFrame, basis: Basis, sides: Sequence[int], by_action: bool, row_bound: int | None, spec: TrajectorySpec) -> dict:
    names = [n for n, _ in basis.numeric]
    narrow = rows.select("fold", action_index(spec.action, spec.actions).alias("_action"), *[F.col(n).cast("double").alias(n) for n in names])
    found = left_out_quantiles(narrow, "fold", sides, ["_action"] if by_action else [], names, (0.5,), row_bound=row_bound).collect()
    return {
        (r["side"], r["_action"] if by_action else None): [r[f"{n}_q"][0] if r[f"{n}_q"] else None for n in names] for r in found
    }


def _side(basis: Basis, gram: np.ndarray, medians: Sequence[float | None]) -> Side:
    n, rows = len(basis.numeric), gram[0, 0]
    found, given = [], medians
    for i, (name, shift) in enumerate(basis.numeric):
        lift = (medians[i] if medians[i] is not None else shift) - shift
        u, m = 1 + i, 1 + n + i
        mean = (gram[0, u] + lift * gram[0, m]) / rows
        square = (gram[u, u] + 2 * lift * gram[u, m] + lift * lift * gram[m, m]) / rows
        deviation = float(np.sqrt(max(square - mean * mean, 0.0)))
        if deviation <= 1e-7 * abs(shift):  # lost in rounding: the column is constant
            deviation = 0.0
        found.append((float(lift + shift), float(mean + shift), float(_scale(deviation, mean + shift))))
    modes, seen, at = [], [], 1 + 2 * n
    for _, levels in basis.categorical:
        counts = [gram[0, at + i] for i in range(len(levels))]
        modes.append(levels[int(np.argmax(counts))] if counts and max(counts) > 0 else None)
        seen.append(tuple(v for v, count in zip(levels, counts) if count > 0))
        at += len(levels) + 1
    medians, means, scales = zip(*found) if found else ((), (), ())
    known = tuple(m is not None for m in (given or [None] * n))
    return Side(medians, means, scales, tuple(modes), int(round(rows)), known, tuple(seen))


def _without_fold(blocks: dict, side: int, actions: Sequence[int]) -> np.ndarray:
    return sum(block for (fold, action), block in sorted(blocks.items()) if fold != side and action in actions)


def ridge_coefficients(gram: np.ndarray, side: Side, basis: Basis, alpha: float) -> np.ndarray:
    """Coefficients of the features, intercept first and not penalised, from the normal equations."""
    lift = side.map(basis)
    whole = lift @ gram[:-1, :-1] @ lift.T
    target = lift @ gram[:-1, -1]
    n = whole[0, 0]
    a = whole[1:, 1:] - np.outer(whole[0, 1:], whole[0, 1:]) / n + alpha * np.eye(len(whole) - 1)
    b = target[1:] - whole[0, 1:] * target[0] / n
    weights = np.linalg.lstsq(a, b, rcond=None)[0] if alpha == 0 else np.linalg.solve(a, b)
    return np.concatenate([[(target[0] - whole[0, 1:] @ weights) / n], weights])


def _newton_task(basis: Basis, coefficients: dict[int, np.ndarray], classes: int):
    pairs = [(c, d) for c in range(classes) for d in range(c, classes)]

    def task(batches):
        from pyspark import TaskContext

        totals: dict = {}
        for batch in batches:
            z_all = basis.matrix(batch)
            y_all = batch.column("_action").to_numpy(zero_copy_only=False).astype(int)
            for fold, own in _groups(batch, "fold"):
                z, y = z_all[own], y_all[own]
                for side, v in coefficients.items():
                    if side == fold:
                        continue
                    logits = z @ v
                    logits -= logits.max(axis=1, keepdims=True)
                    norm = np.log(np.exp(logits).sum(axis=1))
                    p = np.exp(logits - norm[:, None])
                    at = np.arange(len(y))
                    loss = float((norm - logits[at, y]).sum())
                    off = p.copy()
                    off[at, y] -= 1.0
                    curves = [z.T @ (z * (p[:, c] * ((c == d) - p[:, d]))[:, None]) for c, d in pairs]
                    sums = np.concatenate([[loss], (z.T @ off).ravel(), *(x.ravel() for x in curves)])
                    totals[side] = totals.get(side, 0.0) + sums
        yield from _emitted(totals, TaskContext.get().partitionId())

    return task


@dataclass
class _Search:
    """The Newton search of one side."""

    lift: np.ndarray
    rows: int
    penalty: np.ndarray
    weights: np.ndarray
    accepted: np.ndarray | None = None
    loss: float = np.inf
    step: np.ndarray | None = None
    share: float = 1.0
    slope: float = np.inf

    def take(self, sums: np.ndarray, tol: float) -> bool:
        """Use the sums at the current weights; true once they are the optimum."""
        d, c = self.weights.shape
        b = self.lift.shape[1]
        loss = sums[0] + 0.5 * float((self.penalty * self.weights**2).sum())
        if self.accepted is not None and loss > self.loss + 1e-12 * abs(self.loss) and self.share > 1e-6:
            self.share /= 2.0
            self.weights = self.accepted + self.share * self.step
            return False
        gradient = self.lift @ sums[1 : 1 + b * c].reshape(b, c) + self.penalty * self.weights
        self.accepted, self.loss, self.share = self.weights, loss, 1.0
        self.slope = float(np.abs(gradient).max()) / self.rows
        if self.slope <= tol:
            return True
        curves = iter(sums[1 + b * c :].reshape(-1, b, b))
        whole = np.zeros((c, d, c, d))
        for i in range(c):
            for j in range(i, c):
                block = self.lift @ next(curves) @ self.lift.T
                whole[i, :, j, :] = block
                whole[j, :, i, :] = block.T
        whole = whole.reshape(c * d, c * d) + np.diag(self.penalty.T.ravel())
        # all intercepts may move together: that direction is fixed, it changes no probability
        shared = np.zeros(c * d)
        shared[::d] = 1.0
        whole += np.outer(shared, shared) * self.rows / c
        self.step = -np.linalg.lstsq(whole, gradient.T.ravel(), rcond=None)[0].reshape(c, d).T
        self.weights = self.accepted + self.step
        return False


class SharedFits:
    """Behaviour and ridge models of the given sides; side 0 trains on all rows, side f on all but fold f."""

    def __init__(self, basis: Basis, sides: Sequence[int], spec: TrajectorySpec = DEFAULT):
        self.basis, self.sides, self.spec = basis, list(sides), spec
        self.stats: dict[tuple[int, int | None], Side] = {}
        self.behavior: dict[int, np.ndarray] = {}
        self.ridge: dict[str, dict[tuple[int, int], np.ndarray]] = {}
        self.inverse_c = 0.0
        self.alphas: dict[str, float] = {}
        self.passes = 0

    @classmethod
    def fit(cls, rows: DataFrame, sides: Sequence[int], *, behavior: dict | None = None, ridge: dict[str, float] | None = None,
            row_bound: int | None = None, spec: TrajectorySpec = DEFAULT) -> SharedFits | None:
        """``behavior`` holds the options of the logistic model, ``ridge`` the penalties by name; None if the basis is too wide."""
        basis = basis_of(rows, spec)
        if basis.size > MAX_BASIS:
            return None
        out = cls(basis, sides, spec)
        blocks = gram_blocks(rows, basis, spec)
        if not all(np.isfinite(b).all() for b in blocks.values()):
            raise ValueError("Observations and rewards must be finite.")
        every = range(len(spec.actions))
        if ridge:
            medians = _medians(rows, basis, sides, True, row_bound, spec)
            for side in sides:
                for action in every:
                    gram = _without_fold(blocks, side, [action])
                    if np.ndim(gram) == 0:
                        raise ValueError(f"No rows of {spec.actions[action]!r} outside fold {side}.")
                    own = out.stats[side, action] = _side(basis, gram, medians[side, action])
                    for name, alpha in ridge.items():
                        out.ridge.setdefault(name, {})[side, action] = ridge_coefficients(gram, own, basis, alpha)
            out.alphas = dict(ridge)
        if behavior is not None:
            medians = _medians(rows, basis, sides, False, row_bound, spec)
            for side in sides:
                out.stats[side, None] = _side(basis, _without_fold(blocks, side, every), medians[side, None])
            out._newton(_inputs(rows, basis, spec), **behavior)
        return out

    def _newton(self, inputs: DataFrame, *, regularization_c: float = 1.0, max_iter: int = 2_000, tol: float = 1e-8) -> None:
        classes, d = len(self.spec.actions), len(self.basis.names)
        self.inverse_c = 1.0 / regularization_c
        penalty = np.full((d, classes), self.inverse_c)
        penalty[0] = 0.0
        searches = {
            s: _Search(self.stats[s, None].map(self.basis), self.stats[s, None].rows, penalty, np.zeros((d, classes))) for s in self.sides
        }
        left = dict(searches)
        while left and self.passes < max_iter:
            coefficients = {s: x.lift.T @ x.weights for s, x in left.items()}
            sums = _summed(inputs, _newton_task(self.basis, coefficients, classes))
            self.passes += 1
            left = {s: x for s, x in left.items() if not x.take(sums[s], min(tol, 1e-9))}
        self.behavior = {s: x.accepted for s, x in searches.items()}

    def _weights(self) -> DataFrame:
        """One row per side: all coefficients in terms of the basis."""
        rows = []
        for side in self.sides:
            row: list = [side, []]
            if self.behavior:
                row[1] = (self.stats[side, None].map(self.basis).T @ self.behavior[side]).T.ravel().tolist()
            for fits in self.ridge.values():
                row.append([x for a in range(len(self.spec.actions)) for x in (self.stats[side, a].map(self.basis).T @ fits[side, a]).tolist()])
            rows.append(tuple(row))
        names = "".join(f", _{i} array<double>" for i in range(len(self.ridge)))
        return self._session.createDataFrame(rows, f"_side int, _b array<double>{names}")

    def predict(self, df: DataFrame, side: str = "fold") -> DataFrame:
        """Add ``b_i`` and ``<ridge name>_i`` of the side in a column: one join with a row per side, one projection."""
        self._session = df.sparkSession
        actions, size = range(len(self.spec.actions)), self.basis.size
        # As many rows as sides: a proven bound.
        joined = df.join(F.broadcast(self._weights()), F.col(side) == F.col("_side"))
        found = {}
        if self.behavior:
            joined = computed_once(joined, {f"_l{i}": F.expr(self.basis.product("_b", i * size)) for i in actions})
            most = F.greatest(*[F.col(f"_l{i}") for i in actions])
            total = sum((F.exp(F.col(f"_l{i}") - most) for i in actions), F.lit(0.0))
            found |= {c: F.exp(F.col(f"_l{i}") - most) / total for i, c in enumerate(self.spec.indexed("b"))}
        for k, name in enumerate(self.ridge):
            found |= {c: F.expr(self.basis.product(f"_{k}", i * size)) for i, c in enumerate(self.spec.indexed(name))}
        return joined.select(*df.columns, *[v.alias(c) for c, v in found.items()])

    def certificate(self, rows: DataFrame) -> DataFrame:
        """``model, side, action, feature, moment``: the first-order conditions of every fit, in one pass.

        ``moment`` is what the model says of the mean, over its training rows, of feature times class
        (behaviour) or feature times reward (ridge), with the penalty's part. At the optimum, and only there,
        that is the mean in the data.
        """
        basis, actions = self.basis, range(len(self.spec.actions))
        fitted = [*(self.spec.indexed("b") if self.behavior else []), *(c for name in self.ridge for c in self.spec.indexed(name))]
        of_class = len(actions) if self.behavior else 0

        def task(batches):
            from pyspark import TaskContext

            totals: dict = {}
            for batch in batches:
                z = basis.matrix(batch)
                logged = batch.column("_action").to_numpy(zero_copy_only=False)
                values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in fitted])
                for k in range(of_class, len(fitted)):  # a reward model trains on the rows of its own action
                    values[logged != (k - of_class) % len(actions), k] = 0.0
                for side, at in _groups(batch, "side"):
                    totals[side] = totals.get(side, 0.0) + z[at].T @ values[at]
            yield from _emitted(totals, TaskContext.get().partitionId())

        scored = self.predict(_sided(rows, self.sides), "side")
        inputs = _inputs(scored, basis, self.spec, ["side", *fitted])
        out = []
        for side, sums in _summed(inputs, task).items():
            sums = sums.reshape(basis.size, len(fitted))
            for k in range(len(fitted)):
                action = k % len(actions)
                if k < of_class:
                    model, own, weights = "behavior", self.stats[side, None], self.behavior[side][:, action] * self.inverse_c
                else:
                    model = list(self.ridge)[(k - of_class) // len(actions)]
                    own, weights = self.stats[side, action], self.ridge[model][side, action] * self.alphas[model]
                moments = (own.map(basis) @ sums[:, k] + np.concatenate([[0.0], weights[1:]])) / own.rows
                out += [(model, side, self.spec.actions[action], f, float(m)) for f, m in zip(basis.names, moments)]
        return rows.sparkSession.createDataFrame(out, "model string, side int, action string, feature string, moment double")
