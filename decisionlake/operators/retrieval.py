"""Nearest factual examples of every query state, per action/outcome cell."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.operators.factual import LABELS, assert_library
from decisionlake.operators.features import FeatureStats, fit_features
from decisionlake.operators.scale import top_per_group
from decisionlake.operators.validate import require_columns
from decisionlake.sources.storage import cut
from decisionlake.spec import DEFAULT, TrajectorySpec

#: Library rows whose feature matrix is shipped to the tasks at once.
BLOCK_ROWS = 20_000
#: Distances taken at once.
NEAR_NUMBERS = 1 << 15


def library_features(library: DataFrame, spec: TrajectorySpec = DEFAULT) -> FeatureStats:
    """Fitted on the library itself, which is capped per cell."""
    return fit_features(library, row_bound=library.count(), spec=spec)


def nearest_examples(
    queries: DataFrame,
    library: DataFrame,
    *,
    key: Sequence[str] | None = None,
    examples_per_cell: int = 1,
    exclude: str | Column | None = None,
    spec: TrajectorySpec = DEFAULT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per query and cell the nearest library rows: ``key, action, outcome_label, place,
    library_rank, retrieval_distance``.

    Distances are taken inside each query batch against the library matrix, so a task
    emits only its winners and the queries are never shuffled. A library beyond
    ``block_rows`` is walked in blocks whose winners are merged, which stays exact.
    """
    key = list(key or spec.key)
    if examples_per_cell <= 0:
        raise ValueError("Ask for at least one example per cell.")
    require_columns(queries, [*key, *spec.observations])
    assert_library(library, spec)
    sizes = _cell_sizes(library, spec)
    if min(n for n, _ in sizes) < examples_per_cell:
        raise ValueError(f"A cell of the library has fewer than {examples_per_cell} examples.")
    stats = library_features(library, spec)
    excluded = F.lit(None).cast("string") if exclude is None else (
        F.col(exclude) if isinstance(exclude, str) else exclude
    )
    asked = queries.select(
        *key, excluded.cast("string").alias("_exclude"), F.array(*stats.columns()).alias("_x")
    )
    known = library.select(
        "source_patient_id", "action", "outcome_label", "library_rank",
        F.array(*stats.columns()).alias("_x"),
    )
    size = library.count()

    def whole(found: DataFrame) -> DataFrame:
        # an exclusion drops one patient's examples: only where that may empty a cell is the result checked
        if exclude is not None and min(n - most for n, most in sizes) < examples_per_cell:
            found = cut(found, "retrieved")
            assert_complete(queries, found, key=key, examples_per_cell=examples_per_cell, spec=spec)
        return found

    if size <= block_rows:
        return whole(_search(asked, known, key, examples_per_cell, spec))

    edges = [r["e"] for r in known.select(
        F.explode(F.percentile_approx(
            "library_rank", [i / (2 * size // block_rows) for i in range(1, 2 * size // block_rows)], 100_000
        )).alias("e")
    ).collect()]
    bounds = [None, *sorted(set(edges)), None]
    found = None
    for low, high in zip(bounds, bounds[1:]):
        block = known
        if low is not None:
            block = block.filter(F.col("library_rank") > low)
        if high is not None:
            block = block.filter(F.col("library_rank") <= high)
        part = _search(asked, block, key, examples_per_cell, spec)
        found = part if found is None else found.unionByName(part)
    return whole(top_per_group(
        found.drop("place"), [*key, "action", "outcome_label"],
        ["retrieval_distance", "library_rank"], examples_per_cell, name="place",
    ))


def _cell_sizes(library: DataFrame, spec: TrajectorySpec) -> list[tuple[int, int]]:
    """Rows of each cell and of its most frequent patient; (0, 0) for a cell without rows."""
    rows = library.groupBy("action", "outcome_label", "source_patient_id").agg(F.count("*").alias("n"))
    rows = rows.groupBy("action", "outcome_label").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    found = {(r["action"], r["outcome_label"]): (r["n"], r["most"]) for r in rows}
    return [found.get((a, label), (0, 0)) for a in spec.actions for label in LABELS]


class _Cells:
    """The library's matrix, a column after the other, its rows cell by cell in library order; shipped to the tasks."""

    def __init__(self, known: DataFrame, spec: TrajectorySpec):
        table = known.orderBy("library_rank").toPandas()
        matrix = np.array(table["_x"].tolist(), dtype=float).reshape(len(table), -1)
        order, self.cells, at = [np.empty(0, int)], [], 0
        for a, label in [(a, label) for a in spec.actions for label in LABELS]:
            rows = np.flatnonzero(((table["action"] == a) & (table["outcome_label"] == label)).to_numpy())
            if len(rows):
                self.cells.append((a, label, at, at + len(rows)))
                order.append(rows)
                at += len(rows)
        order = np.concatenate(order)
        self.matrix = np.ascontiguousarray(matrix[order].T)
        self.finite = bool(np.isfinite(self.matrix).all())
        self.ranks = table["library_rank"].to_numpy()[order]
        self.owned: dict[object, list[int]] = {}
        for i, owner in enumerate(table["source_patient_id"].to_numpy(dtype=object)[order]):
            if owner == owner:
                self.owned.setdefault(owner, []).append(i)

    def _distances(self, x: np.ndarray, excluded: np.ndarray) -> np.ndarray:
        total, gap = np.zeros((x.shape[1], len(self.ranks))), np.empty((x.shape[1], len(self.ranks)))
        for own, known in zip(x, self.matrix):
            np.subtract(own[:, None], known, out=gap)
            np.multiply(gap, gap, out=gap)
            total += gap
        np.sqrt(total, out=total)
        if not self.finite:
            total[np.isnan(total)] = np.inf
        for i, patient in enumerate(excluded):
            for j in self.owned.get(patient, ()):
                total[i, j] = np.inf
        return total

    def nearest(self, x: np.ndarray, excluded: np.ndarray, n: int):
        """Per cell and place ``action, label, place, rows found, library rank, distance``."""
        x = np.ascontiguousarray(x.reshape(len(excluded), -1).T)
        best: list[list] = [[] for _ in self.cells]
        step = max(1, NEAR_NUMBERS // max(1, len(self.ranks)))  # distances that stay in a core's own cache
        for start in range(0, max(1, len(excluded)), step):
            distance = self._distances(x[:, start:start + step], excluded[start:start + step])
            for found, (_, _, low, high) in zip(best, self.cells):
                part = distance[:, low:high]
                # the first of equal distances, as in a stable order
                order = part.argmin(axis=1)[:, None] if n == 1 else np.argsort(part, axis=1, kind="stable")[:, :n]
                found.append((low + order, np.take_along_axis(part, order, axis=1)))
        for (a, label, _, _), found in zip(self.cells, best):
            rows, near = (np.concatenate(parts) for parts in zip(*found))
            for place in range(rows.shape[1]):
                yield a, label, place, np.isfinite(near[:, place]), self.ranks[rows[:, place]], near[:, place]


def _search(asked, known, key, examples_per_cell, spec):
    cells = _Cells(known, spec)
    schema = T.StructType(
        [asked.schema[c] for c in key]
        + [
            T.StructField("action", T.StringType()),
            T.StructField("outcome_label", T.StringType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("library_rank", T.LongType()),
            T.StructField("retrieval_distance", T.DoubleType()),
        ]
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 2_000):
                yield best(whole.iloc[start:start + 2_000])

    def best(batch: pd.DataFrame) -> pd.DataFrame:
        x = np.array(batch["_x"].tolist(), dtype=float)
        out = []
        for a, label, place, keep, rank, distance in cells.nearest(x, batch["_exclude"].to_numpy(dtype=object), examples_per_cell):
            frame = batch.loc[keep, key].copy()
            frame["action"] = a
            frame["outcome_label"] = label
            frame["place"] = np.int32(place + 1)
            frame["library_rank"] = rank[keep]
            frame["retrieval_distance"] = distance[keep]
            out.append(frame)
        if not out:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        return pd.concat(out, ignore_index=True)

    return asked.mapInPandas(search, schema)


def ranked_examples(
    queries: DataFrame, library: DataFrame, *, examples_per_cell: int = 1,
    exclude: str | Column | None = None, spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """Every query as it is, with ``ranks``: the library ranks of its nearest examples, ascending.

    One row in, one row out, so queries are neither shuffled nor joined back, and rows of one key stay
    apart. The library is shipped whole: it may have ``BLOCK_ROWS`` rows at most. A query left short of
    examples by its exclusion fails in the plan itself.
    """
    if examples_per_cell <= 0:
        raise ValueError("Ask for at least one example per cell.")
    require_columns(queries, spec.observations)
    assert_library(library, spec)
    sizes = _cell_sizes(library, spec)
    if min(n for n, _ in sizes) < examples_per_cell:
        raise ValueError(f"A cell of the library has fewer than {examples_per_cell} examples.")
    if sum(n for n, _ in sizes) > BLOCK_ROWS:
        raise ValueError(f"A library of more than {BLOCK_ROWS} rows is searched by nearest_examples.")
    stats = library_features(library, spec)
    cells = _Cells(library.select(
        "source_patient_id", "action", "outcome_label", "library_rank", F.array(*stats.columns()).alias("_x"),
    ), spec)
    excluded = F.lit(None) if exclude is None else F.col(exclude) if isinstance(exclude, str) else exclude
    asked = queries.withColumns({"_exclude": excluded.cast("string"), "_x": F.array(*stats.columns())})
    kept, wanted = queries.columns, examples_per_cell * len(sizes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False)
                found = list(cells.nearest(x, batch.column("_exclude").to_numpy(zero_copy_only=False), examples_per_cell))
                hits = np.stack([keep for _, _, _, keep, _, _ in found], axis=1)
                far = np.iinfo(np.int64).max
                ranks = np.sort(np.where(hits, np.stack([rank for *_, rank, _ in found], axis=1), far), axis=1)
                ends = np.concatenate([[0], np.cumsum(hits.sum(axis=1))]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(ranks[ranks < far]))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], column], [*kept, "ranks"])

    schema = T.StructType([*queries.schema.fields, T.StructField("ranks", T.ArrayType(T.LongType()))])
    found = asked.mapInArrow(search, schema)
    short = F.raise_error(F.lit("Not enough examples in a cell after exclusions."))
    return found.withColumn("ranks", F.when(F.size("ranks") == wanted, F.col("ranks")).otherwise(short))


def retrieve_examples(
    queries: DataFrame, library: DataFrame, *, key: Sequence[str] | None = None,
    examples_per_cell: int = 1, exclude: str | Column | None = None,
    spec: TrajectorySpec = DEFAULT,
) -> DataFrame:
    """The nearest examples with their library columns, next to the query key."""
    key = list(key or spec.key)
    found = nearest_examples(
        queries, library, key=key, examples_per_cell=examples_per_cell, exclude=exclude, spec=spec
    )
    rows = library.drop("action", "outcome_label")
    return found.join(rows, "library_rank")


def assert_complete(
    queries: DataFrame, retrieved: DataFrame, *, key: Sequence[str] | None = None,
    examples_per_cell: int = 1, spec: TrajectorySpec = DEFAULT,
) -> None:
    """Raise when any query found fewer examples than asked for in some cell."""
    key = list(key or spec.key)
    wanted = examples_per_cell * len(spec.actions) * len(LABELS)
    counts = retrieved.groupBy(*key).agg(F.count("*").alias("_n"))
    short = queries.select(*key).join(counts, key, "left").filter(
        F.coalesce(F.col("_n"), F.lit(0)) < wanted
    )
    if not short.isEmpty():
        raise ValueError("Not enough examples in a cell after exclusions.")


def prompt_safe_records(examples: DataFrame, keep: Sequence[str] = (), spec: TrajectorySpec = DEFAULT) -> DataFrame:
    """State, action and label only: no rewards, propensities, distances or provenance."""
    return examples.select(
        *keep,
        F.struct(*spec.observations).alias("state"),
        F.col("action").alias("logged_action"),
        F.col("outcome_label").alias("observed_outcome_label"),
    )
