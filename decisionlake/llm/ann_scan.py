"""Nearest neighbours by inverted lists and an adaptive scan of dimensions.

Vectors get one more component that makes all lengths equal, so that the largest inner product is the
smallest distance; they are turned by a random rotation and kept in column blocks. In each probed list
the distances of a block of queries to a block of vectors grow column block by column block. After
each, a hypothesis test compares the scaled partial distance with the query's bound, the distance of
its k-th best vector so far, and abandons the candidates that are too far. Those that stay to the end
are scored exactly, in double precision, on the original vectors.

The centroids, and how many lists a query must probe for a recall of ``RECALL``, are fitted on a
sample of at most about ``SAMPLE`` vectors; every vector is indexed. The nearest list of each query is
searched first and gives its bound for the others. A list with very many vectors or queries is cut into
blocks of each, of bounded size.

Cases: vectors that are null, zero, empty or have null or non-finite components take no part, nor do
those whose length is not the most frequent one (of equals the smallest); null ids take no part; rows
that repeat an id are candidates each, but never of a query with that id, and as queries are asked
once, with the first vector in order; ties go to the smaller id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.sources.storage import cut

BLOCK = 16
SAMPLE, MAX_LISTS, TURNS = 20_000, 1024, 8
RECALL, CALIBRATION = 0.985, 400
VECTORS, QUERIES = 4096, 512
#: Rows probed at least, so that small tables are searched in full.
LEAST = 2000
#: Of the test: a larger value abandons less.
EPSILON = 2.1


@dataclass
class Index:
    """``rows``: list, vec_id, vector and the rotated column blocks r0, r1, ...; the rest is of fixed size."""

    rows: DataFrame
    centroids: np.ndarray
    sizes: np.ndarray
    probes: int
    dimension: int
    rotation: np.ndarray
    longest: float

    @property
    def blocks(self) -> list[str]:
        return [f"r{i}" for i in range(-(-(self.dimension + 1) // BLOCK))]


def usable(df: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id, vector`` of the rows that take part, and their dimension."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad & F.exists(vector, lambda x: x != 0))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    frequent = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = frequent["d"] if frequent else 0
    return rows.filter(F.size("vector") == dimension), dimension


def _matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to the centroids, less what is the same for all of them."""
    return (centroids * centroids).sum(axis=1) - 2 * (x @ centroids.T)


def _augmented(x: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def fit(sample: np.ndarray, lists: int, k: int, longest: float) -> tuple[np.ndarray, int]:
    """Centroids by a few turns of k-means, and the lists to probe for ``RECALL`` within the sample."""
    random = np.random.default_rng(11)
    x = _augmented(sample, longest)
    centroids = x[random.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(TURNS):
        own = np.argmin(_nearest(x, centroids), axis=1)
        count = np.bincount(own, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, own, x)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    own = np.argmin(_nearest(x, centroids), axis=1)
    asked = random.choice(len(x), min(CALIBRATION, len(x)), replace=False)
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return centroids, len(centroids)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(_nearest(_augmented(sample[asked], longest, query=True), centroids), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, own[best], axis=1).reshape(-1))
    return centroids, int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1


def _index_task(shared, width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, rotation, longest = shared.value
        for batch in batches:
            x = _augmented(_matrix(batch.column("vector"), width), longest)
            own = np.argmin(_nearest(x, centroids), axis=1) if len(x) else np.empty(0, np.int64)
            turned = (x @ rotation).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), batch.column("vec_id"), batch.column("vector"),
                 *(_lists(turned[:, i * BLOCK : (i + 1) * BLOCK]) for i in range(len(names)))],
                ["list", "vec_id", "vector", *names],
            )

    return run


def build(df: DataFrame, k: int = 20) -> Index | None:
    """Index of ``df`` (vec_id, embedding); None if no vector takes part."""
    rows, dimension = usable(df)
    if not dimension:
        return None
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = rows.agg(F.count("*"), F.sqrt(F.max(norm))).first()
    chosen = rows.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) < min(1.0, SAMPLE / n) * (1 << 30))
    sample = _matrix(pa.array(chosen.orderBy("vec_id").select("vector").toPandas()["vector"].tolist(), pa.list_(pa.float64())), dimension)
    if not len(sample):
        sample = np.array([r[0] for r in rows.select("vector").take(1)])
    centroids, probes = fit(sample, max(1, min(MAX_LISTS, int(np.sqrt(n)))), k, longest)
    rotation = np.linalg.qr(np.random.default_rng(5).normal(size=(dimension + 1, dimension + 1)))[0]
    index = Index(rows, centroids, np.zeros(len(centroids), np.int64), probes, dimension, rotation, longest)
    schema = "list int, vec_id bigint, vector array<double>, " + ", ".join(f"{b} array<float>" for b in index.blocks)
    shared = df.sparkSession.sparkContext.broadcast((centroids, rotation, longest))
    index.rows = cut(rows.mapInArrow(_index_task(shared, dimension, index.blocks), schema), "vectors")
    for own, count in index.rows.groupBy("list").count().collect():
        index.sizes[own] = count
    return index


def _probe_task(shared, width: int, names: list[str]):
    """A row for each query and list to probe, in the order of nearness; turn 0 is the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, rotation, longest, sizes, probes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _augmented(_matrix(batch.column("vector"), width), longest, query=True)
            turned = (q @ rotation).astype(np.float32)
            order = np.argsort(_nearest(q, centroids) + np.where(sizes == 0, np.inf, 0.0), axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            take = ((np.arange(order.shape[1]) < probes) | (before < LEAST)) & (sizes[order] > 0)
            row, turn = np.nonzero(take)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), pa.array(turn.astype(np.int32)), pa.array(order[row, turn].astype(np.int32)),
                 batch.column("vector").take(at), *(_lists(turned[row, i * BLOCK : (i + 1) * BLOCK]) for i in range(len(names)))],
                ["query_id", "turn", "list", "vector", *names],
            )

    return run


def _scan_blocks(dimension: int, names: list[str], k: int, longest: float):
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("distance", pa.float64())])

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return out.empty_table()
        qid, vid = queries.column("query_id").to_numpy(), vectors.column("vec_id").to_numpy()
        bound = queries.column("bound").to_numpy()
        alive_q = alive_v = partial = None
        seen = 0
        for name in names:
            width = min(BLOCK, dimension + 1 - seen)
            q, v = _matrix(queries.column(name), width, np.float32), _matrix(vectors.column(name), width, np.float32)
            seen += width
            if partial is None:
                far = (q * q).sum(axis=1)[:, None] + (v * v).sum(axis=1)[None, :] - 2 * (q @ v.T)
            else:
                gap = q[alive_q] - v[alive_v]
                far = partial + np.einsum("ij,ij->i", gap, gap)
            limit = bound * (1 + EPSILON / np.sqrt(seen)) ** 2 * (seen / (dimension + 1)) if seen <= dimension else bound * 1.0001
            if partial is None:
                alive_q, alive_v = np.nonzero((far <= limit[:, None]) & (qid[:, None] != vid[None, :]))
                partial = far[alive_q, alive_v]
            else:
                stay = far <= limit[alive_q]
                alive_q, alive_v, partial = alive_q[stay], alive_v[stay], far[stay]
        # no more than is needed is scored: the k nearest of each query, with room for rounding
        order = np.lexsort((partial, alive_q))
        alive_q, alive_v, partial = alive_q[order], alive_v[order], partial[order]
        start = np.searchsorted(alive_q, np.arange(len(qid)))
        last = partial[np.minimum(start + k - 1, len(partial) - 1)] if len(partial) else np.zeros(len(qid))
        enough = np.diff(np.append(start, len(partial))) >= k
        stay = partial <= np.where(enough, last * 1.0001 + 1e-5 * longest**2, np.inf)[alive_q]
        alive_q, alive_v = alive_q[stay], alive_v[stay]
        q, v = _matrix(queries.column("vector"), dimension), _matrix(vectors.column("vector"), dimension)
        score = np.concatenate([np.einsum("ij,ij->i", q[a], v[b]) for a, b in zip(np.array_split(alive_q, len(alive_q) // 50_000 + 1), np.array_split(alive_v, len(alive_v) // 50_000 + 1))])
        order = np.lexsort((vid[alive_v], -score, alive_q))
        alive_q, alive_v, score = alive_q[order], alive_v[order], score[order]
        start = np.searchsorted(alive_q, alive_q)
        top = np.arange(len(alive_q)) - start < k
        alive_q, alive_v, score = alive_q[top], alive_v[top], score[top]
        length = (q * q).sum(axis=1)[alive_q] + longest**2
        return pa.Table.from_arrays([pa.array(qid[alive_q]), pa.array(vid[alive_v]), pa.array(score), pa.array(length - 2 * score)], schema=out)

    return run


def _blocks_of(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """Searches each query in its list: both sides are dealt into blocks of bounded size, and every pair of blocks meets once."""
    asked = dict(queries.groupBy("list").count().collect())  # at most a row for each list
    cuts = F.create_map(*[F.lit(x) for own, n in asked.items() for x in (own, -(-n // QUERIES))]) if asked else None
    if cuts is None:
        return index.rows.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double, distance double")
    parts = F.create_map(*[F.lit(x) for own in asked for x in (own, max(1, -(-int(index.sizes[own]) // VECTORS)))])
    q = queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), cuts[F.col("list")]))
    q = q.withColumn("vb", F.explode(F.sequence(F.lit(0).cast("bigint"), parts[F.col("list")].cast("bigint") - 1)))
    v = index.rows.filter(cuts[F.col("list")].isNotNull()).withColumn("vb", F.pmod(F.xxhash64("vec_id"), parts[F.col("list")]))
    v = v.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), cuts[F.col("list")].cast("bigint") - 1)))
    names = index.blocks
    q = q.select("list", "vb", "qb", "query_id", "bound", "vector", *names)
    v = v.select(F.col("list").alias("l"), F.col("vb").alias("b1"), F.col("qb").alias("b2"), "vec_id", "vector", *names)
    return q.groupBy("list", "vb", "qb").cogroup(v.groupBy("l", "b1", "b2")).applyInArrow(
        _scan_blocks(index.dimension, names, k, index.longest), "query_id bigint, vec_id bigint, score double, distance double"
    )


def search(index: Index | None, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each query (vec_id, embedding)."""
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked, dimension = usable(queries)
    asked = asked.filter(F.size("vector") == index.dimension).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    # few bytes become many here, which partitions merged by their size do not foresee
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id")
    shared = spark.sparkContext.broadcast((index.centroids, index.rotation, index.longest, index.sizes, index.probes))
    schema = "query_id bigint, turn int, list int, vector array<double>, " + ", ".join(f"{b} array<float>" for b in index.blocks)
    probes = cut(asked.mapInArrow(_probe_task(shared, index.dimension, index.blocks), schema), "probes")
    first = _blocks_of(index, probes.filter("turn = 0").withColumn("bound", F.lit(float("inf"))), k)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = cut(first.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k), "first")
    bounds = first.filter(F.col("rank") == k).select("query_id", F.col("distance").alias("bound"))
    others = probes.filter("turn > 0").join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    more = _blocks_of(index, others, k)
    found = first.select("query_id", "vec_id", "score").unionByName(more.select("query_id", "vec_id", "score"))
    found = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
