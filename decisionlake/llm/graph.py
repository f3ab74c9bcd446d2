"""Connected components and fixed-size membership bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.text import giving_back
from decisionlake.sources.storage import cut

#: Edges that one task hangs on the smallest nodes that they reach among themselves.
TASK_EDGES = 1 << 18


def smallest_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges ``a``-``b`` and the smallest node that each reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        one, two = root[x], root[y]
        apart = one != two
        if not apart.any():
            return nodes, nodes[root]
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while not np.array_equal(root, up := root[root]):
            root = up


@giving_back
def _hang_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = list(batches)
    a, b = (np.concatenate([np.empty(0, np.int64), *(x.column(c).to_numpy() for x in rows)]) for c in ("u", "v"))
    nodes, root = smallest_reached(a, b)
    below = nodes != root
    yield pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(root[below])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); the root is the smallest node reachable.

    Alternates two steps that hang the larger neighbours, then the smaller ones, on the smallest
    neighbour, until nothing changes; the number of turns grows with the logarithm of a path's
    length. No group of neighbours is ever gathered, only its minimum. Edges are written in each turn.
    Before, tasks of ``TASK_EDGES`` edges do the same among their own edges; where one task has them all
    no turn is needed.
    """
    rows = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    rows, before = cut(rows, "edges"), None
    tasks = -(-rows.count() // TASK_EDGES)
    if tasks:
        rows = cut(rows.repartition(tasks).mapInArrow(_hang_task, "u bigint, v bigint"), "edges")
    while tasks > 1:
        both = rows.unionAll(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        rows = cut(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        now = rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = rows.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return rows.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


BITS = 25


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A bit for the leading ``bits`` of each 64-bit hash: of fixed size, whatever the number of rows.

    The words of 64 bits are put together by an aggregation; at most 2**bits / 64 of them reach the
    driver.
    """
    bit = F.shiftrightunsigned(F.col(column), 64 - bits)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")
    rows = hashes.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    found = rows.toPandas()
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def in_bitmap(words: np.ndarray, hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether each unsigned hash may be in the set; never false for one that is."""
    at = hashes >> np.uint64(64 - bits)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
