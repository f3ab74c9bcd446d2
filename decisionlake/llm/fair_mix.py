"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow with a target number of words. Its documents are shuffled, once for each
repeat that is allowed, and each entry gets a virtual finish time: the words of its source up to and
with it, divided by the source's target. The entries of all sources, sorted by that time, are taken
until the total budget is used. A source so gets its target to within about a document.

Sums along an order are never made in one task: rows are range-sorted, summed within each range, and
moved by the totals of the ranges before.

Cases: null and empty texts have size 0 and are never taken; a null source is a source of its own,
last in order; rows alike in id, source and text are one document of that many times its size, and
each of them gets the same ``taken``; with no words at all targets and ``taken`` are 0; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.llm.text import Words, slices
from decisionlake.sources.storage import cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            counts = np.diff(Words(rows.column("text")).at).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("source"), rows.column("digest"), pa.array(counts)],
                ["doc_id", "source", "digest", "size"],
            )


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``digest``, which tells apart rows that share an id."""
    return docs.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, digest, size, copies``: one row for rows alike in id, source and text."""
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"))
    rows = rows.select("doc_id", "source", "digest", "text").mapInArrow(
        _count_words, "doc_id bigint, source string, digest string, size bigint"
    )
    return rows.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: its place, its words, its target, and the budget of all.

    Water filling: sources in the order of the level at which they are full; a source is full where
    the level reached by what is left, shared among the sources not yet full, is above its own.
    """
    rows = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("place", place).withColumn("weight", weight)
    rows = rows.withColumn("cap", F.col("source_size") * float(repeats))
    full = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    every, before = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), full.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "budget": F.sum("source_size").over(every) * F.lit(float(share)),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("cap_before")) / F.col("weight_left")
    rows = rows.withColumn("level", level).withColumn("is_full", F.col("cap") / F.col("weight") <= F.col("level"))
    open_level = F.min(F.when(~F.col("is_full"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(every)
    rows = rows.withColumn("open_level", open_level["level"])
    target = F.when(F.col("is_full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("open_level")))
    return rows.select("source", "place", "source_size", target.alias("target"), "budget")


def _running(by: str | None, value: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carried, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(values)
            if by is None:
                sums = total + carried
            else:
                group = batch.column(by).to_numpy(zero_copy_only=False)
                first = np.concatenate([[True], group[1:] != group[:-1]])
                start = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
                sums = total - (total[start] - values[start])
                sums = np.where(start == 0, sums + (carried if group[0] == last else 0), sums)
                last = group[-1]
            carried = int(sums[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums), pa.array(np.full(batch.num_rows, part, np.int32))],
                [*batch.schema.names, "_local", "_part"],
            )

    return run


def running_sum(df: DataFrame, order: list[str | Column], value: str, out: str, by: str | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` along ``order``, up to and with the row, within ``by``.

    ``by`` must lead ``order`` and have no nulls. The rows are written once, range-sorted.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_local", T.LongType()), T.StructField("_part", T.IntegerType())])
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running(by, value), schema)
    rows = cut(rows, "running")
    keys = ["_part", *([by] if by else [])]
    before = Window.partitionBy(*([by] if by else [])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    offsets = offsets.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, keys).withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_part", "_before")


def fair_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """``doc_id, source, digest, size, copies, source_size, target, times, taken`` per document."""
    sized = cut(sizes(docs), "sizes")
    goals = cut(targets(sized, weights, share, repeats), "targets")
    budget = goals.agg(F.max("budget")).first()[0] or 0.0
    rows = sized.join(goals.drop("budget"), sized["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    rows = cut(rows.withColumn("words", F.col("size") * F.col("copies")), "mix-documents")
    entries = rows.filter("words > 0").select(
        "place", "target", "words", "doc_id", "digest", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")
    )
    seeded = F.concat_ws(":", F.lit(str(seed)), "turn", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest")
    entries = entries.withColumn("shuffled", F.md5(seeded))
    flow = running_sum(entries, ["place", "turn", "shuffled", "doc_id"], "words", "flow_words", by="place")
    flow = flow.withColumn("finish", F.col("flow_words") / F.col("target"))
    queue = running_sum(flow.select("finish", "place", "turn", "shuffled", "words", "doc_id", "digest"),
                        ["finish", "place", "turn", "shuffled", "doc_id"], "words", "used")
    taken = queue.filter(F.col("used") <= F.lit(budget)).groupBy("doc_id", "place", "digest").agg(F.count("*").alias("times"))
    same = rows["doc_id"].eqNullSafe(taken["doc_id"]) & (rows["place"] == taken["place"]) & (rows["digest"] == taken["digest"])
    out = rows.join(taken, same, "left").select(rows["*"], F.coalesce(taken["times"], F.lit(0)).alias("times"))
    return out.withColumn("taken", F.col("times") * F.col("size"))


def per_row(mixed: DataFrame) -> DataFrame:
    """A row for each row of the input, repeated rows included."""
    rows = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with the columns of ``docs``."""
    times = fair_mix(docs, **options).filter("times > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"), "times"
    ).withColumnRenamed("times", "_times")
    rows = docs.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id"))
        & F.col("source").cast("string").eqNullSafe(F.col("_source")) & (F.col("_key") == F.col("_digest"))
    )
    rows = rows.join(times, same).withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    return rows.select(*docs.columns)
