"""Benchmark decontamination by winnowing.

Both sides keep the minimum k-gram hash of every sliding window of ``span - k + 1`` k-grams, so that
any shared run of ``span`` words shares a kept fingerprint. Equal fingerprints are joined and extended
word by word; an extension of at least ``span`` words is a hit. Items shorter than ``span`` are one
window of their own length.

Of the benchmark only a bitmap of fixed size goes to the tasks, which spares the join most
fingerprints of clean text; it never decides a hit.

Cases: null text has no words; an item without words occurs nowhere; items that share an id are taken
together; an item without id makes hits, but is not listed; repeated rows each get their result;
either table may be empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.graph import bitmap, in_bitmap
from decisionlake.llm.text import LETTERS, Words, gram_hashes, minima, signed, slices
from decisionlake.sources.storage import cut

SPAN, K = 10, 5

_HIT = "hash bigint, pos int, words int, around array<bigint>"
_SCANNED = f"doc_id bigint, digest bigint, n_words bigint, found array<struct<{_HIT.replace(' ', ':').replace(',:', ',')}>>"


def _grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and validity of the k words from each word on; invalid where the text ends before."""
    grams = gram_hashes(words.hash, k)
    document = words.document()
    return grams, document[: len(grams)] == document[len(document) - len(grams) :]


def fingerprints(words: Words, span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are the minimum of a window within a text."""
    grams, valid = _grams(words, k)
    grams = np.where(valid, grams, np.uint64(2**64 - 1))
    width = span - k + 1
    low = minima(grams, width)
    if len(low) == 0:
        return np.empty(0, np.int64), grams[:0]
    # a gram is kept if it is the minimum of a window, that is of the window with the largest minimum
    edge = np.zeros(width - 1, np.uint64)
    most = ~minima(~np.concatenate([edge, low, edge]), width)
    at = np.flatnonzero((grams == most) & valid)
    return at, grams[at]


def _around(words: Words, at: np.ndarray, span: int, k: int) -> np.ndarray:
    """Hashes of the words from ``span - k`` before to ``span - k`` after each k-gram; 0 outside its text."""
    document = words.document()
    reach = np.arange(-(span - k), span)
    index = at[:, None] + reach[None, :]
    inside = (index >= 0) & (index < len(words.hash))
    index = np.where(inside, index, 0)
    inside &= document[index] == document[at][:, None] if len(document) else inside
    return np.where(inside, words.hash[index] if len(words.hash) else 0, np.uint64(0))


def _candidates(words: Words, span: int, k: int, lengths: tuple[int, ...], keep):
    """Position, hash, length in words and surroundings of what may be in the other table."""
    found = []
    for n in (span, *lengths):
        if n == span:
            at, h = fingerprints(words, span, k)
        else:
            grams, valid = _grams(words, n)
            at = np.flatnonzero(valid)
            h = grams[at]
        if keep is not None:
            passed = keep(h)
            at, h = at[passed], h[passed]
        around = _around(words, at, span, k) if n == span else np.zeros((len(at), 2 * span - k), np.uint64)
        found.append((at, h, np.full(len(at), n, np.int32), around))
    return [np.concatenate(x) for x in zip(*found)]


def _item_task(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                words = Words(rows.column("text"), LETTERS)
                counts = np.diff(words.at)
                lengths = tuple(sorted({int(n) for n in counts if 0 < n < span}))
                at, h, n, around = _candidates(words, span, k, lengths, None)
                item = words.document()[at] if len(at) else at
                whole = (n == span) | ((counts[item] == n) if len(at) else np.empty(0, bool))
                at, h, n, around, item = at[whole], h[whole], n[whole], around[whole], item[whole]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("item_id").take(pa.array(item)), pa.array(signed(h)), pa.array(n), _lists(around)],
                    ["item_id", "hash", "words", "around"],
                )

    return run


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(signed(rows.reshape(-1))))


def item_index(items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """``item_id, hash, words, around``: the windows' fingerprints of every item, written once."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    return cut(rows.mapInArrow(_item_task(span, k), "item_id bigint, hash bigint, words int, around array<bigint>").distinct(), "items")


def _document_task(span: int, k: int, lengths: tuple[int, ...], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keep(h):
            return in_bitmap(shared.value, h)

        for batch in batches:
            for rows in slices(batch):
                words = Words(rows.column("text"), LETTERS)
                at, h, n, around = _candidates(words, span, k, lengths, keep)
                document = words.document()[at] if len(at) else at
                order = np.argsort(document, kind="stable")
                at, h, n, around, document = at[order], h[order], n[order], around[order], document[order]
                found = pa.StructArray.from_arrays(
                    [pa.array(signed(h)), pa.array((at - words.at[document]).astype(np.int32)), pa.array(n), _lists(around)],
                    ["hash", "pos", "words", "around"],
                )
                cuts = np.searchsorted(document, np.arange(rows.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("digest"), pa.array(np.diff(words.at).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cuts), found)],
                    ["doc_id", "digest", "n_words", "found"],
                )

    return run


def _extend_task(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, side = 2 * span - k, span - k
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for c in ("around", "other"))
            pos = batch.column("pos").to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.column("words").to_numpy(zero_copy_only=False).astype(np.int64)
            same = (a == b) & (a != 0)
            left = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
            right = np.cumprod(same[:, side + k :], axis=1).sum(axis=1)
            short = n < span
            start = np.where(short, pos, pos - left)
            end = np.where(short, pos + n, pos + k + right)
            hit = short | ((end - start >= span) & same[:, side : side + k].all(axis=1))
            rows = batch.filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [rows.column("rid"), rows.column("window"), pa.array(start[hit].astype(np.int32)), pa.array(end[hit].astype(np.int32))],
                ["rid", "window", "start", "end"],
            )

    return run


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """``doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    ``digest`` is the hash of the text, ``xxhash64(text)``.
    """
    index = item_index(items, span, k)
    windows = cut(index.select("hash", "words", "around").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    lengths = tuple(sorted(r[0] for r in index.select("words").distinct().collect() if r[0] < span))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(index, "hash"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    scanned = rows.mapInArrow(_document_task(span, k, lengths, shared), _SCANNED)
    scanned = cut(scanned.withColumn("rid", F.monotonically_increasing_id()), "scanned")

    found = scanned.filter(F.size("found") > 0).select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    joined = found.join(windows.withColumnRenamed("around", "other"), ["hash", "words"])
    hits = cut(joined.select("rid", "window", "pos", "words", "around", "other").mapInArrow(
        _extend_task(span, k), "rid bigint, window bigint, start int, end int"), "hits")

    spans = hits.select("rid", "start", "end").distinct().groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    first = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("upto"))
    covered = F.aggregate("spans", first, lambda have, s: F.struct(
        (have["n"] + F.greatest(s["end"] - F.greatest(s["start"], have["upto"]), F.lit(0))).cast("bigint").alias("n"),
        F.greatest(have["upto"], s["end"]).alias("upto"),
    ))
    spans = spans.select("rid", covered["n"].alias("n_hit"))
    item = index.join(windows, ["hash", "words", "around"]).filter("item_id IS NOT NULL").select("window", "item_id").distinct()
    listed = hits.select("rid", "window").distinct().join(item, "window").groupBy("rid").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    none = F.array().cast("array<string>")
    out = scanned.drop("found").join(spans, "rid", "left").join(listed, "rid", "left").withColumn("items", F.coalesce("items", none))
    return out.select(
        "doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
