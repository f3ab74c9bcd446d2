"""Repeated passages: matching statistics on run-length compressed suffix indexes.

Every window of ``length`` bytes is given to the k-gram in it with the smallest hash, its anchor;
windows in a row with the same anchor form a context, a short piece of text. Equal windows have equal
anchors, so contexts can be dealt out by anchor and no text meets another one as a whole. Contexts
equal to an earlier one are marked at once, in the task that cut them or where their anchors meet.
What is left, contexts that share an anchor but not all their bytes, is put together in shards of
whole anchors, in document order. A shard gets a suffix array, of which the Burrows-Wheeler transform
is kept as runs, with the suffix at the head of each run and its match with the suffix before. Matching
statistics of all positions follow by streaming over the text: between samples they fall by one at each
byte. Positions whose statistics reach ``length`` and that have an earlier one among their matches are
marked. An anchor with more contexts than a shard holds has its windows compared by their hashes.

Cases: a null text is empty; texts shorter than ``length`` keep every byte; null ids come before all
others; rows alike in id and text are one document, which does not repeat itself by being listed twice,
and each gets its result; texts that share only the id (up to 2**26 of them) are ordered by their hash; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.graph import bitmap, in_bitmap
from decisionlake.llm.text import Prefix, column_bytes, giving_back, minima, ranges, signed, slices
from decisionlake.operators.scale import number_in_blocks
from decisionlake.sources.storage import cut

LENGTH, K = 100, 32
SHARD_BYTES = 512 << 10
#: Contexts of one anchor that still go into a shard.
MOST_CONTEXTS = 5000
#: A place in a document as one number: 26 bits for the text's number among those of its id, the offset, the number of windows.
_COUNT_BITS, _PLACE_BITS = 7, 38
_KEY = "doc_id bigint, digest bigint"


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, text``: null ids as the least number, and a number that tells the texts of one id apart.

    Texts that share an id are numbered in the order of their hash; an id of one text has number 0.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    many = rows.groupBy("doc_id").agg((F.min("hash") != F.max("hash")).alias("many")).filter("many").select("doc_id")
    texts = cut(rows.select("doc_id", "hash").join(many, "doc_id", "left_semi").distinct(), "shared-ids")
    if texts.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("bigint").alias("digest"), "text")
    numbered = number_in_blocks(texts, ["doc_id"], F.shiftright("hash", 48), ["hash"], "digest")
    numbered = cut(numbered.select(F.col("doc_id").alias("i"), F.col("hash").alias("g"), F.col("digest").cast("bigint").alias("digest")), "numbers")
    if numbered.agg(F.max("digest")).first()[0] >= 1 << (64 - _PLACE_BITS):
        raise ValueError(f"More than {1 << (64 - _PLACE_BITS)} different texts share one id.")
    same = (F.col("doc_id") == F.col("i")) & (F.col("hash") == F.col("g"))
    return rows.join(numbered, same, "left").select("doc_id", F.coalesce("digest", F.lit(0).cast("bigint")).alias("digest"), "text")


def cut_contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K):
    """``document, start, windows, anchor hash, context hash`` of all contexts of consecutive texts."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = Prefix(data, fold=False)
    grams = prefix.hash_all(k)
    bits = np.uint64(max(21, int(len(grams)).bit_length()))
    low = minima(((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64), length - k + 1)
    anchor = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = document[: len(anchor)] == document[length - 1 : length - 1 + len(anchor)]
    first = whole.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    last = whole.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~whole[1:]
    # two texts that meet at a boundary have no window across it, so a run never joins them
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return document[start], start, end - start + 1, grams[anchor[start]], prefix.hash(start, end + length)


def _context_task(length: int, k: int):
    """Contexts with their places; a context that its task has seen before goes on as a mark alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, limit=SHARD_BYTES):
                data, offsets = column_bytes(rows.column("text"))
                document, start, n, h, c = cut_contexts(data, offsets, length, k)
                ids = rows.column("doc_id").to_numpy()[document]
                digest = rows.column("digest").to_numpy()[document].astype(np.uint64)
                place = signed((digest << np.uint64(_PLACE_BITS)) | ((start - offsets[document]).astype(np.uint64) << np.uint64(_COUNT_BITS)) | n.astype(np.uint64))
                order = np.lexsort((place, ids, c))
                ids, place, h, c = ids[order], place[order], signed(h[order]), signed(c[order])
                same = np.zeros(len(c), bool)
                same[1:] = c[1:] == c[:-1]
                again = same.copy()
                again[1:] &= (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])
                h = np.where(same, c + np.arange(len(c)), h)  # marks are dealt anywhere
                keep = ~again
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep]) for x in (h, c, ids, place)] + [pa.array(same[keep])], ["h", "c", "doc_id", "place", "marked"]
                )

    return giving_back(run)


@giving_back
def _meet_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, context and place: all but the first of a context are marked, and the
    first ones pass if their anchor has another context."""
    held = None  # first context of the current anchor, not passed yet
    last = (None, None, None, None)
    for batch in batches:
        h, c, ids, place = (batch.column(x).to_numpy() for x in ("h", "c", "doc_id", "place"))
        marked = batch.column("marked").to_numpy(zero_copy_only=False)
        out_id, out_place = [ids[marked]], [place[marked]]
        rest = ~marked
        h, c, ids, place = h[rest], c[rest], ids[rest], place[rest]
        pass_h, pass_id, pass_place = [], [], []
        if len(h):
            new_h = np.concatenate([[h[0] != last[0]], h[1:] != h[:-1]])
            new_c = new_h | np.concatenate([[c[0] != last[1]], c[1:] != c[:-1]])
            again = np.concatenate([[(ids[0], place[0]) == last[2:]], (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])])
            dup = ~new_c & ~again
            out_id.append(ids[dup])
            out_place.append(place[dup])
            at = np.flatnonzero(new_c)
            group = np.cumsum(new_h[at]) - 1 + (0 if new_h[0] else 1)  # 0: the anchor carried over
            many = np.bincount(group)
            if len(many) and not new_h[0] and many[0] and held is not None:
                for store, value in zip((pass_h, pass_id, pass_place), held):
                    store.append(np.array([value]))
                held = None
            passed = (many[group] > 1) | ((group == 0) & (not new_h[0]))
            final = group == group[-1] if len(group) else passed
            alone = np.flatnonzero(final & ~passed)
            if len(at) and new_h.any():
                held = None
            if len(alone):
                i = at[alone[0]]
                held = (h[i], ids[i], place[i])
            pass_h.append(h[at[passed]])
            pass_id.append(ids[at[passed]])
            pass_place.append(place[at[passed]])
            last = (h[-1], c[-1], ids[-1], place[-1])
        out_id, out_place = np.concatenate(out_id), np.concatenate(out_place)
        went = [np.concatenate([*x, np.empty(0, np.int64)]) for x in (pass_h, pass_id, pass_place)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(len(out_id), np.int64), went[0]])), pa.array(np.concatenate([out_id, went[1]])),
             pa.array(np.concatenate([out_place, went[2]])), pa.array(np.arange(len(out_id) + len(went[0])) < len(out_id))],
            ["h", "doc_id", "place", "marked"],
        )


def suffix_array(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes of pieces that each end before a mark of their own, smaller than any byte.

    ``text`` holds bytes + 1, and 0 for the marks at ``ends``. ``depth`` is at least a piece's length.
    """
    n = len(text)
    wide = np.concatenate([text, np.zeros(8, np.uint64)]).astype(np.uint64)
    key, open_ = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(7):
        symbol = np.where(open_, wide[i : i + n], 0)
        key = (key << np.uint64(9)) | symbol
        open_ &= symbol > 0
    piece = np.repeat(np.arange(len(starts)), ends - starts + 1)
    tie = np.where(open_, 0, piece + 1)
    order = np.lexsort((tie, key))
    changed = np.concatenate([[False], (key[order[1:]] != key[order[:-1]]) | (tie[order[1:]] != tie[order[:-1]])])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(changed)
    have = 7
    while have < depth + 1 and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - have] = rank[have:] + 1
        key = rank * np.int64(n + 1) + second
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate([[False], key[order[1:]] != key[order[:-1]]]))
        have *= 2
    return order


def run_samples(text: np.ndarray, order: np.ndarray):
    """Of the runs of the Burrows-Wheeler transform: the suffix at each head, its predecessor, and their match."""
    before = text[order - 1]  # the mark of the last piece precedes the first suffix
    before = np.where(before == 0, 256 + np.arange(len(order)), before)  # marks all differ
    heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
    suffix, former = order[heads], order[np.maximum(heads - 1, 0)]
    match = np.zeros(len(heads), np.int64)
    alive = np.flatnonzero(heads > 0)
    wide = np.concatenate([text, [0]])
    while len(alive):
        a, b = suffix[alive] + match[alive], former[alive] + match[alive]
        equal = (wide[np.minimum(a, len(text))] == wide[np.minimum(b, len(text))]) & (wide[np.minimum(a, len(text))] > 0)
        alive = alive[equal]
        match[alive] += 1
    return suffix, match


def matching_statistics(n: int, suffix: np.ndarray, match: np.ndarray) -> np.ndarray:
    """Match of every suffix with the one before it in order, from the samples at the heads of runs."""
    by = np.argsort(suffix)
    suffix, match = suffix[by], match[by]
    at = np.searchsorted(suffix, np.arange(n), side="right") - 1
    return np.maximum(match[at] - (np.arange(n) - suffix[at]), 0)


def mark_repeats(pieces: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """``piece, offset`` of each window that also starts earlier, in the order of the pieces."""
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    text = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + 1
    order = suffix_array(text, starts, ends, int(sizes.max()))
    suffix, match = run_samples(text, order)
    shared = matching_statistics(len(text), suffix, match)[order]
    shared[0] = 0
    heads = np.flatnonzero(shared < length)
    least = np.minimum.reduceat(order, heads)
    group = np.cumsum(shared < length) - 1
    marked = np.sort(order[order > least[group]])
    piece = np.searchsorted(ends, marked)
    return piece, marked - starts[piece]


def _fetch_task(length: int):
    """Bytes of the contexts of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (rows for whole in batches for rows in slices(whole)):
            data, offsets = column_bytes(batch.column("text"))
            data = data.tobytes()
            wanted = batch.column("wanted")
            at = wanted.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            flat = wanted.values.slice(at[0], at[-1] - at[0])
            h, place = (flat.field(i).to_numpy() for i in (0, 1))
            start, n = _start_count(place)
            begin = offsets[row] + start
            pieces = [data[b : b + m] for b, m in zip(begin.tolist(), (n + length - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), batch.column("doc_id").take(pa.array(row)), pa.array(place), pa.array(pieces, pa.binary())], ["h", "doc_id", "place", "piece"]
            )

    return giving_back(run)


def _start_count(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = place.view(np.uint64)
    return ((p >> np.uint64(_COUNT_BITS)) & np.uint64((1 << (_PLACE_BITS - _COUNT_BITS)) - 1)).astype(np.int64), (p & np.uint64(127)).astype(np.int64)


def _spans(ids, place, piece, offset, length: int) -> pa.RecordBatch:
    """Byte spans of marked windows, neighbours in a piece joined."""
    if not len(piece):
        empty = pa.array([], pa.int64())
        return pa.RecordBatch.from_arrays([empty, empty, empty, empty], ["doc_id", "digest", "start", "stop"])
    first = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    last = np.append(first[1:], len(piece)) - 1
    own = piece[first]
    start = _start_count(place[own])[0]
    digest = (place[own].view(np.uint64) >> np.uint64(_PLACE_BITS)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[own]), pa.array(digest), pa.array(start + offset[first]), pa.array(start + offset[last] + length)], ["doc_id", "digest", "start", "stop"]
    )


def _shard_task(length: int):
    """Fills shards with whole anchors, from rows sorted by anchor, and marks in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table) -> pa.RecordBatch:
            h, ids, place = (rows.column(x).to_numpy() for x in ("h", "doc_id", "place"))
            order = np.lexsort((place, ids))
            pieces = rows.column("piece").to_pylist()
            piece, offset = mark_repeats([pieces[i] for i in order], length)
            return _spans(ids[order], place[order], piece, offset, length)

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            size += batch.column("piece").nbytes
            if size < SHARD_BYTES:
                continue
            rows = pa.Table.from_batches(kept)
            h = rows.column("h").to_numpy()
            end = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
            if end:
                yield flush(rows.slice(0, end))
                rows = rows.slice(end)
            kept = rows.combine_chunks().to_batches()
            size = sum(b.column("piece").nbytes for b in kept)
        if kept:
            yield flush(pa.Table.from_batches(kept))

    return giving_back(run)


def _window_task(length: int):
    """Hash and place of each window of a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, place = batch.column("doc_id").to_numpy(), batch.column("place").to_numpy()
            data, offsets = column_bytes(batch.column("piece"))
            start, n = _start_count(place)
            row = np.repeat(np.arange(len(n)), n)
            at = ranges(offsets[:-1], n)
            h = Prefix(data, fold=False).hash(at, at + length)
            own = (place.view(np.uint64)[row] & ~np.uint64((1 << _PLACE_BITS) - 1)) | ((start[row] + at - offsets[row]).astype(np.uint64) << np.uint64(_COUNT_BITS)) | np.uint64(1)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(ids[row]), pa.array(signed(own))], ["w", "doc_id", "place"])

    return giving_back(run)


def _marks_of(rows: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, start, stop`` of places."""
    start = F.shiftrightunsigned("place", _COUNT_BITS).bitwiseAND((1 << (_PLACE_BITS - _COUNT_BITS)) - 1)
    n = F.col("place").bitwiseAND(127)
    return rows.select("doc_id", F.shiftrightunsigned("place", _PLACE_BITS).alias("digest"), start.alias("start"), (start + n + length - 1).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = K, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """``doc_id, digest, start, stop``: byte spans to remove; they may overlap."""
    if not k <= length <= k - 1 + (1 << _COUNT_BITS):
        raise ValueError("length must be at least k and less than k + 128.")
    spark = docs.sparkSession
    rows = keyed(docs).filter(F.octet_length("text") >= length)
    contexts = rows.mapInArrow(_context_task(length, k), "h bigint, c bigint, doc_id bigint, place bigint, marked boolean")
    contexts = contexts.repartition("h").sortWithinPartitions("h", "c", "doc_id", "place")
    met = cut(contexts.mapInArrow(_meet_task, "h bigint, doc_id bigint, place bigint, marked boolean"), "met")
    marks = _marks_of(met.filter("marked"), length)

    left = met.filter(~F.col("marked")).withColumn("digest", F.shiftrightunsigned("place", _PLACE_BITS))
    wanted = left.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("h", "place")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"doc_id": "i", "digest": "g"})
    held = spark.sparkContext.broadcast(bitmap(left.select(F.xxhash64("doc_id", "digest").alias("b")), "b"))
    texts = rows.withColumn("b", F.xxhash64("doc_id", "digest")).mapInArrow(_only_held(held), _KEY + ", text string")
    texts = texts.join(wanted, (F.col("doc_id") == F.col("i")) & (F.col("digest") == F.col("g")))
    pieces = texts.select("doc_id", "text", "wanted").mapInArrow(_fetch_task(length), "h bigint, doc_id bigint, place bigint, piece binary")
    pieces = cut(pieces.dropDuplicates(["h", "doc_id", "place"]), "pieces")
    hot = cut(left.groupBy("h").count().filter(F.col("count") > most_contexts).select("h"), "hot")
    cool = pieces.join(hot, "h", "left_anti").repartition("h").sortWithinPartitions("h")
    marks = marks.unionByName(cool.mapInArrow(_shard_task(length), "doc_id bigint, digest bigint, start bigint, stop bigint"))
    if not hot.isEmpty():
        windows = pieces.join(hot, "h").mapInArrow(_window_task(length), "w bigint, doc_id bigint, place bigint")
        first = windows.groupBy("w").agg(F.min(F.struct("doc_id", "place")).alias("first"))
        later = windows.join(first, "w").filter(F.struct("doc_id", "place") != F.col("first"))
        marks = marks.unionByName(_marks_of(later, length))
    return marks


def _held_rows(batch: pa.RecordBatch, held, inside: bool) -> pa.RecordBatch:
    """The rows whose hash ``b`` may be in the bitmap, or the others, without ``b``."""
    keep = in_bitmap(held.value, batch.column("b").to_numpy().view(np.uint64)) == inside
    return batch.filter(pa.array(keep)).select([c for c in batch.schema.names if c != "b"])


def _only_held(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _held_rows(batch, held, True)

    return giving_back(run)


_RESULT = "doc_id bigint, digest bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _result_task(with_text: bool, held=None):
    """Results of texts with their spans, or without any; given a bitmap, of those outside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held is not None:  # here, as a task of two Python passes has two workers
            batches = (_held_rows(batch, held, False) for batch in batches)
        for batch in (rows for whole in batches for rows in slices(whole)):
            data, offsets = column_bytes(batch.column("text"))
            data = data.tobytes()
            spans = batch.column("spans") if "spans" in batch.schema.names else None
            at = spans.offsets.to_numpy() if spans is not None else None
            starts, stops = (spans.values.field(i).to_numpy() for i in (0, 1)) if spans is not None else (None, None)
            valid = ~spans.is_null().to_numpy(zero_copy_only=False) if spans is not None else None
            removed, runs, sums, texts = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                text, gone, count = data[a:b], 0, 0
                if spans is not None and valid[i] and at[i + 1] > at[i]:
                    kept, upto = [], 0
                    for s, e in sorted(zip(starts[at[i] : at[i + 1]].tolist(), stops[at[i] : at[i + 1]].tolist())):
                        if s > upto or not count:
                            kept.append(text[upto:s])
                            count += 1
                            upto = s
                        gone += max(e - upto, 0)
                        upto = max(upto, e)
                    text = b"".join(kept) + text[upto:]
                removed.append(gone)
                runs.append(count)
                sums.append(hashlib.sha256(text).hexdigest())
                texts.append(text if with_text else None)
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sums, pa.string())]
            names = ["doc_id", "digest", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return giving_back(run)


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, most_contexts: int = MOST_CONTEXTS, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``; with the kept bytes on demand."""
    return remove_spans(docs, repeated_spans(docs, length, k, most_contexts), with_text)


def remove_spans(docs: DataFrame, marks: DataFrame, with_text: bool = False) -> DataFrame:
    """The result for the byte spans ``doc_id, digest, start, stop``."""
    schema = _RESULT + (", kept binary" if with_text else "")
    marks = cut(marks, "marks")
    spans = marks.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "i", "digest": "g"})
    held = docs.sparkSession.sparkContext.broadcast(bitmap(marks.select(F.xxhash64("doc_id", "digest").alias("b")), "b"))
    rows = keyed(docs).withColumn("b", F.xxhash64("doc_id", "digest"))
    touched = rows.mapInArrow(_only_held(held), _KEY + ", text string")
    touched = touched.join(spans, (F.col("doc_id") == F.col("i")) & (F.col("digest") == F.col("g")), "left").select("doc_id", "digest", "text", "spans")
    out = rows.mapInArrow(_result_task(with_text, held), schema).unionByName(touched.mapInArrow(_result_task(with_text), schema))
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(2**63), F.col("doc_id"))).drop("digest")
