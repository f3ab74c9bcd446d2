"""Token-id files: ORC in document order, with row indexes and Bloom filters on the id.

Documents are range-sorted by id, encoded in tasks, and written as one row per document. The
writer's integer run-length encoding packs the ids; stripes are small enough that one file is read
by several tasks; filters on ``doc_id`` skip stripes and row groups by their statistics and Bloom
filters. Every row carries its token offset within its file, so that one sum per file turns it into
the offset within the whole corpus.

Cases: a null or empty text has only the end id; null ids come first; rows that share an id are
ordered by the hash of their text, then by the text; repeated rows are kept; an empty table gives an
empty, readable folder; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from decisionlake.llm.text import Words, give_back, giving_back, ranges, slices

#: Text encoded at once; its words and ids are held as arrays.
ENCODE_BYTES = 512 << 10

SCHEMA = "doc_id bigint, part int, local_start bigint, n_tokens int, tokens array<int>"
#: Writer settings: indexes for every 2,000 rows, stripes of 16 MB, Bloom filters on the id.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Encodes texts with a byte-level ``tokenizers`` vocabulary that drops white space.

    No token crosses white space, so each distinct word is encoded once and remembered under its
    64-bit hash, in tables of bounded size. Texts with special-token marks are encoded as a whole.
    ``single`` tells that the vocabulary lower-cases and splits letters from other signs, which lets a
    word of letters go to the model without the normaliser.
    """

    SLOTS = 1 << 21
    KEPT = 1 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.seen = np.zeros(self.SLOTS, np.uint64)
        self.slot = np.full(self.SLOTS, -1, np.int32)
        self.flat = np.empty(4 * self.KEPT, np.int32)
        self.first = np.zeros(self.KEPT + 1, np.int64)
        self.n = 0
        self.signs: dict[str, list[int]] = {}

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_word(self, word: bytes) -> list[int]:
        text = word.decode("utf-8")
        core = text.rstrip(".,;:!?#*%&$()[]{}\"/|+=<>_-")
        signs = text[len(core) :]
        # a capital sigma is lower-cased by its place, and some letters become a letter and a sign
        if not core.isalpha() or "Σ" in core or not is_normalized("NFC", core) or not core.lower().isalpha():
            return self._whole(text)
        core = core.lower()
        ids = [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, core.encode())))]
        if signs:
            if signs not in self.signs:
                if len(self.signs) > 100_000:
                    self.signs.clear()
                self.signs[signs] = self._whole(signs)
            ids = ids + self.signs[signs]
        return ids

    def _add(self, ids: list[int]) -> int:
        start = self.first[self.n]
        if start + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(ids)), np.int32)])
        self.flat[start : start + len(ids)] = ids
        self.n += 1
        if self.n == len(self.first) - 1:
            self.first = np.concatenate([self.first, np.zeros(len(self.first), np.int64)])
        self.first[self.n] = start + len(ids)
        return self.n - 1

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of consecutive texts and the number of ids of each."""
        if self.n > self.KEPT:
            self._clear()
        words = Words(column)
        at = (words.hash >> np.uint64(64 - 21)).astype(np.int64)
        index = self.slot[at]
        miss = np.flatnonzero((self.seen[at] != words.hash) | (index < 0))
        if len(miss):
            new, which, back = np.unique(words.hash[miss], return_index=True, return_inverse=True)
            own = np.empty(len(new), np.int32)
            for j, i in enumerate(miss[which]):
                own[j] = self._add(self._of_word(words.word(i)))
            index[miss] = own[back]
            at = (new >> np.uint64(64 - 21)).astype(np.int64)
            self.seen[at], self.slot[at] = new, own
            # of two new words in one slot numpy keeps the last for both arrays alike
        lengths = self.first[index + 1] - self.first[index]
        flat = self.flat[ranges(self.first[index], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        counts = total[words.at[1:]] - total[words.at[:-1]]
        marked = [i for i, t in enumerate(column.to_pylist()) if t and any(m in t for m in self.marks)] if self._has_marks(words.data) else []
        if not marked:
            return flat, counts
        parts, ends = [], np.cumsum(counts)
        for i in range(len(counts)):
            ids = self._whole(column[i].as_py()) if i in set(marked) else flat[ends[i] - counts[i] : ends[i]]
            parts.append(np.asarray(ids, np.int32))
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _has_marks(self, data: np.ndarray) -> bool:
        """Whether any special mark may occur: ``<|`` as bytes."""
        return bool(len(data) > 1 and np.any((data[:-1] == 0x3C) & (data[1:] == 0x7C)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode_task(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start, part = encoder(path), 0, TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, limit=ENCODE_BYTES):
                ids, counts = own.encode(rows.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(np.int32)
                counts = counts + 1
                offsets = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").cast(pa.int64()),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(start + offsets[:-1]),
                        pa.array(counts.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                    ],
                    ["doc_id", "part", "local_start", "n_tokens", "tokens"],
                )
                start += int(offsets[-1])

    return giving_back(run)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) and write the files, in ascending order of the id."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h"), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("_h", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(_encode_task(tokenizer, end_id), SCHEMA).write.mode("overwrite").options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files. Filters on ``doc_id`` and unused columns are left to the ORC reader."""
    return spark.read.schema(SCHEMA).orc(path)


def with_start(rows: DataFrame, path: str) -> DataFrame:
    """Adds ``start``: the number of ids of all documents before, from one sum per file."""
    files = read_tokens(rows.sparkSession, path).groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_before"))
    return rows.join(offsets, "part").withColumn("start", F.col("_before") + F.col("local_start")).drop("_before")


@giving_back
def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a worker that has encoded before needs its vocabulary no more
    _encoders.clear()
    give_back()
    for batch in batches:
        tokens = batch.column("tokens")
        at = tokens.offsets.to_numpy()
        flat = memoryview(tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("local_start"),
             pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: its place, its number of ids and their checksum."""
    rows = read_tokens(spark, path).select("doc_id", "part", "local_start", "tokens")
    rows = rows.mapInArrow(_digest, "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint")
    return with_start(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")
