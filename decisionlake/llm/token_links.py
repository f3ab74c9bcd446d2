"""Cross-tokenizer alignment: tokens of two vocabularies linked where their bytes overlap.

Both tokenizers see the same bytes, a space and the text. The ends of the tokens are two ascending
lists of byte offsets, merged by two pointers per document. All documents of a batch are merged in
lockstep: one numpy state vector holds a pair of pointers per lane, and each step emits a link per
lane, emits a cut where both tokens end together, advances the pointers whose token ends first, and
compacts the lanes that are done. A lane is a document or, for a long one, a stretch of it between two
places that no token of either vocabulary crosses, so that one long document does not hold up a batch.

Such places are the spaces after a byte that is no white space. The stretches between them, mostly
words, are encoded once and remembered under a 64-bit hash in tables of bounded size. Texts with white
space beyond ASCII or with the sign U+2581, where this need not hold, are encoded as a whole.

What the corpus knows of a pair of ids, in how many documents it is linked, is counted by an
aggregation. The most frequent pairs (at most ``HOT_PAIRS``, about 6 MB) are broadcast to the links;
the links of all others are joined by a shuffle, in which none of them can be a hot key.

Cases: null and empty texts, and texts that one of the vocabularies does not give back byte for byte,
have no tokens: zeros and an empty ``groups_sha256``; repeated rows are documents of their own, each
counted; very long texts are handled alone; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.text import NOT_SPACE, Prefix, column_bytes, ranges, slices
from decisionlake.sources.storage import cut

#: Pairs of ids that are broadcast with their counts; all others are joined.
HOT_PAIRS = 1 << 18
#: Stretches of a document that one lane merges.
LANE = 256
#: Text handled at once; its links are held as arrays.
BATCH_BYTES = 1 << 19

#: White space that a pattern may take for such though ASCII does not, and the sign that stands for a space.
_ODD = re.compile("[%s]" % "".join(map(chr, [
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x2581,
])))
#: Bytes with which their UTF-8 begins.
_ODD_BYTES = np.zeros(256, bool)
_ODD_BYTES[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True

_SCHEMA = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)


def _byte_of_letter() -> dict[str, int]:
    """The byte for which a letter of a byte-level vocabulary stands: printable ones for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(256)}


class ByteLevel:
    """A byte-level ``tokenizers`` vocabulary; marks of special tokens in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of_letter()
        self.tokens = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            # an added token may hold letters of its own; it is never emitted
            self.tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, spaced: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """A ``sentencepiece`` vocabulary that puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.space = self.model.piece_to_id("▁")

    def encode(self, spaced: list[str]) -> list[list[int]]:
        # of an empty text no piece is made, not even the space before it
        found = self.model.encode([text[1:] for text in spaced], num_threads=1)
        return [ids or [self.space] for ids in found]


class _Bytes:
    """Byte strings in one array, looked up by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(x) for x in strings], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.at[numbers], self.lengths[numbers])]


class PairEncoder:
    """Ids of stretches of text in both vocabularies, remembered under the stretch's hash."""

    BITS = 22
    KEPT = 1 << 20

    def __init__(self, first: str, second: str):
        self.sides = [ByteLevel(first), Pieces(second)]
        self.bytes = [_Bytes(side.tokens) for side in self.sides]
        self.lengths = [b.lengths for b in self.bytes]
        self._clear()

    def _clear(self) -> None:
        self.seen = np.zeros(1 << self.BITS, np.uint64)
        self.slot = np.full(1 << self.BITS, -1, np.int32)
        self.flat = [np.empty(1 << 20, np.int32) for _ in self.sides]
        self.at = [np.zeros(self.KEPT + 1, np.int64) for _ in self.sides]
        self.exact = np.zeros(self.KEPT, bool)
        self.n = 0

    def _add(self, stretches: list[bytes]) -> None:
        """Encode new stretches, at the next numbers; ``exact`` tells if both sides give back their bytes."""
        n, m = self.n, self.n + len(stretches)
        if m > len(self.exact):
            more = max(m - len(self.exact), len(self.exact))
            self.exact = np.concatenate([self.exact, np.zeros(more, bool)])
            self.at = [np.concatenate([at, np.zeros(more, np.int64)]) for at in self.at]
        sizes = np.array([len(x) for x in stretches], np.int64)
        texts, source, begin = [x.decode("utf-8") for x in stretches], np.frombuffer(b"".join(stretches), np.uint8), np.cumsum(sizes) - sizes
        exact = np.ones(len(stretches), bool)
        for k, side in enumerate(self.sides):
            found = side.encode(texts)
            counts = np.array([len(x) for x in found], np.int64)
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
            first = np.cumsum(counts) - counts
            same = np.add.reduceat(self.lengths[k][ids], first) == sizes
            own = np.flatnonzero(same)
            given = self.bytes[k].joined(ids[ranges(first[own], counts[own])])
            differs = np.flatnonzero(given != source[ranges(begin[own], sizes[own])])
            ends = np.cumsum(sizes[own])
            same[own[np.searchsorted(ends, differs, side="right")]] = False
            exact &= same
            start = int(self.at[k][n])
            if start + len(ids) > len(self.flat[k]):
                self.flat[k] = np.concatenate([self.flat[k], np.empty(max(len(self.flat[k]), len(ids)), np.int32)])
            self.flat[k][start : start + len(ids)] = ids
            self.at[k][n + 1 : m + 1] = start + np.cumsum(counts)
        self.exact[n:m] = exact
        self.n = m

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number under which each stretch is remembered, until the next call."""
        if self.n > self.KEPT or max(len(f) for f in self.flat) > 8 * self.KEPT:
            self._clear()
        h = Prefix(data, fold=False).hash(start, end)
        at = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        index = self.slot[at]
        miss = np.flatnonzero((self.seen[at] != h) | (index < 0))
        if len(miss):
            new, which, back = np.unique(h[miss], return_index=True, return_inverse=True)
            own = np.arange(self.n, self.n + len(new), dtype=np.int32)
            whole = data.tobytes()
            self._add([whole[a:b] for a, b in zip(start[miss[which]].tolist(), end[miss[which]].tolist())])
            index[miss] = own[back]
            at = (new >> np.uint64(64 - self.BITS)).astype(np.int64)
            self.seen[at], self.slot[at] = new, own
        return index

    def ids(self, k: int, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of one vocabulary for consecutive stretches, and how many each has."""
        lengths = self.at[k][index + 1] - self.at[k][index]
        return self.flat[k][ranges(self.at[k][index], lengths)], lengths


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray):
    """Links (two index arrays) and cuts (two index arrays) of lanes that start at tokens ``a`` and ``b``.

    ``stop`` is the first token of A behind a lane; the tokens of both sides end together there.
    """
    links, cuts = [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        links.append((a, b))
        together = end_a == end_b
        cuts.append((a[together], b[together]))
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    none = np.empty(0, np.int64)
    return [np.concatenate([none, *(x[i] for x in pairs)]) for pairs in (links, cuts) for i in (0, 1)]


class _Decimals:
    """Ids as decimal digits, in one byte array."""

    def __init__(self, n: int):
        names = [str(i).encode() for i in range(n)]
        self.digits = np.frombuffer(b"".join(names), np.uint8)
        self.lengths = np.array([len(x) for x in names], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id followed by its mark, and the offset behind each of them."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = marks
        out[ranges(ends - 1 - lengths, lengths)] = self.digits[ranges(self.at[ids], lengths)]
        return out, ends


_COMMA, _BAR, _SEMICOLON = b",|;"


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each text, and the offsets of the texts with it."""
    return np.insert(data, offsets[:-1], 0x20), offsets + np.arange(len(offsets))


class Aligned:
    """Tokens, links and cuts of the texts of a batch; documents without tokens have empty ranges."""

    def __init__(self, encoder: PairEncoder, column: pa.Array):
        data, offsets = _spaced(*column_bytes(column))
        n = len(offsets) - 1
        start = (data == 0x20) & np.concatenate([[True], NOT_SPACE[data[:-1]]])[: len(data)]
        maybe = np.unique(np.searchsorted(offsets, np.flatnonzero(_ODD_BYTES[data]), side="right") - 1)
        for i in maybe.tolist():
            if _ODD.search(column[i].as_py()):
                start[offsets[i] : offsets[i + 1]] = False
        start[offsets[:-1]] = True
        first = np.flatnonzero(start)
        end = np.append(first[1:], len(data))
        document = np.searchsorted(offsets, first, side="right") - 1
        index = encoder.lookup(data, first, end)
        bad = np.zeros(n, bool)
        bad[document[~encoder.exact[index]]] = True
        bad |= np.diff(offsets) == 1
        keep = ~bad[document]
        index, document = index[keep], document[keep]
        self.ids, ends, before = [], [], []
        for k in (0, 1):
            ids, lengths = encoder.ids(k, index)
            self.ids.append(ids)
            ends.append(np.cumsum(encoder.lengths[k][ids]))
            before.append(np.cumsum(lengths) - lengths)
        unit = np.searchsorted(document, np.arange(n + 1))
        #: Tokens of document i: ``at[k][i]:at[k][i + 1]``.
        self.at = [np.append(b, len(ids))[unit] for b, ids in zip(before, self.ids)]
        place = np.arange(len(document)) - unit[document] if len(document) else np.empty(0, np.int64)
        lane = np.flatnonzero(place % LANE == 0)
        stop = np.append(before[0][lane][1:], len(self.ids[0]))[: len(lane)]
        self.link_a, self.link_b, cut_a, cut_b = lockstep(*ends, before[0][lane], before[1][lane], stop)
        order = np.argsort(cut_a)
        self.cut_a, self.cut_b = cut_a[order], cut_b[order]

    def digests(self, decimals: _Decimals) -> list[str]:
        """SHA-256 of each document's groups, written ``a1,a2|b1;a3|b2,b3``."""
        behind_a, behind_b = self.cut_a + 1, self.cut_b + 1
        in_a, in_b = np.diff(behind_a, prepend=0), np.diff(behind_b, prepend=0)
        total = len(self.ids[0]) + len(self.ids[1])
        ids, marks = np.empty(total, np.int64), np.full(total, _COMMA, np.uint8)
        ids[np.arange(len(self.ids[0])) + np.repeat(behind_b - in_b, in_a)] = self.ids[0]
        ids[np.arange(len(self.ids[1])) + np.repeat(behind_a, in_b)] = self.ids[1]
        marks[self.cut_a + behind_b - in_b] = _BAR
        marks[self.cut_b + behind_a] = _SEMICOLON
        out, ends = decimals.joined(ids, marks)
        ends, view = np.append(0, ends), memoryview(out)
        at = ends[self.at[0] + self.at[1]].tolist()
        return [hashlib.sha256(view[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(at, at[1:])]

    def pairs(self, n_second: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked id pairs of each document (as one number) with their links, and where each document's begin."""
        document = np.searchsorted(self.at[0], self.link_a, side="right") - 1
        pair = self.ids[0][self.link_a].astype(np.int64) * n_second + self.ids[1][self.link_b]
        order = np.lexsort((pair, document))
        document, pair = document[order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (document[1:] != document[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(pair)))
        return pair[first], times, np.searchsorted(document[first], np.arange(len(self.at[0])))


_encoders: dict[tuple[str, str], tuple[PairEncoder, _Decimals]] = {}


def _encoder(first: str, second: str) -> tuple[PairEncoder, _Decimals]:
    if (first, second) not in _encoders:
        own = PairEncoder(first, second)
        _encoders[first, second] = own, _Decimals(max(len(x) for x in own.lengths))
    return _encoders[first, second]


def _align_task(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decimals = _encoder(first, second)
        n_second = len(encoder.lengths[1])
        for batch in batches:
            for rows in slices(batch, limit=BATCH_BYTES):
                own = Aligned(encoder, rows.column("text"))
                pair, times, at = own.pairs(n_second)
                counted = [np.diff(own.at[0]), np.diff(own.at[1]),
                           np.diff(np.searchsorted(own.cut_a, own.at[0])), np.diff(np.searchsorted(np.sort(own.link_a), own.at[0]))]
                at = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *map(pa.array, counted), pa.array(own.digests(decimals), pa.string()),
                     pa.ListArray.from_arrays(at, pa.array(pair)), pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32)))],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return run


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """One row per document: counts, digest of its groups, and its distinct ``pairs`` with their links (``times``).

    A pair is ``a * size of the second vocabulary + b``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_align_task(first, second), _SCHEMA)


def pair_counts(pairs: DataFrame, n_second: int) -> DataFrame:
    """``pair, documents, best``: in how many documents a pair is linked, and if that is the most for its first id."""
    counts = pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / n_second))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def token_links(docs: DataFrame, first: str, second: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    n_second = len(Pieces(second).tokens)
    rows = cut(aligned(docs, first, second).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = cut(pair_counts(rows, n_second), "pair-counts")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.times", F.col("l.pairs").alias("pair"))
    hot = counts.orderBy(F.desc("documents"), "pair").limit(hot_pairs)
    found = links.join(F.broadcast(hot), "pair", "left")
    if counts.count() > hot_pairs:
        rest = found.filter("documents IS NULL").select("row", "times", "pair").join(counts, "pair")
        found = found.filter("documents IS NOT NULL").unionByName(rest)
    sums = found.groupBy("row").agg(
        F.sum(F.col("documents") * F.col("times")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    )
    none = F.lit(0).cast("bigint")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
