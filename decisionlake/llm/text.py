"""Words and hashes of whole Arrow string columns, computed with numpy inside tasks.

A word is a maximal run of bytes of an alphabet; texts are compared with A-Z lower-cased.
Hashes are 64-bit polynomials over bytes with random byte values, modulo 2**64, so that the
hash of any substring follows from two prefix sums; a final mix spreads the bits.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text handled at once by one task; a longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Tables of powers grow by so many numbers.
POWERS = 1 << 18

_random = np.random.default_rng(20240607)
_BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_FOLDED = _BYTE_VALUES.copy()
_FOLDED[65:91] = _BYTE_VALUES[97:123]
_BASE = int(_random.integers(1, 2**61)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_LANES = _random.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)

#: Not the white space of the contract: words are `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Letters, digits and every byte above 0x7F: words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a lower-cased text.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = -(-n // POWERS) * POWERS
        both = []
        for step in (_BASE, _INVERSE):
            out = np.empty(size, np.uint64)
            out[0], have = 1, 1
            while have < size:
                more = min(have, size - have)
                out[have : have + more] = out[:more] * U64(pow(step, have, 2**64))
                have += more
            both.append(out)
        _powers[:] = both
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Prefix:
    """Prefix sums of a byte array: the hash of any of its substrings in constant time."""

    def __init__(self, data: np.ndarray, fold: bool = True):
        power, self.inverse = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _BYTE_VALUES)[data] * power[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def hash_all(self, length: int) -> np.ndarray:
        """Of every substring of one length."""
        n = max(len(self.sums) - length, 0)
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + U64(length))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the n+1 offsets of the texts; null is empty."""
    if column.null_count:
        if pa.types.is_null(column.type):
            column = column.cast(pa.string())
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``limit`` bytes of text, or a single row."""
    _, at = column_bytes(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


class Words:
    """The words of consecutive texts: byte ranges, folded hashes, and where each text begins."""

    def __init__(self, column: pa.Array, alphabet: np.ndarray = NOT_SPACE, hide=None):
        """``hide`` gives, for the bytes, those that are of no word besides those outside the alphabet."""
        self.data, self.offsets = column_bytes(column)
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = alphabet[self.data]
        if hide is not None:
            inside[1:-1] &= ~hide(self.data)
        first = inside[1:] & ~inside[:-1]
        last = inside[:-1] & ~inside[1:]
        cuts = self.offsets[1:-1]  # a text ends here even where both neighbours are of the alphabet
        both = cuts[(cuts > 0) & (cuts < len(self.data))]
        both = both[inside[both] & inside[both + 1]]
        first[both] = last[both] = True
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last)
        self.hash = Prefix(self.data).hash(self.start, self.end)
        #: Text i has the words ``at[i]:at[i + 1]``.
        self.at = np.searchsorted(self.start, self.offsets)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def word(self, i: int) -> bytes:
        return bytes(self.data[self.start[i] : self.end[i]]).lower()


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes; the order counts."""
    n = max(len(hashes) - k + 1, 0)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _LANES[i]
    return mix(total + U64(k))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of all pairs, one after the other."""
    if len(starts) == 0:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64, copy=False).view(np.int64)


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:]) if len(values) > have else values[:0]
        have *= 2
    rest = width - have
    if rest:
        values = np.minimum(values[:-rest], values[rest:]) if len(values) > rest else values[:0]
    return values


def give_back() -> None:
    """Returns the memory that this process has freed to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(task):
    """The task of ``mapInArrow``, after which its worker, which later stages use again, holds no more than it needs."""

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        _powers.clear()
        give_back()

    return run


class WordMemory:
    """Remembers a small row of numbers for each distinct word, under its hash, in bounded memory.

    ``compute(word)`` gives the row of a word not yet known; of two words in one slot the later stays.
    """

    BITS = 20

    def __init__(self, compute, width: int):
        self.compute = compute
        self.seen = np.zeros(1 << self.BITS, np.uint64)
        self.rows = np.zeros((1 << self.BITS, width), np.float32)

    def lookup(self, words: Words) -> np.ndarray:
        at = (words.hash >> U64(64 - self.BITS)).astype(np.int64)
        out = self.rows[at]
        miss = np.flatnonzero(self.seen[at] != words.hash)
        if len(miss):
            new, which, back = np.unique(words.hash[miss], return_index=True, return_inverse=True)
            own = np.array([self.compute(words.word(i)) for i in miss[which]], np.float32).reshape(len(new), -1)
            out[miss] = own[back]
            at = (new >> U64(64 - self.BITS)).astype(np.int64)
            self.seen[at], self.rows[at] = new, own
        return out
