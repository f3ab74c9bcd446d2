"""Language-model scores by a subword lattice: the marginal over all segmentations of a text.

The pieces are those of an existing public subword vocabulary, as byte strings, with a piece for each
byte, so that every text has a segmentation. A text is written as its words, each after a space, and
an end; a segmentation has the product of its pieces' unigram scores, and a forward recursion in log
space sums over all segmentations without listing them. As no piece holds a space but in front, the
lattice falls apart at the words, and the recursion runs once for each distinct word of the corpus.

The lattice of a word known from training has one more edge, the word as a whole, with its count less
``DISCOUNT``; what is so set aside is spread over the segmentations (and, a tenth of it, over the words
of all languages). Scores are kept for each language of the training texts, and a text's probability
is the sum over the languages: the language of a scored text is not read.

The vocabulary's own ranks give the first scores; expectation maximisation over the distinct training
words gives those used. The driver holds one number per piece and language; word counts, which grow
with the corpus, stay in tables. They are joined to texts by blocks: a block is a few MB of
consecutive texts, of which every distinct word is sent once. No word, text or piece is dropped. Languages
past the ``LANGUAGES`` most frequent ones share one set of scores: each more costs a number per piece on the
driver and per word in a shuffle; their texts count and are scored as all others.

Cases: null text is empty: only its end is a token; a null id is training text; a null language is a
language of its own; repeated rows each count and are each scored; without training text every count
is 0 and the ranks' scores are used; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.text import Prefix, Words, column_bytes, mix, ranges, slices
from decisionlake.sources.storage import cut

BLOCK_BYTES = 12 << 20
ITERATIONS = 1
#: Languages with scores of their own, the most frequent ones; all others share one set of scores.
LANGUAGES = 7
#: Set aside from the count of each known word, and the share of it that goes to the lattice.
DISCOUNT, LATTICE_SHARE = 0.75, 0.9
#: Added to the expected count of each piece; and the weight of all languages' scores in each one's.
SMOOTHING, COMMON = 0.05, 0.001
WORD_BATCH_BYTES = 256 << 10


def pieces(path: str) -> list[bytes]:
    """Usable pieces in the order of the vocabulary's scores; then a piece for each byte. The end is not among them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = sorted(range(model.vocab_size()), key=lambda i: (-model.get_score(i), i))
    special = {i for i in ranked if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    texts = [model.id_to_piece(i).replace("▁", " ") for i in ranked if i not in special]
    texts = [t for t in texts if t and " " not in t[1:] and not any("A" <= c <= "Z" for c in t)]
    known = dict.fromkeys(t.encode() for t in texts)
    return list(dict.fromkeys([*known, *(bytes([b]) for b in range(256))]))


def rank_scores(n: int) -> np.ndarray:
    """Natural-log scores that fall with the rank, as a column."""
    weight = 1.0 / (np.arange(n) + 10.0)
    return np.log(weight / weight.sum())[:, None]


class Lattice:
    """Finds the pieces in words and runs the recursions for many words at once."""

    SLOT_BITS = 20

    def __init__(self, vocabulary: list[bytes]):
        self.n = len(vocabulary)
        self.lengths = sorted({len(p) for p in vocabulary})
        flat = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(p) for p in vocabulary])
        starts = ends - np.array([len(p) for p in vocabulary])
        hashes = Prefix(flat, fold=False).hash(starts, ends)
        # tables of slots by other bits each: a piece goes to the first where its slot is free
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        todo = np.arange(self.n)
        while len(todo):
            held, which = np.zeros(1 << self.SLOT_BITS, np.uint64), np.full(1 << self.SLOT_BITS, -1, np.int32)
            at = self._slot(hashes[todo], len(self.tables))
            _, first = np.unique(at, return_index=True)
            held[at[first]], which[at[first]] = hashes[todo[first]], todo[first]
            self.tables.append((held, which))
            todo = np.delete(todo, first)

    def _slot(self, hashes: np.ndarray, table: int) -> np.ndarray:
        return (mix(hashes + np.uint64(table)) >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        for i, (held, which) in enumerate(self.tables):
            at = self._slot(hashes, i)
            out = np.where((held[at] == hashes) & (which[at] >= 0), which[at], out)
        return out

    def edges(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """``source, target, piece`` of all pieces in all words; a node is a byte's place plus its word's number."""
        word = np.repeat(np.arange(len(starts)), lengths)
        left = np.repeat(starts + lengths, lengths) - np.arange(len(flat))
        prefix = Prefix(flat, fold=False)
        found = []
        for length in self.lengths:
            at = np.flatnonzero(left >= length)
            piece = self._find(prefix.hash(at, at + length))
            at, piece = at[piece >= 0], piece[piece >= 0]
            source = at + word[at]
            found.append((source, source + length, piece))
        return [np.concatenate(x) for x in zip(*found)]


def _sweep(values: np.ndarray, source: np.ndarray, target: np.ndarray, score: np.ndarray, turn: np.ndarray) -> None:
    """``values[target] = log sum exp(values[source] + score)``, for the edges of one turn after the other.

    Each column is a recursion of its own.
    """
    order = np.lexsort((target, turn))
    source, target, score, turn = source[order], target[order], score[order], turn[order]
    new = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
    cuts = np.searchsorted(turn, np.arange(int(turn[-1]) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        heads = new[np.searchsorted(new, a) : np.searchsorted(new, b)] - a
        x = values[source[a:b]] + score[a:b]
        top = np.maximum.reduceat(x, heads)
        size = np.diff(np.append(heads, b - a))
        values[target[a + heads]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size, axis=0)), heads))


def _batches(words: list[bytes]) -> Iterator[np.ndarray]:
    """Numbers of words of like length, at most ``WORD_BATCH_BYTES`` together or a single one."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    total = np.cumsum(lengths[order])
    at = 0
    while at < len(order):
        before = total[at - 1] if at else 0
        end = max(int(np.searchsorted(total, before + WORD_BATCH_BYTES, side="right")), at + 1)
        yield order[at:end]
        at = end


def forward(lattice: Lattice, words: list[bytes], scores: np.ndarray, weights: np.ndarray | None = None):
    """Natural-log marginals of each word, a column for each column of ``scores``.

    With ``weights`` (a row for each word) and one column of scores it also returns the expected
    counts of the pieces, a column for each column of weights.
    """
    out = np.zeros((len(words), scores.shape[1]))
    expected = None if weights is None else np.zeros((lattice.n, weights.shape[1]))
    for own in _batches(words):
        spaced = [b" " + words[i] for i in own]
        lengths = np.array([len(w) for w in spaced])
        flat = np.frombuffer(b"".join(spaced), np.uint8)
        starts = np.cumsum(lengths) - lengths
        source, target, piece = lattice.edges(flat, starts, lengths)
        first = starts + np.arange(len(starts))
        last = first + lengths
        forth, back = ranges(np.zeros(len(own), np.int64), lengths + 1), None
        score = scores[piece]
        alpha = np.full((len(flat) + len(own), scores.shape[1]), -np.inf)
        alpha[first] = 0.0
        _sweep(alpha, source, target, score, forth[target])
        out[own] = alpha[last]
        if weights is not None:
            beta = np.full(alpha.shape, -np.inf)
            beta[last] = 0.0
            back = np.repeat(lengths, lengths + 1) - forth
            _sweep(beta, target, source, score, back[source])
            word = own[np.repeat(np.arange(len(own)), lengths + 1)[source]]
            share = np.exp(alpha[source] + score + beta[target] - out[word])[:, 0]
            for k in range(weights.shape[1]):
                expected[:, k] += np.bincount(piece, share * weights[word, k], lattice.n)
    return out if weights is None else (out, expected)


class _Block:
    """Collects consecutive texts: distinct words with their training counts per language, texts as word numbers."""

    def __init__(self, languages: int):
        self.languages, self.number, self.words = languages, {}, []
        self.trained, self.parts, self.bytes = [], [], 0

    def add(self, rows: pa.RecordBatch) -> None:
        words = Words(rows.column("text"))
        held = rows.column("held_out").to_numpy(zero_copy_only=False)
        language = rows.column("language").to_numpy(zero_copy_only=False)
        distinct, first, ids = np.unique(words.hash, return_index=True, return_inverse=True)
        mine = np.empty(len(distinct), np.int64)
        for j, (h, i) in enumerate(zip(distinct.tolist(), first.tolist())):
            at = self.number.get(h)
            if at is None:
                at = self.number[h] = len(self.words)
                self.words.append(words.word(i))
            mine[j] = at
        document = words.document()
        learned = ~held[document]
        cell, n = np.unique(mine[ids[learned]] * self.languages + language[document[learned]], return_counts=True)
        self.trained.append((cell, n))
        width = max(len(self.words), 1)
        pair, counts = np.unique(document * np.int64(width) + mine[ids], return_counts=True)
        at = np.searchsorted(pair, np.arange(rows.num_rows + 1) * np.int64(width))
        self.parts.append((rows.column("doc_id"), held, language, np.diff(at), pair % width, counts))
        self.bytes += len(words.data)

    def row(self) -> pa.RecordBatch:
        trained = np.zeros(len(self.words) * self.languages, np.int64)
        for cell, n in self.trained:
            trained[cell] += n
        trained = trained.reshape(-1, self.languages)

        def one(values, kind):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))

        def joined(k, kind):
            return np.concatenate([p[k] for p in self.parts]).astype(kind)

        ids = pa.concat_arrays([p[0].combine_chunks() if isinstance(p[0], pa.ChunkedArray) else p[0] for p in self.parts])
        at = np.concatenate([[0], np.cumsum(joined(3, np.int64))]).astype(np.int32)
        columns = {
            "words": one(self.words, pa.binary()), "doc_id": one(ids, pa.int64()), "held_out": one(joined(1, bool), pa.bool_()),
            "language": one(joined(2, np.int32), pa.int32()), "at": one(at, pa.int32()), "ids": one(joined(4, np.int32), pa.int32()),
            "counts": one(joined(5, np.int32), pa.int32()),
            **{f"c{k}": one(trained[:, k].astype(np.int32), pa.int32()) for k in range(self.languages)},
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _block_task(languages: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(languages)
        for batch in batches:
            for rows in slices(batch):
                block.add(rows)
                if block.bytes >= BLOCK_BYTES:
                    yield block.row()
                    block = _Block(languages)
        if block.parts:
            yield block.row()

    return run


_lattices: dict[int, Lattice] = {}


def _lattice(vocabulary: list[bytes]) -> Lattice:
    key = hash(tuple(vocabulary))
    if key not in _lattices:
        _lattices[key] = Lattice(vocabulary)
    return _lattices[key]


def _expect_task(vocabulary, scores, languages: int | None):
    """Expected counts of the pieces over the distinct words: of all, or of each language's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = _lattice(vocabulary.value), 0.0
        for batch in batches:
            if languages is None:
                weights = np.ones((batch.num_rows, 1))
            else:
                weights = np.stack([batch.column(f"c{k}").to_numpy() > 0 for k in range(languages)], axis=1).astype(float)
            total = total + forward(lattice, batch.column("word").to_pylist(), scores.value, weights)[1]
        if isinstance(total, np.ndarray):
            piece, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)), pa.array(total[piece, language])],
                ["piece", "language", "expected"],
            )

    return run


def _packed(value: np.ndarray) -> pa.Array:
    """Each row as the bytes of its four-byte floats: a column for each number would take twice the room in a shuffle."""
    data = np.ascontiguousarray(value, "<f4")
    at = np.arange(len(data) + 1, dtype=np.int32) * (4 * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(at), pa.py_buffer(data)])


def _unpacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [np.frombuffer(column_bytes(chunk)[0].tobytes(), "<f4") for chunk in column.chunks]
    return np.concatenate([np.empty(0, np.float32), *parts]).reshape(-1, width)


def _word_task(vocabulary, shared, languages: int):
    """Natural-log probability of each word in each language, in one packed column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (scores, tokens, kinds) = _lattice(vocabulary.value), shared.value
        for batch in batches:
            c = np.stack([batch.column(f"c{k}").to_numpy() for k in range(languages)], axis=1).astype(float)
            inner = forward(lattice, batch.column("word").to_pylist(), scores)
            with np.errstate(divide="ignore"):
                free = np.where(tokens > 0, DISCOUNT * kinds / np.maximum(tokens, 1), 1.0)
                share = LATTICE_SHARE if tokens.sum() else 1.0
                whole = np.maximum(c - DISCOUNT, 0.0) / np.maximum(tokens, 1)
                whole = whole + free * (1 - share) * c.sum(axis=1, keepdims=True) / max(tokens.sum(), 1)
                value = np.logaddexp(np.log(whole), np.log(free * share) + inner)
            total = c.sum(axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(total), _packed(value)], ["word", "c", "value"])

    return run


def _score_block(total: int, kinds: int, ends: int, prior: np.ndarray, end: np.ndarray, go_on: np.ndarray):
    divisor, languages = total + kinds + 1.0, len(prior)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))

    def run(words: pa.Table, blocks: pa.Table) -> pa.Table:
        number = words.column("number").to_numpy()
        c, value = np.zeros(len(number)), np.zeros((len(number), languages))
        c[number] = words.column("c").to_numpy()
        value[number] = _unpacked(words.column("value"), languages)
        known, base = (c > 0).astype(np.int64), np.log10((c + 1.0) / divisor)
        out = []
        for row in range(blocks.num_rows):
            ids, counts, at = (blocks.column(k)[row].values.to_numpy().astype(np.int64) for k in ("ids", "counts", "at"))
            text = np.repeat(np.arange(len(at) - 1), np.diff(at))

            def sums(x):
                return np.bincount(text, x, len(at) - 1)

            n = sums(counts).astype(np.int64)
            each = np.stack([sums(counts * value[ids, k]) for k in range(languages)], axis=1) + n[:, None] * go_on + end + prior
            top = each.max(axis=1)
            score = (top + np.log(np.exp(each - top[:, None]).sum(axis=1))) / np.log(10.0)
            out.append(pa.RecordBatch.from_arrays(
                [blocks.column("doc_id")[row].values, blocks.column("held_out")[row].values, pa.array(n + 1),
                 pa.array(sums(counts * known[ids]).astype(np.int64) + (ends > 0)),
                 pa.array(sums(counts * base[ids]) + np.log10((ends + 1.0) / divisor)), pa.array(score)],
                schema=schema,
            ))
        return pa.Table.from_batches(out, schema)

    return run


def score(docs: DataFrame, held_out, vocabulary_path: str, iterations: int = ITERATIONS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    ``docs`` has doc_id, text and lang; ``held_out`` is a boolean column of it, and the model learns
    from the rows where it isn't true.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast
    vocabulary = pieces(vocabulary_path)
    shared = broadcast(vocabulary)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text",
    )
    frequent = rows.filter(~F.col("held_out")).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES + 1)
    named = [r["lang"] for r in frequent.collect()]
    languages = max(len(named), 1)
    place = F.lit(languages - 1)
    for k, name in enumerate(named[: languages - 1]):
        place = F.when(F.col("lang") == name, k).otherwise(place)
    rows = rows.select("doc_id", "held_out", place.alias("language"), "text")

    columns = [f"c{k}" for k in range(languages)]
    kinds_of = ", ".join(f"{c} array<int>" for c in columns)
    schema = f"words array<binary>, doc_id array<bigint>, held_out array<boolean>, language array<int>, at array<int>, ids array<int>, counts array<int>, {kinds_of}"
    blocks = cut(rows.mapInArrow(_block_task(languages), schema).withColumn("block", F.monotonically_increasing_id()), "blocks", rows_at_once=1)
    held = blocks.select("block", F.posexplode(F.arrays_zip("words", *columns)).alias("number", "w"))
    held = held.select("block", "number", F.col("w.words").alias("word"), *[F.col(f"w.{c}").alias(c) for c in columns])
    counted = cut(held.groupBy("word").agg(*[F.sum(c).alias(c) for c in columns]), "words")

    trained = blocks.select(F.explode(F.arrays_zip("held_out", "language")).alias("d")).filter(~F.col("d.held_out"))
    texts = np.zeros(languages)
    for language, n in trained.groupBy("d.language").count().collect():
        texts[language] = n
    every = sum((F.col(c) for c in columns), F.lit(0))
    found = counted.agg(*[F.sum(c) for c in columns], *[F.sum((F.col(c) > 0).cast("int")) for c in columns], F.sum((every > 0).cast("int"))).first()
    found = np.array([float(x or 0) for x in found])
    tokens, kinds, ends = found[:languages], found[languages : 2 * languages], int(texts.sum())

    def expected(scores, by):
        counts = np.zeros((len(vocabulary), by or 1))
        rows = counted.filter(every > 0).mapInArrow(_expect_task(shared, broadcast(scores), by), "piece int, language int, expected double")
        # a row for each piece of the vocabulary and language at most
        for piece, language, value in rows.groupBy("piece", "language").agg(F.sum("expected")).collect():
            counts[piece, language] = value
        return counts

    scores = rank_scores(len(vocabulary))
    for _ in range(iterations if tokens.sum() else 0):
        counts = expected(scores, None) + SMOOTHING
        scores = np.log(counts / counts.sum())
    if tokens.sum():
        counts = expected(scores, languages)
        counts = counts + (COMMON * counts.sum(axis=0) + 1e-9) * np.exp(scores)
        scores = np.log(counts / counts.sum(axis=0))
    else:
        scores = np.repeat(scores, languages, axis=1)

    valued = counted.mapInArrow(_word_task(shared, broadcast((scores, tokens, kinds)), languages), "word binary, c bigint, value binary")
    sent = held.select("block", "number", "word").join(valued, "word").select("block", "number", "c", "value")
    end = (texts + 1.0) / (tokens + texts + 2.0)
    finish = _score_block(
        int(tokens.sum()) + ends, int(found[-1]) + (ends > 0), ends,
        np.log((texts + 1.0) / (texts + 1.0).sum()), np.log(end), np.log1p(-end),
    )
    written = blocks.select(F.col("block").alias("of_block"), "doc_id", "held_out", "at", "ids", "counts")
    out = sent.groupBy("block").cogroup(written.groupBy("of_block")).applyInArrow(
        finish, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    total = F.lit(int(tokens.sum()) + ends).cast("bigint")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", total.alias("train_tokens"), "base_score", "score")
