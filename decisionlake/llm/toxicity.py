"""Toxicity: a learned lexicon, matched through Levenshtein automata, and the context of its hits.

The lexicon comes from labelled documents: words that toxic ones use far more often than others, and
stems all of whose continuations do. Its terms form a trie, which is walked together with a
Levenshtein automaton: a state is a set of (trie node, edits), and the transitions that texts need
are worked out once and remembered. A hit counts apart by whether it is exact, misspelled or within
quotation marks, and a window of words around it tells by their own log-odds whether it is abuse. A
logistic regression turns the counts of a document into its score.

Learning uses at most about ``SAMPLE`` labelled documents of each label, chosen by the hash of their
id, which bounds the words past the thresholds: all of these are learned. Scoring is one pass over all
documents, each by itself.

Cases: null and empty texts have no hits and get the score of a document without any; null ids are
never learned from and not held out; of labels that contradict each other for an id the larger counts;
null labels are ignored; if one of the two labels is missing every score is the share of toxic labels
(0 without labels); repeated rows each get their score; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.llm.text import LETTERS, WordMemory, Words, giving_back, slices
from decisionlake.sources.storage import cut

SAMPLE = 20_000
#: Least log-odds of a term and a stem, and least evidence (see ``_evidence``).
MIN_ODDS, STEM_ODDS = 2.0, 3.0
MIN_EVIDENCE, STEM_EVIDENCE = 8.0, 13.0
MISSPELLED = 0.8
STEM_LENGTHS = range(4, 8)
MIN_FUZZY, MAX_EDITS, WINDOW, QUOTE_BYTES = 5, 1, 6, 400
FEATURES = 7
_WORD_COUNTS = "word string, toxic int, n bigint"


class Lexicon:
    """A trie of terms, and of stems that any ending may follow, with a remembered automaton.

    ``distance(word)`` is the fewest edits that turn the word into a term, within what the term's
    length allows, or -1. Terms of fewer than ``MIN_FUZZY`` letters, and stems, allow no edits; a term
    that begins with a stem stands beside it, so that a misspelling in its first letters is found.
    """

    KEPT = 100_000

    def __init__(self, terms: list[str], stems: list[str] = (), edits: int = MAX_EDITS):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]
        self.open: list[bool] = [False]
        self.most: list[int] = [0]
        for term, is_open in [*((t, False) for t in terms), *((s, True) for s in stems)]:
            allowed = 0 if is_open or len(term) < MIN_FUZZY else edits
            node = 0
            for letter in term:
                self.most[node] = max(self.most[node], allowed)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(-1)
                    self.open.append(False)
                    self.most.append(0)
                node = self.children[node][letter]
            self.most[node] = max(self.most[node], allowed)
            self.allowed[node] = max(self.allowed[node], allowed)
            self.open[node] |= is_open
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.step: list[dict[str, int]] = []
        self.accept: list[int] = []
        self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """Number of the state: a term's letter may be left out at the cost of an edit."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                edits = reached[node] + 1
                if edits <= self.most[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    todo.append(child)
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.step.append({})
            ends = [e for node, e in key if e <= self.allowed[node]]
            self.accept.append(min(ends, default=-1))
        return self.number[key]

    def _next(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.states[state]:
            if self.open[node] and edits == 0:
                reach(node, 0)
            reach(node, edits + 1)  # a letter too many
            for other, child in self.children[node].items():
                reach(child, edits + (other != letter))
        return self._state(reached)

    def distance(self, word: str) -> int:
        if len(self.states) > self.KEPT:
            self._reset()
        state = 0
        for letter in word:
            follow = self.step[state].get(letter)
            if follow is None:
                follow = self.step[state][letter] = self._next(state, letter)
            state = follow
            if not self.states[state]:
                return -1
        return self.accept[state]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each label a word occurs, added up for each slice."""
    for batch in batches:
        for rows in slices(batch):
            words = Words(rows.column("text"), LETTERS, hide=_mark_bytes)
            document = words.document()
            label = rows.column("toxic").to_numpy(zero_copy_only=False)
            order = np.lexsort((document, words.hash))
            h, d = words.hash[order], document[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            once = order[new]
            out = []
            for value in (0, 1):
                own = once[label[document[once]] == value]
                _, which, n = np.unique(words.hash[own], return_index=True, return_counts=True)
                out += [(words.word(i).decode(), value, int(c)) for i, c in zip(own[which], n)]
            if out:
                word, toxic, n = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(toxic, pa.int32()), pa.array(n, pa.int64())], ["word", "toxic", "n"])


def _marks(data: np.ndarray) -> np.ndarray:
    """Where a quotation mark begins: the straight one, two curly ones and two angular ones."""
    mark = data == 0x22
    if len(data) > 2:
        mark[:-2] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & ((data[2:] == 0x9C) | (data[2:] == 0x9D))
    if len(data) > 1:
        mark[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0xAB) | (data[1:] == 0xBB))
    return mark


def _mark_bytes(data: np.ndarray) -> np.ndarray:
    mark = _marks(data)
    out = mark.copy()
    wide = np.flatnonzero(mark & (data != 0x22))
    out[wide + 1] = True
    out[wide[data[wide] == 0xE2] + 2] = True
    return out


class Scorer:
    """Features of texts: what hits there are, how they are written, quoted and surrounded."""

    def __init__(self, terms: list[str], stems: list[str], context: dict[str, float]):
        self.lexicon, self.context = Lexicon(terms, stems), context
        self.memory = WordMemory(self._of_word, 2)

    def _of_word(self, word: bytes) -> tuple[float, float]:
        text = word.decode()
        return self.lexicon.distance(text), self.context.get(text, 0.0)

    def features(self, column: pa.Array) -> np.ndarray:
        words = Words(column, LETTERS, hide=_mark_bytes)
        n = len(words.at) - 1
        rows = self.memory.lookup(words)
        hits = np.flatnonzero(rows[:, 0] >= 0) if len(rows) else np.empty(0, np.int64)
        document = words.document()[hits]
        exact = rows[hits, 0] == 0
        quoted = self._quoted(words, hits, document)
        odds = np.concatenate([[0.0], np.cumsum(np.where(rows[:, 0] >= 0, 0.0, rows[:, 1]) if len(rows) else [])])
        left = np.maximum(hits - WINDOW, words.at[document])
        right = np.minimum(hits + WINDOW + 1, words.at[document + 1])
        around = (odds[right] - odds[left]) / np.maximum(right - left - 1, 1)

        def total(mask, weight=None):
            return np.bincount(document[mask], None if weight is None else weight[mask], n)

        plain = ~quoted
        out = np.zeros((n, FEATURES))
        # a misspelled hit counts nearly as much as an exact one; feature 1 tells where that is wrong
        weight = np.where(exact, 1.0, MISSPELLED)
        out[:, 0] = np.log1p(total(plain, weight))
        out[:, 1] = np.log1p(total(~exact & plain))
        out[:, 2] = np.log1p(total(quoted))
        out[:, 3] = np.minimum(total(plain, weight), 1.0)
        every = np.ones(len(hits), bool)
        count = np.maximum(total(every), 1)
        out[:, 4] = total(every, around) / count
        out[:, 5] = np.clip(total(plain, np.maximum(around, 0.0)), 0, 10)
        out[:, 6] = 10 * total(plain, weight) / np.maximum(np.diff(words.at), 10)
        return out

    @staticmethod
    def _quoted(words: Words, hits: np.ndarray, document: np.ndarray) -> np.ndarray:
        """Between two quotation marks of the same text, the second within ``QUOTE_BYTES``."""
        data = words.data
        marks = np.append(np.flatnonzero(_marks(data)), len(data) + QUOTE_BYTES + 1)
        before = np.searchsorted(marks, words.start[hits])
        inside = (before - np.searchsorted(marks, words.offsets[document])) % 2 == 1
        close = marks[np.minimum(before, len(marks) - 1)]
        return inside & (close < words.offsets[document + 1]) & (close - words.start[hits] <= QUOTE_BYTES)


def _feature_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for rows in slices(batch):
                found = scorer.features(rows.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * FEATURES), pa.array(found.reshape(-1)))
                yield pa.RecordBatch.from_arrays([rows.column("toxic"), lists], ["toxic", "features"])

    return run


def _score_task(shared, weights: list[float], bias: float, column: str):
    """All columns of the rows, and the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, w = Scorer(*shared.value), np.array(weights)
        for batch in batches:
            for rows in slices(batch):
                score = 1 / (1 + np.exp(-(scorer.features(rows.column("text")) @ w + bias)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], [*rows.schema.names, column])

    return giving_back(run)


def remainder(column="doc_id"):
    """crc32 of the id as text, modulo 5: 0 is held out of learning."""
    return F.crc32(F.col(column).cast("bigint").cast("string").cast("binary")) % 5


def _odds(n1, n0, total1: int, total0: int):
    return F.log((n1 + 0.5) / (total1 + 1.0)) - F.log((n0 + 0.5) / (total0 + 1.0))


def _evidence(n1, n0, total1: int, total0: int):
    """Natural log of how much likelier ``n1`` toxic documents are by themselves than by the labels' shares."""
    return n1 * F.log(F.greatest(n1, F.lit(1)) / ((n1 + n0) * (total1 / (total1 + total0))))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """The broadcast lexicon, the weights and the bias; or (None, [], logit of the share)."""
    spark = docs.sparkSession
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(remainder() != 0)
    marked = marked.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return None, [], 40.0 if n1 else -40.0
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    chosen = marked.filter(place < F.when(F.col("toxic") == 1, sample / n1).otherwise(sample / n0) * 1_000_000)
    # about `sample` narrow rows of each label, whatever the size of the tables
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = cut(rows.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxic-sample")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        return None, [], 40.0 if n1 else -40.0

    words = rows.mapInArrow(_count_task, _WORD_COUNTS).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0")
    )
    words = cut(words.withColumn("odds", _odds(F.col("n1"), F.col("n0"), n1, n0)), "toxic-words")
    # what passes the thresholds is bounded by the sample, so every such term, stem and context word is taken
    least = words.filter((_evidence(F.col("n1"), F.col("n0"), n1, n0) >= MIN_EVIDENCE) & (F.col("odds") >= MIN_ODDS) & (F.length("word").between(3, 40)))
    terms = [r["word"] for r in least.orderBy(F.desc(F.col("odds") * F.log1p("n1")), "word").collect()]
    stem = words.filter(F.length("word").between(STEM_LENGTHS[0], 40)).select(
        F.explode(F.array(*[F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEM_LENGTHS])).alias("stem"), "word", "n1", "n0"
    ).filter("stem IS NOT NULL").groupBy("stem").agg(F.sum("n1").alias("s1"), F.sum("n0").alias("s0"), F.sum(F.expr("if(n1 > 0, 1, 0)")).alias("kinds"))
    stem = stem.filter((_evidence(F.col("s1"), F.col("s0"), n1, n0) >= STEM_EVIDENCE) & (F.col("kinds") >= 4) & (_odds(F.col("s1"), F.col("s0"), n1, n0) >= STEM_ODDS))
    stems: list[str] = []
    for r in sorted(stem.collect(), key=lambda r: (len(r["stem"]), -r["s1"], r["stem"])):
        if not any(r["stem"].startswith(s) for s in stems):
            stems.append(r["stem"])
    frequent = words.filter("n1 + n0 >= 20")
    context = {r["word"]: float(max(-3.0, min(3.0, r["odds"]))) for r in frequent.collect()}
    shared = spark.sparkContext.broadcast((terms, stems, context))
    features = cut(rows.mapInArrow(_feature_task(shared), "toxic int, features array<double>"), "toxic-features")
    fit = LogisticRegression(labelCol="toxic", featuresCol="vector", regParam=1e-3, maxIter=50).fit(
        features.select("toxic", array_to_vector("features").alias("vector"))
    )
    # the sample holds other shares of the labels than the tables: move the bias back
    shift = math.log(totals[1] / totals[0]) - math.log(n1 / n0)
    return shared, [float(w) for w in fit.coefficients], float(fit.intercept + shift)


def scored(docs: DataFrame, labels: DataFrame, column: str = "score", sample: int = SAMPLE) -> DataFrame:
    """The rows and columns of ``docs`` with the score in one column more, whose name must be new."""
    shared, weights, bias = learn(docs, labels, sample)
    if shared is None:
        return docs.withColumn(column, F.lit(1.0 if bias > 0 else 0.0))
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(_score_task(shared, weights, bias, column), schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scored(rows, labels, "score", sample).select(
        "doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
