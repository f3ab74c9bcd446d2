import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from decisionlake.llm import lattice_lm
from decisionlake.llm.queries import vocabulary
from decisionlake.sources import storage
from tests.llm.helpers import documents, prose, with_clashes, words

PATH = vocabulary("piece_bpe_32k.model")
def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2



def test_forward_equals_the_sum_over_listed_segmentations():
    vocabulary = [b" ", b"a", b"b", b" a", b"ab", b"ba", b" ab", b"bab"]
    scores = np.log(np.arange(1, 9) / 36.0)

    def listed(rest):
        if not rest:
            return 1.0
        return sum(math.exp(scores[i]) * listed(rest[len(p) :]) for i, p in enumerate(vocabulary) if rest.startswith(p))

    tested = [b"a", b"b", b"abab", b"babba", b"ab" * 12]
    found, counts = lattice_lm.forward(lattice_lm.Lattice(vocabulary), tested, scores[:, None], np.ones((5, 1)))
    assert np.allclose(found[:, 0], [math.log(listed(b" " + w)) for w in tested])
    spent = sum(c * len(p) for c, p in zip(counts[:, 0], vocabulary))
    assert spent == pytest.approx(sum(len(w) + 1 for w in tested))


def test_counts_and_base_scores_are_exact(spark):
    rows = [(i, prose(i % 5, 40 + i)) for i in range(60)] + [(100, None), (101, ""), (None, "the the"), (5, prose(0, 45))]
    rows.append((102, "x" * 5000 + " " + prose(9, 20_000)))
    found = lattice_lm.score(with_clashes(documents(spark, rows)), held_out(), PATH).collect()
    tokens = [(i, words(t) + [None]) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in tokens if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    expected = Counter(
        (i, held[i], len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for i, t in tokens
    )
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert got == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    longest = {r.doc_id: r for r in found}
    assert longest[102].score < longest[1].score


def test_probabilities_of_short_texts_do_not_exceed_one(spark):
    letters = [a + b for a in "xyz" for b in ["", *"xyz"]]
    rows = [(i, t) for i, t in enumerate(["", *letters, *(f"{a} {b}" for a in "xyz" for b in "xyz")])]
    found = lattice_lm.score(documents(spark, rows), held_out(), PATH).collect()
    assert sum(10**r.score for r in found) < 1


def test_nothing_to_learn_from_and_empty_table(spark):
    one = lattice_lm.score(documents(spark, [(1, "a b")]), F.lit(True), PATH).first()
    assert (one.n_known, one.train_tokens, one.n_tokens) == (0, 0, 3) and math.isfinite(one.score)
    assert lattice_lm.score(documents(spark, []), held_out(), PATH).count() == 0


def listed(word, vocabulary, scores):
    """Probability of a word and, of each piece, its expected count, from a list of all segmentations."""

    def all_of(rest):
        if not rest:
            yield []
        for i, p in enumerate(vocabulary):
            if rest.startswith(p):
                for more in all_of(rest[len(p) :]):
                    yield [i, *more]

    total, counts = 0.0, np.zeros(len(vocabulary))
    for pieces in all_of(b" " + word.encode()):
        chance = math.exp(sum(scores[i] for i in pieces))
        total += chance
        for i in pieces:
            counts[i] += chance
    return total, counts / total


def plain_scores(rows, vocabulary):
    """log10 probability of each (doc_id, text, lang) by the model as the docstring has it, without lattices."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows}
    train = [(words(t), lang) for i, t, lang in rows if not held[i]]
    names = sorted({lang for _, lang in train}, key=lambda x: (-sum(y == x for _, y in train), x))
    c = {k: Counter(w for t, lang in train if lang == k for w in t) for k in names}
    texts = np.array([sum(lang == k for _, lang in train) for k in names], float)
    tokens = np.array([sum(c[k].values()) for k in names], float)
    every = sum(c.values(), Counter())

    scores = lattice_lm.rank_scores(len(vocabulary))[:, 0]
    for _ in range(lattice_lm.ITERATIONS):
        counts = sum(listed(w, vocabulary, scores)[1] for w in every) + lattice_lm.SMOOTHING
        scores = np.log(counts / counts.sum())
    own = {}
    for k in names:
        counts = sum(listed(w, vocabulary, scores)[1] for w in c[k])
        counts = counts + (lattice_lm.COMMON * counts.sum() + 1e-9) * np.exp(scores)
        own[k] = np.log(counts / counts.sum())

    def word(w, k):
        n, free = sum(c[k].values()), lattice_lm.DISCOUNT * len(c[k]) / sum(c[k].values())
        whole = max(c[k][w] - lattice_lm.DISCOUNT, 0) / n + free * (1 - lattice_lm.LATTICE_SHARE) * every[w] / tokens.sum()
        return math.log(whole + free * lattice_lm.LATTICE_SHARE * listed(w, vocabulary, own[k])[0])

    end = (texts + 1) / (tokens + texts + 2)
    prior = (texts + 1) / (texts + 1).sum()
    out = {}
    for i, t, _ in rows:
        each = [math.log(prior[j] * end[j]) + sum(word(w, k) + math.log(1 - end[j]) for w in words(t)) for j, k in enumerate(names)]
        out[i] = math.log10(sum(math.exp(x) for x in each))
    return out


def test_scores_equal_a_model_of_listed_segmentations(spark, monkeypatch):
    long = "abcabcabcabcabcabcab"
    vocabulary = [b" ", b"a", b"b", b"c", b" a", b"ab", b"bc", b" ab", b"cab", long.encode(), *(bytes([x]) for x in range(256) if bytes([x]) not in b" abc")]
    monkeypatch.setattr(lattice_lm, "pieces", lambda path: vocabulary)
    texts = ["ab abc", "cab ab", "A bca bb", "", "ab ab abc cc", "bcab", long, "cc ccb ab", "aab", "bb bca", None, "abc a", "ab zz", "c"]
    rows = [(i, t, "xy"[i % 3 == 0]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.score for r in lattice_lm.score(df, held_out(), PATH).collect()}
    expected = plain_scores(rows, vocabulary)
    assert {i for i in expected if zlib.crc32(str(i).encode()) % 7 == 2} and found.keys() == expected.keys()
    assert all(found[i] == pytest.approx(expected[i], rel=1e-5) for i in expected)


def test_long_pieces_of_the_vocabulary_are_kept():
    assert max(len(p) for p in lattice_lm.pieces(PATH)) > 16


def test_a_task_holds_one_block_at_a_time(spark, monkeypatch):
    """A block is many MB: rows that are written or read together must not be as many as a task has blocks."""
    rows = documents(spark, [(i, prose(i, 60)) for i in range(40)]).coalesce(1)
    whole = sorted(map(tuple, lattice_lm.score(rows, held_out(), PATH).collect()))
    kept = {}

    def cut(df, name, *more, **options):
        kept[name] = storage.cut(df, name, *more, **options)
        return kept[name]

    monkeypatch.setattr(lattice_lm, "cut", cut)
    monkeypatch.setattr(lattice_lm, "BLOCK_BYTES", 1)
    monkeypatch.setattr(lattice_lm, "slices", lambda batch: (batch.slice(i, 4) for i in range(0, batch.num_rows, 4)))
    found = sorted(map(tuple, lattice_lm.score(rows, held_out(), PATH).collect()))
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in kept["blocks"].inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert groups == [1] * 10
    assert len(found) == len(whole) and all(a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9) for a, b in zip(found, whole))
