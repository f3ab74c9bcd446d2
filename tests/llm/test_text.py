import numpy as np
import pyarrow as pa

from decisionlake.llm.text import LETTERS, Words, gram_hashes, minima, slices
from tests.llm.helpers import words


def test_words_of_neighbouring_texts_stay_apart():
    texts = ["Ab cd", "ef", None, "", " \t x\x0by ", "É é"]
    found = Words(pa.array(texts))
    per = [[found.word(i).decode() for i in range(a, b)] for a, b in zip(found.at[:-1], found.at[1:])]
    assert [[w for w in x] for x in per] == [words(t) for t in texts]


def test_equal_words_have_equal_hashes_anywhere():
    found = Words(pa.array(["the cat", "xx The cat", "catthe"]))
    h = found.hash
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_sliced_columns_and_letters():
    column = pa.array(["zz", "a-b1", None, "q"]).slice(1, 3)
    found = Words(column, LETTERS)
    assert [found.word(i) for i in range(len(found.start))] == [b"a", b"b1", b"q"]
    assert found.at.tolist() == [0, 2, 2, 3]


def test_minima_and_grams():
    v = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 2, 3, 7, 51):
        assert minima(v, w).tolist() == [v[i : i + w].min() for i in range(50 - w + 1)]
    assert gram_hashes(v[:3], 5).tolist() == []


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, "b" * 50, None, "c", "d" * 5]})
    parts = list(slices(batch, limit=12))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) > 1
