import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from decisionlake.llm import token_orc
from decisionlake.llm.queries import vocabulary
from tests.llm.helpers import documents, prose, with_clashes

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


HARD = [
    "", None, "Hello, WORLD's it's don't 12345 a1b2  x y", "<|endoftext|> in <|startoftext|>text", "éclair É İI ǅ ß ΑΣ σς", "🙂🙃 中文 字",
    "tab\tnew\nline\x0bvt\x0cff\rcr  double", "a<|b <|", "!!!! ... '' '", "x" * 3000, "naïve café. (naïve) [naïve]! déjà-vu", "\x1c\x1d\x85", "ﬁ ﬀ ½ Ⅷ ª",
]


def test_round_trip_is_exact(spark, tokenizer, tmp_path):
    rows = [(i * 3 % 41, t) for i, t in enumerate(HARD)] + [(None, "no id"), (7, prose(1, 30_000)), (7, "b"), (7, "b"), (99, prose(2, 500))]
    path = str(tmp_path / "t")
    token_orc.write_tokens(with_clashes(documents(spark, rows), "part", "tokens", "_h"), path, PATH)
    got = token_orc.token_digests(spark, path).orderBy("start").collect()
    kept = {r.start: r for r in got}
    assert len(got) == len(rows)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    expected = {}
    for i, t in rows:
        a = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.setdefault(i, []).append((len(a), zlib.crc32(a.tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in expected[r.doc_id]
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert not any(expected.values()) and kept


def test_lookup_reads_by_id(spark, tmp_path):
    path = str(tmp_path / "t")
    token_orc.write_tokens(documents(spark, [(i, f"word{i}") for i in range(300)]), path, PATH)
    rows = token_orc.read_tokens(spark, path).filter("doc_id IN (5, 250)")
    assert sorted(r.doc_id for r in rows.collect()) == [5, 250]
    assert "PushedFilters: [In(doc_id" in rows._jdf.queryExecution().toString()


def test_empty_table(spark, tmp_path):
    token_orc.write_tokens(documents(spark, []), str(tmp_path / "t"), PATH)
    assert token_orc.token_digests(spark, str(tmp_path / "t")).count() == 0


def test_memory_of_words_is_bounded(tokenizer):
    import pyarrow as pa

    own = token_orc.Encoder(PATH)
    own.KEPT = 50
    for i in range(5):
        texts = [prose(10 * i + j, 200, 3000) for j in range(3)]
        ids, counts = own.encode(pa.array(texts))
        assert ids.tolist() == sum((tokenizer.encode(t, add_special_tokens=False).ids for t in texts), [])
