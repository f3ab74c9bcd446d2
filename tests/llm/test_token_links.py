"""Alignment of two vocabularies against a plain version that encodes whole texts and compares all token ranges."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from decisionlake.llm import token_links
from decisionlake.llm.queries import QUERIES, vocabulary
from tests.llm.helpers import documents, prose, with_clashes

FIRST, SECOND = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def _spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends], ends))


def brute(rows):
    a_side, b_side = token_links.ByteLevel(FIRST), token_links.Pieces(SECOND)
    found = []
    for doc_id, text in rows:
        text = text or ""
        a, b = a_side.tokenizer.encode(" " + text, add_special_tokens=False).ids, b_side.model.encode(text)
        same = all(b"".join(side.tokens[i] for i in ids) == (" " + text).encode() for side, ids in ((a_side, a), (b_side, b)))
        if not text or not same:
            found.append((doc_id, [], [], [], []))
            continue
        x, y = _spans([a_side.tokens[i] for i in a]), _spans([b_side.tokens[i] for i in b])
        cuts = sorted({e for _, e in x} & {e for _, e in y})
        groups = [([i for i, (s, e) in zip(a, x) if lo <= s < hi], [j for j, (s, e) in zip(b, y) if lo <= s < hi]) for lo, hi in zip([0, *cuts], cuts)]
        links = [(a[i], b[j]) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e]
        found.append((doc_id, a, b, groups, links))
    count = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

ODD = [
    None, "", " ", "  ", "a ", " a", "a  b   c", "tabs\tand\nlines\r\n\n two  ", "\n", "　wide　space 　", "no\xa0break \xa0 x",
    "▁ mark", "x▁ y", "<|endoftext|> plain <s> </s> <unk> <0x41>", "\x00\x01 \x1c \x1f x", "\xe9 ﬁ é \U0001d518 \U0001f600\U0001f600",
    "don't we'll I'M 'S", "中文 字 漢字", "\xdcn\xefc\xf6d\xe9 \xdftra\xdfe na\xefve", "1234567890 12,345.67 --- ... !!!", "a  line para", "a\x0bb\x0cc \x85d", "x  y  z ",
]


@pytest.mark.parametrize("hot_pairs", [token_links.HOT_PAIRS, 5])
def test_equals_plain_version(spark, monkeypatch, hot_pairs):
    rows = [*enumerate(ODD), *((100 + i, prose(i, 5 + 9 * i)) for i in range(12)), (3, "a b"), (3, "a b"), (None, "null id"), (500, prose(7, 900) + "\n" + "x" * 400)]
    docs = with_clashes(documents(spark, rows), "pairs", "row", "times", "pair")
    found = token_links.token_links(docs, FIRST, SECOND, hot_pairs)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_stretches_equal_whole_texts():
    r = np.random.default_rng(5)
    signs = np.array(list("ab  cd\xe9.,'!1239\n\t \xdf\xf1-_\xfc<|>\xa0\u2003") + ["the", " un", "\n\n", "  ", "ing", "中", " ", "s'"])
    texts = ["".join(r.choice(signs, r.integers(1, 60))) for _ in range(1500)]
    encoder = token_links.PairEncoder(FIRST, SECOND)
    own = token_links.Aligned(encoder, pa.array(texts))
    for i, text in enumerate(texts):
        a, b = encoder.sides[0].encode([" " + text])[0], encoder.sides[1].model.encode(text)
        assert own.ids[0][own.at[0][i] : own.at[0][i + 1]].tolist() == a, repr(text)
        assert own.ids[1][own.at[1][i] : own.at[1][i + 1]].tolist() == b, repr(text)


def test_lanes_and_small_tables_change_nothing(monkeypatch):
    texts = [prose(i, 40 * i) for i in range(8)]
    whole = token_links.Aligned(token_links.PairEncoder(FIRST, SECOND), pa.array(texts))
    monkeypatch.setattr(token_links, "LANE", 3)
    monkeypatch.setattr(token_links.PairEncoder, "KEPT", 64)
    encoder = token_links.PairEncoder(FIRST, SECOND)
    decimals = token_links._Decimals(51_000)
    for _ in range(2):
        parts = token_links.Aligned(encoder, pa.array(texts))
        assert np.array_equal(np.sort(whole.link_a), np.sort(parts.link_a)) and np.array_equal(whole.cut_b, parts.cut_b)
        assert whole.digests(decimals) == parts.digests(decimals)


def test_empty_table(spark):
    assert token_links.token_links(documents(spark, []), FIRST, SECOND).collect() == []


def test_query_equals_plain_version(spark):
    small = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").filter("n_chars < 3000").collect()]
    found = {r.doc_id: r for r in QUERIES["op13_token_links"](spark, small).collect()}
    assert len(found) == spark.read.parquet(f"{small}/documents.parquet").count()
    for doc_id, n_a, n_b, n_groups, n_links, _, _, digest in brute(rows):
        r = found[doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, n_links, digest)
