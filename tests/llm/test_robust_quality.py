"""Statistics against a plain count; estimates against numpy; what is rejected and what is left alone."""

import re
from collections import Counter

import numpy as np
import pytest

from decisionlake.llm import robust_quality as quality
from tests.llm.helpers import prose, with_clashes


def plain(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(grams)
    covered = {k for i, g in enumerate(grams) if many[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), len("".join(w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \t\n\x0b\f\r ", "a", "a b", "a b c", "a b c a b c", " lead and trail \n", "x\ny\nx\n\n \n \nx ", "#*$%&|<> ## é|",
    "the the the the", "a b c d a b c e a b c", "éè \U0001f600 x y", "one\r\ntwo\r\none\r\n", prose(1, 400), "so it goes " * 40,
    "q " * 3 + prose(2, 80) + "\n" + prose(2, 80), "x" * 5000, "A a A a A a",
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def corpus(n=260):
    """Sound texts of two languages and several sources, some of them small, with strange ones among them."""
    rows, r = [], np.random.default_rng(3)
    for i in range(n):
        lang, source = ("en", "de")[i % 3 == 0], None if i % 7 == 0 else f"s{i % 2}" if i % 5 else f"rare{i % 11}"
        rows.append((i, prose(i, int(60 + 100 * r.gamma(2))), lang, source))
    for i in range(24):
        text = prose(1000 + i, 120)
        text = " ".join(w + "###" for w in text.split()) if i % 2 else "\n".join([text[:40]] * 14 + [text])
        rows.append((2000 + i, text, "en", "s1"))
    return rows + [(3000, "too short", "en", "s1"), (3001, None, None, None), (3002, prose(5, 90), None, None), (7, "b " * 90, "fr", "s0")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_statistics(spark):
    docs = with_clashes(frame(spark, [(i, t, None, None) for i, t in enumerate(TEXTS)]), "words", "lines", "placed", "n_words", "cell", "x0")
    found = {r.doc_id: tuple(r)[3:] for r in quality.statistics(docs).collect()}
    assert found == {i: plain(t) for i, t in enumerate(TEXTS)}


def _estimate(x, share=quality.SHARE, steps=quality.STEPS):
    """The same estimate, with numpy and whole arrays."""
    p, floor = x.shape[1], np.diag((np.array(quality.FLOORS) * quality.SCALE) ** 2)
    low = lambda v: np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]
    med = low(x)
    width = np.maximum(1.4826 * low(np.abs(x - med)), np.array(quality.FLOORS) * quality.SCALE)
    signs = np.sign(x - med)
    found = []
    for scatter in (np.diag(width**2), np.outer(width, width) * (signs.T @ signs) / len(x)):
        m, s = med, scatter + floor
        for _ in range(steps):
            d = np.sqrt(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m))
            bins = np.minimum((d * quality.BINS).astype(int), quality.MOST_BINS - 1)
            near = x[bins <= np.sort(bins)[int(np.ceil(share * len(x))) - 1]]
            m, s = near.mean(axis=0), quality.consistency(share, p) * np.cov(near.T, bias=True) + floor
        found.append((np.linalg.det(s), m, s))
    _, m, s = min(found, key=lambda f: f[0])
    d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    near = x[d2 <= quality.chi2_quantile(0.975, p)]
    return near.mean(axis=0), quality.consistency(0.975, p) * np.cov(near.T, bias=True) + floor


def test_estimates_equal_numpy(spark):
    r, rows = np.random.default_rng(8), []
    mixing = r.normal(size=(5, 5))
    for cell, n in (("a", 400), ("b", 75)):
        x = r.normal(size=(n, 5)) @ mixing * 900 + 5000
        x[: n // 6] += 9000
        x[:, 3] = np.where(r.random(n) < 0.8, 0, x[:, 3])
        rows += [(cell, *map(int, v)) for v in np.round(x)]
    found = quality.estimates(spark.createDataFrame(rows, "cell string, " + ", ".join(f"x{i} bigint" for i in range(5)))).collect()
    assert sorted(r.cell for r in found) == ["a", "b"]
    for row in found:
        m, s = _estimate(np.array([v[1:] for v in rows if v[0] == row.cell], float))
        factor = np.array([[row[f"l{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        assert np.allclose([row[f"m{i}"] for i in range(5)], m) and np.allclose(factor @ factor.T, s)


def test_rejects_strange_texts_and_keeps_sound_ones(spark):
    rows = corpus()
    found = {r.doc_id: r for r in quality.robust_quality(frame(spark, rows).repartition(5)).collect()}
    assert len(found) == len(rows) - 1  # one id is twice
    assert not any(found[i].kept for i in range(2000, 2024)) and not any(found[i].base_failed for i in range(2001, 2024, 2))
    assert all(found[i].kept for i, *_ in rows if i < 260 and i != 7)
    assert found[3000].base_failed and not found[3000].kept and found[3001].base_failed and found[3002].kept
    again = {r.doc_id: tuple(r) for r in quality.robust_quality(frame(spark, rows[::-1]).repartition(3)).filter("doc_id <> 7").collect()}
    assert again == {i: tuple(r) for i, r in found.items() if i != 7}


def test_small_groups_share_an_estimate(spark):
    rows = [(i, prose(i, 60), "en", f"s{i % 3}" if i < 180 else f"rare{i}") for i in range(240)] + [(900 + i, prose(i, 60), "de", None) for i in range(20)]
    cells = {(r.lang, r.source): r.cell for r in quality._cells(frame(spark, rows).drop("text")).collect()}
    assert len({cells["en", f"s{i}"] for i in range(3)}) == 3 and len({cells["en", f"rare{i}"] for i in range(180, 240)}) == 1
    assert cells["de", None] is None


def test_too_few_rows_and_empty_table(spark):
    assert quality.robust_quality(frame(spark, [])).collect() == []
    few = quality.robust_quality(frame(spark, [(1, prose(1, 60), "en", "s"), (1, prose(1, 60), "en", "s")])).collect()
    assert [(r.kept, r.distance) for r in few] == [(True, None)] * 2


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    quality.robust_quality(docs).explain("formatted")
    quality.statistics(docs).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", re.sub(r"Location: .*", "", capsys.readouterr().out))


@pytest.mark.parametrize("share,p,expected", [(0.975, 5, 12.832502), (0.95, 1, 3.841459), (0.9, 2, 4.605170), (0.95, 4, 9.487729)])
def test_quantiles(share, p, expected):
    assert quality.chi2_quantile(share, p) == pytest.approx(expected, abs=1e-5)
