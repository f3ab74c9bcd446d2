import random
import zlib

import pytest

from decisionlake.llm import toxicity
from tests.llm.helpers import documents, prose, with_clashes


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_automaton_equals_edit_distance(edits):
    r = random.Random(1)
    terms = ["idiot", "moron", "scum", "worthless", "clown", "clowns", "é" * 6]
    words = [t for t in terms] + ["", "i", "idiots", "1diot", "wortless", "worthlesss", "scums", "cum", "xclown"]
    for _ in range(400):
        w = list(r.choice(terms))
        for _ in range(r.randrange(4)):
            at = r.randrange(len(w) + 1)
            w[at : at + r.randrange(2)] = r.choice(["", "x", "i", "o"])
        words.append("".join(w))
    own = toxicity.Lexicon(terms, ["lowei"], edits)
    own.KEPT = 30
    for w in words:
        best = [d for t in terms if (d := distance(w, t)) <= (edits if len(t) >= 5 else 0)]
        assert own.distance(w) == min(best, default=-1), w
    assert own.distance("loweixyz") == 0 and own.distance("lowe") == (-1 if edits == 1 else 2)


def corpus(n=600):
    r, rows, labels = random.Random(3), [], []
    for i in range(n):
        bad = i % 5 == 0
        w = prose(i, 60, 3000).split()
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["moronic", "scumbag", "worthless"]))
        rows.append((i, " ".join(w)))
        labels.append((i, None, int(bad)))
    return rows, labels


def test_held_out_texts_and_misspellings(spark):
    rows, labels = corpus()
    rows += [(1001, None), (1002, ""), (1003, "you m0ronic worthles " * 3 + prose(1, 20)), (1004, prose(77, 20_000)), (1005, prose(5, 40)), (None, "scumbag"), (1, rows[1][1])]
    labels += [(0, 1, 0), (5, 1, None), (None, 1, 1), (9999, 1, 1)]
    marked = with_clashes(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), "text", "score", "n")
    found = toxicity.toxicity(with_clashes(documents(spark, rows), "score", "toxic", "features", "predicted"), marked).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i in range(600):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert by[i].predicted == (i % 5 == 0), i
    assert by[1003].predicted == 1 and not by[None].held_out
    assert all(by[i].predicted == 0 for i in (1001, 1002, 1004, 1005)) and all(0 <= r.score <= 1 for r in found)


def test_misspelled_first_part_of_a_family_with_a_stem(spark):
    r, rows, labels = random.Random(8), [], []
    family = ["scumbag", "scumbags", "scumbagger", "scumbaggery", "scumbagging"]
    for i in range(600):
        w = prose(i, 60, 3000).split()
        if i % 5 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(family))
        rows.append((i, " ".join(w)))
        labels.append((i, None, int(i % 5 == 0)))
    rows += [(1000, prose(1000, 60, 3000) + " you zcumbags and scubagger, sxcumbaggery"), (1001, prose(1001, 60, 3000))]
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    terms, stems, _ = toxicity.learn(documents(spark, rows), marked)[0].value
    assert stems == ["scum"]
    own = toxicity.Lexicon(terms, stems)
    assert [own.distance(w) for w in ("zcumbags", "scubagger", "sxcumbaggery", "scumbaglike", "xcum")] == [1, 1, 1, 0, -1]
    found = {x.doc_id: x.predicted for x in toxicity.toxicity(documents(spark, rows), marked).collect()}
    assert found[1000] == 1 and found[1001] == 0


def test_quotation_is_told_from_abuse():
    import pyarrow as pa

    own = toxicity.Scorer(["scumbag"], [], {})
    said = own.features(pa.array(['he wrote "you scumbag" yesterday', "you scumbag", 'a "b" scumbag "c"', "“scumbag”", '"open scumbag', None]))
    assert said[:, 2].round(3).tolist() == [0.693, 0, 0, 0.693, 0, 0]
    assert said[:, 3].tolist() == [0, 1, 1, 0, 1, 0]


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 1, 1)], 1.0), ([(1, 1, 0)], 0.0)])
def test_without_both_labels(spark, labels, score):
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert [r.score for r in toxicity.toxicity(documents(spark, [(1, "a"), (2, None)]), marked).collect()] == [score] * 2
    assert toxicity.toxicity(documents(spark, []), marked).count() == 0
