import hashlib
import re

from decisionlake.llm import winnowing
from tests.llm.helpers import LOWER, documents, prose, with_clashes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = split(t)
        for at in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[at : at + 10]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in range(1, 11):
            for at in range(len(w) - n + 1):
                if (items_of := windows.get(tuple(w[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= items_of - {None}
        names = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    rows = winnowing.decontaminate(with_clashes(documents(spark, docs)), with_clashes(items, "hash", "words", "window"))
    return sorted((tuple(r) for r in rows.drop("digest").collect()), key=str)


def test_every_shared_window_is_found(spark):
    items = [(i, prose(i, 12 + i % 30, 60)) for i in range(25)]
    items += [(30, "Short item of five words"), (31, "one"), (32, None), (33, "..."), (None, prose(90, 20)), (34, items[0][1]), (0, prose(91, 15)), (35, "same " * 14)]
    docs = []
    for i in range(60):
        a, b = items[i % 25][1], items[(i * 7) % 25][1]
        cut = split(a)[i % 5 : i % 5 + 8 + i % 6]
        docs.append((i, f"{prose(200 + i, 15, 60)} {' '.join(cut).upper()}, {b[: 20 + i * 3]}! {prose(300 + i, 9, 60)}"))
    docs += [(70, None), (71, ""), (72, "x short-item OF five, words. y one"), (73, prose(90, 20)), (73, prose(90, 20)), (None, items[3][1]), (74, "same " * 40), (75, "same " * 9)]
    docs.append((76, prose(5, 20_000, 900) + " " + items[7][1] + " " + items[7][1]))
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "a b c"), (2, None)]
    assert found(spark, docs, []) == brute(docs, [])
    assert found(spark, [], [(1, "a b")]) == []
