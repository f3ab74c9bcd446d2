import hashlib
import random

import numpy as np
import pytest

from decisionlake.llm import run_index
from tests.llm.helpers import documents, prose, with_clashes


def brute(rows, length):
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, result = set(), {}
    for i, t in order:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        result[(i, t)] = (i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return sorted((result[(i, t or "")] for i, t in rows), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in run_index.remove_repeats(df, **options).collect()), key=str)


def repetitive(n=60):
    r = random.Random(4)
    passages = [prose(i, 40, 5000) for i in range(4)]
    rows = []
    for i in range(n):
        parts = [prose(100 + i, r.randrange(0, 30), 5000), r.choice(passages)[r.randrange(30) :], prose(500 + i, r.randrange(20), 5000), passages[0][: r.randrange(40, 240)]]
        rows.append((i * 7 % n, " ".join(parts)))
    return rows + [(n + 1, "ab" * 400), (n + 2, "x" * 350), (n + 3, None), (n + 4, ""), (n + 5, "short"), (None, rows[0][1]), (n + 6, rows[3][1]), (n + 6, rows[3][1]), (n + 7, prose(9, 5000))]


@pytest.mark.parametrize("most", [5000, 1])
def test_all_repeated_windows_go(spark, most):
    rows = repetitive()
    assert found(with_clashes(documents(spark, rows), "digest", "b", "place", "wanted", "i", "g"), most_contexts=most) == brute(rows, 100)


def test_other_lengths_and_kept_text(spark):
    rows = repetitive(20)
    kept = run_index.remove_repeats(documents(spark, rows), length=60, k=20, with_text=True)
    assert sorted((tuple(r)[:-1] for r in kept.collect()), key=str) == brute(rows, 60)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in kept.collect())


def test_copies_of_a_context_fill_whole_batches(spark):
    passage = prose(1, 60, 5000)
    rows = [(i, prose(10 + i, 5 + i % 7, 5000) + " " + passage + " " + prose(90 + i, 9, 5000)) for i in range(45)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(documents(spark, rows)) == brute(rows, 100)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_statistics_from_runs_equal_direct_ones():
    r = random.Random(2)
    pieces = [bytes(r.choice(b"ab") for _ in range(r.randrange(1, 60))) for _ in range(30)] + [b"ab" * 30, b"ab" * 29]
    text, starts, ends = [], [], []
    for p in pieces:
        starts.append(len(text))
        text += [b + 1 for b in p] + [0]
        ends.append(len(text) - 1)
    text, starts, ends = np.array(text), np.array(starts), np.array(ends)
    order = run_index.suffix_array(text, starts, ends, 60)
    rest = {i: (text[i : e].tolist() + [0], p) for p, (s, e) in enumerate(zip(starts, ends)) for i in range(s, e + 1)}
    assert order.tolist() == sorted(rest, key=rest.get)
    suffix, match = run_index.run_samples(text, order)
    assert len(suffix) < len(text)
    shared = run_index.matching_statistics(len(text), suffix, match)
    for before, i in zip(order[:-1], order[1:]):
        a, b = rest[before][0][:-1], rest[i][0][:-1]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == n


def test_texts_of_one_id_with_like_hashes_stay_apart(spark):
    from pyspark.sql import functions as F

    passage = prose(77, 60, 5000)
    texts = spark.range(40_000).select(F.concat(F.lit(passage + " "), F.col("id").cast("string")).alias("text"))
    alike = texts.groupBy(F.shiftrightunsigned(F.xxhash64("text"), 38)).agg(F.collect_list("text").alias("t")).filter("size(t) > 1").first()["t"]
    for ids in ((None, None), (5, 5)):
        got = found(documents(spark, list(zip(ids, alike))))
        assert sorted(r[2] for r in got)[0] == 0 and sorted(r[2] for r in got)[1] > 100
    with pytest.raises(ValueError):
        run_index.repeated_spans(documents(spark, []), length=200, k=32)


def test_workers_keep_no_tables_of_powers():
    import pyarrow as pa

    from decisionlake.llm import text

    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "digest": [0, 0], "text": [prose(1, 200), prose(1, 200)]})
    assert sum(b.num_rows for b in run_index._context_task(100, 32)(iter([rows]))) > 0
    assert text._powers == []


def test_results_of_texts_without_repeats_take_one_python_pass(spark):
    rows = documents(spark, [(1, prose(1, 60, 5000)), (2, prose(2, 60, 5000))])
    shown = run_index.remove_repeats(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("MapInArrow") == 3  # two for texts with repeats, whose spans are joined between
