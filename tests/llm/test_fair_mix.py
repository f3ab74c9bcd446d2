from collections import defaultdict

import pytest

from decisionlake.llm import fair_mix
from tests.llm.helpers import documents, prose, with_clashes, words


def goals(sizes, total):
    """Targets by repeated resharing of what is above the caps."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, left, open_ = {}, total, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level >= 2 * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in open_}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]
            open_.remove(s)
    return full


def rows_of():
    rows = [(i, prose(i, 5 + i % 40), "abcd"[i % 4] if i % 3 else "hot") for i in range(300)]
    return rows + [(400, None, "a"), (401, "", None), (402, "x y z " * 50, None), (None, "no id here", "b"), (403, prose(7, 15_000), "hot"), (5, rows[5][1], rows[5][2])]


def test_targets_and_takes(spark):
    rows = rows_of()
    mixed = fair_mix.fair_mix(with_clashes(documents(spark, rows)))
    found = fair_mix.per_row(mixed).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    expected = goals(sizes, 1.5 * sum(sizes.values()))
    assert len(found) == len(rows)
    source = {(i, len(words(t))): s for i, t, s in rows}
    taken = defaultdict(int)
    for r in found:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(expected[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    largest = defaultdict(int)
    for _, t, s in rows:
        largest[s] = max(largest[s], len(words(t)))
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2 * largest[s] + 1
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = fair_mix.per_row(fair_mix.fair_mix(documents(spark, rows[::-1])))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, found), key=str)


def test_mixed_rows_keep_columns_and_repeats(spark):
    docs = with_clashes(documents(spark, rows_of()), "times", "digest", "size")
    out = fair_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    times = {(r.doc_id, r.digest): r.times for r in fair_mix.fair_mix(docs).collect()}
    assert out.count() == sum(times.values()) + times[(5, next(d for i, d in times if i == 5))]


def test_no_words_and_empty_table(spark):
    found = fair_mix.per_row(fair_mix.fair_mix(documents(spark, [(1, None), (2, " ")]))).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2
    assert fair_mix.per_row(fair_mix.fair_mix(documents(spark, []))).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([(i % 3, i, i * 7 % 5) for i in range(200)], "g int, o bigint, v bigint")
    found = fair_mix.running_sum(df, ["g", "o"], "v", "s", by="g").collect()
    for r in found:
        assert r.s == sum(i * 7 % 5 for i in range(r.o + 1) if i % 3 == r.g)
