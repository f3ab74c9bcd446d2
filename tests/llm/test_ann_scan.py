import numpy as np

from decisionlake.llm import ann_scan

SCHEMA = "vec_id bigint, embedding array<float>, label int, list int, vector string, bound string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "clash", "clash") for i, v in rows], SCHEMA)


def search(spark, rows, asked, k=20):
    df = table(spark, rows)
    index = ann_scan.build(df, k)
    return ann_scan.search(index, df.filter(f"vec_id % {asked} = 0"), k).collect()


def brute(rows, asked, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, q in good:
        if i % asked == 0 and i not in out:
            near = sorted(((-float(q @ v), j) for j, v in good if j != i))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def random_rows(n, d=16, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    return [(i, [float(a) for a in v]) for i, v in enumerate(x)]


def test_small_tables_are_searched_in_full_with_ties(spark):
    rows = random_rows(300) + [(1000 + i, [1.0] * 16) for i in range(60)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] + [1.0] * 15), (2080, []), (2100, [1.0] * 3), (None, [1.0] * 16), (2120, [float("inf")] * 16)]
    found, expected = {}, brute([r for r in rows if r[0] != 2100], 20)
    for r in sorted(search(spark, rows, 20), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == expected.keys()
    for q in expected:
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in expected[q]], rtol=1e-12, atol=1e-12)


def test_recall_on_many_vectors_and_a_hot_one(spark):
    rows = random_rows(6000, seed=4) + [(10_000 + i, [3.0] + [0.5] * 15) for i in range(3000)]
    found, expected, hit = {}, brute(rows[:9000], 200), 0
    for r in search(spark, rows, 200):
        found.setdefault(r.query_id, set()).add(round(r.score, 9))
    for q in expected:
        hit += len({round(s, 9) for _, s in expected[q]} & found[q]) / len({round(s, 9) for _, s in expected[q]})
    assert hit / len(expected) >= 0.95


def test_fewer_candidates_than_asked_and_empty(spark):
    assert sorted((r.query_id, r.vec_id) for r in search(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (20, [0.0, 1.0])], 20)) == [(0, 1), (0, 20), (20, 0), (20, 1)]
    assert search(spark, [(0, [1.0])], 20) == [] and search(spark, [], 20) == [] and search(spark, [(0, None)], 20) == []
