import random
from collections import defaultdict

from decisionlake.llm import graph, minhash_tensor
from decisionlake.llm.graph import components
from tests.llm.helpers import documents, prose, with_clashes, words


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        name = min(least[find(i)], default=None) if sets[i] else d
        out.append((d, len(sets[i]), name, d is not None and d == name))
    return sorted(out, key=str)


def edited(text, edits, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_tensor.near_duplicates(df).collect()), key=str)


def test_groups_of_copies_match_all_pairs(spark):
    base, other = prose(1, 150, 5000), prose(2, 60, 5000)
    rows = [(10 + i, edited(base, i % 9, i)) for i in range(80)]
    rows += [(200 + i, edited(other, i % 4, i)) for i in range(30)]
    rows += [(300 + i, prose(50 + i, 30) + " " + base[:400]) for i in range(20)]
    rows += [(400, base), (401, base.upper()), (402, base), (403, "short Text"), (404, "SHORT text"), (405, None), (406, ""), (407, " \n")]
    rows += [(None, base), (403, "short Text"), (500, "one"), (501, "one " * 7), (502, "one " * 900), (503, prose(3, 20_000, 9000))]
    assert found(with_clashes(documents(spark, rows))) == brute(rows)


def test_threshold_is_inclusive(spark):
    w = [f"w{i}" for i in range(24)]
    # 20 shingles against 15 of them, and against 15 with one word more
    rows = [(1, " ".join(w)), (2, " ".join(w[:19])), (3, " ".join(w[:18]))]
    assert found(documents(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_pairs_at_the_threshold_are_met():
    import numpy as np

    r, met, n = np.random.default_rng(3), 0, 300
    for _ in range(n):
        s = r.integers(1, 2**63, 140, dtype=np.uint64)
        a, b = s[:120], s[20:]  # 100 of 140 in common: below 0.75
        a = np.concatenate([a, s[120:125]])
        sig = minhash_tensor.signatures([np.sort(a), np.sort(np.concatenate([s[:1], b]))])
        same = (sig[0] == sig[1]).reshape(-1, 2).all(axis=1)
        met += same[:12].any() and same[12:].any()
    assert met >= n - 2


def test_pairs_of_one_hub_are_confirmed_as_in_blocks(spark):
    sets = [(i, list(range(i % 9, 40))) for i in range(700)]
    table = spark.createDataFrame(sets, "node bigint, set array<bigint>")
    pairs = [(0, i) for i in range(1, 650)] + [(650 + i, 660 + i) for i in range(10)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [sorted(map(tuple, minhash_tensor._confirmed(frame, table, 85, stars=stars).collect())) for stars in (True, False)]
    of = dict(sets)
    close = lambda a, b: 100 * len(set(of[a]) & set(of[b])) >= 85 * len(set(of[a]) | set(of[b]))
    assert got[0] == got[1] == sorted(p for p in pairs if close(*p)) != sorted(pairs)


def _reached(edges):
    least = {x: x for e in edges for x in e}
    while any(least[a] != least[b] for a, b in edges):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_components_over_several_tasks(spark, monkeypatch):
    r = random.Random(5)
    edges = [(r.randrange(90), r.randrange(90)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)]
    edges = [(a, b) for a, b in edges if a != b]
    monkeypatch.setattr(graph, "TASK_EDGES", 16)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted(_reached(edges).items())


def test_components_of_few_edges_take_few_jobs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(40)]
    spark.sparkContext.setJobGroup("few-edges", "components")
    try:
        got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few-edges")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == _reached(edges)
    assert 0 < len(jobs) <= 12


def test_rows_are_dealt_once_for_their_counts_and_themselves(spark):
    sigs = [(i, [1 + (i % 7) * (j % 3) for j in range(minhash_tensor.HASHES)]) for i in range(40)]
    sides = minhash_tensor.sub_keys(spark.createDataFrame(sigs, "node bigint, sig array<int>"))
    sets = spark.createDataFrame([(1, [1, 2, 3]), (2, [2, 3, 4]), (3, [3, 4, 5]), (4, [9])], "node bigint, set array<bigint>")
    placed = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 3), (4, 3)], "node bigint, root bigint")
    elsewhere = minhash_tensor._shared_elsewhere(placed, sets)
    assert sorted(map(tuple, elsewhere.collect())) == [(1, 1), (2, 2), (3, 2)]
    for frame, key in ((sides, "i#"), (elsewhere, "s#")):
        assert frame._jdf.queryExecution().sparkPlan().toString().count("Generate") == 1
        initial = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert initial.count(f"Exchange hashpartitioning({key}") == 1


def test_sketches_do_not_depend_on_the_parts_taken(monkeypatch):
    import numpy as np

    sets = [np.random.default_rng(n).integers(1, 2**63, n, dtype=np.uint64) for n in (1, 7, 50)] + [np.empty(0, np.uint64)]
    whole = [w.to_pylist() for w in minhash_tensor.sketches(sets)]
    monkeypatch.setattr(minhash_tensor, "SKETCH_SHINGLES", 7)
    assert [w.to_pylist() for w in minhash_tensor.sketches(sets)] == whole and len(whole) == minhash_tensor.SKETCH // 64
