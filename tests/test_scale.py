import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.operators import scale
from decisionlake.operators.episodes import logged_transitions
from decisionlake.plans import data
from decisionlake.sources.events_view import trajectories_from_events
from tests.conftest import SMALL


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).isEmpty()


def test_split_hot_users_equal_plain_windows(spark):
    events = data.table(spark, SMALL, "events")
    same(trajectories_from_events(events, 10**6), trajectories_from_events(events, task_rows=9))


def test_one_user_with_most_rows_equals_plain_windows(spark):
    events = data.table(spark, SMALL, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 != 0, F.lit(7)).otherwise(F.col("user_id")))
    same(trajectories_from_events(events, 10**6), trajectories_from_events(events, task_rows=50))


def test_split_transitions_equal_plain_ones_with_gaps(spark, trajectories):
    gappy = trajectories.filter(F.col("time_step") % 4 != 2)
    same(logged_transitions(gappy, row_bound=10**6, validated=True), logged_transitions(gappy, task_rows=10, validated=True))
    same(logged_transitions(trajectories, row_bound=10**6), logged_transitions(trajectories, task_rows=10))


def test_neighbours_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("x", 1, "b"), ("x", 2, "c"), ("x", 3, "d")], "k string, t int, v string")
    out = scale.neighbours(df, "k", "t", number="n", ahead=("next", ["v"]), task_rows=2)
    assert sorted((r.k or "", r.n, r.next and r.next.v) for r in out.collect()) == [
        ("", 0, None), ("x", 0, "c"), ("x", 1, "d"), ("x", 2, None)]


@pytest.mark.parametrize("limit", [10, 200])
def test_bracketed_quantiles_equal_numpy(spark, limit):
    rng = np.random.default_rng(3)
    rows = [(g, float(x)) for g in ("a", "b") for x in np.concatenate(
        [rng.normal(size=400), np.full(300, 0.25), [1e12, -1e12, 5.0]])]
    rows += [("c", None), (None, 1.5)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {r["g"]: r["x_q"] for r in scale.group_quantiles(df, ["g"], ["x"], probs, task_rows=limit).collect()}
    for g in ("a", "b"):
        values = [x for k, x in rows if k == g]
        assert np.allclose(got[g], np.quantile(values, probs), atol=1e-12)
    assert got["c"] is None and got[None] == [1.5] * len(probs)


def test_quantiles_of_many_groups_reach_no_driver(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(g, k, float(x), float(-x)) for g in range(60) for k in ("a", None) for x in np.round(rng.normal(size=25), 1)]
    rows += [(0, "a", 0.5, None)] * 700 + [(61, "b", None, None), (62, None, float("inf"), 1.0), (62, None, float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "g int, k string, x double, y double").repartition(7)
    probs = (0.0, 0.1, 0.5, 0.77, 1.0)
    plain = scale.group_quantiles(df, ["g", "k"], ["x", "y"], probs, row_bound=1)
    want = {(r["g"], r["k"]): (r["x_q"], r["y_q"]) for r in plain.collect()}

    def refused(self):
        raise AssertionError("collected")

    with monkeypatch.context() as patched:
        patched.setattr(type(df), "collect", refused)
        split = scale.group_quantiles(df, ["g", "k"], ["x", "y"], probs, task_rows=50, few_cells=10)
    got = {(r["g"], r["k"]): (r["x_q"], r["y_q"]) for r in split.collect()}
    assert got.keys() == want.keys() and split.columns == plain.columns
    for group, pair in want.items():
        for a, b in zip(got[group], pair):
            assert (a is None) == (b is None) and (a is None or np.allclose(a, b, atol=1e-12, equal_nan=True)), group
    none = scale.group_quantiles(df.limit(0), ["g"], ["x"], probs, row_bound=10**9, few_cells=0)
    assert none.count() == 0


@pytest.mark.parametrize("values", [
    [0.3] * 10 + [0.1 + 0.2] * 10,
    [float("inf")] * 9 + [1.0] * 3 + [float("-inf")] * 9,
    [float("nan")] * 9 + [2.0, 3.0, 4.0],
    [0.0, -0.0] * 6 + [5e-324] * 7,
    [float(i) for i in range(500)],
])
def test_ranged_quantiles_agree_on_awkward_values(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "g int, x double")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    plain = scale.group_quantiles(df, ["g"], ["x"], probs, row_bound=1).first()["x_q"]
    split = scale.group_quantiles(df, ["g"], ["x"], probs, row_bound=10**9, task_rows=4, few_cells=0).first()["x_q"]
    assert [str(a + 0.0) for a in split] == [str(a + 0.0) for a in plain]


def test_number_in_blocks_is_a_row_number(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    out = scale.number_in_blocks(df, ["g"], F.substring("h", 1, 1), ["h"], "n").toPandas()
    for _, part in out.sort_values("h").groupby("g"):
        assert part["n"].tolist() == list(range(len(part)))


def test_salted_top_equals_plain_top(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1009).alias("v"), "id")
    order = [F.desc("v"), "id"]
    same(scale.top_per_group(df, ["g"], order, 7, row_bound=1),
         scale.top_per_group(df, ["g"], order, 7, salt=["id"]))


def test_small_side_broadcasts_only_within_the_limit(spark):
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(scale.small_side(spark.range(5), 10))
    assert "ResolvedHint" not in plan(scale.small_side(spark.range(50), 10))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_plans_limit_before_the_shuffle(spark):
    from decisionlake.plans.catalog import QUERIES

    for name in ("contrastive_examples", "factual_library"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "WindowGroupLimit" in plan and ", Partial" in plan


def test_hot_windows_are_keyed_by_slice(spark, trajectories):
    plan = plan_of(logged_transitions(trajectories, task_rows=10))
    assert "hashpartitioning(patient_id" in plan and "_slice" in plan


def test_order_of_wall_clock_times_ignores_the_session_zone(spark):
    events = data.table(spark, SMALL, "events")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = trajectories_from_events(events.withColumn("ts", F.expr("ts + INTERVAL 280 DAYS")), 10**6).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(rows) == sorted(trajectories_from_events(events, 10**6).collect())


POSITIONS = [None, None, 1, 1, 1, 2, 5, 5, 9, 10**12, -4]


@pytest.mark.parametrize("limit", [2, 4])
def test_both_window_forms_agree_on_null_positions_ties_and_hot_null_keys(spark, limit):
    rows = [(k, p, i, f"v{i}" if i % 4 else None) for k in ("x", None, "y") for i, p in enumerate(POSITIONS * (3 if k != "y" else 1))]
    df = spark.createDataFrame(rows, "k string, t bigint, i int, v string")
    args = dict(tie=("i",), number="n", behind=("before", ["v"]), ahead=("after", ["v", "i"]))
    plain = scale.neighbours(df, "k", "t", row_bound=1, **args)
    split = scale.neighbours(df, "k", "t", task_rows=limit, **args)
    same(plain, split)
    assert split.count() == len(rows)


def test_many_rows_at_one_position_are_split_by_the_tie(spark):
    df = spark.range(300).select(F.lit("x").alias("k"), F.lit(3).alias("t"), "id")
    args = dict(tie=("id",), number="n", behind=("before", ["id"]))
    same(scale.neighbours(df, "k", "t", row_bound=1, **args), scale.neighbours(df, "k", "t", task_rows=20, **args))


@pytest.mark.parametrize("values", [
    [0.3] * 10 + [0.1 + 0.2] * 10,
    [float("inf")] * 9 + [1.0] * 3 + [float("-inf")] * 9,
    [float("nan")] * 9 + [2.0, 3.0, 4.0],
    [0.0, -0.0] * 6 + [5e-324] * 7,
    [-1.0] * 12 + [-1.0000000000000002] * 12 + [None],
])
def test_both_quantile_forms_agree_on_awkward_values(spark, values):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    plain = scale.group_quantiles(df, [], ["x"], probs, row_bound=1).first()[0]
    split = scale.group_quantiles(df, [], ["x"], probs, row_bound=10**9, task_rows=4).first()[0]
    assert [str(float(a)).replace("-0.0", "0.0") for a in split] == [str(float(a)).replace("-0.0", "0.0") for a in plain]


def test_long_user_ids_stay_apart(spark):
    events = data.table(spark, SMALL, "events").withColumn("user_id", F.col("user_id") + 12_345_600)
    out = trajectories_from_events(events, 10**6)
    assert out.select("patient_id").distinct().count() == events.select("user_id").distinct().count()
    assert out.groupBy("patient_id", "time_step").count().filter("count > 1").isEmpty()


def test_left_out_quantiles_equal_a_quantile_per_side(spark):
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(1, 4)), ["a", "b", None][int(rng.integers(3))],
             None if i % 7 == 0 else float(rng.integers(9)) if i % 2 else float(rng.normal()), None) for i in range(900)]
    df = spark.createDataFrame(rows, "fold int, g string, x double, nothing double")
    for groups in (["g"], []):
        args = (df, "fold", [0, 1, 2, 3], groups, ["x", "nothing"], (0.25, 0.5))
        plain = scale.left_out_quantiles(*args, row_bound=900).collect()
        split = scale.left_out_quantiles(*args, row_bound=900, task_rows=10).collect()

        def cells(found):
            return {(r["side"], r["g"] if groups else None): r["x_q"] for r in found}

        assert cells(plain).keys() == cells(split).keys() and len(plain) == len(split)
        for cell, q in cells(plain).items():
            assert cells(split)[cell] == pytest.approx(q)
        assert all(r["nothing_q"] is None or r["nothing_q"][0] is None for r in split)


def test_brackets_of_a_cell_share_a_sketch_and_are_narrowed(spark, monkeypatch):
    """Brackets past ``BRACKET_ROWS`` are narrowed, whatever the rows that a percentile may hold."""
    monkeypatch.setattr(scale, "BRACKET_ROWS", 20)
    asked = []
    monkeypatch.setattr(scale.F, "percentile_approx", lambda *a, f=scale.F.percentile_approx: asked.append(a) or f(*a))
    df = spark.range(600).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 % 301).cast("double").alias("x"))
    found = scale.group_quantiles(df, ["g"], ["x"], (0.1, 0.5, 0.9), task_rows=500).orderBy("g").collect()
    plain = scale.group_quantiles(df, ["g"], ["x"], (0.1, 0.5, 0.9), row_bound=600).orderBy("g").collect()
    assert asked and [r["x_q"] for r in found] == [pytest.approx(r["x_q"]) for r in plain]
