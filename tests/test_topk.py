"""Prefix top-1 against the direct plan, ties, nulls, empty slots, nested tiers."""

import random

from pyspark.sql import functions as F

from slotplan.operators.topk import (naive_best, prefix_best, prefix_topk, slots_frame,
                                     with_all_slots)

SLOTS = (1, 5, 10, 15, 30, 60, 120)
METRICS = (("x", {"bx_name": "name", "bx": "x"}), ("p", {"bp_name": "name", "bp": "p"}))


def sample(spark, n=400, seed=7):
    rnd = random.Random(seed)
    data = [(i, f"n{i}", rnd.choice(["a", "b", "c"]), rnd.choice([None, 0, 1, 3, 7, 12, 40, 70, 200]),
             rnd.choice([None, 1, 2, 2, 5, 9]), rnd.randint(-5, 5)) for i in range(n)]
    return spark.createDataFrame(data, "ord bigint, name string, g string, t bigint, x bigint, p bigint")


def key(df):
    return sorted(tuple(r) for r in df.collect())


def test_prefix_equals_naive(spark):
    df = sample(spark)
    a = prefix_best(df, time="t", slots=SLOTS, metrics=METRICS, ord_cols=("ord",), group_by=("g",))
    b = naive_best(df, time="t", slots=SLOTS, metrics=METRICS, ord_cols=("ord",), group_by=("g",))
    cols = ["g", "return_time", "bx_name", "bx", "bp_name", "bp"]
    assert key(a.select(*cols)) == key(b.select(*cols))


def test_ties_first_and_nulls_last(spark):
    df = spark.createDataFrame([(2, "late", 5, 7), (1, "early", 5, 7), (3, "nullx", 5, None)],
                               "ord bigint, name string, t bigint, x bigint")
    best = prefix_best(df, time="t", slots=(5,), metrics=(("x", {"n": "name"}),), ord_cols=("ord",))
    assert best.first()["n"] == "early"
    only_null = df.where("x is null")
    best = prefix_best(only_null, time="t", slots=(5,), metrics=(("x", {"n": "name"}),),
                       ord_cols=("ord",))
    assert best.first()["n"] == "nullx"


def test_empty_slot_omitted_or_kept(spark):
    df = spark.createDataFrame([(1, "a", 3, 1)], "ord bigint, name string, t bigint, x bigint")
    best = prefix_best(df, time="t", slots=(1, 5), metrics=(("x", {"n": "name"}),), ord_cols=("ord",))
    assert key(best) == [(5, "a")]
    kept = with_all_slots(best, slots_frame(spark, (1, 5)))
    assert key(kept) == [(1, None), (5, "a")]


def test_nested_tiers_monotone(spark):
    df = sample(spark, 300, seed=3).withColumn("lvl", (F.col("ord") % 3 + 1).cast("int"))
    tiers = F.array(F.lit("easy"), F.lit("medium"), F.lit("hard"))
    fan = (("lvl", "tier", F.slice(tiers, F.col("lvl"), 3)),)
    best = prefix_best(df, time="t", slots=SLOTS, metrics=(("x", {"bx": "x"}),), ord_cols=("ord",),
                       group_by=("lvl",), fan_out=fan)
    vals = {(r["tier"], r["return_time"]): r["bx"] for r in best.collect()}
    order = {"easy": 0, "medium": 1, "hard": 2}
    for (tier, slot), v in vals.items():
        for (t2, s2), v2 in vals.items():
            if order[t2] >= order[tier] and s2 >= slot and v is not None:
                assert v2 is not None and v2 >= v
    # every tier equals a direct filter on its members
    for tier, cap in order.items():
        members = df.where(F.col("lvl") <= cap + 1)
        direct = prefix_best(members, time="t", slots=SLOTS, metrics=(("x", {"bx": "x"}),),
                             ord_cols=("ord",))
        assert {(r["return_time"], r["bx"]) for r in direct.collect()} == \
            {(s, v) for (t, s), v in vals.items() if t == tier}


def test_topk_matches_sorting(spark):
    df = sample(spark, 200, seed=11)
    top = prefix_topk(df, time="t", slots=SLOTS, metric="x", k=3, payload={"name": "name"},
                      ord_cols=("ord",))
    rows = df.collect()
    for s in SLOTS:
        fit = [r for r in rows if r.t is not None and r.t <= s]
        fit.sort(key=lambda r: (r.x is None, -(r.x or 0), r.ord))
        want = [(i + 1, r.name) for i, r in enumerate(fit[:3])]
        got = sorted((r["rank"], r["name"]) for r in top.where(F.col("return_time") == s).collect())
        assert got == want


def test_strategies_agree(spark):
    df = sample(spark, 500, seed=21)
    kw = dict(time="t", slots=SLOTS, metrics=METRICS, ord_cols=("ord",), group_by=("g",))
    a = prefix_best(df, strategy="struct", **kw)
    b = prefix_best(df, strategy="maxima", **kw)
    assert key(a) == key(b)
    # all-null metric group and heavy ties
    ties = spark.createDataFrame([(i, f"n{i}", "h", 3, 5 if i % 2 else None, None) for i in range(40)],
                                 "ord bigint, name string, g string, t bigint, x bigint, p bigint")
    assert key(prefix_best(ties, strategy="struct", **kw)) == key(prefix_best(ties, strategy="maxima", **kw))


def test_cube_monotone_in_level_and_slot(spark):
    from tests.conftest import SF_SMALL
    from slotplan.plans.planner import planner_cube
    rows = planner_cube(spark, SF_SMALL).collect()
    best = {(r.game_mode, r.recipe_type, r.level, r.return_time): r.best_xp for r in rows}
    for (g, t, lvl, s), v in best.items():
        for key in ((g, t, lvl + 1, s), (g, t, lvl, s * 2)):
            if key in best and v is not None:
                assert best[key] is not None and best[key] >= v
    tiers = ("easy", "medium", "hard")
    for (g, t, lvl, s), v in best.items():
        if t != "hard" and v is not None:
            looser = (g, tiers[tiers.index(t) + 1], lvl, s)
            assert best[looser] >= v


def test_nan_metric_ranks_with_nulls(spark):
    df = spark.createDataFrame([(1, "nan", 5, float("nan")), (2, "null", 5, None), (3, "five", 5, 5.0)],
                               "ord bigint, name string, t bigint, x double")
    for strategy in ("struct", "maxima"):
        best = prefix_best(df, time="t", slots=(5,), metrics=(("x", {"n": "name"}),), ord_cols=("ord",),
                           strategy=strategy)
        assert best.first()["n"] == "five"
    top = prefix_topk(df, time="t", slots=(5,), metric="x", k=1, payload={"n": "name"}, ord_cols=("ord",))
    assert top.first()["n"] == "five"
