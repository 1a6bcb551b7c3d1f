"""Level table typing, forward fill, as-of lookup, and the fold against the cycle loop."""

import random

import pytest
from pyspark.sql import functions as F

from slotplan.operators.levels import (cycles_to_target, level_array, slot_changes, slots_at,
                                       typed_levels, with_cycles)


def loop_cycles(rate, thresholds, slots, target):
    """The cycle-by-cycle definition."""
    if rate is None or rate <= 0:
        return None
    xp, cycle, st, idx = 0, 0, 2, 0
    while xp < target:
        cycle += 1
        xp += st * rate
        while idx < len(thresholds) and xp >= thresholds[idx]:
            st = slots[idx]
            idx += 1
    return cycle


def levels_df(spark, rows):
    return spark.createDataFrame([(str(i + 1), x, s) for i, (x, s) in enumerate(rows)],
                                 "Level string, ` XP` string, `Slots ` string")


def test_ffill_and_typing(spark):
    lv = levels_df(spark, [("0", None), ("5", "3"), ("9", None), (" 1,200 ", "x")])
    t = typed_levels(lv)
    assert t.columns == ["level", "xp", "slots"]
    arr = level_array(lv).first()["levels"]
    assert [(e["xp"], e["slots"]) for e in arr] == [(0, 2), (5, 3), (9, 3), (1200, 3)]


def test_bad_xp_raises(spark):
    lv = levels_df(spark, [("abc", "2")])
    with pytest.raises(Exception):
        typed_levels(lv).collect()


@pytest.mark.parametrize("seed", range(3))
def test_fold_matches_loop(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 8)
    xs = sorted(rnd.randint(0, 5000) for _ in range(n))
    ss = [rnd.choice([None, 1, 2, 3, 5, 8]) for _ in range(n)]
    lv = levels_df(spark, [(str(x), None if s is None else str(s)) for x, s in zip(xs, ss)])
    filled, last = [], None
    for s in ss:
        last = s if s is not None else last
        filled.append(last if last is not None else 2)
    target = rnd.randint(1, 20000)
    rates = [None, 0, -3] + [rnd.randint(1, 400) for _ in range(100)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rates)], "i int, r bigint")
    arr = level_array(lv).scalar()
    got = df.withColumn("_lv", arr).select("i", cycles_to_target("r", "_lv", target).alias("c"))
    got = dict((r.i, r.c) for r in got.collect())
    for i, r in enumerate(rates):
        assert got[i] == loop_cycles(r, xs, filled, target), (r, xs, filled, target)


def test_with_cycles_and_asof(spark):
    lv = levels_df(spark, [("0", "2"), ("100", "4"), ("1,000", None)])
    df = spark.createDataFrame([(1, 10), (2, 10), (3, None), (4, 600)], "k int, r bigint")
    out = {r.k: r.cycles for r in with_cycles(df, "r", lv, target=2000).collect()}
    assert out == {k: loop_cycles(r, [0, 100, 1000], [2, 4, 4], 2000)
                   for k, r in [(1, 10), (2, 10), (3, None), (4, 600)]}
    arr = level_array(lv).scalar()
    got = (df.withColumn("_lv", arr).select("k", slots_at(F.col("r") * 2, "_lv").alias("s"))
             .orderBy("k").collect())
    assert [r.s for r in got] == [2, 2, None, 4]


def test_printed_sample_rows(spark):
    """Printed sample rows: (xp 6, 1 min), (340, 2760), (209, 2780) on a simple table."""
    lv = levels_df(spark, [("0", "2"), ("1,000", "3"), ("50,000", "5"), ("400,000", "8")])
    df = spark.createDataFrame([(6, 1), (340, 2760), (209, 2780)], "r bigint, t bigint")
    got = with_cycles(df, "r", lv).collect()
    for row in got:
        assert row.cycles == loop_cycles(row.r, [0, 1000, 50000, 400000], [2, 3, 5, 8], 803600)


def test_truncation(spark):
    lv = levels_df(spark, [("1,200.7", "2.9"), ("10", "-1.5")])
    got = sorted((r.xp, r.slots) for r in typed_levels(lv).collect())
    assert got == [(10, -1), (1200, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_only_changes_of_slots_are_folded(spark, seed):
    """The fold over the changes equals the fold over all levels, odd levels included."""
    rnd = random.Random(seed)
    slots = [None, "1", "2", "2", "3", "x"] + (["0", "-1"] if seed == 3 else [])
    rows = [(None if seed == 2 and rnd.random() < 0.1 else str(rnd.randint(0, 3000)), rnd.choice(slots)) for _ in range(30)]
    df = spark.createDataFrame([(None,), (0,), (-2,), *[(rnd.randint(1, 900),) for _ in range(60)]], "r bigint")
    arr = level_array(levels_df(spark, rows))
    both = df.withColumn("all", arr.scalar()).withColumn("few", arr.select(slot_changes(F.col("levels"))).scalar())
    got = both.select("r", F.size("few").alias("n"), cycles_to_target("r", "all", 2500).alias("a"), cycles_to_target("r", "few", 2500).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and (seed == 3 or any(r.a is not None for r in got))
    assert got[0].n < 30


def test_levels_of_equal_slots_become_one_step(spark):
    lv = levels_df(spark, [(str(100 * i), str(2 + i // 10)) for i in range(99)])
    steps = level_array(lv).select(slot_changes(F.col("levels")).alias("s")).first().s
    assert [(x.xp, x.slots) for x in steps] == [(1000 * k, 2 + k) for k in range(1, 10)]
