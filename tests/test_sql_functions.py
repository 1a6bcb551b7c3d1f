"""The SQL function surface equals the Column functions."""

import pytest
from pyspark.sql import functions as F

from slotplan.functions import fmt, sql, text as T
from slotplan.plans import inputs, planner
from tests.conftest import SF_SMALL

TEXTS = [None, "", " ", "nan", "Build", " gem ", "Build, Gem", "Event", "c: -1,250", "59.5", "n/a", "-", "3-4", "0.25 hrs", "12", "soon", " 7x", "+3", "0",
         "150", "\tNaN\n", "1.75 hrs", "99999999999999999999"]
NUMBERS = [None, 0, 1, 29, 59, 60, 61, 90, 119, 1439, 1440, 43200, 525600, 1234567, -5]


def pairs(name, x):
    return {
        "clean_int": T.clean_int(x), "hours_to_minutes": T.hours_text_to_minutes(x), "rcp_obtainability": T.rcp_obtainability(x),
        "appl_obtainability": T.appl_obtainability(x), "display": fmt.display(x),
    }[name]


@pytest.mark.parametrize("name", ["clean_int", "hours_to_minutes", "rcp_obtainability", "appl_obtainability", "display"])
def test_text_functions(spark, name):
    sql.register(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    assert df.where(~F.expr(f"{name}(x)").eqNullSafe(pairs(name, F.col("x")))).collect() == []


def test_number_functions(spark):
    sql.register(spark)
    df = spark.createDataFrame([(m, t) for m in NUMBERS for t in (1, 30, 60, 720)], "m bigint, t int")
    checks = {"format_minutes(m)": fmt.format_minutes("m"), "format_short(m)": fmt.format_short("m"), "rate_2dp(m, t)": fmt.rate_2dp("m", "t"),
              "rate_0dp(m, t)": fmt.rate_0dp("m", "t"), "rate_js(m, t)": fmt.rate_js("m", "t")}
    for call, want in checks.items():
        assert df.where(~F.expr(call).eqNullSafe(want)).collect() == [], call
    clamp = spark.createDataFrame([(t, d) for t in TEXTS for d in (-1, 0, 200)], "x string, d int")
    for d in (-1, 0, 200):
        assert clamp.where(f"d = {d}").where(~F.expr("level_clamp(x, d)").eqNullSafe(fmt.level_clamp("x", d))).collect() == []
    scores = spark.createDataFrame([(r, a) for r in ("easy", "hard", None) for a in ("easy", "medium", "hard", None)], "r string, a string")
    assert scores.where(~F.expr("difficulty(r, a)").eqNullSafe(T.difficulty("r", "a"))).collect() == []
    tiers = spark.createDataFrame([(t, s) for t in ("easy", "medium", "hard", "other", None) for s in (None, 1, 2, 3, 6, 7)], "t string, s int")
    assert tiers.where(~F.expr("in_tier(t, s)").eqNullSafe(planner.tier_predicate(F.col("t"), "s"))).collect() == []


def test_planner_from_sql(spark):
    master = inputs.master(spark, SF_SMALL)
    sql.register_planner(spark, master)
    for mode, level, tier in (("bakery", 40, "medium"), ("restaurant", 7, "easy")):
        got = spark.sql(f"SELECT * FROM planner('{mode}', {level}, '{tier}')")
        want = planner.filtered_report(spark, master, mode, level, tier)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for call in ("planner('other', 1, 'easy')", "planner('bakery', 0, 'easy')", "planner('bakery', 1, null)"):
        with pytest.raises(Exception, match="must be"):
            spark.sql(f"SELECT * FROM {call}").collect()


def test_planner_at_any_minute_from_sql(spark, tmp_path):
    master = inputs.master(spark, SF_SMALL)
    planner.any_time_staircases(planner.cell_staircases(master)).write.parquet(str(tmp_path / "steps"))
    sql.register_planner_at(spark, spark.read.parquet(str(tmp_path / "steps")))
    for minutes in (1, 60, 777):
        got = {r.metric: (r.recipe, r.best, r.per_hr) for r in spark.sql(f"SELECT * FROM planner_at('bakery', 40, 'medium', {minutes})").collect()}
        want = planner.filtered_report(spark, master, "bakery", 40, "medium", slots=(minutes,)).first()
        assert got.get("rcp_xp", (None, None, None)) == (want.best_xp_recipe, want.best_xp, want.xp_per_hr)
        assert got.get("rcp_profit", (None, None, None)) == (want.best_profit_recipe, want.best_profit, want.profit_per_hr)
