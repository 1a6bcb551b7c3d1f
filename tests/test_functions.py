"""Edge rows for the column functions (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from slotplan.functions import fmt
from slotplan.functions import text as T


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def many(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_int(spark):
    got = many(spark, T.clean_int, ["c: -1,250", "59.5", "n/a", "3-4", "-", None, "007"])
    assert got == [-1250, 595, None, None, None, None, 7]
    bad = many(spark, T.clean_int_is_bad, ["n/a", "3-4", "12", None])
    assert bad == [True, True, False, False]


def test_hours_to_minutes(spark):
    got = many(spark, T.hours_text_to_minutes, ["0.25 hrs", "2.00 hrs", "soon", "30 min", "0.375 hrs",
                                                "0.625 hrs", None])
    # 22.5 → 22 and 37.5 → 38 (half to even); "30 min" is read as hours
    assert got == [15, 120, None, 1800, 22, 38, None]


def test_labels(spark):
    assert many(spark, T.rcp_obtainability, [None, "", " NaN ", "Gem", "\tnan\n"]) == \
        ["easy", "easy", "easy", "hard", "easy"]
    assert many(spark, T.appl_obtainability, ["", "Build", " gem ", "Build, Gem", "Event", None,
                                              "Build, Gem, Event"]) == \
        ["easy", "medium", "medium", "hard", "hard", "easy", "hard"]


def test_difficulty(spark):
    df = spark.createDataFrame([("easy", "easy"), ("easy", "medium"), ("hard", "easy"),
                                ("hard", "hard"), ("easy", None), ("EASY", "Medium")],
                               "r string, a string")
    got = [r[0] for r in df.select(T.difficulty("r", "a")).collect()]
    assert got == [2, 3, 4, 6, 4, 3]


def test_slug(spark):
    assert one(spark, T.title_slug, "ice-cream maker bob's") == "Ice-Cream_Maker_Bob'S"
    assert one(spark, T.title_slug, "1st OVEN") == "1St_Oven"


def test_url_basename(spark):
    assert many(spark, T.url_basename_png, ["http://a/b/c?x=1", "http://a/b/c.png", "https://h/x/y.jpg#f"]) \
        == ["c.png", "c.png", "y.jpg.png"]


def test_regex_field_null_not_empty(spark):
    assert many(spark, lambda c: T.regex_field(c, r"Lvl:\s*(\d+)"), ["Lvl: 12", "none"]) == ["12", None]


def test_format_minutes(spark):
    got = many(spark, fmt.format_minutes, [0, 60, 2780, 1576801, None], "bigint")
    assert got == ["0 minutes", "1 hours", "1 days 22 hours 20 minutes", "3 years 1 minutes", None]


def test_format_short(spark):
    assert many(spark, fmt.format_short, [5, 60, 90, 61, 2880], "bigint") == \
        ["5 min", "1 hr", "1.5 hr", "1.0 hr", "48 hr"]


def test_level_clamp(spark):
    assert many(spark, fmt.level_clamp, ["0", "abc", "150", "12abc", " 7", "-3", None]) == \
        [1, 1, 99, 12, 7, 1, 1]


def test_display_zero_stays(spark):
    assert many(spark, fmt.display, [0, None, 5], "bigint") == ["0", "-", "5"]


def test_rates(spark):
    df = spark.createDataFrame([(-1, 120), (1, 120), (5, 1)], "x bigint, t int")
    got = df.select(fmt.rate_0dp("x", "t").alias("s"), fmt.rate_js("x", "t").alias("j"),
                    fmt.rate_2dp("x", "t").alias("d")).collect()
    assert [(r.s, r.j, r.d) for r in got] == [(-1, 0, -0.5), (1, 1, 0.5), (300, 300, 300.0)]


def test_nan_to_null(spark):
    assert many(spark, T.nan_to_null, [float("nan"), float("inf"), float("-inf"), 1.5], "double") == \
        [None, None, None, 1.5]


def test_clean_column_name():
    assert T.clean_column_name(" Slots ") == "slots"
    assert T.clean_column_name("Return Time (min)") == "return_time_min"


def test_json_html_text(spark):
    assert one(spark, T.json_html_text, '{"parse":{"text":{"*":"<t>x</t>"}}}') == "<t>x</t>"


def test_medium_sql_predicate_and_clean_recipes(spark):
    from slotplan.operators.clean import clean_recipes
    from slotplan.plans.planner import medium_predicate, easy_predicate
    df = spark.createDataFrame([("", "Build, Gem, Event"), (None, "Event"), ("", None), ("Gem", "Build")],
                               "rcp_labels string, appl_labels string")
    got = [(r[0], r[1]) for r in df.select(medium_predicate(), easy_predicate()).collect()]
    assert got == [(True, False), (False, False), (True, True), (False, False)]
    raw = spark.createDataFrame([(1, "Turtle Soup", "c: -1,250", "2,000 coins", "12 xp", "9 hrs", None)],
                                "rcp_ord bigint, rcp_name string, rcp_cost string, rcp_income string, "
                                "rcp_xp string, rcp_time_hr string, rcp_labels string")
    r = clean_recipes(raw).first()
    assert (r.rcp_cost, r.rcp_income, r.rcp_profit, r.rcp_time_min, r.rcp_obtainability) == \
        (1250, 2000, 750, 15, "easy")


def test_keep_where(spark):
    from slotplan.operators.quality import keep_where
    df = spark.createDataFrame([(1, "12"), (2, None), (3, "x")], "i int, t string")
    parsed = df.withColumn("n", F.regexp_extract("t", "([0-9]+)", 1).try_cast("int"))
    kept = keep_where(parsed, F.col("n") > 5)
    assert [r.i for r in kept.collect()] == [1]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "regexp_extract" not in plan.split("Generate")[1].split("Project")[0]
