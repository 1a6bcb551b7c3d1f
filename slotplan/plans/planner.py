"""The planner family: best item per return-time slot.

* ``sql`` semantics (the four stored SQL reports): one game's recipes left-joined
  to appliances, tiers by label predicates (easy ⊂ medium ⊂ hard), slots with
  no candidate left out, rates rounded to 2 decimals.
* ``score`` semantics (interactive planner): master table filtered by game,
  level and difficulty score, every slot kept, rates rounded half up.

Both rank by metric descending with nulls last, ties to the first row in
table order. All plans use :func:`slotplan.operators.topk.prefix_best`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (DEFAULT_LEVEL, DEFAULT_MODE, DEFAULT_TIER, MODES, RETURN_SLOTS,
                         RETURN_SLOTS_TIERS, TIER_MAX_SCORE, TIERS)
from ..functions.fmt import display, format_short as format_slot, rate_2dp, rate_js
from ..functions.text import empty_label_sql
from ..operators.joins import sized_join
from ..operators.quality import keep_where
from ..operators.staircase import best_at, staircase, steps_of
from ..operators.topk import prefix_best, slots_frame, with_all_slots
from . import inputs

XP_PROFIT = (
    ("rcp_xp", {"best_xp_recipe": "rcp_name", "best_xp": "rcp_xp"}),
    ("rcp_profit", {"best_profit_recipe": "rcp_name", "best_profit": "rcp_profit"}),
)
XP_PROFIT_APPL = (
    ("rcp_xp", {"best_xp_recipe": "rcp_name", "best_xp_appl": "appl_name", "best_xp": "rcp_xp"}),
    ("rcp_profit", {"best_profit_recipe": "rcp_name", "best_profit_appl": "appl_name",
                    "best_profit": "rcp_profit"}),
)
ORD = ("rcp_ord",)


def easy_predicate(rcp_labels="rcp_labels", appl_labels="appl_labels"):
    """C17: no recipe label and no appliance label."""
    return empty_label_sql(rcp_labels) & empty_label_sql(appl_labels)


def medium_predicate(rcp_labels="rcp_labels", appl_labels="appl_labels"):
    """No recipe label; appliance label mentions build or gem, or is empty."""
    a = F.coalesce(F.col(appl_labels), F.lit(""))
    return empty_label_sql(rcp_labels) & (a.ilike("%build%") | a.ilike("%gem%")
                                          | empty_label_sql(appl_labels))


def sql_tier_level():
    """Strictest tier a row passes: 1 easy, 2 medium, 3 hard (everything)."""
    return (F.when(easy_predicate(), 1).when(medium_predicate(), 2).otherwise(3)).cast("int")


def sql_candidates(spark: SparkSession, sf_dir: str, mode: str = DEFAULT_MODE,
                   require_time: bool = True) -> DataFrame:
    """One game's clean recipes, left-joined to appliance labels.

    ``require_time`` keeps only rows with a numeric, non-negative time. The
    planners pass False: a row without a time never lands in a slot bucket, and
    filtering first would make Catalyst evaluate the time expression again.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    r = inputs.recipes_clean(spark, sf_dir).where(F.col("game_mode") == mode)
    if require_time:  # the time is parsed from text: select without a pushed re-parse
        r = keep_where(r, F.col("rcp_time_min").isNotNull() & (F.col("rcp_time_min") >= 0))
    r = (r
         .select("rcp_ord", "rcp_name", "appl_name", "rcp_xp", "rcp_profit",
                 "rcp_time_min", "rcp_labels"))
    a = (inputs.appliances(spark, sf_dir).where(F.col("game_mode") == mode)
         .select("appl_name", "appl_labels"))
    return sized_join(r, a, on="appl_name", how="left").withColumn("tier_level", sql_tier_level())


def with_sql_rates(df: DataFrame) -> DataFrame:
    """Per-hour rates with 2 decimals."""
    return (df.withColumn("xp_per_hr", rate_2dp("best_xp", "return_time"))
              .withColumn("profit_per_hr", rate_2dp("best_profit", "return_time")))


def _sql_report(spark, sf_dir, max_level: int, slots=RETURN_SLOTS, mode=DEFAULT_MODE) -> DataFrame:
    cand = sql_candidates(spark, sf_dir, mode, require_time=False).where(F.col("tier_level") <= max_level)
    best = prefix_best(cand, time="rcp_time_min", slots=slots, metrics=XP_PROFIT, ord_cols=ORD)
    return (with_sql_rates(best)
            .select("return_time", "best_xp_recipe", "best_xp", "xp_per_hr",
                    "best_profit_recipe", "best_profit", "profit_per_hr")
            .orderBy("return_time"))


def planner_easy(spark, sf_dir, slots=RETURN_SLOTS, mode=DEFAULT_MODE) -> DataFrame:
    """Q1: easy recipes (no labels on recipe or appliance)."""
    return _sql_report(spark, sf_dir, 1, slots, mode)


def planner_medium_sql(spark, sf_dir, slots=RETURN_SLOTS, mode=DEFAULT_MODE) -> DataFrame:
    """Q2: easy + medium by the SQL substring predicate."""
    return _sql_report(spark, sf_dir, 2, slots, mode)


def planner_hard(spark, sf_dir, slots=RETURN_SLOTS, mode=DEFAULT_MODE) -> DataFrame:
    """Q3: every recipe."""
    return _sql_report(spark, sf_dir, 3, slots, mode)


XP_THEN_PROFIT = (
    (("rcp_xp", "rcp_profit"), {"best_xp_recipe": "rcp_name", "best_xp": "rcp_xp"}),
    (("rcp_profit", "rcp_xp"), {"best_profit_recipe": "rcp_name", "best_profit": "rcp_profit"}),
)


def planner_tiebreak(spark, sf_dir, slots=RETURN_SLOTS, mode=DEFAULT_MODE) -> DataFrame:
    """Q3 with the wanted tie rule: equal xp → higher profit wins (and equal profit →
    higher xp), then first in table order."""
    cand = sql_candidates(spark, sf_dir, mode, require_time=False)
    best = prefix_best(cand, time="rcp_time_min", slots=slots, metrics=XP_THEN_PROFIT, ord_cols=ORD)
    return (with_sql_rates(best)
            .select("return_time", "best_xp_recipe", "best_xp", "xp_per_hr",
                    "best_profit_recipe", "best_profit", "profit_per_hr")
            .orderBy("return_time"))


def planner_tiers(spark, sf_dir, slots=RETURN_SLOTS_TIERS, mode=DEFAULT_MODE) -> DataFrame:
    """Q4: all three tiers in one pass (one scan, nested tiers), ordered by slot then tier."""
    return tiers_report(sql_candidates(spark, sf_dir, mode, require_time=False), slots)


def tiers_report(cand: DataFrame, slots=RETURN_SLOTS_TIERS, strategy: str = "struct") -> DataFrame:
    """Q4 over any candidate table with ``tier_level`` (1 easy, 2 medium, 3 hard)."""
    tier_arr = F.array(*[F.lit(t) for t in TIERS])
    looser = ("tier_level", "recipe_type", F.slice(tier_arr, F.col("tier_level"), len(TIERS)))
    best = prefix_best(cand, time="rcp_time_min", slots=slots, metrics=XP_PROFIT, ord_cols=ORD,
                       group_by=("tier_level",), fan_out=(looser,), strategy=strategy,
                       reduce_slots=False)
    tier_order = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("recipe_type"))
    return (with_sql_rates(best)
            .select("return_time", "recipe_type", "best_xp_recipe", "best_xp", "xp_per_hr",
                    "best_profit_recipe", "best_profit", "profit_per_hr")
            .orderBy("return_time", tier_order))


def tier_predicate(tier, score="rcp_difficulty"):
    """Easy → score = 2, medium → <= 3, hard → <= 6, anything else → false."""
    s = F.col(score)
    t = F.lit(tier) if isinstance(tier, str) else tier
    e = None
    for name, ceiling in TIER_MAX_SCORE:
        cond = (s == ceiling) if name == "easy" else (s <= ceiling)
        e = F.when(t == name, cond) if e is None else e.when(t == name, cond)
    return F.coalesce(e.otherwise(F.lit(False)), F.lit(False))


def validate_params(mode: str, level: int, tier: str) -> None:
    """Game in the list, level 1..99, tier in the list."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if not isinstance(level, int) or not 1 <= level <= 99:
        raise ValueError(f"level must be an integer in 1..99, got {level!r}")
    if tier not in TIERS:
        raise ValueError(f"tier must be one of {TIERS}, got {tier!r}")


def score_candidates(master: DataFrame, mode: str, level: int, tier: str) -> DataFrame:
    """game = mode, level <= L, tier predicate on the difficulty score.

    Rows with a null level are dropped; rows with a null time never land in a
    slot bucket, so they drop out there.
    """
    validate_params(mode, level, tier)
    # game and level are plain columns (pushed down); the score is derived from
    # parsed labels, so it is selected without a pushed re-evaluation
    return keep_where(master.where((F.col("game_mode") == mode) & (F.col("rcp_level") <= level)),
                      tier_predicate(tier))


def planner_filtered(spark, sf_dir, mode: str = DEFAULT_MODE, level: int = DEFAULT_LEVEL,
                     tier: str = DEFAULT_TIER, slots: Sequence[int] = RETURN_SLOTS,
                     keep_empty: bool = True) -> DataFrame:
    """Interactive planner for one (game, level, tier): every slot, best xp and profit."""
    return filtered_report(spark, inputs.master(spark, sf_dir), mode, level, tier, slots, keep_empty)


def filtered_report(spark, master: DataFrame, mode: str = DEFAULT_MODE, level: int = DEFAULT_LEVEL,
                    tier: str = DEFAULT_TIER, slots: Sequence[int] = RETURN_SLOTS,
                    keep_empty: bool = True) -> DataFrame:
    """The interactive planner over any master table."""
    cand = score_candidates(master, mode, level, tier)
    best = prefix_best(cand, time="rcp_time_min", slots=slots, metrics=XP_PROFIT_APPL,
                       ord_cols=ORD)
    if keep_empty:
        best = with_all_slots(best, slots_frame(spark, slots))
    return (best.withColumn("xp_per_hr", rate_js("best_xp", "return_time"))
                .withColumn("profit_per_hr", rate_js("best_profit", "return_time"))
                .select("return_time", "best_xp_recipe", "best_xp_appl", "best_xp", "xp_per_hr",
                        "best_profit_recipe", "best_profit_appl", "best_profit", "profit_per_hr"))


def planner_cube(spark, sf_dir, slots: Sequence[int] = RETURN_SLOTS) -> DataFrame:
    """Every (game, level 1..99, tier, slot) answer precomputed, so a lookup is a filter.

    A row with level l and score s counts for every level >= l and every tier
    whose ceiling admits s. Winners per (game, level, score, bucket) are found
    once over the raw rows; only those winners are fanned out over slots, tiers
    and levels, with a reduction after each step.
    """
    return cube_report(inputs.master(spark, sf_dir), slots)


def cube_report(master: DataFrame, slots: Sequence[int] = RETURN_SLOTS,
                strategy: str = "struct") -> DataFrame:
    """The (game, level, tier, slot) cube over any master table."""
    m = (master
         .where((F.col("rcp_level") <= 99) & F.col("game_mode").isin(*MODES))
         .withColumn("_lvl", F.greatest(F.col("rcp_level"), F.lit(1))))
    tier_ok = F.filter(F.array(*[F.struct(F.lit(n).alias("t"), F.lit(c).alias("c"))
                                 for n, c in TIER_MAX_SCORE]),
                       lambda x: F.when(x["t"] == "easy", F.col("rcp_difficulty") == x["c"])
                                  .otherwise(F.col("rcp_difficulty") <= x["c"]))
    fan = (("rcp_difficulty", "recipe_type", F.transform(tier_ok, lambda x: x["t"])),
           ("_lvl", "level", F.sequence(F.col("_lvl"), F.lit(99))))
    best = prefix_best(m, time="rcp_time_min", slots=slots, metrics=XP_PROFIT_APPL, ord_cols=ORD,
                       group_by=("game_mode", "_lvl", "rcp_difficulty"), fan_out=fan,
                       strategy=strategy, reduce_slots=False)
    return (best.withColumn("level", F.col("level").cast("int"))
                .withColumn("xp_per_hr", rate_js("best_xp", "return_time"))
                .withColumn("profit_per_hr", rate_js("best_profit", "return_time"))
                .select("game_mode", "level", "recipe_type", "return_time",
                        "best_xp_recipe", "best_xp_appl", "best_xp", "xp_per_hr",
                        "best_profit_recipe", "best_profit_appl", "best_profit", "profit_per_hr"))


def cube_lookup(spark, cube_path: str, mode: str = DEFAULT_MODE, level: int = DEFAULT_LEVEL,
                tier: str = DEFAULT_TIER) -> DataFrame:
    """Answer one (game, level, tier) from a stored cube: a filter on the cube table
    (pushed to the parquet scan), plus the slots that have no candidate."""
    validate_params(mode, level, tier)
    cube = spark.read.parquet(cube_path)
    hit = cube.where((F.col("game_mode") == mode) & (F.col("level") == level)
                     & (F.col("recipe_type") == tier)).drop("game_mode", "level", "recipe_type")
    slots = sorted(set(RETURN_SLOTS))
    return with_all_slots(hit, slots_frame(spark, slots))


# ------------------------------------------------------------------ any return time

STAIR_CELL = ("game_mode", "level", "recipe_type", "metric")
_STAIR_PAYLOAD = {"recipe": "rcp_name", "appl": "appl_name", "img": "rcp_img_url", "value": "_metric"}


def cell_staircases(master: DataFrame) -> DataFrame:
    """Staircases of the raw rows per (game, level, score, metric): what a store keeps and new rows merge into."""
    m = (master.where((F.col("rcp_level") <= 99) & F.col("game_mode").isin(*MODES))
         .withColumn("_lvl", F.greatest(F.col("rcp_level"), F.lit(1))))
    # a row's two metrics are two rows of slim cells
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("_metric")) for name, _ in XP_PROFIT]))
    rows = m.select("*", each.alias("_e")).select(*[c for c in m.columns if c not in ("metric", "_metric")], "_e.*")
    return staircase(rows, ("game_mode", "_lvl", "rcp_difficulty", "metric"), "rcp_time_min", "_metric", ORD, _STAIR_PAYLOAD)


def any_time_staircases(cells: DataFrame) -> DataFrame:
    """Staircases per (game, level 1..99, tier, metric) from those of :func:`cell_staircases`.

    A step of level l and score s counts for every level from l on and every tier that
    admits s; only steps are fanned out, never rows.
    """
    tiers = F.filter(F.array(*[F.struct(F.lit(n).alias("t"), F.lit(c).alias("c")) for n, c in TIER_MAX_SCORE]),
                     lambda x: F.when(x["t"] == "easy", F.col("rcp_difficulty") == x["c"]).otherwise(F.col("rcp_difficulty") <= x["c"]))
    fan = (cells.withColumn("recipe_type", F.explode(F.transform(tiers, lambda x: x["t"])))
           .withColumn("level", F.explode(F.sequence(F.col("_lvl"), F.lit(99)))))
    return steps_of(fan.select(*STAIR_CELL, "time", "best"), STAIR_CELL)


def planner_at(asks: DataFrame, steps: DataFrame) -> DataFrame:
    """Report rows for ``asks`` (game_mode, level, recipe_type, return_time): any times, any cells.

    Each ask is one look-up in the staircase of each metric.
    """
    keys = ["game_mode", "level", "recipe_type", "return_time"]
    asks = asks.select(*keys).distinct()
    each = asks.withColumn("metric", F.explode(F.array(*[F.lit(m) for m, _ in XP_PROFIT])))
    hit = best_at(each, steps, STAIR_CELL, "return_time")
    of = lambda metric, field: F.max(F.when(F.col("metric") == metric, F.col("best")[field]))
    out = hit.groupBy(*keys).agg(*[of(f"rcp_{m}", field).alias(f"best_{m}{suffix}") for m in ("xp", "profit")
                                   for field, suffix in (("recipe", "_recipe"), ("appl", "_appl"), ("value", ""))])
    return (out.withColumn("xp_per_hr", rate_js("best_xp", "return_time")).withColumn("profit_per_hr", rate_js("best_profit", "return_time"))
            .select(*keys, "best_xp_recipe", "best_xp_appl", "best_xp", "xp_per_hr",
                    "best_profit_recipe", "best_profit_appl", "best_profit", "profit_per_hr"))


ANY_TIMES = (1, 2880)      # minutes


def planner_any_time(spark, sf_dir) -> DataFrame:
    """C23/J8/E5 for every minute of ``ANY_TIMES`` and all tiers of the default game and level."""
    steps = any_time_staircases(cell_staircases(inputs.master(spark, sf_dir)))
    asks = (spark.range(ANY_TIMES[0], ANY_TIMES[1] + 1).select(
        F.lit(DEFAULT_MODE).alias("game_mode"), F.lit(DEFAULT_LEVEL).alias("level"),
        F.explode(F.array(*[F.lit(t) for t in TIERS])).alias("recipe_type"), F.col("id").alias("return_time")))
    return planner_at(asks, steps)


def planner_sql_function(spark, sf_dir) -> DataFrame:
    """The interactive planner called from SQL, as a table function over the master table."""
    from ..functions.sql import register_planner

    register_planner(spark, inputs.master(spark, sf_dir))
    return spark.sql(f"SELECT * FROM planner('{DEFAULT_MODE}', {DEFAULT_LEVEL}, '{DEFAULT_TIER}')")


def planner_images(spark, sf_dir) -> DataFrame:
    """The interactive report with its image columns ('' where there is none), every slot kept."""
    pick = lambda m, what: (m, {f"best_{what}_recipe": "rcp_name", f"best_{what}_appl": "appl_name", f"best_{what}": m, f"best_{what}_img": "rcp_img_url"})
    best = prefix_best(score_candidates(inputs.master(spark, sf_dir), DEFAULT_MODE, DEFAULT_LEVEL, DEFAULT_TIER),
                       time="rcp_time_min", slots=RETURN_SLOTS, metrics=(pick("rcp_xp", "xp"), pick("rcp_profit", "profit")), ord_cols=ORD)
    rows = with_all_slots(best, slots_frame(spark, RETURN_SLOTS))
    text = lambda c: display(F.nullif(F.col(c).cast("string"), F.lit("")))
    per_hour = lambda c: display(rate_js(c, "return_time").cast("string"))
    return rows.select(
        format_slot("return_time").alias("return_time"), text("best_xp_recipe").alias("best_xp_recipe"), text("best_xp_appl").alias("best_xp_appl"),
        text("best_xp").alias("best_xp"), per_hour("best_xp").alias("xp_per_hr"), F.coalesce("best_xp_img", F.lit("")).alias("best_xp_img"),
        text("best_profit_recipe").alias("best_profit_recipe"), text("best_profit_appl").alias("best_profit_appl"),
        text("best_profit").alias("best_profit"), per_hour("best_profit").alias("profit_per_hr"), F.coalesce("best_profit_img", F.lit("")).alias("best_profit_img"))
