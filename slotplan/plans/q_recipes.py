"""Registered queries over the recipe / appliance / master tables (2.C, 2.D, 2.E, 2.I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import MODES, PRIORITY_COLUMNS, RETURN_SLOTS, TIERS
from ..functions import fmt
from ..functions import text as T
from ..operators.clean import build_master, lookup_first, nulls_for_nan, override_time
from ..operators.topk import fitting_slots, prefix_topk, slot_bucket, slots_frame
from ..sources import fixtures
from ..sources.tables import read_table
from . import inputs, oracle as O
from .registry import Registry
from .planner import (ORD, easy_predicate, filtered_report, medium_predicate, planner_filtered,
                      score_candidates, sql_candidates, tier_predicate)

register = Registry()


# ---------------------------------------------------------------- cleaning (2.C)

@register("q_clean_int", O.with_ctes("fx_recipe_raw") + """
select rcp_ord,
  try_cast(nullif(regexp_replace(rcp_cost, '[^0-9-]', '', 'g'), '') as bigint) as cost_int,
  try_cast(nullif(regexp_replace(rcp_income, '[^0-9-]', '', 'g'), '') as bigint) as income_int,
  try_cast(nullif(regexp_replace(rcp_xp, '[^0-9-]', '', 'g'), '') as bigint) as xp_int,
  try_cast(nullif(regexp_replace(rcp_time_hr, '[^0-9-]', '', 'g'), '') as bigint) as time_digits,
  rcp_time_hr is not null
    and try_cast(nullif(regexp_replace(rcp_time_hr, '[^0-9-]', '', 'g'), '') as bigint) is null as time_bad
from fx_recipe_raw""")
def q_clean_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits and '-' only, then integer ("0.25 hrs" → 25, "soon" → null, flagged)."""
    r = fixtures.recipe_raw(spark, sf_dir)
    return r.select("rcp_ord", T.clean_int("rcp_cost").alias("cost_int"),
                    T.clean_int("rcp_income").alias("income_int"),
                    T.clean_int("rcp_xp").alias("xp_int"),
                    T.clean_int("rcp_time_hr").alias("time_digits"),
                    T.clean_int_is_bad("rcp_time_hr").alias("time_bad"))


@register("q_clean_recipes", O.with_ctes("recipes") + """
select rcp_ord, rcp_cost, rcp_income, rcp_xp, rcp_profit, rcp_time_min, rcp_obtainability
from recipes""")
def q_clean_recipes(spark, sf_dir):
    """Absolute cost, profit = income − cost, minutes, obtainability."""
    return inputs.recipes_clean(spark, sf_dir).select(
        "rcp_ord", "rcp_cost", "rcp_income", "rcp_xp", "rcp_profit", "rcp_time_min",
        "rcp_obtainability")


@register("q_override_fix", O.with_ctes("fx_recipe_raw") + f"""
select rcp_ord, rcp_name, coalesce({O._FIX_CASE}, rcp_time_hr) as rcp_time_hr,
       ({O._FIX_CASE}) is not null as fixed
from fx_recipe_raw""")
def q_override_fix(spark, sf_dir):
    """Known time corrections applied by name."""
    return _override_flags(fixtures.recipe_raw(spark, sf_dir))


def _override_flags(r: DataFrame) -> DataFrame:
    from ..constants import TIME_FIXES
    names = [k for k, _ in TIME_FIXES]
    out = override_time(r)
    return out.select("rcp_ord", "rcp_name", "rcp_time_hr",
                      F.coalesce(F.col("rcp_name").isin(*names), F.lit(False)).alias("fixed"))


@register("q_time_to_minutes", O.with_ctes("recipes") + """
select rcp_ord, rcp_time_hr, rcp_time_min from recipes""")
def q_time_to_minutes(spark, sf_dir):
    """C4: first number in the text as hours → minutes, half-to-even."""
    return inputs.recipes_clean(spark, sf_dir).select("rcp_ord", "rcp_time_hr", "rcp_time_min")


@register("q_rcp_obtainability", O.with_ctes("recipes") + """
select rcp_ord, rcp_labels, rcp_obtainability from recipes""")
def q_rcp_obtainability(spark, sf_dir):
    """Recipe labels empty → easy, else hard."""
    return inputs.recipes_clean(spark, sf_dir).select("rcp_ord", "rcp_labels", "rcp_obtainability")


@register("q_appl_obtainability", O.with_ctes("appl") + """
select appl_ord, appl_labels, appl_obtainability,
       cast(len(string_split(lower(appl_labels), ',')) as int) as n_tokens
from appl""")
def q_appl_obtainability(spark, sf_dir):
    """Appliance labels → easy / medium / hard; token count of the label list."""
    a = fixtures.appliances(spark, sf_dir)
    n_tokens = F.when(F.col("appl_labels").isNotNull(),
                      F.size(T.split_trim(F.lower("appl_labels")))).cast("int")
    return a.select("appl_ord", "appl_labels",
                    T.appl_obtainability("appl_labels").alias("appl_obtainability"),
                    n_tokens.alias("n_tokens"))


@register("q_difficulty", O.with_ctes("master") + """
select rcp_ord, lower(coalesce(rcp_obtainability, 'nan')) as rcp_obt,
       lower(coalesce(appl_obtainability, 'nan')) as appl_obt, rcp_difficulty
from master""")
def q_difficulty(spark, sf_dir):
    """Normalised obtainability pair and the 2..6 score."""
    m = inputs.master(spark, sf_dir)
    return m.select("rcp_ord", F.lower(F.coalesce("rcp_obtainability", F.lit("nan"))).alias("rcp_obt"),
                    F.lower(F.coalesce("appl_obtainability", F.lit("nan"))).alias("appl_obt"),
                    "rcp_difficulty")


@register("q_tier_predicate", O.with_ctes("master") + f"""
select rcp_ord, rcp_difficulty,
  {O.TIER_SQL.format(t="'easy'")} as is_easy,
  {O.TIER_SQL.format(t="'medium'")} as is_medium,
  {O.TIER_SQL.format(t="'hard'")} as is_hard
from master""")
def q_tier_predicate(spark, sf_dir):
    """Tier membership by score (easy = 2, medium <= 3, hard <= 6)."""
    m = inputs.master(spark, sf_dir)
    return m.select("rcp_ord", "rcp_difficulty",
                    *[tier_predicate(t).alias(f"is_{t}") for t in TIERS])


@register("q_filter_easy", O.with_ctes("sql_cand") + f"""
select rcp_ord, rcp_name, rcp_labels, appl_labels from sql_cand where {O.EASY_SQL}""")
def q_filter_easy(spark, sf_dir):
    """Left join to appliances, both label sets empty."""
    c = sql_candidates(spark, sf_dir)
    return c.where(easy_predicate()).select("rcp_ord", "rcp_name", "rcp_labels", "appl_labels")


@register("q_filter_medium", O.with_ctes("sql_cand") + f"""
select rcp_ord, rcp_name, rcp_labels, appl_labels from sql_cand where {O.MEDIUM_SQL}""")
def q_filter_medium(spark, sf_dir):
    """Recipe unlabelled, appliance label mentions build/gem (any case) or is empty."""
    c = sql_candidates(spark, sf_dir)
    return c.where(medium_predicate()).select("rcp_ord", "rcp_name", "rcp_labels", "appl_labels")


@register("q_numeric_guard", O.with_ctes("fx_recipe_raw") + """
select rcp_ord, split_part(rcp_time_hr, '.', 1) as time_text,
       case when split_part(rcp_time_hr, '.', 1) ~ '^[0-9]+$'
            then try_cast(split_part(rcp_time_hr, '.', 1) as int) end as time_int
from fx_recipe_raw""")
def q_numeric_guard(spark, sf_dir):
    """Only all-digit text is cast; the cast itself cannot fail."""
    r = fixtures.recipe_raw(spark, sf_dir)
    t = F.split_part(F.col("rcp_time_hr"), F.lit("."), F.lit(1))
    return r.select("rcp_ord", t.alias("time_text"),
                    F.when(t.rlike("^[0-9]+$"), t.try_cast("int")).alias("time_int"))


@register("q_nan_inf_to_null", """
select c_custkey,
  case when c_acctbal < 0 or c_acctbal > 9000 then null else c_acctbal end as acctbal
from customer""")
def q_nan_inf_to_null(spark, sf_dir):
    """NaN / ±inf → null before loading (negative balances marked NaN, large ones inf)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    marked = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(float("nan")))
                      .when(F.col("c_acctbal") > 9000, F.lit(float("inf")))
                      .otherwise(F.col("c_acctbal")).alias("acctbal"))
    return nulls_for_nan(marked)


@register("q_left_join_no_dups", O.with_ctes("recipes", "appl", extra="""appl2 as (
  select * from appl
  union all
  select * replace (appl_ord + 1000000000 as appl_ord, 'Event' as appl_labels,
                    appl_img_url || '#2' as appl_img_url, 'hard' as appl_obtainability) from appl),
appl2_first as (select * from appl2
  qualify row_number() over (partition by game_mode, appl_name order by appl_ord) = 1)""") + """
select r.rcp_ord, r.appl_name, a.appl_ord, a.appl_labels, a.appl_obtainability,
  cast((case when r.rcp_obtainability = 'easy' then 1 else 3 end)
     + (case coalesce(a.appl_obtainability, 'nan') when 'easy' then 1 when 'medium' then 2 else 3 end)
     as int) as rcp_difficulty
from recipes r left join appl2_first a on r.appl_name = a.appl_name and r.game_mode = a.game_mode""")
def q_left_join_no_dups(spark, sf_dir):
    """C14/J1/trap 8: appliances found twice (second copy labelled differently) are kept once."""
    m = build_master(inputs.recipes_clean(spark, sf_dir), _appliances_twice(spark, sf_dir))
    return m.select("rcp_ord", "appl_name", "appl_ord", "appl_labels", "appl_obtainability",
                    "rcp_difficulty")


@register("q_left_join_fanout", O.with_ctes("recipes", "appl", extra="""appl2 as (
  select * from appl
  union all
  select * replace (appl_ord + 1000000000 as appl_ord, 'Event' as appl_labels,
                    appl_img_url || '#2' as appl_img_url, 'hard' as appl_obtainability) from appl)""") + """
select r.rcp_ord, r.appl_name, a.appl_ord, a.appl_labels, a.appl_obtainability
from recipes r left join appl2 a on r.appl_name = a.appl_name and r.game_mode = a.game_mode""")
def q_left_join_fanout(spark, sf_dir):
    """J1 parity: without de-duplication an appliance found twice duplicates its recipes."""
    m = build_master(inputs.recipes_clean(spark, sf_dir), _appliances_twice(spark, sf_dir), fanout=True)
    return m.select("rcp_ord", "appl_name", "appl_ord", "appl_labels", "appl_obtainability")


@register("q_left_join_two_games", O.with_ctes("master") + """
select rcp_ord, game_mode, appl_name, appl_labels, appl_source_url, appl_img_url, rcp_difficulty from master""")
def q_left_join_two_games(spark, sf_dir):
    """A name that both games know takes its own game's labels and difficulty; the clashing
    image column is the recipe's."""
    return inputs.master(spark, sf_dir).select("rcp_ord", "game_mode", "appl_name", "appl_labels",
                                               "appl_source_url", "appl_img_url", "rcp_difficulty")


def _appliances_twice(spark, sf_dir):
    """Every appliance twice, the second copy labelled differently, as if found from a second page."""
    a = fixtures.appliances(spark, sf_dir)
    dup = a.withColumns({"appl_ord": F.col("appl_ord") + 1_000_000_000, "appl_labels": F.lit("Event"),
                         "appl_img_url": F.concat("appl_img_url", F.lit("#2"))})
    return a.unionByName(dup)


@register("q_priority_columns", O.with_ctes("master") + """
select game_mode, rcp_name, appl_name, rcp_level, rcp_time_min, rcp_xp, rcp_profit, rcp_difficulty,
       rcp_ord, rcp_cost, rcp_income, rcp_time_hr, rcp_labels, rcp_obtainability, rcp_servings,
       rcp_release_date, rcp_img_url, rcp_url, appl_img_url, appl_ord, appl_labels, appl_obtainability,
       appl_unlock_level, appl_cost, appl_release_date, appl_recipes_count, appl_source_url
from master""")
def q_priority_columns(spark, sf_dir):
    """Priority columns that exist first (level columns absent here), then the rest."""
    return inputs.master(spark, sf_dir)


@register("q_master_levels", O.with_ctes("master", "fold") + """
select m.game_mode, m.rcp_name, m.appl_name, m.rcp_level, m.rcp_time_min, m.rcp_xp, m.rcp_profit, m.rcp_difficulty,
       f.cycles * m.rcp_time_min as min_to_lvl99, m.rcp_ord
from master m left join fold f on f.rcp_ord = m.rcp_ord""")
def q_master_levels(spark, sf_dir):
    """C10 with the level columns: the master table begins with all ten priority columns."""
    m = inputs.master(spark, sf_dir, with_levels=True)
    assert tuple(m.columns[:len(PRIORITY_COLUMNS)]) == PRIORITY_COLUMNS
    return m.select(*[c for c in PRIORITY_COLUMNS if c != "time_to_lvl99"], "rcp_ord")


# ---------------------------------------------------------------- joins / aggregates

@register("q_theta_slots", O.with_ctes("sql_cand") + f"""
, time_slots as (select unnest({O.slots_list()}) as return_time)
select t.return_time, count(*) as n_candidates, cast(sum(c.rcp_xp) as bigint) as xp_sum, max(c.rcp_time_min) as max_time
from time_slots t join sql_cand c on c.rcp_time_min <= t.return_time
group by t.return_time""")
def q_theta_slots(spark, sf_dir):
    """For each slot, the rows with time <= slot (count, xp sum, longest time).

    Computed per bucket, then the bucket sums are fanned out to the larger slots.
    """
    c = sql_candidates(spark, sf_dir, require_time=False).withColumn(
        "_b", slot_bucket("rcp_time_min", RETURN_SLOTS))
    per = (c.groupBy("_b")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("rcp_xp").alias("s"), F.max("rcp_time_min").alias("m")))
    fan = per.withColumn("return_time", F.explode(fitting_slots("_b", RETURN_SLOTS)))
    return fan.groupBy("return_time").agg(F.sum("n").alias("n_candidates"),
                                          F.sum("s").alias("xp_sum"), F.max("m").alias("max_time"))


@register("q_time_slots", O.with_ctes("recipes") + f"""
, time_slots as (select unnest({O.slots_list()}) as return_time),
b as (select min(t.return_time) as return_time from recipes r join time_slots t
      on r.rcp_time_min <= t.return_time group by r.rcp_ord)
select t.return_time, count(b.return_time) as n_in_bucket
from time_slots t left join b on b.return_time = t.return_time group by t.return_time""")
def q_time_slots(spark, sf_dir):
    """The slot list, with how many recipes have each as their tightest slot."""
    r = inputs.recipes_clean(spark, sf_dir)
    counts = (r.select(slot_bucket("rcp_time_min", RETURN_SLOTS).alias("return_time"))
               .groupBy("return_time")
               .agg(F.count(F.lit(1)).alias("n_in_bucket")))
    return (slots_frame(spark, RETURN_SLOTS).join(counts, "return_time", "left")
            .select("return_time", F.coalesce("n_in_bucket", F.lit(0)).cast("bigint").alias("n_in_bucket")))


@register("q_argmax_first", O.with_ctes("recipes") + """
select game_mode, rcp_level, rcp_name, rcp_xp, rcp_ord from (
  select *, row_number() over (partition by game_mode, rcp_level
                               order by rcp_xp desc nulls last, rcp_ord) rn from recipes) where rn = 1""")
def q_argmax_first(spark, sf_dir):
    """E5: best xp per (game, level), first in table order on ties (max over a struct key)."""
    r = inputs.recipes_clean(spark, sf_dir)
    best = r.groupBy("game_mode", "rcp_level").agg(F.max(F.struct(
        F.col("rcp_xp").isNotNull().alias("nn"), F.col("rcp_xp").alias("x"),
        (-F.col("rcp_ord")).alias("o"), F.col("rcp_name").alias("n"))).alias("b"))
    return best.select("game_mode", "rcp_level", F.col("b.n").alias("rcp_name"),
                       F.col("b.x").alias("rcp_xp"), (-F.col("b.o")).alias("rcp_ord"))


@register("q_top1", O.with_ctes("recipes") + """
select appl_name, rcp_name, rcp_profit, rcp_ord from (
  select *, row_number() over (partition by appl_name order by rcp_profit desc nulls last, rcp_ord) rn
  from recipes) where rn = 1""")
def q_top1(spark, sf_dir):
    """Top-1 per group with ``row_number() = 1`` (plans as WindowGroupLimit)."""
    r = inputs.recipes_clean(spark, sf_dir)
    w = Window.partitionBy("appl_name").orderBy(F.col("rcp_profit").desc_nulls_last(), "rcp_ord")
    return (r.withColumn("rn", F.row_number().over(w)).where("rn = 1")
             .select("appl_name", "rcp_name", "rcp_profit", "rcp_ord"))


#: ranks kept per slot and metric; the report uses rank 1 only
REPORT_RANKS = 1


def _rank_sql(metric: str) -> str:
    return O.with_ctes("sql_cand") + f"""
, time_slots as (select unnest({O.slots_list()}) as return_time),
r as (select t.return_time, c.rcp_name, c.{metric},
        row_number() over (partition by t.return_time order by c.{metric} desc nulls last, c.rcp_ord) as rnk
      from time_slots t join sql_cand c on c.rcp_time_min <= t.return_time)
select return_time, rnk as rank, rcp_name, {metric} from r where rnk <= {REPORT_RANKS}"""


@register("q_rank_xp", _rank_sql("rcp_xp"))
def q_rank_xp(spark, sf_dir):
    """xp rank per slot (the ranks the report uses)."""
    return prefix_topk(sql_candidates(spark, sf_dir, require_time=False), time="rcp_time_min",
                       slots=RETURN_SLOTS, metric="rcp_xp", k=REPORT_RANKS, payload={"rcp_name": "rcp_name", "rcp_xp": "rcp_xp"},
                       ord_cols=ORD)


@register("q_rank_profit", _rank_sql("rcp_profit"))
def q_rank_profit(spark, sf_dir):
    """profit rank per slot (the ranks the report uses)."""
    return prefix_topk(sql_candidates(spark, sf_dir, require_time=False), time="rcp_time_min",
                       slots=RETURN_SLOTS, metric="rcp_profit", k=REPORT_RANKS,
                       payload={"rcp_name": "rcp_name", "rcp_profit": "rcp_profit"}, ord_cols=ORD)


@register("q_filtered_max", O.with_ctes("master") + f"""
, time_slots as (select unnest({O.slots_list()}) as return_time)
select t.return_time, max(m.rcp_xp) as max_xp, max(m.rcp_profit) as max_profit
from time_slots t join master m on m.rcp_time_min <= t.return_time
where m.rcp_level <= 50 and m.game_mode = 'bakery' and m.rcp_difficulty <= 3
group by t.return_time""")
def q_filtered_max(spark, sf_dir):
    """``MAX(FILTER(col, preds))`` per slot for (bakery, level 50, medium)."""
    c = score_candidates(inputs.master(spark, sf_dir), "bakery", 50, "medium")
    c = c.withColumn("_b", slot_bucket("rcp_time_min", RETURN_SLOTS))
    per = c.groupBy("_b").agg(F.max("rcp_xp").alias("x"), F.max("rcp_profit").alias("p"))
    fan = per.withColumn("return_time", F.explode(fitting_slots("_b", RETURN_SLOTS)))
    return fan.groupBy("return_time").agg(F.max("x").alias("max_xp"), F.max("p").alias("max_profit"))


@register("q_vlookup_first", O.with_ctes("master") + f"""
, first_by_name as (select * from master qualify row_number() over (
      partition by rcp_name order by case game_mode when 'restaurant' then 0 else 1 end, rcp_ord) = 1),
cand as (select * from master where game_mode = 'bakery' and rcp_level <= 99
         and rcp_time_min is not null and rcp_difficulty <= 6),
time_slots as (select unnest({O.slots_list()}) as return_time),
bx as (select t.return_time, c.rcp_name, c.rcp_xp, row_number() over (
         partition by t.return_time order by c.rcp_xp desc nulls last, c.rcp_ord) rn
       from time_slots t join cand c on c.rcp_time_min <= t.return_time)
select bx.return_time, bx.rcp_name as best_xp_recipe, bx.rcp_xp as best_xp,
       f.game_mode as lookup_game, f.appl_name as lookup_appl, f.rcp_xp as lookup_xp,
       f.rcp_profit as lookup_profit
from bx left join first_by_name f on f.rcp_name = bx.rcp_name where bx.rn = 1""")
def q_vlookup_first(spark, sf_dir):
    """J4/trap 12: the bakery report's names looked up by first match across both games."""
    m = inputs.master(spark, sf_dir)
    src = F.array_position(F.array(*[F.lit(x) for x in MODES]), F.col("game_mode"))
    report = filtered_report(spark, m, mode="bakery", keep_empty=False)
    names = report.select(F.col("best_xp_recipe").alias("rcp_name"))  # one per slot at most
    first = lookup_first(names, m.withColumn("_src_ord", F.struct(src, F.col("rcp_ord"))),
                         "rcp_name", "_src_ord", max_keys=len(RETURN_SLOTS))
    look = first.select(F.col("rcp_name").alias("best_xp_recipe"),
                        F.col("game_mode").alias("lookup_game"), F.col("appl_name").alias("lookup_appl"),
                        F.col("rcp_xp").alias("lookup_xp"), F.col("rcp_profit").alias("lookup_profit"))
    return (report.select("return_time", "best_xp_recipe", "best_xp")
                  .join(look, "best_xp_recipe", "left"))


# ---------------------------------------------------------------- scalar functions (2.I)

@register("q_rate_2dp", O.with_ctes("recipes") + """
select rcp_ord, round(cast(rcp_xp as double) * 60 / rcp_time_min, 2) as xp_per_hr,
       round(cast(rcp_profit as double) * 60 / rcp_time_min, 2) as profit_per_hr
from recipes where rcp_time_min > 0""")
def q_rate_2dp(spark, sf_dir):
    """Per-hour rates to 2 decimals over each recipe's own time."""
    r = inputs.recipes_clean(spark, sf_dir).where(F.col("rcp_time_min") > 0)
    return r.select("rcp_ord", fmt.rate_2dp("rcp_xp", "rcp_time_min").alias("xp_per_hr"),
                    fmt.rate_2dp("rcp_profit", "rcp_time_min").alias("profit_per_hr"))


@register("q_rate_0dp", O.with_ctes("recipes") + """
select rcp_ord,
  cast(round(cast(rcp_xp - 500 as double) * 60 / rcp_time_min) as bigint) as xp_rate_sheet,
  cast(floor(cast(rcp_xp - 500 as double) * 60 / rcp_time_min + 0.5) as bigint) as xp_rate_page
from recipes where rcp_time_min > 0""")
def q_rate_0dp(spark, sf_dir):
    """Whole-number rates, halves away from zero (sheet) vs toward +inf (page);
    xp is offset by 500 so negative halves occur."""
    r = inputs.recipes_clean(spark, sf_dir).where(F.col("rcp_time_min") > 0)
    x = F.col("rcp_xp") - 500
    return r.select("rcp_ord", fmt.rate_0dp(x, "rcp_time_min").alias("xp_rate_sheet"),
                    fmt.rate_js(x, "rcp_time_min").alias("xp_rate_page"))


@register("q_format_minutes", """
select o_orderkey, cast(floor(o_totalprice * 10) as bigint) as minutes,
  coalesce(nullif(concat_ws(' ',
    case when m // 525600 <> 0 then (m // 525600)::varchar || ' years' end,
    case when (m % 525600) // 43200 <> 0 then ((m % 525600) // 43200)::varchar || ' months' end,
    case when (m % 525600 % 43200) // 1440 <> 0 then ((m % 525600 % 43200) // 1440)::varchar || ' days' end,
    case when (m % 1440) // 60 <> 0 then ((m % 1440) // 60)::varchar || ' hours' end,
    case when m % 60 <> 0 then (m % 60)::varchar || ' minutes' end), ''), '0 minutes') as readable
from (select *, cast(floor(o_totalprice * 10) as bigint) as m from orders)""")
def q_format_minutes(spark, sf_dir):
    """Minutes → "Y years M months D days H hours N minutes"."""
    o = read_table(spark, sf_dir, "orders")
    m = F.floor(F.col("o_totalprice") * 10).cast("bigint")
    return o.select("o_orderkey", m.alias("minutes"), fmt.format_minutes(m).alias("readable"))


@register("q_format_short", O.with_ctes("recipes") + """
select rcp_ord, rcp_time_min,
  case when rcp_time_min < 60 then rcp_time_min::varchar || ' min'
       when rcp_time_min % 60 = 0 then (rcp_time_min // 60)::varchar || ' hr'
       else ((rcp_time_min + 3) // 60)::varchar || '.' || (((rcp_time_min + 3) // 6) % 10)::varchar || ' hr'
  end as short_time
from recipes where rcp_time_min is not null and rcp_time_min >= 0""")
def q_format_short(spark, sf_dir):
    """Minutes → "N min" / "H hr" / "H.h hr"."""
    r = inputs.recipes_clean(spark, sf_dir).where(F.col("rcp_time_min") >= 0)
    return r.select("rcp_ord", "rcp_time_min", fmt.format_short("rcp_time_min").alias("short_time"))


@register("q_level_clamp", """
select page_id, lvl_text,
  cast(least(99, greatest(1, case when coalesce(v, 0) = 0 then 1 else v end)) as int) as level,
  cast(least(99, greatest(1, case when coalesce(v, 0) = 0 then 1 else v end + 1)) as int) as level_up,
  cast(least(99, greatest(1, case when coalesce(v, 0) = 0 then 1 else v end - 1)) as int) as level_down
from (select page_id, lvl_text,
        try_cast(nullif(regexp_extract(lvl_text, '^\\s*([+-]?[0-9]+)', 1), '') as bigint) as v
      from (select page_id, regexp_extract(url, '/([^/?#]*)$', 1) as lvl_text from pages))""")
def q_level_clamp(spark, sf_dir):
    """Leading integer of the text (none or 0 → 1), ±1 step, clamped to 1..99."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    t = F.regexp_extract("url", r"/([^/?#]*)$", 1)
    return p.select("page_id", t.alias("lvl_text"), fmt.level_clamp(t).alias("level"),
                    fmt.level_clamp(t, 1).alias("level_up"), fmt.level_clamp(t, -1).alias("level_down"))


@register("q_report_display", O.with_ctes("master") + f"""
, cand as (select * from master where game_mode = 'bakery' and rcp_level <= 5
           and rcp_time_min is not null and rcp_difficulty = 2),
time_slots as (select unnest({O.slots_list()}) as return_time),
bx as (select t.return_time, c.rcp_name, c.rcp_xp, row_number() over (
         partition by t.return_time order by c.rcp_xp desc nulls last, c.rcp_ord) rn
       from time_slots t join cand c on c.rcp_time_min <= t.return_time)
select case when t.return_time < 60 then t.return_time::varchar || ' min'
            when t.return_time % 60 = 0 then (t.return_time // 60)::varchar || ' hr'
            else ((t.return_time + 3) // 60)::varchar || '.' || (((t.return_time + 3) // 6) % 10)::varchar || ' hr'
       end as slot_text,
       coalesce(bx.rcp_name, '-') as xp_recipe,
       coalesce(cast(bx.rcp_xp as varchar), '-') as xp,
       coalesce(cast(cast(floor(cast(bx.rcp_xp as double) * 60 / t.return_time + 0.5) as bigint) as varchar), '-') as xp_hr
from time_slots t left join bx on bx.return_time = t.return_time and bx.rn = 1""")
def q_report_display(spark, sf_dir):
    """Every slot shown; missing values as '-', zero stays '0' (bakery, level 5, easy)."""
    rep = planner_filtered(spark, sf_dir, mode="bakery", level=5, tier="easy")
    return rep.select(fmt.format_short("return_time").alias("slot_text"),
                      fmt.display("best_xp_recipe").alias("xp_recipe"),
                      fmt.display("best_xp").alias("xp"), fmt.display("xp_per_hr").alias("xp_hr"))


@register("q_exclude_contains", """
select page_id, url from pages
where not coalesce(lower(url) like '%spam-farm%', false)""")
def q_exclude_contains(spark, sf_dir):
    """Drop rows whose text contains a marker, ignoring case; nulls kept."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.where(T.exclude_contains("url", "SPAM-farm"))


@register("q_slug", r"""
select p_partkey, p_name,
  replace(array_to_string(list_transform(
      regexp_extract_all(p_name || ' ' || p_type, '(\pL+|[^\pL]+)', 1),
      lambda r: upper(r[1]) || lower(r[2:])), ''), ' ', '_') as slug
from part""")
def q_slug(spark, sf_dir):
    """Python-style title case (every letter run capitalised), spaces → '_'."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.select("p_partkey", "p_name",
                    T.title_slug(F.concat_ws(" ", "p_name", "p_type")).alias("slug"))


@register("q_archive_name", """
select event_id, 'planner_report_' || strftime(ts, '%Y%m%d_%H%M%S') as archive_name from events""")
def q_archive_name(spark, sf_dir):
    """Archive name ``<name>_YYYYmmdd_HHMMSS`` for each publish time."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return e.select("event_id", fmt.archive_name(F.lit("planner_report"), "ts").alias("archive_name"))


QUERIES = register.queries
ORACLE = register.oracle
