"""Registered queries over the level table and the level-up fold (2.C C12/C30, 2.D J9,
2.E E11, 2.F F4, 2.G G3, 2.I I13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import START_SLOTS, TARGET_XP
from ..operators.clean import clean_columns
from ..operators.asof import asof_merge
from ..operators.levels import filled_levels, level_array, slots_at, typed_levels, with_cycles
from ..sinks.publish import dense_ids
from ..sources import fixtures
from ..sources.tables import read_table
from . import inputs, oracle as O
from .registry import Registry

register = Registry()


_XP_TEXT = ("case when x >= 1000 then cast(cast(floor(x / 1000) as bigint) as varchar) || ',' "
            "|| lpad(cast(x % 1000 as varchar), 3, '0') else cast(x as varchar) end")
_FX_LEVEL = f"""fx_level as (
select cast(k + 1 as varchar) as level,
       case when k % 7 = 3 then ' ' || {_XP_TEXT} || ' ' else {_XP_TEXT} end as xp,
       case when k % 5 = 1 then null when k % 11 = 4 then 'x'
            else cast(cast(2 + floor(k / 10) as bigint) as varchar) end as slots,
       cast(k % 3 as varchar) as expansion
from (select k, k * k * 90 + n as x from (
        select c_custkey % 99 as k, count(*) as n from customer group by c_custkey % 99)))"""
_LEVELS = f"""level_typed as (
select cast(level as int) as level, cast(trunc(cast(trim(replace(xp, ',', '')) as double)) as bigint) as xp,
       cast(trunc(try_cast(trim(slots) as double)) as int) as raw_slots
from fx_level),
levels as (
select level, xp, raw_slots,
       coalesce(last_value(raw_slots ignore nulls) over (order by xp, level
                rows between unbounded preceding and current row), {START_SLOTS}) as slots,
       row_number() over (order by xp, level) as i
from level_typed)"""
O.add_cte("fx_level", _FX_LEVEL)
O.add_cte("levels", _LEVELS, ("fx_level",))
_FOLD = f"""fold_in as (
select rcp_ord, rcp_xp as r, rcp_time_min from recipes where rcp_xp > 0),
fold as (
  with recursive st(rcp_ord, r, i, xp, c, s) as (
    select rcp_ord, r, 0, {START_SLOTS} * r, 1, {START_SLOTS} from fold_in
    union all
    select st.rcp_ord, st.r, st.i + 1, nx.xp2, st.c + nx.k,
           case when nx.xp2 >= l.xp then l.slots else st.s end
    from st join levels l on l.i = st.i + 1,
    lateral (select case when st.xp >= {TARGET_XP} or least(l.xp, {TARGET_XP}) - st.xp <= 0 then 0
                         else (least(l.xp, {TARGET_XP}) - st.xp + st.s * st.r - 1) // (st.s * st.r) end as k) kk,
    lateral (select kk.k as k, st.xp + kk.k * st.s * st.r as xp2) nx
  )
  select rcp_ord, c + case when {TARGET_XP} - xp <= 0 then 0
                           else ({TARGET_XP} - xp + s * r - 1) // (s * r) end as cycles
  from st qualify row_number() over (partition by rcp_ord order by i desc) = 1)"""
O.add_cte("fold", _FOLD, ("recipes", "levels"))


@register("q_clean_columns", O.with_ctes("fx_level") + """
select level, xp, slots, expansion from fx_level""")
def q_clean_columns(spark, sf_dir):
    """Scraped headers (" XP", "Slots ") → level, xp, slots, expansion."""
    return clean_columns(fixtures.level_raw(spark, sf_dir))


@register("q_level_arrays", O.with_ctes("levels") + """
select i as pos, level, xp, raw_slots from levels""")
def q_level_arrays(spark, sf_dir):
    """Xp without commas as a number, slots coerced, sorted by xp."""
    return _level_rows(spark, sf_dir)


def _level_rows(spark, sf_dir):
    t = typed_levels(fixtures.level_raw(spark, sf_dir)).select("xp", "level", F.col("slots").alias("raw_slots"))
    return dense_ids(t, ["xp", "level"], "pos").select("pos", "level", "xp", "raw_slots")


@register("q_ffill_slots", O.with_ctes("levels") + """
select level, xp, slots from levels""")
def q_ffill_slots(spark, sf_dir):
    """missing slots take the last value in xp order, 2 before any."""
    return filled_levels(fixtures.level_raw(spark, sf_dir)).select("level", "xp", "slots")


@register("q_asof_slots", O.with_ctes("recipes", "levels") + f"""
select r.rcp_ord, {START_SLOTS} * r.rcp_level * r.rcp_xp as first_xp,
       coalesce((select l.slots from levels l where l.xp <= {START_SLOTS} * r.rcp_level * r.rcp_xp
                 order by l.xp desc, l.level desc limit 1), {START_SLOTS}) as slots
from recipes r where r.rcp_xp is not null""")
def q_asof_slots(spark, sf_dir):
    """Slots in force after ``rcp_level`` cycles (last threshold <= xp, else 2)."""
    lv = level_array(fixtures.level_raw(spark, sf_dir)).scalar()
    r = (inputs.recipes_clean(spark, sf_dir).where(F.col("rcp_xp").isNotNull())
         .withColumn("_lv", lv))
    first = (F.lit(START_SLOTS) * F.col("rcp_level") * F.col("rcp_xp")).cast("bigint")
    return r.select("rcp_ord", first.alias("first_xp"), slots_at(first, "_lv").alias("slots"))


_THRESHOLDS = """thresholds as (
select c_custkey as ord, case when c_custkey % 2 = 0 then 'restaurant' else 'bakery' end as game_mode,
       case when c_custkey % 41 = 8 then null else cast(floor(abs(c_acctbal)) as bigint) * 30 end as xp,
       case when c_custkey % 13 = 5 then null else cast(2 + c_custkey % 9 as int) end as slots
from customer)"""


@register("q_asof_merge", O.with_ctes("recipes", extra=_THRESHOLDS) + f"""
select r.rcp_ord, r.game_mode, {START_SLOTS} * r.rcp_level * r.rcp_xp as first_xp, t.ord as threshold, t.slots
from recipes r left join lateral (
  select ord, slots from thresholds t where t.game_mode = r.game_mode and t.xp <= {START_SLOTS} * r.rcp_level * r.rcp_xp
  order by t.xp desc, t.ord desc limit 1) t on true""")
def q_asof_merge(spark, sf_dir):
    """J9 where both tables grow: the last threshold of the recipe's game at or below its xp."""
    c = read_table(spark, sf_dir, "customer")
    thresholds = c.selectExpr(
        "c_custkey as threshold", "case when c_custkey % 2 = 0 then 'restaurant' else 'bakery' end as game_mode",
        "case when c_custkey % 41 = 8 then null else cast(floor(abs(c_acctbal)) as bigint) * 30 end as xp",
        "case when c_custkey % 13 = 5 then null else cast(2 + c_custkey % 9 as int) end as slots")
    first = (F.lit(START_SLOTS) * F.col("rcp_level") * F.col("rcp_xp")).cast("bigint")
    rows = inputs.recipes_clean(spark, sf_dir).select("rcp_ord", "game_mode", first.alias("first_xp"))
    return asof_merge(rows, thresholds, ["game_mode"], "first_xp", ["threshold", "slots"], entry_at="xp", tie=["threshold"])


@register("q_cycles_to_target", O.with_ctes("recipes", "fold") + """
select r.rcp_ord, r.rcp_xp, r.rcp_time_min, f.cycles,
       f.cycles * r.rcp_time_min as min_to_lvl99
from recipes r left join fold f on f.rcp_ord = r.rcp_ord""")
def q_cycles_to_target(spark, sf_dir):
    """Cycles to reach the target xp under the step-wise slot table, and minutes."""
    r = with_cycles(inputs.recipes_clean(spark, sf_dir), "rcp_xp", fixtures.level_raw(spark, sf_dir))
    return r.select("rcp_ord", "rcp_xp", "rcp_time_min", "cycles",
                    (F.col("cycles") * F.col("rcp_time_min")).alias("min_to_lvl99"))


@register("q_level_report", O.with_ctes("recipes", "fold") + """
select r.rcp_ord, f.cycles * r.rcp_time_min as min_to_lvl99,
  case when f.cycles * r.rcp_time_min is null then null else
  coalesce(nullif(concat_ws(' ',
    case when m // 525600 <> 0 then (m // 525600)::varchar || ' years' end,
    case when (m % 525600) // 43200 <> 0 then ((m % 525600) // 43200)::varchar || ' months' end,
    case when (m % 525600 % 43200) // 1440 <> 0 then ((m % 525600 % 43200) // 1440)::varchar || ' days' end,
    case when (m % 1440) // 60 <> 0 then ((m % 1440) // 60)::varchar || ' hours' end,
    case when m % 60 <> 0 then (m % 60)::varchar || ' minutes' end), ''), '0 minutes') end as time_to_lvl99
from recipes r left join fold f on f.rcp_ord = r.rcp_ord,
lateral (select f.cycles * r.rcp_time_min as m) mm""")
def q_level_report(spark, sf_dir):
    """I13 on D2: minutes to the target level and the readable text, per recipe."""
    r = inputs.recipes_with_levels(spark, sf_dir)
    return r.select("rcp_ord", "min_to_lvl99", "time_to_lvl99")


QUERIES = register.queries
ORACLE = register.oracle
