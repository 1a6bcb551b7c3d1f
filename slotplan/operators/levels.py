"""Level table: typing, forward fill, as-of lookup, cycles-to-target fold
(C12, C30, F4, G3, J9, E11).

A level table is a step function "from this much xp on, you have this many
slots". It has one row per level, so it is bounded by design; it is turned into
one sorted array and attached to the large side as a scalar subquery
(computed once, shipped with the plan) instead of being joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import START_SLOTS, TARGET_XP
from ..functions.text import col_of
from .clean import clean_columns
from .windows import fill_forward


def typed_levels(raw: DataFrame) -> DataFrame:
    """Clean headers; xp must be a number (commas allowed, errors raise); bad slots → null.

    Both become integers by truncation toward zero (a fractional value is cut).
    """
    df = clean_columns(raw)
    xp = F.trim(F.replace(F.col("xp").cast("string"), F.lit(","), F.lit("")))
    slots = F.trim(F.col("slots").cast("string")).try_cast("double").cast("int")
    out = df.withColumn("xp", xp.cast("double").cast("bigint")).withColumn("slots", slots)
    if "level" in out.columns:
        out = out.withColumn("level", F.col("level").try_cast("int"))
    return out


#: levels up to which a level table may become one array
MAX_LEVELS = 10_000


def filled_levels(raw: DataFrame) -> DataFrame:
    """Rows (level, xp, raw_slots, slots), ``slots`` filled (F4): missing ones take the last known
    value in xp order, and 2 before any. Any number of rows: the fill runs over ranges."""
    t = typed_levels(raw)
    lvl = F.col("level") if "level" in t.columns else F.lit(None).cast("int")
    rows = t.select(lvl.alias("level"), "xp", F.col("slots").alias("raw_slots"))
    return fill_forward(rows, [], ["xp", "level"], "raw_slots", "slots", F.lit(START_SLOTS))


def level_array(raw: DataFrame) -> DataFrame:
    """One row, one column ``levels``: array<struct<xp, level, slots>> sorted by xp.

    For folds that need the whole table per row. A table of more than ``MAX_LEVELS`` rows is an
    error by name, never cut; ``filled_levels`` gives such a table as rows.
    """
    t = typed_levels(raw).limit(MAX_LEVELS + 1)
    lvl = F.col("level") if "level" in t.columns else F.lit(None).cast("int")
    upto = Window.orderBy("xp", "level").rowsBetween(Window.unboundedPreceding, Window.currentRow)      # bounded rows
    rows = t.select("xp", lvl.alias("level"), F.col("slots").alias("raw_slots"))
    rows = rows.withColumn("slots", F.coalesce(F.last("raw_slots", ignorenulls=True).over(upto), F.lit(START_SLOTS)))
    arr = F.array_sort(F.collect_list(F.struct("xp", "level", "slots")))
    too_many = F.raise_error(F.lit(f"TooManyLevels: more than {MAX_LEVELS} rows in the level table"))
    return rows.agg(F.when(F.count(F.lit(1)) > MAX_LEVELS, too_many.cast(
        "array<struct<xp:bigint,level:int,slots:int>>")).otherwise(arr).alias("levels"))


def slots_at(xp, levels) -> Column:
    """Slots in force at ``xp``: the last threshold <= xp, else the starting slots."""
    hit = F.try_element_at(F.filter(col_of(levels), lambda l: l["xp"] <= col_of(xp)), F.lit(-1))
    return F.when(col_of(xp).isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(hit["slots"], F.lit(START_SLOTS)))


def slot_changes(levels: Column) -> Column:
    """The levels of a sorted array that change the slots in force; those without xp all stay.

    Cycles to a target need no others: between two changes every cycle adds the same, so
    stopping at a level in between takes as many.
    """
    def step(acc, lv):
        same = lv["xp"].isNotNull() & (lv["slots"] == acc["st"])
        st = F.when(lv["xp"].isNull(), acc["st"]).otherwise(lv["slots"])
        return F.struct(st.alias("st"), F.when(same, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(lv))).alias("kept"))

    kind = "array<struct<xp:bigint,level:int,slots:int>>"
    return F.aggregate(levels, F.struct(F.lit(START_SLOTS).alias("st"), F.array().cast(kind).alias("kept")), step, lambda acc: acc["kept"])


def _ceil_div(a: Column, b: Column) -> Column:
    """ceil(a / b) for b > 0, 0 when a <= 0; null when b <= 0 (no progress is possible)."""
    return (F.when(b <= 0, F.lit(None).cast("bigint"))
             .when(a <= 0, F.lit(0).cast("bigint"))
             .otherwise(F.floor((a + b - 1) / b).cast("bigint")))


def cycles_to_target(rate, levels, target: int = TARGET_XP) -> Column:
    """Cycles needed to reach ``target`` xp when each cycle adds slots × rate.

    Same answer as running the cycles one by one (start with 2 slots, after each
    cycle switch to the slots of every threshold passed), but computed in
    O(levels) per row: between two thresholds the slot count is constant, so the
    number of cycles there is a ceiling division. Rate <= 0 or null → null.
    """
    r = col_of(rate).cast("bigint")
    tgt = F.lit(target).cast("bigint")
    init = F.struct((F.lit(START_SLOTS) * r).cast("bigint").alias("xp"),
                    F.lit(1).cast("bigint").alias("c"),
                    F.lit(START_SLOTS).cast("bigint").alias("st"))

    def step(acc, lv):
        goal = F.least(lv["xp"], tgt)
        k = _ceil_div(goal - acc["xp"], acc["st"] * r)
        k = F.when(acc["xp"] >= tgt, F.lit(0).cast("bigint")).otherwise(k)

        def after(n):
            xp = acc["xp"] + n * acc["st"] * r
            st = F.when(xp >= lv["xp"], lv["slots"].cast("bigint")).otherwise(acc["st"])
            return F.struct(xp.alias("xp"), (acc["c"] + n).alias("c"), st.alias("st"))

        return F.get(F.transform(F.array(k), after), F.lit(0))      # the division is worked out once

    def finish(acc):
        return acc["c"] + _ceil_div(tgt - acc["xp"], acc["st"] * r)

    folded = F.aggregate(col_of(levels), init, step, finish)
    if target <= 0:
        return F.when(r.isNull(), F.lit(None)).otherwise(F.lit(0).cast("bigint"))
    return F.when(r.isNull() | (r <= 0), F.lit(None).cast("bigint")).otherwise(folded)


def with_cycles(df: DataFrame, rate: str, level_raw: DataFrame, out: str = "cycles",
                target: int = TARGET_XP) -> DataFrame:
    """Add ``out`` = cycles to reach ``target`` for each row's rate.

    The fold runs in place, O(changes of slots) per row: one read of ``df``, no shuffle and no
    join. The level table rides along as a scalar subquery, cut to those changes once.
    """
    lv = level_array(level_raw).select(slot_changes(F.col("levels")).alias("levels")).scalar()
    return df.withColumn("_lv", lv).withColumn(out, cycles_to_target(rate, "_lv", target)).drop("_lv")
