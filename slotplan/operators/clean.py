"""Recipe and appliance cleaning, master table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PRIORITY_COLUMNS, TIME_FIXES
from ..functions.text import (appl_obtainability, clean_column_name, clean_int, difficulty,
                              hours_text_to_minutes, nan_to_null, rcp_obtainability)
from .joins import sized_join


def fixed_time(fixes: Sequence[tuple[str, str]] = TIME_FIXES) -> Column:
    """``rcp_time_hr`` with the known corrections by recipe name.

    The fix table is a handful of constants, so it is a map literal inside the
    projection rather than a join: no shuffle and no broadcast.
    """
    if not fixes:
        return F.col("rcp_time_hr")
    m = F.create_map(*[F.lit(x) for kv in fixes for x in kv])
    return F.coalesce(F.try_element_at(m, F.col("rcp_name")), F.col("rcp_time_hr"))


def override_time(df: DataFrame, fixes: Sequence[tuple[str, str]] = TIME_FIXES) -> DataFrame:
    """Replace ``rcp_time_hr`` for the named recipes."""
    return df.withColumn("rcp_time_hr", fixed_time(fixes))


def clean_recipes(raw: DataFrame, fixes: Sequence[tuple[str, str]] = TIME_FIXES) -> DataFrame:
    """Numbers out of text, time fixes, minutes, profit, obtainability.

    One projection: every derived column is computed from the raw columns.
    """
    cols = {c: F.col(c) for c in raw.columns}
    for c in ("rcp_income", "rcp_xp", "rcp_servings"):
        if c in cols:
            cols[c] = clean_int(c)
    if "rcp_cost" in cols:
        cols["rcp_cost"] = F.abs(clean_int("rcp_cost"))
    if "rcp_time_hr" in cols:
        cols["rcp_time_hr"] = fixed_time(fixes)
    cols["rcp_time_min"] = hours_text_to_minutes(cols["rcp_time_hr"])
    cols["rcp_profit"] = cols["rcp_income"] - cols["rcp_cost"]
    cols["rcp_obtainability"] = rcp_obtainability("rcp_labels")
    return raw.select(*[v.alias(k) for k, v in cols.items()])


def with_appl_obtainability(appl: DataFrame) -> DataFrame:
    return appl.withColumn("appl_obtainability", appl_obtainability("appl_labels"))


def first_per_key(df: DataFrame, key: Sequence[str], ord_col: str) -> DataFrame:
    """Keep the first row (smallest ``ord_col``) of every key.

    ``row_number() = 1`` plans as a WindowGroupLimit, which also trims each task's
    rows before the shuffle.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*key).orderBy(F.col(ord_col).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def lookup_first(keys: DataFrame, table: DataFrame, key: str, ord_col: str,
                 max_keys: int | None = None) -> DataFrame:
    """First row of ``table`` (smallest ``ord_col``) for each key in ``keys``.

    The table is first cut down to the looked-up keys with a left-semi join, so
    only matching rows reach the window. ``keys`` is broadcast when the caller
    states its bound (``max_keys``, e.g. one name per report slot).
    """
    k = keys.select(key).distinct()
    if max_keys is not None:
        k = F.broadcast(k)
    return first_per_key(table.join(k, on=key, how="left_semi"), [key], ord_col)


def distinct_rows(df: DataFrame, ord_col: str) -> DataFrame:
    """Full-row distinct that keeps the first position of each row."""
    key = [c for c in df.columns if c != ord_col]
    return df.groupBy(*key).agg(F.min(ord_col).alias(ord_col)).select(*df.columns)


def build_master(recipes: DataFrame, appliances: DataFrame, *, fanout: bool = False,
                 appl_ord: str = "appl_ord") -> DataFrame:
    """Recipes left-joined to their game's appliances, then difficulty.

    The key is (game_mode, appl_name) where both sides have a game, else appl_name.
    Right-side columns that clash with recipe columns are dropped before the
    join (the left copy wins). Unless ``fanout`` is set, an appliance listed
    twice in a game keeps only its first row so recipes are not duplicated.
    """
    appl = with_appl_obtainability(appliances)
    key = ["appl_name"]
    if "game_mode" in appl.columns and "game_mode" in recipes.columns:
        key = ["game_mode", "appl_name"]
    if not fanout and appl_ord in appl.columns:
        appl = first_per_key(appl, key, appl_ord)
    keep = [c for c in appl.columns if c in key or c not in recipes.columns]
    merged = sized_join(recipes, appl.select(*keep), on=key, how="left")
    merged = merged.withColumn("rcp_difficulty",
                               difficulty("rcp_obtainability", "appl_obtainability"))
    return priority_order(merged)


def priority_order(df: DataFrame, priority: Iterable[str] = PRIORITY_COLUMNS) -> DataFrame:
    """Priority columns that exist first, then the rest in their order."""
    first = [c for c in priority if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename columns: strip, lower, space → '_', drop non-word characters."""
    new = [clean_column_name(c) for c in df.columns]
    dup = {n for n in new if new.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after cleaning: {sorted(dup)}")
    return df.toDF(*new)


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NaN and ±inf → null in every floating column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(nan_to_null(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
