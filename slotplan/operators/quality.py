"""Record-level error isolation (K11) and row selection on derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_int_is_bad


def keep_where(df: DataFrame, cond) -> DataFrame:
    """Keep rows where ``cond`` is true, for conditions on expensive derived columns.

    A plain filter would be pushed below the projection that derives the
    columns and evaluate the derivation (e.g. regex parsing) a second time in
    the predicate. A generator that emits one row when the condition holds and
    none otherwise is not pushed down, so every derivation runs once per row.
    """
    keep = F.explode(F.filter(F.array(F.lit(True)), lambda _: F.coalesce(cond, F.lit(False))))
    return df.select("*", keep.alias("_keep")).drop("_keep")


def quarantine(df: DataFrame, key: str, ints: Sequence[str] = (),
               hours: Sequence[str] = ()) -> DataFrame:
    """One row per (key, field) whose non-null text does not parse.

    Integer fields use the digits-only rule; hour fields need a leading number.
    Built as a ``stack`` of the fields (one pass over the table).
    """
    fields = list(ints) + list(hours)
    stacked = df.select(key, F.expr(
        f"stack({len(fields)}, " + ", ".join(f"'{f}', cast(`{f}` as string)" for f in fields)
        + ") as (field, raw_value)"))
    v = F.col("raw_value")
    bad_int = clean_int_is_bad(v)
    bad_hours = v.isNotNull() & F.nullif(
        F.regexp_extract(v, r"([0-9]+[.]?[0-9]*)", 1), F.lit("")).isNull()
    is_hours = F.col("field").isin(*hours) if hours else F.lit(False)
    return stacked.where(F.when(is_hours, bad_hours).otherwise(bad_int))
