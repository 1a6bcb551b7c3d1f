"""Formatting and rate functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LEVEL_MAX, LEVEL_MIN
from .text import col_of

__all__ = ["format_minutes", "format_short", "rate_2dp", "rate_0dp", "rate_js",
           "display", "level_clamp", "archive_name"]

_HOUR = 60
_DAY = 60 * 24
_MONTH = 60 * 24 * 30   # 30-day month
_YEAR = 60 * 24 * 365   # 365-day year


def format_minutes(c) -> Column:
    """Minutes → "Y years M months D days H hours N minutes".

    Zero parts are left out, units are always plural, all-zero gives "0 minutes",
    and null stays null.
    """
    m = col_of(c).cast("bigint")
    years = F.floor(m / _YEAR)
    r = F.pmod(m, F.lit(_YEAR))
    months = F.floor(r / _MONTH)
    r = F.pmod(r, F.lit(_MONTH))
    days = F.floor(r / _DAY)
    r = F.pmod(r, F.lit(_DAY))
    hours = F.floor(r / _HOUR)
    mins = F.pmod(r, F.lit(_HOUR))

    def part(v, unit):
        return F.when(v != 0, F.concat(v.cast("string"), F.lit(" " + unit)))

    text = F.concat_ws(" ", part(years, "years"), part(months, "months"), part(days, "days"),
                       part(hours, "hours"), part(mins, "minutes"))
    return F.when(m.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.nullif(text, F.lit("")), F.lit("0 minutes")))


def format_short(c) -> Column:
    """Minutes → "N min" under an hour, "H hr" on whole hours, else "H.h hr".

    Tenths round half up on the exact value, computed in integers.
    """
    m = col_of(c).cast("bigint")
    tenths = F.floor((m + 3) / 6)
    return (F.when(m < 60, F.concat(m.cast("string"), F.lit(" min")))
             .when(F.pmod(m, F.lit(60)) == 0, F.concat(F.floor(m / 60).cast("string"), F.lit(" hr")))
             .otherwise(F.concat(F.floor(tenths / 10).cast("string"), F.lit("."),
                                 F.pmod(tenths, F.lit(10)).cast("string"), F.lit(" hr"))))


def rate_2dp(x, minutes) -> Column:
    """Per-hour rate with 2 decimals, as a double."""
    return F.round(col_of(x).cast("double") * 60.0 / col_of(minutes), 2)


def rate_0dp(x, minutes) -> Column:
    """Per-hour rate rounded to a whole number, halves away from zero."""
    return F.round(col_of(x).cast("double") * 60.0 / col_of(minutes), 0).cast("bigint")


def rate_js(x, minutes) -> Column:
    """Per-hour rate rounded with halves toward +infinity."""
    return F.floor(col_of(x).cast("double") * 60.0 / col_of(minutes) + 0.5).cast("bigint")


def display(c, missing: str = "-") -> Column:
    """Text for display: missing → '-'; zero stays '0'."""
    return F.coalesce(col_of(c).cast("string"), F.lit(missing))


def level_clamp(c, delta: int = 0) -> Column:
    """Leading integer of the text (0 or none → 1), plus a step, clamped to 1..99."""
    lead = F.regexp_extract(col_of(c).cast("string"), r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")
    base = F.when(lead.isNull() | (lead == 0), F.lit(1)).otherwise(lead)
    return F.least(F.lit(LEVEL_MAX), F.greatest(F.lit(LEVEL_MIN), base + F.lit(delta))).cast("int")


def archive_name(name, ts) -> Column:
    """``<name>_YYYYmmdd_HHMMSS`` for an archived report."""
    return F.concat(col_of(name), F.lit("_"), F.date_format(col_of(ts), "yyyyMMdd_HHmmss"))
