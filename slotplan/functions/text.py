"""Text → typed value functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EMPTY_LABELS, MEDIUM_APPL_TOKENS

__all__ = [
    "col_of", "pystrip", "clean_int", "clean_int_is_bad", "hours_text_to_minutes",
    "is_empty_label", "rcp_obtainability", "appl_obtainability", "obtainability_score",
    "difficulty", "regex_field", "regex_int", "title_slug", "url_basename_png",
    "nan_to_null", "exclude_contains", "clean_column_name", "json_html_text",
    "split_trim", "empty_label_sql", "url_host", "url_path",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pystrip(c) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too, like Python's ``strip``)."""
    return F.regexp_replace(col_of(c), r"^\s+|\s+$", "")


def _digits(c) -> Column:
    return F.nullif(F.regexp_replace(col_of(c), "[^0-9-]", ""), F.lit(""))


def clean_int(c) -> Column:
    """Keep digits and '-' and read the rest as an integer; null stays null.

    ``"c: -1,250"`` → -1250, ``"59.5"`` → 595 (the point is dropped). Text that is
    left with no number (``"n/a"``, ``"-"``, ``"3-4"``) becomes null; see
    :func:`clean_int_is_bad` to count those.
    """
    return _digits(c).try_cast("bigint")


def clean_int_is_bad(c) -> Column:
    """True when non-null text does not yield an integer under :func:`clean_int`."""
    return col_of(c).isNotNull() & _digits(c).try_cast("bigint").isNull()


def hours_text_to_minutes(c) -> Column:
    """First number in the text, read as hours, times 60, rounded half-to-even."""
    num = F.nullif(F.regexp_extract(col_of(c), r"([0-9]+[.]?[0-9]*)", 1), F.lit(""))
    return F.bround(num.try_cast("double") * 60, 0).cast("bigint")


def empty_label_sql(c) -> Column:
    """SQL-style empty test: ``TRIM(LOWER(COALESCE(x,''))) IN ('', 'nan')``."""
    return F.trim(F.lower(F.coalesce(col_of(c), F.lit("")))).isin(*EMPTY_LABELS)


def is_empty_label(c) -> Column:
    """Python-style empty test: null, or stripped lower text in ('', 'nan')."""
    return col_of(c).isNull() | F.lower(pystrip(c)).isin(*EMPTY_LABELS)


def rcp_obtainability(labels) -> Column:
    """Recipe: no label → 'easy', otherwise 'hard'."""
    return F.when(is_empty_label(labels), "easy").otherwise("hard")


def split_trim(c, sep: str = ",") -> Column:
    """Split on a separator and strip every token."""
    return F.transform(F.split(col_of(c), re.escape(sep)), lambda t: pystrip(t))


def appl_obtainability(labels) -> Column:
    """Appliance: empty → 'easy'; exactly one token, 'build' or 'gem' → 'medium'; else 'hard'."""
    toks = split_trim(F.lower(pystrip(labels)))
    return (F.when(is_empty_label(labels), "easy")
             .when((F.size(toks) == 1) & F.try_element_at(toks, F.lit(1)).isin(*MEDIUM_APPL_TOKENS), "medium")
             .otherwise("hard"))


def obtainability_score(c, medium: bool) -> Column:
    """'easy' → 1, 'medium' → 2 (appliances only), anything else (incl. null) → 3."""
    norm = F.lower(F.coalesce(col_of(c).cast("string"), F.lit("nan")))
    e = F.when(norm == "easy", 1)
    if medium:
        e = e.when(norm == "medium", 2)
    return e.otherwise(3)


def difficulty(rcp_obt, appl_obt) -> Column:
    """Difficulty score 2..6; an unmatched appliance (null) scores 3."""
    return (obtainability_score(rcp_obt, False) + obtainability_score(appl_obt, True)).cast("int")


def regex_field(c, pattern: str, group: int = 1) -> Column:
    """First match of a group, or null when there is no match (Spark returns '')."""
    return F.nullif(F.regexp_extract(col_of(c), pattern, group), F.lit(""))


def regex_int(c, pattern: str, group: int = 1) -> Column:
    return regex_field(c, pattern, group).try_cast("int")


def title_slug(c) -> Column:
    """Python ``str.title()`` then spaces → '_'.

    Title-case upper-cases the first letter of every run of letters and lower-cases
    the rest (so ``bob's`` → ``Bob'S``), which ``initcap`` does not do.
    """
    runs = F.regexp_extract_all(col_of(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    titled = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                                  F.lower(F.substring(r, 2, 1 << 30))))
    return F.replace(F.array_join(titled, ""), F.lit(" "), F.lit("_"))


def url_path(c) -> Column:
    """Path part of a URL (no scheme, host, query or fragment)."""
    return F.regexp_extract(col_of(c), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_host(c) -> Column:
    return regex_field(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def url_basename_png(c) -> Column:
    """File name of a URL path, with '.png' added when it does not end with it."""
    base = F.try_element_at(F.split(url_path(c), "/"), F.lit(-1))
    return F.when(base.endswith(".png"), base).otherwise(F.concat(base, F.lit(".png")))


def nan_to_null(c) -> Column:
    """NaN and ±infinity → null (other values unchanged)."""
    x = col_of(c)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def exclude_contains(c, needle: str) -> Column:
    """Null-safe "does not contain, ignoring case" predicate."""
    return ~F.coalesce(F.lower(col_of(c)).contains(needle.lower()), F.lit(False))


_NON_WORD = re.compile(r"[^\w]")


def clean_column_name(name: str) -> str:
    """strip → lower → ' ' to '_' → drop non-word characters."""
    return _NON_WORD.sub("", name.strip().lower().replace(" ", "_"))


def json_html_text(c) -> Column:
    """``parse.text['*']`` of a JSON document (``*`` is a key here, not a wildcard)."""
    parsed = F.from_json(col_of(c), "struct<parse:struct<text:map<string,string>>>")
    return F.try_element_at(parsed.getField("parse").getField("text"), F.lit("*"))
