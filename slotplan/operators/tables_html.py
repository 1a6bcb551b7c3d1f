"""HTML tables inside a text column → rows.

Everything happens inside one projection per document (array functions), so
there is no shuffle: each document is handled where it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE = r"(?is)<table(\s[^>]*)?>(.*?)</table\s*>"
TH = r"(?is)<th(?:\s[^>]*)?>(.*?)</th\s*>"
TR = r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr\s*>"
TD = r"(?is)<td(?:\s[^>]*)?>(.*?)</td\s*>"
TAG = r"<[^>]*>"


def _texts(fragment, pattern):
    return F.transform(F.regexp_extract_all(fragment, F.lit(pattern), 1),
                       lambda x: F.trim(F.regexp_replace(x, TAG, "")))


def _headers(table) -> Column:
    """Lower-cased header cells of the table's first row (later header rows do not count)."""
    first = F.coalesce(F.try_element_at(F.regexp_extract_all(table, F.lit(TR), 1), F.lit(1)), F.lit(""))
    return F.transform(_texts(first, TH), lambda h: F.lower(h))


def chosen_table(html: str, required: Sequence[str], css_class: str | None = "wikitable") -> Column:
    """The first table of the class whose first row holds every required header, or null (K9)."""
    req = F.array(*[F.lit(r) for r in required])
    attrs = F.regexp_extract_all(F.col(html), F.lit(TABLE), 1)
    inner = F.regexp_extract_all(F.col(html), F.lit(TABLE), 2)
    marked = F.lit(True) if css_class is None else None
    named = r"""(?is)\sclass\s*=\s*["']?(?:[^"'>]*\s)?""" + str(css_class) + r"""(?:[\s"'>]|$)"""
    ok = F.filter(F.arrays_zip(attrs.alias("a"), inner.alias("t")), lambda x: (
        marked if marked is not None else F.coalesce(x["a"].rlike(named), F.lit(False)))
        & (F.size(F.array_except(req, _headers(x["t"]))) == 0))
    return F.try_element_at(ok, F.lit(1))["t"]


def html_table_rows(df: DataFrame, key: str, html: str, required: Sequence[str],
                    css_class: str | None = "wikitable", min_cells: int | None = None) -> DataFrame:
    """Rows of the chosen table, with one column per required header.

    Rows are kept if they have as many cells as headers (K10), or with ``min_cells``
    at least that many (C28; further cells are dropped, missing ones are null). A
    document without the table gives no row; :func:`missing_tables` lists it.
    """
    t = df.select(key, chosen_table(html, required, css_class).alias("_t")).where(F.col("_t").isNotNull())
    t = t.select(key, _headers(F.col("_t")).alias("_h"),
                 F.posexplode(F.regexp_extract_all("_t", F.lit(TR), 1)).alias("_p", "_tr"))
    size = F.size("_c")
    fits = size == F.size("_h") if min_cells is None else size >= min_cells
    rows = t.where(F.col("_p") >= 1).withColumn("_c", _texts("_tr", TD)).where(fits)
    cell = lambda r: F.get("_c", (F.array_position("_h", r) - 1).cast("int"))
    return rows.select(key, F.col("_p").cast("bigint").alias("row_pos"), *[cell(r).alias(r) for r in required])


def missing_tables(df: DataFrame, key: str, html: str, required: Sequence[str],
                   css_class: str | None = "wikitable") -> DataFrame:
    """(key, reason) of the documents that hold no such table (K11): a quarantine list, no error."""
    from .quality import keep_where
    found = df.select(key, chosen_table(html, required, css_class).isNull().alias("_none"))
    return keep_where(found, F.col("_none")).select(key, F.lit("Target table not found").alias("reason"))
