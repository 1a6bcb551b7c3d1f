"""Several sources into one table; source tags; search URLs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MODES
from ..functions.text import col_of, pystrip, title_slug


def find_mode(url) -> Column:
    """'bakery' if the text mentions it, else 'restaurant', else 'other' (first match wins)."""
    u = col_of(url)
    return (F.when(u.contains("bakery"), "bakery")
             .when(u.contains("restaurant"), "restaurant").otherwise("other"))


def select_sources(mode: str, available: Sequence[str] = MODES) -> list[str]:
    """'both' → every source in order; a single known name → itself; else an error."""
    if mode == "both":
        return list(available)
    if mode in available:
        return [mode]
    raise ValueError(f"invalid mode {mode!r}; use one of {list(available)} or 'both'")


def source_index(mode, available: Sequence[str] = MODES) -> Column:
    """Position of a source in configuration order (unknown sources last)."""
    out = F.lit(len(available))
    for i, name in reversed(list(enumerate(available))):
        out = F.when(col_of(mode) == name, i).otherwise(out)
    return out


def union_sources(frames: Mapping[str, DataFrame], mode: str = "both",
                  ord_col: str = "rcp_ord") -> DataFrame:
    """Union the selected sources by column name, in configuration order.

    ``src_idx`` records the source's position so "table order" across sources
    is (src_idx, ord_col).
    """
    names = select_sources(mode, list(frames))
    out = None
    for i, n in enumerate(names):
        df = frames[n].withColumn("src_idx", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def search_urls(df: DataFrame, name_col: str, ord_col: str, template: str) -> DataFrame:
    """Distinct names from a comma-listed column, in first-seen order, as URLs.

    Null names are dropped; each name is split on ',', stripped, de-duplicated
    (keeping its first position), title-cased into a slug and put into the template.
    """
    names = (df.where(F.col(name_col).isNotNull())
               .select(ord_col, F.explode(F.split(F.col(name_col), ",")).alias("_n"))
               .select(ord_col, pystrip("_n").alias(name_col)))
    firsts = names.groupBy(name_col).agg(F.min(ord_col).alias("first_ord"))
    url = F.replace(F.lit(template), F.lit("{}"), title_slug(name_col))
    return firsts.select(name_col, "first_ord", url.alias("search_url"))
