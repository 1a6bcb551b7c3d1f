"""Typed records from catalogue pages (A6, A7, D1, D3): one row per block of a page.

A block is an element of the block class, read up to the next block's opening. Fields are
read inside it by tag and class, wherever the class stands among the attributes and in any
case; an element may hold others of its own kind (``elements``). A missing part gives null.
Everything is one pass per page: a projection for appliances, one Arrow function for recipes.

A block that cannot be read has an ``error`` (K11): a recipe block is left out alone, an
appliance block ends its page, whose rows before it stay. ``recipe_rows`` and
``appliance_rows`` give all blocks with their error; ``split_errors`` writes them once and
gives the good and the bad rows from that table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import regex_field
from ..operators.quality import keep_where
from ..operators.windows import written
from . import elements as E
from . import fragments as P
from .markup import Markup
from .pages import clean_html

# FIXED VALUES — classes of the catalogue's pages.
RECIPE_BLOCK = ("span", "appliance_single_recipe")
APPLIANCE_BLOCK = ("div", "appliance_parts_block")
STATS = (("rcpcost", "rcp_cost"), ("rcpserv", "rcp_servings"), ("rcptime", "rcp_time_hr"),
         ("rcpxp", "rcp_xp"), ("rcpincome", "rcp_income"))


def _block_rows(pages: DataFrame, tag: str, css_class: str) -> DataFrame:
    """One row per block: its content, up to its own closing or the next block."""
    parts = F.slice(F.split(clean_html("html"), E.opening(tag, css_class)), 2, 1 << 30)
    return (pages.select("page_id", "url", F.posexplode(parts).alias("_p", "_raw"))
            .withColumn("_b", E.up_to_close(F.col("_raw"), tag)).drop("_raw"))


def _labels(block: Column) -> Column:
    texts = F.transform(E.inside(block, "span", "sd_label"), E.text_of)
    return F.array_join(F.filter(texts, lambda x: x != ""), ", ")


def _image(element: Column) -> tuple[Column, Column]:
    """Source of the first image of an element, and whether that image lacks one."""
    tag = E.first_tag(element, "img")
    source = E.attribute(tag, "img", "src")
    return source, tag.isNotNull() & source.isNull()


def _error(*cases: tuple[Column, str]) -> Column:
    """The first reason that holds, null without one."""
    return F.coalesce(*[F.when(cond, F.lit(why)) for cond, why in cases], F.lit(None).cast("string"))


#: bytes of the pages that a task hands to Python at once
BATCH_BYTES = 4 << 20
#: recipe figures of one block, as text
_TEXTS = ("rcp_name", "appl_name", *(name for _, name in STATS), "rcp_labels")


def _level_of_texts(divisions: Iterable[str]) -> int | None:
    """Number after the label in the first division whose text has both."""
    for d in divisions:
        m = P.pattern(r"Lvl:\s*(\d+)").search(P.text_of(d, (0, len(d)))) if "Lvl:" in d else None
        if m:
            digits = m[1].lstrip("0") or "0"
            return int(digits) if len(digits) < 11 and int(digits) < 1 << 31 else None
    return None


def _image_of(s: str, element: P.Span | None) -> tuple[str | None, bool]:
    """Source of the first image of an element, and whether that image lacks one."""
    tag = P.first_tag(s, element, "img")
    source = P.attribute(s, tag, "img", "src")
    return source, tag is not None and source is None


def _recipe_blocks(s: str) -> Iterator[tuple]:
    """(pos, fields, image errors) of the blocks of a cleaned page that have figures or a bad image."""
    starts = list(P.opening(*RECIPE_BLOCK).finditer(s))
    for pos, (m, after) in enumerate(zip(starts, [*starts[1:], None]), 1):
        block = P.up_to_close(s, RECIPE_BLOCK[0], m.end(), after.start() if after else len(s))
        details = P.first_inside(s, block, "div", "hide-on-mobile")
        stats = P.first_inside(s, details, "div", "detstats")
        rcp_img, rcp_bad = _image_of(s, P.first_inside(s, block, "div", "rcp_view"))
        appl_img, appl_bad = _image_of(s, P.first_inside(s, block, "span", "appl_view"))
        # an image is read before the details are looked for, so its error counts either way
        if stats is None and not rcp_bad and not appl_bad:
            continue
        names = [P.text_of(s, x) for x in P.inside(s, details, "div", "applname")] if details else []
        labels = ", ".join(filter(None, (P.text_of(s, x) for x in P.inside(s, details, "span", "sd_label")))) if details else None
        yield (pos, P.first_text(s, block, "div", "invtitle2"), names[0] if names else None,
               *(P.first_text(s, stats, "div", css) for css, _ in STATS), labels,
               _level_of_texts(s[x:y] for x, y in P.inside(s, details, "div")) if details else None, names[-1] if len(names) > 1 else None,
               rcp_img, appl_img, P.attribute(s, block, "a", "href"), rcp_bad, appl_bad)


_KINDS = {"div": ("hide-on-mobile", "detstats", "rcp_view", "invtitle2", "applname", *(css for css, _ in STATS)),
          "span": (RECIPE_BLOCK[1], "appl_view", "sd_label")}


def _plain_recipes(html: list[str]) -> tuple[list[int], list[list], np.ndarray]:
    """(pages, columns, odd pages): the rows of :func:`_recipe_blocks` of all pages but the odd ones."""
    pages = [x.encode() for x in html]
    limits = np.concatenate([[0], np.cumsum([len(x) for x in pages], dtype=np.int64)])
    raw = b"".join(pages)
    m = Markup(raw, limits, _KINDS)
    at, lo = m.kinds["span"].places[RECIPE_BLOCK[1]]
    page = np.searchsorted(limits, at, side="right") - 1
    pos = np.arange(len(at)) - np.searchsorted(page, page) + 1
    hi = m.kinds["span"].closing(lo, np.minimum(np.append(at[1:], len(raw)), limits[page + 1]))
    mine = ~m.odd[page]
    page, pos, block = page[mine], pos[mine], (lo[mine], hi[mine])
    details = m.first(*block, "div", "hide-on-mobile")
    stats = m.first(*details, "div", "detstats")

    def images(found):
        some = [_image_of(raw[x:y].decode(), (0, y - x)) if x >= 0 else (None, False) for x, y in zip(*(v.tolist() for v in found))]
        return [x for x, _ in some], np.array([bad for _, bad in some], dtype=bool)

    rcp_img, rcp_bad = images(m.first(*block, "div", "rcp_view"))
    appl_img, appl_bad = images(m.first(*block, "span", "appl_view"))
    keep = np.flatnonzero((stats[0] >= 0) | rcp_bad | appl_bad)
    block, details, stats = ((x[keep], y[keep]) for x, y in (block, details, stats))

    def texts(found):
        spans = ((raw[x:y].decode() if x >= 0 else None) for x, y in zip(*(v.tolist() for v in found)))
        return [x if x is None else P.text_of(x, (0, len(x))) for x in spans]

    def lists(tag, css):
        offsets, *found = m.every(*details, tag, css)
        all_, offsets = texts(found), offsets.tolist()
        return [all_[x:y] for x, y in zip(offsets[:-1], offsets[1:])]

    def levels():
        offsets, starts, ends = (v.tolist() for v in m.every(*details, "div", None))
        for k, (x, y) in enumerate(zip(*(v.tolist() for v in details))):
            yield _level_of_texts(raw[u:v].decode() for u, v in zip(starts[offsets[k]:offsets[k + 1]], ends[offsets[k]:offsets[k + 1]])
                                  if raw.find(b"Lvl:", u, v) >= 0) if x >= 0 else None

    def links():
        for x, y in zip(*(v.tolist() for v in block)):
            s = raw[x:y].decode()
            yield P.attribute(s, (0, y - x), "a", "href")

    names, labels = lists("div", "applname"), lists("span", "sd_label")
    return page[keep].tolist(), [
        pos[keep].tolist(), texts(m.first(*block, "div", "invtitle2")), [x[0] if x else None for x in names],
        *(texts(m.first(*stats, "div", css)) for css, _ in STATS),
        [", ".join(filter(None, x)) if d >= 0 else None for x, d in zip(labels, details[0].tolist())],
        list(levels()), [x[-1] if len(x) > 1 else None for x in names],
        [rcp_img[k] for k in keep], [appl_img[k] for k in keep], list(links()), rcp_bad[keep].tolist(), appl_bad[keep].tolist()], m.odd


def recipe_rows(pages: DataFrame) -> DataFrame:
    """Recipe rows (D1) of pages (page_id, url, html), with page_id, pos and ``error``.

    Blocks without a details part or without its figures are skipped (K4); figures are read
    inside the figures' element only. The first appliance name is the appliance; the last of
    several is the release date (K7). Many fields of one block are read, so its page is read
    once, in Python, by the rules of ``elements`` (``markup``; odd pages: ``fragments``); all else is native.
    """
    conf, key = pages.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    fields = T.StructType([
        pages.schema["page_id"], pages.schema["url"], T.StructField("pos", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in _TEXTS), T.StructField("rcp_level", T.IntegerType()),
        *(T.StructField(c, T.StringType()) for c in ("rcp_release_date", "rcp_img_url", "appl_img_url", "rcp_url")),
        *(T.StructField(c, T.BooleanType()) for c in ("_rcp_bad", "_appl_bad"))])
    names = fields.fieldNames()
    types = [pa.int64(), *[pa.string()] * len(_TEXTS), pa.int32(), *[pa.string()] * 4, *[pa.bool_()] * 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            html = [P.clean(x) if x else "" for x in b.column(2).to_pylist()]
            at, columns, odd = _plain_recipes(html)
            for i in np.flatnonzero(odd).tolist():
                found = list(_recipe_blocks(html[i]))
                at += [i] * len(found)
                for column, values in zip(columns, zip(*found)):
                    column += values
            place = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(place), b.column(1).take(place),
                                              *[pa.array(c, t) for c, t in zip(columns, types)]], names)

    rows = pages.select("page_id", "url", "html").mapInArrow(run, fields)
    game = regex_field("url", r"/s8/(\w+)_recipes")
    return rows.select(
        "page_id", "pos", game.alias("game_mode"), *_TEXTS, "rcp_level", "rcp_release_date", "rcp_img_url", "appl_img_url", "rcp_url",
        _error((F.col("_rcp_bad"), "recipe image without source"), (F.col("_appl_bad"), "appliance image without source"),
               (game.isNull(), "no game in the address")).alias("error"))


def appliance_rows(pages: DataFrame) -> DataFrame:
    """Appliance rows (D3) of pages (page_id, url, html), with page_id, pos and ``error``.

    Blocks after a page's first bad one have the error 'after a bad block'.
    """
    b = _block_rows(pages, *APPLIANCE_BLOCK)
    block = F.col("_b")
    b = (b.withColumn("_i", E.first_inside(block, "span", "appliance_parts_parts"))
         .withColumn("_ds", E.inside(block, "span", "details"))
         .withColumn("_lvl", E.first_text(block, "div", "lvl")).withColumn("_n", E.first_text(block, "span", "bold")))
    image, image_bad = _image(F.col("_i"))
    details = E.text_of(F.try_element_at(F.col("_ds"), F.lit(-1)))
    game = regex_field("url", r"/s8/(\w+)_appl")
    name = E.first_text(block, "div", "appltitle")
    not_int = lambda c: F.col(c).isNotNull() & F.col(c).try_cast("int").isNull()
    out = b.select(
        "page_id", (F.col("_p") + 1).cast("bigint").alias("pos"), game.alias("game_mode"), name.alias("appl_name"),
        image.alias("appl_img_url"), F.col("_lvl").try_cast("int").alias("appl_unlock_level"),
        regex_field(details, r"c:\s*(\d+)").try_cast("int").alias("appl_cost"),
        regex_field(details, r"RD:\s*([\d-]+)").alias("appl_release_date"),
        F.col("_n").try_cast("int").alias("appl_recipes_count"), _labels(block).alias("appl_labels"),
        F.col("url").alias("appl_source_url"),
        _error((name.isNull(), "no name"), (F.col("_i").isNull(), "no image part"), (image_bad, "image without source"),
               (not_int("_lvl"), "level is no number"), (F.size("_ds") == 0, "no details"),
               (not_int("_n"), "number of recipes is no number"), (game.isNull(), "no game in the address")).alias("error"))
    # the blocks of one page, in order
    before = Window.partitionBy("page_id", "appl_source_url").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    late = F.coalesce(F.max(F.col("error").isNotNull()).over(before), F.lit(False))
    return out.withColumn("error", F.when(late, "after a bad block").otherwise(F.col("error")))


def split_errors(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, bad rows) of a table that is written once."""
    table = written(rows, "rows")
    return table.where(F.col(error).isNull()).drop(error), table.where(F.col(error).isNotNull())


def recipe_records(pages: DataFrame) -> DataFrame:
    """The good rows of :func:`recipe_rows`."""
    return recipe_rows(pages).where(F.col("error").isNull()).drop("error")


def appliance_records(pages: DataFrame) -> DataFrame:
    """The good rows of :func:`appliance_rows`: each page up to its first bad block."""
    return keep_where(appliance_rows(pages), F.col("error").isNull()).drop("error")
