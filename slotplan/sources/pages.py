"""Record extraction from a page table ``pages(page_id, url, html)``.

Pages arrive as rows; extraction is a projection with regular expressions over
the HTML column, so it runs where the data is, one task per file split, with no
Python parser in the path. Script, style and comment sections are removed
first (a script may contain "</p>"), and paragraphs are counted by their
openings because ``<p>`` is often left unclosed. Tags may carry attributes and be
written in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of, regex_field, url_host
from ..operators.quality import keep_where

NOISE = r"(?is)<script.*?</script\s*>|<style.*?</style\s*>|<!--.*?-->"
# a paragraph runs from its opening tag to the next one, "</p>", the end of a container or of the page
OPENING = r"(?i)<p(?:\s[^>]*)?>"
PARAGRAPH = (r"(?is)<p(?:\s[^>]*)?>(.*?)(?=<p[\s>]|</p\s*>|"
             r"</(?:article|aside|body|div|footer|header|html|li|main|section|td)\s*>|\z)")
TAG = r"<[^>]*>"
NAV = r"(?is)<nav(?:\s[^>]*)?>(.*?)</nav\s*>"
LINK = r"(?is)<a(\s[^>]*)?>(.*?)</a\s*>"
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
H1 = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
AD = r"""(?is)<div\s[^>]*class\s*=\s*["']?ad["'\s>][^>]*>?(.*?)</div\s*>"""
PATH_NUMBER = r"^[a-z]+://[^/?#]*/(?:[^/?#]*/)*?([0-9]+)"


# FIXED VALUES — named character references decoded in extracted text
# ("&amp;" last, so double-encoded text is decoded exactly once).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"))


def decode_entities(c) -> Column:
    """Decode the common named character references (native ``replace`` calls,
    skipped for text without an '&')."""
    src = col_of(c)
    out = src
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return F.when(F.instr(src, "&") > 0, out).otherwise(src)


def clean_html(c) -> Column:
    return F.regexp_replace(col_of(c), NOISE, "")


def tag_text(c) -> Column:
    """Text of an HTML fragment: tags removed, entities decoded, stripped; '' → null."""
    return F.nullif(F.trim(decode_entities(F.regexp_replace(col_of(c), TAG, ""))), F.lit(""))


def first_text(html, pattern: str) -> Column:
    """First match's stripped text or null (K2)."""
    return tag_text(F.regexp_extract(col_of(html), pattern, 1))


def paragraphs(html) -> Column:
    """Array of paragraph texts in page order (K1)."""
    raw = F.regexp_extract_all(clean_html(html), F.lit(PARAGRAPH), 1)
    return F.transform(raw, lambda b: F.coalesce(tag_text(b), F.lit("")))


def paragraph_count(html) -> Column:
    """Number of paragraphs (openings) — without building their texts."""
    return F.regexp_count(clean_html(html), F.lit(OPENING))


def nav_links(html) -> Column:
    """Array of struct<href, text> for the links inside <nav> (K3).

    The attribute may stand anywhere in the tag and may be quoted in any way; a link
    without it has a null href. Markup inside a link is no part of its text.
    """
    return links_inside(clean_html(html))


def links_inside(cleaned) -> Column:
    """:func:`nav_links` of HTML that :func:`clean_html` has been through."""
    nav = F.regexp_extract(col_of(cleaned), NAV, 1)
    attrs = F.regexp_extract_all(nav, F.lit(LINK), 1)
    hrefs = F.transform(attrs, _href)
    texts = F.transform(F.regexp_extract_all(nav, F.lit(LINK), 2),
                        lambda x: decode_entities(F.regexp_replace(x, TAG, "")))
    return F.arrays_zip(hrefs.alias("href"), texts.alias("text"))


def _href(attrs) -> Column:
    found = F.when(attrs.rlike(HREF), F.concat(*[F.regexp_extract(attrs, HREF, i) for i in (1, 2, 3)]))
    return decode_entities(found)


def page_number(url) -> Column:
    """First all-digit path segment of the URL (the page number), or null."""
    return regex_field(url, PATH_NUMBER).try_cast("bigint")


def page_blocks(pages: DataFrame) -> DataFrame:
    """One row per paragraph: page_id, pos (1-based), text (K1, H3)."""
    return (pages.select("page_id", F.posexplode(paragraphs("html")).alias("pos0", "text"))
                 .select("page_id", (F.col("pos0") + 1).cast("bigint").alias("pos"), "text"))


def page_details(pages: DataFrame) -> DataFrame:
    """Per page: title, heading, ad text, first and (if more than one) last nav link.

    Pages without a heading are skipped (K4); missing parts are null (K2, K7, G5).
    """
    # cleaned once, and the links read once from that
    clean = pages.select("page_id", "url", clean_html("html").alias("_html"))
    clean = clean.withColumn("_links", links_inside("_html"))
    links = F.col("_links")
    out = clean.select(
        "page_id", url_host("url").alias("host"),
        first_text("_html", TITLE).alias("title"),
        first_text("_html", H1).alias("heading"),
        first_text("_html", AD).alias("ad_text"),
        F.try_element_at(links, F.lit(1))["text"].alias("first_link"),
        F.when(F.size(links) > 1, F.try_element_at(links, F.lit(-1))["text"]).alias("last_link"),
    )
    # not a plain filter: it would re-run the page regexes in the pushed predicate
    return keep_where(out, F.col("heading").isNotNull())
