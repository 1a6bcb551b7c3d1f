"""Elements of HTML fragments as native expressions (K1, K2): tags, depth, containment.

A fragment is cut before every opening and closing of one kind of tag; a fold over these pieces
keeps the running depth. The element that an opening starts ends where the depth falls below
that of the opening, so elements may hold others of their own kind. An element that is never
closed ends with its fragment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pages import TAG, decode_entities


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def opening(tag: str, css_class: str | None = None) -> str:
    """Pattern of an opening tag, of any or of one class (quoted or not, among others)."""
    if css_class is None:
        return rf"(?is)<{tag}(?:\s[^>]*)?>"
    return rf"""(?is)<{tag}\s(?:[^>]*\s)?class\s*=\s*(?:"(?:[^">]*\s)?{css_class}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{css_class}(?:\s[^'>]*)?'|{css_class}(?=[\s>]))[^>]*>"""


def _kept_pieces(pieces: Column, tag: str) -> Column:
    """How many pieces lie before the closing that takes the depth below zero."""
    state = lambda depth, n, done: F.struct(depth.alias("depth"), n.alias("n"), done.alias("done"))

    def step(acc, piece):
        # a piece starts with the tag it was cut at
        depth = acc["depth"] + (F.when(F.lower(F.substring(piece, 1, len(tag) + 2)) == f"</{tag}", -1)
                                .when(F.lower(F.substring(piece, 1, len(tag) + 1)) == f"<{tag}", 1).otherwise(0))
        done = acc["done"] | (depth < 0)
        return state(depth, acc["n"] + F.when(done, 0).otherwise(1), done)

    return F.aggregate(pieces, state(F.lit(0), F.lit(0), F.lit(False)), step, lambda acc: acc["n"])


def _simple(rest: Column, tag: str, otherwise) -> Column:
    """What stands before the first closing if that holds no opening of its kind, else ``otherwise``."""
    return bound(F.split(rest, rf"(?i)</{tag}\s*>", 2), lambda two: F.when(
        (F.size(two) == 2) & ~two[0].rlike(rf"(?i)<{tag}[\s>/]"), two[0]).otherwise(otherwise))


def up_to_close(rest: Column, tag: str) -> Column:
    """What stands before the closing that belongs to an opening just before ``rest``."""
    def balanced(r: Column) -> Column:
        # the space keeps the first piece, which may start with a longer tag's name, from counting
        pieces = F.split(F.concat(F.lit(" "), r), rf"(?i)(?=</?{tag}[\s>/])")
        return bound(pieces, lambda p: F.substring(F.array_join(F.slice(p, 1, _kept_pieces(p, tag)), ""), 2, 0x7FFFFFFF))

    return bound(rest, lambda r: _simple(r, tag, balanced(r)))


def inside(fragment: Column, tag: str, css_class: str | None = None) -> Column:
    """Array of the contents of all elements of a kind, in order of their openings (nested ones too)."""
    own = opening(tag, css_class)
    starts = F.split(fragment, "(?is)(?=" + own.removeprefix("(?is)") + ")")

    def each(parts: Column) -> Column:
        def content(p, i):
            after = lambda x: F.regexp_replace(x, r"\A<[^>]*>", "")
            rest = F.array_join(F.slice(parts, i + 1, F.size(parts)), "")
            # most elements end before the next one of their class starts
            return F.when(p.rlike(r"\A" + own), _simple(after(p), tag, up_to_close(after(rest), tag)))

        return F.filter(F.transform(parts, content), lambda c: c.isNotNull())

    return bound(starts, each)


def first_inside(fragment: Column, tag: str, css_class: str | None = None) -> Column:
    """Content of the first element of a kind, null without one."""
    return bound(F.split(fragment, opening(tag, css_class), 2), lambda two: F.when(
        F.size(two) == 2, up_to_close(F.get(two, F.lit(1)), tag)))


def text_of(fragment: Column) -> Column:
    """Text without tags, stripped; null stays null."""
    return bound(F.regexp_replace(fragment, TAG, ""), lambda t: F.trim(decode_entities(t)))


def first_text(fragment: Column, tag: str, css_class: str) -> Column:
    return text_of(first_inside(fragment, tag, css_class))


def attribute_pattern(tag: str, name: str) -> str:
    """Pattern of a tag of a kind that has an attribute, up to its value (one of three groups)."""
    return rf"""(?is)<{tag}\s(?:[^>]*\s)?{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def attribute(fragment: Column, tag: str, name: str) -> Column:
    """Attribute of the first tag of a kind that has it, null without one."""
    pattern = attribute_pattern(tag, name)
    value = lambda m: decode_entities(F.concat(*[F.regexp_extract(m, pattern, i) for i in (1, 2, 3)]))
    return bound(F.regexp_extract(fragment, pattern, 0), lambda m: F.when(m != "", value(m)))


def first_tag(fragment: Column, tag: str) -> Column:
    """The first opening tag of a kind, null without one."""
    return F.nullif(F.regexp_extract(fragment, rf"(?is)<{tag}(?:\s[^>]*)?>", 0), F.lit(""))
