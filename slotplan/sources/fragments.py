"""The rules of ``elements`` on Python strings, for records that read many fields of one block.

An element is a pair of offsets into its page, so nothing is copied until a field's text is
taken. Patterns are those of ``elements`` and ``pages``; classes and case are ASCII, as in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from . import elements as E
from .pages import ENTITIES, NOISE, TAG

Span = tuple[int, int]


@lru_cache(maxsize=None)
def pattern(text: str) -> re.Pattern:
    return re.compile(text, re.ASCII)


@lru_cache(maxsize=None)
def opening(tag: str, css_class: str | None = None) -> re.Pattern:
    return pattern(E.opening(tag, css_class))


@lru_cache(maxsize=None)
def _limits(tag: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    return pattern(rf"(?i)</{tag}\s*>"), pattern(rf"(?i)<{tag}[\s>/]"), pattern(rf"(?i)</?{tag}[\s>/]")


def clean(html: str) -> str:
    return pattern(NOISE).sub("", html)


def up_to_close(s: str, tag: str, lo: int, hi: int) -> Span:
    """What stands before the closing that belongs to an opening that ends at ``lo``."""
    closing, starting, either = _limits(tag)
    first = closing.search(s, lo, hi)
    if first and not starting.search(s, lo, first.start()):
        return lo, first.start()
    depth = 0
    for m in either.finditer(s, lo, hi):
        depth += -1 if s[m.start() + 1] == "/" else 1
        if depth < 0:
            return lo, m.start()
    return lo, hi


def inside(s: str, span: Span, tag: str, css_class: str | None = None) -> Iterator[Span]:
    """Contents of all elements of a kind, in order of their openings (nested ones too)."""
    own, at, hi = opening(tag, css_class), *span
    while m := own.search(s, at, hi):
        # an opening that lies inside the text of this one is the one that counts
        inner = own.search(s, m.start() + 1, m.end())
        if inner is None:
            yield up_to_close(s, tag, m.end(), hi)
        at = inner.start() if inner else m.end()


def first_inside(s: str, span: Span | None, tag: str, css_class: str | None = None) -> Span | None:
    """Content of the first element of a kind, None without one."""
    m = span and opening(tag, css_class).search(s, *span)
    return up_to_close(s, tag, m.end(), span[1]) if m else None


def decode_entities(text: str) -> str:
    if "&" in text:
        for entity, character in ENTITIES:
            text = text.replace(entity, character)
    return text


def text_of(s: str, span: Span | None) -> str | None:
    """Text without tags, stripped; None stays None."""
    if span is None:
        return None
    text = s[span[0]:span[1]]
    return decode_entities(pattern(TAG).sub("", text) if "<" in text else text).strip(" ")


def first_text(s: str, span: Span | None, tag: str, css_class: str) -> str | None:
    return text_of(s, first_inside(s, span, tag, css_class))


def attribute(s: str, span: Span | None, tag: str, name: str) -> str | None:
    """Attribute of the first tag of a kind that has it, None without one."""
    m = span and pattern(E.attribute_pattern(tag, name)).search(s, *span)
    return decode_entities("".join(g or "" for g in m.groups())) if m else None


def first_tag(s: str, span: Span | None, tag: str) -> Span | None:
    """The first opening tag of a kind, None without one."""
    m = span and opening(tag).search(s, *span)
    return m.span() if m else None
