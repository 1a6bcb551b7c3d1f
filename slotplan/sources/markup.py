"""Tags of a batch of pages, found once by array operations (the rules of ``fragments``).

All pages lie end to end in one byte string. Openings are matched against a class once per
distinct tag text; the closing of an opening is the next place where the running depth falls
below that of the opening. Pages whose tags do not nest plainly (a ``<`` inside a tag, or a
closing with more than a name) are named by ``odd``; ``fragments`` reads those.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from .fragments import opening

_WORD_END = np.zeros(256, dtype=bool)
_WORD_END[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x2F, 0x3E]] = True       # white space, / and >


class _Kind:
    """Openings and closings of one kind of tag."""

    def __init__(self, raw: bytes, data: np.ndarray, at: np.ndarray, end: np.ndarray, tag: str, classes: Sequence[str]):
        size = len(data)

        def named(shift: int) -> np.ndarray:
            ok = at + shift + len(tag) < size
            for k, c in enumerate(tag.encode()):
                ok &= (data[np.minimum(at + shift + k, size - 1)] | 0x20) == c
            return ok & _WORD_END[data[np.minimum(at + shift + len(tag), size - 1)]]

        slash = data[np.minimum(at + 1, size - 1)] == 0x2F
        closes, opens = slash & named(2), ~slash & named(1)
        both = np.flatnonzero(closes | opens)
        self.at, self.end = at[both], end[both]
        down = closes[both]
        # closings with more than white space after the name
        after = self.at + 2 + len(tag)
        more = np.flatnonzero(down & (self.end - 1 > after))
        self.odd = self.at[[k for k in more.tolist() if raw[after[k]:self.end[k] - 1].strip()]]
        depth = np.cumsum(np.where(down, -1, 1))
        n = len(both)
        low = int(depth.min()) if n else 0
        # closings by the depth they leave, then place
        self.n, self.low = n + 1, low
        self.keys = np.sort((depth[down] - low + 1) * self.n + np.flatnonzero(down))
        self.depth = np.concatenate([[0], depth]) - low + 1
        self.opens = ~down
        texts = [raw[x:y] for x, y in zip(self.at[self.opens].tolist(), self.end[self.opens].tolist())]
        known: dict[bytes, int] = {}
        code = np.array([known.setdefault(t, len(known)) for t in texts], dtype=np.int64)
        self.places = {}
        for css in (None, *classes):
            own = opening(tag, css)
            fits = np.array([own.match(t.decode("utf-8", "replace")) is not None for t in known], dtype=bool)
            here = fits[code] if len(code) else np.zeros(0, bool)
            self.places[css] = self.at[self.opens][here], self.end[self.opens][here]

    def closing(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the content that begins at ``lo`` ends, at most ``hi``."""
        j = np.searchsorted(self.at, lo)
        if not len(self.keys):
            return hi
        key = (self.depth[j] - 1) * self.n + j
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[k] >= key) & (self.keys[k] // self.n == self.depth[j] - 1)
        return np.where(found, np.minimum(self.at[self.keys[k] % self.n], hi), hi)


class Markup:
    """Tags of ``raw``: pages end to end, ``limits`` their offsets; ``kinds`` tag -> classes to find."""

    def __init__(self, raw: bytes, limits: np.ndarray, kinds: dict[str, Sequence[str]]):
        data = np.frombuffer(raw, dtype=np.uint8)
        left, right = np.flatnonzero(data == 0x3C), np.flatnonzero(data == 0x3E)
        place = np.searchsorted(right, left)
        end = np.append(right, len(data))[place] + 1
        # a tag ends with its page; nothing closes it there
        page = np.searchsorted(limits, left, side="right")
        whole = end <= limits[page] if len(left) else np.zeros(0, bool)
        inner = np.append(left[1:], len(data) + 1) < end
        odd = left[~whole | inner]
        self.kinds = {tag: _Kind(raw, data, left, np.minimum(end, len(data)), tag, css) for tag, css in kinds.items()}
        odd = np.concatenate([odd, *[k.odd for k in self.kinds.values()]])
        #: pages that ``fragments`` must read
        self.odd = np.zeros(len(limits) - 1, dtype=bool)
        self.odd[np.searchsorted(limits, odd, side="right") - 1] = True

    def first(self, lo: np.ndarray, hi: np.ndarray, tag: str, css: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Content of the first element of a kind in each span; (-1, -1) without one, or where ``lo`` is -1."""
        kind = self.kinds[tag]
        at, end = kind.places[css]
        if not len(at):
            return np.full(len(lo), -1), np.full(len(lo), -1)
        k = np.searchsorted(at, lo)
        there = np.minimum(k, len(at) - 1)
        ok = (lo >= 0) & (k < len(at)) & (end[there] <= hi)
        start = np.where(ok, end[there], -1)
        return start, np.where(ok, kind.closing(start, hi), -1)

    def every(self, lo: np.ndarray, hi: np.ndarray, tag: str, css: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, starts, ends): contents of all elements of a kind in each span, in order of their openings."""
        kind = self.kinds[tag]
        at, end = kind.places[css]
        a, b = np.searchsorted(at, lo), np.searchsorted(at, hi)
        n = np.where(lo >= 0, np.maximum(b - a, 0), 0)
        offsets = np.concatenate([[0], np.cumsum(n)])
        pick = np.repeat(a - offsets[:-1], n) + np.arange(offsets[-1])
        starts = end[pick]
        return offsets, starts, kind.closing(starts, np.repeat(hi, n))
