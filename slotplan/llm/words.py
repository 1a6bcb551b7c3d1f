"""Words and word-sequence fingerprints of Arrow string columns, vectorised.

A word is a maximal run of bytes other than the six ASCII spaces (0x20 and
0x09-0x0D). All functions work on *chunks*: a few texts whose bytes lie end to
end, so temporary arrays stay a small multiple of ``CHUNK_BYTES`` (or of one
text, if that is longer; texts are never cut).

A word hash takes the bytes eight at a time. A fingerprint of a run of items is the
polynomial ``sum(x[i+j] * R**j)`` modulo 2**64, finished by a bijective mix. Prefix
sums give the fingerprint of any run in constant time, so windows cost nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)   # little-endian: the first k bytes
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n (kept and grown per process)."""
    have = _powers.get("r")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 64)
        for name, base in (("r", _R), ("inv", _R_INV)):
            col = np.full(size, base, dtype=np.uint64)
            col[0] = 1
            _powers[name] = np.cumprod(col, dtype=np.uint64)
    return _powers["r"][:n], _powers["inv"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finish, so that order and low bits look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of ``items[start:end]`` for each pair (items: uint64)."""
    r, inv = powers(len(items) + 1)
    total = np.zeros(len(items) + 1, dtype=np.uint64)
    np.cumsum(items * r[:-1], dtype=np.uint64, out=total[1:])
    width = (end - start).astype(np.uint64)
    return mix((total[end] - total[start]) * inv[start] + width * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Chunk:
    """Words of some consecutive texts: ``doc`` is the row inside the batch."""

    first: int            # first row of the batch in this chunk
    rows: int             # number of rows
    data: np.ndarray      # bytes of the texts, end to end
    doc: np.ndarray       # row of each word, counted from ``first``
    start: np.ndarray     # byte span of each word in ``data``
    end: np.ndarray
    at: np.ndarray        # rows + 1 offsets: words of row i are at[i]:at[i+1]
    base: np.ndarray      # rows + 1 byte offsets of the texts

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word (``lower``: A-Z count as a-z)."""
        return _word_hashes(_LOWER[self.data] if lower else self.data, self.start, self.end)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash words eight bytes at a time; few words need more than two rounds."""
    room = np.zeros(len(data) + 16, dtype=np.uint8)
    room[:len(data)] = data
    eights = np.lib.stride_tricks.as_strided(room[:8].view(np.uint64), shape=(len(data) + 8,), strides=(1,))
    size = end - start
    out = mix(size.astype(np.uint64) * np.uint64(_R))
    at, left, rows = start, size, slice(None)
    while len(at):
        part = eights[at] & _MASK[np.minimum(left, 8)]
        out[rows] = mix(out[rows] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def _string_parts(col) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null texts have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.zeros(len(col) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets.astype(np.int64), body


def chunks(col, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow string column in chunks of at most ``limit`` bytes."""
    offsets, body = _string_parts(col)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield _split(i, offsets[i:j + 1] - offsets[i], body[offsets[i]:offsets[j]])
        i = j


def _split(first: int, base: np.ndarray, data: np.ndarray) -> Chunk:
    rows = len(base) - 1
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)      # a text begins or ends here
    edge[base] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    at = np.searchsorted(start, base)
    doc = np.repeat(np.arange(rows), np.diff(at))
    return Chunk(first, rows, data, doc, start, end, at, base)


def gram_starts(chunk: Chunk, width: int) -> np.ndarray:
    """Positions of words that begin a run of ``width`` words of the same text."""
    n = len(chunk.doc)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(chunk.doc[:n - width + 1] == chunk.doc[width - 1:])
