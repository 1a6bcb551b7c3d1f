"""N-gram Jaccard join: linked documents by signature trees over word shingles.

Two documents link when ``100 * |A & B| >= 75 * |A | B|`` for their sets of
distinct five-word shingles. Exact, in steps that each shrink the data:

1. Equal sets form one *class*; every step below works on classes.
2. A linked class of size n misses at most n - ceil(0.75 n) of its shingles in its
   partner. A class with more shingles that no other class has links with nothing
   (``candidates``). Few documents are left on ordinary text.
3. Shingles are ordered by frequency level, then hash. Linked classes share one of
   their first n - ceil(0.75 n) + 1 shingles, so the connected components of
   "shares such a shingle" (``clusters``) hold every link.
4. Each cluster is joined by its *signature tree*: nodes hold the OR (and AND) of
   token bitmaps and a size range; the dual traversal drops node pairs whose largest
   possible overlap is too small, skips pairs already connected, and verifies the
   rest on the full sets (``spanning``). Chance makes clusters that grow with the
   table, so those beyond two ``PIECE`` are first split by the *lists* that make
   them, the members of one shared shingle: each member is verified against the
   largest of its lists (``hub``), and the pairs of a list that no hub has joined
   are held against each other by signatures alone, which are far smaller than the
   sets. Short lists give their pairs at once, long ones go through signature trees.
   What is left connected are the clusters of the last join. Only members that no hub
   reaches meet the others, piece by piece, so no task holds more than two pieces.

A frequent shingle only changes an order, so the list of frequent ones may be
approximate and is bounded (``MAX_FREQUENT``). Shingles are 64-bit hashes.

Defined cases: null, empty and blank texts have no shingles and link with nothing;
a text of fewer than five words is one shingle; repeated rows and ids are separate
rows of one class; rows without an id link like any other (their component is the smallest
id of the linked rows that have one, null where none has); ties need no rule; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import settled, sized
from .components import components

WIDTH = 5
PERCENT = 75
PIECE = 256                 # members of a cluster that meet in one task (at most two pieces)
SIGNATURE_PIECE = 2048      # the same where only signatures meet
LIST = 64                   # members up to which a list gives its pairs without a tree
MAX_FREQUENT = 1 << 20      # shingles with a frequency level of their own
FREQUENT = 8                # documents of a shingle that count as frequent
SUMMARY = 1 << 15           # entries of a task's heavy-hitter summary


def shingle_sets(chunk: W.Chunk, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of the chunk."""
    h = chunk.hashes(lower=True)
    start = W.gram_starts(chunk, width)
    grams = W.run_hashes(h, start, start + width)
    at = np.searchsorted(chunk.doc[start], np.arange(chunk.rows + 1)) if len(start) else np.zeros(chunk.rows + 1, int)
    size = np.diff(chunk.at)
    whole = W.run_hashes(h, chunk.at[:-1], chunk.at[1:])
    none = np.zeros(0, dtype=np.uint64)
    return [np.unique(grams[at[i]:at[i + 1]]) if size[i] >= width else (whole[i:i + 1] if size[i] else none)
            for i in range(chunk.rows)]


def set_id(values: np.ndarray) -> int:
    """64-bit identity of a set (order-free sum of mixed members and the size)."""
    total = np.sum(W.mix(values ^ np.uint64(0x5DEECE66D1234567)), dtype=np.uint64) + np.uint64(len(values))
    return int(W.mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def prefix_size(n: int) -> int:
    """Shingles of which a linked partner shares at least one, in any fixed order."""
    return n - (PERCENT * n + 99) // 100 + 1


def _prefix_column(n: str) -> Column:
    return F.expr(f"{n} - ({PERCENT} * {n} + 99) div 100 + 1")


class Frequency:
    """Frequency levels of some shingles; all others have level 0."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.levels = np.log2(np.maximum(counts[order], 1)).astype(np.int8) + 1

    def ordered(self, values: np.ndarray) -> np.ndarray:
        """``values`` (sorted by hash) ordered by (level, hash)."""
        if not len(self.tokens) or not len(values):
            return values
        at = np.minimum(np.searchsorted(self.tokens, values), len(self.tokens) - 1)
        level = np.where(self.tokens[at] == values, self.levels[at], 0)
        return values[np.argsort(level, kind="stable")] if level.any() else values


def _frequent(counts: DataFrame) -> Frequency:
    """Of a table of shingles and counts; it comes to the driver as two arrays."""
    got = counts.toArrow()
    tokens, many = (got.column(i).to_numpy().astype(np.int64) for i in (0, 1))
    return Frequency(tokens.view(np.uint64), many)


def _members(docs: DataFrame) -> DataFrame:
    """One pass over the texts: rows (kind 0, doc_id, n, cls, rid) and (kind 1, null, count, shingle, null).

    Kind 1 is each task's mergeable heavy-hitter summary: counts fall short by at
    most the task's shingles divided by ``SUMMARY``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            n, cls = [], []
            for c in W.chunks(b.column(1)):
                sets = shingle_sets(c)
                n += [len(s) for s in sets]
                cls += [set_id(s) if len(s) else None for s in sets]
                k, m = np.unique(np.concatenate(sets), return_counts=True)
                both, inverse = np.unique(np.concatenate([keys, k]), return_inverse=True)
                total = np.bincount(inverse, weights=np.concatenate([counts, m]), minlength=len(both)).astype(np.int64)
                if len(both) > SUMMARY:
                    total -= np.partition(total, len(total) - SUMMARY - 1)[len(total) - SUMMARY - 1]
                keys, counts = both[total > 0], total[total > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(n), pa.int32()), b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), b.column(2)],
                ["kind", "doc_id", "n", "cls", "rid"])
        none = pa.nulls(len(keys), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * len(keys), pa.int32()), none, pa.array(counts), pa.array(keys.view(np.int64)), none],
            ["kind", "doc_id", "n", "cls", "rid"])

    return settled(docs.select("doc_id", "text", "rid").mapInArrow(run, "kind int, doc_id long, n long, cls long, rid long"), "jaccard-members")


def _first_shingles(docs: DataFrame, order: Frequency) -> DataFrame:
    """(token, cls): a few more than the prefix of each class, once per task and class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for c in W.chunks(b.column(0)):
                tokens, cls = [], []
                for s in shingle_sets(c):
                    if not len(s) or (key := set_id(s)) in seen:
                        continue
                    seen.add(key)
                    p = prefix_size(len(s))
                    tokens.append(order.ordered(s)[:p + (3 * p + 19) // 20 + 2])
                    cls.append(np.full(len(tokens[-1]), key, dtype=np.int64))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(cls))], ["token", "cls"])

    return docs.select("text").mapInArrow(run, "token long, cls long")


def candidates(docs: DataFrame, classes: DataFrame, order: Frequency) -> DataFrame:
    """Classes (cls, n, rep) that share enough shingles with others to link at all."""
    own = (_first_shingles(docs, order).groupBy("token").agg(F.min("cls").alias("a"), F.max("cls").alias("b"))
           .where("a = b").groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("own")))
    left = classes.join(own, "cls", "left").where(F.coalesce("own", F.lit(0)) < _prefix_column("n"))
    return settled(left.select("cls", "n", "rep"), "jaccard-candidates")


def _sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(cls, n, tokens) of the chosen classes, read from one document each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column(1).to_pylist()
            for c in W.chunks(b.column(0)):
                sets = shingle_sets(c)
                good = [i for i, s in enumerate(sets) if len(s) and set_id(s) == want[c.first + i]]
                if good:
                    sizes = [len(sets[i]) for i in good]
                    flat = pa.array(np.concatenate([sets[i] for i in good]).view(np.int64))
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([want[c.first + i] for i in good], pa.int64()), pa.array(sizes, pa.int64()),
                         pa.ListArray.from_arrays(offsets, flat)], ["cls", "n", "tokens"])

    rows = docs.select(F.col("rid").alias("rep"), "text").join(sized(chosen.select("rep", "cls")), "rep")
    return settled(rows.select("text", "cls").mapInArrow(run, "cls long, n long, tokens array<long>"), "jaccard-sets")


def _rank(n: str, cls: str) -> Column:
    """One order of classes for all lists: by size, then by the low half of the hash."""
    return F.shiftleft(F.col(n).cast("long"), 32).bitwiseOR(F.col(cls).bitwiseAND(F.lit(0xFFFFFFFF)))


def shared_shingles(sets: DataFrame, order: Frequency) -> DataFrame:
    """(token, cls, n, place, hub, hub_n): the lists of prefix shingles that classes share; the largest class is the hub."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = b.column(1).offsets.to_numpy()
            flat = b.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64)
            tokens = [order.ordered(flat[x:y])[:prefix_size(y - x)] for x, y in zip(offsets[:-1], offsets[1:])]
            if tokens:
                size = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), size)),
                     pa.array(np.repeat(np.diff(offsets), size).astype(np.int32)),
                     pa.array(np.concatenate([np.arange(k) for k in size]).astype(np.int32))], ["token", "cls", "n", "place"])

    first = sets.select("cls", "tokens").mapInArrow(run, "token long, cls long, n int, place int")
    hubs = settled(first.groupBy("token").agg(F.count(F.lit(1)).alias("many"), F.max_by("cls", _rank("n", "cls")).alias("hub"), F.max("n").alias("hub_n"))
                   .where("many > 1").select("token", "hub", "hub_n"), "jaccard-hubs")
    return settled(first.join(hubs, "token"), "jaccard-shared")


def clusters(shared: DataFrame) -> DataFrame:
    """(cls, cluster): classes connected by shared prefix shingles; singles are left out."""
    edges = shared.where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b"))
    return settled(components(edges).select(F.col("node").alias("cls"), F.col("root").alias("cluster")), "jaccard-clusters")


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact rule on two sorted sets."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    small, big = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(big, small), len(big) - 1)
    both = int(np.count_nonzero(big[at] == small))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def bitmap(values: np.ndarray) -> np.ndarray:
    """Token bitmap of a set, as 64-bit words; its width is a power of two of twice the size or more."""
    bits = 1 << min(14, max(8, int(2 * len(values) - 1).bit_length()))
    out = np.zeros(bits // 64, dtype=np.uint64)
    at = (values & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return out


class SignatureTree:
    """Members sorted by size (those ``apart`` last) under nodes with OR and AND bitmaps and a size range."""

    FAN = 16

    def __init__(self, size: np.ndarray, bitmaps: np.ndarray, apart: np.ndarray | None = None):
        self.size, self.bitmaps = size, bitmaps
        self.order = np.lexsort((size, np.zeros(len(size), bool) if apart is None else apart))
        #: levels[0] are leaves of FAN members; each: (first, last + 1, OR, AND, least size, largest size)
        self.levels = [[self._node(i, min(i + self.FAN, len(size)), None) for i in range(0, len(size), self.FAN)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._node(i, min(i + self.FAN, len(below)), below) for i in range(0, len(below), self.FAN)])

    def _node(self, lo, hi, below):
        if below is None:
            rows = self.order[lo:hi]
            maps, size = self.bitmaps[rows], self.size[rows]
            return lo, hi, np.bitwise_or.reduce(maps), np.bitwise_and.reduce(maps), int(size.min()), int(size.max())
        part = below[lo:hi]
        return (lo, hi, np.bitwise_or.reduce([n[2] for n in part]), np.bitwise_and.reduce([n[3] for n in part]),
                min(n[4] for n in part), max(n[5] for n in part))

    @staticmethod
    def may_link(a, b) -> bool:
        """Whether a pair below the two nodes can reach the overlap the rule asks for."""
        if 100 * min(a[5], b[5]) < PERCENT * max(a[4], b[4]):
            return False
        need = PERCENT * (a[4] + b[4]) / (100 + PERCENT)
        most = min(a[5] - int(np.bitwise_count(a[3] & ~b[2]).sum()), b[5] - int(np.bitwise_count(b[3] & ~a[2]).sum()))
        return most >= need

    def _span(self, level: int, i: int) -> slice:
        """Places in ``order`` of the members below a node."""
        lo = i * self.FAN ** (level + 1)
        return slice(lo, min(lo + self.FAN ** (level + 1), len(self.order)))

    def pairs(self, comp: np.ndarray) -> Iterator[tuple[int, int]]:
        """Member pairs of different components that the traversal cannot rule out.

        ``comp`` gives each member's component; the caller may join components
        between two pairs, which rules out more.
        """
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            a, b = self.levels[level][i], self.levels[level][j]
            if i != j and not self.may_link(a, b):
                continue
            below = comp[self.order[self._span(level, i)]]
            if (below == below[0]).all() and (i == j or (comp[self.order[self._span(level, j)]] == below[0]).all()):
                continue
            if level:
                stack += [(level - 1, x, y) for x in range(a[0], a[1]) for y in range(b[0], b[1]) if x <= y]
                continue
            x, y = self.order[a[0]:a[1]], self.order[b[0]:b[1]]
            one, two = self.bitmaps[x][:, None, :], self.bitmaps[y][None, :, :]
            most = np.minimum(self.size[x][:, None] - np.bitwise_count(one & ~two).sum(axis=2, dtype=np.int64),
                              self.size[y][None, :] - np.bitwise_count(two & ~one).sum(axis=2, dtype=np.int64))
            good = (100 + PERCENT) * most >= PERCENT * (self.size[x][:, None] + self.size[y][None, :])
            if i == j:
                good = np.triu(good, 1)
            for u, v in zip(*np.nonzero(good)):
                if comp[x[u]] != comp[y[v]]:
                    yield int(x[u]), int(y[v])


def candidate_pairs(size: np.ndarray, maps: list[np.ndarray], comp: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of different components whose bitmaps and sizes allow a link.

    Linked sizes differ by less than a factor of two, so trees over one bitmap width
    and the next one hold every pair. ``comp`` is changed in place by the caller.
    """
    widths = np.array([len(m) for m in maps])
    kinds, kind = np.unique(comp, return_inverse=True)
    apart = kind != np.bincount(kind, minlength=len(kinds)).argmax()    # the largest component's members stand together
    for w in np.unique(widths):
        rows = np.flatnonzero((widths == w) | (widths == 2 * w))
        same = widths[rows] == w
        if len(rows) < 2 or not same.any():
            continue
        flat = np.stack([maps[r] if len(maps[r]) == w else maps[r][:w] | maps[r][w:] for r in rows])
        view = _View(comp, rows)
        for i, j in SignatureTree(size[rows], flat, apart[rows]).pairs(view):
            if same[i] or same[j]:
                yield int(rows[i]), int(rows[j])


class _View:
    """``comp[rows]`` that follows later changes of ``comp``."""

    def __init__(self, comp: np.ndarray, rows: np.ndarray):
        self.comp, self.rows = comp, rows

    def __getitem__(self, at):
        return self.comp[self.rows[at]]


def spanning(ids: list[int], comps: list[int], size: np.ndarray, maps: list[np.ndarray], sets=None) -> list[tuple[int, int]]:
    """A spanning forest of a group's links (with ``sets``), or of the pairs its signatures allow.

    Members of one ``comps`` value start connected.
    """
    comp = np.unique(np.array(comps), return_inverse=True)[1].reshape(-1)
    left, out = int(comp.max()) + 1, []
    if left < 2:
        return out
    for i, j in candidate_pairs(size, maps, comp):
        if sets is None or links(sets[i], sets[j]):
            comp[comp == comp[i]] = comp[j]
            out.append((ids[i], ids[j]))
            left -= 1
            if left == 1:
                break
    return out


def _groups(rows: DataFrame, exact: bool) -> DataFrame:
    """Links (a, b) of each group, one group in memory at a time.

    ``rows``: grp, cls, comp and n, tokens (``exact``) or n, bits.
    """
    last = "tokens" if exact else "bits"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, comps, size, data = None, [], [], [], []

        def done():
            found = []
            if len(ids) > 1:
                found = spanning(ids, comps, np.array(size), [bitmap(x) for x in data] if exact else data, data if exact else None)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                               pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for b in batches:
            if exact:
                offsets = b.column(4).offsets.to_numpy()
                flat = b.column(4).values.to_numpy(zero_copy_only=False).view(np.uint64)
                values = [flat[x:y].copy() for x, y in zip(offsets[:-1], offsets[1:])]
            else:
                values = [np.frombuffer(x, dtype=np.uint64) for x in b.column(4).to_pylist()]
            for grp, cls, comp, n, value in zip(*(b.column(i).to_pylist() for i in range(4)), values):
                if grp != now:
                    if ids:
                        yield done()
                    now, ids, comps, size, data = grp, [], [], [], []
                ids.append(cls)
                comps.append(comp)
                size.append(n)
                data.append(value)
        if ids:
            yield done()

    return (rows.repartition("grp").sortWithinPartitions("grp").select("grp", "cls", "comp", "n", last)
            .mapInArrow(run, "a long, b long"))


def _signatures(sets: DataFrame) -> DataFrame:
    """(cls, n, bits): the bitmap of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = b.column(2).offsets.to_numpy()
            flat = b.column(2).values.to_numpy(zero_copy_only=False).view(np.uint64)
            bits = [bitmap(flat[x:y]).tobytes() for x, y in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], ["cls", "n", "bits"])

    return sets.select("cls", "n", "tokens").mapInArrow(run, "cls long, n long, bits binary")


def _words(col, rows: np.ndarray, width: int) -> np.ndarray:
    """The bitmaps at ``rows`` of a binary column, all of ``width`` 64-bit words, as a matrix."""
    _, offs, data = col.buffers()
    at = np.frombuffer(offs, dtype=np.int32)[col.offset:col.offset + len(col)][rows].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[:, None] + np.arange(8 * width)].view(np.uint64)


def allowed(n: np.ndarray, m: np.ndarray, one, two) -> np.ndarray:
    """Whether sizes and bitmaps of pairs allow a link (bitmaps: binary columns)."""
    out = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    wide = [np.diff(np.frombuffer(c.buffers()[1], dtype=np.int32)[c.offset:c.offset + len(c) + 1]) // 8 for c in (one, two)]
    for u, v in sorted(set(zip(wide[0][out].tolist(), wide[1][out].tolist()))):
        rows = np.flatnonzero(out & (wide[0] == u) & (wide[1] == v))
        for part in np.array_split(rows, len(rows) * max(u, v) // (1 << 18) + 1):
            a, b = _words(one, part, u), _words(two, part, v)
            while a.shape[1] > b.shape[1]:
                a = a[:, :a.shape[1] // 2] | a[:, a.shape[1] // 2:]
            while b.shape[1] > a.shape[1]:
                b = b[:, :b.shape[1] // 2] | b[:, b.shape[1] // 2:]
            most = np.minimum(n[part] - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
                              m[part] - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
            out[part] = (100 + PERCENT) * most >= PERCENT * (n[part] + m[part])
    return out


def _allowed_pairs(pairs: DataFrame, signs: DataFrame, tag: str) -> DataFrame:
    """The pairs (a, b) whose signatures allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
            good = pa.array(np.flatnonzero(allowed(n, m, b.column(4), b.column(5))))
            yield pa.RecordBatch.from_arrays([b.column(0).take(good), b.column(1).take(good)], ["a", "b"])

    one = signs.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = signs.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return settled(both.mapInArrow(run, "a long, b long"), tag)


def _hub_links(sets: DataFrame, signs: DataFrame, lists: DataFrame) -> DataFrame:
    """Links (a, b) of the members of lists to the hubs (the largest sets, as copies lose words), and the hub's size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [(b.column(i).offsets.to_numpy(), b.column(i).values.to_numpy(zero_copy_only=False).view(np.uint64)) for i in (2, 3)]
            good = [k for k in range(b.num_rows)
                    if links(*(flat[o[k]:o[k + 1]] for o, flat in both))]
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(np.diff(both[1][0])[good].astype(np.int64))], ["a", "b", "n"])

    near = settled(lists.where(f"cls <> hub and 100 * cast(n as long) >= {PERCENT} * cast(hub_n as long)")
                   .select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct(), "jaccard-hub-pairs")
    pairs = _allowed_pairs(near, signs, "jaccard-hub-maybe")
    one = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("tokens_a")).join(sized(pairs), "a")
    two = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tokens_b")).join(sized(pairs.select("b").distinct()), "b", "left_semi")
    return settled(one.join(two, "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long, n long"), "jaccard-hub-links")


def _tied(found: DataFrame) -> DataFrame:
    """(cls, comp): the largest hub that each linked class has, or that hub's own; classes of one ``comp`` are linked through it."""
    best = settled(found.groupBy("a").agg(F.max_by("b", _rank("n", "b")).alias("b")), "jaccard-best")
    up = best.select(F.col("a").alias("b"), F.col("b").alias("up"))
    alone = found.select("b").distinct().join(best.select(F.col("a").alias("b")), "b", "left_anti")
    return settled(best.join(up, "b", "left").select(F.col("a").alias("cls"), F.coalesce("up", "b").alias("comp"))
                   .unionByName(alone.select(F.col("b").alias("cls"), F.col("b").alias("comp"))), "jaccard-tied")


def _list_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of short lists, of different components, whose sizes and places allow a link.

    ``lists``: token, cls, n, place, comp. A pair counts where it shares its first shingle:
    what stands before that in either prefix is not shared.
    """
    def pairs(token, cls, n, place, comp):
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[start, len(token)])
        found = [np.zeros((0, 2), dtype=np.int64)]
        for gap in range(1, int(size.max())):
            x = np.flatnonzero(np.arange(len(token)) + gap < np.repeat(start + size, size))
            y = x + gap
            most = np.minimum(n[x] - place[x], n[y] - place[y])
            x, y = (z[(comp[x] != comp[y]) & ((100 + PERCENT) * most >= PERCENT * (n[x] + n[y]))] for z in (x, y))
            found.append(np.stack([np.minimum(cls[x], cls[y]), np.maximum(cls[x], cls[y])], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None                                    # the last list, which may go on in the next batch
        for b in batches:
            now = [b.column(i).to_numpy().astype(np.int64) for i in range(5)]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            if not len(now[0]):
                continue
            cut = int(np.flatnonzero(now[0] == now[0][-1])[0])
            rest = [x[cut:] for x in now]
            if cut:
                out = pairs(*(x[:cut] for x in now))
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])
        if rest is not None:
            out = pairs(*rest)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    return (lists.repartition("token").sortWithinPartitions("token").select("token", "cls", "n", "place", "comp")
            .mapInArrow(run, "a long, b long").distinct())


def _pieces(m: DataFrame, piece: int) -> DataFrame:
    """(cls, comp, grp) of large clusters: pieces of loose members meet every piece of the cluster.

    ``m``: cls, comp, cluster. All but the members of the most common component are loose.
    """
    main = (m.groupBy("cluster", "comp").count().groupBy("cluster")
            .agg(F.max_by("comp", F.struct("count", "comp")).alias("main")))
    m = settled(m.join(settled(main, "jaccard-main"), "cluster").withColumn("loose", F.col("comp") != F.col("main")), "jaccard-large")
    size = settled(m.groupBy("cluster").agg(
        F.ceil(F.sum(F.when(F.col("loose"), 1).otherwise(0)) / piece).alias("n_loose"),
        F.ceil(F.sum(F.when(F.col("loose"), 0).otherwise(1)) / piece).alias("n_tied")), "jaccard-large-sizes")
    m = m.join(size, "cluster").where("n_loose > 0")
    mine = F.pmod(F.xxhash64("cls"), F.greatest(F.when(F.col("loose"), F.col("n_loose")).otherwise(F.col("n_tied")), F.lit(1)))
    m = m.withColumn("mine", mine)
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<long>"))
    name = lambda *parts: F.concat_ws(":", F.col("cluster").cast("string"), *[p.cast("string") for p in parts])
    with_loose = F.transform(upto("n_loose"), lambda j: F.when(
        F.col("loose"), name(F.lit("u"), F.least("mine", j), F.greatest("mine", j))).otherwise(name(F.lit("t"), j, F.col("mine"))))
    with_tied = F.transform(upto("n_tied"), lambda j: name(F.lit("t"), F.col("mine"), j))
    keys = F.when(F.col("loose"), F.concat(with_loose, with_tied)).otherwise(with_loose)
    return m.select("cls", "comp", F.explode(keys).alias("grp"))


def _blocks(long: DataFrame) -> DataFrame:
    """(cls, comp, cluster): long lists by themselves, or what they connect as one, whichever has fewer pairs."""
    root = settled(components(long.select(F.col("cls").alias("a"), F.col("lead").alias("b"))), "jaccard-blocks")
    of_list = (long.select("token", "members", "lead").distinct().join(root, F.col("lead") == F.col("node"), "left")
               .select("token", "members", F.coalesce("root", "lead").alias("root")))
    size = root.groupBy("root").agg(F.count(F.lit(1)).cast("double").alias("size"))
    apart = settled(of_list.withColumn("pairs", F.col("members").cast("double") * F.col("members")).groupBy("root").agg(F.sum("pairs").alias("pairs"))
                    .join(size, "root").select("root", (F.col("pairs") < F.col("size") * F.col("size")).alias("apart")), "jaccard-apart")
    named = of_list.join(apart, "root").select("token", F.when(F.col("apart"), F.concat(F.lit("t"), "token"))
                                               .otherwise(F.concat(F.lit("r"), "root")).alias("cluster"))
    return long.join(sized(settled(named, "jaccard-named-lists")), "token").select("cls", "comp", "cluster").distinct()


def _split(sets: DataFrame, shared: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Large clusters split by their lists: links to hubs (a, b), what those tie (cls, comp), parts (cls, cluster)."""
    own = sized(large.select("cls"))
    lists = settled(shared.join(own, "cls", "left_semi"), "jaccard-lists")
    signs = settled(_signatures(sets.join(own, "cls", "left_semi")).dropDuplicates(["cls"]), "jaccard-signatures")
    links_to = _hub_links(sets, signs, lists)
    found, tied = links_to.select("a", "b"), _tied(links_to)
    # a hub has met its list, and what one hub ties is connected: only lists of several such components are left
    left = settled(lists.where("cls <> hub").join(sized(tied), "cls", "left")
                   .select("token", "cls", "n", "place", F.coalesce("comp", "cls").alias("comp")), "jaccard-left")
    several = settled(left.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high"),
                                                F.min("cls").alias("lead")).where("low <> high").select("token", "members", "lead"), "jaccard-several")
    left = settled(left.join(sized(several), "token"), "jaccard-open-lists")
    maybe = _allowed_pairs(_list_pairs(left.where(f"members <= {LIST}")), signs, "jaccard-pairs")
    long = left.where(f"members > {LIST}")
    if not long.isEmpty():
        groups = settled(_tasks(_blocks(long), SIGNATURE_PIECE), "jaccard-pieces")
        maybe = maybe.unionByName(settled(_groups(signs.join(sized(groups), "cls"), exact=False), "jaccard-maybe"))
    parts = components(maybe.unionByName(found)).select(F.col("node").alias("cls"), F.concat(F.lit("s"), "root").alias("cluster"))
    return found, tied, parts


def _by_size(member: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """Members (a settled table) of clusters that fit in one task (two pieces), and of larger ones."""
    tagged = settled(member.join(settled(member.groupBy("cluster").count(), "jaccard-sizes"), "cluster"), "jaccard-tagged")
    return (tagged.where(f"count <= {2 * piece}").select(*member.columns),
            tagged.where(f"count > {2 * piece}").select(*member.columns))


def _tasks(member: DataFrame, piece: int) -> DataFrame:
    """(cls, comp, grp): the groups of at most two pieces in which the members of each cluster meet."""
    few, many = _by_size(settled(member.select("cls", "comp", "cluster"), "jaccard-sized"), piece)
    groups = few.select("cls", "comp", F.col("cluster").alias("grp"))
    return groups if many.isEmpty() else groups.unionByName(_pieces(many, piece))


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id (null without words) and component_id, one row per input row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # finds a class's text again: rows without an id go by their text
    docs = docs.withColumn("rid", F.coalesce("doc_id", F.xxhash64("text")))
    both = _members(docs)
    rows = both.where("kind = 0")
    classes = rows.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.min("rid").alias("rep"), F.min("doc_id").alias("least_id"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    heavy = (both.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("c"))
             .where(F.col("c") * 100_000 >= total).orderBy(F.desc("c"), "cls").limit(MAX_FREQUENT))
    chosen = candidates(docs, classes, _frequent(heavy))
    sets = _sets(docs, chosen)
    common = (sets.select(F.explode("tokens").alias("token")).groupBy("token").count().where(f"count >= {FREQUENT}")
              .orderBy(F.desc("count"), "token").limit(MAX_FREQUENT))
    shared = shared_shingles(sets, _frequent(common))
    few, many = _by_size(clusters(shared), PIECE)
    groups = few.select("cls", F.col("cls").alias("comp"), F.col("cluster").cast("string").alias("grp"))
    found = None
    if not many.isEmpty():
        # large clusters: split by their lists, then meet on full sets
        found, tied, parts = _split(sets, shared, many)
        groups = groups.unionByName(_tasks(parts.join(sized(tied), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), PIECE))
    groups = settled(groups, "jaccard-groups")
    trees = settled(_groups(sets.join(sized(groups), "cls"), exact=True), "jaccard-links")
    roots = components(trees if found is None else trees.unionByName(found))
    whole = settled(classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                    .select("cls", "least_id", F.coalesce("root", "cls").alias("root")), "jaccard-roots")
    least = settled(whole.groupBy("root").agg(F.min("least_id").alias("component_id")), "jaccard-least")
    named = settled(whole.join(least, "root").select("cls", "component_id"), "jaccard-named")
    return (rows.join(named, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
