"""SentencePiece encoding and decoding by a relational lattice.

A text is cut into *segments*: white-space runs with the word after them, and
characters that no longer piece holds. No piece crosses a cut, so segments are
encoded apart, each distinct frequent one once:

1. lattice: explode the substrings of bounded length, equi-join them to the piece
   table (its size is fixed, it is broadcast), group the edges by segment;
2. fold the edges with Spark's ``aggregate``: Viterbi for unigram models; for BPE
   models the merges in order of score (a BPE score is a merge rank, for which the
   best-sum path is not the encoding). Characters without a piece become bytes;
3. the ``hot`` most frequent segments form a dictionary of bounded size that every
   task gets. Of BPE models, segments outside it go through the same lattice and fold
   where they stand, many at a time as arrays (``Lattice``), so no text is shuffled; of
   unigram models they go through the tables under their text's key, so no text is sent
   more than once, in packed form.

``decode`` maps pieces back to bytes; ``encode`` tells whether decoding gives the text.

Only models with identity normalisation, a dummy prefix and kept white space are
read (others raise). Defined cases: null and empty texts have no tokens and
round-trip to empty; a repeated row is encoded like the first; characters outside
the pieces use byte pieces, or the unknown piece where the model has no byte pieces
(then the text does not round-trip); a literal white-space mark (U+2581) is bytes, so
that it comes back; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import words as W
from .common import lean, settled, small_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
HOT = 1 << 20             # segments of the dictionary
HOT_BYTES = 64            # longest segment of the dictionary
CUT_BYTES = 1 << 19       # texts that are cut together in a task
GROUPED = 1 << 17         # segments whose edges a task groups in memory, without a sort
_SHORT = 60               # characters whose boundaries fit in one 64-bit mask
_MARK = "▁"


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]     # text (mark as space), score, id
    first_byte: int | None                   # id of the piece of byte 0
    unknown: int
    bpe: bool
    texts: list[bytes]                       # bytes of every id; control pieces are empty

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @property
    def edge_bits(self) -> tuple[int, int, int] | None:
        """Bits of length, id and rank of an edge in one number (merges need no scores, only their order);
        None where they leave fewer than 28 for its place."""
        bits = self.longest.bit_length(), len(self.texts).bit_length(), len(self.pieces).bit_length()
        return bits if self.bpe and sum(bits) <= 35 else None

    @property
    def apart(self) -> np.ndarray:
        """Bytes (of one-byte characters) that no longer piece holds."""
        inside = {c for p, _, _ in self.pieces if len(p) > 1 for c in p}
        return np.array([i < 128 and i != 32 and chr(i) not in inside for i in range(256)])


def load(path: str = MODEL_PATH, as_unigram: bool = False) -> Model:
    """Read a model file (on the driver); ``as_unigram`` takes its scores as log-probabilities."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only models with identity normalisation and a dummy prefix are read")
    pieces, texts, first_byte, unknown = [], [], None, 0
    for i, p in enumerate(proto.pieces):
        if p.type == 6:                                              # byte
            first_byte = i if int(p.piece[1:-1], 16) == 0 else first_byte
            texts.append(bytes([int(p.piece[1:-1], 16)]))
        elif p.type in (1, 4):                                       # normal, user defined
            text = p.piece.replace(_MARK, " ")
            if len(text) > 1 and " " in text.lstrip(" "):
                raise ValueError("a piece holds white space inside")
            pieces.append((text, float(p.score), i))
            texts.append(text.encode())
        else:
            unknown = i if p.type == 2 else unknown
            texts.append(" ⁇ ".encode() if p.type == 2 else b"")
    return Model(pieces, first_byte, unknown, proto.trainer_spec.model_type == 2 and not as_unigram, texts)


# ---- segments of texts -------------------------------------------------------

def segments(chunk_data: np.ndarray, base: np.ndarray, apart: np.ndarray):
    """Bytes with a dummy space before every text, and the spans and rows of its segments."""
    full = np.flatnonzero(np.diff(base) > 0)
    data = np.insert(chunk_data, base[full], 0x20)
    starts = base[full] + np.arange(len(full))
    ends = np.append(starts[1:], len(data))
    alone, space = apart[data], data == 0x20
    new = alone.copy()
    new[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
    new[starts] = True
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(data))
    row = full[np.searchsorted(starts, lo, side="right") - 1] if len(full) else np.zeros(0, np.int64)
    return data, lo, hi, row, starts, ends


def _cuts(column, apart):
    for c in W.chunks(column, CUT_BYTES):
        data, lo, hi, row, _, _ = segments(c.data, c.base, apart)
        yield c, data, lo, hi, row, W._word_hashes(data, lo, hi)


def counted(docs: DataFrame, apart: np.ndarray) -> DataFrame:
    """(word, count) of all segments, summed per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, data, lo, hi, _, h in _cuts(b.column(0), apart):
                _, at, n = np.unique(h, return_index=True, return_counts=True)
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[x:y].decode() for x, y in zip(lo[at].tolist(), hi[at].tolist())], pa.string()), pa.array(n, pa.int64())],
                    ["word", "n"])

    return docs.select("text").mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- lattice and folds -------------------------------------------------------

def lattice(words: DataFrame, model: Model) -> DataFrame:
    """``words`` (column ``word`` and keys) with ``n`` characters and ``edges`` (i, k, score, id) of its pieces.

    For BPE models the edges come in the order of merges: best score first, then leftmost.
    """
    spark = words.sparkSession
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GROUPED))
    table = spark.createDataFrame(model.pieces + [("", 0.0, -1)], "piece string, score double, id int")
    keys = words.columns
    n, i = F.length("word"), F.col("i")
    parts = (words.withColumn("n", n)
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)))))
             # the empty substring at 0 keeps words that hold no piece
             .withColumn("k", F.explode(F.sequence(F.when(i == 0, 0).otherwise(i + 1), F.least(F.col("n"), i + model.longest))))
             .withColumn("piece", F.substr("word", i + 1, F.col("k") - i)))
    if model.edge_bits is None:
        grouped = parts.join(F.broadcast(table), "piece").groupBy(*keys, "n")
        if not model.bpe:
            return grouped.agg(F.collect_list(F.struct("i", "k", "score", "id")).alias("edges"))
        best_first = F.sort_array(F.collect_list(F.struct("score", (-i).alias("left"), "k", "id")), asc=False)
        return grouped.agg(best_first.alias("edges")).withColumn("edges", F.transform("edges", lambda e: F.struct(
            (-e["left"]).alias("i"), e["k"].alias("k"), e["score"].alias("score"), e["id"].alias("id"))))
    # an edge is one number (rank of the score, places to the right, length, id + 1): a group is a
    # list of numbers, and their falling order is the order of merges
    lengths, ids, ranks = model.edge_bits
    places = 28
    right = (1 << places) - 1
    rank = {s: r for r, s in enumerate(sorted({s for _, s, _ in model.pieces}))}
    packed = [(p, (((((rank[s] << places) + right) << lengths) + len(p)) << ids) + id_ + 1) for p, s, id_ in model.pieces]
    coded = spark.createDataFrame(packed + [("", right << (lengths + ids))], "piece string, e long")
    grouped = (parts.join(F.broadcast(coded), "piece")
               .withColumn("e", F.col("e") - F.call_function("shiftleft", i.cast("long"), F.lit(lengths + ids)))
               .groupBy(*keys, "n").agg(F.collect_list("e").alias("edges")))

    def field(e, below, bits):
        return F.call_function("shiftright", e, F.lit(below)).bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int")

    def edge(e):
        at = F.lit(right) - field(e, lengths + ids, places)
        return F.struct(at.alias("i"), (at + field(e, ids, lengths)).alias("k"),
                        field(e, lengths + ids + places, ranks).cast("double").alias("score"), (field(e, 0, ids) - 1).alias("id"))

    return grouped.withColumn("edges", F.transform(F.sort_array("edges", asc=False), edge))


def _bit(p: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), p)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _character_bytes(p: Column, model: Model) -> Column:
    """Ids of the character at position p where it has no piece."""
    if model.first_byte is None:
        return F.array(F.lit(model.unknown))
    code = F.hex(F.substr("word", p + 1, F.lit(1)).cast("binary"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1),
                       lambda b: (F.conv(F.substr(code, (2 * b + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + model.first_byte))


def _ids_between(bounds: Column, model: Model) -> Column:
    """Ids of the pieces between consecutive boundaries."""
    at = lambda x: F.get(bounds, x)
    found = lambda x: F.transform(F.filter("edges", lambda e: (e["i"] == at(x)) & (e["k"] == at(x + 1)) & (e["k"] > e["i"])), lambda e: e["id"])
    return F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(bounds) - 2),
        lambda x: _bound(found(x), lambda f: F.when(F.size(f) > 0, F.slice(f, 1, 1)).otherwise(_character_bytes(at(x), model)))))


def merged(lat: DataFrame, model: Model) -> DataFrame:
    """BPE: join the neighbours whose piece has the best score, leftmost on ties, until none is left.

    One pass over the merges in their order does it unless a merge comes up while its span is
    still in three parts or more (it may fit later): such a segment is folded step by step.
    Boundaries are only taken away, so any other merge that does not fit never will.

    Values that a fold uses are bound to lambda variables, so the optimiser cannot
    copy a fold into another one.
    """
    keys = [c for c in lat.columns if c not in ("n", "edges")]
    n = F.col("n")
    count = lambda x: F.when(x > 0, F.sequence(F.lit(1), x)).otherwise(F.array().cast("array<int>"))

    # up to _SHORT characters: boundaries are the bits of one number; one more bit says "done",
    # in the single pass "a merge may fit later"
    done = 1 << (_SHORT + 2)

    def sweep(mask, e):
        inside = mask.bitwiseAND(e["inner"])
        return (F.when((mask.bitwiseAND(e["ends"]) != e["ends"]) | (inside == 0), mask)
                .when(F.bit_count(inside) == 1, mask.bitwiseAND(F.bitwise_not(e["inner"])))
                .otherwise(mask.bitwiseOR(F.lit(done))))

    def step(moves):
        def one(mask, _):
            fits = F.filter(moves, lambda e: (mask.bitwiseAND(e["ends"]) == e["ends"])
                            & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1))
            return F.when(mask.bitwiseAND(F.lit(done)) != 0, mask).otherwise(
                F.coalesce(mask.bitwiseAND(F.bitwise_not(F.get(fits, F.lit(0))["inner"])), mask.bitwiseOR(F.lit(done))))
        return one

    def joined(moves):
        every = _bit(n + 1) - 1
        return _bound(F.aggregate(moves, every, sweep), lambda m: F.when(m.bitwiseAND(F.lit(done)) == 0, m).otherwise(
            F.aggregate(count(F.least(n - 1, F.size(moves))), every, step(moves))))

    spans = F.transform("edges", lambda e: F.struct(
        e["i"].alias("i"), (_bit(e["k"]) - _bit(e["i"] + 1)).alias("inner"),
        (_bit(e["i"]).bitwiseOR(_bit(e["k"]))).alias("ends"), e["id"].alias("id")))
    merges = F.filter("edges", lambda e: e["k"] - e["i"] > 1)

    def chosen(s):
        """(mask, edges between neighbouring boundaries) of a segment."""
        mask = _bound(F.filter(s, lambda e: e["inner"] > 0), joined)     # not the empty edge
        return _bound(mask, lambda m: F.struct(m.alias("mask"), F.sort_array(F.transform(
            F.filter(s, lambda e: (m.bitwiseAND(e["ends"]) == e["ends"]) & (m.bitwiseAND(e["inner"]) == 0) & (e["id"] >= 0)),
            lambda e: F.struct(e["i"].alias("i"), e["id"].alias("id")))).alias("found")))

    def short_ids(c):
        # every character has a piece: the edges are the answer; else bytes fill the gaps
        bounds = F.filter(F.sequence(F.lit(0), n), lambda p: c["mask"].bitwiseAND(_bit(p)) != 0)
        whole = F.size(c["found"]) == F.bit_count(c["mask"].bitwiseAND(F.lit(done - 1))) - 1
        return F.when(whole, F.transform(c["found"], lambda e: e["id"])).otherwise(
            _bound(bounds, lambda b: _ids_between(b, model)))

    short = _bound(_bound(spans, chosen), short_ids)

    # longer: next[p] is the boundary after p, -1 where p is none
    def far_step(moves):
        def one(nxt, _):
            middle = lambda e: F.get(nxt, e["i"])
            best = F.array_max(F.filter(moves, lambda e: (middle(e) > 0) & (middle(e) < e["k"])
                                        & F.coalesce(F.get(nxt, F.greatest(middle(e), F.lit(0))) == e["k"], F.lit(False))))
            return _bound(best, lambda b: F.when(b.isNull(), nxt).otherwise(F.transform(nxt, lambda x, p: F.when(
                p == b["i"], b["k"]).when((p > b["i"]) & (p < b["k"]), F.lit(-1)).otherwise(x))))
        return one

    far_moves = F.transform(merges, lambda e: F.struct(
        e["score"].alias("score"), (-e["i"]).alias("left"), e["i"].alias("i"), e["k"].alias("k")))
    start = F.transform(F.sequence(F.lit(0), n), lambda p: p + 1)
    nxt = _bound(far_moves, lambda m: F.aggregate(count(F.least(n - 1, F.size(m))), start, far_step(m)))
    far = _bound(nxt, lambda x: F.filter(F.sequence(F.lit(0), n), lambda p: F.get(x, p) > 0))
    far_ids = _bound(far, lambda bounds: _ids_between(bounds, model))
    return lat.select(*keys, F.when(n <= _SHORT, short).otherwise(far_ids).alias("ids"))


def viterbi(lat: DataFrame, model: Model) -> DataFrame:
    """Unigram: the path of edges with the largest sum of scores; a character without a
    piece costs ten more than the worst piece."""
    keys = [c for c in lat.columns if c not in ("n", "edges")]
    unk = min(s for _, s, _ in model.pieces) - 10.0
    node = lambda s, i: F.struct(s.alias("score"), i.alias("from"))

    def reach(best, k):
        own = F.transform(F.filter("edges", lambda e: (e["k"] == k) & (e["k"] > e["i"])),
                          lambda e: node(F.get(best, e["i"])["score"] + e["score"], e["i"]))
        bare = F.array(node(F.get(best, k - 1)["score"] + unk, k - 1))
        has = F.exists("edges", lambda e: (e["k"] == k) & (e["i"] == k - 1))
        return F.concat(best, F.array(F.array_max(F.when(has, own).otherwise(F.concat(own, bare)))))

    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    n = F.col("n")

    def back(best):
        return F.aggregate(upto(n), F.array(n), lambda path, _: _bound(F.get(path, F.lit(0)), lambda at: F.when(
            at > 0, F.concat(F.array(F.get(best, at)["from"]), path)).otherwise(path)))

    best = F.aggregate(upto(n), F.array(node(F.lit(0.0), F.lit(0))), reach)
    return lat.select(*keys, _bound(_bound(best, back), lambda bounds: _ids_between(bounds, model)).alias("ids"))


def encoded_words(words: DataFrame, model: Model) -> DataFrame:
    """``words`` (column ``word`` and keys) with ``ids``."""
    lat = lattice(words, model)
    return merged(lat, model) if model.bpe else viterbi(lat, model)


# ---- the same lattice and fold as arrays, many segments at a time ----------------

def _ramp(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n[0] - 1, 0, 1, .. n[1] - 1, .."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class Lattice:
    """Edges and merges of a BPE model over spans of bytes.

    Substrings are grown byte by byte while some piece begins with them: ``steps`` holds the
    beginnings of all pieces as sorted numbers (place of the beginning one byte shorter, byte).
    """

    def __init__(self, model: Model):
        pieces = [p.encode() for p, _, _ in model.pieces]
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        text = np.zeros((len(pieces), int(size.max(initial=0))), dtype=np.uint8)
        for r, p in enumerate(pieces):
            text[r, :len(p)] = np.frombuffer(p, dtype=np.uint8)
        node, steps, ends, count = np.zeros(len(pieces), np.int64), [], [], 0
        for d in range(text.shape[1]):
            on = np.flatnonzero(size > d)
            step, back = np.unique((node[on] << 8) + text[on, d], return_inverse=True)
            node[on] = count + 1 + back.reshape(-1)
            count += len(step)
            steps.append(step)
            ends.append(on[size[on] == d + 1])
        self.steps = np.concatenate([*steps, [np.iinfo(np.int64).max]])
        self.piece = np.full(count + 1, -1, dtype=np.int64)           # of a beginning that is one
        for on in ends:
            self.piece[node[on]] = on
        rank = {s: r for r, s in enumerate(sorted({s for _, s, _ in model.pieces}, reverse=True))}
        self.rank = np.array([rank[s] for _, s, _ in model.pieces], dtype=np.int64)     # 0 is the best score
        self.ids = np.array([i for _, _, i in model.pieces], dtype=np.int32)
        self.first_byte, self.unknown = model.first_byte, model.unknown

    def edges(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, end, piece) of every piece that lies at one of the places ``start`` before its ``stop``."""
        at, node, found, d = start, np.zeros(len(start), np.int64), [], 0
        while len(at):
            key = (node << 8) + data[at + d]
            k = np.searchsorted(self.steps, key)
            d += 1
            good = np.flatnonzero(self.steps[k] == key)
            at, stop, node = at[good], stop[good], k[good] + 1
            hit = np.flatnonzero(self.piece[node] >= 0)
            found.append((at[hit], at[hit] + d, self.piece[node[hit]]))
            on = np.flatnonzero(at + d < stop)
            at, stop, node = at[on], stop[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def encode(self, source: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the spans ``source[lo:hi]``, end to end, and how many each has."""
        n = hi - lo
        data = source[np.repeat(lo, n) + _ramp(n)]
        begin = np.cumsum(n) - n
        end = begin + n
        segment = np.repeat(np.arange(len(n)), n)
        bound = (data & 0xC0) != 0x80                                    # characters begin here
        start = np.flatnonzero(bound)
        i, k, piece = self.edges(data, start, end[segment[start]])
        longer = np.flatnonzero(np.append(np.cumsum(bound), bound.sum())[k - 1] - np.cumsum(bound)[i] > 0)
        seg = segment[i[longer]]
        order = longer[np.lexsort((i[longer], self.rank[piece[longer]], seg))]
        seg = segment[i[order]]
        first = np.searchsorted(seg, np.arange(len(n) + 1))
        stays = self._swept(bound, begin, n, i[order], k[order], first)
        for s in np.flatnonzero(~stays[1]).tolist():
            moves = order[first[s]:first[s + 1]]
            stays[0][begin[s]:end[s]] = self._folded(bound[begin[s]:end[s]], i[moves] - begin[s], k[moves] - begin[s], self.rank[piece[moves]])
        left = stays[0]
        # an edge between neighbouring bounds is a token; characters left over become bytes
        after = np.cumsum(left)
        last = np.append(after, 0)[k - 1]
        whole = np.flatnonzero(left[i] & (last == after[i]) & ((k == end[segment[i]]) | np.append(left, True)[k]))
        ids = np.full(len(data), -1, dtype=np.int32)
        ids[i[whole]] = self.ids[piece[whole]]
        bare = left & (ids < 0)
        if self.first_byte is None:
            ids[bare] = self.unknown
        else:
            char = np.cumsum(bound) - 1
            out = np.flatnonzero(bare[start][char])
            ids[out] = self.first_byte + data[out].astype(np.int32)
        some = ids >= 0
        return ids[some], np.bincount(segment[some], minlength=len(n))

    @staticmethod
    def _swept(bound, begin, n, i, k, first) -> tuple[np.ndarray, np.ndarray]:
        """Bounds after one pass over the merges of each segment in their order, and whether it settles the segment:
        not if a merge comes up while its span is in three parts or more, nor where bounds do not fit in 64 bits."""
        one, many = np.uint64(1), np.diff(first)
        small = n < 64
        place = np.arange(len(bound)) - np.repeat(begin, n)
        bit = np.where(bound, one << (place & 63).astype(np.uint64), np.uint64(0))
        mask = np.bitwise_or.reduceat(bit, begin) if len(n) else np.zeros(0, np.uint64)
        mask = mask | (one << (n & 63).astype(np.uint64))
        sure = small.copy()
        rows = np.flatnonzero(small & (many > 0))
        base = np.repeat(begin, many)
        x, y = (i - base) & 63, (k - base) & 63
        ends = (one << x.astype(np.uint64)) | (one << y.astype(np.uint64))
        inner = (one << y.astype(np.uint64)) - (one << (x + 1).astype(np.uint64))
        t = 0
        while len(rows):
            e = first[rows] + t
            m = mask[rows]
            parts = np.bitwise_count(m & inner[e])
            fits = (m & ends[e]) == ends[e]
            mask[rows] = np.where(fits & (parts == 1), m & ~inner[e], m)
            later = fits & (parts > 1)
            sure[rows[later]] = False
            t += 1
            rows = rows[~later & (many[rows] > t)]
        left = bound & ((np.repeat(mask, n) >> (place & 63).astype(np.uint64) & one) == 1)
        return left, sure

    @staticmethod
    def _folded(bound, i, k, rank) -> np.ndarray:
        """Bounds of one segment after its merges, step by step: best first, then leftmost."""
        n = len(bound)
        marks = [*np.flatnonzero(bound).tolist(), n]
        after, before = dict(zip(marks, marks[1:])), dict(zip(marks[1:], marks))
        best = {(x, y): r for x, y, r in zip(i.tolist(), k.tolist(), rank.tolist())}
        heap = [(best[x, z], x, z) for x, z in zip(marks, marks[2:]) if (x, z) in best]
        heapq.heapify(heap)
        while heap:
            _, x, z = heapq.heappop(heap)
            y = after.get(x)
            if y is None or after.get(y) != z:
                continue
            del after[y], before[y]
            after[x], before[z] = z, x
            for pair in ((before.get(x), z), (x, after.get(z))):
                if pair in best:
                    heapq.heappush(heap, (best[pair], *pair))
        out = np.zeros(n, dtype=bool)
        out[list(after)] = True
        return out


# ---- texts -------------------------------------------------------------------

class Dictionary:
    """Frequent segments by hash; position = place in the table."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, at: np.ndarray):
        """``hashes`` of the segments; the ids of segment i are ``ids[at[i]:at[i + 1]]``."""
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]
        self.ids, self.at = ids, at

    @classmethod
    def of(cls, batches: list[pa.RecordBatch]) -> Dictionary:
        """From (hash, ids) batches; each is let go once its numbers are copied."""
        hashes, ids, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        while batches:
            b = batches.pop()
            hashes.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            ids.append(b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32))
            sizes.append(pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        return cls(np.concatenate(hashes), np.concatenate(ids), np.cumsum(np.concatenate(sizes)))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each segment, -1 where it is not in the table."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1).astype(np.int64)


def _pack(places: np.ndarray) -> bytes:
    """Places as three planes of bytes, compressed (0 marks a segment outside the table)."""
    v = (places + 1).astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v[:, :3].T).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    v = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(3, -1).astype(np.int64)
    return v[0] + (v[1] << 8) + (v[2] << 16) - 1


def dictionary(docs: DataFrame, model: Model, hot: int = HOT) -> Dictionary:
    """The ``hot`` most frequent segments (all counts as frequent as the last, or fewer) with their ids."""
    hot = min(hot, (1 << 24) - 2)
    counts = settled(counted(docs, model.apart).where((F.col("n") > 1) & (F.octet_length("word") <= HOT_BYTES)), "pieces-counts")
    steps = counts.groupBy("n").count().orderBy(F.desc("n")).collect()       # distinct counts, far fewer than words
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > hot:
            break
        least = r["n"]
    if least is None:
        return Dictionary.of([])
    # spread by word first: the edges of a word are then grouped where they are made
    chosen = counts.where(F.col("n") >= least).select("word").repartition("word")
    return Dictionary.of(encoded_words(chosen, model).select("word", "ids").mapInArrow(lean(_hashed), "h long, ids array<int>").toArrow().to_batches())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, ids) of (word, ids): words stay on the executors."""
    for b in batches:
        offsets, data = W._string_parts(b.column(0))
        h = W._word_hashes(data[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]) if b.num_rows else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(1)], ["h", "ids"])


def decode(ids: np.ndarray, at: np.ndarray, texts: list[bytes]) -> list[bytes]:
    """Bytes of runs of ids (``at``: their limits), without the dummy space."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = size[ids]
    end = np.concatenate([[0], np.cumsum(n)])
    raw = flat[np.repeat(begin[ids] - end[:-1], n) + np.arange(end[-1])].tobytes() if len(ids) else b""
    return [raw[x + 1 if y > x and raw[x:x + 1] == b" " else x:y] for x, y in zip(end[at[:-1]].tolist(), end[at[1:]].tolist())]


def decoded(tokens: DataFrame, model: Model, ids_col: str = "ids") -> DataFrame:
    """``tokens`` plus ``decoded``, the text of its ids (null ids: null)."""
    schema = StructType([*tokens.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(ids_col).to_pylist()
            flat = np.array([i for r in rows for i in (r or [])], dtype=np.int64)
            at = np.concatenate([[0], np.cumsum([len(r or []) for r in rows], dtype=np.int64)])
            text = [t.decode("utf-8", "replace") if r is not None else None for t, r in zip(decode(flat, at, model.texts), rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, "decoded"])

    return tokens.mapInArrow(run, schema)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip (decoding the ids gives the text) of every row."""
    spark = docs.sparkSession
    small_batches(spark, 4 * CUT_BYTES)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    book = spark.sparkContext.broadcast(dictionary(rows, model, hot))       # at most ``hot`` short segments
    if model.bpe:
        return _encoded_in_place(rows, model, book)
    apart = model.apart
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for c, data, lo, hi, row, h in _cuts(b.column(1), apart):
                at = np.flatnonzero(book.value.find(h) < 0)
                order = at - np.searchsorted(row, row[at])                  # place of the segment in its text
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[c.first + row[at]]), pa.array(order.astype(np.int32)),
                     pa.array([raw[x:y].decode() for x, y in zip(lo[at].tolist(), hi[at].tolist())], pa.string())],
                    ["key", "pos", "word"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for c, _, _, _, row, h in _cuts(b.column(2), apart):
                place = book.value.find(h)
                at = np.searchsorted(row, np.arange(c.rows + 1))
                out += [_pack(place[x:y]) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(out, pa.binary())],
                                             ["key", "doc_id", "mark", "packed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    others = encoded_words(keyed.select("key", "text").mapInArrow(lean(cold), "key long, pos int, word string").repartition("key"), model)
    # repeated rows share a key and bring the same segments
    per_text = others.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("pos", "ids"))).alias("cold"))
    texts = keyed.select("key", "doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(
        lean(packed), f"key long, doc_id {kind}, mark long, packed binary")
    joined = texts.join(per_text, "key", "left").select("doc_id", "mark", "packed", "cold")
    pieces = model.texts

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(lo, 256) for whole in batches for lo in range(0, whole.num_rows, 256)):
            table, ids = book.value, []
            for raw, extra in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                place = _unpack(raw)
                hit = np.maximum(place, 0)
                size = np.where(place >= 0, table.at[hit + 1] - table.at[hit] if len(table.ids) else 0, 0)
                missing = np.flatnonzero(place < 0)
                if len(missing) != len(extra or []):
                    raise RuntimeError("segments of a text are missing")
                fills = [np.array(x["ids"], dtype=np.int32) for x in extra or []]
                size[missing] = [len(x) for x in fills]
                end = np.cumsum(size)
                out = np.empty(int(end[-1]) if len(end) else 0, dtype=np.int32)
                known = np.flatnonzero(place >= 0)
                if len(known):
                    n = size[known]
                    to = np.repeat(end[known] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    out[to] = table.ids[np.repeat(table.at[place[known]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                for k, x in zip(missing.tolist(), fills):
                    out[end[k] - len(x):end[k]] = x
                ids.append(out)
            at = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
            flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
            backs = [t.decode("utf-8", "replace") for t in decode(flat, at, pieces)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(at), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)), pa.array(backs, pa.string())],
                ["doc_id", "mark", "n_tokens", "ids", "back"])

    done = joined.mapInArrow(lean(assemble), f"doc_id {kind}, mark long, n_tokens long, ids array<int>, back string")
    return done.select("doc_id", "n_tokens", "ids", (F.xxhash64("back") == F.col("mark")).alias("round_trip"))


def _encoded_in_place(rows: DataFrame, model: Model, book) -> DataFrame:
    """``encode`` in one pass over the texts: ids from the dictionary, all other segments by their lattice."""
    apart, pieces = model.apart, model.texts
    rules = rows.sparkSession.sparkContext.broadcast(Lattice(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, lat = book.value, rules.value
        for b in batches:
            for c, data, lo, hi, row, h in _cuts(b.column(1), apart):
                place = table.find(h)
                known, cold = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
                size = np.zeros(len(h), dtype=np.int64)
                size[known] = np.diff(table.at)[place[known]]
                more, size[cold] = lat.encode(data, lo[cold], hi[cold])
                end = np.concatenate([[0], np.cumsum(size)])
                flat = np.empty(int(end[-1]), dtype=np.int32)
                for part, source, begin in ((known, table.ids, table.at[place[known]]),
                                            (cold, more, np.cumsum(size[cold]) - size[cold])):
                    n, step = size[part], _ramp(size[part])
                    flat[np.repeat(end[part], n) + step] = source[np.repeat(begin, n) + step]
                at = end[np.searchsorted(row, np.arange(c.rows + 1))]
                own = c.data.tobytes()
                same = [x == own[y:z] for x, y, z in zip(decode(flat, at, pieces), c.base[:-1].tolist(), c.base[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.first, c.rows), pa.array(np.diff(at), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "round_trip"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n_tokens long, ids array<int>, round_trip boolean")
