"""Alignment of two tokenizers over a corpus, in Arrow.

Both vocabularies spell a text in bytes, so their tokens tile the same byte range. A batch of
documents (about ``SLICE_BYTES`` of text) goes through Arrow kernels only:

* the token lists are flattened, with the parent index of every token; byte ends are segmented
  cumulative sums of token lengths;
* tokens are joined on the key (document, end) by Acero's hash join. Rows found on both sides are
  the cuts between *groups*; the full outer join in order of the key is the list of *links*: an
  overlapping pair of tokens ends where the earlier of the two ends, so every end is one link;
* links are dictionary-encoded as id pairs, and ``Table.group_by`` counts, per pair, the documents
  of the batch that hold it.

A batch becomes one row: its documents' results, its pairs with their partial counts, and the
links as packed places in its list of pairs. Spark merges the partial counts by pair, and the best
count of an A id is a maximum over pairs (as many rows as the vocabulary, the only table that is
broadcast). Every batch then gets the counts of its own pairs back, one row per batch and
pair, so a pair that all documents hold is a join key with one slim row per batch, and neither
texts nor tokens are shuffled by pair.

Defined cases: null and empty texts, and texts that a side does not spell back byte for byte
(such as a literal white-space mark U+2581), have no tokens: zeros and an empty digest; special
tokens inside texts are plain text; rows that share an id, and rows without an id, are documents
of their own and count each; an empty table gives an empty result; a very long text makes a batch
of its own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import settled, small_batches

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
SLICE_BYTES = 2 << 20    # texts that are aligned together; a longer text stands alone
# FIXED VALUE: how byte-level BPE files of this kind cut a text before merging
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---- vocabularies --------------------------------------------------------------

def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE file; texts get a space in front."""

    def __init__(self, raw: bytes):
        import tiktoken
        spec = json.loads(raw)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex"):
            raise ValueError("only byte-level BPE files without normalisation and prefix are read")
        to_byte = byte_level()
        self.texts = [b""] * (max(model["vocab"].values()) + 1)
        for token, i in model["vocab"].items():
            self.texts[i] = bytes(to_byte[c] for c in token)
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("ids do not follow the order of the merges")
        self._coder = tiktoken.Encoding("file", pat_str=_CUTS, mergeable_ranks={t: i for i, t in enumerate(self.texts) if t}, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._coder.encode_ordinary(" " + text), dtype=np.int32)


class Pieces:
    """A piece model that puts a space in front itself."""

    def __init__(self, raw: bytes):
        import sentencepiece
        self._coder = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.texts = []
        for i in range(self._coder.get_piece_size()):
            piece = self._coder.id_to_piece(i)
            if self._coder.is_byte(i):
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.texts.append(b"" if self._coder.is_control(i) else piece.replace(_MARK, " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._coder.encode(text), dtype=np.int32)


class Side:
    """A tokenizer with Arrow tables of its tokens' bytes, lengths and decimal names."""

    def __init__(self, coder, stops: tuple[str, str]):
        self.coder = coder
        self.bytes = pa.array(coder.texts, pa.binary())
        self.lengths = pc.binary_length(self.bytes).cast(pa.int64())
        # names with the mark that follows a token: inside a group, at its end
        self.names = [pa.array([f"{i}{s}".encode() for i in range(len(coder.texts))], pa.binary()) for s in stops]

    def __len__(self) -> int:
        return len(self.lengths)

    def encode(self, texts: list[str]) -> pa.ListArray:
        runs = [self.coder.encode(t) if t else np.zeros(0, np.int32) for t in texts]
        ends = np.cumsum([0, *map(len, runs)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs)))


@lru_cache(maxsize=4)
def sides(a: bytes, b: bytes) -> tuple[Side, Side]:
    """Both tokenizers from their files, built once per Python worker."""
    return Side(ByteBpe(a), (",", "|")), Side(Pieces(b), (",", ";"))


# ---- one batch -------------------------------------------------------------------

def spelled(tokens: pa.ListArray, side: Side, want: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every document: do its tokens' bytes equal its part of ``want`` (cut at ``starts``)?"""
    ids, parents = pc.list_flatten(tokens), pc.list_parent_indices(tokens).to_numpy()
    sizes = np.bincount(parents, weights=side.lengths.take(ids).to_numpy(), minlength=len(tokens)).astype(np.int64)
    good = sizes == np.diff(starts)
    if not good.all():                       # compare the rest only
        keep = good[parents]
        ids = ids.filter(pa.array(keep))
        want = want[np.repeat(good, np.diff(starts))]
        starts = np.concatenate([[0], np.cumsum(np.diff(starts)[good])])
    taken = side.bytes.take(ids)
    have = np.frombuffer(taken.buffers()[2] or b"", dtype=np.uint8)[:len(want)]
    off = np.flatnonzero(have != want)
    if len(off):
        wrong = np.flatnonzero(good)[np.unique(np.searchsorted(starts, off, side="right") - 1)]
        good[wrong] = False
    return good


@dataclass
class Flat:
    """Tokens of a batch, flattened: ids, parent document and key (document, end) in one number."""
    ids: pa.Array
    parents: pa.Array
    keys: pa.Array

    @classmethod
    def of(cls, tokens: pa.ListArray, side: Side, stride: int) -> Flat:
        ids, parents = pc.list_flatten(tokens), pc.list_parent_indices(tokens).cast(pa.int64())
        running = pc.cumulative_sum(side.lengths.take(ids))
        # segmented: less the running sum before the document
        before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(tokens.offsets)
        ends = pc.subtract(running, before.take(parents))
        return cls(ids, parents, pc.add(pc.multiply(parents, stride), ends))


def links_of(a: Flat, b: Flat) -> pa.Table:
    """key, a, b (token ids) of all links in order, and ``cut``: both tokens end here."""
    left = pa.table({"key": a.keys, "a": a.ids})
    right = pa.table({"key": b.keys, "b": b.ids})
    both = left.join(right, "key", join_type="full outer", use_threads=False).combine_chunks()
    both = both.take(pc.sort_indices(both["key"]))
    cut = pc.and_(pc.is_valid(both["a"]), pc.is_valid(both["b"]))
    # the last end of a document is on both sides, so a fill never leaves its document
    return pa.table({"key": both["key"], "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]), "cut": cut})


def digests(a: Flat, b: Flat, side_a: Side, side_b: Side, cuts: np.ndarray, n_docs: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document. ``cuts``: keys of the group ends, rising."""
    keys = (a.keys.to_numpy(), b.keys.to_numpy())
    last = [np.searchsorted(k, cuts, side="right") for k in keys]          # tokens up to each group's end
    group = [np.repeat(np.arange(len(cuts)), np.diff(x, prepend=0)) for x in last]
    pick = np.empty(len(keys[0]) + len(keys[1]), dtype=np.int64)
    table, base = [], 0
    for side, flat, own, other, mine in ((side_a, a, 0, 1, 0), (side_b, b, 1, 0, 1)):
        at_end = np.zeros(len(flat.ids), dtype=np.int64)
        at_end[last[own] - 1] = 1
        # tokens of the other side that stand before: of earlier groups for A, of this one too for B
        upto = last[other] if mine else np.concatenate([[0], last[other][:-1]])
        place = np.arange(len(flat.ids)) + upto[group[own]]
        pick[place] = base + flat.ids.to_numpy() + at_end * len(side)
        table += side.names
        base += 2 * len(side)
    names = pa.concat_arrays(table).take(pa.array(pick))
    raw = memoryview(names.buffers()[2]) if len(names) else memoryview(b"")
    offsets = np.frombuffer(names.buffers()[1], dtype=np.int32) if len(names) else np.zeros(1, np.int32)
    n_tokens = sum(np.bincount(f.parents.to_numpy(), minlength=n_docs) for f in (a, b))
    ends = np.concatenate([[0], np.cumsum(n_tokens)])
    limits = offsets[ends].tolist()
    return [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(limits, limits[1:])]


def packed(places: np.ndarray) -> bytes:
    """Places below 2^24 as three planes of bytes, compressed."""
    planes = np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    p = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(3, -1).astype(np.int32)
    return p[0] + (p[1] << 8) + (p[2] << 16)


def aligned(texts: list[str | None], side_a: Side, side_b: Side) -> dict:
    """Results of one batch: per document, per pair, and its links as places in the pairs."""
    n_docs = len(texts)
    texts = [t or "" for t in texts]
    raws = [b" " + t.encode() if t else b"" for t in texts]
    want = np.frombuffer(b"".join(raws), dtype=np.uint8)
    starts = np.cumsum([0, *map(len, raws)])
    tokens = [side_a.encode(texts), side_b.encode(texts)]
    good = spelled(tokens[0], side_a, want, starts) & spelled(tokens[1], side_b, want, starts)
    if not good.all():
        tokens = [pa.array([x if g else [] for x, g in zip(t.to_pylist(), good.tolist())], pa.list_(pa.int32())) for t in tokens]
    stride = int(np.diff(starts).max(initial=0)) + 1
    a, b = Flat.of(tokens[0], side_a, stride), Flat.of(tokens[1], side_b, stride)
    links = links_of(a, b)
    keys, cut = links["key"].to_numpy(), links["cut"].to_numpy()
    doc = keys // stride
    pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), len(side_b)), links["b"].cast(pa.int64()))
    coded = pa.concat_arrays(pair.chunks or [pa.array([], pa.int64())]).dictionary_encode()
    pairs, codes = coded.dictionary, coded.indices.to_numpy()
    # documents per pair: distinct (document, pair) first
    held = pc.unique(pa.array(doc * max(1, len(pairs)) + codes))
    per_pair = pa.table({"code": pc.subtract(held, pc.multiply(pc.divide(held, max(1, len(pairs))), max(1, len(pairs))))})
    counts = per_pair.group_by("code", use_threads=False).aggregate([([], "count_all")]).sort_by("code")
    return {
        "n_a": np.diff(tokens[0].offsets.to_numpy()), "n_b": np.diff(tokens[1].offsets.to_numpy()),
        "n_groups": np.bincount(doc[cut], minlength=n_docs), "n_links": np.bincount(doc, minlength=n_docs),
        "groups_sha256": digests(a, b, side_a, side_b, keys[cut], n_docs),
        "pairs": pairs, "held": counts["count_all"], "codes": codes,
    }


# ---- the corpus --------------------------------------------------------------------

def _batch_schema(kind) -> StructType:
    longs = ArrayType(LongType())
    return StructType([
        StructField("batch", LongType()), StructField("ids", ArrayType(kind)),
        *[StructField(c, longs) for c in ("n_a", "n_b", "n_groups", "n_links")],
        StructField("groups_sha256", ArrayType(StringType())), StructField("pairs", longs),
        StructField("held", ArrayType(IntegerType())), StructField("links", BinaryType())])


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text (column 1)."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def aligned_batches(docs: DataFrame, files: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """One row per slice of an Arrow batch of documents (see the module)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b = sides(*files.value)
        part, at = TaskContext.get().partitionId(), 0
        for b in (piece for whole in batches for piece in slices(whole, SLICE_BYTES)):
            r = aligned(b.column(1).to_pylist(), side_a, side_b)
            one = lambda x, t: pa.array([x], pa.list_(t))
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0))
            lists = pa.ListArray.from_arrays
            whole = lambda x: lists(pa.array([0, len(x)], pa.int32()), x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + at]), ids, *[one(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                 one(r["groups_sha256"], pa.string()), whole(r["pairs"].cast(pa.int64())), whole(r["held"].cast(pa.int32())),
                 pa.array([packed(r["codes"])], pa.binary())],
                ["batch", "ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "held", "links"])
            at += 1

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _batch_schema(rows.schema["doc_id"].dataType))


def pair_counts(batches: DataFrame, n_b: int) -> DataFrame:
    """pair, a, b and n_docs: how many documents hold the pair linked, corpus-wide."""
    parts = batches.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    return (parts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n_docs"))
            .withColumn("a", F.expr(f"cast(pair div {n_b} as int)")).withColumn("b", F.expr(f"cast(pair % {n_b} as int)")))


def align(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(a_path, "rb") as fa, open(b_path, "rb") as fb:
        raw = fa.read(), fb.read()
    files = spark.sparkContext.broadcast(raw)                    # two vocabulary files
    batches = settled(aligned_batches(docs, files, id_col, text_col), "align-batches")
    counts = settled(pair_counts(batches, len(Pieces(raw[1]).texts)), "align-pairs")
    best = counts.groupBy("a").agg(F.max("n_docs").alias("best"))      # one row per id of A at most
    judged = counts.join(F.broadcast(best), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("best")).alias("is_best"))
    own = (batches.select("batch", F.posexplode("pairs").alias("code", "pair"))
           .join(judged, "pair").select(F.col("batch").alias("of"), "code", "n_docs", "is_best"))
    kind = docs.schema[id_col].dataType
    out = StructType([StructField("doc_id", kind), *[StructField(c, LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                      StructField("groups_sha256", StringType())])

    def finish(batch: pa.Table, found: pa.Table) -> pa.Table:
        flat = {c: pc.list_flatten(batch[c]) for c in ("ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        code = found["code"].to_numpy()
        n_docs, is_best = np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=np.int64)
        n_docs[code], is_best[code] = found["n_docs"].to_numpy(), found["is_best"].cast(pa.int64()).to_numpy()
        links = unpacked(batch["links"][0].as_py())
        ends = np.concatenate([[0], np.cumsum(flat["n_links"].to_numpy())])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[links])])[ends])
        return pa.table([flat["ids"], flat["n_a"], flat["n_b"], flat["n_groups"], flat["n_links"],
                         pa.array(total(is_best), pa.int64()), pa.array(total(n_docs), pa.int64()), flat["groups_sha256"]],
                        names=out.names)

    slim = batches.drop("pairs", "held")
    return slim.groupBy("batch").cogroup(own.groupBy("of")).applyInArrow(finish, out)
