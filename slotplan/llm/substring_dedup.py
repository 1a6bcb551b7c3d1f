"""Substring dedup: winnowed anchors, extended to maximal repeats of ``LENGTH`` words.

Every window of ``LENGTH`` words picks the smallest hash among its ``SEED``-word
grams (winnowing, leftmost on ties). Equal windows pick the same gram at the same
place, so repeats always meet at a shared *anchor*. The windows that one anchor
serves in one text are consecutive: a *run*, whose words reach from its first
window's start to its last window's end.

1. Anchors are counted; one that occurs once repeats nothing.
2. Runs with equal anchor and equal words (``sig``) are repeats as a whole. Most
   copied text ends here, without looking at single windows.
3. Other runs of shared anchors are extended: one text per distinct run gives the
   hashes of its windows, and equal hashes under one anchor are repeats.
4. Windows merge into maximal ranges of words, which are cut.

All counting is aggregated before the shuffle, so an anchor that a third of all
texts holds is never gathered. Hashes have 64 bits, and two of them must agree.

Defined cases: null, empty and short texts keep all words; a repeated row repeats
all windows of its text (both lose them); every occurrence is cut, the first too;
an empty table gives an empty result; extra columns, whatever their names, stay in
``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import words as W
from .common import settled, sized

LENGTH = 35
SEED = 8


def runs(chunk: W.Chunk, length: int = LENGTH, seed: int = SEED):
    """Per run of the chunk: anchor hash, hash of its words, row, first window, windows."""
    start = W.gram_starts(chunk, length)
    none = np.zeros(0, dtype=np.int64)
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    h = chunk.hashes()
    grams = W.run_hashes(h, np.arange(len(h) - seed + 1), np.arange(seed, len(h) + 1))
    view = np.lib.stride_tricks.sliding_window_view(grams, length - seed + 1)
    anchor = start + view[start].argmin(axis=1)
    doc = chunk.doc[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    lo = np.flatnonzero(new)
    count = np.diff(np.append(lo, len(start)))
    sig = W.run_hashes(h, start[lo], start[lo] + count - 1 + length)
    return grams[anchor[lo]], sig, doc[lo], start[lo] - chunk.at[doc[lo]], count


def _anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(a, sig, key, lo, n) of every run; ``docs``: key, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for c in W.chunks(b.column(1)):
                a, sig, doc, lo, n = runs(c, length, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(sig.view(np.int64)), pa.array(keys[c.first + doc]),
                     pa.array(lo, pa.int32()), pa.array(n, pa.int32())], ["a", "sig", "key", "lo", "n"])

    return docs.mapInArrow(run, "a long, sig long, key long, lo int, n int")


def _windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, at, g) of each window of the wanted runs: g identifies anchor and words.

    ``wanted``: key, runs (array of a, lo, n).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, asked = b.column(0).to_pylist(), b.column(2).to_pylist()
            for c in W.chunks(b.column(1)):
                parts = [(r["a"], c.at[i] + r["lo"], r["n"], i) for i in range(c.rows) for r in asked[c.first + i]]
                if not parts:
                    continue
                a, lo, n, row = (np.array(x) for x in zip(*parts))
                at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes = W.run_hashes(c.hashes(), at, at + length)
                g = W.mix(hashes ^ W.mix(np.repeat(a, n).astype(np.int64).view(np.uint64)))
                row = np.repeat(row, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(keys, dtype=np.int64)[c.first + row]), pa.array((at - c.at[row]).astype(np.int32)),
                     pa.array(g.view(np.int64))], ["key", "at", "g"])

    return docs.join(sized(wanted, "runs"), "key").select("key", "text", "runs").mapInArrow(run, "key long, at int, g long")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(key, ranges): word ranges [lo, hi) covered by repeats; ``docs``: key, text."""
    anchors = _anchors(docs, length, seed)
    shared = settled(anchors.groupBy("a").agg(F.count(F.lit(1)).alias("c"), F.min("sig").alias("x"), F.max("sig").alias("y"))
                     .where("c > 1").select("a", (F.col("x") == F.col("y")).alias("same")), "substring-anchors")
    met = settled(anchors.join(sized(shared), "a"), "substring-runs")
    mixed = met.where("not same")
    classes = settled(mixed.groupBy("a", "sig").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "lo", "n")).alias("r")),
                      "substring-classes")
    # runs equal as a whole
    equal = (met.where("same").select("key", "lo", "n")
             .unionByName(mixed.join(classes.where("c > 1").select("a", "sig"), ["a", "sig"]).select("key", "lo", "n")))
    # one text per distinct run, extended window by window
    wanted = settled(classes.select("r.key", F.struct("a", "r.lo", "r.n").alias("run"))
                     .groupBy("key").agg(F.collect_list("run").alias("runs")), "substring-wanted")
    single = settled(_windows(docs, wanted, length), "substring-windows")
    twice = settled(single.groupBy("g").count().where("count > 1").select("g"), "substring-twice")
    windows = single.join(sized(twice), "g").select("key", F.col("at").alias("lo"), F.lit(1).alias("n"))
    covered = equal.unionByName(windows).select("key", "lo", (F.col("lo") + F.col("n") - 1 + length).alias("hi"))
    per_text = covered.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("all"))
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate(
        F.slice("all", 2, F.size("all")), F.slice("all", 1, 1),
        lambda acc, x: F.when(x["lo"] <= last(acc)["hi"], F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last(acc)["lo"].alias("lo"), F.greatest(last(acc)["hi"], x["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(x))))
    return settled(per_text.select("key", merged.alias("ranges")), "substring-ranges")


def _cut(rows: DataFrame) -> DataFrame:
    """``rows``: row, text, ranges -> row, n_words, n_removed, kept_text."""
    schema = StructType([rows.schema["row"], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept_text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranges = b.column(2).to_pylist()
            n_words, n_removed, kept = [], [], []
            for c in W.chunks(b.column(1)):
                for i in range(c.rows):
                    lo, hi = c.at[i], c.at[i + 1]
                    n_words.append(int(hi - lo))
                    cut = ranges[c.first + i] or []
                    n_removed.append(sum(r["hi"] - r["lo"] for r in cut))
                    left, at = [], c.base[i]
                    for r in cut:
                        left.append(c.data[at:c.start[lo + r["lo"]]].tobytes())
                        at = c.end[lo + r["hi"] - 1]
                    left.append(c.data[at:c.base[i + 1]].tobytes())
                    kept.append(b"".join(left).decode("utf-8", "replace"))
            kept = pa.array(kept, pa.string())
            if b.column(1).null_count:
                kept = pa.compute.if_else(b.column(1).is_null(), pa.scalar(None, pa.string()), kept)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), kept],
                ["row", "n_words", "n_removed", "kept_text"])

    return rows.mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """row (a struct of all columns but the text), n_words, n_removed, kept_text.

    A cut takes the words and the space between them, not the space around them. The
    kept text of a null text is null.
    """
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    ranges = repeated_ranges(docs.select(key.alias("key"), F.col(text_col).alias("text")), length, seed)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"), key.alias("key"))
    return _cut(rows.join(sized(ranges, "ranges"), "key", "left").select("row", "text", "ranges"))
