"""Line dedup: which lines of every document stay, as compressed bitmaps.

1. *Keys.* Each line is stripped, lower-cased and hashed to 128 bits (two 64-bit hashes);
   a document becomes one slim row of (position, hash) pairs, written once. Lines shorter
   than ``min_chars`` have no key and always stay.
2. *Order.* The pairs are range-partitioned by hash with document (largest first) and
   position as secondary sort columns, so a line that a third of all documents hold is
   spread over many ranges.
3. *Stream.* Inside a range the rows of a key are read in that order; a row whose document
   differs from the one before opens a document of the key. Each (key, range) leaves one
   summary: documents opened, first and last document. The summaries of a key (one a range
   at most) give its number of documents, less those that straddle two ranges, and its first
   occurrence: the largest document of the first range.
4. *Bitmaps.* Rows of keys with ``min_docs`` documents or more that lie outside the first
   document are dropped lines. They go back to their documents as run containers: ``keep``
   lists the runs (start, length) of lines that stay. No text is returned or shuffled;
   ``restore`` applies the bitmaps to the texts where they are wanted.

Only DataFrame functions run here.

Defined cases: a null text counts as empty, and an empty text is one empty line; rows that
share an id are one document (it counts once, and where it is the largest of a key all of its
rows keep the line), each with the bitmap of its own text; a null id is a document like any
other and the smallest; equal rows share one bitmap, and ``restore`` gives each row back; an
empty table gives an empty result; extra columns are ignored by ``keep_bitmaps`` and carried
whole by ``restore``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotplan.operators.windows import range_chunks

from .common import settled

MIN_CHARS = 40
MIN_DOCS = 5
_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = "array<struct<start:int,length:int>>"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_hashes(text: Column) -> list[Column]:
    """128 bits that stand for a whole text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc, t1, t2, n_lines and ``keys``: (pos, h1, h2) of the lines that have a key."""
    lines = docs.select(F.col(id_col).alias("doc"), *text_hashes(F.col(text_col)), lines_of(F.col(text_col)).alias("lines"))

    def key(line: Column, pos: Column) -> Column:
        folded = F.translate(line, _UPPER, _LOWER)
        return F.when(F.length(line) >= min_chars, F.struct(
            pos.cast("int").alias("pos"), F.xxhash64(folded).alias("h1"), F.xxhash64(F.lit(1), folded).alias("h2")))

    stripped = F.transform("lines", lambda line: F.btrim(line, F.lit(_BLANK)))
    return lines.select("doc", "t1", "t2", F.size("lines").cast("long").alias("n_lines"),
                        F.filter(F.transform(stripped, key), lambda k: k.isNotNull()).alias("keys"))


def dropped(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc, t1, t2, pos) of the lines that go. ``lines``: doc, t1, t2, pos, h1, h2."""
    # documents in falling order: negative places are avoided by sorting on a flag and the id itself
    order = ["h1", "h2", F.desc("doc"), "t1", "t2", "pos"]
    ranged = range_chunks(lines, order)
    stream = Window.partitionBy("_chunk", "h1", "h2").orderBy(F.desc("doc"), "t1", "t2", "pos")
    opened = ranged.select("_chunk", "h1", "h2", "doc", (
        (F.row_number().over(stream) == 1) | ~F.col("doc").eqNullSafe(F.lag("doc").over(stream))).alias("opens"))
    # a struct keeps null documents in minima and maxima (null is the smallest)
    place = F.struct("doc")
    parts = opened.groupBy("_chunk", "h1", "h2").agg(
        F.count_if("opens").alias("n"), F.max(place).alias("first"), F.min(place).alias("last"))
    by_key = Window.partitionBy("h1", "h2")
    along = by_key.orderBy("_chunk")
    straddles = F.coalesce(F.lag("last").over(along).eqNullSafe(F.col("first")), F.lit(False)) & (F.row_number().over(along) > 1)
    totals = (parts.withColumn("n", F.col("n") - straddles.cast("long"))
              .withColumn("n_docs", F.sum("n").over(by_key)).withColumn("keeper", F.max("first").over(by_key))
              .where(F.col("n_docs") >= min_docs).select("_chunk", "h1", "h2", "keeper"))
    # joined by range and key: a frequent key meets its own ranges, not one task
    totals = settled(totals, "line-totals")
    return (ranged.join(totals, ["_chunk", "h1", "h2"])
            .where(~F.col("doc").eqNullSafe(F.col("keeper.doc"))).select("doc", "t1", "t2", "pos"))


def runs(n_lines: Column, gone: Column) -> Column:
    """Runs (start, length) of kept lines; ``gone``: sorted positions of dropped ones."""
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(n_lines.cast("int")))
    gaps = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(gaps, lambda r: r["length"] > 0).cast(_RUNS)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per distinct (id, text): doc, t1, t2 (hashes of the text), n_lines, n_dropped and ``keep``."""
    slim = settled(keyed_lines(docs, id_col, text_col, min_chars), "line-keys")
    lines = slim.select("doc", "t1", "t2", F.explode("keys").alias("k")).select("doc", "t1", "t2", "k.*")
    # equal rows bring the same positions
    gone = settled(dropped(lines, min_docs).groupBy("doc", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("gone")),
                   "line-gone").select(F.col("doc").alias("_d"), F.col("t1").alias("_1"), F.col("t2").alias("_2"), "gone")
    at = [F.col("doc").eqNullSafe(F.col("_d")), F.col("t1") == F.col("_1"), F.col("t2") == F.col("_2")]
    none = F.array().cast("array<int>")
    return (slim.select("doc", "t1", "t2", "n_lines").distinct().join(gone, at, "left")
            .withColumn("gone", F.coalesce("gone", none))
            .select("doc", "t1", "t2", "n_lines", F.size("gone").cast("long").alias("n_dropped"),
                    runs(F.col("n_lines"), F.col("gone")).alias("keep")))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of the runs, joined by line ends."""
    bound = F.transform(F.array(lines_of(text)), lambda lines: F.flatten(
        F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))))
    return F.array_join(F.get(bound, F.lit(0)), "\n")


def restore(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` as one struct), n_lines, n_dropped, keep and kept_text of every row.

    Texts that lose nothing are not cut, and only bitmaps that drop lines are joined.
    """
    cuts = bitmaps.where("n_dropped > 0").select(
        F.col("doc").alias("_d"), F.col("t1").alias("_1"), F.col("t2").alias("_2"), "n_dropped", "keep")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    id_, text = F.col("row")[id_col], F.col("row")[text_col]
    rows = rows.select("row", id_.alias("_id"), *text_hashes(text), F.size(lines_of(text)).cast("long").alias("n_lines"))
    at = [F.col("_id").eqNullSafe(F.col("_d")), F.col("t1") == F.col("_1"), F.col("t2") == F.col("_2")]
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").cast("int").alias("length"))).cast(_RUNS)
    return (rows.join(cuts, at, "left")
            .select("row", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                    F.coalesce("keep", whole).alias("keep"),
                    F.when(F.col("keep").isNull(), F.coalesce(text, F.lit(""))).otherwise(kept_text(text, F.col("keep"))).alias("kept_text")))
