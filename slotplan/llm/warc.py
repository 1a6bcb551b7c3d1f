"""WARC archives written and read by Spark, with boundary-chain verification.

Writing: one record per page through Spark's text writer, whose line end closes
the record (``\\r\\n\\r`` + ``\\n``), so each part file is a plain WARC file on any
store that Spark reaches. Equal payloads of at least ``min_dup_bytes`` are kept
once: the smallest page id is a ``response``, the others ``revisit`` it.

Reading: files are read in splits, cut at every occurrence of the magic line.
Each cut is a *candidate* record with a *successor* offset (its own offset plus
its header and declared length). A magic line inside a payload gives a candidate
too. Pointer jumping from offset 0 of each file (reach doubles every round) keeps
only candidates on the chain of true records. A payload that holds the magic is
put together again from its cuts. Text never passes through a window: only
offsets and lengths do. Files of other writers are read too: ``version`` names theirs, ids of any
kind come back as ``record_id``, a block that is no HTTP message is its own payload, and ``.gz``
files (one member per record, as is the custom) are read through Spark's codec.

Defined cases: null html is an empty payload; null url writes no target header;
CR and LF inside a url are written as %0D and %0A; a null page id writes an empty
id and reads back as null; repeated rows with the smallest id are all responses;
an empty table gives no records; extra columns are ignored. A file whose first
bytes are not the magic has no reachable record. A folder of several versions is read
once for each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, settled

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
CRLF = "\r\n"
BLANK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_BLANK_SQL = r"'\r\n\r\n'"


def dedupe(pages: DataFrame, min_dup_bytes: int = 100) -> DataFrame:
    """Pages with payload, its size and digest, and ``first``: the page a revisit refers to."""
    body = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", body.alias("payload"), F.octet_length(body).cast("long").alias("n"),
                     F.sha2(body, 256).alias("digest"))
    # written first, so that Spark knows its size when it plans the join with the payloads
    repeated = settled(p.where(F.col("n") >= min_dup_bytes).groupBy("digest")
                       .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c"))
                       .where("c > 1").select("digest", "first"), "warc-repeated")
    joined = p.join(repeated, "digest", "left")
    other = F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    return joined.withColumn("first", F.when(other, F.col("first")))


def record_text(revisit: Column) -> Column:
    """The whole record but its last line feed, which the text writer adds."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(BLANK))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", ident(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", uri)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", ident(F.col("first")))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block, F.lit("\r\n\r"))


def write_archives(pages: DataFrame, path: str, min_dup_bytes: int = 100, records_per_file: int = 50_000) -> None:
    """Write a folder of WARC files, one record per page."""
    recs = dedupe(pages, min_dup_bytes)
    (recs.select(record_text(F.col("first").isNotNull()).alias("value"))
     .write.option("maxRecordsPerFile", records_per_file).text(path))


def _cuts(spark: SparkSession, path: str, magic: str) -> DataFrame:
    """The files cut at every magic line, in file order by (file, block, row)."""
    raw = spark.read.option("lineSep", magic).text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("row"), F.col("value"))


def _header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def _parsed(cuts: DataFrame) -> DataFrame:
    """Header fields of each cut; ``whole`` where its declared block ends inside the cut."""
    df = cuts.withColumn("head", F.expr(f"substring_index(value, {_BLANK_SQL}, 1)"))
    df = df.withColumn("head_n", F.octet_length("head").cast("long")).withColumn("value_n", F.octet_length("value").cast("long"))
    df = df.withColumn("length", F.expr("try_cast(nullif(regexp_extract(head, '(?im)^Content-Length:[ \\\\t]*([0-9]+)', 1), '') as bigint)"))
    return df.withColumn("whole", F.coalesce(F.col("head_n") + 4 + F.col("length") <= F.col("value_n"), F.lit(False)))


def _payload(value: Column) -> tuple[Column, Column]:
    """(payload bytes, HTTP header) of a whole record that begins after the magic; no HTTP block: null header."""
    http = F.when(F.lower(_header("Content-Type")).startswith("application/http"),
                  F.substring_index(F.substr(value, F.length("head") + 5), BLANK, 1))
    http_n = F.coalesce(F.octet_length(http) + 4, F.lit(0))
    body = F.substr(value.cast("binary"), (F.col("head_n") + 4 + http_n + 1).cast("int"),
                    F.greatest(F.col("length") - http_n, F.lit(0)).cast("int"))
    return body, http


def _described(df: DataFrame) -> DataFrame:
    body, http = _payload(F.col("value"))
    return df.select(
        "path", "block", "row", "off", "value_n", "head_n", "length", "whole", "key",
        _header("WARC-Type").alias("record_type"),
        F.nullif(F.regexp_extract("head", r"(?im)^WARC-Record-ID:[ \t]*<([^>]*)>", 1), F.lit("")).alias("record_id"),
        F.expr("try_cast(nullif(regexp_extract(head, 'WARC-Record-ID:[ \\\\t]*<urn:page:([^>]*)>', 1), '') as bigint)").alias("page_id"),
        F.expr("try_cast(nullif(regexp_extract(head, 'WARC-Refers-To:[ \\\\t]*<urn:page:([^>]*)>', 1), '') as bigint)").alias("refers_to"),
        F.nullif(_header("WARC-Target-URI"), F.lit("")).alias("url"),
        F.regexp_extract("head", r"WARC-Payload-Digest:[ \t]*sha256:([0-9a-f]*)", 1).alias("told"),
        F.when(F.col("whole"), F.regexp_extract(http, r"(?im)^Content-Length:[ \t]*([0-9]+)", 1)).alias("http_length"),
        F.when(F.col("whole"), F.octet_length(body).cast("long")).alias("stored_bytes"),
        F.when(F.col("whole"), F.sha2(body, 256)).alias("stored_digest"))


def candidates(spark: SparkSession, path: str, magic: str = MAGIC) -> DataFrame:
    """Every magic line with its file offset, successor and record fields (settled)."""
    cuts = _parsed(_cuts(spark, path, magic)).withColumn("off", F.lit(None).cast("long")).withColumn("key", F.md5("value"))
    rows = settled(_described(cuts), "warc-cuts")
    # a cut's offset is the sum of the lengths before it in its file; rows carry no text here
    order = Window.partitionBy("path").orderBy("block", "row")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("off", F.coalesce(F.sum("value_n").over(before), F.lit(0).cast("long"))
                            + (F.row_number().over(order) - 2) * len(magic))
            .where("off >= 0"))
    succ = F.col("off") + len(magic) + F.col("head_n") + 4 + F.col("length") + 4
    return settled(rows.withColumn("file", F.xxhash64("path")).withColumn("succ", succ), "warc-candidates")


def reachable(cand: DataFrame, rounds_per_write: int = 3) -> DataFrame:
    """(file, off) of the candidates on the chain from offset 0, by pointer jumping."""
    at = cand.select("file", "off")
    jump = settled(cand.select("file", "off", F.col("succ").alias("to"))
                   .join(at.withColumnRenamed("off", "to"), ["file", "to"], "left_semi"), "warc-jump")
    seen = at.where("off = 0")
    longest = cand.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for i in range(max(0, math.ceil(math.log2(max(1, longest))))):
        step = seen.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        seen = seen.unionByName(step)
        a, b = jump.alias("a"), jump.alias("b")
        jump = (a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.off")))
                .select("a.file", "a.off", "b.to"))
        if (i + 1) % rounds_per_write == 0:
            seen, jump = settled(seen, "warc-seen"), settled(jump, "warc-jump")
    return seen


def read_archives(spark: SparkSession, path: str, version: str = "1.0") -> DataFrame:
    """The true records of a folder of WARC files of one version.

    Columns: record_id, page_id (null for ids of other writers), url, record_type, refers_to,
    payload_bytes, payload_digest, verified (the stored payload has the told digest; true for
    revisits, null where no SHA-256 is told).
    """
    magic = f"WARC/{version}\r\n"
    cand = candidates(spark, path, magic)
    seen = reachable(cand).withColumn("hit", F.lit(True))
    found = settled(cand.join(seen, ["file", "off"], "left").withColumn("hit", F.coalesce("hit", F.lit(False))), "warc-found")
    records = found.where("hit and whole")
    broken = found.where("hit and not whole")
    if not broken.isEmpty():
        records = records.unionByName(_mended(spark, path, found, magic), allowMissingColumns=True)
    revisit = F.col("record_type") == "revisit"
    told_bytes = F.expr("try_cast(nullif(http_length, '') as bigint)")
    told = F.nullif(F.col("told"), F.lit(""))
    return records.select(
        "record_id", "page_id", "url", "record_type", F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.when(revisit, told_bytes).otherwise(F.col("stored_bytes")).alias("payload_bytes"),
        F.when(revisit, told).otherwise(F.col("stored_digest")).alias("payload_digest"),
        (revisit | (told == F.col("stored_digest"))).alias("verified"))


def _mended(spark: SparkSession, path: str, found: DataFrame, magic: str) -> DataFrame:
    """Records whose payload holds the magic, joined again from their cuts.

    The cuts are found by file and content hash, so a second read may split the
    files in another way. Only cuts of such records are shuffled.
    """
    order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    parts = settled(found.select(
        "path", "file", "off", "key", F.max(F.when(F.col("hit"), F.col("off"))).over(order).alias("owner"),
        F.last(F.when(F.col("hit"), F.col("whole")), ignorenulls=True).over(order).alias("complete")
    ).where("not complete"), "warc-parts")
    wanted = settled(parts.select("path", "key").distinct(), "warc-wanted")
    text = (_cuts(spark, path, magic).select("path", F.md5("value").alias("key"), "value")
            .join(wanted, ["path", "key"], "left_semi").dropDuplicates(["path", "key"]))
    whole = (parts.join(text, ["path", "key"])
             .groupBy("path", "file", "owner")
             .agg(F.sort_array(F.collect_list(F.struct("off", "value"))).alias("cuts"))
             .select("path", "file", F.col("owner").alias("off"), F.lit(0).cast("long").alias("block"),
                     F.lit(0).cast("long").alias("row"), F.lit("").alias("key"),
                     F.array_join(F.transform("cuts", lambda c: c["value"]), magic).alias("value")))
    return _described(_parsed(whole)).where("whole")


def archive_round_trip(pages: DataFrame, min_dup_bytes: int = 100) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, min_dup_bytes)
    return read_archives(pages.sparkSession, path)
