"""Publishing.

All writers are distributed DataFrame writes; nothing is gathered on the driver.
Ordered text outputs (a JS document) carry a line key and are range-sorted
before writing, so part files concatenated in name order give the document.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..constants import EXPORT_CHUNK_ROWS
from ..functions.fmt import archive_name
from ..functions.text import url_basename_png
from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (``spark.checkpoint.dir``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------------------ files

NULL_TEXT = "\\N"  # how a null is spelled in CSV, so that '' and null stay different


def write_csv(df: DataFrame, path: str) -> None:
    """B1: overwrite, header, no index column."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", NULL_TEXT)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def csv_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write as CSV and read back with the same declared schema (A1/B1).

    Null is written as ``\\N`` and '' as a quoted empty string, so both survive
    the trip (a schema is given; nothing is inferred).
    """
    write_csv(df, path)
    return (df.sparkSession.read.schema(df.schema).option("header", True)
            .option("nullValue", NULL_TEXT).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).option("mode", "FAILFAST").csv(path))


def json_records(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """One JSON object per row; null fields are kept as ``null``."""
    cols = list(cols or df.columns)
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def js_document_lines(df: DataFrame, order_col: str, var: str = "masterData",
                      cols: Sequence[str] | None = None) -> DataFrame:
    """``const <var> = [`` / one record per line / ``];`` as (line_key, line).

    Every record line ends with ',' (a trailing comma is valid in a JS array
    literal), so no row needs to know whether it is the last one.
    """
    rec = df.select(F.col(order_col).cast("bigint").alias("line_key"),
                    F.concat(json_records(df, cols), F.lit(",")).alias("line"))
    spark = df.sparkSession
    edge = spark.createDataFrame([(-(1 << 62), f"const {var} = ["), ((1 << 62), "];")],
                                 "line_key bigint, line string")
    return edge.unionByName(rec)


def write_text_document(lines: DataFrame, path: str) -> None:
    """Range-sort by line key and write text; part files in name order form the document."""
    lines.orderBy("line_key").select("line").write.mode("overwrite").text(path)


# ------------------------------------------------------------------ ids and chunks

def dense_ids(df: DataFrame, order: Sequence[str], id_col: str = "id",
              buckets: int | None = None) -> DataFrame:
    """Dense 1..N ids in ``order`` (unique together), without a global window.

    The rows are written once, range-partitioned by ``order``. Rows per range are
    counted from that file (a table of one row per range), the counts become offsets,
    and each range numbers its own rows in parallel. ``total_col`` of
    :func:`numbered` is the last offset, so no other scan counts the rows.
    """
    return numbered(df, order, id_col, buckets).drop("_total")


def numbered(df: DataFrame, order: Sequence[str], id_col: str = "id",
             buckets: int | None = None) -> DataFrame:
    """:func:`dense_ids` with ``_total``, the number of rows."""
    from ..operators.windows import range_chunks

    d = range_chunks(df, list(order), buckets, out="_bkt")
    counts = d.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(F.lit(0))                 # one row per range: bounded by ``buckets``
    w_off = every.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bkt", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_n").over(every).alias("_total"))
    local = d.withColumn("_pos", F.row_number().over(Window.partitionBy("_bkt").orderBy(*order)))
    out = local.join(F.broadcast(offsets), "_bkt")       # bounded by ``buckets``
    return out.withColumn(id_col, (F.col("_off") + F.col("_pos")).cast("bigint")).drop("_bkt", "_pos", "_off")


def chunk_plan(df: DataFrame, order_cols: Sequence[str], chunk_rows: int = EXPORT_CHUNK_ROWS,
               existing_rows: int = 1000, existing_cols: int = 26) -> DataFrame:
    """Sheet row, chunk id and chunk start for every row, and the sheet size.

    The header is row 1, so data row ``id`` sits on sheet row ``id + 1`` and in
    chunk ``id div chunk_rows``. ``required_rows`` = max(existing, rows + 1),
    ``required_cols`` = max(existing, columns of ``df``).
    """
    chunk = F.floor(F.col("id") / chunk_rows).cast("bigint")
    return (numbered(df, order_cols).withColumn("sheet_row", F.col("id") + 1)
            .withColumn("chunk_id", chunk)
            .withColumn("chunk_start_row", chunk * chunk_rows + 1)
            .withColumn("required_rows", F.greatest(F.lit(existing_rows).cast("bigint"), F.col("_total") + 1))
            .withColumn("required_cols", F.lit(max(existing_cols, len(df.columns))))
            .drop("_total"))


def write_chunks(plan: DataFrame, path: str, files: int | None = None) -> None:
    """The export in sheet-row order, ready for a chunked upload (overwrite).

    Rows are range-partitioned and sorted by id, so every file holds a
    contiguous id range; reading one chunk (``chunk_id = k``) touches one or two
    files thanks to parquet min/max statistics. No folder per chunk: at scale
    that would be one directory per 1000 rows.
    """
    n = files or int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (plan.repartitionByRange(n, "id").sortWithinPartitions("id")
         .write.mode("overwrite").parquet(path))


# ------------------------------------------------------------------ tables

# FIXED VALUES — load type names.
def sql_type(dt: T.DataType) -> str:
    """Integer → INT, floating → FLOAT, date/time → TIMESTAMP, everything else → TEXT."""
    if isinstance(dt, T.IntegralType):
        return "INT"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "TIMESTAMP"
    return "TEXT"


def create_table_column_types(df: DataFrame) -> str:
    """The ``createTableColumnTypes`` option text for a JDBC overwrite.

    The option takes Spark SQL type names, which the database's dialect maps to its
    own (STRING becomes TEXT). Columns with the dialect's default type are listed too,
    so that the table does not depend on the dialect's choice of integer width.
    """
    names = {"INT": "BIGINT", "FLOAT": "DOUBLE", "TIMESTAMP": "TIMESTAMP", "TEXT": "STRING"}
    return ", ".join(f"`{f.name}` {names[sql_type(f.dataType)]}" for f in df.schema.fields)


def type_profile(df: DataFrame) -> DataFrame:
    """B6 as a table: (column_name, sql_type, non_null) in one pass over the data."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    stack = ", ".join(f"'{f.name}', '{sql_type(f.dataType)}', c{i}" for i, f in enumerate(fields))
    return counts.select(F.expr(f"stack({len(fields)}, {stack}) as (column_name, sql_type, non_null)"))


def jdbc_options(url: str, table: str, df: DataFrame, batchsize: int = 1000,
                 extra: Mapping[str, str] | None = None) -> dict:
    """Options for ``df.write.format('jdbc')`` (drop-and-create, batched insert)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": "false",
            "createTableColumnTypes": create_table_column_types(df)}
    opts.update(extra or {})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 1000, **extra) -> None:
    """Overwrite a database table. Errors propagate (nothing is swallowed)."""
    df.write.format("jdbc").options(**jdbc_options(url, table, df, batchsize, extra)) \
        .mode("overwrite").save()


def archive_and_replace(spark: SparkSession, df: DataFrame, table: str, ts) -> str | None:
    """Rename the current table to ``<table>_YYYYmmdd_HHMMSS`` and put the new one in its place.

    The new table is saved under another name first; two renames follow. A save that fails
    leaves the current table as it was. ``ts`` is passed in (a datetime), so reruns are
    reproducible. Returns the archive name, or None when there was nothing to archive.
    """
    stage = f"{table}__new"
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    df.write.mode("errorifexists").saveAsTable(stage)
    archived = None
    if spark.catalog.tableExists(table):
        archived = spark.range(1).select(archive_name(F.lit(table), F.lit(ts))).first()[0]
        spark.sql(f"ALTER TABLE {table} RENAME TO {archived}")
    spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    return archived


def publish(df: DataFrame, table: str, ts, order_cols: Sequence[str],
            chunk_rows: int = EXPORT_CHUNK_ROWS) -> str | None:
    """The export of ``df`` as a table, in chunks; the current table is archived first.

    Returns the archive's name, or None when there was nothing to archive. ``store.Store``
    does the same in a folder, writing changed chunks only.
    """
    return archive_and_replace(df.sparkSession, chunk_plan(df, order_cols, chunk_rows), table, ts)


# ------------------------------------------------------------------ assets

#: files shorter than this count as not there (a download that broke off)
MIN_ASSET_BYTES = 1


def existing_files(spark: SparkSession, folder: str, min_bytes: int = MIN_ASSET_BYTES) -> DataFrame:
    """(filename, length) of the files of a folder (B14), from its listing: no content is read.

    Files shorter than ``min_bytes`` count as absent. A folder ``filename=<name>``, as Spark's
    partitioned writers make it, counts as the file <name> with the length of its parts.
    Empty when the folder is absent.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = files.load(folder).select("path", "length")
        files.schema
    except AnalysisException:
        return spark.createDataFrame([], "filename string, length bigint")
    part = F.regexp_extract("path", r"/filename=([^/]+)/[^/]+$", 1)
    name = F.when(part != "", F.url_decode(part)).otherwise(F.element_at(F.split("path", "/"), -1))
    sizes = files.groupBy(name.alias("filename")).agg(F.sum("length").alias("length"))
    return sizes.where(F.col("length") >= min_bytes)


def asset_plan(urls: DataFrame, url_col: str, order_col: str, existing: DataFrame) -> DataFrame:
    """What to fetch: file name per URL, position, percent, action.

    Null URLs are dropped. A file already present, or a name already taken by
    an earlier URL in this run, is SKIP; the rest are DOWNLOAD.
    """
    u = urls.where(F.col(url_col).isNotNull()).select(order_col, url_col)
    named = numbered(u, [order_col], "idx").withColumn("filename", url_basename_png(url_col))
    first = named.groupBy("filename").agg(F.min("idx").alias("_first"))
    have = existing.select("filename").distinct().withColumn("_have", F.lit(True))
    out = named.join(first, "filename").join(have, "filename", "left")
    action = F.when(F.col("_have") | (F.col("idx") != F.col("_first")), "SKIP").otherwise("DOWNLOAD")
    return out.select("idx", url_col, "filename",
                      F.round(F.col("idx") * 100.0 / F.col("_total"), 2).alias("percent"),
                      action.alias("action"))
