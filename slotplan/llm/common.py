"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotplan.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


#: bytes of an Arrow batch between Spark and Python; tasks hold a few batches at a time
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of this session by ``most`` bytes (texts may be long)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > most:
        spark.conf.set(key, str(most))


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A ``mapInArrow`` function that hands its freed memory back to the system when its task ends.

    Spark keeps Python workers for later tasks; without this each keeps the largest heap it ever had.
    """
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # GNU C library only
            if trim is not None:
                trim(0)

    return wrapped


def settled(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: rows (or array entries) up to which a settled table is broadcast; beyond it Spark shuffles the join
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, entries: str | None = None) -> DataFrame:
    """A settled table to join with: broadcast only if it is counted small.

    ``entries`` names an array column whose total length counts too.
    """
    total = F.coalesce(F.sum(F.size(entries)), F.lit(0)) if entries else F.lit(0)
    rows, inner = df.agg(F.count(F.lit(1)), total).first()
    return F.broadcast(df) if max(rows, inner) <= BROADCAST_ROWS else df


#: bits of the largest filter that is broadcast (32 MB); one row of it holds as many as ``bitmap_construct_agg`` takes
FILTER_BITS = 1 << 28
_FILTER_ROW = 1 << 15


def touched(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` is surely not in ``keys``, and the others: all that are in it, and few more.

    ``key`` is a 64-bit hash without nulls. Its low bits go into a bitmap of 16 bits a key, bounded by
    ``FILTER_BITS`` (beyond it more rows count as touched). Rows apart from the keys meet no shuffle.
    """
    n = keys.count()
    bits = max(_FILTER_ROW, min(FILTER_BITS, 1 << (16 * n).bit_length()))
    slot = F.pmod(F.col(key), F.lit(bits))
    line, place = (slot / _FILTER_ROW).cast("long"), slot % _FILTER_ROW
    bitmap = settled(keys.groupBy(line.alias("_line")).agg(F.bitmap_construct_agg(place).alias("_bits")), "touched-bits")
    byte = F.conv(F.hex(F.substr("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    found = rows.join(F.broadcast(bitmap), line == F.col("_line"), "left")
    return found.where(~hit).select(*rows.columns), found.where(hit).select(*rows.columns)
