"""Ordered-sequence operators that stay parallel under skew."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import sized_join


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_count(df: DataFrame) -> int:
    """Ranges for a written table: a quarter of Spark's advisory partition size each (its files are compressed)."""
    sizes = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    total = sizes.agg(F.sum("file_size")).first()[0] or 0
    advisory = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    unit = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = re.match(r"\d+", advisory)[0]
    each = int(digits) * unit.get(advisory[len(digits):][:1].lower(), 1) // 4
    return max(2, -(-total // max(each, 1)))


def range_chunks(df: DataFrame, order: Sequence[str | Column], chunks: int | None = None,
                 out: str = "_chunk", is_written: bool = False) -> DataFrame:
    """``df`` in ``order``, cut into ranges of similar size, with the range number ``out``.

    Spark samples its input in a job of its own to set the range limits, so ``df`` is
    written first (``is_written`` says that it comes straight from a written table): what
    lies before it runs once. The number of ranges follows the written size. The ranges are
    written too; what follows reads that file, so the rows and their range cannot change
    between passes. The order may have several columns: equal values of the first are
    split by the next ones.
    """
    step = df if is_written else written(df, "range-input")
    n = chunks or range_count(step)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cut = (step.repartitionByRange(max(2, n), *cols).sortWithinPartitions(*cols)
           .withColumn(out, F.spark_partition_id().cast("bigint")))
    return written(cut, "ranges")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``right`` with its keys renamed, and the null-safe condition that joins it to ``left``."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    return right.withColumnsRenamed(names), [left[k].eqNullSafe(F.col(n)) for k, n in names.items()]


def _over_ranges(df: DataFrame, partition: Sequence[str], order: Sequence[str], chunks: int | None,
                 end: Column, carry, local, combine, out: str) -> DataFrame:
    """A running value per ``partition`` in ``order`` without a whole key in one task.

    The rows are cut into ranges of (partition, order). ``end`` aggregates each (key, range)
    to one value; ``carry`` folds the ends of the ranges before, per key (at most one row per
    range); ``local`` runs inside a (key, range); ``combine`` joins both to ``out``.
    """
    part = list(partition)
    d = range_chunks(df, [*part, *order], chunks)
    keys = [*part, "_chunk"]
    ends = d.groupBy(*keys).agg(end.alias("_end"))
    before = Window.partitionBy(*(part or [F.lit(0)])).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carries, cond = _null_safe(d, ends.withColumn("_carry", carry(F.col("_end"), before)).drop("_end"), keys)
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = d.withColumn("_local", local(upto))
    joined = sized_join(rows, carries, on=cond, how="inner")
    return joined.withColumn(out, combine(F.col("_carry"), F.col("_local"))).select(
        *[c for c in df.columns if c != out], out)


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
                out: str, chunks: int | None = None) -> DataFrame:
    """Running total of ``value`` per ``partition`` in ``order`` (which must be unique in a key).

    A hot key spreads over several ranges even if its first order column is constant.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    return _over_ranges(df, partition, order, chunks, F.sum(value), lambda e, w: F.sum(e).over(w),
                        lambda w: F.sum(value).over(w), lambda c, x: (x + zero(c)).cast("bigint"), out)


def running_max(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
                out: str, chunks: int | None = None) -> DataFrame:
    """Largest ``value`` so far (this row's included) per ``partition`` in ``order``; any ordered type."""
    return _over_ranges(df, partition, order, chunks, F.max(value), lambda e, w: F.max(e).over(w),
                        lambda w: F.max(value).over(w), lambda c, x: F.when(x.isNull() | (c > x), c).otherwise(x), out)


def fill_forward(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str, out: str,
                 default: Column | None = None, chunks: int | None = None) -> DataFrame:
    """``out`` = the last non-null ``value`` up to this row per ``partition`` in ``order``.

    Rows before any value get ``default``. Nulls come first in ``order``. The value that a
    range ends with is carried into the ranges after it, so no key sits in one task.
    """
    here = F.struct(*[F.col(c) for c in order])
    end = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), here))
    last = [] if default is None else [default]
    return _over_ranges(df, partition, order, chunks, end, lambda e, w: F.last(e, ignorenulls=True).over(w),
                        lambda w: F.last(value, ignorenulls=True).over(w), lambda c, x: F.coalesce(x, c, *last), out)


def take_while(df: DataFrame, partition: Sequence[str], order: Sequence[str], bad) -> DataFrame:
    """Rows before the first bad row of each partition, in ``order``.

    The first bad position per key is a grouped ``min`` (partial aggregation,
    skew-safe), joined back to the rows — no single-task window per key.
    """
    part = list(partition)
    pos = F.struct(*[F.col(c) for c in order])
    stops = (df.where(bad).groupBy(*part).agg(F.min(pos).alias("_stop"))
               .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(part)], "_stop"))
    cond = [df[k].eqNullSafe(stops[f"_k{i}"]) for i, k in enumerate(part)]
    j = sized_join(df, stops, on=cond, how="left").drop(*[f"_k{i}" for i in range(len(part))])
    return j.where(F.col("_stop").isNull() | (pos < F.col("_stop"))).drop("_stop")
