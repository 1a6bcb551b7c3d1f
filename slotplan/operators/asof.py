"""As-of merge of two tables that both grow (J9): the last entry at or before each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import fill_forward


def asof_merge(rows: DataFrame, entries: DataFrame, by: Sequence[str], at: str, values: Sequence[str],
               entry_at: str | None = None, tie: Sequence[str] = (), chunks: int | None = None) -> DataFrame:
    """``rows`` with ``values`` of the last of ``entries`` at or before ``at``, per ``by``.

    Both tables go into one order of (key, place, entries first, tie), cut into ranges; the
    entry in force at the end of a range is carried into the next ones. Neither side is
    broadcast and a key may hold any share of the rows. Of entries at one place the last in
    the order of ``tie`` counts. A row without an entry before it, without a place or
    without a key gets nulls; entries without a place or a key are in force nowhere. The
    names of ``values`` must not be columns of ``rows``.
    """
    clash = set(values) & set(rows.columns)
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    entry_at = entry_at or at
    keys = [f"_by{i}" for i in range(len(by))]
    own = rows.select(F.struct(*rows.columns).alias("_row"), *[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(at).alias("_at"))
    entry = entries.where(F.col(entry_at).isNotNull())
    for b in by:
        entry = entry.where(F.col(b).isNotNull())
    place = F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0).alias("none"))
    entry = entry.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(entry_at).alias("_at"),
                         F.lit(0).alias("_side"), place.alias("_tie"), F.struct(*values).alias("_entry"))
    # rows of one place stand after its entries; a number spreads equal ones over ranges
    own = own.withColumn("_side", F.xxhash64("_row").bitwiseAND(F.lit(0x3FFFFFFF)).cast("int") + 1)
    both = entry.unionByName(own, allowMissingColumns=True)
    filled = fill_forward(both, keys, ["_at", "_side", "_tie"], "_entry", "_hit", chunks=chunks)
    return filled.where(F.col("_side") > 0).select("_row.*", *[F.col("_hit")[v].alias(v) for v in values])
