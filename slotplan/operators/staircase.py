"""Best item for any return time: prefix-maximum staircases.

"Which item with time <= T has the highest metric" changes its answer only at the times of
items that beat every shorter one. Per cell (a game, a level, a tier, ...) these items, in
order of time, form a staircase; the answer for any T is its last step at or before T. A
staircase of staircases is the staircase of all their rows, so cells merge (levels and
tiers that include others) and new rows merge in without the old raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import asof_merge
from .topk import best_key
from .windows import running_max


def steps_of(df: DataFrame, cell: Sequence[str], time: str = "time", key: str = "best",
             chunks: int | None = None) -> DataFrame:
    """Steps (cell, time, key): rows whose ``key`` (see ``best_key``) beats all shorter ones of their cell.

    Rows of one time are reduced in their own task first; the running maximum is carried over
    ranges of (cell, time), so a large cell is spread over tasks. Rows without a time are in
    no staircase.
    """
    best = df.where(F.col(time).isNotNull()).groupBy(*cell, time).agg(F.max(key).alias(key))
    run = running_max(best, cell, [time], key, "_so_far", chunks)
    # a row is a step where the maximum so far is its own
    return run.where(F.col("_so_far") == F.col(key)).drop("_so_far")


def staircase(df: DataFrame, cell: Sequence[str], time: str, metric, ord_cols: Sequence[str],
              payload: Mapping[str, str], chunks: int | None = None) -> DataFrame:
    """Staircase of raw rows by one metric: cell columns, ``time`` and ``best`` (the best row's key)."""
    keyed = df.select(*cell, F.col(time).cast("bigint").alias("time"), best_key(metric, ord_cols, payload).alias("best"))
    return steps_of(keyed, cell, chunks=chunks)


def merged(old: DataFrame, new: DataFrame, cell: Sequence[str], chunks: int | None = None) -> DataFrame:
    """The staircase of two staircases of the same cells."""
    return steps_of(old.unionByName(new), cell, chunks=chunks)


def best_at(asks: DataFrame, steps: DataFrame, cell: Sequence[str], at: str, out: str = "best") -> DataFrame:
    """``asks`` with ``out``: the key of the best row within time ``at`` of their cell, null where none is."""
    return asof_merge(asks, steps.withColumnRenamed("best", out), cell, at, [out], entry_at="time")
