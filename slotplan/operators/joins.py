"""Join helper: the broadcast decision stays with Spark's own size check."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join without a hint.

    The planner compares the estimated size of a side with
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the real shuffled size
    at run time; beyond it the join stays a sort-merge join, with AQE splitting skewed
    partitions.
    """
    return left.join(right, on=on, how=how)
