"""Joins leave the broadcast decision to Spark's size check."""

from slotplan.operators.joins import sized_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_join_broadcasts_by_threshold_only(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(0, 50000).withColumnRenamed("id", "k")
        small = spark.range(0, 10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan(sized_join(big, small, "k", "left"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan(sized_join(big, small, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
