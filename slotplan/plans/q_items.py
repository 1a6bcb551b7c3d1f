"""The planner on the large item table (``lineitem``): the scale form of the report.

time = quantity × 60 minutes, group = return flag, score = floor(extended price),
profit = floor(extended price × (1 − discount)); ties go to the smallest
(orderkey, linenumber, partkey, suppkey, extendedprice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RETURN_SLOTS
from ..functions.fmt import rate_2dp
from ..operators.topk import naive_best, prefix_best
from ..sources.tables import read_table
from . import oracle as O

ITEM_ORD = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
ITEM_METRICS = (
    ("score", {"best_score_item": "item", "best_score": "score"}),
    ("profit", {"best_profit_item": "item", "best_profit": "profit"}),
)


def items(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        *ITEM_ORD, "l_returnflag",
        (F.col("l_quantity").cast("int") * 60).alias("time"),
        F.floor("l_extendedprice").cast("bigint").alias("score"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("profit"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ITEM_ORD[:4]]).alias("item"))


def _finish(best: DataFrame) -> DataFrame:
    return (best.withColumn("score_per_hr", rate_2dp("best_score", "return_time"))
                .withColumn("profit_per_hr", rate_2dp("best_profit", "return_time"))
                .select("l_returnflag", "return_time", "best_score_item", "best_score", "score_per_hr",
                        "best_profit_item", "best_profit", "profit_per_hr"))


def item_planner(spark, sf_dir, slots=RETURN_SLOTS) -> DataFrame:
    """Prefix top-1: bucket, partial aggregate, fan the winners out, reduce."""
    return _finish(prefix_best(items(spark, sf_dir), time="time", slots=slots,
                               metrics=ITEM_METRICS, ord_cols=ITEM_ORD, group_by=("l_returnflag",)))


def item_planner_naive(spark, sf_dir, slots=RETURN_SLOTS) -> DataFrame:
    """Baseline only: every row × every slot it fits, two row_numbers, pivot."""
    return _finish(naive_best(items(spark, sf_dir), time="time", slots=slots,
                              metrics=ITEM_METRICS, ord_cols=ITEM_ORD, group_by=("l_returnflag",)))


_ORDER = ", ".join(ITEM_ORD)
_PRICE, _NET = "cast(floor(l_extendedprice) as bigint)", "cast(floor(l_extendedprice * (1 - l_discount)) as bigint)"
_LABEL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
ITEMS_SQL = f"""
select l_returnflag, minutes as return_time,
       first({_LABEL} order by {_PRICE} desc nulls last, {_ORDER}) as best_score_item, max({_PRICE}) as best_score,
       round(60 * cast(max({_PRICE}) as double) / minutes, 2) as score_per_hr,
       first({_LABEL} order by {_NET} desc nulls last, {_ORDER}) as best_profit_item, max({_NET}) as best_profit,
       round(60 * cast(max({_NET}) as double) / minutes, 2) as profit_per_hr
from lineitem, (select unnest({O.slots_list()}) as minutes)
where cast(l_quantity as int) * 60 <= minutes group by l_returnflag, minutes"""

QUERIES = {"q_item_planner": item_planner}
ORACLE = {"q_item_planner": ITEMS_SQL}
