"""Registered queries: name → (spark, sf_dir) → DataFrame, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle, planner, q_items, q_levels, q_pages, q_publish, q_recipes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "q_planner_easy": planner.planner_easy,
    "q_planner_medium_sql": planner.planner_medium_sql,
    "q_planner_hard": planner.planner_hard,
    "q_planner_tiebreak": planner.planner_tiebreak,
    "q_planner_tiers": planner.planner_tiers,
    "q_planner_filtered": planner.planner_filtered,
    "q_planner_cube": planner.planner_cube,
    "q_planner_any_time": planner.planner_any_time,
    "q_planner_sql_function": planner.planner_sql_function,
    "q_planner_images": planner.planner_images,
}
ORACLE: dict[str, str] = dict(oracle.ORACLE)

for _mod in (q_recipes, q_levels, q_pages, q_publish, q_items):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
