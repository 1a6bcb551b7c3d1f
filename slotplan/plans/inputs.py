"""Shared inputs for the registered queries: cleaned recipes, appliances, master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import build_master, clean_recipes
from ..operators.levels import with_cycles
from ..functions.fmt import format_minutes
from ..sources import fixtures


def recipes_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_recipes(fixtures.recipe_raw(spark, sf_dir))


def recipes_with_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean recipes plus minutes and text to reach the target xp."""
    df = with_cycles(recipes_clean(spark, sf_dir), "rcp_xp", fixtures.level_raw(spark, sf_dir),
                     out="_cycles")
    df = df.withColumn("min_to_lvl99", F.col("_cycles") * F.col("rcp_time_min")).drop("_cycles")
    return df.withColumn("time_to_lvl99", format_minutes("min_to_lvl99"))


def appliances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.appliances(spark, sf_dir)


def master(spark: SparkSession, sf_dir: str, *, with_levels: bool = False,
           fanout: bool = False) -> DataFrame:
    rec = recipes_with_levels(spark, sf_dir) if with_levels else recipes_clean(spark, sf_dir)
    return build_master(rec, appliances(spark, sf_dir), fanout=fanout)
