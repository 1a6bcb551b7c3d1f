"""Catalogue inputs of the planner: recipes, appliances and levels.

``from_csv`` reads the three files a user keeps, with declared schemas; the test
tables reach the same shape through ``from_base_tables``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_columns
from ..operators.windows import written
from . import fixtures
from .tables import BAD_ROW, in_file_order, read_csv


def _schema(text: str, ints: str = "") -> T.StructType:
    return T.StructType([T.StructField(c, T.IntegerType() if c in ints.split() else T.StringType()) for c in text.split()])


RECIPES = _schema("game_mode rcp_name appl_name rcp_cost rcp_servings rcp_time_hr rcp_xp rcp_income rcp_labels "
                  "rcp_level rcp_release_date rcp_img_url appl_img_url rcp_url", ints="rcp_level")
APPLIANCES = _schema("game_mode appl_name appl_img_url appl_unlock_level appl_cost appl_release_date "
                     "appl_recipes_count appl_labels appl_source_url",
                     ints="appl_unlock_level appl_cost appl_recipes_count")
LEVELS = _schema("level xp slots expansion")


@dataclass
class Catalogue:
    recipes: DataFrame       # D1 plus rcp_ord, the table order
    appliances: DataFrame    # D3 plus appl_ord
    levels: DataFrame        # D4, all text
    rejected: DataFrame | None = None    # rows that do not fit their schema: input, file, row_no, raw
    inputs: list[str] | None = None      # the files it was read from


@dataclass
class CsvFiles:
    """Three CSV files (or folders of them), read when a step needs them."""
    recipes: str
    appliances: str
    levels: str

    def load(self, spark: SparkSession) -> Catalogue:
        return from_csv(spark, self.recipes, self.appliances, self.levels)


def _read(spark: SparkSession, path: str, name: str, schema: T.StructType, order: str) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``order``, rejected rows) of one file or folder, from one written table."""
    rows = in_file_order(read_csv(spark, path, schema, name, enforceSchema=False), order)
    table = written(rows, f"csv-{name}")
    bad = table.where(F.col(BAD_ROW).isNotNull())
    return (table.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW, "_file"),
            bad.select(F.lit(name).alias("input"), F.col("_file").alias("file"), F.col(order).alias("row_no"), F.col(BAD_ROW).alias("raw")))


def from_csv(spark: SparkSession, recipes: str, appliances: str, levels: str) -> Catalogue:
    """Read CSV files (or folders of them) with header. Table order is file name and line order.

    A missing file raises ``MissingInput`` by name. A row that does not fit the schema stops
    nothing: it is listed in ``rejected`` with its input, file, row number and raw text.
    """
    rec, bad_rec = _read(spark, recipes, "recipes", RECIPES, "rcp_ord")
    appl, bad_appl = _read(spark, appliances, "appliances", APPLIANCES, "appl_ord")
    lev, bad_lev = _read(spark, levels, "levels", LEVELS, "_ord")
    return Catalogue(rec, appl, clean_columns(lev.drop("_ord")), bad_rec.unionByName(bad_appl).unionByName(bad_lev),
                     [recipes, appliances, levels])


def from_base_tables(spark: SparkSession, sf_dir: str) -> Catalogue:
    return Catalogue(fixtures.recipe_raw(spark, sf_dir), fixtures.appliances(spark, sf_dir), fixtures.level_raw(spark, sf_dir))
