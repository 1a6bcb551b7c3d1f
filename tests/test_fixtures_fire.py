"""Every branch that a query decides on fires both ways on the fixtures."""

import pytest
from pyspark.sql import functions as F

from slotplan.plans.catalog import QUERIES
from tests.conftest import SF_MID

FLAGS = [
    ("q_asset_manifest", "action"), ("q_asof_slots", "slots"), ("q_left_join_two_games", "rcp_difficulty"),
    ("q_rcp_obtainability", "rcp_obtainability"), ("q_appl_obtainability", "appl_obtainability"),
    ("q_find_mode", "mode"), ("q_bad_records", "field"), ("q_planner_tiers", "recipe_type"), ("q_override_fix", "fixed"),
]


@pytest.mark.parametrize("name,col", FLAGS)
def test_flag_has_two_values(spark, name, col):
    assert QUERIES[name](spark, SF_MID).select(col).where(F.col(col).isNotNull()).distinct().count() >= 2


def test_rows_are_dropped_and_kept(spark):
    """The given pages are read as they are; the extra ones (negative ids) lack parts."""
    given = spark.read.parquet(f"{SF_MID}/pages.parquet")
    extra = given.where("page_id % 11 = 5").count() + given.where("page_id % 9 = 4").count()
    for name in ("q_pages_details", "q_take_while_pages"):
        kept = QUERIES[name](spark, SF_MID)
        assert kept.where("page_id >= 0").count() == given.count()
        assert 0 < kept.where("page_id < 0").count() < extra
    counts = QUERIES["q_page_counts"](spark, SF_MID)
    assert counts.where("n_blocks = 0").count() == given.where("page_id % 9 = 4").count() and counts.count() == given.count() + extra
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet").count()
    assert 0 < QUERIES["q_recipe_records"](spark, SF_MID).count() < orders


def test_games_label_a_name_differently(spark):
    two = QUERIES["q_left_join_two_games"](spark, SF_MID)
    per_name = two.where("appl_labels is not null").groupBy("appl_name").agg(
        F.countDistinct("game_mode").alias("g"), F.countDistinct("appl_labels").alias("l"))
    assert per_name.where("g = 2 and l = 2").count() > 0
