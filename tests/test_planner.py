"""Planner parameters and report shapes."""

import pytest

from slotplan.constants import RETURN_SLOTS
from slotplan.plans.planner import planner_filtered, validate_params
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("mode,level,tier", [("other", 10, "easy"), ("bakery", 0, "easy"),
                                             ("bakery", 100, "easy"), ("bakery", 5, "extreme"),
                                             ("bakery", "5", "easy")])
def test_invalid_params(mode, level, tier):
    with pytest.raises(ValueError):
        validate_params(mode, level, tier)


def test_keep_empty_and_not(spark):
    kept = planner_filtered(spark, SF_SMALL, "bakery", 3, "easy")
    assert sorted(r.return_time for r in kept.collect()) == sorted(RETURN_SLOTS)
    dropped = planner_filtered(spark, SF_SMALL, "bakery", 3, "easy", keep_empty=False)
    rows = dropped.collect()
    assert all(r.best_xp_recipe is not None for r in rows)
    assert {r.return_time for r in rows} <= set(RETURN_SLOTS)


def test_tiers_nested(spark):
    rows = {(r.return_time, t): r.best_xp for t in ("easy", "medium", "hard")
            for r in planner_filtered(spark, SF_SMALL, "restaurant", 99, t).collect()}
    for s in RETURN_SLOTS:
        e, m, h = rows[(s, "easy")], rows[(s, "medium")], rows[(s, "hard")]
        if e is not None:
            assert m >= e
        if m is not None:
            assert h >= m


@pytest.mark.parametrize("mode,level,tier", [("restaurant", 99, "hard"), ("bakery", 40, "medium"),
                                             ("restaurant", 7, "easy"), ("bakery", 1, "hard")])
def test_cube_equals_filtered(spark, mode, level, tier):
    from pyspark.sql import functions as F
    from slotplan.plans.planner import planner_cube
    cube = (planner_cube(spark, SF_SMALL)
            .where((F.col("game_mode") == mode) & (F.col("level") == level) & (F.col("recipe_type") == tier))
            .drop("game_mode", "level", "recipe_type"))
    direct = planner_filtered(spark, SF_SMALL, mode, level, tier, keep_empty=False)
    cols = sorted(direct.columns)
    assert sorted(tuple(r) for r in cube.select(*cols).collect()) == \
        sorted(tuple(r) for r in direct.select(*cols).collect())
