"""run_pipeline: steps write named tables; later steps read them back."""

import os

import pytest

from slotplan.pipeline import run_pipeline
from slotplan.sinks.store import Store
from slotplan.sources.tables import MissingInput
from tests.conftest import SF_SMALL


def test_pipeline_steps(spark, tmp_path):
    out = str(tmp_path / "run")
    with pytest.raises(MissingInput):
        run_pipeline(spark, SF_SMALL, out, steps=["master"])
    paths = run_pipeline(spark, SF_SMALL, out, mode="both")
    master = spark.read.parquet(paths["master"])
    assert master.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert {"min_to_lvl99", "time_to_lvl99", "rcp_difficulty"} <= set(master.columns)
    assert spark.read.parquet(paths["report_cube"]).count() > 0
    assert spark.read.parquet(paths["report_tiers"]).select("game_mode").distinct().count() == 2
    js = sorted(p for p in os.listdir(paths["master_js"]) if p.startswith("part-"))
    first = open(os.path.join(paths["master_js"], js[0])).readline().strip()
    assert first == "const masterData = ["
    # rerun only the reports from the saved master
    run_pipeline(spark, SF_SMALL, out, steps=["reports"])
    with pytest.raises(ValueError):
        run_pipeline(spark, SF_SMALL, out, mode="other")


def test_cube_lookup_matches_planner(spark, tmp_path):
    from slotplan.plans.planner import cube_lookup, planner_filtered
    out = str(tmp_path / "run")
    paths = run_pipeline(spark, SF_SMALL, out, steps=["clean", "master", "reports"])
    got = cube_lookup(spark, paths["report_cube"], "bakery", 40, "medium")
    want = planner_filtered(spark, SF_SMALL, "bakery", 40, "medium")
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, want.select(*cols).collect()), key=repr)


RECIPES_CSV = """game_mode,rcp_name,appl_name,rcp_cost,rcp_servings,rcp_time_hr,rcp_xp,rcp_income,rcp_labels,rcp_level,rcp_release_date,rcp_img_url,appl_img_url,rcp_url
restaurant,Soup,Oven,c: 10,4 servings,1.5 hrs,30 xp,50 coins,,3,,,,http://h/1
restaurant,Roast,Oven,c: 20,2 servings,0.25 hrs,12 xp,25 coins,Event,1,,,,http://h/2
bakery,Bun,Oven,c: -5,6 servings,2 hrs,44 xp,"1,000 coins",,9,,http://i/3.png,,http://h/3
"""
APPLIANCES_CSV = """game_mode,appl_name,appl_img_url,appl_unlock_level,appl_cost,appl_release_date,appl_recipes_count,appl_labels,appl_source_url
restaurant,Oven,http://a/r.png,1,100,,2,,http://s/r
bakery,Oven,http://a/b.png,2,200,,1,"Build, Gem",http://s/b
bakery,Oven,http://a/b2.png,2,200,,1,,http://s/b2
"""
LEVELS_CSV = """level,xp,slots,expansion
1,0,2,0
2,100,,0
3,"1,000",3,1
"""


def test_pipeline_from_plain_csv(spark, tmp_path):
    """Real inputs: three CSV files; an appliance name that both games use keeps its game's labels."""
    from slotplan.sources.catalogue import from_csv
    files = {}
    for name, text in (("recipes", RECIPES_CSV), ("appliances", APPLIANCES_CSV), ("levels", LEVELS_CSV)):
        files[name] = str(tmp_path / f"{name}.csv")
        with open(files[name], "w") as f:
            f.write(text)
    paths = run_pipeline(spark, from_csv(spark, **files), str(tmp_path / "out"))
    rows = {r["rcp_name"]: r for r in spark.read.parquet(paths["master"]).collect()}
    assert len(rows) == 3
    assert (rows["Soup"]["rcp_difficulty"], rows["Roast"]["rcp_difficulty"], rows["Bun"]["rcp_difficulty"]) == (2, 4, 4)
    bun = rows["Bun"]
    assert (bun["rcp_cost"], bun["rcp_income"], bun["rcp_profit"], bun["rcp_time_min"]) == (5, 1000, 995, 120)
    assert bun["appl_labels"] == "Build, Gem" and bun["appl_source_url"] == "http://s/b" and bun["appl_img_url"] is None
    assert rows["Soup"]["min_to_lvl99"] > 0
    chunks = Store(spark, paths["master_chunks"]).read().orderBy("id").collect()
    assert [r["rcp_name"] for r in chunks] == ["Soup", "Roast", "Bun"]
    js = "".join(open(os.path.join(paths["master_js"], p)).read() for p in sorted(os.listdir(paths["master_js"])) if p.startswith("part-"))
    assert js.index("Soup") < js.index("Roast") < js.index("Bun") and js.rstrip().endswith("];")
    with pytest.raises(MissingInput):
        from_csv(spark, str(tmp_path / "none.csv"), files["appliances"], files["levels"])
