"""Reuse by content, the chunk store, the load step and asset folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from slotplan.pipeline import run_pipeline
from slotplan.sinks import load as L, publish as S
from slotplan.sinks.store import Store
from slotplan.sources.catalogue import CsvFiles
from slotplan.sources.manifest import files_digest, read_or_build
from slotplan.sources.tables import MissingInput
from tests.test_pipeline import APPLIANCES_CSV, LEVELS_CSV, RECIPES_CSV

TS = dt.datetime(2024, 1, 2, 3, 4, 5)


def test_changed_input_reruns_the_later_steps(spark, tmp_path):
    files = {}
    for name, text in (("recipes", RECIPES_CSV), ("appliances", APPLIANCES_CSV), ("levels", LEVELS_CSV)):
        files[name] = str(tmp_path / f"{name}.csv")
        with open(files[name], "w") as f:
            f.write(text)
    out = str(tmp_path / "out")

    def run(**kw):
        ran = []
        paths = run_pipeline(spark, CsvFiles(**files), out, ran=ran, **kw)
        return ran, paths

    every = ["clean", "master", "reports", "publish"]
    assert run(ts=TS)[0] == every
    assert run()[0] == []                                         # nothing has changed
    with open(files["recipes"], "a") as f:
        f.write("bakery,Pie,Oven,c: 1,1 servings,1 hrs,7 xp,9 coins,,2,,,,http://h/4\n")
    ran, paths = run(ts=TS)
    assert ran == every and spark.read.parquet(paths["master"]).count() == 4
    # an output that is gone is made again, and what reads it
    spark.read.parquet(paths["master"]).limit(0).write.mode("overwrite").parquet(paths["master"])
    for p in os.listdir(paths["master"]):
        assert not p.startswith("game_mode=")
    assert run(steps=["master", "reports"])[0] == ["master", "reports"]
    assert run(steps=["reports"])[0] == [] and run(steps=["reports"], force=True)[0] == ["reports"]
    assert run(mode="bakery", steps=["clean"])[0] == ["clean"]         # other parameters
    assert run(steps=["clean"])[0] == ["clean"]


def test_broken_step_is_not_done(spark, tmp_path):
    from slotplan.sources.manifest import Steps
    steps, out = Steps(spark, str(tmp_path)), str(tmp_path / "t")

    def half():
        spark.range(3).write.mode("overwrite").parquet(out)
        raise OSError("disk")

    with pytest.raises(OSError):
        steps.run("s", [], {}, [out], half)
    assert steps.mark("s") is None
    assert steps.run("s", [], {}, [out], lambda: spark.range(4).write.mode("overwrite").parquet(out))
    assert not steps.run("s", [], {}, [out], half) and steps.run("s", [], {"p": 1}, [out], lambda: None)


def test_read_or_build_notices_inputs(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(2).write.parquet(source)
    build = lambda: spark.read.parquet(source)
    assert read_or_build(spark, path, build, inputs=[source]).count() == 2
    before = files_digest(spark, path)
    assert read_or_build(spark, path, build, inputs=[source]).count() == 2 and files_digest(spark, path) == before
    spark.range(5).write.mode("overwrite").parquet(source)
    assert read_or_build(spark, path, build, inputs=[source]).count() == 5
    assert read_or_build(spark, path, build, inputs=[source], params={"x": 1}).count() == 5
    assert files_digest(spark, str(tmp_path / "none")) == "missing"


def table(spark, n=3500, changed=()):
    return spark.range(1, n + 1).select(F.col("id").alias("k"), F.when(F.col("id").isin(*changed), "new").otherwise("old").alias("v"),
                                        F.when(F.col("id") % 7 == 0, F.col("id")).alias("maybe"))


def test_store_writes_changed_chunks_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "report"))
    with pytest.raises(MissingInput):
        store.read()
    plan = lambda *a, **kw: S.chunk_plan(table(spark, *a, **kw), ["k"])
    one = store.publish(plan(), TS)
    assert (one["version"], one["archived"], one["n_rows"], one["n_chunks"], one["n_written"], one["n_removed"]) == (1, None, 3500, 4, 4, 0)
    assert store.publish(plan(), TS)["n_written"] == 0
    # required_rows is part of every row, so a changed length rewrites all; same length here
    two = store.publish(plan(changed=[1500]), TS + dt.timedelta(days=1))
    assert (two["n_written"], two["n_removed"], two["archived"]) == (1, 0, "report_20240103_030405")
    now = {r.k: r.v for r in store.read().collect()}
    assert len(now) == 3500 and now[1500] == "new" and now[1499] == "old"
    old = {r.k: r.v for r in store.read("report_20240103_030405").collect()}
    assert len(old) == 3500 and set(old.values()) == {"old"}
    three = store.publish(plan(1200).drop("required_rows"), TS)
    assert (three["n_rows"], three["n_chunks"], three["n_removed"]) == (1200, 2, 2) and store.read().count() == 1200
    with pytest.raises(MissingInput):
        store.read("report_19990101_000000")


def test_digest_depends_on_order_and_nulls(spark):
    from slotplan.sinks.store import chunk_digests
    rows = lambda *x: spark.createDataFrame([(i, 0, *r) for i, r in enumerate(x)], "id bigint, chunk_id bigint, a string, b string")
    d = lambda *x: tuple(chunk_digests(rows(*x)).first()[1:])
    base = d(("x", "y"), ("z", None))
    assert base == d(("x", "y"), ("z", None))
    assert len({base, d(("z", None), ("x", "y")), d(("x", "y"), (None, "z")), d(("x", "y")), d(("y", "x"), ("z", None))}) == 5


@pytest.mark.parametrize("part", ["rows", "chunks", "log"])
def test_failed_publication_leaves_the_old_table(spark, tmp_path, monkeypatch, part):
    from pyspark.sql.readwriter import DataFrameWriter
    store = Store(spark, str(tmp_path / "report"))
    store.publish(S.chunk_plan(table(spark), ["k"]), TS)
    real = DataFrameWriter.parquet

    def broken(self, path, *a, **kw):
        if f"/report/{part}" in path:
            raise OSError("no space")
        return real(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(OSError):
        store.publish(S.chunk_plan(table(spark, changed=[1, 2]), ["k"]), TS)
    monkeypatch.undo()
    assert store.read().where("v = 'new'").count() == 0 and store.read().count() == 3500 and store.history().count() == 1
    again = store.publish(S.chunk_plan(table(spark, changed=[1, 2]), ["k"]), TS)
    assert store.read().where("v = 'new'").count() == 2 and again["n_written"] == 1


def test_failed_save_leaves_the_catalogue_table(spark):
    name = "planner_safe_test"
    for t in (name, f"{name}__new"):
        spark.sql(f"drop table if exists {t}")
    S.archive_and_replace(spark, spark.range(3), name, TS)
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        S.archive_and_replace(spark, bad, name, TS)
    assert spark.table(name).count() == 3
    archived = S.archive_and_replace(spark, spark.range(4), name, TS)
    assert spark.table(name).count() == 4 and spark.table(archived).count() == 3
    for t in (name, archived, f"{name}__new"):
        spark.sql(f"drop table if exists {t}")


def game_files(spark, tmp_path):
    rec = spark.createDataFrame([(2, "bakery", "Bun", float("nan")), (1, "bakery", "Pie", 1.5), (3, "restaurant", "Soup", 2.0)],
                                "rcp_ord bigint, game_mode string, `Rcp Name` string, score double")
    appl = spark.createDataFrame([("bakery", "Oven", 3, True), ("restaurant", "Grill", 4, None)], "game_mode string, appl_name string, lvl int, open boolean")
    rec.write.parquet(str(tmp_path / "rec"))
    appl.write.parquet(str(tmp_path / "appl"))
    return str(tmp_path / "rec"), str(tmp_path / "appl")


def test_load_plan(spark, tmp_path):
    rec, appl = game_files(spark, tmp_path)
    loads = L.plan_load(spark, "bakery", rec, appl, "jdbc:postgresql://db/x", batchsize=500)
    assert [x.table for x in loads] == ["recipes_all_bakery", "appliances_all_bakery"]
    one, two = loads
    assert one.before == ['DROP TABLE IF EXISTS "recipes_all_bakery__staging"',
                          'CREATE TABLE "recipes_all_bakery__staging" ("id" BIGINT PRIMARY KEY, "rcp_ord" BIGINT, "game_mode" TEXT, "rcp_name" TEXT, "score" DOUBLE PRECISION)']
    assert one.swap == ['DROP TABLE IF EXISTS "recipes_all_bakery"', 'ALTER TABLE "recipes_all_bakery__staging" RENAME TO "recipes_all_bakery"']
    assert '"lvl" BIGINT, "open" TEXT' in two.before[1]
    assert one.options == {"url": "jdbc:postgresql://db/x", "dbtable": "recipes_all_bakery__staging", "batchsize": "500"}
    assert [tuple(r) for r in one.rows.orderBy("id").collect()] == [(1, 1, "bakery", "Pie", 1.5), (2, 2, "bakery", "Bun", None)]
    with pytest.raises(ValueError):
        L.plan_load(spark, "other", rec, appl, "jdbc:x")
    with pytest.raises(MissingInput, match="appliances_all_bakery"):
        L.plan_load(spark, "bakery", rec, str(tmp_path / "none"), "jdbc:x")
    spark.createDataFrame([(1, 2)], "id int, a int").write.parquet(str(tmp_path / "ids"))
    with pytest.raises(ValueError, match="id"):
        L.plan_load(spark, "bakery", str(tmp_path / "ids"), appl, "jdbc:x")


def test_load_swaps_only_whole_tables(spark, tmp_path):
    """A stand-in for the driver records the statements; rows that arrive twice stop the swap."""
    loads = L.plan_load(spark, "bakery", *game_files(spark, tmp_path), "jdbc:x")
    said, staged = [], {}

    def append(load, times=1):
        staged[load.staging] = load.rows.count() * times

    found = L.load_game(loads, said.append, staged.__getitem__, append)
    assert found == {"recipes_all_bakery": 2, "appliances_all_bakery": 1}
    assert said == [loads[0].before, loads[1].before, loads[0].swap + loads[1].swap]
    said.clear()
    with pytest.raises(RuntimeError, match="4 rows arrived of 2"):
        L.load_game(loads, said.append, staged.__getitem__, lambda x: append(x, 2))
    assert said == [loads[0].before]


def test_short_files_count_as_absent(spark, tmp_path):
    for name, size in (("a.png", 20), ("b.png", 0), ("c.png", 3)):
        (tmp_path / name).write_bytes(b"x" * size)
    names = lambda **kw: sorted(r.filename for r in S.existing_files(spark, str(tmp_path), **kw).collect())
    assert names() == ["a.png", "c.png"] and names(min_bytes=10) == ["a.png"]
    spark.createDataFrame([("y" * 30, "d e.png")], "value string, filename string").write.partitionBy("filename").text(str(tmp_path / "sub"))
    assert names(min_bytes=10) == ["a.png", "d e.png"]
