"""Writers and table helpers."""

import datetime as dt
import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from slotplan.operators.clean import clean_columns, priority_order
from slotplan.sinks import publish as S
from slotplan.sources.multi import select_sources, union_sources
from slotplan.sources.manifest import read_or_build
from slotplan.sources.tables import MissingInput, load_required

import pytest


def test_dense_ids_equal_row_number(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").withColumn("v", F.col("k") % 7)
    ids = S.dense_ids(df, ["k"], buckets=6)
    want = df.withColumn("id", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert sorted(map(tuple, ids.select("k", "id").collect())) == \
        sorted(map(tuple, want.select("k", "id").collect()))


def test_dense_ids_honour_every_order_column(spark):
    df = spark.createDataFrame([(g, i) for g in (1, 0) for i in range(40, 0, -1)], "g int, o int")
    got = {(r.g, r.o): r.id for r in S.dense_ids(df, ["g", "o"], buckets=5).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(got))}


def test_csv_roundtrip_keeps_empty_and_null(spark, tmp_path):
    df = spark.createDataFrame([(1, "", None), (2, None, " a "), (3, "x", "")], "id int, a string, b string")
    back = S.csv_roundtrip(df, str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == [(1, "", None), (2, None, " a "), (3, "x", "")]


def test_js_document(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 5)], "k bigint, n string, v bigint")
    lines = S.js_document_lines(df, "k", "masterData")
    S.write_text_document(lines, str(tmp_path / "js"))
    text = "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / "js" / "part-*"))))
    assert text.splitlines() == ['const masterData = [', '{"k":1,"n":"a","v":5},',
                                 '{"k":2,"n":"b","v":null},', '];']


def test_chunk_plan(spark):
    df = spark.range(1, 2501).withColumnRenamed("id", "k")
    plan = S.chunk_plan(df, ["k"], chunk_rows=1000)
    got = {r.k: (r.sheet_row, r.chunk_id, r.chunk_start_row, r.required_rows) for r in plan.collect()}
    assert {r.required_cols for r in plan.collect()} == {26}
    assert got[1] == (2, 0, 1, 2501) and got[999] == (1000, 0, 1, 2501)
    assert got[1000] == (1001, 1, 1001, 2501) and got[2500] == (2501, 2, 2001, 2501)


def test_type_map_and_jdbc_options(spark):
    df = spark.sql("select 1L a, 1.5D b, current_timestamp() c, 'x' d, true e, 1 f")
    prof = {r.column_name: (r.sql_type, r.non_null) for r in S.type_profile(df).collect()}
    assert prof == {"a": ("INT", 1), "b": ("FLOAT", 1), "c": ("TIMESTAMP", 1), "d": ("TEXT", 1),
                    "e": ("TEXT", 1), "f": ("INT", 1)}
    opts = S.jdbc_options("jdbc:postgresql://db/x", "recipes_all_bakery", df, batchsize=500)
    from pyspark.sql.types import StructType
    told = StructType.fromDDL(opts["createTableColumnTypes"])
    assert [(f.name, f.dataType.simpleString()) for f in told] == [
        ("a", "bigint"), ("b", "double"), ("c", "timestamp"), ("d", "string"), ("e", "string"), ("f", "bigint")]
    assert opts["batchsize"] == "500" and opts["dbtable"] == "recipes_all_bakery"


def test_archive_and_replace(spark, tmp_path):
    t = "planner_report_test"
    spark.sql(f"drop table if exists {t}")
    assert S.archive_and_replace(spark, spark.range(2), t, dt.datetime(2024, 1, 2, 3, 4, 5)) is None
    name = S.archive_and_replace(spark, spark.range(3), t, dt.datetime(2024, 1, 2, 3, 4, 5))
    assert name == f"{t}_20240102_030405"
    assert spark.table(t).count() == 3 and spark.table(name).count() == 2
    spark.sql(f"drop table if exists {t}")
    spark.sql(f"drop table if exists {name}")


def test_asset_plan_skips_existing_and_repeats(spark, tmp_path):
    folder = tmp_path / "img"
    folder.mkdir()
    (folder / "b.png").write_bytes(b"x")
    urls = spark.createDataFrame([(1, "http://h/a"), (2, "http://h/b.png"), (3, None),
                                  (4, "http://h/z/a.png?v=2")], "o int, u string")
    plan = S.asset_plan(urls, "u", "o", S.existing_files(spark, str(folder)))
    got = sorted((r.idx, r.filename, r.percent, r.action) for r in plan.collect())
    assert got == [(1, "a.png", 33.33, "DOWNLOAD"), (2, "b.png", 66.67, "SKIP"),
                   (3, "a.png", 100.0, "SKIP")]
    empty = S.existing_files(spark, str(tmp_path / "missing"))
    assert empty.count() == 0


def test_columns_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Rcp Xp` int, game_mode int, `x-y` int")
    assert clean_columns(df).columns == ["rcp_xp", "game_mode", "xy"]
    with pytest.raises(ValueError):
        clean_columns(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))
    assert priority_order(clean_columns(df)).columns == ["game_mode", "rcp_xp", "xy"]


def test_sources_selection_and_guarded_load(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "rcp_ord int")
    b = spark.createDataFrame([(2,)], "rcp_ord int")
    u = union_sources({"restaurant": a, "bakery": b}, "both")
    assert sorted(map(tuple, u.collect())) == [(1, 0), (2, 1)]
    assert select_sources("bakery") == ["bakery"]
    with pytest.raises(ValueError):
        select_sources("other")
    with pytest.raises(MissingInput):
        load_required(spark, str(tmp_path / "nope"), "recipes")
    built = read_or_build(spark, str(tmp_path / "cache"), lambda: spark.range(4))
    again = read_or_build(spark, str(tmp_path / "cache"), lambda: spark.range(99))
    assert built.count() == 4 and again.count() == 4


def test_write_chunks_contiguous_files(spark, tmp_path):
    df = spark.range(1, 3001).withColumnRenamed("id", "k")
    out = str(tmp_path / "chunks")
    S.write_chunks(S.chunk_plan(df, ["k"], chunk_rows=1000), out, files=4)
    back = spark.read.parquet(out)
    assert back.count() == 3000
    one = back.where("chunk_id = 1").select("id").collect()
    assert sorted(r.id for r in one) == list(range(1000, 2000))
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("id").alias("n")).collect()
    assert all(r.hi - r.lo + 1 == r.n for r in per_file)  # contiguous id ranges


def test_publish_archives_and_chunks(spark):
    df = spark.range(1, 2501).withColumnRenamed("id", "k")
    name = "planner_publish_test"
    spark.sql(f"drop table if exists {name}")
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert S.publish(df, name, ts, ["k"]) is None
    old = S.publish(df.where("k < 5"), name, ts, ["k"])
    assert old == f"{name}_20240102_030405" and spark.table(old).count() == 2500
    assert [r.id for r in spark.table(name).orderBy("k").collect()] == [1, 2, 3, 4]
    spark.sql(f"drop table {name}")
    spark.sql(f"drop table {old}")


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ids_read_the_base_table_once(spark):
    """Everything after the range-partitioned write reads that file, not the source."""
    from slotplan.plans.q_publish import q_chunk_export, q_surrogate_id
    from tests.conftest import SF_SMALL
    for q in (q_chunk_export, q_surrogate_id):
        assert "o_orderkey" not in scans(q(spark, SF_SMALL))
