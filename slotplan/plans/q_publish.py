"""Registered queries for sources/sinks and publishing (2.A A1/A9, 2.B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import MODES, RETURN_SLOTS
from ..sinks import publish as S
from ..functions.text import url_basename_png
from ..sources import fixtures
from ..sources.multi import source_index, union_sources
from ..sources.tables import read_table
from . import inputs, oracle as O
from .registry import Registry

register = Registry()


_MASTER_COLS = ("rcp_ord", "game_mode", "rcp_name", "appl_name", "rcp_level", "rcp_time_min",
                "rcp_xp", "rcp_profit", "rcp_difficulty", "rcp_labels", "appl_labels")


@register("q_csv_roundtrip", O.with_ctes("master") + f"""
select {', '.join(_MASTER_COLS)} from master""")
def q_csv_roundtrip(spark, sf_dir):
    """A1/B1: master table written as CSV (header, overwrite) and read back typed."""
    m = inputs.master(spark, sf_dir).select(*_MASTER_COLS)
    return S.csv_roundtrip(m, S.scratch_path(spark, "csv_roundtrip"))


@register("q_json_records", O.with_ctes("master") + """
select rcp_ord, to_json(struct_pack(rcp_ord := rcp_ord, game_mode := game_mode, rcp_name := rcp_name,
  appl_name := appl_name, rcp_level := rcp_level, rcp_time_min := rcp_time_min, rcp_xp := rcp_xp,
  rcp_profit := rcp_profit, rcp_difficulty := rcp_difficulty, rcp_labels := rcp_labels,
  appl_labels := appl_labels))::varchar as record
from master""")
def q_json_records(spark, sf_dir):
    """One JSON record per master row, nulls kept as null."""
    m = inputs.master(spark, sf_dir)
    return m.select("rcp_ord", S.json_records(m, _MASTER_COLS).alias("record"))


@register("q_js_document", O.with_ctes("master") + """
select cast(-(1::bigint << 62) as bigint) as line_key, 'const masterData = [' as line
union all
select rcp_ord, to_json(struct_pack(rcp_ord := rcp_ord, game_mode := game_mode, rcp_name := rcp_name,
  appl_name := appl_name, rcp_level := rcp_level, rcp_time_min := rcp_time_min, rcp_xp := rcp_xp,
  rcp_profit := rcp_profit, rcp_difficulty := rcp_difficulty, rcp_labels := rcp_labels,
  appl_labels := appl_labels))::varchar || ',' from master
union all
select cast(1::bigint << 62 as bigint), '];'""")
def q_js_document(spark, sf_dir):
    """The master table as a JS constant, one record per line."""
    m = inputs.master(spark, sf_dir)
    return S.js_document_lines(m, "rcp_ord", "masterData", _MASTER_COLS)


_ORDER_TYPES = (("o_orderkey", "INT"), ("o_custkey", "INT"), ("o_orderstatus", "TEXT"),
                ("o_totalprice", "FLOAT"), ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "TEXT"))


@register("q_type_map", " union all ".join(
    f"select '{c}' as column_name, '{t}' as sql_type, count({c}) as non_null from orders"
    for c, t in _ORDER_TYPES))
def q_type_map(spark, sf_dir):
    """Column → load type (INT / FLOAT / TIMESTAMP / TEXT) with non-null counts."""
    return S.type_profile(read_table(spark, sf_dir, "orders"))


@register("q_surrogate_id", O.with_ctes("master") + """
select row_number() over (order by case game_mode when 'restaurant' then 0 else 1 end, rcp_ord) as id, rcp_ord, rcp_name from master""")
def q_surrogate_id(spark, sf_dir):
    """Dense 1..N ids in table order, computed without a single-partition window."""
    m = inputs.master(spark, sf_dir).select(source_index("game_mode").alias("src_idx"), "rcp_ord", "rcp_name")
    return S.dense_ids(m, ["src_idx", "rcp_ord"]).select("id", "rcp_ord", "rcp_name")


@register("q_chunk_export", O.with_ctes("master") + """
select rcp_ord, id, id + 1 as sheet_row, id // 1000 as chunk_id, (id // 1000) * 1000 + 1 as chunk_start_row,
       greatest(1000, count(*) over () + 1) as required_rows, 26 as required_cols
from (select rcp_ord, row_number() over (order by case game_mode when 'restaurant' then 0 else 1 end, rcp_ord) as id from master)""")
def q_chunk_export(spark, sf_dir):
    """Sheet row and 1000-row chunk of every master row, and the sheet size."""
    m = inputs.master(spark, sf_dir).select(source_index("game_mode").alias("src_idx"), "rcp_ord")
    return S.chunk_plan(m, ["src_idx", "rcp_ord"]).select("rcp_ord", "id", "sheet_row", "chunk_id",
                                                          "chunk_start_row", "required_rows", "required_cols")


# FIXED VALUES — headings of an empty report.
_SCAFFOLD = ("Best_XP_Recipe", "Appliance_xp", "XP", "XP/Hr", "Best_Profit_Recipe", "Appliance_$",
             "Profit", "Profit/Hr")


@register("q_report_scaffold", O.with_ctes("fx_recipe_raw") + f"""
select m.game_mode, t.return_time as "return_time (min)", {', '.join(f"'' as \"{c}\"" for c in _SCAFFOLD)}
from (select distinct game_mode from fx_recipe_raw) m, (select unnest({O.slots_list()}) as return_time) t""")
def q_report_scaffold(spark, sf_dir):
    """An empty report per game present in the data: the slots plus 8 blank columns."""
    modes = fixtures.recipe_raw(spark, sf_dir).select("game_mode").distinct()
    slots = F.array(*[F.lit(s) for s in RETURN_SLOTS])
    return modes.select("game_mode", F.explode(slots).alias("return_time (min)"),
                        *[F.lit("").alias(c) for c in _SCAFFOLD])


@register("q_asset_manifest", O.with_ctes("fx_appl") + """
select idx, appl_img_url, filename, round(cast(idx as double) * 100 / total, 2) as percent,
       case when idx <> min(idx) over (partition by filename) or filename like '%7.png' then 'SKIP' else 'DOWNLOAD' end as action
from (select row_number() over (order by appl_ord) as idx, appl_img_url,
        case when ends_with(b, '.png') then b else b || '.png' end as filename,
        count(*) over () as total
      from (select appl_ord, appl_img_url,
              string_split(regexp_extract(appl_img_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')[-1] as b
            from fx_appl where appl_img_url is not null))""")
def q_asset_manifest(spark, sf_dir):
    """Image URLs → file names, position, percent, DOWNLOAD or SKIP
    (files already in the asset folder, or a name already taken, are skipped)."""
    a = fixtures.appliances(spark, sf_dir)
    # what an earlier run has left: whole files for the names that end in 7, broken ones for those in 3
    name = url_basename_png("appl_img_url")
    left = (a.where(F.col("appl_img_url").isNotNull()).select(name.alias("filename")).distinct()
            .where(F.col("filename").rlike("[37][.]png$")))
    folder = S.scratch_path(spark, "assets")
    body = F.when(F.col("filename").endswith("7.png"), F.lit("image " * 8)).otherwise(F.lit("x"))
    left.select(body.alias("value"), "filename").write.partitionBy("filename").text(folder)
    return S.asset_plan(a, "appl_img_url", "appl_ord", S.existing_files(spark, folder, min_bytes=16))


_CHUNK_OF = "(row_number() over (order by case game_mode when 'restaurant' then 0 else 1 end, rcp_ord)) as id"


@register("q_chunk_changes", O.with_ctes("master", extra=f"""before as (
select id, id // 1000 as chunk_id, rcp_ord, rcp_name, rcp_profit from (select *, {_CHUNK_OF} from master)),
after as (
select id, id // 1000 as chunk_id, rcp_ord, case when rcp_ord % 4999 = 42 then 'renamed' else rcp_name end as rcp_name, rcp_profit
from (select *, {_CHUNK_OF} from master where rcp_ord < (select max(o_orderkey) from orders) - 2500)),
b as (select chunk_id, count(*) as n, string_agg(id || '|' || rcp_ord || '|' || rcp_name || '|' || coalesce(rcp_profit::varchar, '?'), ';' order by id) as t
      from before group by chunk_id),
a as (select chunk_id, count(*) as n, string_agg(id || '|' || rcp_ord || '|' || rcp_name || '|' || coalesce(rcp_profit::varchar, '?'), ';' order by id) as t
      from after group by chunk_id)""") + """
select coalesce(a.chunk_id, b.chunk_id) as chunk_id,
       case when a.chunk_id is null then 'REMOVE' when a.t = b.t then 'KEEP' else 'WRITE' end as action, coalesce(a.n, 0) as n_rows
from a full join b on a.chunk_id = b.chunk_id""")
def q_chunk_changes(spark, sf_dir):
    """Chunks that a second publication writes, keeps or removes. Some rows have another
    name, and the table ends earlier; nothing else changes."""
    from ..sinks.store import chunk_changes, chunk_digests
    m = inputs.master(spark, sf_dir).select(source_index("game_mode").alias("src_idx"), "rcp_ord", "rcp_name", "rcp_profit")
    last = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).scalar()
    after = (m.where(F.col("rcp_ord") < last - 2500)
             .withColumn("rcp_name", F.when(F.col("rcp_ord") % 4999 == 42, "renamed").otherwise(F.col("rcp_name"))))
    digests = lambda df: chunk_digests(S.chunk_plan(df, ["src_idx", "rcp_ord"]).select("id", "chunk_id", "rcp_ord", "rcp_name", "rcp_profit"))
    return chunk_changes(digests(after), digests(m)).select("chunk_id", "action", "n_rows")


@register("q_multi_source_union", O.with_ctes("fx_recipe_raw") + """
select case game_mode when 'restaurant' then 0 else 1 end as src_idx, game_mode, rcp_ord, rcp_name
from fx_recipe_raw where game_mode in ('restaurant', 'bakery')""")
def q_multi_source_union(spark, sf_dir):
    """The selected sources ('both') unioned by name in configuration order."""
    r = fixtures.recipe_raw(spark, sf_dir).select("game_mode", "rcp_ord", "rcp_name")
    frames = {m: r.where(F.col("game_mode") == m) for m in MODES}
    return union_sources(frames, "both").select("src_idx", "game_mode", "rcp_ord", "rcp_name")


QUERIES = register.queries
ORACLE = register.oracle
