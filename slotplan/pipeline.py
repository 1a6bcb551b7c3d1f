"""End-to-end batch run (A15, 3.1): raw → clean → master → reports → published files.

Each selected step writes its named tables under ``out_dir`` (a shared folder) and the next
step reads them back, which cuts the lineage. A step runs only if the files it reads or its
parameters have changed since its last complete run (``sources.manifest``). A step that is not
selected is skipped; its output must then exist: steps name their inputs explicitly and fail
by name when one is missing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import RETURN_SLOTS_TIERS
from .functions.fmt import format_minutes
from .operators.clean import build_master, clean_recipes
from .operators.levels import with_cycles
from .plans.planner import any_time_staircases, cell_staircases, cube_report, sql_tier_level, tiers_report
from .sinks import publish as S
from .sinks.store import Store
from .sources.catalogue import Catalogue, CsvFiles, from_base_tables
from .sources.manifest import Steps
from .sources.multi import select_sources, source_index
from .sources.tables import load_required, table_path

STEPS = ("clean", "master", "reports", "publish")


def _save(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    w = df.write.mode("overwrite")
    cols = list(partition_by)
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


#: raised when the meaning of a step's output changes, so that older outputs are not reused
REVISION = 3


def _inputs_of(source) -> list[str] | None:
    """Files a source is read from; None where they are not known."""
    if isinstance(source, CsvFiles):
        return [source.recipes, source.appliances, source.levels]
    if isinstance(source, Catalogue):
        return source.inputs
    return [table_path(source, t) for t in ("orders", "supplier", "customer")]


def run_pipeline(spark: SparkSession, source: str | Catalogue | CsvFiles, out_dir: str, mode: str = "both",
                 steps: Iterable[str] = STEPS, force: bool = False, ran: list[str] | None = None,
                 ts: dt.datetime | None = None) -> dict[str, str]:
    """Run the selected steps; returns {table name: path} of everything written.

    ``source`` is three CSV files (``CsvFiles``), a :class:`Catalogue`, or a folder of base tables
    from which one is derived. ``force`` runs steps that are up to date too; the names of the
    steps that ran are appended to ``ran``. A catalogue whose files are not known is always
    read again. ``ts`` names the archive of the table that the publish step replaces.
    """
    steps = list(steps)
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}; choose from {STEPS}")
    games = select_sources(mode)
    out = out_dir.rstrip("/")
    paths = {n: f"{out}/{n}" for n in ("recipes_clean", "appliances", "rejected", "master", "report_tiers",
                                       "report_cube", "report_any_time", "master_json", "master_js", "master_csv",
                                       "master_chunks")}
    marks = Steps(spark, out)
    ran = [] if ran is None else ran

    def step(name, reads, writes, work, always=False):
        if name in steps:
            params = {"games": games, "revision": REVISION}
            if force or always:
                marks.reset(name)
            if marks.run(name, reads, params, [paths[w] for w in writes], work):
                ran.append(name)

    def clean():
        cat = source if isinstance(source, Catalogue) else source.load(spark) if isinstance(source, CsvFiles) else from_base_tables(spark, source)
        raw = cat.recipes.where(F.col("game_mode").isin(*games))
        rec = with_cycles(clean_recipes(raw), "rcp_xp", cat.levels, out="_c")
        rec = (rec.withColumn("min_to_lvl99", F.col("_c") * F.col("rcp_time_min")).drop("_c")
                  .withColumn("time_to_lvl99", format_minutes("min_to_lvl99")))
        _save(rec, paths["recipes_clean"], ["game_mode"])
        _save(cat.appliances, paths["appliances"])
        if cat.rejected is not None:
            _save(cat.rejected, paths["rejected"])

    def master():
        rec = load_required(spark, paths["recipes_clean"], "recipes_clean")
        appl = load_required(spark, paths["appliances"], "appliances")
        _save(build_master(rec.where(F.col("game_mode").isin(*games)), appl), paths["master"], ["game_mode"])

    def reports():
        table = load_required(spark, paths["master"], "master")
        per_game = [tiers_report(table.where(F.col("game_mode") == g)
                                 .withColumn("tier_level", sql_tier_level()), RETURN_SLOTS_TIERS)
                    .withColumn("game_mode", F.lit(g)) for g in games]
        tiers = per_game[0]
        for t in per_game[1:]:
            tiers = tiers.unionByName(t)
        _save(tiers, paths["report_tiers"])
        _save(cube_report(table), paths["report_cube"])
        _save(any_time_staircases(cell_staircases(table)), paths["report_any_time"])

    def publish():
        table = load_required(spark, paths["master"], "master")
        S.write_json_lines(table, paths["master_json"])
        S.write_csv(table, paths["master_csv"])
        # table order: games in configuration order, then the order inside a game
        ordered = table.withColumn("src_idx", source_index("game_mode"))
        store = Store(spark, paths["master_chunks"], "master")
        store.publish(S.chunk_plan(ordered, ["src_idx", "rcp_ord"]).drop("src_idx"), ts or dt.datetime.now(dt.timezone.utc))
        if mode == "both":
            S.write_text_document(S.js_document_lines(store.read(), "id", cols=table.columns), paths["master_js"])

    inputs = _inputs_of(source)
    step("clean", inputs or [], ["recipes_clean", "appliances"], clean, always=inputs is None)
    step("master", [paths["recipes_clean"], paths["appliances"]], ["master"], master)
    step("reports", [paths["master"]], ["report_tiers", "report_cube", "report_any_time"], reports)
    step("publish", [paths["master"]], ["master_json", "master_csv", "master_chunks"], publish)
    return paths
