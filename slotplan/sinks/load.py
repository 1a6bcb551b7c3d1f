"""Load step for a database (B4, B5, B6, B8): checked inputs, staged tables, then a swap.

Both tables of a game are written to staging tables first. The swap, a few statements in one
transaction, replaces the live tables only when every row has arrived, so a repeated or
failed task cannot leave a table half filled or doubled. ``load_game`` writes through Spark's
JDBC source; ``plan_load`` only says what would be done, for a run without a database.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODES
from ..operators.clean import clean_columns, nulls_for_nan
from ..sources.tables import load_required
from .publish import create_table_column_types, dense_ids, jdbc_options, sql_type

KEY = "id"
STAGING = "__staging"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class TableLoad:
    """One table: the rows to write, where they are staged, and the statements around the write."""
    table: str
    rows: DataFrame
    options: dict
    before: list[str] = field(default_factory=list)
    swap: list[str] = field(default_factory=list)

    @property
    def staging(self) -> str:
        return self.table + STAGING


def create_statement(table: str, rows: DataFrame) -> str:
    """CREATE TABLE of a staged table: the key first, then the columns by load type."""
    cols = [f"{quoted(KEY)} BIGINT PRIMARY KEY"]
    cols += [f"{quoted(f.name)} {sql_type(f.dataType).replace('INT', 'BIGINT').replace('FLOAT', 'DOUBLE PRECISION')}"
             for f in rows.schema.fields if f.name != KEY]
    return f"CREATE TABLE {quoted(table)} ({', '.join(cols)})"


def prepared(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cleaned names, no NaN, and the dense key 1..N in table order."""
    df = nulls_for_nan(clean_columns(df))
    if KEY in df.columns:
        raise ValueError(f"the input has a column named '{KEY}' already")
    ids = dense_ids(df, [c for c in order if c in df.columns], KEY)
    return ids.select(KEY, *df.columns)


def table_load(df: DataFrame, table: str, url: str, order: Sequence[str], batchsize: int = 1000) -> TableLoad:
    """The load of one table. Rows are appended to a staging table that is made anew first."""
    rows = prepared(df, order)
    options = jdbc_options(url, table + STAGING, rows, batchsize)
    # the staging table is created by statement, with its key; Spark appends to it
    options.pop("createTableColumnTypes")
    options.pop("truncate")
    stage, live = quoted(table + STAGING), quoted(table)
    return TableLoad(table, rows, options,
                     before=[f"DROP TABLE IF EXISTS {stage}", create_statement(table + STAGING, rows)],
                     swap=[f"DROP TABLE IF EXISTS {live}", f"ALTER TABLE {stage} RENAME TO {live}"])


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def plan_load(spark: SparkSession, mode: str, recipes: str, appliances: str, url: str, fmt: str = "parquet",
              batchsize: int = 1000) -> list[TableLoad]:
    """The loads of a game's two tables. An unknown mode raises ``ValueError`` and an input that
    is not there ``MissingInput`` by name, before anything is written."""
    check_mode(mode)
    out = []
    for path, name, order in ((recipes, f"recipes_all_{mode}", "rcp_ord"), (appliances, f"appliances_all_{mode}", "appl_ord")):
        df = load_required(spark, path, name, fmt)
        if "game_mode" in df.columns:
            df = df.where(F.col("game_mode") == mode)
        out.append(table_load(df, name, url, [order] if order in df.columns else df.columns, batchsize))
    return out


def append_rows(load: TableLoad) -> None:
    """Spark's JDBC write; each partition is one transaction."""
    load.rows.write.format("jdbc").options(**load.options).mode("append").save()


def load_game(loads: Sequence[TableLoad], execute: Callable[[list[str]], None], count: Callable[[str], int],
              append: Callable[[TableLoad], None] = append_rows) -> dict[str, int]:
    """Stage all tables, compare their row counts, then swap them together.

    ``execute`` runs statements in one transaction, ``count`` counts a table's rows (both
    from the caller's database driver). A task that Spark repeats may append its rows twice;
    the key refuses them, and a count that differs stops the load with the live tables as
    they were. Returns the rows per table.
    """
    found = {}
    for load in loads:
        execute(load.before)
        append(load)
        have, want = count(load.staging), load.rows.count()
        if have != want:
            raise RuntimeError(f"{load.staging}: {have} rows arrived of {want}; the live table stays")
        found[load.table] = have
    execute([s for load in loads for s in load.swap])
    return found


__all__ = ["KEY", "STAGING", "TableLoad", "append_rows", "check_mode", "create_statement", "create_table_column_types",
           "load_game", "plan_load", "prepared", "table_load"]
