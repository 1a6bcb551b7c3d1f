"""The function library for SQL users (L1-L5): temporary SQL functions and table functions.

``register`` declares the scalar functions under the names of the library; each is a SQL
expression that Spark inlines, so a query that calls them plans like one that spells them
out. ``register_planner`` declares the table function ``planner(mode, level, tier)`` over a
master table, and ``planner_at(mode, level, tier, minutes)`` over stored staircases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import (EMPTY_LABELS, LEVEL_MAX, LEVEL_MIN, MEDIUM_APPL_TOKENS, MODES, RETURN_SLOTS, TIER_MAX_SCORE, TIERS)


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_EMPTY = f"(x IS NULL OR lower(regexp_replace(x, '^\\\\s+|\\\\s+$', '')) IN ({_texts(EMPTY_LABELS)}))"
_FLOOR_PARTS = (("years", 525600, None), ("months", 43200, 525600), ("days", 1440, 43200), ("hours", 60, 1440), ("minutes", 1, 60))


def _minutes_text() -> str:
    """Parts of a span of minutes that are not zero; a month has 30 days and a year 365."""
    parts, rest = [], "m"
    for unit, size, _ in _FLOOR_PARTS:
        value = f"floor({rest} / {size})" if size > 1 else rest
        parts.append(f"CASE WHEN {value} <> 0 THEN concat(cast({value} AS STRING), ' {unit}') END")
        rest = f"pmod({rest}, {size})"
    return f"CASE WHEN m IS NOT NULL THEN coalesce(nullif(concat_ws(' ', {', '.join(parts)}), ''), '0 minutes') END"


def scalar_functions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, result type, expression)."""
    medium = f"size(split(x, ',')) = 1 AND lower(regexp_replace(x, '^\\\\s+|\\\\s+$', '')) IN ({_texts(MEDIUM_APPL_TOKENS)})"
    score = " ".join(f"WHEN t = '{t}' THEN s {'=' if t == 'easy' else '<='} {c}" for t, c in TIER_MAX_SCORE)
    return {
        "clean_int": ("x STRING", "BIGINT", "try_cast(nullif(regexp_replace(x, '[^0-9-]', ''), '') AS BIGINT)"),
        "hours_to_minutes": ("x STRING", "BIGINT",
                             "cast(bround(try_cast(nullif(regexp_extract(x, '([0-9]+[.]?[0-9]*)', 1), '') AS DOUBLE) * 60, 0) AS BIGINT)"),
        "rcp_obtainability": ("x STRING", "STRING", f"CASE WHEN {_EMPTY} THEN 'easy' ELSE 'hard' END"),
        "appl_obtainability": ("x STRING", "STRING", f"CASE WHEN {_EMPTY} THEN 'easy' WHEN {medium} THEN 'medium' ELSE 'hard' END"),
        "difficulty": ("r STRING, a STRING", "INT",
                       "CASE WHEN lower(r) = 'easy' THEN 1 ELSE 3 END + CASE lower(a) WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"),
        "in_tier": ("t STRING, s INT", "BOOLEAN", f"coalesce(CASE {score} ELSE false END, false)"),
        "rate_2dp": ("x DOUBLE, m DOUBLE", "DOUBLE", "round(x * 60.0D / m, 2)"),
        "rate_0dp": ("x DOUBLE, m DOUBLE", "BIGINT", "cast(round(x * 60.0D / m, 0) AS BIGINT)"),
        "rate_js": ("x DOUBLE, m DOUBLE", "BIGINT", "cast(floor(x * 60.0D / m + 0.5D) AS BIGINT)"),
        "format_minutes": ("m BIGINT", "STRING", _minutes_text()),
        "format_short": ("m BIGINT", "STRING",
                         "CASE WHEN m < 60 THEN concat(cast(m AS STRING), ' min') WHEN pmod(m, 60) = 0 THEN concat(cast(floor(m / 60) AS STRING), ' hr') "
                         "ELSE concat(cast(floor(floor((m + 3) / 6) / 10) AS STRING), '.', cast(pmod(floor((m + 3) / 6), 10) AS STRING), ' hr') END"),
        "level_clamp": ("x STRING, step INT", "INT",
                        f"cast(least({LEVEL_MAX}, greatest({LEVEL_MIN}, coalesce(nullif(try_cast(regexp_extract(x, '^\\\\s*([+-]?[0-9]+)', 1) AS BIGINT), 0), 1) + step)) AS INT)"),
        "display": ("x STRING", "STRING", "coalesce(x, '-')"),
    }


def register(spark: SparkSession) -> list[str]:
    """Declare the scalar functions in this session; returns their names."""
    for name, (params, kind, body) in scalar_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {kind} RETURN {body}")
    return list(scalar_functions())


_REPORT = ("return_time INT, best_xp_recipe STRING, best_xp_appl STRING, best_xp BIGINT, xp_per_hr BIGINT, "
           "best_profit_recipe STRING, best_profit_appl STRING, best_profit BIGINT, profit_per_hr BIGINT")


def _checked(mode: str, level: str, tier: str) -> str:
    """C24 in SQL: a parameter out of range is an error by name."""
    return (f"CASE WHEN {mode} IS NULL OR {mode} NOT IN ({_texts(MODES)}) THEN raise_error(concat('mode must be one of {', '.join(MODES)}, got ', coalesce({mode}, 'null'))) "
            f"WHEN {level} IS NULL OR {level} NOT BETWEEN {LEVEL_MIN} AND {LEVEL_MAX} THEN raise_error(concat('level must be in {LEVEL_MIN}..{LEVEL_MAX}, got ', coalesce(cast({level} AS STRING), 'null'))) "
            f"WHEN {tier} IS NULL OR {tier} NOT IN ({_texts(TIERS)}) THEN raise_error(concat('tier must be one of {', '.join(TIERS)}, got ', coalesce({tier}, 'null'))) ELSE true END")


def register_planner(spark: SparkSession, master: DataFrame, view: str = "planner_master", name: str = "planner") -> str:
    """Declare ``planner(mode, level, tier)``: the report of every return slot, as a table.

    A row goes to its smallest slot; winners per slot are reduced first and then fanned out
    to the longer slots, so no row is joined to every slot it fits.
    """
    register(spark)
    master.createOrReplaceTempView(view)
    slots = ", ".join(map(str, RETURN_SLOTS))
    key = lambda m: f"named_struct('known', {m} IS NOT NULL, 'm', {m}, 'o', -rcp_ord, 'r', rcp_name, 'a', appl_name)"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(mode STRING, level INT, tier STRING) RETURNS TABLE({_REPORT}) RETURN
      WITH fits AS (
        SELECT element_at(filter(array({slots}), s -> s >= rcp_time_min), 1) AS slot, {key('rcp_xp')} AS x, {key('rcp_profit')} AS p
        FROM {view} WHERE game_mode = {name}.mode AND rcp_level <= {name}.level AND rcp_time_min <= {max(RETURN_SLOTS)}
          AND in_tier({name}.tier, rcp_difficulty)),
      per_slot AS (SELECT slot, max(x) AS x, max(p) AS p FROM fits GROUP BY slot),
      best AS (
        SELECT t, max(x) AS x, max(p) AS p
        FROM (SELECT explode(filter(array({slots}), s -> s >= slot)) AS t, x, p FROM per_slot) GROUP BY t),
      slots AS (SELECT explode(array({slots})) AS t WHERE {_checked(f'{name}.mode', f'{name}.level', f'{name}.tier')})
      SELECT slots.t, x.r, x.a, x.m, rate_js(x.m, slots.t), p.r, p.a, p.m, rate_js(p.m, slots.t)
      FROM slots LEFT JOIN best ON slots.t = best.t""")
    return name


def register_planner_at(spark: SparkSession, steps: DataFrame, view: str = "planner_steps", name: str = "planner_at") -> str:
    """Declare ``planner_at(mode, level, tier, minutes)``: the best rows for any return time, from staircases.

    The cell is selected first; its last step at or before the time is one ``max_by``.
    """
    register(spark)
    steps.createOrReplaceTempView(view)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(mode STRING, level INT, tier STRING, minutes INT)
      RETURNS TABLE(metric STRING, recipe STRING, appl STRING, best BIGINT, per_hr BIGINT) RETURN
      SELECT metric, hit.recipe, hit.appl, hit.value, rate_js(hit.value, {name}.minutes)
      FROM (SELECT metric, max_by(best, time) AS hit FROM {view}
            WHERE game_mode = {name}.mode AND level = {name}.level AND recipe_type = {name}.tier AND time <= {name}.minutes
              AND {_checked(f'{name}.mode', f'{name}.level', f'{name}.tier')}
            GROUP BY metric)""")
    return name
