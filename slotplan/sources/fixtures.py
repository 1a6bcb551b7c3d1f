"""Catalogue-shaped inputs derived from the driver's base tables.

The planner works on recipe, appliance and level tables. The test tables do not
have those, so each is derived here with DataFrame expressions from a base table.
All derived tables grow with the base tables (the level table is bounded by
design: one row per level, at most 99).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TIME_FIXES
from .tables import read_table

_FIX_NAMES = ", ".join(f"'{name}'" for name, _ in TIME_FIXES)


def recipe_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw recipe rows (D1), one per order. ``rcp_ord`` is the table order."""
    o = read_table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_orderkey as rcp_ord",
        "case when o_orderkey % 2 = 0 then 'restaurant' else 'bakery' end as game_mode",
        # some rows carry the names that have a time correction
        f"case when o_orderkey % 37 = 5 then element_at(array({_FIX_NAMES}), cast(o_orderkey % {len(TIME_FIXES)} + 1 as int))"
        " else concat('rcp_', cast(floor(o_orderkey / 3) as string)) end as rcp_name",
        "concat('Supplier#', lpad(cast(o_custkey % 120 as string), 9, '0')) as appl_name",
        "concat('c: -', cast(floor(o_totalprice / 7) as string)) as rcp_cost",
        "concat(cast(floor(o_totalprice / 5) as string), ' coins') as rcp_income",
        "case when o_orderkey % 101 = 7 then 'tbd' else concat(cast(o_custkey % 997 + 1 as string), ' xp') end as rcp_xp",
        "case when o_orderkey % 50 = 0 then 'soon'"
        " else concat(cast(o_orderkey % 48 as string), '.25 hrs') end as rcp_time_hr",
        "case o_orderkey % 4 when 0 then '' when 1 then cast(null as string)"
        " when 2 then 'Gem' else 'Event, Holiday' end as rcp_labels",
        "cast(1 + o_orderkey % 99 as int) as rcp_level",
        "concat(cast(o_orderkey % 12 as string), ' servings') as rcp_servings",
        "concat('RD: ', cast(o_orderdate as string)) as rcp_release_date",
        "concat('http://cdn.example.com/r/', cast(o_orderkey as string), '.png') as rcp_img_url",
        "concat('http://www.example.com/s8/', case when o_orderkey % 2 = 0 then 'restaurant' else 'bakery' end,"
        " '_recipes_all.php?page=', cast(floor(o_orderkey / 40) + 1 as string)) as rcp_url",
        "cast(null as string) as appl_img_url",
    )


def appliances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appliance rows (D3), one per supplier and game; the games label the same name differently."""
    s = read_table(spark, sf_dir, "supplier")
    return s.selectExpr("*", "explode(array(0, 1)) as g").selectExpr(
        "2 * s_suppkey + g as appl_ord",
        "case g when 0 then 'restaurant' else 'bakery' end as game_mode",
        "s_name as appl_name",
        "case (s_suppkey + 2 * g) % 5 when 0 then '' when 1 then cast(null as string)"
        " when 2 then 'Build' when 3 then ' gem ' else 'Build, Gem' end as appl_labels",
        "concat('http://cdn.example.com/a/appl_', cast(s_suppkey as string),"
        " case when s_suppkey % 3 = 0 then '.png' else '' end) as appl_img_url",
        "cast(1 + s_suppkey % 60 as int) as appl_unlock_level",
        "cast(s_suppkey * 250 as int) as appl_cost",
        "cast(null as string) as appl_release_date",
        "cast(s_suppkey % 9 as int) as appl_recipes_count",
        "concat('http://www.example.com/s8/', case g when 0 then 'restaurant' else 'bakery' end,"
        " '_appl_retr.php?search_appl=', s_name) as appl_source_url",
    )


def level_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped-style level table (D4): all text, commas in xp, gaps and junk in slots.

    One row per level (``c_custkey % 99``), so it has at most 99 rows whatever the scale.
    """
    c = read_table(spark, sf_dir, "customer")
    g = c.groupBy((F.col("c_custkey") % 99).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    xp = ("case when x >= 1000 then concat(cast(floor(x / 1000) as string), ',',"
          " lpad(cast(x % 1000 as string), 3, '0')) else cast(x as string) end")
    return g.selectExpr("k", "k * k * 90 + n as x").selectExpr(
        "cast(k + 1 as string) as Level",
        f"case when k % 7 = 3 then concat(' ', {xp}, ' ') else {xp} end as ` XP`",
        "case when k % 5 = 1 then cast(null as string) when k % 11 = 4 then 'x'"
        " else cast(2 + floor(k / 10) as string) end as `Slots `",
        "cast(k % 3 as string) as Expansion",
    )


def wiki_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents holding HTML (D10): a navigation table, then the level table.

    The last row of the level table is short on purpose.
    """
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey").cast("string")
    html = F.concat(
        F.lit("<table class=nav><tr><th>Name</th></tr><tr><td>"), F.col("s_name"),
        F.lit("</td></tr></table><table class=wikitable><tr><th>Level</th><th>XP</th>"
              "<th>Slots</th><th>Expansion</th></tr><tr><td>"), k,
        F.lit("</td><td>"), (F.col("s_suppkey") * 100).cast("string"),
        F.lit("</td><td>"), (2 + F.col("s_suppkey") % 4).cast("string"),
        F.lit("</td><td>"), F.col("s_nationkey").cast("string"),
        F.lit("</td></tr><tr><td>x</td></tr></table>"),
    )
    return s.select(F.col("s_suppkey").alias("doc"),
                    F.concat(F.lit('{"parse":{"text":{"*":"'), html, F.lit('"}}}')).alias("j"))


PAGE_BLOCKS = 40   # blocks of a catalogue page
PART_BLOCKS = 50_000   # blocks of the pages that one task builds


def _pages_of(rows: DataFrame, order: str, url, html) -> DataFrame:
    """Pages (page_id, url, html) of at most PAGE_BLOCKS blocks each, in table order."""
    page = F.floor(F.col(order) / (2 * PAGE_BLOCKS)).cast("bigint")     # the games alternate
    # a stated number of parts: Spark would merge them by their compressed size
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    parts = max(min(most, n // 25_000), n // PART_BLOCKS, 1)
    blocks = rows.select("game_mode", page.alias("no"), F.struct(F.col(order).alias("o"), html.alias("h")).alias("b"))
    if parts > 1:   # what fits one part needs no number of its own
        blocks = blocks.repartition(parts, "game_mode", "no")
    return (blocks.groupBy("game_mode", "no").agg(F.array_sort(F.collect_list("b")).alias("bs"))
            .select((2 * F.col("no") + (F.col("game_mode") == "bakery").cast("int")).alias("page_id"), url.alias("url"),
                    F.concat(F.lit("<html><body><!-- <span class=\"appliance_single_recipe\"> -->"),
                             F.array_join(F.transform("bs", lambda b: b["h"]), "\n"), F.lit("</body></html>")).alias("html")))


def _nested(cond, c):
    """``c`` with its last part inside an element of the field's own kind."""
    return F.when(cond, F.regexp_replace(c, r"^(.*?)(\S+)$", "$1<div class=in>$2</div>")).otherwise(c)


def recipe_pages(spark: SparkSession, sf_dir: str, spoiled: bool = False) -> DataFrame:
    """Listing pages whose blocks hold the raw recipes; some blocks lack parts, and some fields
    hold elements of their own kind. ``spoiled``: some images have no source."""
    r, o = recipe_raw(spark, sf_dir), F.col("rcp_ord")
    div = lambda css, c: F.concat(F.lit(f'<div class="{css}">'), c, F.lit("</div>"))
    maybe = lambda cond, c: F.when(cond, c).otherwise(F.lit(""))
    labels = F.concat(*[maybe(F.coalesce(F.col("rcp_labels").contains(x), F.lit(False)),
                              F.when(o % 8 == 2, F.lit(f'<span id=l class="big sd_label"><span> </span> {x} </span>'))
                              .otherwise(F.lit(f'<span id=l class="big sd_label"> {x} </span>')))
                        for x in ("Event", "Holiday", "Gem")], F.lit('<span class="sd_label"> </span>'))
    stats = F.concat(*[div(css, _nested(o % 4 == 1, F.col(c))) for css, c in (("rcpcost", "rcp_cost"), ("rcpserv", "rcp_servings"), ("x rcptime", "rcp_time_hr"),
                                                                             ("rcpxp", "rcp_xp"), ("rcpincome", "rcp_income"))])
    image = F.concat(F.lit('<div class="rcp_view"><div>'), F.when(F.lit(spoiled) & (o % 17 == 6), F.lit("<img alt=x>")).otherwise(
        F.concat(F.lit('<img alt=x src="'), F.col("rcp_img_url"), F.lit('">'))), F.lit("</div></div>"))
    html = F.concat(
        F.lit('<SPAN class="row appliance_single_recipe">'), maybe(o % 7 != 3, image),
        F.lit("<span class='appl_view'><b>no image</b></span>"),
        div("invtitle2", F.when(o % 4 == 3, _nested(F.lit(True), F.col("rcp_name"))).otherwise(F.concat(F.lit("<b>"), F.col("rcp_name"), F.lit("</b>")))),
        # figures outside the figures' element are no figures
        maybe(o % 9 == 4, div("rcpcost", F.lit("c: 0"))),
        maybe(o % 5 != 4, F.concat(F.lit("<a class=go>no</a><a class=go href='"), F.col("rcp_url"), F.lit("'>more</a>"))),
        F.lit('<div class="hide-on-mobile">'), div("applname", _nested(o % 10 == 7, F.col("appl_name"))), labels,
        maybe(o % 9 == 5, div("rcpxp", F.lit("0 xp"))),
        maybe(o % 6 != 1, F.concat(F.lit("<div><div>Lvl: ?</div><i>Lvl:</i> "), F.col("rcp_level").cast("string"), F.lit("</div>"))),
        maybe(o % 13 != 2, F.concat(F.lit('<div class=detstats>'), stats, F.lit("</div>"))),
        maybe(o % 3 == 0, div("applname", F.col("rcp_release_date"))), F.lit("</div><div class=applname>outside</div></SPAN><div class=detstats>after</div>"))
    url = F.concat(F.lit("http://www.example.com/s8/"), F.col("game_mode"), F.lit("_recipes_all.php?page="), F.col("no").cast("string"))
    return _pages_of(r, "rcp_ord", url, html)


def appliance_pages(spark: SparkSession, sf_dir: str, spoiled: bool = False) -> DataFrame:
    """Search pages whose blocks hold the appliances; some blocks lack parts. ``spoiled``: some
    blocks have no name, or a level that is no number."""
    a, o = appliances(spark, sf_dir), F.col("appl_ord")
    maybe = lambda cond, c: F.when(cond, c).otherwise(F.lit(""))
    text = lambda c: F.col(c).cast("string")
    html = F.concat(
        F.lit('<div class="appliance_parts_block">'),
        maybe(~(F.lit(spoiled) & (o % 23 == 9)), F.concat(F.lit('<div class="appltitle">'), _nested(o % 3 == 1, F.col("appl_name")), F.lit("</div>"))),
        F.lit('<span class="appliance_parts_parts">'), maybe(o % 4 != 1, F.concat(F.lit('<img src="'), F.col("appl_img_url"), F.lit('">'))),
        F.lit("</span>"), maybe(o % 5 != 2, F.concat(F.lit('<div class="lvl">'), maybe(F.lit(spoiled) & (o % 29 == 4), F.lit("x")), text("appl_unlock_level"), F.lit("</div>"))),
        F.lit('<span class="details">first</span><span class="details"><span>c:</span> '), text("appl_cost"),
        maybe(o % 3 == 0, F.lit(" RD: 2021-03-04")), F.lit("</span>"),
        maybe(o % 6 != 3, F.concat(F.lit('<span class="bold"> '), text("appl_recipes_count"), F.lit(" </span>"))),
        F.transform(F.split(F.coalesce("appl_labels", F.lit("")), ","),
                    lambda x: F.concat(F.lit('<span class="sd_label">'), x, F.lit("</span>"))).cast("array<string>")[0],
        F.lit("</div>"))
    url = F.concat(F.lit("http://www.example.com/s8/"), F.col("game_mode"), F.lit("_appl_retr.php?page="), F.col("no").cast("string"))
    return _pages_of(a, "appl_ord", url, html)


def recipe_lines(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    """(rcp_ord, value): the raw recipes as CSV lines, some of which do not fit the schema."""
    o = F.col("rcp_ord")
    shown = [F.when(o % 59 == 7, F.lit("x1")).otherwise(F.col(c).cast("string")).alias(c) if c == "rcp_level" else F.col(c) for c in cols]
    line = F.to_csv(F.struct(*shown), {"nullValue": "\\N"})
    return recipe_raw(spark, sf_dir).select("rcp_ord", F.concat(line, F.when(o % 53 == 11, F.lit(",one,more")).otherwise(F.lit(""))).alias("value"))
