"""Registered queries over page tables and source URLs (2.A, 2.J, E6-E10, F6-F7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import LEVEL_TABLE_HEADERS
from ..functions import text as T
from ..operators.clean import clean_columns, distinct_rows
from ..operators.windows import running_sum, take_while
from ..sources import fixtures, pages as P
from ..sources.records import appliance_records, recipe_records
from ..sources.tables import read_table
from . import oracle as O
from .registry import Registry

register = Registry()


def _pages(spark, sf_dir):
    """The page table as given, and extra pages made from some of them, under new ids and sites.

    The extra pages have no heading, or no paragraphs, as some pages of a real crawl do; the
    given pages are not touched.
    """
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    site = F.replace("url", F.lit("://"), F.lit("://extra."))
    bare = p.where("page_id % 11 = 5").select((-2 * F.col("page_id") - 1).alias("page_id"), site.alias("url"),
                                              F.regexp_replace("html", "<(/?)h1", "<$1h6").alias("html"))
    flat = p.where("page_id % 9 = 4").select((-2 * F.col("page_id") - 2).alias("page_id"), site.alias("url"),
                                             F.regexp_replace("html", "<(/?)p>", "<$1span>").alias("html"))
    return p.unionByName(bare).unionByName(flat)


def _q(s: str) -> str:
    return s.replace("'", "''")


# DuckDB forms. They cut texts at openings and closings instead of matching whole elements.
_PAGE_X = r"""page_g as (
select page_id, url, html from pages
union all select -2 * page_id - 1, replace(url, '://', '://extra.'), regexp_replace(html, '<(/?)h1', '<\1h6', 'g') from pages where page_id % 11 = 5
union all select -2 * page_id - 2, replace(url, '://', '://extra.'), regexp_replace(html, '<(/?)p>', '<\1span>', 'g') from pages where page_id % 9 = 4),
page_x as (
select page_id, url, html,
       array_to_string(list_transform(string_split_regex(html, '(?i)<!--|<script|<style'),
         lambda x, i: case when i = 1 then x else regexp_replace(x, '(?is)^.*?(-->|</script\s*>|</style\s*>)', '') end), '') as chtml,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) as host0
from page_g)"""
O.add_cte("page_x", _PAGE_X)


def _decode(x: str) -> str:
    for ent, ch in P.ENTITIES:
        x = f"replace({x}, '{ent}', '{_q(ch)}')"
    return x


def _bare(x: str) -> str:
    """Text outside tags: what follows a '>' in each piece between two '<'."""
    return (f"array_to_string(list_transform(string_split({x}, '<'), "
            f"lambda y, i: case when i = 1 then y else substr(y, strpos(y, '>') + 1) end), '')")


def _tag_text(x: str) -> str:
    return f"nullif(trim({_decode(_bare(x))}), '')"


def _element(src: str, opening: str, closing: str) -> str:
    """Inside of the first element: after its opening, up to its closing ('' without one)."""
    tail = f"string_split_regex({src}, '(?i)<{opening}>')[2]"
    return rf"coalesce(case when regexp_matches({tail}, '(?i)</{closing}\s*>') then string_split_regex({tail}, '(?i)</{closing}\s*>')[1] end, '')"


_BLOCKS = (r"list_transform(string_split_regex(chtml, '(?i)<p(\s[^>]*)?>')[2:], lambda b: "
           r"string_split_regex(b, '(?i)</(p|article|aside|body|div|footer|header|html|li|main|section|td)\s*>')[1])")
_NAV = _element("chtml", r"nav(\s[^>]*)?", "nav")
_LINKS = (r"list_filter(string_split_regex(n, '(?i)<a(\s|>)')[2:], lambda z: regexp_matches(z, '(?i)</a\s*>'))")
_LINK_TEXTS = (f"list_transform({_LINKS}, lambda z: "
               + _decode(_bare(r"substr(string_split_regex(z, '(?i)</a\s*>')[1], strpos(z, '>') + 1)")) + ")")
_HREFS = f"""list_transform({_LINKS}, lambda z: nullif(split_part(split_part(split_part(z, '>', 1), 'href="', 2), '"', 1), ''))"""


@register("q_pages_blocks", O.with_ctes("page_x") + f"""
select page_id, cast(unnest(generate_series(1, len(b))) as bigint) as pos,
       unnest(list_transform(b, lambda x: coalesce({_tag_text('x')}, ''))) as text
from (select page_id, {_BLOCKS} as b from page_x)""")
def q_pages_blocks(spark, sf_dir):
    """One row per paragraph, in page order (openings counted, not pairs)."""
    return P.page_blocks(_pages(spark, sf_dir))


@register("q_pages_details", O.with_ctes("page_x") + f"""
select page_id, nullif(host0, '') as host,
  {_tag_text(_element("chtml", "title", "title"))} as title,
  {_tag_text(_element("chtml", "h1", "h1"))} as heading,
  {_tag_text(_element("chtml", 'div class="ad"', "div"))} as ad_text,
  texts[1] as first_link,
  case when len(texts) > 1 then texts[len(texts)] end as last_link
from (select *, {_LINK_TEXTS} as texts
      from (select *, {_NAV} as n from page_x))
where {_tag_text(_element("chtml", "h1", "h1"))} is not null""")
def q_pages_details(spark, sf_dir):
    """First match text or null; skip pages without a heading."""
    return P.page_details(_pages(spark, sf_dir))


@register("q_pages_links", O.with_ctes("page_x") + f"""
select page_id, cast(unnest(generate_series(1, len(h))) as bigint) as pos,
       unnest(h) as href, unnest(t) as link_text
from (select page_id, {_HREFS} as h,
             {_LINK_TEXTS} as t
      from (select page_id, {_NAV} as n from page_x))""")
def q_pages_links(spark, sf_dir):
    """K3: attribute values (href) with their link text, one row per link."""
    p = _pages(spark, sf_dir)
    return (p.select("page_id", F.posexplode(P.nav_links("html")).alias("p", "l"))
             .select("page_id", (F.col("p") + 1).cast("bigint").alias("pos"),
                     F.col("l.href").alias("href"), F.col("l.text").alias("link_text")))


@register("q_labels_join", O.with_ctes("page_x") + f"""
select page_id, array_to_string(list_filter(list_transform(t, lambda x: trim(x)), lambda x: x <> ''), ', ') as labels
from (select page_id, {_LINK_TEXTS} as t
      from (select page_id, {_NAV} as n from page_x))""")
def q_labels_join(spark, sf_dir):
    """The non-empty label texts of a block, joined with ', '."""
    p = _pages(spark, sf_dir)
    texts = F.transform(P.nav_links("html"), lambda l: F.trim(l["text"]))
    return p.select("page_id", F.array_join(F.filter(texts, lambda x: x != ""), ", ").alias("labels"))


@register("q_distinct_rows", O.with_ctes("page_x") + f"""
, links as (
select page_id, unnest(generate_series(1, len(h))) as pos, unnest(h) as href, unnest(t) as link_text
from (select page_id, {_HREFS} as h,
             {_LINK_TEXTS} as t
      from (select page_id, {_NAV} as n from page_x)))
select href, link_text, f.page_id as first_page, f.pos as first_pos
from (select href, link_text, min(struct_pack(page_id := page_id, pos := pos)) as f from links group by href, link_text)""")
def q_distinct_rows(spark, sf_dir):
    """Full-row distinct over extracted rows, keeping each row's first position."""
    p = _pages(spark, sf_dir)
    rows = (p.select("page_id", F.posexplode(P.nav_links("html")).alias("p", "l"))
             .select(F.col("l.href").alias("href"), F.col("l.text").alias("link_text"),
                     F.struct("page_id", (F.col("p") + 1).cast("bigint").alias("pos")).alias("at")))
    return distinct_rows(rows, "at").select("href", "link_text", F.col("at.page_id").alias("first_page"),
                                            F.col("at.pos").alias("first_pos"))


@register("q_regex_fields", O.with_ctes("page_x") + """
select page_id,
  nullif(regexp_extract(html, 'lang="(\\w+)"', 1), '') as lang,
  try_cast(nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') as int) as track_no,
  try_cast(nullif(regexp_extract(url, 'page=(\\d+)', 1), '') as int) as page_param,
  nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') as url_lang
from page_x""")
def q_regex_fields(spark, sf_dir):
    """I4/K6/K8: regex group or null (never ''), optional integers."""
    p = _pages(spark, sf_dir)
    return p.select("page_id", T.regex_field("html", r'lang="(\w+)"').alias("lang"),
                    T.regex_int("html", r"track\((\d+)\)").alias("track_no"),
                    T.regex_int("url", r"page=(\d+)").alias("page_param"),
                    T.regex_field("url", r"/([a-z]{2})/").alias("url_lang"))


_PAGE_NO = f"try_cast(nullif(regexp_extract(url, '{_q(P.PATH_NUMBER)}', 1), '') as bigint)"


#: a page with at most this many blocks ends its site's sequence
EMPTY_PAGE_BLOCKS = 0


_PAGE_OF = "2 * (({o}) // (2 * {n})) + (game_mode = 'bakery')::int"


@register("q_recipe_records", O.with_ctes("fx_recipe_raw") + f"""
select cast({_PAGE_OF.format(o='rcp_ord', n=fixtures.PAGE_BLOCKS)} as bigint) as page_id,
       pos, game_mode, rcp_name, appl_name, rcp_cost, rcp_servings, rcp_time_hr, rcp_xp, rcp_income,
       coalesce(rcp_labels, '') as rcp_labels, case when rcp_ord % 6 <> 1 then rcp_level end as rcp_level,
       case when rcp_ord % 3 = 0 then rcp_release_date end as rcp_release_date,
       case when rcp_ord % 7 <> 3 then rcp_img_url end as rcp_img_url, cast(null as varchar) as appl_img_url,
       case when rcp_ord % 5 <> 4 then rcp_url end as rcp_url
from (select *, row_number() over (partition by game_mode, rcp_ord // {2 * fixtures.PAGE_BLOCKS} order by rcp_ord) as pos
      from fx_recipe_raw)
where rcp_ord % 13 <> 2""")
def q_recipe_records(spark, sf_dir):
    """Listing pages → typed recipe rows. The SQL reads the source columns, no page."""
    return recipe_records(fixtures.recipe_pages(spark, sf_dir))


@register("q_appliance_records", O.with_ctes("fx_appl") + f"""
select page_id, pos, game_mode, appl_name, appl_img_url, appl_unlock_level, appl_cost, appl_release_date, appl_recipes_count,
       appl_labels, 'http://www.example.com/s8/' || game_mode || '_appl_retr.php?page=' || (appl_ord // {2 * fixtures.PAGE_BLOCKS}) as appl_source_url
from (select cast({_PAGE_OF.format(o='appl_ord', n=fixtures.PAGE_BLOCKS)} as bigint) as page_id, game_mode, appl_name, appl_ord,
        row_number() over (partition by game_mode, appl_ord // {2 * fixtures.PAGE_BLOCKS} order by appl_ord) as pos,
        case when appl_ord % 4 <> 1 then appl_img_url end as appl_img_url,
        case when appl_ord % 5 <> 2 then appl_unlock_level end as appl_unlock_level, appl_cost,
        case when appl_ord % 3 = 0 then '2021-03-04' end as appl_release_date,
        case when appl_ord % 6 <> 3 then appl_recipes_count end as appl_recipes_count,
        trim(coalesce(split_part(appl_labels, ',', 1), '')) as appl_labels from fx_appl)""")
def q_appliance_records(spark, sf_dir):
    """Search pages → typed appliance rows (the URL is tagged by its ``_appl`` form, A11)."""
    return appliance_records(fixtures.appliance_pages(spark, sf_dir))


@register("q_take_while_pages", O.with_ctes("page_x") + f"""
, seq as (select page_id, nullif(host0, '') as host, {_PAGE_NO} as page_no,
                 len({_BLOCKS}) <= {EMPTY_PAGE_BLOCKS} as empty_page
          from page_x),
stops as (select host, min((page_no, page_id)) as stop from seq where empty_page group by host)
select s.page_id, s.host, s.page_no from seq s left join stops t on t.host is not distinct from s.host
where t.stop is null or (s.page_no, s.page_id) < t.stop""")
def q_take_while_pages(spark, sf_dir):
    """Per site in page order, keep pages before the first empty one."""
    p = _pages(spark, sf_dir)
    seq = p.select("page_id", T.url_host("url").alias("host"), P.page_number("url").alias("page_no"),
                   (P.paragraph_count("html") <= EMPTY_PAGE_BLOCKS).alias("empty_page"))
    kept = take_while(seq, ["host"], ["page_no", "page_id"], F.col("empty_page"))
    return kept.select("page_id", "host", "page_no")


@register("q_page_counts", O.with_ctes("page_x") + f"""
select page_id, nullif(host0, '') as host, {_PAGE_NO} as page_no, cast(n as bigint) as n_blocks,
  cast(sum(n) over (partition by nullif(host0, '') order by {_PAGE_NO} nulls first, page_id
                    rows between unbounded preceding and current row) as bigint) as running_blocks
from (select *, len({_BLOCKS}) as n from page_x)""")
def q_page_counts(spark, sf_dir):
    """Blocks per page and the running total per site in page order."""
    p = _pages(spark, sf_dir)
    seq = p.select("page_id", T.url_host("url").alias("host"), P.page_number("url").alias("page_no"),
                   P.paragraph_count("html").cast("bigint").alias("n_blocks"))
    return running_sum(seq, ["host"], ["page_no", "page_id"], "n_blocks", "running_blocks")


@register("q_bad_records", O.with_ctes("fx_recipe_raw") + """
select rcp_ord, field, raw_value from (
  select rcp_ord, 'rcp_cost' as field, rcp_cost as raw_value from fx_recipe_raw
  union all select rcp_ord, 'rcp_income', rcp_income from fx_recipe_raw
  union all select rcp_ord, 'rcp_xp', rcp_xp from fx_recipe_raw
  union all select rcp_ord, 'rcp_time_hr', rcp_time_hr from fx_recipe_raw)
where raw_value is not null and (
  (field <> 'rcp_time_hr' and try_cast(nullif(regexp_replace(raw_value, '[^0-9-]', '', 'g'), '') as bigint) is null)
  or (field = 'rcp_time_hr' and nullif(regexp_extract(raw_value, '([0-9]+[.]?[0-9]*)', 1), '') is null))""")
def q_bad_records(spark, sf_dir):
    """K11/trap 10: fields that do not parse go to a quarantine table (field, raw text)."""
    from ..operators.quality import quarantine
    return quarantine(fixtures.recipe_raw(spark, sf_dir), "rcp_ord",
                      ints=("rcp_cost", "rcp_income", "rcp_xp"), hours=("rcp_time_hr",))


_BLOCK_NO = "row_number() over (partition by game_mode, {o} // {n} order by {o})"


@register("q_bad_rows", O.with_ctes("fx_recipe_raw", "fx_appl", extra=f"""appl_rows as (
select cast({_PAGE_OF.format(o='appl_ord', n=fixtures.PAGE_BLOCKS)} as bigint) as page_id, appl_ord,
       {_BLOCK_NO.format(o='appl_ord', n=2 * fixtures.PAGE_BLOCKS)} as pos,
       case when appl_ord % 23 = 9 then 'no name'
            when appl_ord % 29 = 4 and appl_ord % 5 <> 2 then 'level is no number' end as own
from fx_appl),
first_bad as (select page_id, min(pos) as stop from appl_rows where own is not null group by page_id)""") + f"""
select 'csv' as input, rcp_ord as place, 0 as pos, 'does not fit the schema' as error
from fx_recipe_raw where rcp_ord % 53 = 11 or rcp_ord % 59 = 7
union all
select 'recipe page', cast({_PAGE_OF.format(o='rcp_ord', n=fixtures.PAGE_BLOCKS)} as bigint), pos, 'recipe image without source'
from (select *, {_BLOCK_NO.format(o='rcp_ord', n=2 * fixtures.PAGE_BLOCKS)} as pos from fx_recipe_raw)
where rcp_ord % 17 = 6 and rcp_ord % 7 <> 3
union all
select 'appliance page', page_id, pos, case when pos > stop then 'after a bad block' else own end
from appl_rows join first_bad using (page_id) where pos >= stop""")
def q_bad_rows(spark, sf_dir):
    """Rows of CSV files and blocks of pages that cannot be read, each with its place and
    reason. Good and bad rows come from one written table; a bad row stops no run."""
    from pyspark.sql.types import LongType, StructField, StructType

    from ..sinks.publish import scratch_path
    from ..sources.catalogue import RECIPES
    from ..sources.records import appliance_rows, recipe_rows, split_errors
    from ..sources.tables import BAD_ROW, read_csv
    cols = ["rcp_ord", *RECIPES.fieldNames()]
    lines = fixtures.recipe_lines(spark, sf_dir, cols)
    path = scratch_path(spark, "recipe_lines")
    lines.select("value").write.text(path)
    table = read_csv(spark, path, StructType([StructField("rcp_ord", LongType()), *RECIPES.fields]), header=False, nullValue="\\N")
    table = table.withColumn("error", F.when(F.col(BAD_ROW).isNotNull(), "does not fit the schema"))
    _, lines_bad = split_errors(table)
    _, recipes_bad = split_errors(recipe_rows(fixtures.recipe_pages(spark, sf_dir, spoiled=True)))
    _, appl_bad = split_errors(appliance_rows(fixtures.appliance_pages(spark, sf_dir, spoiled=True)))
    as_rows = lambda df, name, place, pos: df.select(F.lit(name).alias("input"), place.alias("place"), pos.alias("pos"), "error")
    first = F.split(BAD_ROW, ",")[0].cast("bigint")
    return (as_rows(lines_bad, "csv", first, F.lit(0).cast("bigint"))
            .unionByName(as_rows(recipes_bad, "recipe page", F.col("page_id"), F.col("pos")))
            .unionByName(as_rows(appl_bad, "appliance page", F.col("page_id"), F.col("pos"))))


# ---------------------------------------------------------------- JSON / HTML tables

_FX_WIKI = """fx_wiki as (
select s_suppkey as doc,
  '{"parse":{"text":{"*":"' || '<table class=nav><tr><th>Name</th></tr><tr><td>' || s_name
  || '</td></tr></table><table class=wikitable><tr><th>Level</th><th>XP</th><th>Slots</th><th>Expansion</th></tr><tr><td>'
  || cast(s_suppkey as varchar) || '</td><td>' || cast(s_suppkey * 100 as varchar) || '</td><td>'
  || cast(2 + s_suppkey % 4 as varchar) || '</td><td>' || cast(s_nationkey as varchar)
  || '</td></tr><tr><td>x</td></tr></table>' || '"}}}' as j
from supplier)"""
O.add_cte("fx_wiki", _FX_WIKI)


@register("q_json_path", O.with_ctes("fx_wiki") + """
select doc, json_transform(j, '{"parse":{"text":"MAP(VARCHAR, VARCHAR)"}}').parse.text['*'] as html
from fx_wiki""")
def q_json_path(spark, sf_dir):
    """I16: ``parse.text['*']`` of a JSON document (the key is '*', not a wildcard)."""
    w = fixtures.wiki_json(spark, sf_dir)
    return w.select("doc", T.json_html_text("j").alias("html"))


@register("q_html_table_rows", O.with_ctes("fx_wiki", extra=f"""tabs as (
select doc, unnest(generate_series(1, len(t))) as tpos, unnest(t) as tab
from (select doc, list_filter(string_split_regex(json_transform(j, '{{"parse":{{"text":"MAP(VARCHAR, VARCHAR)"}}}}').parse.text['*'],
             '<table'), lambda x: contains(split_part(x, '>', 1), 'wikitable')) as t from fx_wiki)),
trs as (select doc, tpos, list_transform(string_split(tab, '<tr>')[2:], lambda r: split_part(r, '</tr>', 1)) as r from tabs),
heads as (select *, list_transform(string_split(r[1], '<th>')[2:], lambda h: lower(trim(split_part(h, '</th>', 1)))) as hdr from trs),
chosen as (select * from heads where list_has_all(hdr, {list(LEVEL_TABLE_HEADERS)})
  qualify row_number() over (partition by doc order by tpos) = 1),
body as (select doc, hdr, unnest(generate_series(1, len(r) - 1)) as row_pos, unnest(r[2:]) as tr from chosen)""") + """
select doc, cast(row_pos as bigint) as row_pos, c[1] as level, c[2] as xp, c[3] as slots, c[4] as expansion
from (select *, list_transform(string_split(tr, '<td>')[2:], lambda x: trim(split_part(x, '</td>', 1))) as c from body)
where len(c) = len(hdr)""")
def q_html_table_rows(spark, sf_dir):
    """First table of its class whose first row holds all required headers; rows with
    one cell per header become named columns (the short last row is dropped)."""
    from ..operators.tables_html import html_table_rows
    w = fixtures.wiki_json(spark, sf_dir)
    rows = html_table_rows(w.select("doc", T.json_html_text("j").alias("html")), "doc", "html",
                           LEVEL_TABLE_HEADERS)
    return clean_columns(rows)


# ---------------------------------------------------------------- sources and URLs

def _source_urls(spark, sf_dir):
    """Each recipe's listing-page URL (built from its game and table position) plus the
    page table's URLs: the inputs for source tagging."""
    r = fixtures.recipe_raw(spark, sf_dir)
    rec = r.select(F.lit("recipe").alias("src"), F.col("rcp_ord").alias("id"),
                   F.concat(F.lit("http://www.example.com/s8/"), F.col("game_mode"),
                            F.lit("_recipes_all.php?page="),
                            (F.floor(F.col("rcp_ord") / 40) + 1).cast("string")).alias("url"))
    pg = read_table(spark, sf_dir, "pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"), "url")
    return rec.unionByName(pg)


_SOURCE_URLS_SQL = """source_urls as (
select 'recipe' as src, rcp_ord as id,
       'http://www.example.com/s8/' || game_mode || '_recipes_all.php?page='
       || cast(cast(floor(rcp_ord / 40) + 1 as bigint) as varchar) as url from fx_recipe_raw
union all select 'page', page_id, url from pages)"""


@register("q_find_mode", O.with_ctes("fx_recipe_raw", extra=_SOURCE_URLS_SQL) + """
select src, id, case when contains(url, 'bakery') then 'bakery'
                     when contains(url, 'restaurant') then 'restaurant' else 'other' end as mode
from source_urls""")
def q_find_mode(spark, sf_dir):
    """A10: source tag by substring, first match wins (bakery, restaurant, other)."""
    from ..sources.multi import find_mode
    u = _source_urls(spark, sf_dir)
    return u.select("src", "id", find_mode("url").alias("mode"))


@register("q_url_tag", O.with_ctes("fx_recipe_raw", extra=_SOURCE_URLS_SQL) + """
select src, id, nullif(regexp_extract(url, '/s8/(\\w+)_recipes', 1), '') as game_tag from source_urls""")
def q_url_tag(spark, sf_dir):
    """Source tag by regex group, null when absent."""
    u = _source_urls(spark, sf_dir)
    return u.select("src", "id", T.regex_field("url", r"/s8/(\w+)_recipes").alias("game_tag"))


@register("q_search_urls", O.with_ctes("fx_recipe_raw") + """
, names as (select rcp_ord, trim(unnest(string_split(appl_name, ','))) as appl_name
            from fx_recipe_raw where appl_name is not null),
firsts as (select appl_name, min(rcp_ord) as first_ord from names group by appl_name)
select appl_name, first_ord,
  replace('http://www.example.com/s8/restaurant_appl_retr.php?search_appl={}', '{}',
    replace(array_to_string(list_transform(regexp_extract_all(appl_name, '(\\p{L}+|[^\\p{L}]+)', 1),
            lambda r: upper(r[1]) || lower(r[2:])), ''), ' ', '_')) as search_url
from firsts""")
def q_search_urls(spark, sf_dir):
    """Appliance names → split, trim, first-seen unique, slug, URL."""
    from ..sources.multi import search_urls
    return search_urls(fixtures.recipe_raw(spark, sf_dir), "appl_name", "rcp_ord",
                       "http://www.example.com/s8/restaurant_appl_retr.php?search_appl={}")


QUERIES = register.queries
ORACLE = register.oracle
