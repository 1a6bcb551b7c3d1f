"""Nested elements, record errors, file order: catalogue reading on real-looking input."""

import os

import pytest
from pyspark.sql import functions as F

from slotplan.sources import elements as E
from slotplan.sources.catalogue import from_csv
from slotplan.sources.records import appliance_records, appliance_rows, recipe_records, recipe_rows, split_errors


def one(spark, html, expr):
    return spark.createDataFrame([(html,)], "h string").select(expr(F.col("h")).alias("x")).first()["x"]


def test_elements_nest(spark):
    html = ('a<div class="n"><div>Pie</div> big</div>b<div class=m>1</DIV ><div class="x n">2<divx></div>'
            '<div class=n>open <span>t</span>')
    assert one(spark, html, lambda h: E.inside(h, "div", "n")) == ["<div>Pie</div> big", "2<divx>", "open <span>t</span>"]
    assert one(spark, html, lambda h: E.first_text(h, "div", "n")) == "Pie big"
    assert one(spark, html, lambda h: E.first_text(h, "div", "none")) is None
    assert one(spark, html, lambda h: E.inside(h, "div"))[:2] == ["<div>Pie</div> big", "Pie"]
    own = '<div class=n>1<div class=n>2<div class=n>3</div></div>4</div>5'
    assert [x.replace("<div class=n>", "(").replace("</div>", ")") for x in one(spark, own, lambda h: E.inside(h, "div", "n"))] == ["1(2(3))4", "2(3)", "3"]
    assert one(spark, "", lambda h: E.inside(h, "div", "n")) == []
    assert one(spark, None, lambda h: E.first_inside(h, "div", "n")) is None
    deep = "<div class=n>" + "<div>" * 200 + "x" + "</div>" * 200 + "y</div>z"
    assert one(spark, deep, lambda h: E.first_text(h, "div", "n")) == "xy"


RECIPE = ('<span class="appliance_single_recipe"><div class="invtitle2"><div>Pie</div> big</div><div class=rcpcost>c: 99</div>'
          '<div class="hide-on-mobile"><div class=applname><div>Oven</div></div><div><div>Lvl: none</div><i>Lvl:</i> 12</div>'
          '<span class=sd_label><span>New</span></span><div class=rcpxp>1 xp</div>'
          '<div class=detstats><div class=rcpcost>c: <div>12</div></div><div class=rcpxp>40 xp</div></div></div>{img}</span>')


def pages(spark, *html, url="http://h/s8/bakery_recipes_all.php?page=1"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], "page_id bigint, url string, html string")


def test_records_of_nested_fields(spark):
    r = recipe_records(pages(spark, RECIPE.format(img=""))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.rcp_name, r.rcp_cost, r.rcp_xp, r.appl_name, r.rcp_level, r.rcp_labels) == ("Pie big", "c: 12", "40 xp", "Oven", 12, "New")
    assert (r.rcp_income, r.rcp_release_date, r.game_mode, r.pos) == (None, None, "bakery", 1)


def test_bad_recipe_blocks_stand_alone(spark):
    bad = RECIPE.format(img="<div class=rcp_view><img alt=x></div>")
    p = pages(spark, bad + RECIPE.format(img="<div class=rcp_view><img src=a.png></div>") + bad)
    good, errors = split_errors(recipe_rows(p))
    assert [(r.pos, r.rcp_img_url) for r in good.collect()] == [(2, "a.png")]
    assert [(r.pos, r.error) for r in errors.orderBy("pos").collect()] == [(1, "recipe image without source"), (3, "recipe image without source")]
    other = recipe_rows(pages(spark, RECIPE.format(img=""), url="http://h/x")).collect()
    assert [r.error for r in other] == ["no game in the address"]
    assert recipe_rows(p.limit(0)).count() == 0 and recipe_rows(pages(spark, None, "")).count() == 0


def block(name="<div class=appltitle>{}</div>", lvl="1", img="<img src=x.png>"):
    return ('<div class="appliance_parts_block">' + name.format("N" + lvl) + f"<span class=appliance_parts_parts>{img}</span>"
            f"<div class=lvl>{lvl}</div><span class=details>c: 5</span></div>")


def test_bad_appliance_block_ends_its_page(spark):
    p = pages(spark, block(lvl="1") + block(lvl="2") + block(lvl="x3") + block(lvl="4"), block(lvl="5") + block(name="", lvl="6"),
              block(img="<img>"), url="http://h/s8/bakery_appl_retr.php")
    assert sorted((r.page_id, r.appl_name) for r in appliance_records(p).collect()) == [(0, "N1"), (0, "N2"), (1, "N5")]
    _, errors = split_errors(appliance_rows(p))
    assert [(r.page_id, r.pos, r.error) for r in errors.orderBy("page_id", "pos").collect()] == [
        (0, 3, "level is no number"), (0, 4, "after a bad block"), (1, 2, "no name"), (2, 1, "image without source")]


HEAD = "game_mode,rcp_name,appl_name,rcp_cost,rcp_servings,rcp_time_hr,rcp_xp,rcp_income,rcp_labels,rcp_level,rcp_release_date,rcp_img_url,appl_img_url,rcp_url\n"


def test_table_order_is_file_and_line_order_and_bad_rows_are_listed(spark, tmp_path):
    folder = tmp_path / "recipes"
    folder.mkdir()
    line = lambda n, level="3": f"bakery,{n},Oven,c: 1,1,1 hrs,3 xp,5 coins,,{level},,,,u\n"
    (folder / "a.csv").write_text(HEAD + line("a1") + line("a2", "many") + line("a3"))
    (folder / "b.csv").write_text(HEAD + "".join(line(f"b{i}") for i in range(4000)) + "bakery,short\n")
    appl, lev = tmp_path / "appl.csv", tmp_path / "lev.csv"
    appl.write_text("game_mode,appl_name,appl_img_url,appl_unlock_level,appl_cost,appl_release_date,appl_recipes_count,appl_labels,appl_source_url\n"
                    "bakery,Oven,,1,100,,2,,s\nbakery,Grill,,one,1,,1,,s\n")
    lev.write_text("level,xp,slots,expansion\n1,0,2,0\n2,100,3,0\n")
    cat = from_csv(spark, str(folder), str(appl), str(lev))
    names = [r.rcp_name for r in cat.recipes.orderBy("rcp_ord").collect()]
    assert names == ["a1", "a3", *[f"b{i}" for i in range(4000)]]
    bad = [(r.input, os.path.basename(r.file), r.row_no, r.raw.split(",")[1]) for r in cat.rejected.orderBy("input", "row_no").collect()]
    assert bad == [("appliances", "appl.csv", 2, "Grill"), ("recipes", "a.csv", 2, "a2"), ("recipes", "b.csv", 4004, "short")]
    from slotplan.pipeline import run_pipeline
    paths = run_pipeline(spark, cat, str(tmp_path / "out"), steps=["clean", "master"])
    assert spark.read.parquet(paths["master"]).count() == 4002
    assert spark.read.parquet(paths["rejected"]).count() == 3


@pytest.mark.parametrize("name", ["fill", "max", "asof"])
def test_ordered_operators_equal_plain_windows(spark, name):
    import random

    from slotplan.operators.asof import asof_merge
    from slotplan.operators.windows import fill_forward, running_max
    rnd = random.Random(4)
    rows = [(rnd.choice(["h", "h", "h", "k", None]), rnd.choice([None, *range(40)]), i, rnd.choice([None, None, *range(9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, tie int, v int")
    by = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])
    if name == "asof":
        entries = df.where("tie % 3 = 0").select("g", F.col("o").alias("at"), F.col("tie").alias("t"), F.col("v").alias("w"))
        got = {r.tie: (r.t, r.w) for r in asof_merge(df, entries, ["g"], "o", ["t", "w"], entry_at="at", tie=["t"], chunks=9).collect()}
        have = [(g, o, t, v) for g, o, t, v in rows if t % 3 == 0 and g is not None and o is not None]
        for g, o, t, _ in rows:
            fit = [e for e in have if e[0] == g and o is not None and e[1] <= o]
            best = max(fit, key=lambda e: (e[1], e[2]), default=None)
            assert got[t] == ((best[2], best[3]) if best else (None, None))
        return
    got = {r.tie: r.x for r in (fill_forward(df, ["g"], ["o", "tie"], "v", "x", F.lit(-1), chunks=9) if name == "fill"
                                else running_max(df, ["g"], ["o", "tie"], "v", "x", chunks=9)).collect()}
    last = {}
    for g, _, t, v in sorted(rows, key=by):
        if name == "fill":
            last[g] = v if v is not None else last.get(g, -1)
        else:
            last[g] = v if last.get(g) is None else last[g] if v is None else max(v, last[g])
        assert got[t] == last[g]


def test_staircases_merge(spark):
    """Steps of two halves merge into the steps of all rows, and answer any time."""
    import random

    from slotplan.operators.staircase import best_at, merged, staircase
    rnd = random.Random(7)
    rows = [(i, rnd.choice("ab"), rnd.choice([None, *range(30)]), rnd.choice([None, *range(50)])) for i in range(300)]
    df = spark.createDataFrame(rows, "o bigint, g string, t int, m bigint")
    of = lambda d: staircase(d, ["g"], "t", "m", ["o"], {"id": "o"}, chunks=5)
    whole = sorted((r.g, r.time, r.best.id) for r in of(df).collect())
    halves = merged(of(df.where("o < 100")), of(df.where("o >= 100")), ["g"])
    assert sorted((r.g, r.time, r.best.id) for r in halves.collect()) == whole
    asks = spark.createDataFrame([(g, t) for g in "abc" for t in range(-1, 32)], "g string, at int")
    got = {(r.g, r["at"]): r.best.id if r.best else None for r in best_at(asks, halves, ["g"], "at").collect()}
    for (g, t), i in got.items():
        fit = [r for r in rows if r[1] == g and r[2] is not None and r[2] <= t]
        best = max(fit, key=lambda r: (r[3] is not None, r[3] or 0, -r[0]), default=None)
        assert i == (best[0] if best else None)


def test_too_many_levels_is_an_error_by_name(spark, monkeypatch):
    from slotplan.operators import levels
    raw = spark.range(30).selectExpr("cast(id as string) as level", "cast(id * 10 as string) as xp", "cast(null as string) as slots")
    assert len(levels.level_array(raw).first()["levels"]) == 30
    monkeypatch.setattr(levels, "MAX_LEVELS", 29)
    with pytest.raises(Exception, match="TooManyLevels"):
        levels.level_array(raw).collect()


def _odd_fragments():
    import random
    rnd = random.Random(11)
    bits = ["<div>", "<DIV class=n>", "<div class='a n b'>", '<div id=1 class="n">', "</div>", "</div >", "</div/>", "</div x>", "<div <div class=n>",
            "<divx>", "<span class=n>", "</span>", "<img>", "<img alt=x src=a.png>", "<img src='b c'>", "<a href=\"u&amp;v\">", "Lvl: 3", " t ", "&lt;", "<", ">",
            "<div class=n", "</div", "<!-- <div class=n> -->", "\t", "\u00a0x", "\u0130"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]


def test_fragments_in_python_follow_the_native_rules(spark):
    from slotplan.sources import fragments as P
    texts = _odd_fragments()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, h string").repartition(4)
    h = F.col("h")
    native = df.select("i", E.inside(h, "div", "n").alias("cls"), E.inside(h, "div").alias("all"), E.first_inside(h, "div", "n").alias("first"),
                       E.first_text(h, "span", "n").alias("text"), E.first_tag(h, "img").alias("tag"),
                       E.attribute(h, "img", "src").alias("src"), E.attribute(h, "a", "href").alias("href")).collect()
    assert len(native) == len(texts)
    for r in native:
        s = texts[r.i]
        whole, cut = (0, len(s)), lambda x: None if x is None else s[x[0]:x[1]]
        got = ([cut(x) for x in P.inside(s, whole, "div", "n")], [cut(x) for x in P.inside(s, whole, "div")], cut(P.first_inside(s, whole, "div", "n")),
               P.first_text(s, whole, "span", "n"), cut(P.first_tag(s, whole, "img")), P.attribute(s, whole, "img", "src"), P.attribute(s, whole, "a", "href"))
        assert got == (r.cls, r["all"], r["first"], r.text, r.tag, r.src, r.href), s


def test_array_reader_of_recipes_equals_the_page_reader():
    """Odd pages are named, all others give the rows of one page at a time."""
    import random

    from slotplan.sources import fragments as P
    from slotplan.sources import records as R
    rnd = random.Random(3)
    bits = ["<div>", "<DIV class=hide-on-mobile>", "<div class='applname x'>", '<div class="detstats">', "</div>", "</div>", "</div >", "</div\n>",
            "<span class=appl_view>", "<img>", "<img alt=x src=a.png>", "<img src='b>c'>", "<a class=go>", '<a href="u&amp;>v">', "Lvl: 3", "Lvl:\t0012", "Lvl: 99999999999",
            " t ", "&lt;", '<span class="row appliance_single_recipe">', "<SPAN class=appliance_single_recipe>", "</span>", "<span class=sd_label>",
            "<div class=rcp_view>", "<div class=rcpcost>", "<div class=invtitle2>", "é", "<div/>", "<br/>"]
    odd = ["</div/>", "</div x>", "<div <div class=applname>", "<", "<div class=detstats", "</div", "<!-- x", "a<b", ">"]
    rows = odd_pages = 0
    for _ in range(400):
        pages = []
        for _ in range(rnd.randint(1, 6)):
            pool = bits + (odd if rnd.random() < 0.4 else [])
            some = [rnd.choice(pool) for _ in range(rnd.randint(0, 60))]
            half = len(some) // 2
            pages.append(P.clean("".join(['<span class="appliance_single_recipe"><div class=hide-on-mobile>', *some[:half],
                                          "<div class=detstats>" if rnd.random() < 0.7 else "", *some[half:]])))
        at, columns, strange = R._plain_recipes(pages)
        want = [(i, *r) for i, s in enumerate(pages) if not strange[i] for r in R._recipe_blocks(s)]
        assert list(zip(at, *columns)) == want
        rows, odd_pages = rows + len(want), odd_pages + int(strange.sum())
    assert rows > 300 and odd_pages > 100
    assert R._plain_recipes([])[0] == [] and R._plain_recipes(["", "x"])[0] == []


def test_recipe_pages_are_dealt_evenly(spark):
    """Large pages are not merged into few tasks by their compressed size."""
    from slotplan.sources import fixtures
    table = fixtures.recipe_pages(spark, "/root/testdata/sf0.1")
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
