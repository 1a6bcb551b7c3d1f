"""Page extraction edge cases: scripts holding "</p>", unclosed tags, comments, take-while."""

from pyspark.sql import functions as F

from slotplan.operators.windows import running_sum, take_while
from slotplan.sources import pages as P

HTML = ('<html><head><title> T1 </title><script>var t="</p><p>";</script><style>p{}</style></head>'
        '<body><nav><a href="/a">A</a><a href="/b"> </a><a href="/c">C</a></nav>'
        '<!-- <p>hidden</p> --><div class="ad">Buy</div><article><h1>Head <b>line</b></h1>'
        '<p><b>Lead<br><p>Two &amp; two</p><p>Three</article></body></html>')


def test_blocks_and_details(spark):
    pages = spark.createDataFrame([(1, "http://x.example.com/en/3", HTML),
                                   (2, "http://x.example.com/en/4", "<html><p>no heading</p></html>")],
                                  "page_id bigint, url string, html string")
    blocks = [(r.page_id, r.pos, r.text) for r in P.page_blocks(pages).orderBy("page_id", "pos").collect()]
    assert blocks[:3] == [(1, 1, "Lead"), (1, 2, "Two & two"), (1, 3, "Three")]
    det = P.page_details(pages).collect()
    assert len(det) == 1  # page 2 has no heading: skipped
    d = det[0]
    assert (d.title, d.heading, d.ad_text, d.first_link, d.last_link, d.host) == \
        ("T1", "Head line", "Buy", "A", "C", "x.example.com")


def test_take_while_stops_at_first_bad(spark):
    # statuses 200, 200, empty, 200 → pages 1-2 only; another source without a bad page keeps all
    df = spark.createDataFrame([("s", 1, False), ("s", 2, False), ("s", 3, True), ("s", 4, False),
                                ("t", 1, False), ("t", 2, False)], "src string, page int, bad boolean")
    kept = take_while(df, ["src"], ["page"], F.col("bad"))
    assert sorted((r.src, r.page) for r in kept.collect()) == [("s", 1), ("s", 2), ("t", 1), ("t", 2)]


def test_running_sum_chunks(spark):
    data = [("h", i, i * 10 + 1, i % 3) for i in range(50)] + [("k", 5, 1, 4), (None, 1, 2, 7)]
    df = spark.createDataFrame(data, "h string, o long, tie long, v long")
    out = running_sum(df, ["h"], ["o", "tie"], "v", "run", chunks=7)
    got = {(r.h, r.o): r.run for r in out.collect()}
    acc = 0
    for i in range(50):
        acc += i % 3
        assert got[("h", i)] == acc
    assert got[("k", 5)] == 4 and got[(None, 1)] == 7


def test_html_table_choice_and_missing_table(spark):
    from slotplan.operators.tables_html import html_table_rows
    html = ("<table><tr><th>Name</th></tr><tr><td>x</td></tr></table>"
            '<table><tr><th>Level</th><th>XP</th></tr><tr><td>9</td><td>9</td></tr></table>'
            '<TABLE id=t class="big wikitable"><tr><th> Level </th><th>XP</th></tr><tr><td>1</td><td>0</td></tr>'
            "<tr><td>2</td><td><b>1,200</b></td></tr><tr><td>3</td></tr><tr><th>Level</th><th>XP</th><th>Sum</th></tr></table>")
    df = spark.createDataFrame([(1, html)], "doc int, html string")
    rows = html_table_rows(df, "doc", "html", ("level", "xp")).orderBy("row_pos").collect()
    assert [(r.row_pos, r.level, r.xp) for r in rows] == [(1, "1", "0"), (2, "2", "1,200")]
    wide = html_table_rows(df, "doc", "html", ("level", "xp"), min_cells=1).orderBy("row_pos").collect()
    assert [(r.level, r.xp) for r in wide] == [("1", "0"), ("2", "1,200"), ("3", None)]
    from slotplan.operators.tables_html import missing_tables
    bad = spark.createDataFrame([(1, html), (2, "<table><tr><th>Name</th></tr></table>"), (3, None)], "doc int, html string")
    assert html_table_rows(bad, "doc", "html", ("level", "xp")).select("doc").distinct().count() == 1
    assert [r.doc for r in missing_tables(bad, "doc", "html", ("level", "xp")).orderBy("doc").collect()] == [2, 3]


def test_paragraphs_and_links_with_markup(spark):
    page = ('<NAV class="x"><a class=y href="/1">one <b>two</b></a><a href=/2>2</a><a name=z>no</a></NAV>'
            '<P class="x">See <a href="x">here</a> for <abbr>more</abbr></P><pre>code</pre><div><p>in div</div>tail<p>last')
    df = spark.createDataFrame([(1, "http://h/1", page)], "page_id bigint, url string, html string")
    assert [r.text for r in P.page_blocks(df).orderBy("pos").collect()] == ["See here for more", "in div", "last"]
    links = df.select(F.explode(P.nav_links("html")).alias("l")).select("l.*").collect()
    assert [(r.href, r.text) for r in links] == [("/1", "one two"), ("/2", "2"), (None, "no")]


def test_running_sum_splits_a_key_of_equal_order_values(spark):
    from slotplan.operators.windows import range_chunks
    df = spark.createDataFrame([("h", None if i % 2 else 5, i, 1) for i in range(400)], "h string, o long, tie long, v long")
    assert range_chunks(df, ["h", "o", "tie"], 8).select("_chunk").distinct().count() > 3
    got = running_sum(df, ["h"], ["o", "tie"], "v", "run", chunks=8).collect()
    assert sorted(r.run for r in got) == list(range(1, 401))
    assert {r.tie: r.run for r in got}[1] == 1              # nulls come first
