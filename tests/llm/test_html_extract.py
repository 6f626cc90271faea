import re

from tallyloom.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{x:"</p>"}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies {n}.</p></div>
<article><h1>Title   {n} &amp; more</h1><!-- no --><p>First <b>bold</b>&nbsp;part
of {n}.<br>Same block<p>Second &lt;{n}&gt;<p>{n} third<div class="ad banner">Buy {n}</div>{more}
<form><p>Name {n}</p></form><section class="comments"><article><p>I say {n}</p></article></section></article>
<aside><p>Related {n}</p></aside><footer>&copy; {n}</footer>"""
WANT = "Title {n} & more\nFirst bold part of {n}. Same block\nSecond <{n}>\n{n} third"


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "'x' AS text", "2 AS path")
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    return {r.page_id: r for r in got.collect()}


def test_furniture_goes_and_blocks_stay(spark):
    rows = [(i, f"http://a.com/{i}", PAGE.format(n=i, more="<ul><li>x<li>y</ul>" * (i % 2))) for i in range(6)]
    got = extracted(spark, rows)
    for i in range(6):
        assert got[i].text == WANT.format(n=i) + "\nx\ny" * (i % 2)
        assert got[i].n_chars == len(got[i].text)


def test_without_an_article(spark):
    page = "<body><div id=menu><a href=1>one</a><a href=2>two</a></div><div class=body><p>Text {n}.</p><p>More {n}.</p></div><ul><li><a href=a>Link {n}</a></li><li><a href=b>Other {n}</a></li></ul><p>Printed by us</p></body>"
    got = extracted(spark, [(i, "http://b.com/", page.format(n=i)) for i in range(4)])
    assert [got[i].text for i in range(4)] == [f"Text {i}.\nMore {i}." for i in range(4)]


def test_text_that_pages_share_stays_in_an_article(spark):
    page = "<nav><a href=1>Home</a></nav><{0}><h1>One title</h1><h2>Notes</h2><p>First {1}.</p><p>Second {1}.</p></{0}>"
    rows = [(i, "http://copies.com/", page.format("article", "x")) for i in range(4)]
    rows += [(10 + i, "http://fixed.com/", page.format("article", i)) for i in range(4)]
    rows += [(20 + i, "http://main.com/", page.format("main", i)) for i in range(4)]
    rows += [(30 + i, "http://plain.com/", page.format("div", "x")) for i in range(4)]
    rows += [(40 + i, "http://two.com/", page.format("div", "xy"[i % 2])) for i in range(4)]
    rows += [(50 + i, "http://body.com/", page.format("div", i)) for i in range(4)]
    got = extracted(spark, rows)
    for i in range(4):
        for start, n in ((0, "x"), (10, i), (20, i), (30, "x"), (40, "xy"[i % 2])):
            assert got[start + i].text == f"One title\nNotes\nFirst {n}.\nSecond {n}.", start
        assert got[50 + i].text == f"First {i}.\nSecond {i}."  # outside a container: template text of distinct pages


def test_main_and_the_article_in_it(spark):
    page = "<p>Out {0}</p><main><h1>Title {0}</h1><article><p>Text {0}.</p></article><p>Note {0}.</p></main>"
    got = extracted(spark, [(i, "http://h.com/", page.format(i)) for i in range(3)])
    assert [got[i].text for i in range(3)] == [f"Title {i}\nText {i}.\nNote {i}." for i in range(3)]


def test_odd_rows(spark):
    rows = [
        (1, None, "<p>Alone"), (2, "x", None), (3, "http://c.com", ""), (4, "http://c.com", "plain &amp; simple"), (4, "http://c.com", "plain &amp; simple"),
        (5, "http://d.com", "<p>" + "long words " * 50_000), (6, "http://e.com", "</div></b><p class=>a < b <i>c</b></p><"), (7, "http://f.com", "<nav>only</nav>"),
        (None, "http://g.com", "<main><p>Main</p></main><p>not main</p>"),
    ]
    got = extracted(spark, rows)
    assert [got[i].text for i in (1, 2, 3, 4)] == ["Alone", "", "", "plain & simple"]
    assert len(got[5].text) == 11 * 50_000 - 1 and got[6].text == "a < b c\n<" and got[7].text == "" and got[None].text == "Main"
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_table_and_beyond_the_broadcast(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(re.sub(r"<[^>]*>", "", b).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        import html

        assert got[r.page_id] == "\n".join(html.unescape(b) for b in blocks if b)
    monkeypatch.setattr(html_extract, "MAX_BROADCAST_SLOTS", 0)
    assert {r.page_id: r.text for r in html_extract.extract(pages).collect()} == got


def test_folding_and_alignment():
    assert html_extract.folded("<ul <li # >li <li # >li <li # >li >ul".split()) == ("<ul", "(<li # >li)+", ">ul")
    a, b = ("<p", "#", ">p"), ("<p", "#", ">p", "<table", ">table")
    assert html_extract.merged(a, b) == ("<p", "#", ">p", "(<table >table)?")
    assert html_extract.merged(("(<li # >li)+", "x"), ("<li # >li".replace(" ", " "), "x"))[-1] == "x"


def test_wrappers(spark):
    rows = [(i, "http://a.com/", "<ul>" + "<li>x</li>" * i + "</ul>" + "<p>y</p>" * (i % 2)) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extract.wrappers(html_extract._parts(df)).collect()
    assert len(found) == 1 and found[0].pages == 4 and "(<li # >li)+" in found[0].wrapper


def test_a_host_of_many_streams_is_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "STREAMS_AT_ONCE", 3)
    rows = [(i, "http://a.com/", "".join(f"<{t}>x</{t}>" for k, t in enumerate(["p", "h2", "pre", "h3", "dl"]) if i >> k & 1)) for i in range(32)]
    df = spark.createDataFrame([*rows, (99, "http://b.com/", "<p>x</p>")], "page_id long, url string, html string")
    found = {r.host: r for r in html_extract.wrappers(html_extract._parts(df)).collect()}
    assert found["a.com"].pages == 32 and (found["b.com"].wrapper, found["b.com"].pages) == ("<p\n#\n>p", 1)
    assert all(f"<{t}" in found["a.com"].wrapper for t in ["p", "h2", "pre", "h3", "dl"])
