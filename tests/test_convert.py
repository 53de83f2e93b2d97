"""Hand-written HTML goldens for the clean-up operators and the whole conversion."""

import pytest
from pyspark.sql import functions as F

from pagelex.operators import clean as C
from pagelex.operators import nodes as N
from pagelex.operators import selectors as S
from pagelex.plans.convert import ConvertOptions, convert_articles
from tests.helpers import make_dims

ARTICLES = {
    1: ("Ab Def", '<html><head><title>T</title><link rel="dc:isVersionOf" href="http://x.org/wiki/Ab_Def">'
                  '<meta charset="utf-8"></head><body><div class="navbox"><p>x</p></div>tail'
                  '<a class="new" href="./X">red</a><h2 id="s1">One</h2>'
                  '<p>a<a class="autonumber" href="http://e.org/1"></a><a class="autonumber" href="http://e.org/2">t</a>'
                  '<a class="autonumber" href="http://e.org/3"></a></p>'
                  '<h3 id="s2">Two <span></span></h3><h4 id="s3">Three</h4><h2>no id</h2>'
                  '<a href="/wiki/Category:Z">c</a> <a href="w:Foo">iw</a> <a href="/wiki/Ab_Def#n1">self</a>'
                  '<span class="geo-nondefault"><span class="geo">1.5; 2.5</span></span>'
                  '<a class="mw-kartographer-map" data-lat="45" data-lon="7" data-zoom="12" data-overlays="[]" '
                  'data-style="osm" data-height="1" data-width="2"><img src="//x/y.png" srcset="//x/z.png 2x"></a>'
                  '<a class="mw-kartographer-map" data-lat="45" data-lon="7" data-zoom="12">gone</a>'
                  '<span class="mwe-math-element" data-mw=\'{"body":{"extsrc":"x^2"}}\'>'
                  '<img class="mwe-math-fallback-image-inline" src="//m/x.png" alt="x^2"></span>'
                  '<span class="mwe-math-element" data-mw="{bad"><img class="mwe-math-fallback-image-inline" src="//m/y.png"></span>'
                  '<script>evil()</script><!-- c --><p onclick="x()" id="mw1" title="t">k</p></body></html>'),
    2: ("Empty", None),
    3: ("Frag", "<p>just <b>text</b>"),
    4: ("Toc", '<body><div id="toc"><ul><li>existing</li></ul></div><h2 id="a">A</h2></body>'),
}


@pytest.fixture(scope="module")
def converted(spark):
    dims = make_dims(spark, ["Category"], {"w": "http://en.wikipedia.org/wiki/$1"}, server="http://en.example.org")
    arts = spark.createDataFrame([(k, t, h) for k, (t, h) in ARTICLES.items()], "article_id long, title string, text string")
    rows = convert_articles(arts, dims, ConvertOptions(rules=[".navbox"])).collect()
    return {r.article_id: r for r in rows}


def html(r):
    return (r.content or b"").decode("utf-8")


def test_statuses(converted):
    assert {k: r.status for k, r in converted.items()} == {1: "S", 2: "E", 3: "S", 4: "S"}
    assert converted[2].n_bytes == 0


def test_rules_sanitise_unwrap(converted):
    h = html(converted[1])
    assert "navbox" not in h and "tail" in h           # subtree dropped, tail kept
    assert "evil" not in h and "<!--" not in h          # script + comment gone
    assert 'class="new"' not in h and "red" in h        # a.new unwrapped
    assert "onclick" not in h and 'id="mw1"' not in h and 'title="t"' not in h
    assert "<meta" not in h and "<title>" not in h       # head dropped


def test_links_and_autonumber(converted):
    h = html(converted[1])
    assert 'href="http://en.example.org/wiki/Category:Z"' in h
    assert 'href="http://en.wikipedia.org/wiki/Foo"' in h
    assert 'href="#n1"' in h
    assert ">[1]</a>" in h and ">t</a>" in h and ">[3]</a>" in h


def test_header_and_toc(converted):
    h = html(converted[1])
    assert '<a id="view-online-link" href="http://x.org/wiki/Ab_Def">Ab Def</a>' in h
    assert ('<div id="a2-toc"><ol class="toc"><li><a href="#s1">One</a><ol><li><a href="#s2">Two </a>'
            '<ol><li><a href="#s3">Three</a></li></ol></li></ol></li></ol></div>') in h
    h4 = html(converted[4])
    # existing #toc is moved into the header, not generated
    assert h4.index('id="a2-article-header"') < h4.index("existing") < h4.index("</details>")
    assert '<div id="a2-toc">' not in h4


def test_maps_geo_math(converted):
    h = html(converted[1])
    assert 'href="https://www.openstreetmap.org/#map=12/45.0/7.0" target="_blank"' in h
    assert 'src="https://tile.openstreetmap.org/12/2127/1473.png"' in h and "srcset" not in h
    assert "gone" not in h                              # map without required attributes removed
    assert 'href="geo:1.5,2.5"' in h and "geo-nondefault" not in h
    assert 'data-tex="x^2"' in h and "data-mw" not in h
    assert "//m/x.png" not in h and "//m/y.png" not in h
    assert converted[1].has_math and not converted[3].has_math
    assert "MathJax" in h and "MathJax" not in html(converted[3])


def test_fragment_wrapped(converted):
    h = html(converted[3])
    assert h.endswith("<div><p>just <b>text</b></p></div>") or "<div><details" in h


def test_tokenize_roundtrip(spark):
    src = '<div class="a"><p>x &amp; y<b>bold</b></p>tail<br><img src="a.png"></div>'
    df = spark.createDataFrame([(1, src)], "article_id long, text string")
    out = N.serialise(N.tokenize(df), wrap_tag=None).first().html
    assert out == src
    again = N.serialise(N.tokenize(spark.createDataFrame([(1, out)], "article_id long, text string")), wrap_tag=None).first().html
    assert again == out


def test_unclosed_balanced(spark):
    df = spark.createDataFrame([(1, "<p><b>x<p>y</div>z")], "article_id long, text string")
    assert N.serialise(N.tokenize(df), wrap_tag=None).first().html == "<p><b>x<p>yz</p></b></p>"


def test_nested_hits_drop_once(spark):
    df = spark.createDataFrame([(1, '<div class="x">a<div class="x">b</div>c</div>d')], "article_id long, text string")
    n = C.apply_rules(N.tokenize(df), [".x"])
    assert N.serialise(n, wrap_tag=None).first().html == "d"


def converted_body(spark, text, **options):
    arts = spark.createDataFrame([(1, "Ab", text, "./")], "article_id long, title string, text string, articlepath string")
    return convert_articles(arts, make_dims(spark), ConvertOptions(**options), header=False).first()


def body(spark, text, **options):
    return html(converted_body(spark, text, **options)).rpartition('title="Night">')[2]


def test_rules_see_raw_links_and_no_scripts(spark):
    got = body(spark, '<a href="./Ab#cite_1">n</a><a href="#cite_2">x</a><p><script>s</script></p>', rules=["p:empty", 'a[href^="#cite"]'])
    assert got == '<div><a href="#cite_1">n</a></div>'


def test_unwrapped_elements_hand_over_their_children(spark):
    assert body(spark, '<ul class="menu"><foo><li>x</li></foo>y</ul>', rules=["ul.menu > li"]) == '<div><ul class="menu">y</ul></div>'


def geo(href):
    return f'<a href="geo:{href}"><img class="a2-geo-link-icon" src="~%2Fimages%2FGlobe.svg"></a>'


def test_geo_links_of_any_number_and_depth(spark):
    many = "".join(f'<span class="geo">{i};{i}</span>' for i in range(12))
    got = body(spark, f'<div><p><b class="geo-nondefault">{many}</b></p></div>')
    assert got == "<div><div><p></p>" + "".join(geo(f"{i},{i}") for i in reversed(range(12))) + "</div></div>"
    two = body(spark, '<p><b class="geo-nondefault"><i class="geo">1;2</i></b><b class="geo-nondefault"><i class="geo">3;4</i></b></p>')
    assert two == "<div><p></p>" + geo("3,4") + geo("1,2") + "</div>"
    deep = body(spark, '<span class="geo">' + "<b>" * 30 + '<i class="latitude">5</i>' + "</b>" * 30 + '<i class="longitude">6</i></span>t')
    assert deep == "<div>" + geo("5,6") + "t</div>"


@pytest.mark.parametrize("style,expected", [
    ("color:red;\nbackground:blue", "color: red"),
    ("background:url(data:image/png;base64,AAA);color:red", "color: red"),
    ('content:";background:x";Background-Color : red ; margin:1px', 'content: &quot;;background:x&quot;;\nmargin: 1px'),
])
def test_background(spark, style, expected):
    text = f"<table class='infobox'><td style='{style}'>x</td></table>"
    assert f'<td style="{expected}">' in body(spark, text, remove_embedded_bg="table.infobox td")


def test_charsets(spark):
    lost = converted_body(spark, "<p>日</p>", html_encoding="latin1")
    assert (lost.status, lost.content) == ("F", None)
    assert bytes(converted_body(spark, "<p>é</p>", html_encoding="latin1").content).endswith("<p>é</p></div>".encode("latin-1"))
    with pytest.raises(ValueError):
        converted_body(spark, "x", html_encoding="klingon")


def test_empty_heading_spans_stay_without_generated_contents(spark):
    assert '<span id="old"></span>' in body(spark, '<h2 id="a"><span id="old"></span>A</h2>')


def test_line_addresses():
    from pagelex.sources.dump import line_address

    assert [line_address(x) for x in ("7", "2:30")] == [(1, 7), (2, 30)]
    for bad in ("", "a", "1:", "1:2:3", "-1"):
        with pytest.raises(ValueError):
            line_address(bad)


def test_articles_of_one_small_file_are_dealt_out_and_grouped_rows_need_no_other_exchange(spark):
    """One input partition, as of a small file, is no bound of the tokenizer's tasks, and windows use the partitions of grouped rows."""
    df = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(200)], "article_id long, text string").coalesce(1)
    at = lambda n: n.where(F.col("kind") == "doc").groupBy(F.spark_partition_id().alias("p")).count().count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert at(N.tokenize(df)) == at(N.tokenize(df, grouped=True)) == partitions > 1
    plan = N.serialise(C.apply_rules(N.tokenize(df, grouped=True), [".x .y"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(article_id") == 2 and "ENSURE_REQUIREMENTS" not in plan


def test_dangling_links_read_the_links_once(spark):
    from pagelex.operators import links as L

    pages = spark.createDataFrame([(i, f'<a href="/wiki/Hub">h</a><a href="/wiki/P_{i}">p</a><a href="/wiki/P_{i}#f">q</a>') for i in range(40)], "article_id long, text string")
    keys = spark.createDataFrame([(f"P {i}",) for i in range(0, 40, 2)] + [("P 0",), (None,)], "key string")
    out = L.dangling_links(L.links_table(N.tokenize(pages), make_dims(spark)), keys)
    got = {tuple(r) for r in out.collect()}
    assert got == {(i, "Hub", None, 1) for i in range(40)} | {(i, f"P {i}", f, 1) for i in range(1, 40, 2) for f in (None, "f")} and out.count() == 80
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_dangling_links_do_not_broadcast_the_keys(spark, tmp_path):
    """Spark takes the keys for as small as their file, though each is given to all parts."""
    from pagelex.operators import links as L

    spark.range(2000).select(F.concat(F.lit("P "), "id").alias("key")).write.parquet(f"{tmp_path}/keys")
    pages = spark.createDataFrame([(i, f'<a href="/wiki/P_{i}">p</a>') for i in range(1990, 2010)], "article_id long, text string")
    out = L.dangling_links(L.links_table(N.tokenize(pages), make_dims(spark)), spark.read.parquet(f"{tmp_path}/keys"))
    assert {r.target for r in out.collect()} == {f"P {i}" for i in range(2000, 2010)}
    joins = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftAnti" in x]
    assert joins and not any("Broadcast" in x for x in joins)


def test_windows_of_headings_see_headings_and_text_only(spark):
    from pagelex.operators import extract as X

    df = spark.createDataFrame([(1, '<div><h2 id="a">A<b>c</b></h2><p>x<br></p><h3 id="b"><i>B</i></h3></div>')], "article_id long, text string")
    out = X.headings(N.tokenize(df, grouped=True))
    assert sorted((r.level, r.id, r.text, r.listed) for r in out.collect()) == [(2, "a", "Ac", True), (3, "b", "B", True)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "tag" in plan[plan.rindex("Window ["):].split("Filter", 1)[1].split("\n")[0]


def test_plain_markup_is_scanned_and_gives_the_rows_of_the_stdlib_parser(monkeypatch):
    import random

    pieces = ["<p>", "</p>", '<P CLASS="a b">', '<a href="x&amp;y=1&lt" title=\'q"r\'>', "</a>", "<a HREF=x>", "<br/>", "<div/>", "<div id>", "text", "a &amp; b", "&lt", "<", "< 3",
              "<!-- c -->", "<!---->", "<!--a--b-->", "<!--open", "<!DOCTYPE html>", "<?pi x?>", '<script>var t="</p>";&amp;</script>', "<style>p{}</style>", "<script/>", "</SCRIPT>",
              "<script><!-- x</script>", '<foo bar="1" bar="2">', '<a b= "c">', '<a "x">', '<a b="c"d="e">', '<a b="c>', '">', "<![CDATA[x]]>", "<x:y z-1=\"\n\">", "\x00", "</>", "<h1/ >", "</x"]
    rnd = random.Random(3)
    docs = [("".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))), keep) for keep in (None, C.KEPT_TAGS) for _ in range(1500)]
    scanned = [N.tokenize_one(*d) for d in docs]
    with monkeypatch.context() as m:
        m.setattr(N._Tokenizer, "_scan", lambda self, s: 0)
        assert [N.tokenize_one(*d) for d in docs] == scanned
    monkeypatch.setattr(N._Tokenizer, "goahead", lambda self, end: 1 / 0)
    plain = '<!DOCTYPE html><div class="x">a &amp; b<!-- c --><br><img src="s"/></div><script>if (a < b) "</p>"</script>'
    assert N.tokenize_one(plain)["kind"] == ["doctype", "open", "text", "comment", "open", "open", "open", "text"]


def test_plain_markup_takes_few_calls_a_token():
    import sys

    t, calls = N._Tokenizer(), []
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        t.document('<p class="a" id="b">x<br></p>' * 100)
    finally:
        sys.setprofile(None)
    assert len(calls) < 4 * 100 and len(t.columns()[0]) == 301


def test_pieces_are_put_in_order_without_interpreted_functions(spark):
    df = spark.createDataFrame([(1, '<p id="a&lt;">x<br>&amp;<b></b></p>y')], "article_id long, text string")
    out = N.serialise(N.tokenize(df), wrap_tag=None)
    assert out.first().html == '<p id="a&lt;">x<br>&amp;<b></b></p>y'
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "sort_array" in plan


def test_styles_are_parsed_once_though_filters_read_the_result(spark):
    df = spark.createDataFrame([(1, '<p style="background: red; margin: 1px">x</p><p>y</p><p style="a(">z</p>')], "article_id long, text string")
    out = C.strip_background(N.tokenize(df), "p").where(F.startswith(F.col("attrs")["style"], F.lit("margin")))
    assert [r.attrs for r in out.collect()] == [{"style": "margin: 1px"}]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1


def test_partitions_of_grouped_rows_follow_the_size_of_the_articles(spark, monkeypatch):
    """Windows sort the rows of as many characters in a task at every size of the input."""
    df = spark.range(400).selectExpr("id AS article_id", "concat('<p>', id + 1000, '</p>') AS text")  # 11 characters each
    monkeypatch.setattr(N, "TASK_CHARS", 200, raising=False)
    at = lambda n: n.rdd.getNumPartitions()
    assert at(N.tokenize(df, grouped=True)) == 22 and at(N.tokenize(df.limit(3), grouped=True)) == 8


def test_conversion_is_cut_into_stages_that_keep_their_classes(spark):
    """No stage holds so many windows that an executor cannot hold the classes that it generates: every task would compile them anew."""
    df = spark.createDataFrame([(1, "A", "<h2 id='x'>y</h2>")], "article_id long, title string, text string")
    for header in (True, False):
        plan = convert_articles(df, make_dims(spark), ConvertOptions(rules=[".x .y"]), header=header)._jdf.queryExecution().executedPlan().toString()
        stages = plan.split("Exchange hashpartitioning(article_id")
        assert max(s.count("- Window [") for s in stages) <= 12 and sum(s.count("- Window [") for s in stages) > 12 * header
