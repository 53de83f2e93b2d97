"""URL helpers and link rewriting, as Column tests."""

import pytest
from pyspark.sql import functions as F

from pagelex.functions import urls as U
from pagelex.operators.links import LinkParams, rewrite_srcset, rewrite_urls
from tests.helpers import make_dims


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize("path,expected", [
    ("/pics/2024/cat.gif", True), ("/pics/jpeg", False), ("/scan.png.zip", False), ("/Z/Photo.JPEG", True), ("", False)])
def test_is_image(spark, path, expected):
    assert one(spark, U.is_image(F.lit(path))) is expected


@pytest.mark.parametrize("ap,sap,url,expected", [
    ("./", "/w/", "./Media:Song.ogg", "/w/Media:Song.ogg"),
    ("/page/", "/w/", "/page/A/B", "/w/A/B"),
    ("/page/", "/page/", "/other/A.png", "/other/A.png"),
])
def test_replace_article_path(spark, ap, sap, url, expected):
    assert one(spark, U.replace_article_path(F.lit(ap), F.lit(sap), F.lit(url))) == expected


@pytest.mark.parametrize("w,expected", [(2, 20), (20, 20), (21, 40), (961, 1280), (9999, 3840)])
def test_round_up(spark, w, expected):
    assert one(spark, U.round_up_thumb_width(F.lit(w))) == expected


@pytest.mark.parametrize("path,expected", [
    ("/m/thumb/9/9a/Boat.png/130px-Boat.png", "/m/thumb/9/9a/Boat.png/250px-Boat.png"),
    ("/m/thumb/9/9a/Boat.png/960px-Boat.png", "/m/thumb/9/9a/Boat.png/960px-Boat.png"),
    ("/m/9/9a/Boat.png", "/m/9/9a/Boat.png"),
])
def test_fix_thumb(spark, path, expected):
    assert one(spark, U.fix_thumb_width(F.lit(path))) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://host.test/a", "https://host.test/a"), ("//host.test/a?b", "http://host.test/a?b"), ("a/b", "a/b"), ("/a", "/a")])
def test_add_http(spark, url, expected):
    assert one(spark, U.add_http(F.lit(url))) == expected


def test_quote_unquote(spark):
    assert one(spark, U.quote_path(F.lit("Ab Def/x~y*z+é"))) == "Ab%20Def/x~y%2Az%2B%C3%A9"
    assert one(spark, U.unquote(F.lit("%D0%A4a+b"))) == "Фa+b"
    assert one(spark, U.unquote(F.lit("%zz"))) == "%zz"


CASES = [
    # (url, kwargs, expected)
    ("/wiki/Blue_whale#Diet", {}, "Blue%20whale#Diet"),
    ("/wiki/TCP/IP", {}, "TCP%2FIP"),
    ("/Root", {"articlepath": "/"}, "Root"),
    ("./Dot", {"articlepath": "./"}, "Dot"),
    ("./Dot", {"articlepath": "./", "server": "https://wiki.test"}, "Dot"),
    ("//cdn.test/a/b?c=d#e", {}, "http://cdn.test/a/b?c=d#e"),
    ("HTTPS://Cdn.test/A", {}, "https://Cdn.test/A"),
    ("plain", {}, "plain"),
    ("b:Cake", {"interwiki": {"b": "https://books.test/read/$1"}}, "https://books.test/read/Cake"),
    ("/wiki/Bild:Haus.png", {"server": "http://wiki.test", "namespaces": ["Bild"]}, "http://wiki.test/wiki/Bild:Haus.png"),
    ("/wiki/%C3%84nderung:Haus", {"server": "http://wiki.test", "namespaces": ["Änderung"]}, "http://wiki.test/wiki/%C3%84nderung:Haus"),
    ("/wiki/Datei:Haus.svg", {"server": "http://wiki.test", "ensure_ext": True}, "http://wiki.test/wiki/Datei:Haus.svg"),
    ("/wiki/Long_name#note", {"title": "Long name"}, "#note"),
    ("/wiki/Long_name", {"title": "Long name"}, "Long%20name"),
    # a line separator within a fragment doesn't end it
    ("/wiki/A#x\u2028y", {}, "A#x\u2028y"),
    # blanks before, and tabs and line ends inside, don't count
    (" \t/wiki/A\nB", {}, "AB"),
    # thumbnails on the upload host get a standard width
    ("//upload.wikimedia.org/m/Boat.png/130px-Boat.png", {}, "http://upload.wikimedia.org/m/Boat.png/250px-Boat.png"),
    # decisions: query kept once (Q1), other schemes pass through (Q15)
    ("/wiki/Up_down?action=raw&x=1#f", {}, "Up%20down?action=raw&x=1#f"),
    ("tel:+1_23", {}, "tel:+1_23"),
]


@pytest.mark.parametrize("url,kw,expected", CASES)
def test_convert_url(spark, url, kw, expected):
    dims = make_dims(spark, kw.get("namespaces", ()), kw.get("interwiki"), kw.get("server", ""),
                     kw.get("articlepath", "/wiki/"))
    p = LinkParams.from_dims(dims, ensure_ext_image_urls=kw.get("ensure_ext", False))
    df = spark.createDataFrame([(url, kw.get("title"))], "u string, title string")
    got = rewrite_urls(df, "u", "v", dims, p, title_col="title").first().v
    assert got == expected


SRCSET = [
    ("small.webp 320w, large.webp 1280w", "small.webp 320w, large.webp 1280w"),
    ("//cdn.test/s.webp 1x, /wiki/L_arge.webp 2x 100w", "http://cdn.test/s.webp 1x, L%20arge.webp 2x 100w"),
    ("//cdn.test/only.png", "http://cdn.test/only.png"),
    ("//cdn.test/a.png 1.5x,\n//cdn.test/b.png 2x", "http://cdn.test/a.png 1.5x,\n//cdn.test/b.png 2x"),
    ("https://tiles.test/t,1,a,9x9@2x.png?lang=en&k=v 2x", "https://tiles.test/t,1,a,9x9@2x.png?lang=en&k=v 2x"),
]


@pytest.mark.parametrize("value,expected", SRCSET)
def test_srcset(spark, value, expected):
    dims = make_dims(spark)
    df = spark.createDataFrame([(1, value)], "k int, s string")
    assert rewrite_srcset(df, "s", "t", dims).first().t == expected


def test_a_url_is_split_by_one_match(spark):
    urls = ["HTTP://h:1/p/a?q=1?2#f#g", "//h", "a:b:c", "1a:b", "?", "#", "", " \t/x\ny\u2028z", "x#a\u0085", None, "a//b", "s://?q", "é:x"]
    out = spark.createDataFrame([(u,) for u in urls], "u string").select(U.split_url(F.col("u")).alias("p"))
    want = [("http", "h:1", "/p/a", "q=1?2", "f#g"), ("", "h", "", "", ""), ("a", "", "b:c", "", ""), ("", "", "1a:b", "", ""), ("",) * 5, ("",) * 5, ("",) * 5,
            ("", "", "/xy\u2028z", "", ""), ("", "", "x", "", "a\u0085"), (None,) * 5, ("", "", "a//b", "", ""), ("s", "", "", "q", ""), ("", "", "é:x", "", "")]
    assert [tuple(r.p) for r in out.collect()] == want
    assert "regexp_extract" not in out._jdf.queryExecution().optimizedPlan().toString()
