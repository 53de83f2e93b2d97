"""Inputs derived from the driver tables (FIXTURES.md section 3), built with Spark.

Every derived input is a deterministic function of table columns, so the matching oracle
SQL can compute the expected answer from the same columns without parsing HTML or JSON.
All of them grow with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.siteinfo import Dims, Site, dims_from_tables

SERVER = "http://en.example.org"
SITE = Site("Example wiki", "en", False, "", "", "/wiki/", SERVER)
LOCAL_NAMESPACES = ["NATION_3", "Ns5", "7", "NATION_5"]
LANGLINKS = ["de", "es"]
LINE_START, LINE_END = "2:100", "5:9000"
KEY_START, KEY_END = "Customer 000000100", "Customer 000000499"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def v_ns(spark, d) -> DataFrame:
    """nation -> namespaces (pos, id, canonical, name); id 0 present (excluded from lookups)."""
    return table(spark, d, "nation").select(
        F.col("n_nationkey").cast("int").alias("pos"), F.col("n_nationkey").cast("long").alias("id"),
        F.concat(F.lit("Ns"), F.col("n_nationkey")).alias("canonical"), F.col("n_name").alias("name"))


def v_iw(spark, d) -> DataFrame:
    """region -> interwiki (pos, prefix, url); 'asia' repeated later (last wins), an empty url
    for 'europe' (filtered), 'middle east' never matches a URL scheme."""
    r = table(spark, d, "region")
    base = r.select(F.col("r_regionkey").cast("int").alias("pos"), F.lower("r_name").alias("prefix"),
                    F.concat(F.lit("//"), F.lower("r_name"), F.lit(".example.org/wiki/$1")).alias("url"))
    again = r.where(F.col("r_regionkey") == 2).select((F.col("r_regionkey") + 100).cast("int").alias("pos"),
                                                      F.lower("r_name").alias("prefix"), F.lit("//asia.example.com/w/$1").alias("url"))
    empty = r.where(F.col("r_regionkey") == 3).select((F.col("r_regionkey") + 200).cast("int").alias("pos"),
                                                      F.lower("r_name").alias("prefix"), F.lit("").alias("url"))
    return base.unionByName(again).unionByName(empty)


_dims_cache: dict = {}


def query_dims(spark, d, local=None) -> Dims:
    key = (spark.sparkContext.applicationId, id(spark), d, tuple(local or ()))
    if key not in _dims_cache:
        _dims_cache[key] = dims_from_tables(SITE, v_ns(spark, d), v_iw(spark, d), local)
    return _dims_cache[key]


def _cust(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


def v_wikiurls(spark, d) -> DataFrame:
    """customer x nation x region -> (c_custkey, url, title) in five URL shapes."""
    c = _cust(spark, d)
    nm = F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))
    rg = F.lower("r_name")
    k = F.col("c_custkey") % 5
    thumb = F.concat(F.lit("//upload.wikimedia.org/thumb/x/"), nm, F.lit("/"), (F.col("c_nationkey") * 100).cast("string"),
                     F.lit("px-"), nm, F.lit(".jpg"))
    url = (
        F.when(k == 0, F.concat(F.lit("/wiki/"), F.col("n_name"), F.lit(":"), nm))
        .when(k == 1, F.concat(rg, F.lit(":"), nm))
        .when(k == 2, F.when(F.col("c_custkey") % 10 == 2, thumb).otherwise(F.concat(F.lit("//"), rg, F.lit(".example.net/"), nm)))
        .when(k == 3, F.concat(F.lit("/wiki/"), nm, F.lit("#"), F.col("c_mktsegment")))
        .otherwise(F.concat(F.lit("/wiki/"), nm, F.lit("/"), F.col("c_nationkey").cast("string"), F.lit("?x=1")))
    )
    title = F.when(F.col("c_custkey") % 10 == 3, F.replace(nm, F.lit("_"), F.lit(" "))).otherwise(F.lit("Main Page"))
    return c.select("c_custkey", url.alias("url"), title.alias("title"), nm.alias("nm"), "c_nationkey")


def v_ndjson(spark, d) -> DataFrame:
    """pages -> dump lines (line_id, value): every 17th truncated, every 19th with
    ``redirects: null``, every 23rd without ``redirects``."""
    p = table(spark, d, "pages")
    pid = F.col("page_id")
    body = F.struct(F.col("html").alias("html"))
    redirects = F.array(F.struct(F.concat(F.lit("R"), pid.cast("string")).alias("name")),
                        F.struct(F.concat(F.lit("S"), pid.cast("string")).alias("name")))
    full = F.to_json(F.struct(F.col("url").alias("name"), body.alias("article_body"), redirects.alias("redirects")))
    bare = F.to_json(F.struct(F.col("url").alias("name"), body.alias("article_body")))
    with_null = F.concat(F.expr("substring(__bare, 1, length(__bare) - 1)"), F.lit(',"redirects":null}'))
    line = (
        F.when(pid % 17 == 0, F.substring(full, 1, 50))
        .when(pid % 19 == 0, with_null)
        .when(pid % 23 == 0, F.col("__bare"))
        .otherwise(full)
    )
    return p.withColumn("__bare", bare).select(pid.alias("line_id"), line.alias("value"))


def v_lines(spark, d) -> DataFrame:
    """lineitem -> positioned dump lines (file_number, line_number, value)."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_linenumber").cast("int").alias("file_number"), F.col("l_orderkey").cast("long").alias("line_number"),
                     F.col("l_partkey"), F.to_json(F.struct("l_orderkey", "l_partkey")).alias("value"))


def v_docs(spark, d) -> DataFrame:
    """customer -> exported documents (one JSON row per document: ``{"id", "doc"}``).

    c_custkey % 13 == 0 has no document, % 11 == 0 no body (doc null), % 7 == 0 a malformed
    body (no ``parse.text``).  Aliases: a plain one (twice), a [key, fragment] pair; language
    links de (nation name), fr (empty title), es (market segment)."""
    c = _cust(spark, d).where(F.col("c_custkey") % 13 != 0)
    k = F.col("c_custkey")
    did = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    alias_plain = F.to_json(F.array(F.concat(F.lit("Alias "), k.cast("string"))))
    alias_pair = F.to_json(F.array(F.concat(F.lit("Seg "), F.col("c_mktsegment")), F.concat(F.lit("f"), F.col("c_nationkey").cast("string"))))
    aliases = F.concat(F.lit("["), F.expr("substring(__ap, 2, length(__ap) - 2)"), F.lit(","), F.col("__pair"), F.lit(","),
                       F.expr("substring(__ap, 2, length(__ap) - 2)"), F.lit("]"))
    langlinks = F.to_json(F.array(
        F.struct(F.lit("de").alias("lang"), F.concat(F.col("n_name"), F.lit(" de")).alias("*")),
        F.struct(F.lit("fr").alias("lang"), F.lit("").alias("*")),
        F.struct(F.lit("es").alias("lang"), F.col("c_mktsegment").alias("*"))))
    html = F.to_json(F.struct(F.concat(F.lit("<p>Customer "), k.cast("string"), F.lit("</p>")).alias("*")))
    parse = F.when(k % 7 == 0, F.concat(F.lit('{"langlinks":'), F.col("__ll"), F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"text":'), F.col("__html"), F.lit(',"langlinks":'), F.col("__ll"), F.lit("}")))
    doc = F.concat(F.lit('{"_id":'), F.to_json(F.array(did)).substr(F.lit(2), F.length(F.to_json(F.array(did))) - 2),
                   F.lit(',"aliases":'), F.col("__aliases"), F.lit(',"parse":'), F.col("__parse"), F.lit("}"))
    row = F.concat(F.lit('{"id":'), F.to_json(F.array(did)).substr(F.lit(2), F.length(F.to_json(F.array(did))) - 2),
                   F.lit(',"doc":'), F.when(k % 11 == 0, F.lit("null")).otherwise(F.col("__doc")), F.lit("}"))
    return (c.withColumn("__ap", alias_plain).withColumn("__pair", alias_pair)
            .withColumn("__aliases", aliases).withColumn("__ll", langlinks).withColumn("__html", html)
            .withColumn("__parse", parse).withColumn("__doc", doc)
            .select(k.alias("c_custkey"), row.alias("value")))


def v_keys(spark, d) -> DataFrame:
    """orders -> key-file lines ``Customer_<o_custkey*2, 9 digits>`` (about half missing)."""
    o = table(spark, d, "orders")
    return o.select(F.concat(F.lit("Customer_"), F.lpad((F.col("o_custkey") * 2).cast("string"), 9, "0")).alias("value")).distinct()


def v_geo_html(spark, d) -> DataFrame:
    """customer -> one article per customer with a map anchor (c_custkey % 7 == 0 lacks
    data-style, so it is removed)."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    lat = (k % 170 - 85).cast("string")
    lon = (k * 7 % 360 - 180).cast("string")
    zoom = (k % 19).cast("string")
    style = F.when(k % 7 == 0, F.lit("")).otherwise(F.lit(' data-style="osm"'))
    html = F.concat(F.lit('<p><a class="mw-kartographer-map" data-lat="'), lat, F.lit('" data-lon="'), lon,
                    F.lit('" data-zoom="'), zoom, F.lit('" data-overlays="[]"'), style,
                    F.lit(' data-height="300" data-width="400"><img src="//maps.example.org/'), k.cast("string"),
                    F.lit('.png" srcset="//maps.example.org/x.png 2x"></a></p>'))
    return c.select(k.alias("article_id"), F.col("c_name").alias("title"), html.alias("text"))


def v_coord_html(spark, d) -> DataFrame:
    """customer -> the three coordinate microformats by c_custkey % 3 (% 10 == 9 malformed)."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    lat = (k % 170 - 85).cast("string")
    lon = (k * 7 % 360 - 180).cast("string")
    sep = F.when(k % 10 == 9, F.lit(" ")).otherwise(F.lit("; "))
    html = (
        F.when(k % 3 == 0, F.concat(F.lit('<p>x<span class="geo-nondefault"><span class="geo">'), lat, sep, lon, F.lit("</span></span></p>")))
        .when(k % 3 == 1, F.concat(F.lit('<p><span class="geo"><span class="latitude">'), lat,
                                   F.lit('</span>, <span class="longitude">'), lon, F.lit("</span></span></p>")))
        .otherwise(F.concat(F.lit('<p><span class="geo-geo-dms">dms<span class="geo-dec">dec</span><span class="geo">'),
                            lat, F.lit(";"), lon, F.lit("</span></span></p>")))
    )
    return c.select(k.alias("article_id"), F.col("c_name").alias("title"), html.alias("text"))


RULES = ['.navbox', '.mw-collapsible.mw-collapsed', 'img:not(.tex)', 'a[href^="#cite"]', 'p:empty',
         '.outer .inner', 'ul.menu > li', 'div:empty']


def rules_html(k, size, name, brand) -> list:
    """Pieces of the selector-test document (shared by Spark and the oracle's SQL)."""
    return [
        '<div class="box"><div class="navbox"><p>nav ', k, '</p></div>tail', k,
        '<div class="mw-collapsible', ("size_even", " mw-collapsed"), '">coll', k, '</div>',
        '<img class="tex" alt="t"><img class="pic" src="/i/', k, '.png">',
        '<a href="#cite_note-', k, '">cite</a><a href="#other">keep', k, '</a>',
        '<p></p><p>text ', name, '</p>',
        '<span class="outer"><b><span class="inner">deep', k, '</span></b></span>',
        '<ul class="menu"><li>item ', brand, '</li></ul><ol><li>ok', k, '</li></ol>',
        '<div>', ("size_not3", "full"), '</div></div>',
    ]


def v_rules_html(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    k, size = F.col("p_partkey").cast("string"), F.col("p_size")
    parts = []
    for x in rules_html(k, size, F.col("p_name"), F.col("p_brand")):
        if isinstance(x, str):
            parts.append(F.lit(x))
        elif isinstance(x, tuple):
            cond = (size % 2 == 0) if x[0] == "size_even" else (size % 3 != 0)
            parts.append(F.when(cond, F.lit(x[1])).otherwise(F.lit("")))
        else:
            parts.append(x)
    return p.select(F.col("p_partkey").alias("article_id"), F.col("p_name").alias("title"), F.concat(*parts).alias("text"))


def v_new_html(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    html = F.concat(F.lit('<p><a class="new" href="./X'), k, F.lit('">red '), k,
                    F.lit('</a> and <span class="IPA"><a href="/wiki/IPA">ipa</a></span> <a href="./Y">keep</a></p>'))
    return c.select(F.col("c_custkey").alias("article_id"), F.col("c_name").alias("title"), html.alias("text"))


BG_SELECTORS = "div.bg,span"


def v_attr_html(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit('<div style="color: red; background: blue; Background-Color:#fff; margin: '), F.col("p_size").cast("string"),
        F.lit('px" class="bg">x</div><span style="background:blue">y</span><p style="background: red">z</p>'),
        F.lit('<section data-mw-section-id="'), k, F.lit('" data-mw="{}" id="mw'), k,
        F.lit('" title="t" about="#x" typeof="mw:T" class="s"><a rel="nofollow" id="cite'), k,
        F.lit('" href="http://e.org/'), k, F.lit('" title="link">x</a><div rel="keep" data-mw-section-id="'), k,
        F.lit('" onclick="go()">y</div></section>'))
    return p.select(F.col("p_partkey").alias("article_id"), F.col("p_name").alias("title"), html.alias("text"))


def v_links_html(spark, d) -> DataFrame:
    u = v_wikiurls(spark, d)
    html = F.concat(F.lit('<p><a href="'), F.col("url"), F.lit('">x</a><img src="/wiki/File:'), F.col("nm"),
                    F.lit('.png" srcset="//upload.wikimedia.org/a/'), F.col("c_custkey").cast("string"),
                    F.lit('/440px-a.jpg 2x, /wiki/B_c 3x"></p>'))
    return u.select(F.col("c_custkey").alias("article_id"), "title", html.alias("text"))


def _lineitem_ranked(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return li.withColumn("rn", F.row_number().over(w))


def v_auto_html(spark, d) -> DataFrame:
    """orders -> lineitem: one article per order with an ``a.autonumber`` per line item;
    line numbers divisible by 3 carry their own text."""
    li = _lineitem_ranked(spark, d)
    piece = F.concat(F.lit('<a class="autonumber external" href="http://e.org/'), F.col("rn").cast("string"), F.lit('">'),
                     F.when(F.col("l_linenumber") % 3 == 0, F.lit("ref")).otherwise(F.lit("")), F.lit("</a>"))
    art = li.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rn", piece.alias("s"))))["s"], "").alias("body"))
    return art.select(F.col("l_orderkey").alias("article_id"), F.col("l_orderkey").cast("string").alias("title"),
                      F.concat(F.lit("<p>"), F.col("body"), F.lit("</p>")).alias("text"))


def v_toc_html(spark, d) -> DataFrame:
    """orders -> lineitem: sectioned h2 / h3 / h4 headings (h4 on even ranks), plus an h2
    without id that is never listed."""
    li = _lineitem_ranked(spark, d)
    o = F.col("l_orderkey").cast("string")
    rn = F.col("rn").cast("string")
    h4 = F.when(F.col("rn") % 2 == 0, F.concat(F.lit('<h4 id="q'), o, F.lit("_"), rn, F.lit('">Qty '),
                                                F.col("l_quantity").cast("long").cast("string"), F.lit("</h4>"))).otherwise(F.lit(""))
    piece = F.concat(F.lit('<section><h3 id="l'), o, F.lit("_"), rn, F.lit('">Line <span></span>'), rn, F.lit("</h3>"), h4, F.lit("</section>"))
    art = li.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rn", piece.alias("s"))))["s"], "").alias("body"))
    html = F.concat(F.lit('<body><section><h2 id="o'), o, F.lit('">Order '), o, F.lit("</h2>"), F.col("body"),
                    F.lit("</section><section><h2>No id</h2></section></body>"))
    return art.select(F.col("l_orderkey").alias("article_id"), o.alias("title"), html.alias("text"))


def v_math_html(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    ks, size = k.cast("string"), F.col("p_size").cast("string")
    html = (
        F.when(k % 5 == 0, F.concat(F.lit('<p>Formula <span class="mwe-math-element" data-mw=\'{"body":{"extsrc":"x^'), size,
                                    F.lit('"}}\'><img class="mwe-math-fallback-image-inline" src="//m/'), ks,
                                    F.lit('.png" alt="x"></span> inline</p>')))
        .when(k % 5 == 1, F.concat(F.lit('<dl><dd><span class="mwe-math-element" data-mw=\'{"body":{"extsrc":"\\\\sqrt{'), size,
                                   F.lit('}"}}\'><img class="mwe-math-fallback-image-display" src="//m/d.png" alt="r"></span></dd></dl>')))
        .when(k % 5 == 2, F.concat(F.lit('<p><img class="tex" alt="a_'), ks, F.lit('" src="//m/t.png"></p>')))
        .when(k % 5 == 3, F.lit('<p>bad <span class="mwe-math-element" data-mw="{not json"><img class="mwe-math-fallback-image-inline" src="//m/b.png"></span></p>'))
        .otherwise(F.concat(F.lit("<p>no math "), F.col("p_name"), F.lit("</p>")))
    )
    return p.select(k.alias("article_id"), F.col("p_name").alias("title"), html.alias("text"))


def v_tex(spark, d) -> DataFrame:
    """part -> TeX sources exercising the prefilter and the macro dictionary."""
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    macro = F.element_at(F.array(*[F.lit(m) for m in ("alpha", "Complex", "infin", "rarr", "R", "bold", "sgn")]),
                         (k % 7 + 1).cast("int"))
    tex = F.when(k % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("% of \\iint"), F.replace(F.col("p_name"), F.lit(" "), F.lit("")),
                                      F.lit("!\\!\\!\\!\\!\\!\\!\\!\\!\\!\\!"), F.col("p_type"), F.lit("\\subset\\!\\supset x")))
    tex = tex.otherwise(F.concat(F.lit("50% \\R^"), F.col("p_size").cast("string"), F.lit(" \\%"), F.col("p_type"),
                                 F.lit(" + \\"), macro, F.lit("{x} \\Z")))
    return p.select(k.alias("p_partkey"), tex.alias("tex"))


def v_articles(spark, d, null_every: int = 0) -> DataFrame:
    """pages -> articles (article_id, title=url, text=html); ``null_every`` > 0 gives every
    n-th article a NULL text."""
    p = table(spark, d, "pages")
    text = F.col("html") if not null_every else F.when(F.col("page_id") % null_every == 0, F.lit(None)).otherwise(F.col("html"))
    return p.select(F.col("page_id").alias("article_id"), F.col("url").alias("title"), text.alias("text"))


def v_site_json(spark, d) -> DataFrame:
    """region -> one site-info JSON document per region (rtl key present on odd keys,
    articlepath absent for key 3)."""
    r = table(spark, d, "region")
    k = F.col("r_regionkey")
    general = F.map_filter(F.create_map(
        F.lit("sitename"), F.col("r_name"), F.lit("lang"), F.concat(F.lit("l"), k.cast("string")),
        F.lit("articlepath"), F.when(k != 3, F.lit("/wiki/$1")),
        F.lit("server"), F.concat(F.lit("//"), F.lower("r_name"), F.lit(".example.org")),
        F.lit("rtl"), F.when(k == 1, F.lit("")).when(k == 3, F.lit("yes"))), lambda a, b: b.isNotNull())
    doc = F.to_json(F.struct(general.alias("general"), F.struct(F.concat(F.lit("License "), F.col("r_name")).alias("text"),
                                                                   F.lit("//creativecommons.org/l").alias("url")).alias("rightsinfo")))
    return r.select(k.alias("r_regionkey"), doc.alias("json"))
