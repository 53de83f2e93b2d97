"""Queries of the document operators on trees that need more than a row: chains of child steps, unwrapped parents, styles, headers,
formulas, and of the extraction tables. Inputs are HTML written from the driver tables' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tex as TX
from ..operators import clean as C
from ..operators import extract as X
from ..operators import links as L
from ..operators import nodes as N
from ..sources import dump as D
from ..sources import rules as R
from ..sources import scrape as SC
from . import fixtures as FX
from .convert import CSS_LINKS, ConvertOptions, convert_articles
from .registry import query


def _articles(df, key: str, *pieces):
    """Articles of a table's rows: HTML from literals and columns, with the key as id."""
    html = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in pieces])
    return df.select(F.col(key).alias("article_id"), html.alias("text"))


def _nodes(articles, grouped=False):
    return N.tokenize(articles.select(F.col("article_id").cast("long").alias("article_id"), "text"), "text", grouped=grouped)


def _text(nodes, *tags):
    """The text of each article and how many elements of each tag are left."""
    of = [F.sum(F.when((F.col("kind") == "open") & (F.col("tag") == t), 1).otherwise(0)).cast("long").alias(f"n_{t}") for t in tags]
    text = F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == "text", F.struct("pos", "text"))))["text"], "")
    return nodes.groupBy("article_id").agg(text.alias("text"), *of)


@query("rule_chains", """
SELECT p_partkey AS article_id, 'side' || CAST(p_partkey AS VARCHAR) || 'deep' || CAST(p_partkey AS VARCHAR)
    || CASE WHEN p_size % 2 = 0 THEN '' ELSE 'q' END || 't' || CAST(p_partkey AS VARCHAR) AS text,
  CAST(3 AS BIGINT) AS n_div, CAST(2 AS BIGINT) AS n_i, CAST(2 AS BIGINT) AS n_b, CAST(0 AS BIGINT) AS n_p, CAST(CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_a
FROM part
""")
def rule_chains(spark, d):
    """DOC-3 + UDF-1: chains of child steps of any depth, with ids and attributes, descendant steps between them, and
    a comma list whose alternatives see one tree (the div that p:empty empties stays)."""
    p, k = FX.table(spark, d, "part"), F.col("p_partkey").cast("string")
    arts = _articles(
        p, "p_partkey", '<div class="a"><b><i>chain', k, "</i></b><i>side", k, '</i></div><div class="a"><u><b><i>deep', k, "</i></b></u></div>",
        '<section id="s', (F.col("p_size") % 2).cast("string"), '"><ul><li><em><a href="#x">q</a></em></li></ul></section><div><p></p></div>t', k,
    )
    kept = C.apply_rules(_nodes(arts, grouped=True), ["div.a > b > i", "section#s0 > ul li > em > a[href]", "p:empty, div:empty"])
    return _text(kept, "div", "i", "b", "p", "a")


STYLES = [  # as written, as expected; %s is the part's size
    ("background: url(a;b.png) no-repeat; color: red; margin: %spx", "color: red;\nmargin: %spx"),
    ('content: "x;background:y"; BACKGROUND : blue; margin: %spx', 'content: "x;background:y";\nmargin: %spx'),
    ("color: red; /* background: blue; */ margin: %spx", "color: red;\nmargin: %spx"),
    ("width:calc(%spx;background:red", "width:calc(%spx;background:red"),
    ('content:"x;background:%spx', 'content:"x;background:%spx'),
    ('content: "a\\";b"; background-color:#fff; Margin : %spx;;', 'content: "a\\";b";\nmargin: %spx'),
    ('background:url("a)b(;") ; top: calc((1px + %spx) * 3); x', "top: calc((1px + %spx) * 3);\nx"),
    ("background:red) ; margin: %spx", "background:red) ; margin: %spx"),
    ("background:red; margin: %spx; /* open", "background:red; margin: %spx; /* open"),
    ("background: red; -x: [a;b]; margin: %spx", "-x: [a;b];\nmargin: %spx"),
]


def _style_sql(x: str) -> str:
    return " || ".join("CAST(p_size AS VARCHAR)" if i % 2 else "'" + s.replace("'", "''") + "'" for i, s in enumerate(x.replace("%s", "\0%\0").split("\0")))


@query("bg_styles", "SELECT p_partkey AS article_id, CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN {_style_sql(want)}" for i, (_, want) in enumerate(STYLES)) + " END AS style FROM part")
def bg_styles(spark, d):
    """DOC-6: declarations with strings, escapes, comments and brackets; malformed styles stay as they are."""
    p = FX.table(spark, d, "part")
    size = F.col("p_size").cast("string")
    style = F.element_at(F.array(*[F.concat(*[size if i % 2 else F.lit(s) for i, s in enumerate(x.replace("%s", "\0%\0").split("\0"))]) for x, _ in STYLES]), (F.col("p_partkey") % 10 + 1).cast("int"))
    n = C.strip_background(_nodes(_articles(p, "p_partkey", '<p style="', F.replace(style, F.lit('"'), F.lit("&quot;")), '">x</p>')), "p")
    return n.where((F.col("kind") == "open") & (F.col("tag") == "p")).select("article_id", F.col("attrs")["style"].alias("style"))


@query("formulas_unwrapped", """
SELECT p_partkey AS article_id, 'x^' || CAST(p_partkey AS VARCHAR) AS tex, (p_partkey % 4 IN (1, 3)) OR (p_partkey % 4 = 2 AND p_size % 2 = 0) AS display FROM part
""")
def formulas_unwrapped(spark, d):
    """EXT-5 + DOC-5 + JOIN-10: what shares a formula's parent once red links and IPA links are unwrapped, three levels deep."""
    k = F.col("p_partkey").cast("string")
    m = F.concat(F.lit('<span class="mwe-math-element" data-mw=\'{"body":{"extsrc":"x^'), k, F.lit('"}}\'>f</span>'))
    red = lambda x: F.concat(F.lit('<a class="new" href="./X">'), x if not isinstance(x, str) else F.lit(x), F.lit("</a>"))
    # text in a red link beside; blanks in one beside; within one, with text beside or not; within three, one of them closed before
    other = F.when(F.col("p_size") % 2 == 0, "").otherwise("t")
    html = F.element_at(F.array(F.concat(red("t"), m), F.concat(red(" "), m), F.concat(red(m), other), red(F.concat(red(""), red(m)))), (F.col("p_partkey") % 4 + 1).cast("int"))
    n = C.math_tex(C.unwrap_rules(_nodes(_articles(FX.table(spark, d, "part"), "p_partkey", "<div>a<p>", html, "</p></div>"), grouped=True)))
    return X.formulas(n).select("article_id", "tex", "display")


@query("rebuilt_parents", """
SELECT p_partkey AS article_id, 'div' AS tag, NULL AS ptag, 0 AS depth FROM part
UNION ALL SELECT p_partkey, 'p', 'div', 1 FROM part
UNION ALL SELECT p_partkey, 'b', CASE WHEN p_size % 2 = 0 THEN 'p' ELSE 'u' END, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 3 END FROM part
UNION ALL SELECT p_partkey, 'i', 'p', 2 FROM part
UNION ALL SELECT p_partkey, 'u', 'p', 2 FROM part WHERE p_size % 2 <> 0
UNION ALL SELECT p_partkey, 'img', 'div', 1 FROM part
""")
def rebuilt_parents(spark, d):
    """Parents and depths of the tree without unwrapped elements: the nearest element still around each one."""
    u = F.when(F.col("p_size") % 2 == 0, "s").otherwise("u")
    n = _nodes(_articles(FX.table(spark, d, "part"), "p_partkey", "<div><p><s><s></s><s><", u, "><b>x</b></", u, "></s></s><i>y</i></p><s><img></s></div>"), grouped=True)
    n = N.rebuild_parents(n.where(F.coalesce(F.col("tag") != "s", F.lit(True))))
    return n.where(F.col("kind") == "open").select("article_id", "tag", "ptag", "depth")


TEX_PARTS = [(r"\R^", r"\mathbb{R}^"), (r"\bold{x_{1}\Z}", r"\mathbf{x_{1}\mathbb{Z}}"), (r"\pagecolor{red}\bold  ab", r"\mathbf{a}b"), (r"\bold{\bold{\infin}}", r"\mathbf{\mathbf{\infty}}"),
             (r"\P\sect{\bold}", r"\P\S{\bold}"), (r"\\R \Rx \bold{", r"\\R \Rx \bold{"), (r"\sgn x\isin\reals", r"\operatorname{sgn} x\in\mathbb{R}")]


@query("tex_expanded", "SELECT p_partkey, CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN '{want}'" for i, (_, want) in enumerate(TEX_PARTS)) + " END || CAST(p_size AS VARCHAR) AS tex FROM part")
def tex_expanded(spark, d):
    """TEX-2: macros written out, with their arguments, to the end; macros that reach themselves stay."""
    tex = F.element_at(F.array(*[F.lit(x) for x, _ in TEX_PARTS]), (F.col("p_partkey") % 7 + 1).cast("int"))
    return FX.table(spark, d, "part").select("p_partkey", TX.expand(F.concat(tex, F.col("p_size").cast("string"))).alias("tex"))


@query("dangling_links", """
WITH l AS (
  SELECT c_custkey AS article_id, 'Page ' || CAST(c_custkey * 2 AS VARCHAR) AS target, CAST(NULL AS VARCHAR) AS fragment, 1 AS n FROM customer
  UNION ALL SELECT c_custkey, 'A:b/c ' || CAST(c_nationkey AS VARCHAR), 'f', 2 FROM customer
  UNION ALL SELECT c_custkey, 'Hub', 's' || CAST(c_nationkey AS VARCHAR), 1 FROM customer),
keys AS (SELECT 'Page ' || CAST(c_custkey AS VARCHAR) AS key FROM customer UNION ALL SELECT 'A:b/c ' || CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey % 2 = 0)
SELECT article_id, target, fragment, CAST(n AS BIGINT) AS n_links FROM l WHERE target NOT IN (SELECT key FROM keys)
""")
def dangling_links(spark, d):
    """EXT-1 + JOIN-8: local links that no title answers, by page; a hub that a third of all links lead to is one of them."""
    c, s, n = FX.table(spark, d, "customer"), F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    arts = _articles(
        c, "c_custkey", '<a href="/wiki/Page_', (F.col("c_custkey") * 2).cast("string"), '">1</a><a href="/wiki/A:b/c_', n, '#f">2</a><a href="/wiki/A:b/c_', n,
        '#f">3</a><a href="/wiki/Hub#s', n, '">4</a><a href="#here">5</a><a href="http://e.org/', s, '">6</a><a href="mailto:x">7</a>',
    )
    links = L.links_table(_nodes(arts), FX.query_dims(spark, d))
    titles = c.select(F.concat(F.lit("Page "), s).alias("key")).unionByName(
        FX.table(spark, d, "nation").where(F.col("n_nationkey") % 2 == 0).select(F.concat(F.lit("A:b/c "), F.col("n_nationkey").cast("string")).alias("key")))
    return L.dangling_links(links, titles)


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


HEADER = ('<div><body><details id="a2-article-header"><summary><span id="a2-toc-spacer"></span><span id="a2-title"><a id="view-online-link" href="', "</a></span></summary>")
CONTENTS = ('<div id="a2-toc"><ol class="toc"><li><a href="#a', '">Top ', "</a></li></ol></div></details>")


@query("article_header", f"""
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS s FROM customer)
SELECT k AS article_id, md5({_quoted(CSS_LINKS + HEADER[0])} || CASE WHEN k % 2 = 0 THEN 'http://o.org/' || s ELSE '{FX.SERVER}/wiki/C%20%C3%A9%20' || s END || '">C é ' || s || {_quoted(HEADER[1])}
  || CASE k % 3 WHEN 0 THEN {_quoted(CONTENTS[0])} || s || {_quoted(CONTENTS[1])} || s || {_quoted(CONTENTS[2])} || '<h2 id="a' || s || '">Top ' || s || '</h2>'
     WHEN 1 THEN '<div id="toc"><b>own ' || s || '</b></div></details>' ELSE '</details>' END || '<p>x</p></body></div>') AS content_md5
FROM c
""")
def article_header(spark, d):
    """DOC-14 + DOC-15: the header by content: link to the online page or to the server, generated or existing contents or none;
    link elements go."""
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    head = F.when(k % 2 == 0, F.concat(F.lit('<head><link rel="dc:isVersionOf" href="http://o.org/'), s, F.lit('"></head>'))).otherwise(F.lit(""))
    toc = F.when(k % 3 == 0, F.concat(F.lit('<h2 id="a'), s, F.lit('">Top '), s, F.lit("<span></span></h2>"))).when(k % 3 == 1, F.concat(F.lit('<div id="toc"><b>own '), s, F.lit("</b></div>"))).otherwise(F.lit(""))
    arts = _articles(FX.table(spark, d, "customer"), "c_custkey", "<html>", head, "<body>", toc, '<p>x</p><link rel="stylesheet" href="y.css"></body></html>')
    arts = arts.select("article_id", F.concat(F.lit("C é "), F.col("article_id").cast("string")).alias("title"), "text")
    return convert_articles(arts, FX.query_dims(spark, d), ConvertOptions()).select("article_id", F.md5("content").alias("content_md5"))


@query("images", """
SELECT c_custkey AS article_id, '//upload.wikimedia.org/thumb/x/' || CAST(c_nationkey * 100 + 1 AS VARCHAR) || 'px-a.jpg' AS url, 'a.jpg,/b.png' AS candidates,
  CAST(c_nationkey * 100 + 1 AS INTEGER) AS requested_width,
  CAST(CASE WHEN w <= 20 THEN 20 WHEN w <= 40 THEN 40 WHEN w <= 60 THEN 60 WHEN w <= 120 THEN 120 WHEN w <= 250 THEN 250 WHEN w <= 330 THEN 330 WHEN w <= 500 THEN 500 WHEN w <= 960 THEN 960
       WHEN w <= 1280 THEN 1280 WHEN w <= 1920 THEN 1920 ELSE 3840 END AS INTEGER) AS standard_width
FROM (SELECT *, c_nationkey * 100 + 1 AS w FROM customer)
UNION ALL SELECT c_custkey, '/plain' || CAST(c_custkey AS VARCHAR) || '.png', NULL, NULL, NULL FROM customer
""")
def images(spark, d):
    """EXT-6 + SCL-5 + JOIN-7: images with their candidates and widths."""
    c = FX.table(spark, d, "customer")
    arts = _articles(c, "c_custkey", '<p><img src="//upload.wikimedia.org/thumb/x/', (F.col("c_nationkey") * 100 + 1).cast("string"), 'px-a.jpg" srcset="a.jpg 2x, /b.png 3x"><img src="/plain', F.col("c_custkey").cast("string"), '.png"><img alt="none"></p>')
    out = X.images(_nodes(arts))
    return out.select("article_id", "url", F.array_join("srcset_candidates", ",").alias("candidates"), F.col("requested_width").cast("int").alias("requested_width"), F.col("standard_width").cast("int").alias("standard_width"))


@query("alias_table", """
WITH g AS (SELECT page_id, url FROM pages WHERE page_id % 17 <> 0 AND page_id % 19 <> 0 AND page_id % 23 <> 0)
SELECT url AS title, 'R' || CAST(page_id AS VARCHAR) AS alias, CAST(NULL AS VARCHAR) AS fragment, 'redirect' AS origin FROM g
UNION ALL SELECT url, 'S' || CAST(page_id AS VARCHAR), NULL, 'redirect' FROM g
""")
def alias_table(spark, d):
    """EXT-7: a row for each alias of an article."""
    articles = D.dump_articles(D.good_lines(D.decode_dump_lines(FX.v_ndjson(spark, d)))).withColumn("origin", F.lit("redirect"))
    return X.aliases(articles, "origin").select("title", "alias", "fragment", "origin")


@query("key_in", """
SELECT replace(c_name, '#', ' ') AS title, c_custkey FROM customer
WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0 AND c_name IN ('Customer#000000002', 'Customer#000000013', 'Customer#000000011', 'Customer#000000120', 'Customer#999999999')
""")
def key_in(spark, d):
    """FLT-3: documents of a list of keys, of which some have no document or no body."""
    docs = SC.decode_scrape_rows(FX.v_docs(spark, d))
    return SC.key_in(docs, [f"Customer {i:09d}" for i in (2, 13, 11, 120, 999_999_999)]).select("title", "c_custkey")


@query("article_outcomes", f"""
SELECT c_custkey AS article_id, c_name AS title, CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'E' ELSE 'S' END AS status,
  CAST(CASE WHEN c_custkey % 3 = 2 THEN {len(CSS_LINKS)} + length('<div><p>x' || CAST(c_custkey AS VARCHAR) || '</p></div>') ELSE 0 END AS BIGINT) AS n_bytes,
  CASE WHEN c_custkey % 3 = 0 THEN 'a character beyond us-ascii' END AS error
FROM customer
""")
def article_outcomes(spark, d):
    """SNK-4 + PRJ-4 + FLT-7: each article's outcome: converted, without text, or with a character its charset lacks."""
    from .dictionary import outcomes

    k = F.col("c_custkey")
    text = F.when(k % 3 != 1, F.concat(F.lit("<p>x"), k.cast("string"), F.when(k % 3 == 0, "é").otherwise(""), F.lit("</p>")))
    arts = FX.table(spark, d, "customer").select(k.alias("article_id"), F.col("c_name").alias("title"), text.alias("text"))
    return outcomes(convert_articles(arts, FX.query_dims(spark, d), ConvertOptions(html_encoding="us-ascii"), header=False))


@query("rule_files", """
SELECT c_custkey AS article_id, CASE WHEN n_regionkey = 1 OR n_nationkey = 24 THEN '' ELSE 'x' END || 'y' || CAST(c_custkey AS VARCHAR) AS text
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def rule_files(spark, d):
    """SRC-7: rules read from a file with blank lines (one rule for each nation of a region), then an ad-hoc rule, applied in order."""
    from ..session import ensure_checkpoint_dir
    import uuid

    top = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rules-{uuid.uuid4().hex}"
    lines = FX.table(spark, d, "nation").where(F.col("n_regionkey") == 1).select(F.explode(F.array(F.concat(F.lit(" .n"), F.col("n_nationkey").cast("string")), F.lit(""))).alias("value"))
    lines.coalesce(1).write.text(f"{top}/region")
    rules = R.collect_rules(R.read_rules(spark, ["region"], top, adhoc=["p.n24"]))
    arts = _articles(FX.table(spark, d, "customer"), "c_custkey", '<div><p class="n', F.col("c_nationkey").cast("string"), '">x</p>y', F.col("c_custkey").cast("string"), "</div>")
    return _text(C.apply_rules(_nodes(arts, grouped=True), rules))
