"""Registered queries: Spark jobs over the driver tables and the equivalent DuckDB SQL.

Each query reads the driver tables (or inputs derived from them by ``fixtures``) and runs
the library's operators.  The SQL computes the expected answer from the same columns.
Column names and types agree between both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import tex as TX
from ..functions import urls as U
from ..operators import clean as C
from ..operators import extract as X
from ..operators import links as L
from ..operators import nodes as N
from ..sources import dump as D
from ..sources import scrape as SC
from ..sources import siteinfo as SI
from . import dictionary as DI
from . import fixtures as FX
from .convert import CSS_LINKS, ConvertOptions, convert_articles
from .registry import ORACLE, QUERIES, query  # noqa: F401

# ---------------------------------------------------------------- SQL building blocks


def ladder_sql(x: str) -> str:
    arms = " ".join(f"WHEN {x} <= {w} THEN {w}" for w in U.STANDARD_THUMB_WIDTHS)
    return f"(CASE {arms} ELSE {U.STANDARD_THUMB_WIDTHS[-1]} END)"


def enc_sql(x: str) -> str:
    return f"replace(replace(replace({x}, '/', '%2F'), ':', '%3A'), '_', '%20')"


def count_sql(col: str, needle: str) -> str:
    return f"CAST((length({col}) - length(replace({col}, '{needle}', ''))) // {len(needle)} AS BIGINT)"


CUST_SQL = """
  SELECT c_custkey, c_nationkey, c_mktsegment, n_nationkey, n_name, lower(r_name) AS rg,
         replace(c_name, '#', '_') AS nm, c_custkey % 5 AS k
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

WIKIURL_EXPECTED = f"""
  CASE k
    WHEN 0 THEN CASE WHEN n_nationkey <> 0 THEN '{FX.SERVER}/wiki/' || n_name || ':' || nm
                     ELSE {enc_sql("n_name || ':' || nm")} END
    WHEN 1 THEN CASE WHEN rg = 'middle east' THEN {enc_sql("rg || ':' || nm")}
                     WHEN rg = 'asia' THEN 'http://asia.example.com/w/' || nm
                     ELSE 'http://' || rg || '.example.org/wiki/' || nm END
    WHEN 2 THEN CASE WHEN c_custkey % 10 = 2
                     THEN 'http://upload.wikimedia.org/thumb/x/' || nm || '/' || CAST({ladder_sql("c_nationkey * 100")} AS VARCHAR) || 'px-' || nm || '.jpg'
                     ELSE 'http://' || rg || '.example.net/' || nm END
    WHEN 3 THEN CASE WHEN c_custkey % 10 = 3 THEN '#' || c_mktsegment ELSE replace(nm, '_', '%20') || '#' || c_mktsegment END
    ELSE replace(nm, '_', '%20') || '%2F' || CAST(c_nationkey AS VARCHAR) || '?x=1'
  END"""

WIKIURL_KIND = """
  CASE k
    WHEN 0 THEN CASE WHEN n_nationkey <> 0 THEN 'namespace' ELSE 'article' END
    WHEN 1 THEN CASE WHEN rg = 'middle east' THEN 'article' ELSE 'interwiki' END
    WHEN 2 THEN 'absolute'
    WHEN 3 THEN CASE WHEN c_custkey % 10 = 3 THEN 'self' ELSE 'article' END
    ELSE 'article'
  END"""


def tokens(spark, articles: DataFrame) -> DataFrame:
    return N.tokenize(articles.select("article_id", "text"), "text")


def nodes_of(df: DataFrame, grouped: bool = False) -> DataFrame:
    return N.tokenize(df.select(F.col("article_id").cast("long").alias("article_id"), "text"), "text", grouped=grouped)


# ---------------------------------------------------------------- links


@query("link_kinds", f"""
WITH u AS ({CUST_SQL}),
k AS (
  SELECT {WIKIURL_KIND} AS kind FROM u
  UNION ALL
  SELECT 'article' AS kind FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages)
)
SELECT kind, count(*) AS n_links FROM k GROUP BY kind
""")
def link_kinds(spark, d):
    """Flagship: EXT-1 link table over the page corpus plus the wiki URL shapes, by kind."""
    dims = FX.query_dims(spark, d)
    pages = FX.table(spark, d, "pages").select(F.col("page_id").alias("article_id"), F.col("html").alias("text"))
    page_links = L.links_table(nodes_of(pages), dims).select("kind")
    wiki = L.rewrite_urls(FX.v_wikiurls(spark, d), "url", "new_url", dims, title_col="title", kind_col="kind").select("kind")
    return page_links.unionByName(wiki).groupBy("kind").agg(F.count("*").alias("n_links"))


@query("url_rewrite", f"""
WITH u AS ({CUST_SQL})
SELECT c_custkey, {WIKIURL_EXPECTED} AS new_url, {WIKIURL_KIND} AS kind FROM u
""")
def url_rewrite(spark, d):
    """SCL-6 with JOIN-5/6/9 on every URL shape."""
    dims = FX.query_dims(spark, d)
    out = L.rewrite_urls(FX.v_wikiurls(spark, d), "url", "new_url", dims, title_col="title", kind_col="kind")
    return out.select("c_custkey", "new_url", "kind")


URL_HELPERS_SQL = f"""
WITH p AS (
  SELECT p_partkey, p_name, p_brand, p_size,
         CASE p_partkey % 6 WHEN 0 THEN 'jpg' WHEN 1 THEN 'PNG' WHEN 2 THEN 'pdf' WHEN 3 THEN 'svg'
                            WHEN 4 THEN 'jpeg.txt' ELSE 'gif' END AS ext
  FROM part)
SELECT p_partkey,
       (p_partkey % 6) IN (0, 1, 3, 5) AS is_image,
       '/w/File:' || replace(p_name, ' ', '_') || '.' || ext AS swapped,
       '{FX.SERVER}/w/File:' || replace(p_name, ' ', '_') || '.' || ext AS ext_url,
       CASE WHEN p_partkey % 2 = 0 THEN 'http://img.example.org/' || CAST(p_partkey AS VARCHAR)
            ELSE 'ftp://x/' || CAST(p_partkey AS VARCHAR) END AS with_http,
       replace(replace(p_name || '/' || p_brand, '#', '%23'), ' ', '%20') AS quoted,
       p_name || '/' || p_brand AS unquoted,
       'geo:' || CAST(p_size - 25 AS VARCHAR) || ',' || CAST(p_partkey % 360 - 180 AS VARCHAR) AS geolink,
       CASE WHEN p_size % 2 = 0 THEN '<div dir="rtl" class="rtl">' || p_name || '</div>' ELSE p_name END AS rtl_wrapped
FROM p
"""


@query("url_helpers", URL_HELPERS_SQL)
def url_helpers(spark, d):
    """SCL-1, 2, 3, 8, 12, 13, 14, 15 on columns of part."""
    p = FX.table(spark, d, "part")
    k = F.col("p_partkey")
    ext = F.element_at(F.array(*[F.lit(x) for x in ("jpg", "PNG", "pdf", "svg", "jpeg.txt", "gif")]), (k % 6 + 1).cast("int"))
    path = F.concat(F.lit("/wiki/File:"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("."), ext)
    host = F.when(k % 2 == 0, F.concat(F.lit("//img.example.org/"), k.cast("string"))).otherwise(F.concat(F.lit("ftp://x/"), k.cast("string")))
    quoted = U.quote_path(F.concat(F.col("p_name"), F.lit("/"), F.col("p_brand")))
    pad = lambda c: F.concat(F.lit(" "), c.cast("string"), F.lit(" "))
    return p.select(
        "p_partkey",
        U.is_image(path).alias("is_image"),
        U.replace_article_path(F.lit("/wiki/"), F.lit("/w/"), path).alias("swapped"),
        U.mk_ext_url(F.lit(FX.SERVER), F.lit("/wiki/"), F.lit("/w/"), path).alias("ext_url"),
        U.add_http(host).alias("with_http"),
        quoted.alias("quoted"),
        U.unquote(quoted).alias("unquoted"),
        G.geo_href(pad(F.col("p_size") - 25), pad(k % 360 - 180)).alias("geolink"),
        U.wrap_rtl(F.col("p_name"), F.col("p_size") % 2 == 0).alias("rtl_wrapped"),
    )


@query("srcset_rewrite", f"""
SELECT p_partkey,
  'http://upload.wikimedia.org/t/' || CAST(p_partkey AS VARCHAR) || '/' || CAST({ladder_sql("p_size * 10")} AS VARCHAR)
  || 'px-a.jpg 1x, File%3A' || replace(p_name, ' ', '%20') || '.png 2x, http://asia.example.com/w/'
  || CAST(p_partkey AS VARCHAR) || ' 3x' AS new_srcset
FROM part
""")
def srcset_rewrite(spark, d):
    """SCL-7: every candidate's URL rewritten, descriptors kept."""
    dims = FX.query_dims(spark, d)
    p = FX.table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    s = F.concat(F.lit("//upload.wikimedia.org/t/"), k, F.lit("/"), (F.col("p_size") * 10).cast("string"),
                 F.lit("px-a.jpg 1x, /wiki/File:"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")),
                 F.lit(".png 2x, asia:"), k, F.lit(" 3x"))
    out = L.rewrite_srcset(p.select("p_partkey", s.alias("srcset")), "srcset", "new_srcset", dims)
    return out.select("p_partkey", "new_srcset")


@query("thumb_width", f"""
SELECT l_orderkey, l_linenumber, l_partkey AS requested_width, {ladder_sql("l_partkey")} AS standard_width,
  CASE WHEN {ladder_sql("l_partkey")} = l_partkey
       THEN '/wikipedia/commons/thumb/a/ab/x.jpg/' || CAST(l_partkey AS VARCHAR) || 'px-x.jpg'
       ELSE '/wikipedia/commons/thumb/a/ab/x.jpg/' || CAST({ladder_sql("l_partkey")} AS VARCHAR) || 'px-x.jpg' END AS new_path
FROM lineitem
""")
def thumb_width(spark, d):
    """JOIN-7 + SCL-5 on thumbnail paths with the width taken from lineitem."""
    li = FX.table(spark, d, "lineitem")
    path = F.concat(F.lit("/wikipedia/commons/thumb/a/ab/x.jpg/"), F.col("l_partkey").cast("string"), F.lit("px-x.jpg"))
    req = U.thumb_requested_width(path)
    return li.select("l_orderkey", "l_linenumber", req.alias("requested_width"),
                     U.round_up_thumb_width(req).alias("standard_width"), U.fix_thumb_width(path).alias("new_path"))


# ---------------------------------------------------------------- maps / geo


TILES_SQL = """
WITH g AS (
  SELECT c_custkey, CAST(c_custkey % 170 - 85 AS DOUBLE) AS lat, CAST(c_custkey * 7 % 360 - 180 AS DOUBLE) AS lon,
         CAST(c_custkey % 19 AS INTEGER) AS zoom
  FROM customer WHERE c_custkey % 7 <> 0)
SELECT c_custkey AS article_id, zoom,
  CAST(trunc((lon + 180.0) / 360.0 * pow(2.0, zoom)) AS BIGINT) AS xtile,
  CAST(trunc((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * pow(2.0, zoom)) AS BIGINT) AS ytile,
  'https://tile.openstreetmap.org/' || CAST(zoom AS VARCHAR) || '/' || CAST(CAST(trunc((lon + 180.0) / 360.0 * pow(2.0, zoom)) AS BIGINT) AS VARCHAR)
    || '/' || CAST(CAST(trunc((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * pow(2.0, zoom)) AS BIGINT) AS VARCHAR) || '.png' AS tile_url,
  'https://www.openstreetmap.org/#map=' || CAST(zoom AS VARCHAR) || '/' || CAST(lat AS VARCHAR) || '/' || CAST(lon AS VARCHAR) AS map_url,
  'https://tile.openstreetmap.org/' || CAST(zoom AS VARCHAR) || '/' || CAST(CAST(trunc((lon + 180.0) / 360.0 * pow(2.0, zoom)) AS BIGINT) AS VARCHAR)
    || '/' || CAST(CAST(trunc((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * pow(2.0, zoom)) AS BIGINT) AS VARCHAR) || '.png' AS img_src
FROM g
"""


@query("tiles", TILES_SQL)
def tiles(spark, d):
    """DOC-13 + EXT-4 + SCL-4: map anchors to static tiles; a missing attribute drops the map."""
    nodes = C.convert_maps(nodes_of(FX.v_geo_html(spark, d), grouped=True))
    # the map's image is the row right after the anchor
    nodes = nodes.withColumn("__img", F.lead(F.col("attrs")["src"]).over(N.article_window()))
    m = nodes.where(F.col("__map").isNotNull()).select("article_id", "__map.*", F.col("__img").alias("img_src"))
    return m.select("article_id", "zoom", "xtile", "ytile", "tile_url", "map_url", "img_src")


@query("geo_points", """
WITH g AS (SELECT c_custkey, CAST(c_custkey % 170 - 85 AS VARCHAR) AS lat, CAST(c_custkey * 7 % 360 - 180 AS VARCHAR) AS lon FROM customer)
SELECT c_custkey AS article_id, lat, lon,
  CASE c_custkey % 3 WHEN 0 THEN 'nondefault' WHEN 1 THEN 'microformat' ELSE 'dms' END AS format,
  'geo:' || lat || ',' || lon AS href
FROM g WHERE NOT (c_custkey % 3 = 0 AND c_custkey % 10 = 9)
""")
def geo_points(spark, d):
    """DOC-12 + EXT-3: the three coordinate microformats to geo: links."""
    nodes = C.geo_links(nodes_of(FX.v_coord_html(spark, d), grouped=True))
    return X.coordinates(nodes).select("article_id", "lat", "lon", "format", "href")


@query("newline_collapse", """
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10) || chr(10)) ELSE text END AS text FROM documents)
SELECT doc_id, CAST(length(regexp_replace(text, '\\n{2,}', chr(10), 'g')) AS BIGINT) AS n_chars,
       md5(regexp_replace(text, '\\n{2,}', chr(10), 'g')) AS digest
FROM t
""")
def newline_collapse(spark, d):
    """SCL-11 on documents with newline runs."""
    docs = FX.table(spark, d, "documents")
    t = F.when(F.col("doc_id") % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n\n"))).otherwise(F.col("text"))
    c = F.regexp_replace(t, r"\n{2,}", "\n")
    return docs.select("doc_id", F.length(c).cast("long").alias("n_chars"), F.md5(c).alias("digest"))


# ---------------------------------------------------------------- ingest


DUMP_GOOD_SQL = """
SELECT page_id AS line_id, url AS title, CAST(length(html) AS BIGINT) AS n_chars,
  CASE WHEN page_id % 23 = 0 THEN '' ELSE 'R' || CAST(page_id AS VARCHAR) || '|S' || CAST(page_id AS VARCHAR) END AS aliases
FROM pages WHERE page_id % 17 <> 0 AND page_id % 19 <> 0
"""


@query("dump_decode", DUMP_GOOD_SQL)
def dump_decode(spark, d):
    """SRC-1/SRC-3/PRJ-1/EXT-7: decoded dump lines (redirects as aliases)."""
    good = D.good_lines(D.decode_dump_lines(FX.v_ndjson(spark, d)))
    return good.select("line_id", "title", F.length("text").cast("long").alias("n_chars"),
                       F.array_join(F.transform("aliases", lambda a: a["key"]), "|").alias("aliases"))


@query("dump_quarantine", """
SELECT page_id AS line_id, CASE WHEN page_id % 17 = 0 THEN 'malformed' ELSE 'redirects null' END AS reason
FROM pages WHERE page_id % 17 = 0 OR page_id % 19 = 0
""")
def dump_quarantine(spark, d):
    """SRC-3: lines that cannot be decoded, with the reason, never silently lost."""
    return D.quarantine(D.decode_dump_lines(FX.v_ndjson(spark, d))).select("line_id", "reason")


@query("line_slice", """
SELECT l_linenumber AS file_number, l_orderkey AS line_number, l_partkey FROM lineitem
WHERE l_linenumber BETWEEN 2 AND 5 AND l_orderkey BETWEEN 100 AND 9000
""")
def line_slice(spark, d):
    """FLT-1 / SRT-3 / WIN-2: file:line range (line bounds apply to every file)."""
    return FX.v_lines(spark, d).where(D.line_range(FX.LINE_START, FX.LINE_END)).select(
        F.col("file_number").cast("int").alias("file_number"), F.col("line_number").cast("long").alias("line_number"), "l_partkey")


SCRAPE_SQL = """
WITH c AS (
  SELECT c_custkey, replace(c_name, '#', ' ') AS title, n_name, c_mktsegment, c_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0)
SELECT title, c_custkey % 7 <> 0 AS has_text,
  CASE WHEN c_custkey % 7 = 0 THEN ''
       ELSE array_to_string(list_sort(list_distinct([
         'Alias ' || CAST(c_custkey AS VARCHAR) || '#',
         'Seg ' || c_mktsegment || '#f' || CAST(c_nationkey AS VARCHAR),
         n_name || ' de#',
         c_mktsegment || '#'])), '|') END AS aliases
FROM c
"""


def _scraped(spark, d):
    return SC.decode_scrape_rows(FX.v_docs(spark, d), FX.LANGLINKS)


def _alias_str(col="aliases"):
    return F.array_join(F.array_sort(F.transform(col, lambda a: F.concat(a["key"], F.lit("#"), F.coalesce(a["fragment"], F.lit(""))))), "|")


@query("scrape_decode", SCRAPE_SQL)
def scrape_decode(spark, d):
    """SRC-4, FLT-4, FLT-6, FLT-7 rows, AGG-1, SET-3, SCL-19."""
    return _scraped(spark, d).select("title", F.col("text").isNotNull().alias("has_text"), _alias_str().alias("aliases"))


@query("key_range", f"""
SELECT replace(c_name, '#', ' ') AS title FROM customer
WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0
  AND replace(c_name, '#', ' ') >= '{FX.KEY_START}' AND replace(c_name, '#', ' ') <= '{FX.KEY_END}'
""")
def key_range(spark, d):
    """FLT-2: start/end key over document ids."""
    return SC.key_range(_scraped(spark, d), FX.KEY_START, FX.KEY_END).select("title")


KEYS_SQL = """
WITH k AS (SELECT DISTINCT 'Customer ' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') AS title, o_custkey * 2 AS ck FROM orders),
docs AS (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0)
SELECT title, ck IN (SELECT c_custkey FROM docs) AS found FROM k
"""


@query("key_list", KEYS_SQL)
def key_list(spark, d):
    """SRC-5 + SCL-18 + JOIN-3 + JOIN-4: requested keys, found or not."""
    keys = SC.keys_from_lines(FX.v_keys(spark, d))
    return SC.by_key_list(_scraped(spark, d), keys).select("title", "found")


@query("key_missing", KEYS_SQL.replace("SELECT title, ck IN (SELECT c_custkey FROM docs) AS found FROM k",
                                       "SELECT title FROM k WHERE ck NOT IN (SELECT c_custkey FROM docs)"))
def key_missing(spark, d):
    """SET-2 / JOIN-4: requested minus found; these become NULL-text (E) articles."""
    keys = SC.keys_from_lines(FX.v_keys(spark, d))
    return SC.by_key_list(_scraped(spark, d), keys).where(~F.col("found")).select("title")


@query("source_union", """
SELECT 'dump' AS source, count(*) AS n_articles, count(*) AS n_with_text FROM pages WHERE page_id % 17 <> 0 AND page_id % 19 <> 0
UNION ALL
SELECT 'scrape', count(*), count(*) FILTER (WHERE c_custkey % 7 <> 0) FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0
""")
def source_union(spark, d):
    """SET-1 + PRJ-2: both sources to one article schema, duplicates kept."""
    dump = D.dump_articles(D.good_lines(D.decode_dump_lines(FX.v_ndjson(spark, d))), "dump").select("title", "text", "source")
    scraped = _scraped(spark, d).select("title", "text", F.lit("scrape").alias("source"))
    both = scraped.unionByName(dump)
    return both.groupBy("source").agg(F.count("*").alias("n_articles"), F.count("text").alias("n_with_text"))


# ---------------------------------------------------------------- dims


@query("ns_lookup", """
WITH n AS (SELECT n_nationkey AS id, 'Ns' || CAST(n_nationkey AS VARCHAR) AS canonical, n_name AS name FROM nation WHERE n_nationkey <> 0)
SELECT name, id AS ns_id FROM (
  SELECT canonical AS name, id FROM n UNION SELECT lower(canonical), id FROM n
  UNION SELECT name, id FROM n UNION SELECT lower(name), id FROM n)
""")
def ns_lookup(spark, d):
    """SRC-6 namespaces, FLT-5 (id 0 out), AGG-2 lookup keys."""
    return FX.query_dims(spark, d).ns_lookup.select("name", "ns_id")


@query("ns_local", """
SELECT n_nationkey AS id FROM nation WHERE n_nationkey NOT IN (3, 5, 7)
""")
def ns_local(spark, d):
    """JOIN-1 / JOIN-2 / SET-4 / UDF-2: namespaces named as local are not rewritten."""
    return SI.resolve_local_namespaces(FX.v_ns(spark, d), FX.LOCAL_NAMESPACES).select("id")


@query("iw_last_wins", """
SELECT lower(r_name) AS prefix,
  CASE WHEN r_regionkey = 2 THEN '//asia.example.com/w/$1' ELSE '//' || lower(r_name) || '.example.org/wiki/$1' END AS url
FROM region
""")
def iw_last_wins(spark, d):
    """AGG-2 + FLT-5: repeated prefix keeps the last entry; empty URLs are ignored."""
    return FX.query_dims(spark, d).interwiki.select("prefix", "url")


@query("site_info", """
SELECT r_regionkey, r_name AS sitename, 'l' || CAST(r_regionkey AS VARCHAR) AS sitelang, r_regionkey IN (1, 3) AS rtl,
  'http://creativecommons.org/l' AS license_url,
  CASE WHEN r_regionkey = 3 THEN NULL ELSE '/wiki/' END AS articlepath,
  'http://' || lower(r_name) || '.example.org' AS server
FROM region
""")
def site_info(spark, d):
    """SRC-6 site row: SCL-8 add_http, SCL-9 article path prefix, SCL-10 rtl presence."""
    docs = FX.v_site_json(spark, d)
    info = docs.select("r_regionkey", SI.parse_siteinfo(F.col("json")).alias("s")).select("r_regionkey", "s.*")
    return SI.site_columns(info, keep=["r_regionkey"]).select(
        "r_regionkey", "sitename", "sitelang", "rtl", "license_url", "articlepath", "server")


# ---------------------------------------------------------------- node table


@query("tokenize_counts", f"""
SELECT page_id AS article_id, {count_sql("html", "<a ")} AS n_a, {count_sql("html", "<p>")} AS n_p,
       {count_sql("html", "<li>")} AS n_li, {count_sql("html", "<!--")} AS n_comment
FROM pages
""")
def tokenize_counts(spark, d):
    """DOC-1: token counts per page from the node table."""
    pages = FX.table(spark, d, "pages").select(F.col("page_id").alias("article_id"), F.col("html").alias("text"))
    n = nodes_of(pages)
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    op = F.col("kind") == "open"
    return n.groupBy("article_id").agg(
        cnt(op & (F.col("tag") == "a")).alias("n_a"), cnt(op & (F.col("tag") == "p")).alias("n_p"),
        cnt(op & (F.col("tag") == "li")).alias("n_li"), cnt(F.col("kind") == "comment").alias("n_comment"))


def _counts(n: DataFrame, tags: list[str]) -> DataFrame:
    op = F.col("kind") == "open"
    aggs = [F.sum(F.when(op & (F.col("tag") == t), 1).otherwise(0)).cast("long").alias(f"n_{t}") for t in tags]
    aggs.append(F.sum(F.when(F.col("kind") == "comment", 1).otherwise(0)).cast("long").alias("n_comment"))
    return n.groupBy("article_id").agg(*aggs)


@query("sanitise", f"""
SELECT page_id AS article_id, {count_sql("html", "<a ")} AS n_a, {count_sql("html", "<style>")} AS n_style,
  CAST(0 AS BIGINT) AS n_script, CAST(0 AS BIGINT) AS n_meta, CAST(0 AS BIGINT) AS n_title,
  CAST(0 AS BIGINT) AS n_html, {count_sql("html", "<body>")} AS n_body, CAST(0 AS BIGINT) AS n_comment
FROM pages
""")
def sanitise(spark, d):
    """DOC-2: scripts, meta, comments out; html/title unwrapped; style and anchors kept."""
    pages = FX.table(spark, d, "pages").select(F.col("page_id").alias("article_id"), F.col("html").alias("text"))
    n = C.sanitise_rows(nodes_of(pages, grouped=True))
    n = N.drop_subtrees(n, C.is_open() & F.col("tag").isin(*C.KILL_TAGS))
    return _counts(n, ["a", "style", "script", "meta", "title", "html", "body"])


@query("head_drop", f"""
SELECT page_id AS article_id, CAST(0 AS BIGINT) AS n_head, CAST(0 AS BIGINT) AS n_style, {count_sql("html", "<a ")} AS n_a,
  {count_sql("html", "<body>")} AS n_body
FROM pages
""")
def head_drop(spark, d):
    """DOC-4 + WIN-3: head (with title, style) and base removed with their content."""
    pages = FX.table(spark, d, "pages").select(F.col("page_id").alias("article_id"), F.col("html").alias("text"))
    n = N.drop_subtrees(C.sanitise_rows(nodes_of(pages, grouped=True)), C.kill_hit())
    return _counts(n, ["head", "style", "a", "body"]).drop("n_comment")


def _text_of(n: DataFrame, tags: list[str] = ()) -> DataFrame:
    """The text of each article and how many elements of each tag it has, in one aggregation."""
    of = [F.sum(F.when((F.col("kind") == "open") & (F.col("tag") == t), 1).otherwise(0)).cast("long").alias(f"n_{t}") for t in tags]
    return n.groupBy("article_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == "text", F.struct("pos", "text"))))["text"], "").alias("text"), *of)


RULE_SQL = """
SELECT p_partkey AS article_id,
  'tail' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '' ELSE 'coll' || CAST(p_partkey AS VARCHAR) END
    || 'keep' || CAST(p_partkey AS VARCHAR) || 'text ' || p_name || 'ok' || CAST(p_partkey AS VARCHAR)
    || CASE WHEN p_size % 3 <> 0 THEN 'full' ELSE '' END AS text,
  CAST(1 + CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END + CASE WHEN p_size % 3 <> 0 THEN 1 ELSE 0 END AS BIGINT) AS n_div,
  CAST(1 AS BIGINT) AS n_img, CAST(1 AS BIGINT) AS n_a, CAST(1 AS BIGINT) AS n_p, CAST(1 AS BIGINT) AS n_li
FROM part
"""


@query("rule_drop", RULE_SQL)
def rule_drop(spark, d):
    """DOC-3 + UDF-1 + WIN-3 + JOIN-10: selector rules (classes, :not, ^=, :empty, >,
    descendant) drop elements with their subtree, in rule order."""
    n = C.apply_rules(nodes_of(FX.v_rules_html(spark, d), grouped=True), FX.RULES)
    return _text_of(n, ["div", "img", "a", "p", "li"])


def _rules_html_sql() -> str:
    parts = []
    for x in FX.rules_html("CAST(p_partkey AS VARCHAR)", "p_size", "p_name", "p_brand"):
        if isinstance(x, tuple):
            cond = "p_size % 2 = 0" if x[0] == "size_even" else "p_size % 3 <> 0"
            parts.append(f"CASE WHEN {cond} THEN '{x[1]}' ELSE '' END")
        elif x.startswith("CAST") or x in ("p_name", "p_brand"):
            parts.append(x)
        else:
            parts.append("'" + x.replace("'", "''") + "'")
    return " || ".join(parts)


@query("serialise_text", f"SELECT p_partkey AS article_id, {_rules_html_sql()} AS html FROM part")
def serialise_text(spark, d):
    """DOC-1 + DOC-16 + AGG-5: tokenize -> serialise is the identity on normalised HTML."""
    return N.serialise(nodes_of(FX.v_rules_html(spark, d), grouped=True), wrap_tag=None)


@query("unwrap", """
SELECT c_custkey AS article_id, 'red ' || CAST(c_custkey AS VARCHAR) || ' and ipa keep' AS text, CAST(1 AS BIGINT) AS n_a
FROM customer
""")
def unwrap(spark, d):
    """DOC-5: red links and IPA links lose their tag, keep their text."""
    n = C.unwrap_rules(nodes_of(FX.v_new_html(spark, d), grouped=True))
    return _text_of(n, ["a"])


def _attr_string(n: DataFrame) -> DataFrame:
    s = F.array_join(F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ")
    return n.where(F.col("kind") == "open").select("article_id", "tag", s.alias("attrs"))


@query("bg_strip", """
SELECT p_partkey AS article_id, 'div' AS tag, 'style=color: red;' || chr(10) || 'margin: ' || CAST(p_size AS VARCHAR) || 'px class=bg' AS attrs FROM part
UNION ALL SELECT p_partkey, 'span', 'style=' FROM part
UNION ALL SELECT p_partkey, 'p', 'style=background: red' FROM part
""")
def bg_strip(spark, d):
    """DOC-6: background declarations removed from styles of the selected elements."""
    n = C.strip_background(nodes_of(FX.v_attr_html(spark, d)), FX.BG_SELECTORS)
    return _attr_string(n).where(F.col("tag").isin("div", "span", "p") & F.col("attrs").startswith("style"))


@query("attr_strip", """
SELECT p_partkey AS article_id, 'section' AS tag, 'class=s' AS attrs FROM part
UNION ALL SELECT p_partkey, 'a', 'id=cite' || CAST(p_partkey AS VARCHAR) || ' href=http://e.org/' || CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'div', 'rel=keep data-mw-section-id=' || CAST(p_partkey AS VARCHAR) FROM part
""")
def attr_strip(spark, d):
    """DOC-10 (+ DOC-2 on* removal): wiki attributes stripped per tag."""
    n = C.strip_attributes(C.sanitise_rows(nodes_of(FX.v_attr_html(spark, d))))
    return _attr_string(n).where(F.col("tag").isin("section", "a") | ((F.col("tag") == "div") & ~F.col("attrs").startswith("style")))


@query("href_src_rewrite", f"""
WITH u AS ({CUST_SQL})
SELECT c_custkey AS article_id, {WIKIURL_EXPECTED} AS href,
  'File%3A' || replace(nm, '_', '%20') || '.png' AS src,
  'http://upload.wikimedia.org/a/' || CAST(c_custkey AS VARCHAR) || '/500px-a.jpg 2x, B%20c 3x' AS srcset
FROM u
""")
def href_src_rewrite(spark, d):
    """DOC-7 + DOC-8: href, src and srcset of every element rewritten on the node table."""
    from .convert import rewrite_node_links, swap_links
    dims = FX.query_dims(spark, d)
    arts = FX.v_links_html(spark, d)
    n = N.tokenize(arts.select(F.col("article_id").cast("long").alias("article_id"), "text", F.col("title").alias("__title"),
                               F.lit(None).cast("string").alias("__ap")), "text", carry=["__title", "__ap"], grouped=True)
    n = swap_links(rewrite_node_links(n, dims, ConvertOptions()))
    of = lambda tag, name: F.max(F.when((F.col("kind") == "open") & (F.col("tag") == tag), F.col("attrs")[name])).alias(name)
    return n.groupBy("article_id").agg(of("a", "href"), of("img", "src"), of("img", "srcset"))


CONTENT_SQL = {k: "'" + v.replace("'", "''") + "'" for k, v in {
    "head": CSS_LINKS + '<div><body><p>red gone keep</p><div class="geo-box"><span>b</span></div><a href="geo:',
    "icon": '"><img class="a2-geo-link-icon" src="~%2Fimages%2FGlobe.svg"></a>', "note": '<a href="#cite_note-', "tail": '">n</a><ul class="menu"></ul></body></div>',
}.items()}


@query("convert_content", f"""
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS s FROM customer)
SELECT k AS article_id, 'S' AS status, md5({CONTENT_SQL['head']} || s || ',2' || {CONTENT_SQL['icon']} || {CONTENT_SQL['note']} || s || {CONTENT_SQL['tail']}) AS content_md5 FROM c
""")
def convert_content(spark, d):
    """DOC-17 + SCL-16 by content: rules see raw links and the tree without scripts, unwrapped tags hand their children
    over, links are rewritten, geo links stand behind their container."""
    s = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit('<html><head><title>x</title></head><body><p>red <a class="new" href="./X">gone</a> keep</p><p><script>x</script></p>'
              '<div class="geo-box"><span>b</span><span class="geo-nondefault"><b><i><u><s><tt><em><span class="geo">'), s,
        F.lit(';2</span></em></tt></s></u></i></b></span></div><a href="./C'), s, F.lit("#cite_note-"), s,
        F.lit('">n</a><a href="#cite_ref">gone too</a><ul class="menu"><foo><li>dropped</li></foo></ul></body></html>'))
    arts = spark.read.parquet(f"{d}/customer.parquet").select(
        F.col("c_custkey").alias("article_id"), F.concat(F.lit("C"), s).alias("title"), html.alias("text"), F.lit("./").alias("articlepath"))
    options = ConvertOptions(rules=["p:empty", 'a[href^="#cite"]', "ul.menu > li"])
    out = convert_articles(arts, FX.query_dims(spark, d), options, header=False)
    return out.select("article_id", "status", F.md5("content").alias("content_md5"))


LINE_RANK_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
FROM lineitem
"""


@query("autonumber", f"""
WITH l AS ({LINE_RANK_SQL})
SELECT l_orderkey AS article_id, CAST(rn AS BIGINT) AS rn,
  CASE WHEN l_linenumber % 3 = 0 THEN 'ref' ELSE '[' || CAST(rn AS VARCHAR) || ']' END AS text
FROM l
""")
def autonumber(spark, d):
    """DOC-9 + WIN-1: external-link autonumbering in document order."""
    n = C.autonumber(nodes_of(FX.v_auto_html(spark, d), grouped=True))
    w = N.article_window()
    n = n.withColumn("__t", F.lead("text").over(w)).withColumn("__k", F.lead("kind").over(w))
    a = n.where((F.col("kind") == "open") & (F.col("tag") == "a"))
    return a.select("article_id", F.regexp_extract(F.col("attrs")["href"], r"/(\d+)$", 1).cast("long").alias("rn"),
                    F.when(F.col("__k") == "text", F.col("__t")).alias("text"))


@query("headings_toc", f"""
WITH l AS ({LINE_RANK_SQL}),
items AS (
  SELECT l_orderkey, rn,
    '<li><a href="#l' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(rn AS VARCHAR) || '">Line ' || CAST(rn AS VARCHAR) || '</a>'
    || CASE WHEN rn % 2 = 0 THEN '<ol><li><a href="#q' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(rn AS VARCHAR) || '">Qty '
            || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '</a></li></ol>' ELSE '' END || '</li>' AS s
  FROM l)
SELECT l_orderkey AS article_id,
  '<div id="a2-toc"><ol class="toc"><li><a href="#o' || CAST(l_orderkey AS VARCHAR) || '">Order ' || CAST(l_orderkey AS VARCHAR)
  || '</a><ol>' || string_agg(s, '' ORDER BY rn) || '</ol></li></ol></div>' AS toc_html
FROM items GROUP BY l_orderkey
""")
def headings_toc(spark, d):
    """EXT-2 + WIN-4 + AGG-6: headings table nested into the contents list."""
    return X.toc_html(X.headings(nodes_of(FX.v_toc_html(spark, d), grouped=True)))


def _math_nodes(spark, d):
    n = nodes_of(FX.v_math_html(spark, d), grouped=True)
    return C.math_images(C.strip_attributes(C.math_tex(n)))


@query("formulas", """
SELECT p_partkey AS article_id,
  CASE p_partkey % 5 WHEN 0 THEN 'x^' || CAST(p_size AS VARCHAR) WHEN 1 THEN '\\sqrt{' || CAST(p_size AS VARCHAR) || '}'
       ELSE 'a_' || CAST(p_partkey AS VARCHAR) END AS tex,
  p_partkey % 5 <> 0 AS display
FROM part WHERE p_partkey % 5 IN (0, 1, 2)
""")
def formulas(spark, d):
    """DOC-11 + SCL-17 + EXT-5: formulas with TeX and display flag."""
    return X.formulas(_math_nodes(spark, d)).select("article_id", "tex", "display")


@query("has_math", """
SELECT p_partkey AS article_id, p_partkey % 5 <> 4 AS has_math FROM part
""")
def has_math(spark, d):
    """AGG-4: articles with math markup after clean-up."""
    return _math_nodes(spark, d).groupBy("article_id").agg(F.max("__has_math").alias("has_math"))


@query("tex_prefilter", """
SELECT p_partkey,
  CASE WHEN p_partkey % 3 = 0 THEN p_size || '\\% of \\iint' || replace(p_name, ' ', '') || p_type || '\\subset\\!\\!\\supset x'
       ELSE '50\\% \\R^' || p_size || ' \\%' || p_type || ' + \\'
            || (['alpha', 'Complex', 'infin', 'rarr', 'R', 'bold', 'sgn'])[p_partkey % 7 + 1] || '{x} \\Z' END AS tex
FROM part
""")
def tex_prefilter(spark, d):
    """TEX-1: percent escaping and the old integral spacing hacks."""
    return FX.v_tex(spark, d).select("p_partkey", TX.prefilter(F.col("tex")).alias("tex"))


@query("tex_macros", """
WITH p AS (SELECT p_partkey % 7 AS k FROM part WHERE p_partkey % 3 <> 0),
written AS (
  SELECT 'R' AS macro, '\\mathbb{R}' AS expansion, 0 AS n_args FROM p
  UNION ALL SELECT 'Z', '\\mathbb{Z}', 0 FROM p
  UNION ALL SELECT 'Complex', '\\mathbb{C}', 0 FROM p WHERE k = 1
  UNION ALL SELECT 'infin', '\\infty', 0 FROM p WHERE k = 2
  UNION ALL SELECT 'rarr', '\\rightarrow', 0 FROM p WHERE k = 3
  UNION ALL SELECT 'R', '\\mathbb{R}', 0 FROM p WHERE k = 4
  UNION ALL SELECT 'bold', '\\mathbf{#1}', 1 FROM p WHERE k = 5
  UNION ALL SELECT 'sgn', '\\operatorname{sgn}', 0 FROM p WHERE k = 6)
SELECT macro, expansion, n_args, count(*) AS n_uses FROM written GROUP BY ALL
""")
def tex_macros(spark, d):
    """TEX-2: uses of wiki-dialect macros (broadcast join to the 91-row dictionary)."""
    uses = TX.macro_uses(FX.v_tex(spark, d))
    return uses.groupBy("macro", "expansion", "n_args").agg(F.count("*").alias("n_uses"))


# ---------------------------------------------------------------- product


def _converted(spark, d):
    dims = FX.query_dims(spark, d)
    arts = FX.v_articles(spark, d, null_every=9)
    return convert_articles(arts, dims, ConvertOptions(rules=[".ad"]))


@query("convert_all", """
SELECT page_id AS article_id, url AS title, CASE WHEN page_id % 9 = 0 THEN 'E' ELSE 'S' END AS status, false AS has_math
FROM pages
""")
def convert_all(spark, d):
    """DOC-17 + SCL-16 + PRJ-4: the whole conversion of the page corpus."""
    return _converted(spark, d).select("article_id", "title", "status", "has_math")


@query("outcomes", """
SELECT CASE WHEN page_id % 9 = 0 THEN 'E' ELSE 'S' END AS status, count(*) AS n_articles FROM pages GROUP BY 1
""")
def outcomes(spark, d):
    """AGG-3 + SNK-4: articles per status (S + F + E = articles in)."""
    return DI.outcome_totals(_converted(spark, d)).select("status", "n_articles")


TAGS_SQL = """
WITH s AS (SELECT r_name, lower(r_name) AS rg, r_regionkey FROM region WHERE r_regionkey = 1),
ll AS (SELECT string_agg(n_name, ' ' ORDER BY n_name) AS v FROM nation WHERE n_regionkey = 1)
SELECT 'license.name' AS name, 'License ' || r_name AS value FROM s
UNION ALL SELECT 'license.url', 'http://example.org/license/' || CAST(r_regionkey AS VARCHAR) FROM s
UNION ALL SELECT 'created.by', 'pagelex' FROM s
UNION ALL SELECT 'copyright', '' FROM s
UNION ALL SELECT 'source', 'http://' || rg || '.example.org' FROM s
UNION ALL SELECT 'uri', 'http://' || rg || '.example.org' FROM s
UNION ALL SELECT 'label', r_name || ' (en)' FROM s
UNION ALL SELECT 'langlinks', v FROM ll
"""


@query("tags", TAGS_SQL)
def tags(spark, d):
    """PRJ-3 + SRT-2 + SNK-3: dictionary tags (defaults < site < non-empty options)."""
    r = FX.table(spark, d, "region").where(F.col("r_regionkey") == 1)
    site = r.select(F.col("r_name").alias("sitename"), F.lit("en").alias("sitelang"),
                    F.concat(F.lit("License "), F.col("r_name")).alias("license_name"),
                    F.concat(F.lit("http://example.org/license/"), F.col("r_regionkey").cast("string")).alias("license_url"),
                    F.concat(F.lit("http://"), F.lower("r_name"), F.lit(".example.org")).alias("server"))
    langs = FX.table(spark, d, "nation").where(F.col("n_regionkey") == 1).select(F.col("n_name").alias("lang"))
    return DI.tags_table(spark, DI.site_tags(site, langs), {"created.by": "pagelex", "uri": "", "license.name": ""})


def _dict_articles(spark, d):
    dec = D.good_lines(D.decode_dump_lines(FX.v_ndjson(spark, d)))
    return D.dump_articles(dec).withColumnRenamed("line_id", "article_id")


DICT_KEYS_SQL = """
WITH g AS (SELECT page_id, url FROM pages WHERE page_id % 17 <> 0 AND page_id % 19 <> 0)
SELECT url AS key, page_id AS content_id FROM g
UNION ALL SELECT 'R' || CAST(page_id AS VARCHAR), page_id FROM g WHERE page_id % 23 <> 0
UNION ALL SELECT 'S' || CAST(page_id AS VARCHAR), page_id FROM g WHERE page_id % 23 <> 0
"""


@query("dict_keys", DICT_KEYS_SQL)
def dict_keys(spark, d):
    """SNK-1 + SNK-2 + SRT-1: keys (title and aliases) of every converted blob."""
    conv = convert_articles(_dict_articles(spark, d), FX.query_dims(spark, d), ConvertOptions(rules=[".ad"]))
    return DI.keys_table(conv).select("key", "content_id")


@query("dict_lookup", f"""
WITH k AS ({DICT_KEYS_SQL}),
req AS (SELECT 'R' || CAST(page_id AS VARCHAR) AS key FROM pages WHERE page_id % 3 = 0
        UNION ALL SELECT url FROM pages WHERE page_id % 3 = 1)
SELECT req.key, k.content_id FROM req JOIN k ON req.key = k.key
""")
def dict_lookup(spark, d):
    """JOIN-8: requested keys resolved to content ids."""
    conv = convert_articles(_dict_articles(spark, d), FX.query_dims(spark, d), ConvertOptions(rules=[".ad"]))
    keys = DI.keys_table(conv)
    p = FX.table(spark, d, "pages")
    req = p.where(F.col("page_id") % 3 == 0).select(F.concat(F.lit("R"), F.col("page_id").cast("string")).alias("key")) \
        .unionByName(p.where(F.col("page_id") % 3 == 1).select(F.col("url").alias("key")))
    return DI.lookup(req, keys).select("key", "content_id")


from . import document_queries, product_queries  # noqa: E402, F401  (they register themselves)
