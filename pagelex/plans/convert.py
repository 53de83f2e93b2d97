"""DOC-17: the whole conversion of an article table, as one linear Spark plan.

``articles(article_id, title, text, aliases, articlepath?)`` ->
``converted(article_id, title, aliases, content binary, n_bytes, has_math, error, status)``

Plan shape (one Python step, node rows exchanged by article, and anew at each stage cut)::

    scan -> newline collapse -> articles dealt out -> tokenize (Arrow) -> Exchange
    hashpartitioning(article_id) -> sanitise rows -> href/src/srcset rewrite (broadcast joins to
    the dims) -> windows: online link, geo, rule passes -> stage cut -> maps, autonumber, math -> stage cut -> header ->
    ordered collect_list per article -> output assembly

Every window shares ``partitionBy(article_id).orderBy(pos)``; inserted rows come from
``explode``, so nothing but the cuts (``nodes.stage_cut``) re-shuffles.  A single article is the unit of skew: its node rows
live in one task, bounded by the article's size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import clean as C
from ..operators import extract as X
from ..operators import links as L
from ..operators import nodes as N
from ..sources.siteinfo import Dims

# What the output document starts with (style sheets, and the formula
# renderer when the article has math).
CSS_LINKS = (
    '<link rel="stylesheet" href="~/css/shared.css" type="text/css">'
    '<link rel="stylesheet" href="~/css/mediawiki_shared.css" type="text/css">'
    '<link rel="stylesheet" href="~/css/mediawiki_monobook.css" type="text/css">'
    '<link rel="alternate stylesheet" href="~/css/night.css" type="text/css" title="Night">'
)
MATH_SCRIPTS = (
    '<script type="importmap">\n{"imports":{"mathjax/":"./~/MathJax/"}}</script>\n'
    '<script type="module" src="./~/MathJax/MediaWiki.js"></script>'
)
# Names of the charsets that the output encoder accepts, and the encoder's name for them (others are refused when
# the plan is built), and the characters that the small ones lack.
CHARSETS = {"utf-8": "utf-8", "utf8": "utf-8", "iso-8859-1": "iso-8859-1", "latin1": "iso-8859-1", "latin-1": "iso-8859-1", "us-ascii": "us-ascii",
            "ascii": "us-ascii", "utf-16": "utf-16", "utf-16be": "utf-16be", "utf-16le": "utf-16le", "utf-32": "utf-32"}
BEYOND = {"iso-8859-1": r"[^\x00-\xFF]", "us-ascii": r"[^\x00-\x7F]"}


@dataclass
class ConvertOptions:
    rules: list[str] = field(default_factory=list)
    remove_embedded_bg: str = ""
    ensure_ext_image_urls: bool = False
    html_encoding: str = "utf-8"
    no_math: bool = False


def prepare(articles: DataFrame) -> DataFrame:
    """Newline collapse (SCL-11) and the columns the tokenizer carries."""
    cols = articles.columns
    ap = F.col("articlepath") if "articlepath" in cols else F.lit(None).cast("string")
    aliases = F.col("aliases") if "aliases" in cols else F.array().cast("array<struct<key:string,fragment:string>>")
    return articles.select(
        F.col("article_id").cast("long").alias("article_id"),
        F.regexp_replace(F.col("text"), r"\n{2,}", "\n").alias("text"),
        F.col("title").alias("__title"),
        ap.alias("__ap"),
        F.col("text").isNotNull().alias("__has_text"),
        aliases.alias("__aliases"),
    )


def rewrite_node_links(nodes: DataFrame, dims: Dims, opts: ConvertOptions) -> DataFrame:
    """DOC-7 / DOC-8 before the exchange: the new href, src (self-links by title) and srcset in columns beside the
    attributes, which keep the raw values until the rules have seen them (``swap_links``)."""
    params = L.LinkParams(dims.site.server, F.coalesce(F.col("__ap"), F.lit(dims.site.articlepath)),
                          dims.site.articlepath, opts.ensure_ext_image_urls)
    a = F.col("attrs")
    is_open = F.col("kind") == "open"
    nodes = nodes.withColumn("__href", F.when(is_open, a["href"])).withColumn("__src", F.when(is_open, a["src"]))
    nodes = L.rewrite_urls(nodes, "__href", "__href2", dims, params, title_col="__title")
    nodes = L.rewrite_urls(nodes, "__src", "__src2", dims, params, title_col="__title")
    srcset = F.when(F.col("__src").isNotNull() & (F.coalesce(a["srcset"], F.lit("")) != ""), a["srcset"])
    nodes = nodes.withColumn("__srcset", srcset)
    nodes = L.rewrite_srcset(nodes, "__srcset", "__srcset2", dims, params)
    return nodes.drop("__href", "__src", "__srcset")


def swap_links(nodes: DataFrame) -> DataFrame:
    """The rewritten links take the place of the raw ones."""
    a = F.col("attrs")
    new_attrs = F.transform_values(a, lambda k, v: F.when(k == "href", F.coalesce(F.col("__href2"), v))
                                   .when(k == "src", F.coalesce(F.col("__src2"), v))
                                   .when(k == "srcset", F.coalesce(F.col("__srcset2"), v)).otherwise(v))
    return nodes.withColumn("attrs", F.when(F.col("kind") == "open", new_attrs).otherwise(a)).drop("__href2", "__src2", "__srcset2")


def clean_nodes(articles: DataFrame, dims: Dims, opts: ConvertOptions, header: bool = True) -> DataFrame:
    """Tokenize and run DOC-2..DOC-15 in the reference's order; returns the final node rows."""
    if opts.html_encoding.lower() not in CHARSETS:
        raise ValueError(f"unsupported html encoding: {opts.html_encoding}")
    prep = prepare(articles)
    partitions = N.task_partitions(prep)
    nodes = N.tokenize(prep, "text", carry=["__title", "__ap", "__has_text", "__aliases"], keep_tags=C.KEPT_TAGS, grouped=True, partitions=partitions)
    nodes = C.sanitise_rows(nodes)
    nodes = rewrite_node_links(nodes, dims, opts)
    doc = F.col("kind") == "doc"
    for c in ("__title", "__ap", "__aliases"):
        nodes = nodes.withColumn(c, F.when(doc, F.col(c)))
    # ---- after this point every step is a window over the article
    nodes = X.capture_online_link(nodes)
    nodes = C.geo_links(nodes)
    nodes = C.apply_rules(nodes, list(opts.rules), first_pass_hit=C.kill_hit() | F.coalesce(F.col("__geo_drop"), F.lit(False)))
    nodes = nodes.drop("__geo_drop", "__geo_fmt", "__geo_lat", "__geo_lon")
    nodes = N.stage_cut(C.unwrap_rules(nodes), partitions)
    nodes = C.strip_background(nodes, opts.remove_embedded_bg)
    nodes = swap_links(nodes)
    nodes = C.convert_maps(nodes)
    nodes = N.drop_subtrees(nodes, F.col("__map_drop")).drop("__map", "__map_drop")
    nodes = C.autonumber(nodes)
    nodes = C.math_tex(nodes)
    nodes = C.strip_attributes(nodes)
    nodes = C.math_images(nodes)
    if header:
        nodes = N.by_article(nodes, partitions)  # back to their number: a stage of its own too
        whole = Window.partitionBy("article_id")
        ap_article = F.coalesce(F.max(F.col("__ap")).over(whole), F.lit(dims.site.articlepath))
        nodes = X.article_header(nodes, dims.site.server, ap_article, dims.site.articlepath)
    nodes = C.drop_link_elements(nodes)
    return nodes


def convert_articles(articles: DataFrame, dims: Dims, opts: ConvertOptions | None = None,
                     header: bool = True) -> DataFrame:
    """DOC-17 + SCL-16 + PRJ-4: converted content and per-article status.

    status: F = the article could not be tokenized or encoded (error kept separately from its text,
    decision Q8); E = no text or empty content; S = converted.
    """
    opts = opts or ConvertOptions()
    nodes = clean_nodes(articles, dims, opts, header)
    doc = F.col("kind") == "doc"
    body = N.serialise(nodes, wrap_tag="div", extra_aggs=[
        F.max(F.when(doc, F.col("__title"))).alias("title"),
        F.first(F.when(doc, F.col("__aliases")), ignorenulls=True).alias("aliases"),
        F.max(F.when(doc, F.col("__has_text"))).alias("has_text"),
        F.max(F.col("__has_math")).alias("has_math"),
        F.max(F.when(F.col("kind") == "error", F.col("text"))).alias("error"),
    ])
    html = U.wrap_rtl(F.col("html"), F.lit(dims.site.rtl))
    math = F.when(F.coalesce(F.col("has_math"), F.lit(False)) & F.lit(not opts.no_math), F.lit(MATH_SCRIPTS)).otherwise(F.lit(""))
    charset = CHARSETS[opts.html_encoding.lower()]
    whole = F.concat(F.lit(CSS_LINKS), math, html)
    beyond = whole.rlike(BEYOND[charset]) if charset in BEYOND else F.lit(False)
    error = F.coalesce(F.col("error"), F.when(beyond, F.lit(f"a character beyond {charset}")))
    content = F.encode(F.when(error.isNull(), whole), charset)
    out = body.select(
        "article_id", "title", "aliases", F.coalesce("has_math", F.lit(False)).alias("has_math"), error.alias("error"),
        F.when(F.col("has_text"), content).alias("content"),
    )
    status = F.when(F.col("error").isNotNull(), F.lit("F")) \
        .when(F.col("content").isNull() | (F.octet_length("content") == 0), F.lit("E")).otherwise(F.lit("S"))
    return out.withColumn("n_bytes", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")).withColumn("status", status)
