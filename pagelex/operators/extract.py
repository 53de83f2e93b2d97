"""Article header + table of contents (DOC-14, EXT-2, WIN-4, AGG-6) and extraction tables
(EXT-2..EXT-7).

The table of contents is built as *pieces* of the serialised output with their own order
keys, so it never needs a join or a second exchange: heading rows and their text rows
emit copies into the header region (``okey = (anchor, 1, pos)``) next to the article body.
Nesting follows the nearest preceding heading one level up (survey decision Q9); an h3
needs a listed h2 before it, an h4 a listed h3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import nodes as N
from .clean import classes, first_text, is_open
from ..functions import urls as U

BIG = 1 << 60
def whole() -> Window:
    return Window.partitionBy("article_id")


def _key(a: Column, b: int | Column, c: Column) -> Column:
    return F.struct(a.cast("long").alias("a"), F.lit(b).cast("long").alias("b") if isinstance(b, int) else b.cast("long").alias("b"),
                    c.cast("long").alias("c"))


def capture_online_link(nodes: DataFrame) -> DataFrame:
    """``__online``: href of the first ``link[rel="dc:isVersionOf"]``, taken before the head
    is dropped (decision Q10)."""
    is_link = is_open() & (F.col("tag") == "link") & (F.col("attrs")["rel"] == "dc:isVersionOf") \
        & F.map_contains_key("attrs", "href")
    href = F.col("attrs")["href"]
    if "__href2" in nodes.columns:
        href = F.coalesce(F.col("__href2"), href)
    first = F.min(F.when(is_link, F.struct(F.col("pos").alias("p"), href.alias("h")))).over(whole())
    return nodes.withColumn("__online", first["h"])


def heading_levels(nodes: DataFrame) -> DataFrame:
    """``__level`` (2..4) and ``__listed`` for headings; ``__hparent`` = the listed heading one
    level up that the entry nests under (WIN-4)."""
    tag = F.col("tag")
    level = F.when(is_open() & tag.isin("h2", "h3", "h4"), F.substring(tag, 2, 1).cast("int"))
    has_id = F.coalesce(F.col("attrs")["id"], F.lit("")) != ""
    before = N.article_window().rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("__level", level)
    # h2: listed when it has an id
    nodes = nodes.withColumn("__l2", F.when(F.col("__level") == 2, has_id))
    last_h2 = F.last(F.when(F.col("__level") == 2, F.struct(F.col("pos").alias("p"), F.col("__l2").alias("ok"))),
                     ignorenulls=True).over(before)
    nodes = nodes.withColumn("__h3p", F.when(F.col("__level") == 3, last_h2))
    nodes = nodes.withColumn("__l3", F.when(F.col("__level") == 3, has_id & F.coalesce(F.col("__h3p.ok"), F.lit(False))))
    last_h23 = F.last(F.when(F.col("__level").isin(2, 3), F.struct(
        F.col("pos").alias("p"), F.col("__level").alias("lv"), F.coalesce(F.col("__l2"), F.col("__l3")).alias("ok"))),
        ignorenulls=True).over(before)
    nodes = nodes.withColumn("__h4p", F.when(F.col("__level") == 4, last_h23))
    l4 = has_id & (F.col("__h4p.lv") == 3) & F.coalesce(F.col("__h4p.ok"), F.lit(False))
    nodes = nodes.withColumn("__listed", F.coalesce(F.col("__l2"), F.col("__l3"), F.when(F.col("__level") == 4, l4), F.lit(False)))
    nodes = nodes.withColumn("__hparent", F.when(F.col("__level") == 3, F.col("__h3p.p")).when(F.col("__level") == 4, F.col("__h4p.p")))
    return nodes.drop("__l2", "__h3p", "__l3", "__h4p")


def _drop_empty_heading_spans(nodes: DataFrame, generated: Column) -> DataFrame:
    """``span:empty`` inside headings is removed where the contents are generated."""
    w = N.article_window()
    nxt = F.lead("pos").over(w)
    nodes = nodes.withColumn("__e", is_open() & (F.col("tag") == "span") & (nxt.isNull() | (nxt > F.col("close_pos"))))
    in_h = N.has_enclosing(is_open() & F.col("tag").isin("h2", "h3", "h4"))
    nodes = nodes.withColumn("__inh", in_h)
    return nodes.where(~(F.col("__e") & F.col("__inh") & F.coalesce(generated, F.lit(False)))).drop("__e", "__inh")


def article_header(nodes: DataFrame, server, articlepath, site_articlepath) -> DataFrame:
    """DOC-14: header with the online link and the contents, first in the body.

    Needs ``__online`` (``capture_online_link``) and the carried ``__title`` on the doc row.
    The existing ``#toc`` element (with element children) is moved into the header;
    otherwise a list of headings is generated.  Done only when an online link exists or the
    server and article path are set.  Adds ``okey`` / ``ckey`` order keys for ``serialise``.
    """
    srv = F.coalesce(U.col_or_lit(server), F.lit(""))
    ap = F.coalesce(U.col_or_lit(articlepath), F.lit(""))
    sap = F.coalesce(U.col_or_lit(site_articlepath), F.lit(""))
    title = F.max(F.when(F.col("kind") == "doc", F.col("__title"))).over(whole())
    nodes = nodes.withColumn("__t", title)
    applies = F.col("__online").isNotNull() | ((srv != "") & (ap != ""))
    url = F.coalesce(F.col("__online"), F.concat(srv, sap, U.quote_path(F.coalesce(F.col("__t"), F.lit("")))))
    body = F.min(F.when(is_open() & (F.col("tag") == "body"), F.col("pos"))).over(whole())
    toc = F.min(F.when(is_open() & (F.col("attrs")["id"] == "toc"), F.struct(F.col("pos").alias("p"), F.col("close_pos").alias("c")))).over(whole())
    nodes = nodes.withColumn("__applies", applies).withColumn("__anchor", F.coalesce(body, F.lit(-1))).withColumn("__toc", toc)
    in_toc = (F.col("pos") > F.col("__toc.p")) & (F.col("pos") <= F.col("__toc.c"))
    nodes = nodes.withColumn("__toc_kids", F.max(F.when(is_open() & in_toc, 1).otherwise(0)).over(whole()) == 1)
    moved_toc = F.col("__applies") & F.col("__toc").isNotNull() & F.col("__toc_kids")
    gen = F.col("__applies") & F.col("__toc").isNull()

    # generated contents: only when needed
    nodes = _drop_empty_heading_spans(nodes, gen)
    nodes = heading_levels(nodes)
    listed = is_open() & F.col("__listed")
    before = N.article_window().rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("__prev_lv", F.last(F.when(listed, F.col("__level")), ignorenulls=True).over(before))
    nodes = nodes.withColumn("__last_listed", F.max(F.when(listed, F.col("pos"))).over(whole()))
    nodes = nodes.withColumn("__in_h", N.enclosing(listed, F.col("pos")))
    nodes = nodes.withColumn("__any_listed", F.col("__last_listed").isNotNull())

    # moved #toc: its rows take keys in the header region
    anchor = F.col("__anchor")
    in_moved = moved_toc & (F.col("pos") >= F.col("__toc.p")) & (F.col("pos") <= F.col("__toc.c"))
    own = lambda key, at: F.coalesce(F.col(key), _key(F.col(at), 0, F.lit(0))) if key in nodes.columns else _key(F.col(at), 0, F.lit(0))
    keys = {k: F.when(in_moved, _key(anchor, 1, F.col(at))).otherwise(own(k, at)) for k, at in (("okey", "pos"), ("ckey", "close_pos"))}
    nodes = nodes.withColumns(keys)

    lv, pv = F.col("__level"), F.col("__prev_lv")
    close_levels = F.concat(F.lit("</li>"), F.repeat(F.lit("</ol></li>"), F.greatest(pv - lv, F.lit(0))))
    trans = F.when(pv.isNull(), F.lit("")).when(lv > pv, F.lit("<ol>")).when(lv == pv, F.lit("</li>")).otherwise(close_levels)

    def piece(c: Column, html: Column) -> Column:
        return N.new_node(nodes, pos=F.col("pos"), kind="html", text=html, okey=_key(anchor, 1, c))

    open_item = F.concat(trans, F.lit('<li><a href="#'), N.escape_attr(F.col("attrs")["id"]), F.lit('">'))
    tail = F.concat(F.lit("</li>"), F.repeat(F.lit("</ol></li>"), F.greatest(lv - F.lit(2), F.lit(0))))
    heading_pieces = F.array(
        piece(F.col("pos"), open_item),
        piece(F.col("close_pos"), F.lit("</a>")),
    )
    heading_pieces = F.when(F.col("pos") == F.col("__last_listed"),
                            F.concat(heading_pieces, F.array(piece(F.lit(BIG - 2), tail)))).otherwise(heading_pieces)
    text_piece = F.array(piece(F.col("pos"), N.escape_text(F.col("text"))))
    prefix = F.concat(
        F.lit('<details id="a2-article-header"><summary><span id="a2-toc-spacer"></span><span id="a2-title">'
              '<a id="view-online-link" href="'), N.escape_attr(url), F.lit('">'), N.escape_text(F.coalesce(F.col("__t"), F.lit(""))),
        F.lit("</a></span></summary>"))
    doc_pieces = F.array(piece(F.lit(-3), prefix), piece(F.lit(BIG), F.lit("</details>")))
    doc_pieces = F.when(gen & F.col("__any_listed"), F.concat(doc_pieces, F.array(
        piece(F.lit(-2), F.lit('<div id="a2-toc"><ol class="toc">')),
        piece(F.lit(BIG - 1), F.lit("</ol></div>"))))).otherwise(doc_pieces)
    ins = (
        F.when(~F.col("__applies"), F.lit(None))
        .when(F.col("kind") == "doc", doc_pieces)
        .when(gen & listed, heading_pieces)
        .when(gen & (F.col("kind") == "text") & F.col("__in_h").isNotNull(), text_piece)
    )
    helper = ["__t", "__applies", "__anchor", "__toc", "__toc_kids", "__prev_lv", "__last_listed", "__in_h",
              "__any_listed", "__level", "__listed", "__hparent"]
    out = N.with_inserts(nodes, ins).drop(*helper)
    # inserted pieces have no ckey
    return out


# --------------------------------------------------------------------------- EXT tables


def headings(nodes: DataFrame) -> DataFrame:
    """EXT-2: headings(article_id, pos, level, id, text, parent_pos, listed) for h2..h4 with an id;
    ``parent_pos`` is the listed heading one level up (NULL for h2 and for unlisted ones).

    One ``groupBy(article_id, heading)`` over the heading rows and the text rows inside them
    (headings never nest), on the article partitioning: no join back, no second pass over
    the node table. No other row says anything about headings, so the windows don't see any.
    """
    nodes = heading_levels(nodes.where((is_open() & F.col("tag").isin("h2", "h3", "h4")) | (F.col("kind") == "text")))
    is_h = is_open() & F.col("__level").isNotNull()
    nodes = nodes.withColumn("__in_h", N.enclosing(is_h, F.col("pos")))
    rows = nodes.where(F.col("__in_h").isNotNull() & (is_h | (F.col("kind") == "text")))
    out = rows.groupBy("article_id", F.col("__in_h").alias("pos")).agg(
        F.max(F.when(is_h, F.col("__level"))).alias("level"),
        F.max(F.when(is_h, F.col("attrs")["id"])).alias("id"),
        F.max(F.when(is_h & F.col("__listed") & (F.col("__level") > 2), F.col("__hparent"))).alias("parent_pos"),
        F.max(F.when(is_h, F.col("__listed"))).alias("listed"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == "text", F.struct("pos", "text"))))["text"], "").alias("text"))
    return out.where(F.coalesce(F.col("id"), F.lit("")) != "") \
        .select("article_id", "pos", "level", "id", "text", "parent_pos", "listed")


def toc_html(heads: DataFrame) -> DataFrame:
    """AGG-6: the generated contents list per article from ``headings`` (listed entries)."""
    lst = heads.where("listed")
    w = Window.partitionBy("article_id").orderBy("pos")
    lst = lst.withColumn("prev", F.lag("level").over(w)).withColumn("nxt", F.lead("level").over(w))
    lv, pv = F.col("level"), F.col("prev")
    trans = F.when(pv.isNull(), F.lit("")).when(lv > pv, F.lit("<ol>")).when(lv == pv, F.lit("</li>")) \
        .otherwise(F.concat(F.lit("</li>"), F.repeat(F.lit("</ol></li>"), pv - lv)))
    item = F.concat(trans, F.lit('<li><a href="#'), N.escape_attr(F.col("id")), F.lit('">'), N.escape_text(F.col("text")), F.lit("</a>"))
    item = F.when(F.col("nxt").isNull(), F.concat(item, F.lit("</li>"), F.repeat(F.lit("</ol></li>"), lv - 2))).otherwise(item)
    return lst.groupBy("article_id").agg(F.concat(
        F.lit('<div id="a2-toc"><ol class="toc">'),
        F.array_join(F.sort_array(F.collect_list(F.struct("pos", item.alias("s"))))["s"], ""),
        F.lit("</ol></div>")).alias("toc_html"))


def coordinates(nodes_with_geo: DataFrame) -> DataFrame:
    """EXT-3: coordinates(article_id, pos, lat, lon, format, href) from ``clean.geo_links`` output."""
    return nodes_with_geo.where(F.col("__geo_fmt").isNotNull() & (F.col("kind") == "open")).select(
        "article_id", "pos", U.strip_ws(F.col("__geo_lat")).alias("lat"), U.strip_ws(F.col("__geo_lon")).alias("lon"),
        F.col("__geo_fmt").alias("format"),
        F.concat(F.lit("geo:"), U.strip_ws(F.col("__geo_lat")), F.lit(","), U.strip_ws(F.col("__geo_lon"))).alias("href"))


def maps(nodes_with_maps: DataFrame) -> DataFrame:
    """EXT-4: maps(article_id, pos, lat, lon, zoom, xtile, ytile, tile_url, map_url)."""
    return nodes_with_maps.where(F.col("__map").isNotNull()).select("article_id", "pos", "__map.*")


def formulas(nodes: DataFrame) -> DataFrame:
    """EXT-5: formulas(article_id, pos, tex, display, source).

    TeX comes from ``data-tex`` of ``span.mwe-math-element`` or from ``alt`` of a legacy math
    image; display = the element is the only meaningful child of its parent (other
    children are whitespace-only text). Parents are those of the tree as it is now, after red links and the like
    were unwrapped.
    """
    nodes = N.rebuild_parents(nodes)
    a = F.col("attrs")
    span = is_open() & (F.col("tag") == "span") & F.array_contains(classes(), "mwe-math-element") & F.map_contains_key(a, "data-tex")
    legacy = is_open() & (F.col("tag") == "img") & (F.array_contains(classes(), "tex") | F.array_contains(
        classes(), "mwe-math-fallback-image-inline")) & F.map_contains_key(a, "alt")
    meaningful = is_open() | ((F.col("kind") == "text") & (F.trim(F.regexp_replace("text", r"\s", " ")) != ""))
    sib = Window.partitionBy("article_id", "parent_pos")
    with_n = nodes.withColumn("__n", F.sum(F.when(meaningful, 1).otherwise(0)).over(sib))
    return with_n.where(span | legacy).select(
        "article_id", "pos",
        F.when(span, a["data-tex"]).otherwise(a["alt"]).alias("tex"),
        (F.col("__n") == 1).alias("display"),
        F.when(span, F.lit("data-tex")).otherwise(F.lit("alt")).alias("source"))


def images(nodes: DataFrame) -> DataFrame:
    """EXT-6: images(article_id, pos, url, srcset_candidates, requested_width, standard_width)."""
    a = F.col("attrs")
    img = is_open() & F.map_contains_key(a, "src")
    path = U.split_url(a["src"])["path"]
    req = U.thumb_requested_width(path)
    return nodes.where(img).select(
        "article_id", "pos", a["src"].alias("url"),
        F.when(F.coalesce(a["srcset"], F.lit("")) != "", F.transform(F.split(a["srcset"], ", "), lambda c: F.substring_index(U.strip_ws(c), " ", 1))).alias("srcset_candidates"),
        req.alias("requested_width"),
        F.when(req.isNotNull(), U.round_up_thumb_width(req)).alias("standard_width"))


def aliases(articles: DataFrame, origin_col: str | None = None) -> DataFrame:
    """EXT-7: aliases(title, alias, fragment, origin) from the article table's alias array."""
    origin = F.col(origin_col) if origin_col else F.lit("alias")
    return articles.select("title", origin.alias("origin"), F.explode("aliases").alias("a")).select(
        "title", F.col("a.key").alias("alias"), F.col("a.fragment").alias("fragment"), "origin")
