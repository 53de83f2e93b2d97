"""Document clean-up jobs on the node table (DOC-2..13, DOC-15, AGG-4, WIN-1, WIN-3).

Each job is ``nodes -> nodes``.  Row-local ones (attribute edits, unwrapping, comment
removal) run before the ``article_id`` exchange; subtree drops are one running-max window
per pass; insertions are ``explode``s that keep the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import nodes as N
from . import selectors as S
from ..functions import geo as G
from ..functions import urls as U

# ---------------------------------------------------------------------------
# The sanitiser configuration of the reference's HTML cleaner
# (comments, scripts, javascript, meta, processing instructions, embedded objects,
# page structure, forms, frames, annoying and unknown tags removed; style and link kept).
KILL_TAGS = ("script", "meta", "applet", "frameset", "frame", "noframes", "button", "input",
             "select", "textarea")
UNWRAP_TAGS = ("html", "title", "iframe", "embed", "layer", "object", "param", "blink", "marquee", "form")
# Tags the cleaner knows; any other tag is unwrapped (its children stay).
KNOWN_TAGS = (
    "html", "head", "body", "frameset", "base", "isindex", "link", "meta", "script", "style",
    "title", "address", "blockquote", "center", "del", "div", "h1", "h2", "h3", "h4", "h5",
    "h6", "hr", "ins", "noscript", "p", "pre", "dir", "dl", "dt", "dd", "li", "menu", "ol",
    "ul", "table", "caption", "colgroup", "col", "thead", "tfoot", "tbody", "tr", "td", "th",
    "form", "button", "fieldset", "legend", "input", "label", "select", "optgroup", "option",
    "textarea", "a", "applet", "basefont", "bdo", "br", "embed", "font", "iframe", "img",
    "map", "area", "object", "param", "q", "span", "sub", "sup", "abbr", "acronym", "cite",
    "code", "dfn", "em", "kbd", "samp", "strong", "var", "b", "big", "i", "s", "small",
    "strike", "tt", "u", "blink", "marquee", "article", "aside", "audio", "canvas", "command",
    "datalist", "details", "figcaption", "figure", "footer", "header", "hgroup", "keygen",
    "mark", "math", "meter", "nav", "output", "progress", "rp", "rt", "ruby", "section",
    "source", "summary", "svg", "time", "track", "video", "wbr", "frame", "noframes",
)
# Attributes holding links, blanked when they carry a script scheme.
LINK_ATTRS = ("action", "archive", "background", "cite", "classid", "codebase", "data", "href",
              "longdesc", "profile", "src", "usemap", "dynsrc", "lowsrc")
SCRIPT_SCHEME_RE = r"^(?i)(javascript|jscript|livescript|vbscript|data|about|mocha):"
SAFE_IMAGE_DATA_RE = r"^(?i)data:image/.+;base64"
# Page head parts dropped with their content:
HEAD_TAGS = ("head", "base")
# Elements unwrapped after the rules (red links and IPA links):
UNWRAP_RULES = ("a.new", "span.IPA>a")
# Math markup (modern span with TeX in data-mw, legacy images and fallbacks):
MATH_SELECTORS = (
    "span.mwe-math-element", "img.tex", ".mwe-math-fallback-png-display",
    ".mwe-math-fallback-image-inline", ".mwe-math-fallback-png-inline",
    ".mwe-math-fallback-source-display", ".mwe-math-fallback-source-inline", "strong.texerror",
)
GEO_ICON_CLASS = "a2-geo-link-icon"
GEO_ICON_SRC = "~/images/Globe.svg"
MAP_CLASS = "mw-kartographer-map"
MAP_ATTRS_REQUIRED = ("data-overlays", "data-style", "data-height", "data-width")
# ---------------------------------------------------------------------------

# Tags that keep a row of their own when a document is tokenized for conversion.
KEPT_TAGS = frozenset(KNOWN_TAGS) - frozenset(UNWRAP_TAGS)


def is_open() -> Column:
    return F.col("kind") == "open"


def classes(attrs: Column | None = None) -> Column:
    a = F.col("attrs") if attrs is None else attrs
    return F.split(F.trim(F.coalesce(a["class"], F.lit(""))), r"\s+")


def has_class(name: str) -> Column:
    return is_open() & F.array_contains(classes(), name)


def sel(text: str) -> Column:
    """Row-local Column for a simple selector list (no descendant steps)."""
    pred = S.row_local_pred(S.parse_rules([text]))
    if pred is None:
        raise S.SelectorError(f"selector needs windows: {text!r}")
    return pred


def first_text() -> Column:
    """The element's own leading text (``.text``): the next row, when it is a text child."""
    w = N.article_window()
    return F.when(is_open() & (F.lead("kind").over(w) == "text") & (F.lead("pos").over(w) < F.col("close_pos")),
                  F.lead("text").over(w))


def set_attr(attrs: Column, key: str, value: Column) -> Column:
    """attrs with key set to value (kept in place if present, else appended)."""
    return F.when(F.map_contains_key(attrs, key), F.transform_values(attrs, lambda k, v: F.when(k == key, value).otherwise(v))) \
        .otherwise(F.map_concat(attrs, F.create_map(F.lit(key), value)))


def drop_attrs(attrs: Column, keys: tuple[str, ...]) -> Column:
    return F.map_filter(attrs, lambda k, v: ~k.isin(*keys))


# --------------------------------------------------------------------------- DOC-2 sanitise


def sanitise_rows(nodes: DataFrame) -> DataFrame:
    """DOC-2, row-local part: comments/doctype/PI out, unknown and page-structure tags
    unwrapped, ``on*`` attributes removed, script-scheme links blanked."""
    kind, tag = F.col("kind"), F.col("tag")
    unwrap = is_open() & (tag.isin(*UNWRAP_TAGS) | ~tag.isin(*KNOWN_TAGS))
    keep = kind.isin("doc", "text", "open", "error") & ~unwrap

    def scrub(k, v):
        flat = F.regexp_replace(F.coalesce(F.try_url_decode(v), v), r"[\s\x00-\x19]+", "")
        bad = F.lower(k).isin(*LINK_ATTRS) & flat.rlike(SCRIPT_SCHEME_RE) & ~flat.rlike(SAFE_IMAGE_DATA_RE)
        return F.when(bad, F.lit("")).otherwise(v)

    attrs = F.transform_values(F.map_filter("attrs", lambda k, v: ~F.startswith(F.lower(k), F.lit("on"))), scrub)
    return nodes.where(keep).withColumn("attrs", F.when(is_open(), attrs).otherwise(F.col("attrs")))


def kill_hit() -> Column:
    """DOC-2 (killed elements) and DOC-4 (head, base): dropped with their subtree."""
    return is_open() & F.col("tag").isin(*(KILL_TAGS + HEAD_TAGS))


# --------------------------------------------------------------------------- DOC-12 geo


def geo_links(nodes: DataFrame) -> DataFrame:
    """DOC-12: the three coordinate microformats become ``geo:`` links.

    (a) ``.geo-nondefault`` containing ``.geo`` "lat;lon": link after its parent, element dropped;
    (b) ``.geo`` with ``.latitude`` and ``.longitude``: link after it, element dropped;
    (c) ``.geo-geo-dms`` containing ``.geo`` "lat;lon": link after its parent, ``.geo-dec`` dropped.

    Adds ``__geo_drop`` (subtree drop flag for the next pass) and the inserted link rows;
    also ``__geo_lat`` / ``__geo_lon`` / ``__geo_fmt`` on the rows that produced a link (EXT-3).
    """
    key = "struct<a:bigint,b:bigint,c:bigint>"
    for c in ("okey", "ckey"):
        if c not in nodes.columns:
            nodes = nodes.withColumn(c, F.lit(None).cast(key))
    is_gnd, is_geo, is_dms, is_dec = has_class("geo-nondefault"), has_class("geo"), has_class("geo-geo-dms"), has_class("geo-dec")
    nodes = nodes.withColumns({
        "__ftext": first_text(), "__in_gnd": N.enclosing(is_gnd, F.col("pclose")), "__in_dms": N.enclosing(is_dms, F.col("pclose")),
        "__geo_of": N.enclosing(is_geo, F.col("pos")),
    })
    # the first .latitude and .longitude anywhere inside a .geo (the article's partitioning serves this window too)
    inside = Window.partitionBy("article_id", "__geo_of").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda name: F.first(F.when(has_class(name), F.col("__ftext")), ignorenulls=True).over(inside)
    nodes = nodes.withColumns({"__b_lat": first("latitude"), "__b_lon": first("longitude")})
    semi = F.contains(F.coalesce(F.col("__ftext"), F.lit("")), F.lit(";"))
    # (a) and (c): .geo with "lat;lon" text inside the container; (b): with .latitude and .longitude
    fmt_a = is_geo & F.col("__in_gnd").isNotNull() & semi
    fmt_b = is_geo & F.col("__in_gnd").isNull() & F.col("__b_lat").isNotNull() & F.col("__b_lon").isNotNull()
    fmt_c = is_geo & F.col("__in_gnd").isNull() & F.col("__in_dms").isNotNull() & semi
    nodes = nodes.withColumn("__geo_fmt", F.when(fmt_a, "nondefault").when(fmt_b, "microformat").when(fmt_c, "dms"))
    pair = F.split(F.col("__ftext"), ";", 2)
    micro = F.col("__geo_fmt") == "microformat"
    anchor = F.when(F.col("__geo_fmt") == "nondefault", F.col("__in_gnd")).when(F.col("__geo_fmt") == "dms", F.col("__in_dms")).when(micro, F.col("close_pos"))
    nodes = nodes.withColumns({
        "__geo_lat": F.when(micro, F.col("__b_lat")).when(F.col("__geo_fmt").isNotNull(), pair.getItem(0)),
        "__geo_lon": F.when(micro, F.col("__b_lon")).when(F.col("__geo_fmt").isNotNull(), pair.getItem(1)),
        "__geo_drop": is_gnd | (is_dec & F.col("__in_dms").isNotNull()) | F.coalesce(micro, F.lit(False)),
        "__anchor": anchor,
    }).drop("__ftext", "__in_gnd", "__in_dms", "__b_lat", "__b_lon", "__geo_of")
    href = F.concat(F.lit("geo:"), U.strip_ws(F.col("__geo_lat")), F.lit(","), U.strip_ws(F.col("__geo_lon")))
    nodes = nodes.withColumn("__ghref", href)
    # links stand right behind the anchor's end; of several, the later one first, as if each were put next to the anchor
    at = F.col("__anchor") + 1
    place = lambda k: F.struct(F.col("__anchor").alias("a"), F.lit(1).cast("long").alias("b"), (k - 4 * F.col("pos")).alias("c"))
    link_a = N.new_node(nodes, pos=at, kind="open", tag="a", attrs=F.create_map(F.lit("href"), F.col("__ghref")), close_pos=at,
                        parent_pos=F.lit(-1), depth=F.col("depth"), raw=F.lit(False), pclose=F.lit(-1), okey=place(0), ckey=place(2))
    # the icon's src goes through the link rewrite like every src (it is a relative path)
    link_img = N.new_node(nodes, pos=at, kind="open", tag="img",
                          attrs=F.create_map(F.lit("class"), F.lit(GEO_ICON_CLASS), F.lit("src"),
                                             U.encode_article_path(F.lit(GEO_ICON_SRC))),
                          close_pos=at, parent_pos=at, depth=F.col("depth") + 1, ptag=F.lit("a"), raw=F.lit(False), pclose=at, okey=place(1))
    ins = F.when(F.col("__geo_fmt").isNotNull(), F.array(link_a, link_img))
    return N.with_inserts(nodes, ins).drop("__anchor", "__ghref")


# --------------------------------------------------------------------------- DOC-3 rules


def apply_rules(nodes: DataFrame, rules: list[str], first_pass_hit: Column | None = None) -> DataFrame:
    """DOC-3: drop every element matching a rule, with its subtree, in reference order.

    ``first_pass_hit`` (kill list, head, geo drops) joins the first pass: it does not
    depend on the tree state.
    """
    passes = S.plan_passes(S.parse_groups(rules)) or [[]]
    if first_pass_hit is not None and any(s.structural for s in passes[0]):
        passes.insert(0, [])  # a structural rule sees the tree without what these drop
    for i, group in enumerate(passes):
        if group:
            nodes = S.hits(nodes, group, "__hit")
            hit = F.col("__hit")
        else:
            hit = F.lit(False)
        if i == 0 and first_pass_hit is not None:
            hit = hit | first_pass_hit
        nodes = N.drop_subtrees(nodes, hit)
        if "__hit" in nodes.columns:
            nodes = nodes.drop("__hit")
    return nodes


# --------------------------------------------------------------------------- DOC-5 / DOC-6


def unwrap_rules(nodes: DataFrame) -> DataFrame:
    """DOC-5: ``a.new`` and ``span.IPA>a`` lose their tag; children stay."""
    hit = sel(",".join(UNWRAP_RULES))
    return nodes.where(~hit)


# Pieces of a style, as regular expressions: a comment, an escaped character, a string that ends on its line, square brackets with
# these inside, parentheses with all of them inside (six deep), and any other character. Alternatives never overlap, so matching is linear.
_COMMENT = r"/\*(?:[^*]|\*(?!/))*+\*/"
_STRING = r'"(?:[^"\\\n]|\\.)*+"' + r"|'(?:[^'\\\n]|\\.)*+'"
_SIMPLE = r"""[^;"'\\()\[\]{}/]|/(?!\*)"""


def _style_piece(depth: int = 6) -> str:
    leaf = rf"{_COMMENT}|\\.|{_STRING}|{_SIMPLE}"
    nested = rf"|\[(?:{leaf}|;)*+\]"
    for _ in range(depth):
        nested = rf"|\[(?:{leaf}|;)*+\]|\((?:{leaf}|;{nested})*+\)"
    return f"(?:{leaf}{nested})"


STYLE_PIECE = _style_piece()


def style_declarations(style: Column) -> Column:
    """The declarations of a ``style`` attribute as (name, text) structs: split at semicolons outside strings, brackets, escapes and
    comments; comments go, blank declarations too, names are in lower case. Null for a malformed style: one with an open string, bracket
    or comment, a stray bracket or brace, or an escape at its end."""
    whole = style.rlike(rf"(?s)^(?:{STYLE_PIECE}|;)*+$")
    parts = F.regexp_extract_all(style, F.lit(rf"(?s)({STYLE_PIECE}++)"), F.lit(1))
    bare = F.transform(parts, lambda d: U.strip_ws(F.array_join(F.filter(F.regexp_extract_all(d, F.lit(rf"(?s)({STYLE_PIECE})"), F.lit(1)),
                                                                           lambda x: ~F.startswith(x, F.lit("/*"))), "")))
    name = lambda d: F.lower(U.strip_ws(F.substring_index(d, ":", 1)))
    value = lambda d: U.strip_ws(d.substr(F.length(F.substring_index(d, ":", 1)) + 2, F.length(d)))
    text = lambda d: F.when(F.contains(d, F.lit(":")), F.concat(name(d), F.lit(": "), value(d))).otherwise(d)
    return F.when(whole, F.transform(F.filter(bare, lambda d: d != ""), lambda d: F.struct(name(d).alias("name"), text(d).alias("text"))))


def strip_background(nodes: DataFrame, selector_list: str | None) -> DataFrame:
    """DOC-6: remove ``background`` / ``background-color`` declarations from ``style`` of the
    elements matching the comma-separated selector list; other declarations are kept as
    ``name: value`` joined by ``;\\n``.  Elements without ``style`` and malformed styles are left alone."""
    if not selector_list:
        return nodes
    selectors = S.parse_rules([selector_list])
    hit = S.row_local_pred(selectors)
    if hit is None:  # steps need windows
        nodes = S.hits(nodes, selectors, "__bg")
        hit = F.col("__bg")
    styled = hit & F.map_contains_key("attrs", "style")
    # behind a generator, which filters do not pass, so that a style is parsed once
    nodes = nodes.select("*", F.explode(F.array(F.when(styled, style_declarations(F.col("attrs")["style"])))).alias("__style"))
    kept = F.filter("__style", lambda d: ~d["name"].isin("background", "background-color"))
    new = set_attr(F.col("attrs"), "style", F.array_join(F.transform(kept, lambda d: d["text"]), ";\n"))
    return nodes.withColumn("attrs", F.when(F.col("__style").isNotNull(), new).otherwise(F.col("attrs"))).drop("__bg", "__style")


# --------------------------------------------------------------------------- DOC-13 maps


def convert_maps(nodes: DataFrame) -> DataFrame:
    """DOC-13: interactive map anchors become a static tile image with an OSM link.

    Needs data-lat/lon (numbers), data-zoom (integer) and data-overlays/style/height/width;
    any missing or bad one drops the anchor with its subtree (``__map_drop``).  Adds
    ``__map`` (struct lat, lon, zoom, xtile, ytile, tile_url, map_url) on converted anchors.
    """
    a = F.col("attrs")
    is_map = is_open() & (F.col("tag") == "a") & F.array_contains(classes(), MAP_CLASS)
    lat = a["data-lat"].try_cast("double")
    lon = a["data-lon"].try_cast("double")
    zoom = F.when(F.coalesce(a["data-zoom"], F.lit("")).rlike(r"^\s*[+-]?\d{1,4}\s*$"), F.trim(a["data-zoom"]).try_cast("int"))
    x, y = G.deg2num(lat, lon, zoom)
    ok = lat.isNotNull() & lon.isNotNull() & zoom.isNotNull() & x.isNotNull() & y.isNotNull()
    for k in MAP_ATTRS_REQUIRED:
        ok = ok & F.map_contains_key(a, k)
    tile = F.format_string("https://tile.openstreetmap.org/%d/%d/%d.png", zoom, x, y)
    murl = F.concat(F.lit("https://www.openstreetmap.org/#map="), zoom.cast("string"), F.lit("/"),
                    G.py_float_str(lat, a["data-lat"]), F.lit("/"), G.py_float_str(lon, a["data-lon"]))
    info = F.struct(lat.alias("lat"), lon.alias("lon"), zoom.alias("zoom"), x.alias("xtile"), y.alias("ytile"),
                    tile.alias("tile_url"), murl.alias("map_url"))
    nodes = nodes.withColumn("__map", F.when(is_map & ok, info)).withColumn("__map_drop", is_map & ~ok)
    new_attrs = F.map_concat(
        drop_attrs(a, ("data-lat", "data-lon", "data-zoom", "href", "target") + MAP_ATTRS_REQUIRED),
        F.create_map(F.lit("href"), F.col("__map.map_url"), F.lit("target"), F.lit("_blank")))
    nodes = nodes.withColumn("__in_map", N.enclosing(F.col("__map").isNotNull(), F.col("__map.tile_url")))
    img_attrs = set_attr(drop_attrs(a, ("srcset",)), "src", F.col("__in_map"))
    return nodes.withColumn(
        "attrs",
        F.when(F.col("__map").isNotNull(), new_attrs)
        .when(is_open() & (F.col("tag") == "img") & F.col("__in_map").isNotNull(), img_attrs)
        .otherwise(a),
    ).drop("__in_map")


# --------------------------------------------------------------------------- DOC-9


def autonumber(nodes: DataFrame) -> DataFrame:
    """DOC-9 / WIN-1: ``a.autonumber`` numbered from 1 in document order; those without
    their own leading text get ``[n]`` (all of them advance the counter)."""
    is_auto = is_open() & (F.col("tag") == "a") & F.array_contains(classes(), "autonumber")
    nodes = nodes.withColumn("__ft", first_text()) \
        .withColumn("__n", F.sum(F.when(is_auto, 1).otherwise(0)).over(N.running()))
    needs = is_auto & F.col("__ft").isNull()
    text_row = N.new_node(nodes, pos=F.col("pos") + 1, kind="text", text=F.format_string("[%d]", F.col("__n")),
                          close_pos=F.col("pos") + 1, parent_pos=F.col("pos"), depth=F.col("depth") + 1,
                          ptag=F.col("tag"), pclass=F.col("attrs")["class"], raw=F.lit(False), pclose=F.col("close_pos"))
    return N.with_inserts(nodes, F.when(needs, F.array(text_row))).drop("__ft", "__n")


# --------------------------------------------------------------------------- DOC-11 / DOC-10


def math_tex(nodes: DataFrame) -> DataFrame:
    """DOC-11 (first half): ``span.mwe-math-element`` gets ``data-tex`` from
    ``data-mw`` JSON ``body.extsrc`` (SCL-17); invalid or non-object JSON gives none."""
    a = F.col("attrs")
    is_span = is_open() & (F.col("tag") == "span") & F.array_contains(classes(), "mwe-math-element")
    tex = F.get_json_object(a["data-mw"], "$.body.extsrc")
    ok = is_span & (F.coalesce(tex, F.lit("")) != "")
    return nodes.withColumn("attrs", F.when(ok, set_attr(a, "data-tex", tex)).otherwise(a))


def strip_attributes(nodes: DataFrame) -> DataFrame:
    """DOC-10: drop data-mw (any), data-mw-section-id (section), id starting with 'mw',
    typeof, rel (anchors), about, title."""
    tag = F.col("tag")

    def keep(k, v):
        drop = (k == "data-mw") | ((k == "data-mw-section-id") & (tag == "section")) \
            | ((k == "id") & F.startswith(v, F.lit("mw"))) | (k == "typeof") \
            | ((k == "rel") & (tag == "a")) | (k == "about") | (k == "title")
        return ~drop

    return nodes.withColumn("attrs", F.when(is_open(), F.map_filter("attrs", keep)).otherwise(F.col("attrs")))


def math_images(nodes: DataFrame) -> DataFrame:
    """AGG-4 + DOC-11 (second half): per-article ``__has_math``; with math, fallback images
    inside a data-tex span lose src/srcset/alt, and legacy math images lose src/srcset."""
    math = sel(", ".join(MATH_SELECTORS))
    whole = Window.partitionBy("article_id")
    nodes = nodes.withColumn("__has_math", F.max(F.when(math, 1).otherwise(0)).over(whole) == 1)
    tex_span = is_open() & (F.col("tag") == "span") & F.array_contains(classes(), "mwe-math-element") \
        & F.map_contains_key("attrs", "data-tex")
    nodes = nodes.withColumn("__in_tex", F.coalesce(N.enclosing(tex_span, F.lit(True)), F.lit(False)))
    is_img = is_open() & (F.col("tag") == "img")
    fallback = is_img & F.contains(F.coalesce(F.col("attrs")["class"], F.lit("")), F.lit("mwe-math-fallback"))
    legacy = (is_img & F.array_contains(classes(), "tex")) | fallback
    a = F.col("attrs")
    return nodes.withColumn(
        "attrs",
        F.when(F.col("__has_math") & fallback & F.col("__in_tex"), drop_attrs(a, ("srcset", "src", "alt")))
        .when(F.col("__has_math") & legacy, drop_attrs(a, ("srcset", "src")))
        .otherwise(a),
    ).drop("__in_tex")


# --------------------------------------------------------------------------- DOC-15


def drop_link_elements(nodes: DataFrame) -> DataFrame:
    """DOC-15: ``link`` elements removed (void, so a row filter)."""
    return nodes.where(~(is_open() & (F.col("tag") == "link")))
