"""Link rewriting (SCL-6, SCL-7, JOIN-5, JOIN-6, JOIN-9) and the links table (EXT-1).

The decision list, first match wins:

1. URL has a host                 -> ``http`` default scheme; thumbnail width fixed on upload hosts   (absolute)
2. image path and external images -> server + article-path swap of the original URL                (image)
3. under the article path, prefix before ':' (percent-decoded) is a non-local namespace, server set
                                  -> server + article-path swap of the original URL                (namespace)
4. not under the article path, scheme is an interwiki prefix
                                  -> template with ``$1`` := path[?query], fragment kept            (interwiki)
5. any other scheme               -> the URL unchanged                                              (passthrough)
6. title set, fragment set, remaining path == title with '_' -> ``#fragment``                      (self)
7. otherwise                      -> remaining path with '/', ':', '_' encoded; query and fragment once (article)

Rows 1-4, 6, 7 are the reference's rules; row 5 and "query once" are the decisions Q15 / Q1
of the survey.  Dims (a site's configuration) are joined by broadcast, so the link
rows never shuffle.  ``srcset`` candidates are rewritten inside ``transform`` with the same
decision, looking the dims up in literal maps that are built only after a size check; above
the bound the candidates are exploded, joined and re-collected instead.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sources.siteinfo import Dims

KINDS = ("absolute", "image", "namespace", "interwiki", "passthrough", "self", "article")


@dataclass
class LinkParams:
    """Per-row or per-run rewrite parameters (each may be a Column or a literal)."""

    server: object
    articlepath: object
    site_articlepath: object
    ensure_ext_image_urls: object = False

    @classmethod
    def from_dims(cls, dims: Dims, articlepath=None, ensure_ext_image_urls=False) -> "LinkParams":
        site = dims.site
        ap = site.articlepath if articlepath is None else articlepath
        return cls(site.server, ap, site.articlepath, ensure_ext_image_urls)


def _decide(parts: Column, title: Column | None, ns_hit: Column, iw: Column, p: LinkParams) -> Column:
    """The kind of one URL given its split parts and the two dim probes."""
    ap = U.col_or_lit(p.articlepath)
    srv = F.coalesce(U.col_or_lit(p.server), F.lit(""))
    ext = U.col_or_lit(p.ensure_ext_image_urls)
    scheme, netloc, path, query, frag = (parts[k] for k in ("scheme", "netloc", "path", "query", "fragment"))
    path_q = F.concat(path, U.prefixed("?", query))
    under = ap.isNotNull() & F.startswith(path_q, ap)
    rest = F.when(under, path_q.substr(F.length(ap) + 1, F.greatest(F.length(path_q), F.lit(1)))).otherwise(path_q)
    is_self = F.lit(False) if title is None else (
        (F.coalesce(title, F.lit("")) != "") & (frag != "") & (F.replace(title, F.lit(" "), F.lit("_")) == rest)
    )
    return (
        F.when(netloc != "", F.lit("absolute"))
        .when(ext & U.is_image(path), F.lit("image"))
        .when(under & F.contains(rest, F.lit(":")) & F.coalesce(ns_hit, F.lit(False)) & (srv != ""), F.lit("namespace"))
        .when(iw.isNotNull(), F.lit("interwiki"))
        .when(scheme != "", F.lit("passthrough"))
        .when(is_self, F.lit("self"))
        .otherwise(F.lit("article"))
    )


def _probe_keys(parts: Column, p: LinkParams) -> tuple[Column, Column]:
    """Join keys: namespace prefix (rule 3) and interwiki scheme (rule 4)."""
    ap = U.col_or_lit(p.articlepath)
    path_q = F.concat(parts["path"], U.prefixed("?", parts["query"]))
    under = ap.isNotNull() & F.startswith(path_q, ap)
    rest = path_q.substr(F.length(ap) + 1, F.greatest(F.length(path_q), F.lit(1)))
    ns_key = F.when(under & F.contains(rest, F.lit(":")), U.unquote(F.substring_index(rest, ":", 1)))
    iw_key = F.when(~under & (parts["scheme"] != ""), parts["scheme"])
    return ns_key, iw_key


def _dim_sides(dims: Dims) -> tuple[DataFrame, DataFrame]:
    """Join sides of both dims, made once per ``Dims`` object."""
    if getattr(dims, "_sides", None) is None:
        ns = dims.ns_lookup.select(F.col("name").alias("__nsk"), F.lit(True).alias("__ns_hit"))
        iw = dims.interwiki.select(
            F.col("prefix").alias("__iwk"),
            F.struct("iw_head", "iw_slash", "iw_path", "iw_tail").alias("__iw"),
        )
        dims._sides = (F.broadcast(ns), F.broadcast(iw))  # a site's configuration: some hundreds of rows
    return dims._sides


def rewrite_urls(df: DataFrame, url_col: str, out_col: str, dims: Dims, params: LinkParams | None = None,
                 title_col: str | None = None, kind_col: str | None = None) -> DataFrame:
    """Add ``out_col`` (and optionally ``kind_col``) with the rewritten URL of ``url_col``.

    Two broadcast left joins (namespace keys, interwiki prefixes); rows with a NULL URL
    keep a NULL result.  Partitioning of ``df`` is preserved.  The split parts and the
    decided kind are materialised as columns first, so each is computed once and the
    generated code stays small.
    """
    p = params or LinkParams.from_dims(dims)
    cols = [c for c in df.columns if c not in (out_col, kind_col)]
    ns_key, iw_key = _probe_keys(F.col("__u"), p)
    ns, iw = _dim_sides(dims)
    j = (
        df.withColumn("__u", U.split_url(F.col(url_col)))
        .withColumn("__nsk", ns_key)
        .withColumn("__iwk", iw_key)
        .join(ns, "__nsk", "left")
        .join(iw, "__iwk", "left")
    )
    title = F.col(title_col) if title_col else None
    kind = _decide(F.col("__u"), title, F.col("__ns_hit"), F.col("__iw"), p)
    j = j.withColumn("__kind", F.when(F.col(url_col).isNotNull(), kind))
    out = _assemble(F.col(url_col), F.col("__u"), F.col("__iw"), F.col("__kind"), p)
    sel = [F.col(c) for c in cols] + [out.alias(out_col)]
    if kind_col:
        sel.append(F.col("__kind").alias(kind_col))
    return j.select(*sel)


def _assemble(raw: Column, parts: Column, iw: Column, kind: Column, p: LinkParams) -> Column:
    """The rewritten URL for an already decided kind."""
    ap = U.col_or_lit(p.articlepath)
    srv = F.coalesce(U.col_or_lit(p.server), F.lit(""))
    scheme, netloc, path, query, frag = (parts[k] for k in ("scheme", "netloc", "path", "query", "fragment"))
    qs, fs = U.prefixed("?", query), U.prefixed("#", frag)
    path_q = F.concat(path, qs)
    big = F.greatest(F.length(path_q), F.lit(1))
    under = ap.isNotNull() & F.startswith(path_q, ap)
    rest_noq = F.when(under, path.substr(F.length(ap) + 1, big)).otherwise(path)
    absolute = F.concat(
        F.coalesce(F.nullif(scheme, F.lit("")), F.lit("http")), F.lit("://"), netloc,
        F.when(F.endswith(netloc, F.lit(U.THUMB_HOST_SUFFIX)), U.fix_thumb_width(path)).otherwise(path), qs, fs)
    iw_path = F.replace(iw["iw_path"], F.lit("$1"), path_q)
    iw_path = F.when(iw["iw_slash"] & (iw_path != "") & ~F.startswith(iw_path, F.lit("/")),
                     F.concat(F.lit("/"), iw_path)).otherwise(iw_path)
    return (
        F.when(kind == "absolute", absolute)
        .when(kind.isin("image", "namespace"), U.mk_ext_url(srv, ap, p.site_articlepath, raw))
        .when(kind == "interwiki", F.concat(iw["iw_head"], iw_path, iw["iw_tail"], fs))
        .when(kind == "passthrough", raw)
        .when(kind == "self", F.concat(qs, F.lit("#"), frag))
        .when(kind == "article", F.concat(U.encode_article_path(rest_noq), qs, fs))
    )


def _literal_maps(dims: Dims):
    """(ns_map, iw_map): the site's configuration as literal map columns."""
    ns_json = json.dumps({r.name: True for r in dims.ns_lookup.select("name").collect()})
    iw_json = json.dumps({r.prefix: {"iw_head": r.iw_head, "iw_slash": r.iw_slash, "iw_path": r.iw_path,
                                     "iw_tail": r.iw_tail} for r in dims.interwiki.collect()})
    iw_struct = "struct<iw_head:string,iw_slash:boolean,iw_path:string,iw_tail:string>"
    return (F.from_json(F.lit(ns_json), "map<string,boolean>"),
            F.from_json(F.lit(iw_json), f"map<string,{iw_struct}>"))


def rewrite_srcset(df: DataFrame, srcset_col: str, out_col: str, dims: Dims, params: LinkParams | None = None) -> DataFrame:
    """SCL-7: split on ", ", rewrite the first token of each candidate, keep what follows its first blank as it is."""
    p = params or LinkParams.from_dims(dims)
    if not hasattr(dims, "_maps"):
        dims._maps = _literal_maps(dims)
    ns_map, iw_map = dims._maps

    def bound(value: Column, use) -> Column:  # each value once, so that the expression stays small
        return F.get(F.transform(F.array(value), use), 0)

    def rewritten(x: Column) -> Column:
        ns_key, iw_key = _probe_keys(x["parts"], p)
        hits = F.struct(F.when(ns_key.isNotNull(), F.map_contains_key(ns_map, F.coalesce(ns_key, F.lit("")))).alias("ns"),
                        F.when(iw_key.isNotNull(), F.element_at(iw_map, F.coalesce(iw_key, F.lit("")))).alias("iw"))
        return bound(hits, lambda h: bound(_decide(x["parts"], None, h["ns"], h["iw"], p),
                                           lambda kind: F.concat(_assemble(x["url"], x["parts"], h["iw"], kind, p), x["tail"])))

    def split(c: Column) -> Column:
        url = F.substring_index(c, " ", 1)
        return bound(F.struct(url.alias("url"), c.substr(F.length(url) + 1, F.length(c)).alias("tail"), U.split_url(url).alias("parts")), rewritten)

    def one(cand: Column) -> Column:
        return bound(U.strip_ws(cand), split)

    src = F.col(srcset_col)
    return df.withColumn(out_col, F.when(src.isNotNull(), F.array_join(F.transform(F.split(src, ", "), one), ", ")))


def links_table(nodes: DataFrame, dims: Dims, params: LinkParams | None = None) -> DataFrame:
    """EXT-1: every href / src value of the node table with its rewrite and kind.

    Output: (article_id, pos, tag, attr, raw_url, new_url, kind).  One pass over the nodes
    (an explode of the two attributes), so the node table is read once.
    """
    title = "title" if "title" in nodes.columns else None
    a = F.col("attrs")
    pairs = F.filter(F.array(F.struct(F.lit("href").alias("attr"), a["href"].alias("raw_url")),
                             F.struct(F.lit("src").alias("attr"), a["src"].alias("raw_url"))),
                     lambda x: x["raw_url"].isNotNull())
    both = nodes.where(F.col("kind") == "open").select(
        "article_id", "pos", "tag", *([F.col("title")] if title else []), F.explode(pairs).alias("l")
    ).select("article_id", "pos", "tag", *([F.col("title")] if title else []), "l.attr", "l.raw_url")
    out = rewrite_urls(both, "raw_url", "new_url", dims, params, title_col=title, kind_col="kind")
    return out.drop("title") if title else out


DEALT = 16  # parts that the links of one target are dealt into


def link_targets(links: DataFrame) -> DataFrame:
    """Where local links lead: article_id, target (the key, decoded), fragment, n_links, for each target of an article once. Links
    within the page itself and links with a scheme or host are left out."""
    url = F.col("new_url")
    parts = U.split_url(url)
    local = F.col("kind").isin("article", "self") & (F.coalesce(parts["scheme"], F.lit("")) == "") & (F.coalesce(parts["netloc"], F.lit("")) == "") & (parts["path"] != "")
    found = links.where(local).select("article_id", U.unquote(parts["path"]).alias("target"), F.nullif(parts["fragment"], F.lit("")).alias("fragment"))
    return found.groupBy("article_id", "target", "fragment").agg(F.count("*").alias("n_links"))


def dangling_links(links: DataFrame, keys: DataFrame) -> DataFrame:
    """EXT-1 against the keys: article_id, target, fragment, n_links of the local links that no key answers. A key with a fragment of
    its own answers links to its target whatever their fragment, as a plain one does.

    The links are read once: they are dealt on (target, one of some parts) and each key is given to all parts, so that the links of
    a hub, open or not, are dealt over many tasks. Keys grow with the input and Spark, which takes their size from their files, does not see
    that each is given to all parts: they are never broadcast.
    """
    targets = link_targets(links).withColumn("__part", F.pmod(F.xxhash64("article_id"), F.lit(DEALT)).cast("int"))
    answered = keys.select(F.col("key").alias("target")).distinct().withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    return targets.join(answered.hint("merge"), ["target", "__part"], "left_anti").select("article_id", "target", "fragment", "n_links")
