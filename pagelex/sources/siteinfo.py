"""Site info source and the namespace / interwiki dimensions (SRC-6, JOIN-1/2, AGG-2, FLT-5,
SCL-8..10).

A site-info document is one JSON object::

    {"general": {"sitename", "lang", "articlepath", "server", "rtl"?...},
     "rightsinfo": {"text", "url"},
     "namespaces": {"<id>": {"id", "canonical", "*"}, ...},
     "interwikimap": [{"prefix", "url"}, ...]}

``general`` is read as ``MAP<STRING,STRING>`` because the right-to-left flag is the
*presence* of the key ``rtl`` (whatever its value), which a struct read cannot tell
from a JSON null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls as U

NAMESPACE_T = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("canonical", T.StringType()),
    T.StructField("*", T.StringType()),
])

SITEINFO_SCHEMA = T.StructType([
    T.StructField("general", T.MapType(T.StringType(), T.StringType())),
    T.StructField("rightsinfo", T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
    ])),
    T.StructField("namespaces", T.MapType(T.StringType(), NAMESPACE_T)),
    T.StructField("interwikimap", T.ArrayType(T.StructType([
        T.StructField("prefix", T.StringType()),
        T.StructField("url", T.StringType()),
    ]))),
])


@dataclass
class Site:
    """The per-run constants of one site (one row, collected once)."""

    sitename: str | None
    sitelang: str | None
    rtl: bool
    license_name: str | None
    license_url: str | None
    articlepath: str | None
    server: str


def read_siteinfo_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: parse site-info file(s); one row per file."""
    return spark.read.option("multiLine", True).schema(SITEINFO_SCHEMA).json(path)


def parse_siteinfo(json_col) -> "F.Column":
    """Parse a site-info JSON string column (same schema as the file reader)."""
    return F.from_json(json_col, SITEINFO_SCHEMA)


def site_columns(info: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """Site scalars per site-info row (SCL-8 add_http, SCL-9 article path, SCL-10 rtl)."""
    g = F.col("general")
    return info.select(
        *keep,
        g["sitename"].alias("sitename"),
        g["lang"].alias("sitelang"),
        F.coalesce(F.map_contains_key(g, "rtl"), F.lit(False)).alias("rtl"),
        F.col("rightsinfo.text").alias("license_name"),
        U.add_http(F.col("rightsinfo.url")).alias("license_url"),
        U.article_path_prefix(g["articlepath"]).alias("articlepath"),
        U.add_http(F.coalesce(g["server"], F.lit(""))).alias("server"),
    )


def collect_site(info: DataFrame) -> Site:
    """The one site row as Python constants (exactly one row is required)."""
    rows = site_columns(info).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one site-info document, got {len(rows)}")
    r = rows[0]
    return Site(r.sitename, r.sitelang, bool(r.rtl), r.license_name, r.license_url, r.articlepath, r.server)


def namespaces_raw(info: DataFrame) -> DataFrame:
    """Namespaces in document order: (pos, id, canonical, name)."""
    return info.select(F.posexplode(F.map_values("namespaces")).alias("pos", "ns")).select(
        "pos", F.col("ns.id").alias("id"), F.col("ns.canonical").alias("canonical"), F.col("ns.`*`").alias("name")
    )


def interwiki_raw(info: DataFrame) -> DataFrame:
    """Interwiki entries in document order: (pos, prefix, url)."""
    return info.select(F.posexplode("interwikimap").alias("pos", "iw")).select(
        "pos", F.col("iw.prefix").alias("prefix"), F.col("iw.url").alias("url")
    )


def resolve_local_namespaces(ns: DataFrame, local_names: list[str] | None) -> DataFrame:
    """JOIN-1 / JOIN-2 / SET-4: drop the namespaces named as local.

    A requested name matches a namespace's local name, canonical name or id-as-string.
    Every match is consumed (so naming a namespace by name *and* id is fine).  Requested
    names that match nothing raise, as an invalid option.
    """
    if not local_names:
        return ns
    spark = ns.sparkSession
    requested = spark.createDataFrame([(n,) for n in dict.fromkeys(local_names)], "alias string")
    aliases = ns.select(
        "id", F.explode(F.array(F.col("name"), F.col("canonical"), F.col("id").cast("string"))).alias("alias")
    ).where(F.col("alias").isNotNull())
    matched = aliases.join(F.broadcast(requested), "alias", "left_semi")
    unknown = requested.join(aliases, "alias", "left_anti").collect()
    if unknown:
        raise ValueError(f"Invalid namespaces: {sorted(r.alias for r in unknown)}")
    local_ids = matched.select("id").distinct()
    return ns.join(F.broadcast(local_ids), "id", "left_anti")


def namespace_lookup(ns: DataFrame) -> DataFrame:
    """Lookup keys of the non-local namespaces: (name, ns_id).

    FLT-5: only truthy ids (so id 0 is out, negative ids stay).  Keys are canonical,
    its lower case, the local name and its lower case; a key repeated by a later
    namespace keeps the later id (AGG-2, last wins).
    """
    keyed = ns.where(F.col("id").isNotNull() & (F.col("id") != 0)).select(
        "pos", "id",
        F.posexplode(F.array(F.col("canonical"), F.lower("canonical"), F.col("name"), F.lower("name"))).alias("rank", "name"),
    ).where(F.coalesce(F.col("name"), F.lit("")) != "")
    return keyed.groupBy("name").agg(F.max_by("id", F.struct("pos", "rank")).alias("ns_id"))


def interwiki_dim(iw: DataFrame) -> DataFrame:
    """Interwiki prefixes: (prefix, url, iw_head, iw_path, iw_tail), last entry wins (AGG-2).

    FLT-5: both prefix and url must be non-empty.  The template is split once here so the
    per-link rewrite is a replace + concat: ``iw_head`` is ``scheme:`` plus ``//host`` when
    the URL keeps a host part, ``iw_path`` holds ``$1``, ``iw_tail`` is ``?query``.
    """
    last = (
        iw.where((F.coalesce(F.col("prefix"), F.lit("")) != "") & (F.coalesce(F.col("url"), F.lit("")) != ""))
        .groupBy("prefix")
        .agg(F.max_by("url", "pos").alias("url"))
    )
    parts = U.split_url(F.col("url"))
    scheme = F.coalesce(F.nullif(parts["scheme"], F.lit("")), F.lit("http"))
    keeps_host = (parts["netloc"] != "") | scheme.isin(*U.USES_NETLOC)
    return last.select(
        "prefix",
        "url",
        F.concat(scheme, F.lit(":"), F.when(keeps_host, F.concat(F.lit("//"), parts["netloc"])).otherwise(F.lit(""))).alias("iw_head"),
        keeps_host.alias("iw_slash"),
        parts["path"].alias("iw_path"),
        U.prefixed("?", parts["query"]).alias("iw_tail"),
    )


@dataclass
class Dims:
    """Everything the link rewrite needs from one site."""

    site: Site
    ns_lookup: DataFrame      # (name, ns_id)
    interwiki: DataFrame      # (prefix, url, iw_head, iw_slash, iw_path, iw_tail)


def load_dims(spark: SparkSession, siteinfo_path: str, local_namespaces: list[str] | None = None) -> Dims:
    """SRC-6 end to end: site constants plus both dims from a site-info file."""
    info = read_siteinfo_json(spark, siteinfo_path).cache()
    return dims_from_info(info, local_namespaces)


def dims_from_info(info: DataFrame, local_namespaces: list[str] | None = None) -> Dims:
    site = collect_site(info)
    ns = resolve_local_namespaces(namespaces_raw(info), local_namespaces)
    return Dims(site, namespace_lookup(ns), interwiki_dim(interwiki_raw(info)))


def dims_from_tables(site: Site, ns_raw: DataFrame, iw_raw: DataFrame,
                     local_namespaces: list[str] | None = None) -> Dims:
    """Dims from already tabular namespace (pos, id, canonical, name) / interwiki (pos, prefix, url)."""
    ns = resolve_local_namespaces(ns_raw, local_namespaces)
    return Dims(site, namespace_lookup(ns), interwiki_dim(iw_raw))
