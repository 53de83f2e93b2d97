"""Queries of the files-to-dictionary job: lines of written files, attachments, the committed dictionary and its lookups. What they
read from files was written from the driver tables to the session's shared folder before."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import attachments as A
from ..sources import lines as LN
from . import dictionary as DI
from . import fixtures as FX
from .convert import CSS_LINKS, ConvertOptions, convert_articles
from .registry import query


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("file_slice", """
WITH l AS (SELECT c_nationkey, c_custkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line_number FROM customer)
SELECT c_nationkey AS nation, line_number, c_name AS value FROM l WHERE line_number BETWEEN 2 AND 40
""")
def file_slice(spark, d):
    """SRC-1 + FLT-1 + WIN-2 + SRT-3 on files: one file for each nation, cut into splits, indexed, and sliced by line numbers; splits
    outside the range are not read."""
    c = FX.table(spark, d, "customer")
    top = _folder(spark, "files")
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", F.col("c_name").alias("value")).write.partitionBy("c_nationkey").text(top)
    paths = sorted(spark.read.text(top).inputFiles())
    got = LN.read_lines(spark, paths, "1:2", "1:40", split_bytes=1 << 12)
    return got.select(F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("long").alias("nation"), "line_number", "value")


FILE_SQL = """
SELECT '/res/' || folder || '/f' || CAST(p_partkey AS VARCHAR) || '.' || ending AS path, folder, ending, folder || '/f' || CAST(p_partkey AS VARCHAR) || '.' || ending AS rel, p_brand
FROM (SELECT *, (['js', 'css', 'images', 'MathJax', 'py'])[p_partkey % 5 + 1] AS folder, (['css', 'JS', 'svg', 'zzz'])[p_size % 4 + 1] AS ending FROM part)
"""
TYPE_SQL = "CASE lower(ending) WHEN 'css' THEN 'text/css' WHEN 'js' THEN 'application/javascript' WHEN 'svg' THEN 'image/svg+xml' END"


def _files(spark, d):
    """part -> files (path, content): five folders, four endings of which one has no type, few different contents."""
    pick = lambda values, by: F.element_at(F.array(*[F.lit(x) for x in values]), (by + 1).cast("int"))
    path = F.concat(F.lit("file:/res/"), pick(["js", "css", "images", "MathJax", "py"], F.col("p_partkey") % 5), F.lit("/f"), F.col("p_partkey").cast("string"), F.lit("."),
                    pick(["css", "JS", "svg", "zzz"], F.col("p_size") % 4))
    return FX.table(spark, d, "part").select(path.alias("path"), F.encode("p_brand", "utf-8").alias("content"))


@query("attachment_keys", f"""
WITH f AS ({FILE_SQL})
SELECT no_math, '~/' || rel AS key, sha256(p_brand) AS digest, {TYPE_SQL} AS content_type
FROM f, (VALUES (true), (false)) AS m(no_math) WHERE ending <> 'zzz' AND (folder IN ('js', 'css', 'images') OR (folder = 'MathJax' AND NOT no_math))
""")
def attachment_keys(spark, d):
    """SRC-8 into SNK-2: keys of attached files by the digest of their content, with and without the formula renderer."""
    def keys(no_math: bool):
        files = A.attachments(_files(spark, d), "/res", A.RESOURCE_PREFIX, A.resource_folders(no_math))
        held = A.blobs(files).select("content_id", "digest", "content_type")
        types = files.select("key", F.col("content_type").alias("own"))
        return A.keys(files).join(held, "content_id").join(types, "key").select(F.lit(no_math).alias("no_math"), "key", "digest", F.col("own").alias("content_type"))

    return keys(True).unionByName(keys(False))


@query("attachment_blobs", f"""
WITH f AS ({FILE_SQL})
SELECT sha256(p_brand) AS digest, CAST(min(length(p_brand)) AS BIGINT) AS n_bytes, min(md5(p_brand)) AS content_md5, min_by({TYPE_SQL}, '~/' || rel) AS content_type
FROM f WHERE ending <> 'zzz' AND folder <> 'py' GROUP BY 1
""")
def attachment_blobs(spark, d):
    """SRC-8 into SNK-1: one blob for all files of one content."""
    files = A.attachments(_files(spark, d), "/res", A.RESOURCE_PREFIX, A.resource_folders())
    return A.blobs(files).select("digest", "n_bytes", F.md5("content").alias("content_md5"), "content_type")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


@query("dict_fetch", f"""
WITH a AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS s, md5({_quoted(CSS_LINKS + '<div><p>page ')} || CAST(c_custkey AS VARCHAR) || '</p></div>') AS content_md5 FROM customer WHERE c_custkey % 7 <> 0),
f AS ({FILE_SQL}),
keys AS (SELECT 'C' || s AS key, content_md5 FROM a UNION ALL SELECT 'N' || CAST(k % 25 AS VARCHAR), content_md5 FROM a
         UNION ALL SELECT '~/' || rel, md5(p_brand) FROM f WHERE ending <> 'zzz' AND folder <> 'py'),
asked AS (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'N4' UNION ALL SELECT '~/' || rel FROM f)
SELECT key, content_md5 FROM asked JOIN keys USING (key)
""")
def dict_fetch(spark, d):
    """SNK-1, SNK-2, SRT-1, JOIN-8 with content: a dictionary of articles and files is written, committed and read back; requested
    titles, an alias that many articles share, and files are looked up. Articles without text and files without type have no key."""
    k = F.col("c_custkey")
    s = k.cast("string")
    alias = F.array(F.struct(F.concat(F.lit("N"), (k % 25).cast("string")).alias("key"), F.lit(None).cast("string").alias("fragment")))
    text = F.when(k % 7 != 0, F.concat(F.lit("<p>page "), s, F.lit("</p>")))
    c = FX.table(spark, d, "customer")
    arts = c.select(k.alias("article_id"), F.concat(F.lit("C"), s).alias("title"), text.alias("text"), alias.alias("aliases"))
    files = A.attachments(_files(spark, d), "/res", A.RESOURCE_PREFIX, A.resource_folders())
    tags = DI.tags_table(spark, FX.table(spark, d, "region").select(F.col("r_name").alias("name"), F.lit("x").alias("value")))
    made = DI.write_dictionary(convert_articles(arts, FX.query_dims(spark, d), ConvertOptions(), header=False), _folder(spark, "dictionary"), tags, files=files)
    every = _files(spark, d).select(F.concat(F.lit("~/"), A.below(F.col("path"), "/res")).alias("key"))
    asked = c.where(k % 3 == 0).select(F.concat(F.lit("C"), s).alias("key")).unionByName(spark.createDataFrame([("N4",)], "key string")).unionByName(every)
    return DI.lookup(asked, made.keys, made.content).select("key", F.md5("content").alias("content_md5"))


@query("missing_resources", f"""
WITH f AS ({FILE_SQL}),
t AS (SELECT '~/css/f' || CAST(c_custkey AS VARCHAR) || '.css' AS target FROM customer)
SELECT target, CAST(1 AS BIGINT) AS n_pages FROM t WHERE target NOT IN (SELECT '~/' || rel FROM f WHERE ending <> 'zzz' AND folder <> 'py')
UNION ALL SELECT u, (SELECT count(*) FROM customer) FROM (VALUES ('~/css/shared.css'), ('~/css/mediawiki_shared.css'), ('~/css/mediawiki_monobook.css'), ('~/css/night.css')) AS s(u)
""")
def missing_resources(spark, d):
    """SRC-8 against SNK-1: resources that converted pages point at and no attached file answers."""
    s = F.col("c_custkey").cast("string")
    html = F.concat(F.lit('<p><img src="~/css/f'), s, F.lit('.css?v=1"><img src="~/css/f'), s, F.lit('.css"></p>'))
    arts = FX.table(spark, d, "customer").select(F.col("c_custkey").alias("article_id"), F.concat(F.lit("C"), s).alias("title"), html.alias("text"))
    content = DI.content_table(convert_articles(arts, FX.query_dims(spark, d), ConvertOptions(), header=False))
    files = A.attachments(_files(spark, d), "/res", A.RESOURCE_PREFIX, A.resource_folders())
    return DI.missing_resources(content, A.keys(files))
