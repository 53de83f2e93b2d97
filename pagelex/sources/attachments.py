"""Attachment files (SRC-8): what the dictionary holds next to the articles.

A file's key is its path under its folder, behind the folder's prefix (``~/`` for the resources that converted articles point
at). ``include`` keeps only the named top-level folders. Files whose name has no known ending are left out, as
they have no content type. Equal files are one blob: ``content_id`` comes from the SHA-256 of the bytes and is negative, so
that it never meets an article's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Content types by the ending of a file's name.
CONTENT_TYPES = {
    "css": "text/css", "eot": "application/vnd.ms-fontobject", "gif": "image/gif", "htm": "text/html", "html": "text/html",
    "ico": "image/x-icon", "jpeg": "image/jpeg", "jpg": "image/jpeg", "js": "application/javascript", "json": "application/json",
    "map": "application/json", "mjs": "application/javascript", "otf": "font/otf", "png": "image/png", "svg": "image/svg+xml",
    "ttf": "font/ttf", "txt": "text/plain", "wasm": "application/wasm", "webp": "image/webp", "woff": "font/woff",
    "woff2": "font/woff2", "xml": "application/xml",
}
RESOURCE_PREFIX = "~/"
RESOURCE_FOLDERS = ("js", "css", "images")
MATH_FOLDER = "MathJax"


def resource_folders(no_math: bool = False) -> list[str]:
    """The built-in folders that a dictionary takes; the formula renderer only where formulas are shown."""
    return [*RESOURCE_FOLDERS, *([] if no_math else [MATH_FOLDER])]


def below(path: Column, root: str) -> Column:
    """A path relative to ``root``, both with or without scheme (``file:/x``, ``file:///x``, ``/x`` and ``s3a://b/x`` alike);
    null for a path elsewhere."""
    bare = lambda p: F.regexp_replace(F.regexp_replace(p, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), "^/{2,}", "/")
    top = F.concat(F.rtrim(bare(F.lit(root)), F.lit("/")), F.lit("/"))
    return F.when(F.startswith(bare(path), top), F.substr(bare(path), F.length(top) + 1))


def attachments(files: DataFrame, root: str, prefix: str = "", include: list[str] | None = None) -> DataFrame:
    """key, content, content_type, n_bytes, digest, content_id of the files (path, content) under ``root``."""
    rel = files.select(below(F.col("path"), root).alias("rel"), "content").where(F.col("rel").isNotNull())
    if include is not None:
        rel = rel.where(F.contains("rel", F.lit("/")) & F.split("rel", "/").getItem(0).isin(*include))
    kinds = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    kind = kinds[F.lower(F.regexp_extract("rel", r"\.([^./]+)$", 1))]
    digest = F.sha2("content", 256)
    return (
        rel.select(F.concat(F.lit(prefix), "rel").alias("key"), "content", kind.alias("content_type"), F.octet_length("content").cast("long").alias("n_bytes"), digest.alias("digest"))
        .where(F.col("content_type").isNotNull())
        .withColumn("content_id", -1 - F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"))
    )


def read_attachments(spark: SparkSession, root: str, prefix: str = "", include: list[str] | None = None) -> DataFrame:
    """``attachments`` of every file under ``root``, in any store that Spark reads. Folders that aren't included are not
    opened: each wanted one is a path of its own."""
    root = root.rstrip("/")
    paths = [root] if include is None else [p for p in (f"{root}/{x}" for x in include) if _exists(spark, p)]
    if not paths:
        return attachments(spark.createDataFrame([], "path string, content binary"), root, prefix, include)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return attachments(files.select("path", "content"), root, prefix, include)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def blobs(files: DataFrame) -> DataFrame:
    """One row for each different content: content_id, content, content_type, n_bytes, digest. Of equal files with
    several types the one of the smallest key holds."""
    first = files.groupBy("content_id").agg(F.min_by(F.struct("content_type", "digest", "n_bytes"), "key").alias("f"), F.count_distinct("digest").alias("n"), F.first("content").alias("content"))
    mixed = F.raise_error(F.concat(F.lit("two files share the content id "), F.col("content_id").cast("string")))
    return first.select(F.when(F.col("n") == 1, F.col("content_id")).otherwise(mixed.cast("long")).alias("content_id"), "content", "f.content_type", "f.n_bytes", "f.digest")


def keys(files: DataFrame) -> DataFrame:
    """key, fragment, content_id of the files; of files with one key the smallest content holds."""
    return files.groupBy("key").agg(F.min_by("content_id", "digest").alias("content_id")).select("key", F.lit(None).cast("string").alias("fragment"), "content_id")
