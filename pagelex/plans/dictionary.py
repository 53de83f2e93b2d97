"""The dictionary product: content, keys, tags and outcomes tables (SNK-1..4, PRJ-3,
PRJ-4, AGG-3, JOIN-8, SRT-1, SRT-2).

Written as Parquet in a folder of its own for each run. ``articles`` is written once, with the blobs, and the other
tables are made from its small columns; a row appended to ``commits`` at the end makes the run the one that readers see, so a run that fails
leaves the dictionary as it was. Layout of a run::

    articles/bucket=B/   content_id, content, content_type, title, aliases, status, n_bytes, digest, error; sorted by content_id in its bucket
    keys/                key, fragment, content_id, bucket; ranges of keys, sorted, with Bloom filters of the keys
    tags/                name, value
    outcomes/status=S/   content_id, title, n_bytes, error

A key carries its content's bucket, so a lookup opens the key ranges that may hold the key and of the content only the buckets that answer
it, there by the row groups' bounds of ``content_id``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import attachments as A

# Tags every dictionary starts with (overridden by name), and the options
# that may override the site's tags when given a non-empty value.
DEFAULT_TAGS = [("license.name", ""), ("license.url", ""), ("created.by", ""), ("copyright", "")]
CLI_TAGS = ("license.name", "license.url", "created.by", "uri")
CONTENT_TYPE = "text/html;charset={0}"
ALIASES = "array<struct<key:string,fragment:string>>"
COMMITS = "run string, committed timestamp, buckets int, n_articles long, n_files long"
LITERALS = 1000  # keys or ids that are looked up by value; more are joined


def content_table(converted: DataFrame, html_encoding: str = "utf-8") -> DataFrame:
    """SNK-1: one blob per successful article."""
    return converted.where(F.col("status") == "S").select(
        F.col("article_id").alias("content_id"), "content", F.lit(CONTENT_TYPE.format(html_encoding)).alias("content_type"))


def keys_table(converted: DataFrame, *carry: str) -> DataFrame:
    """SNK-2: every successful blob by its title and by each alias (N keys : 1 blob); ``carry`` columns go along."""
    ok = converted.where(F.col("status") == "S")
    title_key = F.array(F.struct(F.col("title").alias("key"), F.lit(None).cast("string").alias("fragment")))
    keys = F.concat(title_key, F.coalesce(F.col("aliases"), F.array().cast(ALIASES)))
    return ok.select(F.col("article_id").alias("content_id"), *carry, F.explode(keys).alias("k")).select(
        F.col("k.key").alias("key"), F.col("k.fragment").alias("fragment"), "content_id", *carry)


def outcomes(converted: DataFrame) -> DataFrame:
    """SNK-4 / PRJ-4: (title, status, n_bytes, error) per article."""
    return converted.select("article_id", "title", "status", "n_bytes", "error")


def outcome_totals(converted: DataFrame) -> DataFrame:
    """AGG-3: articles and bytes per status (S + F + E = articles in)."""
    return converted.groupBy("status").agg(F.count("*").alias("n_articles"), F.sum("n_bytes").alias("n_bytes"))


def site_tags(site: DataFrame, langlinks: DataFrame | None = None) -> DataFrame:
    """PRJ-3 + SRT-2: tags from the site row(s): license, source/uri = server,
    label = "sitename (lang)", langlinks = sorted and space-joined."""
    base = site.select(
        F.col("license_name").alias("license.name"), F.col("license_url").alias("license.url"),
        F.col("server").alias("source"), F.col("server").alias("uri"),
        F.format_string("%s (%s)", F.col("sitename"), F.col("sitelang")).alias("label"))
    tags = base.unpivot([], ["`license.name`", "`license.url`", "source", "uri", "label"], "name", "value")
    if langlinks is not None:
        ll = langlinks.agg(F.array_join(F.array_sort(F.collect_list("lang")), " ").alias("value")) \
            .select(F.lit("langlinks").alias("name"), "value")
        tags = tags.unionByName(ll)
    return tags


def tags_table(spark: SparkSession, tags: DataFrame, cli: dict[str, str] | None = None) -> DataFrame:
    """SNK-3: defaults, overridden by the site's tags, overridden by non-empty options."""
    defaults = spark.createDataFrame(DEFAULT_TAGS, "name string, value string")
    opts = [(k, v) for k, v in (cli or {}).items() if k in CLI_TAGS and v]
    over = spark.createDataFrame(opts, "name string, value string")
    t = tags.select("name", F.col("value").alias("t"))
    o = over.select("name", F.col("value").alias("o"))
    d = defaults.select("name", F.col("value").alias("d"))
    return d.join(t, "name", "full_outer").join(o, "name", "full_outer").select(
        "name", F.coalesce("o", "t", "d").alias("value"))


def lookup(requests: DataFrame, keys: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """JOIN-8: requested keys -> content ids (and content when given). Where both sides of the content join carry the
    bucket it is part of the join, which lets Spark skip the buckets that no request needs."""
    hit = requests.select(F.col("key")).join(keys, "key")
    if content is not None:
        on = ["content_id", "bucket"] if "bucket" in keys.columns and "bucket" in content.columns else ["content_id"]
        hit = hit.join(content, on)
    return hit


@dataclass
class Dictionary:
    """A committed run as tables."""

    run: str
    content: DataFrame
    keys: DataFrame
    tags: DataFrame
    outcomes: DataFrame

    def fetch(self, keys: list[str]) -> DataFrame:
        """key, fragment, content_id, content_type, content, digest of the requested keys, with the files that may hold them opened
        only: the keys by value, and as few ids as ``LITERALS`` by value too; more ids are joined by bucket and id."""
        wanted = sorted(set(keys))
        spark = self.keys.sparkSession
        if len(wanted) <= LITERALS:
            hits = self.keys.where(F.col("key").isin(wanted))
        else:
            hits = self.keys.join(spark.createDataFrame([(k,) for k in wanted], "key string"), "key")
        ids = hits.select("content_id", "bucket").distinct().limit(LITERALS + 1).collect()
        content = self.content
        if len(ids) <= LITERALS:
            content = content.where(F.col("bucket").isin(sorted({r.bucket for r in ids})) & F.col("content_id").isin([r.content_id for r in ids]))
        return hits.join(content, ["content_id", "bucket"]).select("key", "fragment", "content_id", "content_type", "content", "digest")


def _bucket(content_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(content_id), F.lit(buckets)).cast("int")


def _write_articles(rows: DataFrame, path: str, buckets: int) -> None:
    """Rows to their buckets, each bucket one task's, sorted by id."""
    dealt = rows.withColumn("bucket", _bucket(F.col("content_id"), buckets)).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "content_id")
    dealt.write.mode("append").partitionBy("bucket").option("parquet.bloom.filter.enabled#content_id", "true").parquet(path)


ARTICLES = ("content_id long, content binary, content_type string, title string, aliases " + ALIASES
            + ", status string, n_bytes long, digest string, error string, bucket int")


def write_dictionary(converted: DataFrame, out_dir: str, tags: DataFrame, html_encoding: str = "utf-8", key_partitions: int | None = None,
                     files: DataFrame | None = None, buckets: int | None = None) -> Dictionary:
    """SNK-1..4 and SRT-1: writes a run and commits it. ``files`` are attachments (``sources.attachments``); their blobs lie with the
    articles', their keys with the titles. Nothing but the commit is seen by readers, and only once all tables are there."""
    spark = converted.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = f"run-{uuid.uuid4().hex}"
    top = f"{out_dir.rstrip('/')}/{run}"
    success = F.col("status") == "S"
    _write_articles(converted.select(
        F.col("article_id").alias("content_id"), F.when(success, F.col("content")).alias("content"), F.when(success, F.lit(CONTENT_TYPE.format(html_encoding))).alias("content_type"),
        "title", F.col("aliases").cast(ALIASES).alias("aliases"), "status", "n_bytes", F.when(success, F.sha2("content", 256)).alias("digest"), "error",
    ), f"{top}/articles", buckets)
    if files is not None:
        _write_articles(A.blobs(files).select(
            "content_id", "content", "content_type", F.lit(None).cast("string").alias("title"), F.lit(None).cast(ALIASES).alias("aliases"),
            F.lit("A").alias("status"), "n_bytes", "digest", F.lit(None).cast("string").alias("error"),
        ), f"{top}/articles", buckets)
    rows = spark.read.schema(ARTICLES).parquet(f"{top}/articles")
    small = rows.drop("content")
    keys = keys_table(small.withColumnRenamed("content_id", "article_id"), "bucket")
    if files is not None:
        keys = keys.unionByName(A.keys(files).withColumn("bucket", _bucket(F.col("content_id"), buckets)))
    keys = keys.repartitionByRange(key_partitions, "key") if key_partitions else keys.repartitionByRange("key")
    keys.sortWithinPartitions("key").write.option("parquet.bloom.filter.enabled#key", "true").parquet(f"{top}/keys")
    tags.write.parquet(f"{top}/tags")
    articles = small.where(F.col("status") != "A")
    articles.select("content_id", "title", "status", "n_bytes", "error").write.partitionBy("status").parquet(f"{top}/outcomes")
    n = {r["status"]: r["count"] for r in small.groupBy("status").count().collect()}
    commit = spark.createDataFrame([(run, buckets, sum(v for k, v in n.items() if k != "A"), n.get("A", 0))], "run string, buckets int, n_articles long, n_files long")
    commit.select("run", F.current_timestamp().alias("committed"), "buckets", "n_articles", "n_files").coalesce(1).write.mode("append").parquet(f"{out_dir.rstrip('/')}/commits")
    return read_dictionary(spark, out_dir)


def commits(spark: SparkSession, out_dir: str) -> DataFrame:
    """Committed runs: run, committed, buckets, n_articles, n_files."""
    return spark.read.schema(COMMITS).parquet(f"{out_dir.rstrip('/')}/commits")


def read_dictionary(spark: SparkSession, out_dir: str, run: str | None = None) -> Dictionary:
    """The last committed run, or a given one."""
    if run is None:
        run = commits(spark, out_dir).orderBy(F.desc("committed"), F.desc("run")).limit(1).collect()[0]["run"]
    top = f"{out_dir.rstrip('/')}/{run}"
    rows = spark.read.schema(ARTICLES).parquet(f"{top}/articles")
    return Dictionary(
        run,
        rows.where(F.col("status").isin("S", "A")).select("content_id", "content", "content_type", "n_bytes", "digest", "bucket"),
        spark.read.schema("key string, fragment string, content_id long, bucket int").parquet(f"{top}/keys"),
        spark.read.schema("name string, value string").parquet(f"{top}/tags"),
        spark.read.schema("content_id long, title string, n_bytes long, error string, status string").parquet(f"{top}/outcomes"),
    )


def resource_targets(content: DataFrame, html_encoding: str = "utf-8") -> DataFrame:
    """Which resources the HTML blobs point at: target (``~/...``, without fragment and query), n_pages. Each blob is read
    once and gives each of its targets once, so that targets of all pages come down to a row a task."""
    page = content.where(F.startswith("content_type", F.lit("text/html"))).select(F.decode("content", html_encoding).alias("html"))
    found = F.regexp_extract_all("html", F.lit(r"""(?:href|src)=["'](?:\./)?(~(?:/|%2F)[^"'#?]+)"""), F.lit(1))
    targets = F.array_distinct(F.transform(found, lambda t: F.replace(t, F.lit("%2F"), F.lit("/"))))
    return page.select(F.explode(targets).alias("target")).groupBy("target").agg(F.count("*").alias("n_pages"))


def missing_resources(content: DataFrame, keys: DataFrame, html_encoding: str = "utf-8") -> DataFrame:
    """Targets of the pages that no key answers: target, n_pages."""
    return resource_targets(content, html_encoding).join(keys.select(F.col("key").alias("target")), "target", "left_anti")
