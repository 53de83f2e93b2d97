"""The whole job: files to dictionary (SET-1, SET-5, PRJ-1, PRJ-2, DOC-17, SNK-1..4).

``route`` decides from each input's prefix, when the plan is built, which reader it needs: ``http://`` and ``https://`` name a
document database, of which an export is read, everything else is a dump file (plain, ``.tar`` or ``.tar.gz``). Each input
is a row of ``profiles``, which joins its articles to the constants of their source; options hold for all sources alike.
Article ids come from the place of a line in its input (``sources.lines``), so they are the same in every run.

Each input line is decoded twice at most: for the articles, and, without the HTML, for the quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import attachments as A
from ..sources import dump as D
from ..sources import scrape as S
from ..sources.lines import read_lines
from ..sources.siteinfo import Dims
from . import dictionary as DI
from .convert import ConvertOptions, convert_articles

DATABASES = ("http://", "https://")
PROFILES = "path_number int, source string, kind string, articlepath string"
ARTICLE = "article_id", "title", "text", "aliases", "path_number"


@dataclass(frozen=True)
class Source:
    """An input: its number among all, what was asked for, how it is read ("dump" or "export") and the file to read."""

    path_number: int
    name: str
    kind: str
    path: str


@dataclass
class Inputs:
    """Articles of all sources with their profile, and the lines that couldn't be decoded."""

    articles: DataFrame
    quarantine: DataFrame
    profiles: DataFrame


@dataclass
class Selection:
    """What to take of the sources: a line range of the dumps, keys and language links of the exports."""

    start: str = "1:1"
    end: str | None = None
    startkey: str | None = None
    endkey: str | None = None
    keys: DataFrame | None = None
    langlinks: list[str] = field(default_factory=list)
    index: DataFrame | None = None


def route(names: list[str], exports: dict[str, str] | None = None) -> list[Source]:
    """SET-5: the sources in the order in which they are united (SET-1): databases first, then dump files. ``exports`` gives the
    file with the export of each database; a database without one is refused."""
    databases = [n for n in names if n.startswith(DATABASES)]
    unknown = [n for n in databases if n not in (exports or {})]
    if unknown:
        raise ValueError(f"no export is given of the databases {unknown}")
    found = [(n, "export", exports[n]) for n in databases] + [(n, "dump", n) for n in names if not n.startswith(DATABASES)]
    return [Source(i, *x) for i, x in enumerate(found)]


def profile_rows(spark: SparkSession, sources: list[Source], dims: Dims) -> DataFrame:
    """PRJ-2: a row for each source. Links in dumps are relative to "./", those in exports under the site's own article path."""
    rows = [(s.path_number, s.name, s.kind, D.DUMP_ARTICLEPATH if s.kind == "dump" else dims.site.articlepath) for s in sources]
    return spark.createDataFrame(rows, PROFILES)


def _numbered(lines: DataFrame, sources: list[Source]) -> DataFrame:
    """Lines with the number of their source in place of that among the paths read together, also in the id."""
    numbers = F.array(*[F.lit(s.path_number) for s in sources])
    shift = F.get(numbers, F.col("path_number")) - F.col("path_number")
    return lines.select(
        (F.col("path_number") + shift).alias("path_number"), (F.col("line_id") + F.shiftleft(shift.cast("long"), 44)).alias("article_id"), "path", "file_number", "line_number", "value"
    )


def read_inputs(spark: SparkSession, sources: list[Source], dims: Dims, select: Selection | None = None) -> Inputs:
    """Every source by its reader, united (duplicates stay), with the profile's columns."""
    select = select or Selection()
    profiles = profile_rows(spark, sources, dims)
    dumps, exports = ([s for s in sources if s.kind == k] for k in ("dump", "export"))
    parts, bad = [], []
    if exports:
        lines = _numbered(read_lines(spark, [s.path for s in exports]), exports)
        docs = S.decode_scrape_rows(lines, select.langlinks)
        docs = S.key_range(docs, select.startkey, select.endkey)
        if select.keys is not None:
            docs = docs.join(select.keys.select(F.col("key").alias("title")).distinct(), "title", "left_semi")
        parts.append(docs.select(*ARTICLE))
        bad.append(lines.where(F.get_json_object("value", "$.id").isNull() & (F.trim(F.coalesce("value", F.lit("?"))) != "")).withColumn("reason", F.lit("not a document row")))
    if dumps:
        lines = read_lines(spark, [s.path for s in dumps], select.start, select.end, select.index, numbered=select.index is not None)
        decoded = D.decode_dump_lines(_numbered(lines, dumps))
        parts.append(D.good_lines(decoded).select(*ARTICLE))
        bad.append(D.quarantine(decoded))
    where = ["article_id", "path", "file_number", "line_number", "reason"]
    articles = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    faults = bad[0].select(where).unionByName(bad[1].select(where)) if len(bad) > 1 else bad[0].select(where)
    # a row for each input: its size is that of the call's list
    return Inputs(articles.join(F.broadcast(profiles), "path_number"), faults, profiles)


def missing_keys(articles: DataFrame, keys: DataFrame, base: int) -> DataFrame:
    """JOIN-4: requested keys that no article answers, as articles without text, with ids of their own above ``base``."""
    title = keys.select(F.col("key").alias("title")).distinct().join(articles.select("title"), "title", "left_anti")
    return title.select((F.lit(base) + F.monotonically_increasing_id()).alias("article_id"), "title", F.lit(None).cast("string").alias("text"), F.array().cast(D.ALIAS_T).alias("aliases"))


def attachment_files(spark: SparkSession, resources: str | None, content_dirs: list[str] | None, no_math: bool) -> DataFrame | None:
    """SRC-8: the resources that converted pages point at (``~/``), then the user's folders."""
    parts = [A.read_attachments(spark, resources, A.RESOURCE_PREFIX, A.resource_folders(no_math))] if resources else []
    parts += [A.read_attachments(spark, d) for d in content_dirs or []]
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def build_dictionary(spark: SparkSession, names: list[str], out_dir: str, dims: Dims, tags: DataFrame, options: ConvertOptions | None = None,
                     exports: dict[str, str] | None = None, select: Selection | None = None, resources: str | None = None,
                     content_dirs: list[str] | None = None, buckets: int | None = None) -> DI.Dictionary:
    """Reads all inputs, converts their articles and writes one committed dictionary with the attachments; ``quarantine`` lies beside
    the run's tables. ``tags`` are the dictionary's (``dictionary.tags_table``)."""
    options, select = options or ConvertOptions(), select or Selection()
    sources = route(names, exports)
    if not sources:
        raise ValueError("no inputs")
    inputs = read_inputs(spark, sources, dims, select)
    articles = inputs.articles.select("article_id", "title", "text", "aliases", "articlepath")
    if select.keys is not None:
        wanted = missing_keys(inputs.articles.where(F.col("kind") == "export"), select.keys, len(sources) << 44)
        articles = articles.unionByName(wanted.withColumn("articlepath", F.lit(dims.site.articlepath)))
    converted = convert_articles(articles, dims, options)
    files = attachment_files(spark, resources, content_dirs, options.no_math)
    made = DI.write_dictionary(converted, out_dir, tags, options.html_encoding, files=files, buckets=buckets)
    inputs.quarantine.write.parquet(f"{out_dir.rstrip('/')}/{made.run}/quarantine")
    return made
