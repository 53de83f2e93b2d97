"""Scraped-document source (SRC-4), key list (SRC-5) and the key filters/joins
(FLT-2, FLT-3, FLT-4, FLT-6, AGG-1, JOIN-3, JOIN-4, SET-2, SET-3).

Input is an export of the document store's ``_all_docs?include_docs=true`` rows as JSON
lines: ``{"id": ..., "doc": {"_id", "aliases": [str | [key, fragment]], "parse":
{"text": {"*": html}, "langlinks": [{"lang", "*"}]}}}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import strip_ws
from .dump import ALIAS_T

ROW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("doc", T.StructType([
        T.StructField("_id", T.StringType()),
        # mixed strings and [key, fragment] arrays: read as text, normalised below
        T.StructField("aliases", T.ArrayType(T.StringType())),
        T.StructField("parse", T.StructType([
            T.StructField("text", T.StructType([T.StructField("*", T.StringType())])),
            T.StructField("langlinks", T.ArrayType(T.StructType([
                T.StructField("lang", T.StringType()), T.StructField("*", T.StringType())]))),
        ])),
    ])),
])


def decode_scrape_rows(rows: DataFrame, langlinks: list[str] | None = None, value_col: str = "value") -> DataFrame:
    """SRC-4 + FLT-4 + AGG-1: (title, text, aliases) per exported document with a body.

    A body without ``parse.text`` still gives a row, with NULL text and no aliases.
    Aliases are the document's aliases plus the requested language links with a title
    (FLT-6), without duplicates (SET-3).
    """
    j = F.from_json(F.col(value_col), ROW_SCHEMA)
    others = [c for c in rows.columns if c != value_col]
    # behind a generator, neither the filter nor the fields parse the row again
    df = rows.select(*others, F.explode(F.array(j)).alias("r")).where(F.col("r.doc").isNotNull())
    text = F.col("r.doc.parse.text.`*`")

    def norm(a):
        arr = F.from_json(a, "array<string>")
        return F.when(F.startswith(a, F.lit("[")), F.struct(arr.getItem(0).alias("key"), arr.getItem(1).alias("fragment"))) \
            .otherwise(F.struct(a.alias("key"), F.lit(None).cast("string").alias("fragment")))

    own = F.transform(F.coalesce(F.col("r.doc.aliases"), F.array().cast("array<string>")), norm)
    langs = list(langlinks or [])
    if langs:
        ll = F.filter(F.coalesce(F.col("r.doc.parse.langlinks"), F.array().cast("array<struct<lang:string,`*`:string>>")),
                      lambda x: x["lang"].isin(*langs) & (F.coalesce(x["*"], F.lit("")) != ""))
        ll = F.transform(ll, lambda x: F.struct(x["*"].alias("key"), F.lit(None).cast("string").alias("fragment")))
        all_aliases = F.concat(own, ll)
    else:
        all_aliases = own
    aliases = F.when(text.isNull(), F.array().cast(ALIAS_T)).otherwise(F.array_distinct(all_aliases).cast(ALIAS_T))
    return df.select(*others, F.col("r.id").alias("title"), text.alias("text"), aliases.alias("aliases"))


def read_scrape_export(spark: SparkSession, path: str, langlinks: list[str] | None = None) -> DataFrame:
    return decode_scrape_rows(spark.read.text(path), langlinks)


def key_range(articles: DataFrame, startkey: str | None = None, endkey: str | None = None) -> DataFrame:
    """FLT-2: titles from startkey up to endkey (inclusive), binary order."""
    cond = F.lit(True)
    if startkey:
        cond = cond & (F.col("title") >= startkey)
    if endkey:
        cond = cond & (F.col("title") <= endkey)
    return articles.where(cond)


def key_in(articles: DataFrame, keys: list[str]) -> DataFrame:
    """FLT-3: explicit (small) key list."""
    return articles.where(F.col("title").isin(*keys))


def keys_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC-5 + SCL-18: one title per line, stripped, '_' -> ' ', blanks dropped, distinct."""
    k = F.replace(strip_ws(F.col(value_col)), F.lit("_"), F.lit(" "))
    return lines.select(k.alias("key")).where(F.col("key") != "").distinct()


def by_key_list(articles: DataFrame, keys: DataFrame) -> DataFrame:
    """JOIN-3 + JOIN-4 + SET-2: requested documents, plus a NULL-text row per missing key.

    Documents are read once: those asked for (Spark broadcasts a small key list by itself) meet a marker row of each key by
    title, and a marker stays where no document is beside it. Only documents asked for are shuffled.
    """
    k = keys.select(F.col("key").alias("title"))
    asked = articles.join(k, "title", "left_semi").select("title", "text", F.col("aliases").cast(ALIAS_T).alias("aliases"), F.lit(True).alias("found"))
    markers = k.select("title", F.lit(None).cast("string").alias("text"), F.array().cast(ALIAS_T).alias("aliases"), F.lit(False).alias("found"))
    beside = F.max("found").over(Window.partitionBy("title"))
    return asked.unionByName(markers).withColumn("__any", beside).where(F.col("found") | ~F.col("__any")).drop("__any")
