"""Operator 5, benchmark decontamination: a size-partitioned MinHash containment search, in DataFrame operations.

An item's set holds its distinct 5-word shingles (an item of fewer words: its whole sequence). A document
contains an item when ``100 * shared >= 75 * size of the item's set``, however long the document is.

Items are partitioned by size (powers of two). Each item is indexed by its smallest hashes, as many as an item
of its partition's largest size can lack at 75 %, plus one: a document that contains it holds one of these at least,
so the search loses nothing. A document's shingles are looked up in that index, and each candidate is
verified on the exact sets within the same row; only what is found is shuffled.

The index is broadcast in blocks of about ``BLOCK`` shingles: a larger benchmark takes further passes over the
documents. A block's keys go with their items' numbers alone, and each item's shingles go once. Defined results: null or wordless texts contain nothing and are contained in nothing; repeated
documents are judged each on its text, and give one row for an id and item; repeated items count as one row each
of their item_id, of which the largest share is told; null ids stay null; extra columns are kept by ``without_leaks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelex.llm.common import let
from pagelex.llm.native import windows, word_hashes

PERCENT = 75
WORDS = 5
BLOCK = 1_000_000


def index(items: DataFrame) -> DataFrame:
    """item_id, n, shingles (distinct), sketch (its smallest hashes) and words (of a shingle) of the items with words."""
    h = items.select("item_id", word_hashes(F.col("text")).alias("h")).where(F.size("h") > 0)
    pick = F.when(F.size("h") >= WORDS, windows(F.col("h"), WORDS))
    for k in range(WORDS - 1, 0, -1):
        pick = pick.when(F.size("h") == k, windows(F.col("h"), k))
    sets = h.select("item_id", F.least(F.size("h"), F.lit(WORDS)).alias("words"), F.array_distinct(pick).alias("shingles"))
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("shingles"))) + 1) - 1  # of the item's partition
    lack = (largest - F.ceil(largest * PERCENT / 100) + 1).cast("int")
    order = F.transform("shingles", lambda s: F.struct(F.xxhash64(F.lit(1), s).alias("o"), s.alias("s")))
    return sets.select("item_id", "words", "shingles", F.size("shingles").alias("n"), F.transform(F.slice(F.array_sort(order), 1, lack), lambda x: x["s"]).alias("sketch"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, n_item, n_shared of every document row that contains an item."""
    table = index(items)
    size, kinds = table.agg(F.sum("n"), F.collect_set("words")).first()
    blocks = -(-(size or 0) // BLOCK) or 1
    h = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("h"))
    both = lambda a: F.concat(*[windows(a, k) for k in sorted({WORDS, *kinds})])
    sets = h.select("doc_id", "text_hash", let(F.col("h"), both).alias("s"))
    probe = sets.select("doc_id", "text_hash", "s", F.explode_outer("s").alias("key"))
    found = None
    numbered = table.withColumn("item", F.xxhash64("item_id", "shingles")).dropDuplicates(["item"])  # repeated items are one
    for block in range(blocks):
        part = numbered.where(F.pmod("item", F.lit(blocks)) == block)
        keys, sets = part.select("item", F.explode("sketch").alias("key")), part.select("item", "item_id", "n", "shingles")
        hit = probe.join(F.broadcast(keys), "key").drop("key").join(F.broadcast(sets), "item")
        hit = hit.select("doc_id", "text_hash", "item_id", "n", F.size(F.array_intersect("shingles", "s")).alias("shared"))
        found = hit if found is None else found.union(hit)
    found = found.where(100 * F.col("shared") >= PERCENT * F.col("n"))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct(F.col("shared") / F.col("n"), F.col("n"), F.col("shared"))).alias("x")).select(
        "doc_id", "text_hash", "item_id", F.col("x.n").cast("long").alias("n_item"), F.col("x.shared").cast("long").alias("n_shared")
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, of all their columns, whose text contains no item."""
    gone = leaks(docs, items).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"]), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every pair of a document and a benchmark item that it contains."""
    from pagelex.llm.common import table

    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("x")).select("doc_id", "item_id", "x.n_item", "x.n_shared")


ORACLE = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, k, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS s FROM (SELECT item_id, w, least(len(w), 5) AS k FROM iw WHERE len(w) > 0)),
d AS (SELECT DISTINCT doc_id, k, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS s FROM dw, (SELECT DISTINCT k FROM i)),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS n_item, count(*) AS n_shared FROM d JOIN i USING (k, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n)
"""
