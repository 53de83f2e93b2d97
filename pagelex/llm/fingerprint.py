"""Operator 2, document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame operations.

A paragraph is a line of the text. Its leaves are the MD5s of its blocks of 64 code points, and its node is the MD5 of
its leaves. A section is a run of paragraphs that ends with one whose node starts with 0 to 3 (or with the text),
so that an edit moves few borders; its node is the MD5 of its paragraphs' nodes. The root is the SHA-256 of the
sections' nodes. The fingerprint holds the whole tree, ``root#section|section...``: a section is its node, ``=`` and its
paragraphs, each closed by ``,`` (the last of a section by ``|``), a paragraph is its node, ``:`` and its leaves. Inner nodes are
written by their first 16 hex digits, leaves by 8. Equal roots tell equal texts; else ``changed`` goes down the sections that differ,
and in these to the paragraphs.

Likeness of two fingerprints: 1 if the roots are equal, else twice the number of leaves they share over the
number of both (distinct leaves).

Defined results: a null text is empty, and an empty text is one empty paragraph without leaves; two fingerprints without
leaves and with different roots have likeness 0; documents follow each other by (doc_id, text), a null doc_id
first; the last is followed by the first (of a single row, by itself); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelex.llm.common import let

BLOCK = 64
INNER, SHORT = 16, 8  # hex digits of an inner node and of a leaf in the fingerprint
ROWS = 256  # ids of a bucket in which documents are put in order
NULL_ID = -(1 << 62)


def tree(text: Column) -> Column:
    """A struct: fingerprint, root, leaves (distinct)."""

    def built(leaves: Column) -> Column:
        node = F.transform(leaves, lambda v: F.md5(F.array_join(v, "")))
        return let(node, lambda n: put_together(n, F.transform(leaves, lambda v: F.transform(v, lambda b: F.substring(b, 1, SHORT)))))

    def put_together(node: Column, leaves: Column) -> Column:
        closed = lambda n, x: F.concat(x, F.when(F.substring(n, 1, 1) <= "3", F.lit("|")).otherwise(F.lit(",")))
        sections = lambda entries: F.split(F.array_join(F.zip_with(node, entries, closed), ""), r"\|")
        nodes = F.transform(sections(node), lambda s: F.md5(s))
        paragraphs = F.zip_with(node, leaves, lambda n, v: F.concat(F.substring(n, 1, INNER), F.lit(":"), F.array_join(v, "")))
        return let(nodes, lambda s: F.struct(
            F.concat(root(s), F.lit("#"), F.array_join(F.zip_with(s, sections(paragraphs), lambda n, p: F.concat(F.substring(n, 1, INNER), F.lit("="), p)), "|")).alias("fingerprint"),
            root(s).alias("root"), F.array_distinct(F.flatten(leaves)).alias("leaves"),
        ))

    root = lambda nodes: F.sha2(F.array_join(nodes, ","), 256)
    blocks = lambda p: F.transform(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda b: F.md5(b))
    return let(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), blocks), built)


def likeness(a: Column, b: Column) -> Column:
    """Of two structs of ``tree``."""
    both = F.size(a["leaves"]) + F.size(b["leaves"])
    shared = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    return F.when(a["root"] == b["root"], F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(2.0 * shared / both)


def changed(a: Column, b: Column) -> Column:
    """The paragraphs (numbers from 0) of fingerprint ``a`` that fingerprint ``b`` lacks, found from the root down: none if the roots
    are equal; sections whose node both hold are passed over whole, and only the paragraphs of the others are compared."""

    def sections(f: Column) -> Column:
        paragraphs = lambda s: F.filter(F.split(F.substring_index(s, "=", -1), ","), lambda p: p != "")
        node = lambda x, mark: F.substring_index(x, mark, 1)
        return F.transform(
            F.split(F.substring_index(f, "#", -1), r"\|"),
            lambda s: F.struct(node(s, "=").alias("node"), F.transform(paragraphs(s), lambda p: node(p, ":")).alias("paragraphs")),
        )

    def compared(own: Column, other: Column) -> Column:
        differs = lambda s, of: ~F.array_contains(F.transform(of, lambda x: x["node"]), s["node"])
        open_own = F.flatten(F.transform(own, lambda s: F.transform(s["paragraphs"], lambda p: F.when(differs(s, other), p))))
        open_other = F.flatten(F.transform(F.filter(other, lambda s: differs(s, own)), lambda s: s["paragraphs"]))
        return let(open_other, lambda rest: F.filter(
            F.transform(open_own, lambda p, i: F.when(p.isNotNull() & ~F.array_contains(rest, p), i)), lambda i: i.isNotNull()
        ))

    found = let(sections(a), lambda own: let(sections(b), lambda other: compared(own, other)))
    return F.when(F.substring_index(a, "#", 1) == F.substring_index(b, "#", 1), F.array().cast("array<int>")).otherwise(found)


def _next_bucket(buckets: DataFrame, levels: int = 4) -> DataFrame:
    """bucket, next: each bucket's successor among the distinct ones, the last one's the first. Buckets are put in
    order within buckets of their own, so no task orders more than ROWS of them but at the last level, which has
    ROWS ** levels times fewer."""
    if levels == 0:
        order = Window.orderBy("bucket")
        return buckets.select("bucket", F.coalesce(F.lead("bucket").over(order), F.first("bucket").over(order)).alias("next"))
    upper = F.floor(F.col("bucket") / ROWS).alias("upper")
    low = buckets.select("bucket", upper)
    over = _next_bucket(low.groupBy("upper").agg(F.min("bucket").alias("least")).select(F.col("upper").alias("bucket")), levels - 1)
    least = low.groupBy("upper").agg(F.min("bucket").alias("least"))
    after = over.join(least, over["next"] == least["upper"], "left").select(F.col("bucket").alias("upper"), "least")
    own = low.withColumn("next", F.lead("bucket").over(Window.partitionBy("upper").orderBy("bucket")))
    return own.join(after, "upper").select("bucket", F.coalesce("next", "least").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text of the next document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.floor(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) / ROWS).alias("bucket"))
    order = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("doc_id"), "text")
    placed = rows.select("doc_id", "text", "bucket", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("at"))
    follows = _next_bucket(docs.select(F.floor(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) / ROWS).alias("bucket")).distinct())
    first = placed.where("at = 1").select(F.col("bucket").alias("next"), F.col("text").alias("first"))
    return placed.join(follows.join(first, "next").select("bucket", "first"), "bucket").select("doc_id", "text", F.coalesce("next", "first").alias("next"))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the fingerprints of every text, of its edited text, and their likeness."""
    from pagelex.llm.common import table

    rows = with_next(table(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half))
    made = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    trees = made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("a"), tree(F.col("edited")).alias("e"), tree(F.col("next")).alias("n"))
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", F.col("a.fingerprint").alias("fingerprint"), F.col("e.fingerprint").alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("e")).alias("near_edited"), likeness(F.col("a"), F.col("n")).alias("near_next"),
    )


def _tree_sql(source: str, name: str) -> str:
    return f"""
{name}_p AS (SELECT id, string_split({name}, chr(10)) AS p FROM {source}),
{name}_l AS (SELECT id, [[md5(b) FOR b IN regexp_extract_all(x, '(?s).{{1,{BLOCK}}}')] FOR x IN p] AS leaf FROM {name}_p),
{name}_n AS (SELECT id, leaf, [md5(coalesce(array_to_string(v, ''), '')) FOR v IN leaf] AS node FROM {name}_l),
{name}_e AS (SELECT id, leaf, node, [CASE WHEN n[1] <= '3' THEN '|' ELSE ',' END FOR n IN node] AS mark FROM {name}_n),
{name}_s AS (SELECT id, [md5(s) FOR s IN string_split(array_to_string([node[i] || mark[i] FOR i IN range(1, len(node) + 1)], ''), '|')] AS sections,
  string_split(array_to_string([node[i][1:{INNER}] || ':' || coalesce(array_to_string([b[1:{SHORT}] FOR b IN leaf[i]], ''), '') || mark[i] FOR i IN range(1, len(node) + 1)], ''), '|') AS bodies,
  list_distinct([b[1:{SHORT}] FOR b IN flatten(leaf)]) AS leaves FROM {name}_e),
{name}_t AS (SELECT id, sha256(array_to_string(sections, ',')) AS root,
  array_to_string([sections[i][1:{INNER}] || '=' || bodies[i] FOR i IN range(1, len(sections) + 1)], '|') AS body, leaves FROM {name}_s)"""


def _near_sql(a: str, b: str) -> str:
    return f"""CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE WHEN len({a}.leaves) + len({b}.leaves) = 0 THEN 0.0::DOUBLE
  ELSE 2.0::DOUBLE * len(list_intersect({a}.leaves, {b}.leaves)) / (len({a}.leaves) + len({b}.leaves)) END"""


ORACLE = f"""
WITH t AS (SELECT row_number() OVER w AS id, doc_id, coalesce(text, '') AS own, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS follow
  FROM documents WINDOW w AS (ORDER BY doc_id, text)),
r AS (SELECT *, own[1:length(own) - length(own) // 2] || follow[1:length(own) // 2] AS edited FROM t),
{_tree_sql('r', 'own')},{_tree_sql('r', 'edited')},{_tree_sql('r', 'follow')}
SELECT doc_id, length(own) AS n_chars, sha256(edited) AS edited_sha256, a.root || '#' || a.body AS fingerprint, e.root || '#' || e.body AS edited_fingerprint,
  {_near_sql('a', 'e')} AS near_edited, {_near_sql('a', 'n')} AS near_next
FROM r JOIN own_t a USING (id) JOIN edited_t e USING (id) JOIN follow_t n USING (id)
"""
