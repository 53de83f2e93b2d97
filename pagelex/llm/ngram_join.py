"""Operator 3, n-gram Jaccard join: exact links between documents by a token-group matrix.

A document's set holds the hashes of its distinct 5-word shingles (A-Z in lower case, words
``[^\\x20\\x09-\\x0D]+``; fewer words: the whole sequence as one). Documents link when
``100 * common >= 75 * together``. Copies share one set; the rest works on the distinct sets.

1. Groups. Sets that agree in a minimum hash meet in a group, under three hash functions, and each is compared
   with the group's most common-place set, its centre. Sets linked so far form one group (others are alone).
2. Matrix. Rows (token, group) hold the union of the prefixes of a group's sets: tokens in order of
   rarity, of which similar sets share one at least. Only tokens that two groups hold matter.
3. Bound. A query set meets the groups that share such a token, at positions and with sizes that leave room for
   75 %. Each group of sets of like size has a bitmap of its whole token union; the query's bits in it, plus its tokens
   that fall on one bit together, are at least its overlap with any member. Groups under 75 % of the query stay shut.
4. The others are opened: the query is verified against each member of a fitting size.

A group of thousands of near copies is one group after step 1, so it costs as many comparisons as it has
members. Components follow from the links by label propagation.

Defined results: a null or wordless text has an empty set (n_shingles 0) and is alone: its component is its own
doc_id; repeated rows are copies; a row of null doc_id takes part and has the component of its copies, null if it
has no other; a component's id is the smallest doc_id in it; extra columns are kept by ``one_of_each``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelex.llm import sets, tokens
from pagelex.llm.common import written

PERCENT = 75
WORDS = 5
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tokens.shingle_hashes(*tokens.word_hashes(data, offsets), WORDS)


def _documents(docs: DataFrame, held) -> DataFrame:
    """A row for each document: doc_id, the key and size of its set (null, 0 if empty); where the task first
    meets the set also its prefix, minimum hashes and how common-place it is."""

    def run(batches):
        seen = set()
        for part, data, offsets in tokens.blocks(batches):
            tok, first = sets.distinct_sorted(*_shingles(data, offsets), held.value)
            key, n = sets.keys(tok, first), np.diff(first)
            fresh = np.fromiter((m > 0 and k not in seen and not seen.add(k) for k, m in zip(key.tolist(), n, strict=True)), bool, len(key))
            some = np.flatnonzero(n > 0)
            least = []
            for seed in SEEDS:
                low = np.zeros(len(n), np.int64)
                if len(some):
                    low[some] = np.minimum.reduceat(tokens.mix(tok ^ np.uint64(seed)), first[some]).view(np.int64)
                least.append(pa.array(low, mask=n == 0))
            common = sets.segment_sums((tok >> np.uint64(sets.LOW_BITS)).astype(np.float64), first) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(key, mask=n == 0), pa.array(n, pa.int32()), *least, pa.array(common),
                sets.lists(tok, first, sets.prefix_sizes(n, PERCENT), fresh),
            ], ["doc_id", "key", "n", "m0", "m1", "m2", "common", "prefix"])

    return docs.mapInArrow(run, "doc_id long, key long, n int, m0 long, m1 long, m2 long, common double, prefix array<long>")


def _fits(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})"


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = docs.sparkSession.sparkContext.broadcast(sets.rarity(docs, lambda data, offsets: _shingles(data, offsets)[0]))

    def doc_sets(data, offsets):
        return sets.distinct_sorted(*_shingles(data, offsets), held.value)

    rows = written(_documents(docs, held), "documents")
    classes = written(
        rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), *[F.min(c).alias(c) for c in ("n", "m0", "m1", "m2", "common")]),
        "classes",
    )

    stars = None
    for m in ("m0", "m1", "m2"):
        centre = classes.groupBy(m).agg(F.max(F.struct("common", F.col("n").alias("nb"), F.col("key").alias("b"))).alias("c"), F.count("*").alias("size")).where("size > 1")
        star = classes.select(m, F.col("key").alias("a"), F.col("n").alias("na")).join(centre.select(m, "c.b", "c.nb"), m)
        star = star.where("a <> b and " + _fits("na", "nb")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        stars = star if stars is None else stars.union(star)
    stars = written(stars.distinct(), "stars")
    near = written(sets.verified(stars, _sets(docs, stars, doc_sets), PERCENT), "links")
    group = sets.components(near)

    # the matrix of tokens and groups
    query = rows.where("prefix is not null").select("key", "n", "prefix").join(group.withColumnRenamed("node", "key"), "key", "left")
    query = query.select("key", "n", F.coalesce("component", "key").alias("g"), F.posexplode_outer("prefix").alias("pos", "tok"))
    token = Window.partitionBy("tok")
    # not written: its rows are dealt by token once, for the window, the groups' rows and the join alike
    query = query.withColumns({"least": F.min("g").over(token), "most": F.max("g").over(token)}).where("least < most").groupBy("tok", "key").agg(
        F.first("n").alias("n"), F.first("g").alias("g"), F.first("pos").alias("pos")
    )
    matrix = query.groupBy("tok", F.col("g").alias("h")).agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.min("pos").alias("at"))
    met = query.join(matrix, "tok").where(f"""g < h and 100 * n >= {PERCENT} * smallest and 100 * largest >= {PERCENT} * n
        and {100 + PERCENT} * least(n - pos, largest - at) >= {PERCENT} * (n + smallest)""")
    met = written(met.groupBy("key", "h").agg(F.first("n").alias("n")), "met")

    # bound a query's overlap with the union of a group, then open the group
    member = classes.select("key", F.col("n").alias("nb")).join(group.withColumnRenamed("node", "key"), "key", "left")
    member = written(
        member.select(F.coalesce("component", "key").alias("h"), F.col("key").alias("b"), "nb").join(met.select("h").distinct(), "h", "left_semi"), "members"
    )
    bits = written(sets.sets_of(docs, met.select("key").union(member.select("b")), "key", doc_sets, as_bits=True), "bits")
    word = member.join(bits, member.b == bits.key).select("h", "nb", F.size("bits").alias("size"), F.posexplode_outer("bits").alias("at", "word"))
    word = word.groupBy("h", "size", "at").agg(F.bit_or("word").alias("word"), F.min("nb").alias("smallest"), F.max("nb").alias("largest"))
    union = word.groupBy("h", "size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("union"), F.min("smallest").alias("smallest"), F.max("largest").alias("largest")
    )
    opened = met.join(union, "h").where(f"100 * n >= {PERCENT} * smallest and 100 * largest >= {PERCENT} * n").join(bits.select("key", "bits"), "key")
    opened = opened.where((F.size("bits") <= 2 * F.size("union")) & (F.size("union") <= 2 * F.size("bits")))  # sizes apart by more never fit
    opened = opened.where(100 * sets.most_shared(F.col("bits"), F.col("n"), F.col("union")) >= PERCENT * F.col("n")).select("key", "n", "h").distinct()
    pairs = written(opened.join(member, "h").where(_fits("n", "nb")).select(F.col("key").alias("a"), "b"), "pairs")
    found = sets.verified(pairs, _sets(docs, pairs, doc_sets), PERCENT)

    whole = sets.components(written(near.union(found), "links"))
    of_class = classes.select("key", "doc_id").join(whole.withColumnRenamed("node", "key"), "key", "left").select("key", "doc_id", F.coalesce("component", "key").alias("component"))
    named = of_class.join(of_class.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("key", "component_id")
    return rows.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles")).join(named, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _sets(docs: DataFrame, pairs: DataFrame, doc_sets) -> DataFrame:
    return sets.sets_of(docs, pairs.select(F.col("a").alias("key")).union(pairs.select("b")), "key", doc_sets)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows, of all their columns, of which one of each component stays: the one of the smallest doc_id (null after all others), of
    several texts of an id the one of the smallest hash. Rows count, not ids: a repeated id keeps a row in each of
    its components, repeated rows stay once. Rows without words stay, all of them."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")).withColumn("id", F.xxhash64("d.doc_id", "d.text"))
    place = F.struct(F.col("d.doc_id").isNull().alias("none"), F.col("d.doc_id").alias("doc_id"), F.col("id"))
    of_row = linked(row.select(F.col("id").alias("doc_id"), F.col("d.text").alias("text"))).where("n_shingles > 0").select(F.col("doc_id").alias("id"), "component_id").distinct()
    first = row.select("id", place.alias("place")).join(of_row, "id").groupBy("component_id").agg(F.min("place").alias("place"))
    kept = row.join(first.select(F.col("place.id").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    wordless = F.coalesce(~F.col("d.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return kept.where(~wordless).unionByName(row.where(wordless)).select("d.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the size of every document's set and its component."""
    from pagelex.llm.common import table

    return linked(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[j:j + 4], ' ') FOR j IN range(1, len(w) - 3)] END)) AS t FROM word),
class AS (SELECT t, len(t) AS n, min(doc_id) AS k FROM s WHERE len(t) > 0 GROUP BY t),
tok AS (SELECT k, n, unnest(t) AS x FROM class),
shared AS (SELECT a.k AS a, b.k AS b, a.n AS na, b.n AS nb, count(*) AS common FROM tok a JOIN tok b ON a.x = b.x AND a.k <> b.k
  AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT a, b FROM shared WHERE 100 * common >= 75 * (na + nb - common)),
reach AS (SELECT k AS a, k AS b FROM class UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS k, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s.t) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM s LEFT JOIN class ON s.t = class.t LEFT JOIN comp USING (k)
"""
