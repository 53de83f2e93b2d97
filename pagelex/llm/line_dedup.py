"""Operator 4, line dedup: an exact set-similarity join of the corpus's lines.

A line's tokens are its distinct 5-word shingles (A-Z in lower case, words as ``[^\\x20\\x09-\\x0D]+``), of a line of one to four
words its whole sequence as one, so that only its copies match it. Two lines match when ``100 * common >= 75 * together``; a line goes
when a line at an earlier position (doc_id, line number) matches it. Lines without words always stay.

Copies of a line are one class, so that a line which a third of all documents share is one member of the
join. Classes meet through their prefixes: tokens in order of rarity, of which similar sets share one
at least; the length and positional filters follow in the join's condition; what is left is verified on the full sets.
First each class is compared with the earliest of each token it shares, which settles most members of a group of
near copies in one comparison each. Of what this leaves standing each pair meets once, and a class also meets those that it settled
already; a sketch of each set (a bit for each token) bounds what two sets share before they become a pair.

Defined results: a null text has no lines and stays null; empty texts and lines stay as they are; a null doc_id
comes after all others; lines at the same position (repeated rows) don't remove each other; of ties the
earliest position stays; extra columns are kept by ``without_repeated_lines``, whatever their names. Very long texts and lines are
read whole; sizes from 2**24 - 1 shingles on count as unknown in the filters, which then let pass.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelex.llm import sets, tokens
from pagelex.llm.common import let, written

PERCENT = 75
WORDS = 5
LAST = (1 << 63) - 1
SIZE_BITS = 24
UNKNOWN = (1 << SIZE_BITS) - 1
SKETCH = 4  # words of 64 bits
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
BITS_A_LINE = 32
MARKS = 6
SEVERAL = 8
MOST_BITS = 1 << 30


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Token hashes of the lines with words, each line's first one, and its text and number."""
    low = tokens.lowered(data)
    start, end = tokens.bounds(tokens.in_words(data), offsets)
    feeds = np.flatnonzero(data == 10)
    line = np.searchsorted(feeds, start)  # line feeds of the block before
    first_word = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    head = np.flatnonzero(new)
    h, at = _shingles(tokens.bytes_hashes(low, start, end), np.append(head, len(doc)))
    return h, at, doc[head], line[head] - np.searchsorted(feeds, offsets[doc[head]])


def _shingles(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the WORDS-word windows of each line, in order, and each line's first one; a shorter line is one window."""
    n = np.diff(first)
    last = first[1:]
    # windows over all words, of which those that end in their line count
    windows = np.zeros(len(h), np.uint64)
    whole = max(len(h) - WORDS + 1, 0)
    for j in range(WORDS):
        windows[:whole] = windows[:whole] * MULTIPLIER + h[j : j + whole]
    short = np.flatnonzero(n < WORDS)
    for j in range(WORDS - 1):
        at = short[n[short] > j]
        windows[first[at]] = (windows[first[at]] if j else np.uint64(0)) * MULTIPLIER + h[first[at] + j]
    windows[first[short]] ^= n[short].astype(np.uint64)
    keep = np.ones(len(h), bool)
    for j in range(1, WORDS):  # the last words of a line begin no window, but a short line's first one does
        at = last - j
        keep[at[(n >= j) & (at != first[:-1])]] = False
    keep[first[:-1][n > 0]] = True
    count = np.maximum(n - WORDS + 1, 1)
    return tokens.mix(windows[keep]), np.append(0, np.cumsum(count))


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the row's text), line_no (from 0) of the lines that go, and the position of an earlier line that
    each matches: first_doc_id, first_line_no."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    rank = sets.rarity(docs, lambda data, offsets: _lines(data, offsets)[0])
    held = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches):
        seen = set()
        for part, data, offsets in tokens.blocks(batches):
            h, at, doc, line = _lines(data, offsets)
            tok, first = sets.distinct_sorted(h, at, held.value)
            key, n = sets.keys(tok, first), np.diff(first)
            fresh = np.fromiter((k not in seen and not seen.add(k) for k in key.tolist()), bool, len(key))
            yield pa.RecordBatch.from_arrays([
                pa.array(key), part.column("doc_id").take(pa.array(doc)), part.column("text_hash").take(pa.array(doc)), pa.array(line, pa.int32()), pa.array(n, pa.int32()),
                sets.lists(tok, first, sets.prefix_sizes(n, PERCENT), fresh),
            ], ["key", "doc_id", "text_hash", "line_no", "n", "prefix"])

    lines = written(docs.mapInArrow(run, "key long, doc_id long, text_hash long, line_no int, n int, prefix array<long>"), "lines")
    classes = written(lines.groupBy("key").agg(F.min(F.struct("doc_id", "line_no")).alias("first")), "classes")
    # a posting's place: document order in 15 bits (a hint which line comes first), the set's size and the token's position
    low, high = docs.where(F.col("doc_id") != LAST).agg(F.min("doc_id"), F.max("doc_id")).first()
    order = F.when(F.col("doc_id") == LAST, 32767).otherwise((F.col("doc_id") - F.lit(low or 0)) / (float((high or 0) - (low or 0)) + 1) * 32767).cast("long")
    place = order * (1 << 2 * SIZE_BITS) + F.least(F.col("n"), F.lit(UNKNOWN)).cast("long") * (1 << SIZE_BITS) + F.least(F.col("pos"), F.lit(UNKNOWN))
    posting = lines.where("prefix is not null").select("key", "n", "doc_id", F.posexplode_outer("prefix").alias("pos", "tok")).select("tok", "key", place.alias("place"))
    sorted_ = posting.repartition("tok").sortWithinPartitions("tok")
    shared = written(sorted_.mapInArrow(_shared, "tok long, key long, place long, head long, head_place long"), "shared")
    found = _sets(docs, classes.join(shared.select("key").distinct(), "key", "left_semi"), held)
    size = lambda c: F.shiftright(c, SIZE_BITS).bitwiseAND(UNKNOWN)
    left = lambda c: size(c) - F.col(c).bitwiseAND(UNKNOWN)  # noqa: E731  tokens from the shared one on
    fits = (F.greatest(size("pa"), size("pb")) == UNKNOWN) | (
        (100 * F.least(size("pa"), size("pb")) >= PERCENT * F.greatest(size("pa"), size("pb")))
        & ((100 + PERCENT) * F.least(left("pa"), left("pb")) >= PERCENT * (size("pa") + size("pb")))
    )
    stars = shared.select(F.col("key").alias("a"), F.col("place").alias("pa"), F.col("head").alias("b"), F.col("head_place").alias("pb")).where(fits & (F.col("a") != F.col("b")))
    links = _links(stars, found)
    # the others: each pair once, but for those of two that went; both sides are the same rows, so they are dealt by token once
    gone = links.select(F.col("a").alias("key"), F.lit(True).alias("gone")).distinct()
    posted = shared.select("tok", "key", "place").join(found.select("key", "sketch").join(gone, "key", "left"), "key")
    a, b = (posted.select("tok", F.col("key").alias(x), F.col("place").alias(f"p{x}"), F.col("sketch").alias(f"s{x}"), F.col("gone").alias(f"gone_{x}")) for x in "ab")
    once = (F.col("a") < F.col("b")) & (F.col("gone_a").isNull() | F.col("gone_b").isNull())
    pairs = a.join(b, "tok").where(once & fits & ((F.greatest(size("pa"), size("pb")) == UNKNOWN) | _may_match(size("pa"), size("pb"))))
    links = links.union(_links(pairs, found))
    near = links.groupBy(F.col("a").alias("key")).agg(F.min("first").alias("other"))
    best = classes.join(near, "key", "left").select("key", F.least("first", "other").alias("first"))
    gone = lines.select("key", "doc_id", "text_hash", "line_no").join(best, "key").where(F.struct("doc_id", "line_no") > F.col("first"))
    return gone.select(F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "text_hash", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"))


def _may_match(na, nb):
    """Whether sets of these sizes may share enough by their sketches: a set's tokens beyond its ones fell together, any of them may be
    shared, the others only where both have a one."""
    ones = lambda c: F.aggregate(c, F.lit(0), lambda s, w: s + F.bit_count(w))
    na, nb = (F.col(n) if isinstance(n, str) else n for n in (na, nb))
    both = ones(F.zip_with("sa", "sb", lambda x, y: x.bitwiseAND(y)))
    most = lambda common: F.least(common + na - ones(F.col("sa")), common + nb - ones(F.col("sb")))
    return let(both, lambda common: (100 + PERCENT) * most(common) >= PERCENT * (na + nb))


def _shared(batches):
    """Of postings sorted by token those of tokens that two classes hold, with the token's head, its earliest class (of a token that goes on
    in further batches the earliest one of its first batch), and the head's place; a class that
    several tasks met stands once (again in a later batch at most). Holds one posting of a token beyond a batch."""
    held = None  # the last token's head (token, key, place), and whether another class was met
    for batch in batches:
        if not batch.num_rows:
            continue
        tok, key, place = (batch.column(c).to_numpy() for c in ("tok", "key", "place"))
        first = np.flatnonzero(np.append(True, tok[1:] != tok[:-1]))
        size = np.diff(np.append(first, len(tok)))
        head_place = np.minimum.reduceat(place, first)
        head = key[np.minimum.reduceat(np.where(place == np.repeat(head_place, size), np.arange(len(tok)), len(tok)), first)]
        goes_on = held is not None and held[0][0] == tok[0]
        if goes_on:
            (_, head[0], head_place[0]), _ = held
        other = key != np.repeat(head, size)
        many = np.logical_or.reduceat(other, first)
        if goes_on and not held[1] and many[0]:  # the posting that waited for another class
            tok, key, place = (np.append(x, y) for x, y in zip((tok, key, place), held[0], strict=True))
        last = (int(tok[first[-1]]), int(head[-1]), int(head_place[-1])), bool(many[-1] or (goes_on and len(first) == 1 and held[1]))
        if goes_on:
            many[0] |= held[1]
        group = np.repeat(np.arange(len(first)), size)
        group = np.append(group, np.zeros(len(tok) - len(group), np.int64))
        rows = np.flatnonzero(many[group])
        held = last
        if len(rows):
            # of a class's places the first one
            order = rows[np.lexsort((place[rows], key[rows], group[rows]))]
            once = np.append(True, (group[order[1:]] != group[order[:-1]]) | (key[order[1:]] != key[order[:-1]]))
            order = order[once]
            at = group[order]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tok[order], key[order], place[order], head[at], head_place[at])], ["tok", "key", "place", "head", "head_place"])


def _marks(key: np.ndarray, doc: np.ndarray, line: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits of a class at a place, a row each."""
    h = tokens.mix(key.view(np.uint64) ^ tokens.mix(doc.astype(np.int64).view(np.uint64) * MULTIPLIER + line.astype(np.uint64)))
    step = tokens.mix(h) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(MARKS, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame, held) -> DataFrame:
    """key, first, tokens, sketch of the wanted classes (key, first), made again from the texts, each where it stands first: a Bloom filter of
    these places says which ones, ``BITS_A_LINE`` bits and ``MARKS`` marks for each, and lets some ten-thousandths of the others pass, which do no harm (a class at a later place, too, only adds a link to that place).
    So no set is shuffled; only where a class comes back more than ``SEVERAL`` times (rows repeated as they are) all but one go."""
    bits = min(max(1 << 16, 1 << (BITS_A_LINE * wanted.count()).bit_length()), MOST_BITS)

    def marks(batches):
        for batch in batches:
            bit = _marks(*(batch.column(c).to_numpy() for c in ("key", "doc_id", "line_no")), bits).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(np.left_shift(1, bit & 63))], ["at", "bit"])

    places = wanted.select("key", "first.doc_id", "first.line_no").mapInArrow(marks, "at long, bit long")
    got = places.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    kept = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for part, data, offsets in tokens.blocks(batches):
            h, at, doc, line = _lines(data, offsets)
            tok, first = sets.distinct_sorted(h, at, held.value)
            key, n = sets.keys(tok, first), np.diff(first)
            bit = _marks(key, part.column("doc_id").to_numpy()[doc], line, bits)
            pick = ((kept.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1).all(1)
            if pick.any():
                tok, first = tok[np.repeat(pick, n)], np.append(0, np.cumsum(n[pick]))
                sketch = sets.sketches(tok, first, SKETCH).ravel()
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sketch) + 1, SKETCH), pa.int32()), pa.array(sketch))
                at = pa.StructArray.from_arrays([part.column("doc_id").take(pa.array(doc[pick])), pa.array(line[pick], pa.int32())], ["doc_id", "line_no"])
                yield pa.RecordBatch.from_arrays([pa.array(key[pick]), at, sets.lists(tok, first, n[pick]), rows], ["key", "first", "tokens", "sketch"])

    found = written(docs.select("doc_id", "text").mapInArrow(run, "key long, first struct<doc_id:long,line_no:int>, tokens array<long>, sketch array<long>"), "sets")
    most = found.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    if most <= SEVERAL:
        return found
    return written(found.groupBy("key").agg(F.min("first").alias("first"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")), "sets")


def _links(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, first: the similar pairs of classes of which b comes first, and where."""
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    one = found.select(F.col("key").alias("a"), F.col("tokens").alias("ta"), F.col("first").alias("own"))
    two = found.select(F.col("key").alias("b"), F.col("tokens").alias("tb"), F.col("first").alias("other"))
    links = pairs.join(one, "a").join(two, "b").where((F.col("own") != F.col("other")) & sets.similar(F.col("ta"), F.col("tb"), PERCENT))
    ordered = F.when(F.col("own") > F.col("other"), F.struct("a", "b", F.col("other").alias("first"))).otherwise(
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("own").alias("first"))
    )
    return written(links.select(ordered.alias("x")).select("x.*").distinct(), "links")


def without_repeated_lines(docs: DataFrame, keep_emptied: bool = True) -> DataFrame:
    """The documents, of all their columns, without the lines that an earlier line matches; with ``keep_emptied`` false also without the
    rows that lose every line with a word. Rows are told apart by id and text, so that
    several texts of one id, or of none, each lose their own lines only."""
    gone = repeated(docs).groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("lines"))
    kept = F.array_join(F.filter(F.split("d.text", "\n", -1), lambda x, i: ~F.array_contains("g.lines", i)), "\n")
    mine = docs.select("*").alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.text_hash")), "left")
    text = F.when(F.col("g.lines").isNull(), F.col("d.text")).otherwise(kept)
    if not keep_emptied:
        mine = mine.where(F.col("g.lines").isNull() | kept.rlike(r"[^\x20\x09-\x0D]"))
    return mine.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the lines of every document that go, per document: how many lines it has and which ones go."""
    from pagelex.llm.common import table

    docs = table(spark, sf_dir, "documents")
    gone = repeated(docs).groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    count = docs.select("doc_id", F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"))
    return count.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")), "left").select(
        "d.doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("gone", lambda x: x.cast("string")), " "), F.lit("")).alias("removed"),
    )


ORACLE = r"""
WITH line AS (
  SELECT doc_id, i - 1 AS line_no, list_filter(regexp_split_to_array(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
s AS (SELECT doc_id, line_no, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[j:j + 4], ' ') FOR j IN range(1, len(w) - 3)] END)) AS t FROM line WHERE len(w) >= 1),
class AS (SELECT t, len(t) AS n, row_number() OVER () AS k, min((doc_id, line_no)) AS first FROM s GROUP BY t),
tok AS (SELECT k, n, unnest(t) AS x FROM class),
df AS (SELECT x, count(*) AS f FROM tok GROUP BY x),
ranked AS (SELECT k, n, x, row_number() OVER (PARTITION BY k ORDER BY f, x) AS r FROM tok JOIN df USING (x)),
prefix AS (SELECT k, n, x FROM ranked WHERE r <= n - ceil(0.75 * n) + 1),
pair AS (SELECT DISTINCT a.k AS a, b.k AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.k <> b.k AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
link AS (SELECT a, b FROM pair JOIN class ca ON ca.k = a JOIN class cb ON cb.k = b
  WHERE 100 * len(list_intersect(ca.t, cb.t)) >= 75 * (ca.n + cb.n - len(list_intersect(ca.t, cb.t)))),
best AS (SELECT k, least(c.first, coalesce(m.first, c.first)) AS first FROM class c
  LEFT JOIN (SELECT a, min(first) AS first FROM link JOIN class ON k = b GROUP BY a) m ON m.a = c.k),
gone AS (SELECT doc_id, list(DISTINCT line_no ORDER BY line_no) AS g FROM s JOIN class USING (t) JOIN best USING (k) WHERE (doc_id, line_no) > best.first GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
  coalesce(array_to_string(g, ' '), '') AS removed
FROM documents LEFT JOIN gone ON documents.doc_id IS NOT DISTINCT FROM gone.doc_id
"""
