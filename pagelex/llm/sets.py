"""Sets of 64-bit tokens for the exact set-similarity joins: rarity order, prefixes, verification, components.

A token is relabelled so that its number's order is its rarity order: the top 18 bits are the rank
of its bucket by the corpus count (a table of 2**18 numbers whatever the input), the low 45 bits
keep the hash. Any one order gives the same results; rarity makes prefixes selective. A set's key is a 64-bit hash
of its tokens: copies share it, and different sets do with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import let, written

BUCKETS = 1 << 18
PARTS = 64
LOW_BITS = 45
LOW = np.uint64((1 << LOW_BITS) - 1)
BLOOM_BITS = 1 << 23


def rarity(docs: DataFrame, hashes) -> np.ndarray:
    """The rank of each bucket by its count over all texts; ``hashes(data, offsets)`` gives a block's tokens.
    Each task sends its counts in ``PARTS`` arrays, which are added up by part."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, data, offsets in tokens.blocks(batches):
            total += np.bincount((hashes(data, offsets) >> np.uint64(LOW_BITS + 1)).astype(np.int64), minlength=BUCKETS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(total, PARTS)], pa.binary())], ["part", "counts"])

    def add(batches):  # one array at a time
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, own in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(own.as_buffer(), np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "counts"])

    each = docs.select("text").mapInArrow(run, "part int, counts binary")
    counts = each.repartition(PARTS, "part").mapInArrow(add, "part int, counts binary").toArrow()
    total = np.zeros((PARTS, BUCKETS // PARTS), np.int64)
    for part, own in zip(counts.column("part").to_pylist(), counts.column("counts").to_pylist(), strict=True):
        total[part] = np.frombuffer(own, np.int64)
    rank = np.empty(BUCKETS, np.uint32)
    rank[np.lexsort((np.arange(BUCKETS), total.ravel()))] = np.arange(BUCKETS, dtype=np.uint32)
    return rank


def distinct_sorted(h: np.ndarray, first: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct relabelled tokens of each set, rarest first, and each set's first one."""
    x = h >> np.uint64(1)
    tok = (rank[(x >> np.uint64(LOW_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(LOW_BITS)) | (x & LOW)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(tok)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(first) < 65_000 else np.int64), kind="stable")]
    tok, owner = tok[order], owner[order]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (owner[1:] != owner[:-1])
    tok, owner = tok[new], owner[new]
    return tok, np.searchsorted(owner, np.arange(len(first)))


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def keys(tok: np.ndarray, first: np.ndarray) -> np.ndarray:
    return tokens.mix(segment_sums(tokens.mix(tok + np.uint64(1)), first) + np.diff(first).astype(np.uint64)).view(np.int64)


def lists(values: np.ndarray, first: np.ndarray, size: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
    """The first ``size`` tokens of each set as a list column; null where ``there`` is false."""
    if there is not None:
        size = np.where(there, size, 0)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    mask = None if there is None else pa.array(~there)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(values[at].view(np.int64)), mask=mask)


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of which similar sets share one at least: n - ceil(percent * n / 100) + 1."""
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def bloom(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of BLOOM_BITS bits, whatever the number of ids: it lets others pass, and loses none."""
    bit = ids.select(F.pmod(F.col(column), F.lit(BLOOM_BITS)).alias("bit"))
    got = bit.groupBy(F.expr("bit div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")).toArrow()
    words = np.zeros(BLOOM_BITS >> 5, np.uint64)
    words[got.column("at").to_numpy().astype(np.int64)] = got.column("bits").to_numpy().view(np.uint64)
    return words


def passes(filter_: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = np.mod(key, BLOOM_BITS)
    return (filter_[bit >> 5] >> (bit & 31).astype(np.uint64)) & np.uint64(1) == 1


def bitmaps(tok: np.ndarray, first: np.ndarray, pick: np.ndarray) -> pa.Array:
    """Each picked set as a bitmap of 4 to 8 bits a token (a power of two, 64 at least), bit ``token % bits``."""
    out = []
    for i in pick.tolist():
        t = tok[first[i] : first[i + 1]]
        words = np.zeros(max(1, 1 << int(4 * len(t) - 1).bit_length() >> 6), np.uint64)
        at = t & np.uint64(64 * len(words) - 1)
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        out.append(words.view(np.int64))
    cut = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(out)))


def sketches(tok: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
    """Each set as a bitmap of ``words`` words, bit ``token % bits``: one row of words a set."""
    out = np.zeros((len(first) - 1) * words, np.uint64)
    at = tok & np.uint64(64 * words - 1)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first)) * words
    np.bitwise_or.at(out, owner + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out.view(np.int64).reshape(-1, words)


def sets_of(docs: DataFrame, ids: DataFrame, column: str, sets, as_bits: bool = False) -> DataFrame:
    """key, n, tokens (or bits) of the sets whose keys are in ``ids``, made again from the texts; ``sets(data,
    offsets)`` gives a block's (tokens, first). Each task sends a set once."""
    held = docs.sparkSession.sparkContext.broadcast(bloom(ids, column))
    name = "bits" if as_bits else "tokens"

    def run(batches):
        seen = set()
        for _, data, offsets in tokens.blocks(batches):
            tok, first = sets(data, offsets)
            key, n = keys(tok, first), np.diff(first)
            pick = np.flatnonzero(passes(held.value, key) & (n > 0))
            pick = np.array([i for i in pick if key[i] not in seen and not seen.add(key[i])], np.int64)
            if len(pick):
                full = bitmaps(tok, first, pick) if as_bits else lists(tok, first, np.where(np.isin(np.arange(len(n)), pick), n, 0)).take(pa.array(pick))
                yield pa.RecordBatch.from_arrays([pa.array(key[pick]), pa.array(n[pick], pa.int32()), full], ["key", "n", name])

    made = docs.select("text").mapInArrow(run, f"key long, n int, {name} array<long>")
    wanted = ids.select(F.col(column).alias("key")).distinct()
    return made.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("n").alias("n"), F.first(name).alias(name))


def most_shared(bits: Column, n: Column, other: Column) -> Column:
    """An upper bound of the tokens that a set of n tokens shares with another set or union, of both bitmaps: the bits
    in both, plus the set's tokens that fall on a bit together. A bitmap of twice the length is halved first."""

    def halved(a: Column, b: Column) -> Column:
        return F.when(F.size(a) > F.size(b), F.zip_with(F.slice(a, F.lit(1), F.size(b)), F.slice(a, F.size(b) + 1, F.size(b)), lambda x, y: x.bitwiseOR(y))).otherwise(a)

    def counted(a: Column) -> Column:
        ones = lambda x: F.aggregate(x, F.lit(0), lambda s, w: s + F.bit_count(w))
        return ones(F.zip_with(a, halved(other, bits), lambda x, y: x.bitwiseAND(y))) + n - ones(a)

    return let(halved(bits, other), counted)


def similar(a: Column, b: Column, percent: int) -> Column:
    """Jaccard of two distinct token arrays, in whole numbers."""
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set keys whose sets are similar."""
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").where(similar(F.col("ta"), F.col("tb"), percent)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of an undirected graph: each node takes the smallest label around it and
    then its label's label, until nothing changes. Each round is written to the shared folder."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    label = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "label")
    while True:
        around = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("around"))
        near = label.join(around, "node").select("node", "label", F.least("label", "around").alias("near"))
        far = label.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = written(near.join(far, "near").select("node", "label", F.least("near", "far").alias("new")), "label")
        if new.where("new <> label").isEmpty():
            return new.select("node", F.col("new").alias("component"))
        label = new.select("node", F.col("new").alias("label"))
