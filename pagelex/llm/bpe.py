"""Operator 1, byte-level BPE: encoding and decoding by the ranks of a public tokenizer's file.

Splitting: the tokenizer's pattern, with numpy on blocks of texts. Merging: Spark higher-order functions
fold the ranked merges over the byte arrays of distinct words; the ranks are a literal, the merge of two neighbours'
ids being looked up by both ids in a hashed bucket. The ``WORDS`` most frequent words of the whole corpus (nineteen in
twenty occurrences) are folded so, once, and their ids, of bounded size, are broadcast. Folding the rare rest too goes
beyond the time limit (README), so each task merges those, once for each distinct word, by the same rule in Python;
words of over ``LONG`` bytes with a heap, since a plain search's time grows with the square of a word's length. What a
word encodes to never depends on the way. Decoding joins the pieces' bytes, a literal too, as hexadecimal text.

Defined results: a null or empty text has no ids and decodes to nothing; repeated rows are encoded each; null ids
stay null; special tokens are ordinary text; extra columns are ignored by ``encode``.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import let, written

WORDS = 1 << 18
LONG = 64
FLUSH = 300_000
BUCKETS = 1 << 15
NONE = 1 << 30
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


# ---- splitting


def classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        k = kind.get(unicodedata.category(chr(c))[0])
        if k:
            out[c] = k
    for a, b in ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[a : b + 1] = SPACE
    return out


def split(c: np.ndarray, edge: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Starts of the words in code points ``c``; ``edge`` is true at each text's first one.

    Letters, numbers and other signs form words of their own, each with one blank (U+0020) before it. White space
    leaves its last character to what follows: joined to it if a blank, else a word alone. An apostrophe that
    begins a word takes s, t, m, d, re, ve or ll behind it."""
    n = len(c)
    kind = table[c]
    run = np.ones(n, bool)
    run[1:] = (kind[1:] != kind[:-1]) | edge[1:]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = (c[:-1] == 32) & ~edge[1:]
    start = run & ((kind == SPACE) | ~blank_before)
    after_space = np.flatnonzero(run[1:] & ~edge[1:] & (kind[:-1] == SPACE)) + 1
    start[after_space - 1] = True  # the last of the white space
    mark = np.flatnonzero((c == 39) & run & ~blank_before)
    if len(mark):
        at = lambda i: np.where((i < n) & ~edge[np.minimum(i, n - 1)], c[np.minimum(i, n - 1)], 0)
        one = at(mark + 1)
        two = np.where(one > 0, at(mark + 2), 0)
        pair = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        size = np.where(pair, 3, np.where(np.isin(one, (100, 109, 115, 116)), 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        end = mark + size
        start[end[end < n]] = True
    return np.flatnonzero(start)


class Words:
    """The words of a block: start, end (code points), first word of each text, hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.text = data.tobytes().decode("utf-8")
        c = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        at = lead[offsets]
        edge = np.zeros(len(c) + 1, bool)
        edge[at] = True
        self.start = split(c, edge[:-1], table) if len(c) else np.zeros(0, np.int64)
        self.end = np.append(self.start[1:], len(c))
        self.first = np.searchsorted(self.start, at)
        self.hash = hashes(c, self.start, self.end)

    def word(self, i: int) -> str:
        return self.text[self.start[i] : self.end[i]]


def hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    base = tokens._P
    total = np.zeros(len(c) + 1, np.uint64)
    np.cumsum((c.astype(np.uint64) + np.uint64(1)) * tokens.powers(base, len(c)), out=total[1:])
    scale = tokens.powers(tokens._inverse(int(base)), len(c) + 1)[start]
    return tokens.mix((total[end] - total[start]) * scale + (end - start).astype(np.uint64) * tokens._Q)


# ---- merging


def merge_literal(ranks: dict[bytes, int]) -> Column:
    """struct(k, v): per bucket, the pairs of ids (left * 2**20 + right) that merge, and the ids they make."""
    keys, made = [[] for _ in range(BUCKETS)], [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
            if left is not None and right is not None:
                bucket = (left * 31 + right * 7919) % BUCKETS
                keys[bucket].append((left << 20) + right)
                made[bucket].append(rank)
    return F.from_json(F.lit(json.dumps({"k": keys, "v": made}, separators=(",", ":"))), "k array<array<bigint>>, v array<array<int>>")


def fold(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a word: its bytes, then the pair of the lowest rank (the leftmost of ties) merged until none merges."""
    merges = merge_literal(ranks)
    keys, made = merges["k"], merges["v"]
    single = F.split(F.lit(",".join(str(ranks[bytes([b])]) for b in range(256))), ",").cast("array<int>")
    first = F.transform(F.regexp_extract_all(F.hex(word), F.lit(".."), F.lit(0)), lambda h: F.get(single, F.conv(h, 16, 10).cast("int")))

    def merged(left: Column, right: Column) -> Column:
        bucket = F.pmod(left * 31 + right * 7919, F.lit(BUCKETS))
        return let(bucket, lambda b: F.coalesce(F.get(F.get(made, b), (F.array_position(F.get(keys, b), left.cast("long") * (1 << 20) + right) - 1).cast("int")), F.lit(NONE)))

    def step(ids: Column, _: Column) -> Column:
        pairs = F.zip_with(ids, F.slice(ids, 2, NONE), lambda a, b: F.when(b.isNotNull(), merged(a, b)).otherwise(F.lit(NONE)))

        def apply(found: Column) -> Column:
            return let(F.array_min(found), lambda m: F.when(F.coalesce(m, F.lit(NONE)) == NONE, ids).otherwise(
                let(F.array_position(found, m).cast("int"), lambda p: F.concat(F.slice(ids, 1, p - 1), F.array(m), F.slice(ids, p + 2, NONE)))
            ))

        return let(pairs, apply)

    return let(first, lambda f: F.when(F.size(f) < 2, f).otherwise(F.aggregate(F.sequence(F.lit(2), F.size(f)), f, step)))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``fold``, for one word."""
    if len(word) > LONG:
        return merge_long(word, ranks)
    part = [word[i : i + 1] for i in range(len(word))]
    rank = [ranks.get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while rank and (least := min(rank)) < NONE:
        i = rank.index(least)
        part[i] += part.pop(i + 1)
        rank.pop(i)
        if i < len(rank):
            rank[i] = ranks.get(part[i] + part[i + 1], NONE)
        if i:
            rank[i - 1] = ranks.get(part[i - 1] + part[i], NONE)
    return [ranks[p] for p in part]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, in n log n: a heap of (rank, position) over a linked list of pieces."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != to:
            continue
        alive[j], end[i], after[i] = False, to, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


# ---- the corpus


def frequent_words(docs: DataFrame, table, most: int = WORDS) -> DataFrame:
    """The words that occur at least t times, t being the smallest number from 2 on that at most ``most`` words reach
    (rounded up to a sixteenth of a power of two)."""

    def run(batches):
        count: dict[str, int] = {}
        for _, data, offsets in tokens.blocks(batches):
            w = Words(data, offsets, table.value)
            _, at, n = np.unique(w.hash, return_index=True, return_counts=True)
            for i, k in zip(at.tolist(), n.tolist(), strict=True):
                word = w.word(i)
                count[word] = count.get(word, 0) + k
            if len(count) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])
                count.clear()
        yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])

    words = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words.where(f"n > 1 and octet_length(word) <= {LONG}"), "words")
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, least = 0, 1 << 30
    for s, n in steps:
        total += n
        if total > most:
            break
        least = s
    return words.where(step >= least).select("word")


def _dictionary(words: DataFrame, ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """The words' hashes in order with a table over their top bits, and their ids."""
    got = words.select("word", fold(F.col("word"), ranks).alias("ids")).toArrow().combine_chunks()
    text = got.column("word").to_pylist()
    size = np.array([len(x) for x in text], np.int64)
    end = np.cumsum(size)
    c = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
    h = hashes(c, end - size, end) if len(text) else np.zeros(0, np.uint64)
    ids = got.column("ids").combine_chunks()
    offsets = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy(zero_copy_only=False).astype(np.int32)
    order = np.argsort(h)
    count = np.diff(offsets)[order]
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(offsets[:-1][order] - first[:-1], count) + np.arange(first[-1])
    h = h[order]
    return {"hash": h, "top": tokens.hash_index(h), "first": first.astype(np.int32), "ids": flat[at]}


def encode(docs: DataFrame, ranks: dict[bytes, int], most: int = WORDS) -> DataFrame:
    """doc_id, ids (array of int) of every row."""
    context = docs.sparkSession.sparkContext
    table = context.broadcast(classes())
    known = context.broadcast(_dictionary(frequent_words(docs, table, most), ranks))  # at most ``most`` words of LONG bytes
    pieces = context.broadcast(ranks)  # the tokenizer's own table

    def run(batches):
        d, ranks, memo = known.value, pieces.value, {}
        for part, data, offsets in tokens.blocks(batches):
            w = Words(data, offsets, table.value)
            number = tokens.find(d["hash"], d["top"], w.hash)
            rest = np.flatnonzero(number < 0)
            kinds, at, which = np.unique(w.hash[rest], return_index=True, return_inverse=True)
            own = []
            for h, i in zip(kinds.tolist(), rest[at].tolist(), strict=True):
                ids = memo.get(h)
                if ids is None:
                    ids = memo[h] = merge(w.word(i).encode(), ranks)
                own.append(ids)
            if len(memo) > FLUSH:
                memo.clear()
            known_first = d["first"].astype(np.int64)
            first = np.concatenate([known_first, known_first[-1] + np.cumsum([len(x) for x in own], dtype=np.int64)])
            flat = np.concatenate([d["ids"], np.array([x for ids in own for x in ids], np.int32)])
            number[rest] = len(known_first) - 1 + which
            count = first[number + 1] - first[number]
            total = np.concatenate([[0], np.cumsum(count)])
            ids = flat[np.repeat(first[number] - total[:-1], count) + np.arange(total[-1])]
            lists = pa.ListArray.from_arrays(pa.array(total[w.first], pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for."""
    piece = [""] * (max(ranks.values()) + 1)
    for p, rank in ranks.items():
        piece[rank] = p.hex()
    table = F.split(F.lit(",".join(piece)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = read_ranks(path)
    coded = encode(docs, ranks)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every text encoded and decoded again."""
    from pagelex.llm.common import table

    return digest(table(spark, sf_dir, "documents"))
