"""Operator 6, LM scoring: logistic context mixing over counts of all contexts.

A text is its words (A-Z in lower case, ``[^\\x20\\x09-\\x0D]+``) and one end. Every token of the vocabulary has a path of
bits. The ``WORDS`` most frequent training tokens are dealt into 31 classes of equal mass: five bits for the class, then
the token's rank in it. All others are the 32nd class, and go on with the first bits of their hash, as many as it
takes to number them all; those that still share a path are told apart by their share of it.

Each bit is predicted from how often its node's two sides followed in the training documents, in four contexts: none, the
classes of the two tokens before, the token before, both tokens before. Counts are summed over all training documents: they grow
with the corpus, and contexts share nothing. Log odds are mixed with weights that a gate picks by the bit and by how often the
contexts were seen, and the result is refined by an adaptive table over bit and log odds. Weights and table learn online, batch by
batch, each token from the counts without itself; they are summed over all tasks, weights averaged by the tokens that they saw.
Scoring uses the finished model, so that a text's score depends on nothing but the text and the training documents.

Texts are written once as ranks of tokens, in blocks. The bits of the class and those after it are learned and scored one after
the other. For the first, tokens are dealt by the token before (by both before, if it is heavy), for the others by the classes of
the token before and of the token itself: so every count that a part needs stands in it, but for those by pairs of classes and by
heavy tokens, which are broadcast. What is dealt are packed columns, a few bytes a token, and what comes back is a sum for each text and
task. Nothing else is shuffled or written by token, and what was shuffled for one step goes before the next.

A training document is one whose crc32(doc_id as text) mod 10 is not 0 (null id: it is none). Broadcast are, of fixed size at most:
the frequent tokens, counts of the classes that follow a pair of classes or one of the at most ``HEAVY`` heavy tokens, and the weights. A
part holds ``PART`` tokens or, of large inputs, a ``PARTS``-th of all; a pair of classes is in one part however large it is.

Defined results: a null text is empty, its only token the end; without training documents base_score is 0 and an unknown
token within its path costs nothing; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import fold_of, shuffles_released, written

WORDS = 1 << 18
FLUSH = 400_000
U = np.uint64
END = U(0x452821E638D01377)
BITS = 5
CLASSES = 1 << BITS
RARE = CLASSES - 1
OTHER = U(1 << 63)
INPUTS = 5  # four contexts, and one
BLOCK = 1 << 20
PART = 1 << 18
PARTS = 1 << 10
HEAVY = 1 << 10
BATCH = 10_000
RUN = 256
STEPS = 24
LIMIT = 8.0


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block, each text closed by the end, and each text's first one."""
    h, first = tokens.word_hashes(data, offsets)
    texts = len(first) - 1
    out = np.full(len(h) + texts, END, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(texts), np.diff(first))] = h
    return out, first + np.arange(texts + 1)


def count_tokens(docs: DataFrame) -> DataFrame:
    """h, n: how often each token occurs."""

    def run(batches):
        kinds, times, held = [], [], 0

        def flushed():
            h, which = np.unique(np.concatenate(kinds), return_inverse=True)
            n = np.bincount(which, np.concatenate(times)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        for _, data, offsets in tokens.blocks(batches):
            h, n = np.unique(_tokens(data, offsets)[0], return_counts=True)
            kinds.append(h)
            times.append(n)
            held += len(h)
            if held > 4 * FLUSH:
                yield flushed()
                kinds, times, held = [], [], 0
        if kinds:
            yield flushed()

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _step(n: str):
    return F.floor(F.log2(n) * 16).cast("int")


def _vocabulary(counts: DataFrame, most: int) -> dict:
    """The most frequent tokens: sorted hashes with their ranks and counts; by rank, classes and counts up to there; each class's first
    rank, the bits of its paths and the counts along its own bits; the totals."""
    step = _step("n")
    steps = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect(), reverse=True)
    n_all, v_all = sum(s["n"] for s in steps), sum(s["v"] for s in steps)
    total, least = 0, 1 << 30
    for s in steps:
        total += s["v"]
        if total > most:
            break
        least = s["step"]
    got = counts.where(step >= least).toArrow()
    h, n = got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.lexsort((h, -n))
    h, n = h[order], n[order]
    before = np.cumsum(n) - n
    kind = np.minimum(before * RARE // max(int(n.sum()), 1), RARE - 1).astype(np.int64)
    v_rare = int(v_all - len(n))
    bits = np.array([min(max(int(k) - 1, 0).bit_length(), 32) for k in [*np.bincount(kind, minlength=CLASSES)[:RARE], v_rare]])  # of the path in each class
    mass = np.append(np.bincount(kind, n, RARE), n_all - n.sum())
    zero = _path_totals(np.zeros(CLASSES), np.arange(CLASSES, dtype=U) << U(64 - BITS), mass, np.full(CLASSES, BITS))
    order = np.argsort(h)
    end = np.flatnonzero(h == END)
    return {
        "hash": h[order], "top": tokens.hash_index(h[order]), "n": n[order], "rank": order, "kinds": np.append(kind, RARE), "bits": bits,
        "start": np.append(np.searchsorted(kind, np.arange(RARE)), len(kind)), "heavy": int((n * HEAVY > n_all).sum()),
        "end": (U(end[0]), kind[end[0]]) if len(end) else (_others(END), RARE),
        "zero": zero.astype(np.float32), "up_to": np.append(0, np.cumsum(n)), "n_all": int(n_all), "v_all": int(v_all), "least": least,
    }


def _path_totals(context: np.ndarray, code: np.ndarray, n: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of rows sorted by context and code: the sum of n at each node of each row's path, from the root on. Past the path's
    end the last one is repeated."""
    out = np.zeros((len(code), int(length.max(initial=0)) + 1))
    other = np.ones(len(code), bool)
    other[1:] = context[1:] != context[:-1]
    for b in range(out.shape[1]):
        new = other.copy()
        if b:
            top = code >> U(64 - b)
            new[1:] |= top[1:] != top[:-1]
        at = np.flatnonzero(new)
        total = np.repeat(np.add.reduceat(n, at), np.diff(np.append(at, len(n)))) if len(n) else n
        out[:, b] = np.where(length >= b, total, out[:, b - 1]) if b else total
    return out


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each byte of them a compressed plane of its own; a plane of zeros takes no room."""
    codec, head, out = pa.Codec("zstd", compression_level=1), [len(columns)], []
    for c in columns:
        planes = np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T
        made = [codec.compress(np.ascontiguousarray(x), asbytes=True) if x.any() else b"" for x in planes]
        head += [c.itemsize, len(c), *map(len, made)]
        out += made
    return b"".join([np.array([len(head), *head], np.int32).tobytes(), *out])


def _unpacked(data: pa.Scalar) -> list[np.ndarray]:
    codec, data, out = pa.Codec("zstd"), data.as_buffer(), []
    size = int(np.frombuffer(data, np.int32, 1)[0])
    head = np.frombuffer(data, np.int32, size, 4).tolist()
    at, k = 4 * (size + 1), 1
    for _ in range(head[0]):
        width, rows = head[k : k + 2]
        column = np.zeros((rows, width), np.uint8)
        for j, n in enumerate(head[k + 2 : k + 2 + width]):
            if n:
                column[:, j] = np.frombuffer(codec.decompress(data.slice(at, n), rows), np.uint8)
            at += n
        out.append(column.reshape(-1).view(f"<u{width}"))
        k += 2 + width
    return out


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and which of them each is. Where a key and its place fit into 63 bits, both are sorted as one number."""
    width = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + width > 63:
        return np.unique(key, return_inverse=True)
    both = np.sort(key << width | np.arange(len(key)))
    key = both >> width
    new = np.append(True, key[1:] != key[:-1])
    at = np.empty(len(key), np.int64)
    at[both & ((1 << width) - 1)] = np.cumsum(new) - 1
    return key[new], at


def _others(h: np.ndarray) -> np.ndarray:
    """What stands for tokens beyond the frequent ones, whose own number is their rank: 63 bits of the hash."""
    return (h >> U(1)) | OTHER


def _before(v: dict, ids: np.ndarray, others: np.ndarray, sizes: np.ndarray):
    """Of the tokens of a block: the token, the two before, and the classes of all three."""
    first = np.append(0, np.cumsum(sizes, dtype=np.int64))

    def earlier(values, fill, n):
        out = np.full(len(values), fill, values.dtype)
        out[n:] = values[:-n]
        for k in range(n):
            starts = first[:-1] + k
            out[starts[starts < first[1:]]] = fill
        return out

    token, kind = ids.astype(U), v["kinds"][ids]
    token[ids == len(v["hash"])] = _others(others)
    end, close = v["end"]
    return token, earlier(token, end, 1), earlier(token, end, 2), kind, earlier(kind, close, 1), earlier(kind, close, 2)


def encoded(texts: DataFrame, vocabulary) -> DataFrame:
    """``texts`` (text, text_hash, train) in blocks of about ``BLOCK`` tokens, training texts first: how many these are, ``texts``
    (hashes and numbers of tokens), ``words`` (ranks, and the hashes of tokens that have none) and ``seen``: how many tokens there
    are and, of training texts, how often each class follows each pair of classes and each heavy token."""

    def run(batches):
        v = vocabulary.value
        rank_of_none = len(v["hash"])
        held, size = ([], []), 0

        def flushed():
            hashes, sizes, ids, others = (np.concatenate(x) for x in zip(*held[1], *held[0], strict=True))
            train = sum(len(x[0]) for x in held[1])
            _, one, _, kind, kind_one, kind_two = (x[: sizes[:train].sum()] for x in _before(v, ids, others, sizes))
            heavy = one < U(v["heavy"])
            seen = np.bincount(np.concatenate([1 + (kind_one * CLASSES + kind_two) * CLASSES + kind, 1 + CLASSES**3 + one[heavy].astype(np.int64) * CLASSES + kind[heavy]]), minlength=1)
            seen[0] = len(ids)
            at = np.flatnonzero(seen)
            made = (_packed(hashes, sizes.astype(np.uint32)), _packed(ids, others), _packed(at.astype(np.uint32), seen[at]))
            return pa.RecordBatch.from_arrays([pa.array([train], pa.int32()), *(pa.array([x], pa.binary()) for x in made)], ["train", "texts", "words", "seen"])

        for part, data, offsets in tokens.blocks(batches):
            h, first = _tokens(data, offsets)
            at = tokens.find(v["hash"], v["top"], h)
            known = at >= 0
            ids = np.full(len(h), rank_of_none, np.uint32)
            ids[known] = v["rank"][at[known]]
            sizes, hashes = np.diff(first), part.column("text_hash").to_numpy()
            train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for which in (False, True):
                if (train == which).any():
                    mine = np.repeat(train == which, sizes)
                    held[which].append((hashes[train == which], sizes[train == which], ids[mine], h[mine & ~known]))
            size += len(h)
            if size >= BLOCK:
                yield flushed()
                held, size = ([], []), 0
        if size:
            yield flushed()

    return texts.mapInArrow(run, "train int, texts binary, words binary, seen binary").withColumn("block", F.monotonically_increasing_id())


def _layout(store: DataFrame, v: dict) -> dict:
    """The counts ``seen`` in all blocks, and the parts that the work is dealt into: of the class bits by the token before (and the
    one before that, if it is heavy), of the others by the classes of the token before and of the token itself. Every context of
    all others stands in one part, whole below these classes."""

    def run(batches):
        total = np.zeros(1 + CLASSES**3 + v_heavy * CLASSES, np.int64)
        for batch in batches:
            for x in batch.column("seen"):
                at, n = _unpacked(x)
                total[at] += n.astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    v_heavy = v["heavy"]
    got = store.select("seen").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(1 + CLASSES**3 + v_heavy * CLASSES)
    seen[got.column("at").to_numpy()] = got.column("n").to_numpy()
    pairs, heavy = (np.stack([np.repeat(x.reshape(-1, 1 << b, CLASSES >> b).sum(2), CLASSES >> b, 1) for b in range(BITS + 1)], 2).astype(np.float32)
                    for x in (seen[1 : 1 + CLASSES**3].reshape(-1, CLASSES), seen[1 + CLASSES**3 :].reshape(-1, CLASSES)))
    cells = seen[1 : 1 + CLASSES**3].reshape(CLASSES, CLASSES, CLASSES).sum(1).ravel()
    most = max(PART, seen[0] / PARTS)
    part, held = np.zeros(len(cells), np.int64), 0.0
    for i in range(1, len(cells)):
        held += cells[i - 1]
        new = held + cells[i] > most
        part[i] = part[i - 1] + new
        held *= not new
    return {"pairs": pairs, "heavy": heavy, "part": part, "first": np.searchsorted(part, np.arange(part[-1] + 2)), "parts": int(min(max(-(-seen[0] // PART), 1), PARTS))}


def dealt(store: DataFrame, vocabulary, layout, classes: bool, learning: bool = False) -> DataFrame:
    """part, block, train, size, entries: what a part needs of a block (train, size: its training texts, all texts), those of a part in one task
    and next to each other. Entries are the tokens before, the class (``classes``) or the bits after it, and the text; for
    ``learning``, of training texts."""

    def run(batches):
        v, a = vocabulary.value, layout.value
        none, start = len(v["hash"]), v["start"].astype(np.uint32)
        for batch in batches:
            for block, train, texts, words in zip(*(batch.column(c) for c in ("block", "train", "texts", "words")), strict=True):
                sizes = _unpacked(texts)[1]
                used = int(sizes[: train.as_py() if learning else None].sum())
                token, one, two, kind, kind_one, _ = (x[:used] for x in _before(v, *_unpacked(words), sizes))
                text = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)[:used]
                if classes:
                    part = ((tokens.mix(one) + np.where(one < U(v["heavy"]), tokens.mix(two), U(0))) % U(a["parts"])).astype(np.uint16)
                    order, last = np.argsort(part, kind="stable"), kind.astype(np.uint8)
                    part = part[order]
                else:
                    order = np.flatnonzero(v["bits"][kind] > 0)
                    cell = (kind_one[order] * CLASSES + kind[order]).astype(np.uint16)
                    by = np.argsort(cell, kind="stable")
                    order, cell = order[by], cell[by]
                    part = a["part"][cell]
                    last = np.minimum(token, U(none)).astype(np.uint32) - start[kind]
                    if deep := int(v["bits"][RARE]):
                        last[kind == RARE] = token[kind == RARE] << U(1) >> U(64 - deep)
                one, two, last, text = one[order], two[order], last[order], text[order]
                later = text.copy()
                later[1:] -= text[:-1]
                known = [np.minimum(x, U(none)).astype(np.uint32) for x in (one, two)]
                if not classes:
                    known[0] -= start[kind_one[order]]
                cut = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else np.zeros(1, int)
                later[cut[1:-1]] = text[cut[1:-1]]
                made = []
                for i, j in zip(cut[:-1], cut[1:], strict=True):
                    columns = [known[0][i:j], known[1][i:j], *(x[i:j][x[i:j] >= OTHER] for x in (one, two)), last[i:j], later[i:j]]
                    if not classes:
                        first = a["first"][part[i] : part[i] + 2]
                        columns.append(np.bincount(cell[i:j] - first[0], minlength=first[1] - first[0]).astype(np.uint32))
                    made.append(_packed(*columns))
                n = len(made)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[cut[:-1]].astype(np.int32)), *(pa.array([x] * n, k) for x, k in ((block.as_py(), pa.int64()), (train.as_py(), pa.int32()), (len(sizes), pa.int32()))), pa.array(made, pa.binary()),
                ], ["part", "block", "train", "size", "entries"])

    made = store.select("block", "train", "texts", "words").mapInArrow(run, "part int, block long, train int, size int, entries binary")
    return made.repartition("part").sortWithinPartitions("part")


class _Part:
    """A part's different rows of two tokens before and path, each bit of theirs with its inputs and gate, and where they occur.
    ``n``: how often in training texts; ``slot``: the text of each entry, numbered through the blocks; ``row``: its row."""

    def __init__(self, v: dict, a: dict, rows: list[tuple], classes: bool):
        none, deepest = len(v["hash"]), 0 if classes else int(v["bits"].max())
        held, slots = [], 0
        self.blocks = []
        for part, block, train, size, data in rows:
            known, other, last, text = (x := _unpacked(data))[:2], x[2:4], x[4].astype(np.int64), np.cumsum(x[5], dtype=np.uint32).astype(np.int64)
            tokens_before = [y.astype(U) for y in known]
            if classes:
                path = last
            else:
                cell = np.repeat(np.arange(a["first"][part], a["first"][part + 1]), x[6])
                tokens_before[0] += v["start"].astype(U)[cell // CLASSES]
                kind = cell % CLASSES
                path = kind << deepest | last << (deepest - v["bits"][kind])
            for y, o in zip(tokens_before, other, strict=True):
                y[y == none] = o
            held.append((*tokens_before, path, slots + text, text < train))
            self.blocks.append((block, slots, slots + size))
            slots += size
        one, two, path, self.slot, train = (np.concatenate(x) for x in zip(*held, strict=True))
        both = np.concatenate([one, two])
        rest = both >= OTHER
        both[rest] = U(none) + np.unique(both[rest], return_inverse=True)[1].astype(U)
        one, two = both[: len(one)], both[len(one) :]
        self.deep = BITS + deepest
        width = int(both.max()).bit_length()
        if 2 * width + self.deep < 64:  # a key holds both tokens and the path
            key, self.row = _distinct((one << U(width) | two).astype(np.int64) << self.deep | path)
            pair = (key >> self.deep).view(U)
        else:
            width = 32
            pair, at = np.unique(one << U(32) | two, return_inverse=True)
            key, self.row = np.unique(at << self.deep | path, return_inverse=True)
            pair = pair[key >> self.deep]
        self.n = np.bincount(self.row, train, len(key))
        self.path = key & ((1 << self.deep) - 1)
        one, two = (pair >> U(width)).astype(np.int64), (pair & U((1 << width) - 1)).astype(np.int64)
        kind, kinds = self.path >> deepest, v["kinds"][np.minimum(one, none)] * CLASSES + v["kinds"][np.minimum(two, none)]
        self.length = BITS + (np.zeros(len(key), np.int64) if classes else v["bits"][kind])
        pairs = self._context(kinds << self.deep | self.path) if not classes else _Context(np.arange(CLASSES**3), None, kinds << self.deep | self.path, self.deep, a["pairs"].reshape(-1, BITS + 1))
        paths, at = (np.arange(CLASSES), self.path) if classes else _distinct(pairs.keys & ((1 << self.deep) - 1))
        self.contexts = [_Context(paths, None, at if classes else at[pairs.at], self.deep, _plain(v, paths, self.deep)), pairs]
        self.contexts += [self._context(one << self.deep | self.path, a["heavy"] if classes else None), _Context(key, self.n, None, self.deep)]
        self.first = 0 if classes else BITS

    def _context(self, key: np.ndarray, heavy: np.ndarray | None = None):
        keys, at = _distinct(key)
        table = None
        if heavy is not None:
            mine = keys[: np.searchsorted(keys, len(heavy) << self.deep)]
            table = heavy[mine >> self.deep, mine & (CLASSES - 1)]
        return _Context(keys, np.bincount(at, self.n, len(keys)), at, self.deep, table)

    def bits(self, but: bool):
        """For each bit, the rows whose path has it, the bit, inputs and gate. ``but``: rows of training texts, one occurrence of which is
        not counted."""
        rows = np.flatnonzero(self.n > 0) if but else np.arange(len(self.n))
        for c in self.contexts:
            c.begin(self.first, but)
        rows = rows[np.argsort(-self.length[rows].astype(np.int8), kind="stable")]  # the longest paths first
        length, path, places = -self.length[rows], self.path[rows], [rows if c.at is None else c.at[rows] for c in self.contexts]
        for b in range(self.first, -int(length.min(initial=0))):
            m = int(np.searchsorted(length, -b))
            bit = (path[:m] >> (self.deep - 1 - b)) & 1
            sign = (2 * bit - 1).astype(np.float32)
            x, gate = np.empty((INPUTS, m), np.float32), []
            for i, (c, at) in enumerate(zip(self.contexts, places, strict=True)):
                c.step(b)
                np.multiply(c.odds[at[:m]], sign, out=x[i])
                if i >= 2:
                    gate.append(c.level[at[:m]])
            x[-1] = 1
            yield b, rows[:m], bit, x, (gate[0] * np.int8(4) + gate[1]).astype(np.int64)


def _plain(v: dict, paths: np.ndarray, deep: int) -> np.ndarray:
    """How often the nodes of the paths of some tokens occur, at each depth; nothing is known of a hash's bits."""
    kind, after = paths >> (deep - BITS), deep - BITS
    out = np.repeat(v["zero"][kind, BITS:], deep + 1, 1)
    out[:, : BITS + 1] = v["zero"][kind]
    bits, start, end = v["bits"][kind], v["start"][kind], np.append(v["start"], len(v["hash"]))[kind + 1]
    for b in range(1, after + 1):
        left = np.maximum(bits - b, 0)
        first = start + ((paths & ((1 << after) - 1)) >> (after - bits) >> left << left)
        inside = v["up_to"].take(np.minimum(first + (1 << left), end), mode="clip") - v["up_to"].take(first, mode="clip")
        out[:, BITS + b] = np.where(kind == RARE, np.nan, inside)
    return out


class _Context:
    """Sorted keys of a context and path, how often each occurs, and which of them each row has; ``table`` has the totals of the first
    ones at each depth. A key that is alone at its node stays so: from depth to depth only the others' totals are made. ``odds`` and
    ``level``: of a key's node, the log odds that its own side follows, and how often it was seen."""

    def __init__(self, keys: np.ndarray, n: np.ndarray | None, at: np.ndarray | None, deep: int, table: np.ndarray | None = None):
        self.keys, self.at, self.table, self.given = keys, at, table, 0 if table is None else len(table)
        self.n = np.zeros(len(keys)) if n is None else n
        self.up_to = np.append(0, np.cumsum(self.n))
        differ = np.frexp((keys[1:] ^ keys[:-1]).astype(float))[1]  # the highest bit, above which they agree
        self.agree = np.append(-1, deep - np.minimum(differ, deep + 1)).astype(np.int8)

    def _set(self, which, here: np.ndarray, taken: np.ndarray) -> None:
        here, taken = np.maximum(here - self.less, 0), np.maximum(taken - self.less, 0)
        self.odds[which] = np.clip(np.log((taken + np.float32(0.4)) / (here - taken + np.float32(0.4))), -LIMIT, LIMIT)
        self.level[which] = _level(here)

    def begin(self, b: int, but: bool) -> None:
        self.less, self.total = np.float32(but), self.n.astype(np.float32)
        self.odds, self.level = np.zeros(len(self.n), np.float32), np.zeros(len(self.n), np.int8)
        self._set(slice(None), self.total, self.total)
        self.open, self.closed = np.arange(self.given, len(self.n)), np.arange(0)
        self._go(b)
        self.closed = np.arange(0)

    def _go(self, b: int) -> None:
        """Totals at depth b."""
        if len(self.open):
            first = np.flatnonzero(self.agree[self.open] < b)
            size = np.diff(np.append(first, len(self.open)))
            at = self.open[first]  # the keys of a node stand next to each other
            self.total[self.open] = np.repeat((self.up_to[at + size] - self.up_to[at]).astype(np.float32), size)
            self.open, self.closed = self.open[np.repeat(size > 1, size)], at[size == 1]
        if self.given:
            self.total[: self.given] = self.table[:, min(b, self.table.shape[1] - 1)]

    def step(self, b: int) -> None:
        """From depth b to the next."""
        if len(self.closed):
            self._set(self.closed, n := self.total[self.closed], n)
        which, given, self.closed = self.open, self.given, np.arange(0)
        here, before = self.total[which], self.total[:given].copy()
        self._go(b + 1)
        if len(which):
            self._set(which, here, self.total[which])
        if given:
            self._set(slice(given), before, self.total[:given])
            np.nan_to_num(self.odds[:given], copy=False)


def _parts(v: dict, a: dict, batches, classes: bool):
    rows = []
    for batch in batches:
        for part, block, train, size, data in zip(*batch.columns, strict=True):
            part = part.as_py()
            if rows and rows[-1][0] != part:
                yield _Part(v, a, rows, classes)
                rows = []
            rows.append((part, block.as_py(), train.as_py(), size.as_py(), data))
    if rows:
        yield _Part(v, a, rows, classes)


def _level(n: np.ndarray) -> np.ndarray:
    return (n >= 1).astype(np.int8) + (n >= 7) + (n >= 63)


def _mixed(w: np.ndarray, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
    w = np.ascontiguousarray(w.T)
    out = w[0][gate] * x[0]
    for i in range(1, INPUTS):
        out += w[i][gate] * x[i]
    return np.clip(out, -LIMIT, LIMIT, out=out)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step_of(x: np.ndarray) -> np.ndarray:
    return np.minimum(((x + np.float32(LIMIT)) * np.float32(STEPS / (2 * LIMIT))).astype(np.int64), STEPS - 1)


def _batches(blocks: int, *columns: np.ndarray):
    """The rows in so many batches, each of every blocks-th run of some rows; what is left of them is a batch of its own."""
    whole = columns[0].shape[-1] // (RUN * blocks) * RUN * blocks
    dealt_out = [c[..., :whole].reshape(*c.shape[:-1], -1, blocks, RUN) for c in columns]
    for k in range(blocks if whole else 0):
        yield [np.ascontiguousarray(d[..., k, :]).reshape(*c.shape[:-1], -1) for c, d in zip(columns, dealt_out, strict=True)]
    if whole < columns[0].shape[-1]:
        yield [np.ascontiguousarray(c[..., whole:]) for c in columns]


def learn(store: DataFrame, vocabulary, layout, classes: bool, levels: int) -> tuple:
    """The weights, how many tokens each saw, and the table, from training texts; of the class bits or of those after."""
    gates = 16 * levels

    def run(batches):
        v, a = vocabulary.value, layout.value
        w = np.full((levels, 16, INPUTS), 0.35)
        w[:, :, -1] = 0
        power = np.full((levels, 16, INPUTS), 1.0)
        hits = np.zeros((2, levels, STEPS))
        saw = np.zeros((levels, 16))
        for part in _parts(v, a, batches, classes):
            blocks = -(-len(part.n) // BATCH)
            for b, rows, bits, inputs, gates_of in part.bits(True):
                times = part.n[rows]
                saw[b] += np.bincount(gates_of, times, 16)
                for n, bit, x, gate in _batches(blocks, times, bits, inputs, gates_of):
                    mixed = _mixed(w[b].astype(np.float32), gate, x)
                    error = (bit - _squash(mixed)) * (n / n.sum())
                    g = np.stack([np.bincount(gate, error * y, 16) for y in x], 1)
                    power[b] += (10 * g) ** 2
                    w[b] += 0.5 * g / np.sqrt(power[b])
                    hits[:, b] += np.bincount(bit * STEPS + _step_of(mixed), n, 2 * STEPS).reshape(2, STEPS)
        if saw.any():
            for what, x in ((10, (w * saw[:, :, None]).ravel()), (11, saw.ravel()), (12, hits.ravel())):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), what), pa.int32()), pa.array(np.arange(len(x)), pa.int32()), pa.array(x)], ["what", "at", "x"])

    got = dealt(store, vocabulary, layout, classes, True).mapInArrow(run, "what int, at int, x double").groupBy("what", "at").agg(F.sum("x").alias("x")).toArrow()
    what, at, x = (got.column(c).to_numpy() for c in ("what", "at", "x"))

    def filled(number: int, size: int) -> np.ndarray:
        out = np.zeros(size)
        out[at[what == number]] = x[what == number]
        return out

    saw = filled(11, gates)[:, None]
    w = np.where(saw > 0, filled(10, gates * INPUTS).reshape(gates, INPUTS) / np.maximum(saw, 1), np.full(INPUTS, 0.35) * (np.arange(INPUTS) < INPUTS - 1))
    return w.reshape(levels, 16, INPUTS), filled(12, 2 * levels * STEPS).reshape(2, levels, STEPS)


def _model(classes: tuple, after: tuple) -> dict:
    w, hits = np.concatenate([classes[0][:BITS], after[0][BITS:]]), np.concatenate([classes[1][:, :BITS], after[1][:, BITS:]], 1)
    middle = _squash((np.arange(STEPS) + 0.5) * (2 * LIMIT / STEPS) - LIMIT)
    return {"w": w.astype(np.float32), "refined": (hits[1] + 20 * middle) / (hits.sum(0) + 20)}


def costs(store: DataFrame, vocabulary, layout, model, classes: bool) -> DataFrame:
    """block, sums: what the bits of the class, or those after, cost each of a block's texts in one of the tasks."""

    def run(batches):
        v, a, m = vocabulary.value, layout.value, model.value
        held = {}

        def flushed():
            made = [_packed(x.astype(np.float32).view(np.uint32)) for x in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(made, pa.binary())], ["block", "sums"])

        for part in _parts(v, a, batches, classes):
            total = np.zeros(len(part.n))
            for b, rows, bit, x, gate in part.bits(False):
                mixed = _mixed(m["w"][b], gate, x)
                refined = np.concatenate([1 - m["refined"][b], m["refined"][b]]).astype(np.float32)[bit * STEPS + _step_of(mixed)]
                total[rows] += np.log10(np.float32(0.5) * (_squash(np.where(bit == 1, mixed, -mixed)) + refined))
            sums = np.bincount(part.slot, total[part.row], part.blocks[-1][2])
            for block, i, j in part.blocks:
                held[block] = held.get(block, 0) + sums[i:j]
            if sum(map(len, held.values())) > 4 * BLOCK:
                yield flushed()
                held.clear()
        if held:
            yield flushed()

    return dealt(store, vocabulary, layout, classes).mapInArrow(run, "block long, sums binary")


def _paths_of_texts(store: DataFrame, sums: DataFrame) -> DataFrame:
    """text_hash, path: what the paths of each text cost; the mean over its copies is that of one."""

    def run(batches):
        for batch in batches:
            for texts, parts in zip(batch.column("texts"), batch.column("sums"), strict=True):
                hashes = _unpacked(texts)[0].view(np.int64)
                path = sum((_unpacked(x)[0].view(np.float32).astype(float) for x in parts), np.zeros(len(hashes)))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(path)], ["text_hash", "path"])

    met = store.select("block", "texts").join(sums.groupBy("block").agg(F.collect_list("sums").alias("sums")), "block")
    return met.select("texts", "sums").mapInArrow(run, "text_hash long, path double").groupBy("text_hash").agg(F.avg("path").alias("path"))


def score(docs: DataFrame, training: DataFrame | None = None, most: int = WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of ``docs``. ``training``:
    by default the documents whose remainder is not 0."""
    context = docs.sparkSession.sparkContext
    is_training = fold_of(F.col("doc_id"), 10) != 0
    if training is None:
        texts, training = docs.select("text", is_training.alias("train")), docs.where(is_training)
    else:
        texts = docs.select("text", F.lit(False).alias("train")).union(training.select("text", F.lit(True)))
    with shuffles_released(docs.sparkSession):
        counts = written(count_tokens(training), "counts")
        v = _vocabulary(counts, most)
        held = context.broadcast(v)  # at most ``most`` tokens
        store = written(encoded(texts.withColumn("text_hash", F.xxhash64("text")), held), "texts")
        layout = context.broadcast(_layout(store, v))  # numbers of pairs of classes, and of heavy tokens, times classes
        levels = BITS + int(v["bits"].max())
        model = context.broadcast(_model(*(learn(store, held, layout, x, levels) for x in (True, False))))  # numbers of levels x gates and steps
        sums = [written(costs(store, held, layout, model, x), "costs") for x in (True, False)]
    path = _paths_of_texts(store, sums[0].union(sums[1]))
    base_total = v["n_all"] + 0.1 * (v["v_all"] + 1)

    def run(batches):
        v = held.value
        cost = np.log10(np.diff(v["up_to"]) + 0.1)
        for batch in batches:
            for texts, words in zip(*batch.columns, strict=True):
                (hashes, sizes), (ids, h) = _unpacked(texts), _unpacked(words)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                known = ids < len(cost)
                plain = np.bincount(owner[known], cost[ids[known]], len(sizes)).astype(float)
                count, owner = np.bincount(owner[known], minlength=len(sizes)), owner[~known]
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(order), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                head = np.flatnonzero(new)
                times = np.diff(np.append(head, len(order)))
                cut = pa.array(np.searchsorted(owner[head], np.arange(len(sizes) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashes.view(np.int64)), pa.array(sizes.astype(np.int64)), pa.array(count), pa.array(plain),
                    pa.ListArray.from_arrays(cut, pa.array(h[head].view(np.int64))), pa.ListArray.from_arrays(cut, pa.array(times, pa.int32())),
                ], ["text_hash", "n_tokens", "known", "plain", "rest", "times"])

    of_text = store.select("texts", "words").mapInArrow(run, "text_hash long, n_tokens long, known long, plain double, rest array<long>, times array<int>")
    of_text = written(of_text.dropDuplicates(["text_hash"]), "scored")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), 10) == 0).alias("held_out"), F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
    ).join(of_text.drop("rest", "times"), "text_hash")
    # the counts of the other tokens, and of those that share a path, joined once for each text
    deep = int(v["bits"][RARE])
    leaf = F.shiftrightunsigned("h", 64 - deep) if deep else F.lit(0).cast("long")
    rare = counts.where(_step("n") < v["least"])
    leaves = rare.groupBy(leaf.alias("leaf")).agg(F.sum("n").alias("n_leaf"), F.count("*").alias("v_leaf"))
    rest = of_text.where(F.size("rest") > 0)
    rest = rest.select("text_hash", F.explode_outer(F.arrays_zip("rest", "times")).alias("r")).select("text_hash", F.col("r.rest").alias("h"), F.col("r.times").alias("times"))
    n, n_leaf, v_leaf = (F.coalesce(c, F.lit(0)) for c in ("n", "n_leaf", "v_leaf"))
    found = rest.withColumn("leaf", leaf).join(rare, "h", "left").join(leaves, "leaf", "left").groupBy("text_hash").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known_rest"),
        F.sum(F.col("times") * F.log10(n + 0.1)).alias("plain_rest"),
        F.sum(F.col("times") * F.log10((n + 0.1) / (n_leaf + 0.1 * (v_leaf + 1)))).alias("leaf_rest"),
    )
    coded_all = F.col("path") + F.coalesce("leaf_rest", F.lit(0.0))
    return rows.select("doc_id", "held_out", "text_hash", "bytes", "n_tokens", "known", "plain").join(found, "text_hash", "left").join(path, "text_hash").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"), F.lit(v["n_all"]).cast("long").alias("train_tokens"),
        (F.col("plain") + F.coalesce("plain_rest", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(base_total))).alias("base_score"),
        coded_all.alias("score"), (-coded_all * float(np.log2(10)) / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the scores of every text, learned from the documents whose remainder is not 0."""
    from pagelex.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return score(docs)
