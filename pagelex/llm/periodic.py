"""Operator 12, periodic run detection on grammar-compressed texts.

A run is a stretch of consecutive words ``[^\\x20\\x09-\\x0D]+`` whose smallest period is q (words q apart are the
same), of at least ``max(LEAST, 3 * q)`` words, that no neighbouring word extends. Words are compared as they are, case
included.

Method. Each block of texts (a megabyte, or one longer text) is compressed by Re-Pair: in rounds, the pairs of
neighbouring symbols that occur twice or more in a text become new symbols, of pairs that overlap the more frequent one.
What is left of each text is closed by a balanced tree. A run's lowest symbol or tree node that holds all of it has its
inner boundary within the run, so each symbol is searched once, at its boundary, whatever the number of its
occurrences: for every period up to a third of its length the words beside the boundary are compared, and the few
periods that pass are extended to both sides by bisection on prefix hashes. The runs of a symbol are then moved to all places
of its derivation, and those of one period that overlap by a period or more are merged, which leaves the maximal ones.
Each merged run is compared word by word, so that a prefix hash can cost time but never a wrong run (another base is
taken then). Words themselves are told apart by 64-bit hashes.

Rows are independent, so nothing is shuffled and no text meets another; a very long text costs its length times the
logarithm of its length. Defined results: a null, empty or blank text has no runs and an empty collapsed
text; null and repeated ids are rows like others; an empty table gives no rows; other columns are not read. Of
runs with the same exponent the first start, then the smallest period is the greatest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import let, table
from pagelex.llm.native import BLANK

LEAST = 24
BLOCK = 1 << 20
PRIME = (1 << 31) - 1
CANDIDATES = 1 << 21
FOUND = "array<struct<start:long,length:long,period:long>>"


class Grammar:
    """Symbols below ``words`` are words, the others rules ``left right`` of ``size`` words, first seen at ``at``. ``top`` are the
    symbols that are left, with their places ``top_at``."""

    def __init__(self, word: np.ndarray, doc: np.ndarray):
        self.words = int(word.max()) + 1 if len(word) else 0
        sym, at = word.astype(np.int64), np.arange(len(word))
        size, self.rounds = [np.ones(self.words, np.int64)], [self.words]
        left, right, first = [], [], []
        sizes, made = size[0], self.words
        joins = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
        may = joins.copy()  # pairs that may still occur twice
        while True:
            i = np.flatnonzero(may)
            if not len(i):
                break
            key = (sym[i] << 32) | sym[i + 1]
            # of a streak of one pair (a a a a) every other one counts
            fresh = np.ones(len(i), bool)
            fresh[1:] = (i[1:] != i[:-1] + 1) | (key[1:] != key[:-1])
            step = np.arange(len(i))
            even = (step - np.maximum.accumulate(np.where(fresh, step, 0))) & 1 == 0
            i, key = i[even], key[even]
            order = np.argsort(key, kind="stable")
            new = np.ones(len(key), bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            group = np.empty(len(key), np.int64)
            group[order] = np.cumsum(new) - 1
            n = np.bincount(group)
            many = n[group] > 1
            may[i[~many]] = False
            i, key, group = i[many], key[many], group[many]
            if not len(i):
                break
            weight = (n[group] << 30) | (tokens.mix(key.view(np.uint64)) >> np.uint64(34)).astype(np.int64)
            beside = i[1:] == i[:-1] + 1
            wins = np.ones(len(i), bool)
            wins[1:] &= ~beside | (weight[1:] > weight[:-1])
            wins[:-1] &= ~beside | (weight[:-1] >= weight[1:])
            i, group = i[wins], group[wins]
            twice = np.bincount(group, minlength=len(n))[group] > 1
            i, group = i[twice], group[twice]
            _, one, group = np.unique(group, return_index=True, return_inverse=True)
            left.append(sym[i[one]])
            right.append(sym[i[one] + 1])
            first.append(at[i[one]])
            size.append(sizes[left[-1]] + sizes[right[-1]])
            sizes = np.concatenate([sizes, size[-1]])
            sym[i] = made + group
            made += len(one)
            self.rounds.append(made)
            joins[i] = joins[i + 1]
            may[i] = True
            may[np.maximum(i - 1, 0)] = True
            keep = np.ones(len(sym), bool)
            keep[i + 1] = False
            sym, at, joins, may = sym[keep], at[keep], joins[keep], may[keep]
            may &= joins
        none = [np.zeros(0, np.int64)]
        self.size = sizes
        self.left, self.right, self.at = (np.concatenate(none + x) for x in (left, right, first))
        self.top, self.top_at, self.joins = sym, at, joins

    def tree(self):
        """Start, boundary and end of the nodes of balanced trees over what is left of each text, LEAST words long at least."""
        start, end = self.top_at, self.top_at + self.size[self.top]
        last = ~self.joins
        out = []
        while not last.all():
            owner = np.cumsum(np.append(0, last[:-1]))
            begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            odd = (np.arange(len(start)) - begin[owner]) & 1 == 1
            j = np.flatnonzero(odd)
            out.append(np.stack([start[j - 1], start[j], end[j]]))
            end[j - 1], last[j - 1] = end[j], last[j]
            start, end, last = start[~odd], end[~odd], last[~odd]
        got = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return got[:, got[2] - got[0] >= LEAST]

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of the wanted rules in the texts: (rule, place), by derivation from what is left."""
        holds = np.concatenate([np.zeros(self.words, bool), wanted])
        for a, b in zip(self.rounds[:-1], self.rounds[1:], strict=True):  # a rule's parts are older than itself
            at = slice(a - self.words, b - self.words)
            holds[a:b] |= holds[self.left[at]] | holds[self.right[at]]
        sym, place = self.top[holds[self.top]], self.top_at[holds[self.top]]
        rules, places = [], []
        while len(sym):
            rule = sym - self.words
            rules.append(rule[wanted[rule]])
            places.append(place[wanted[rule]])
            left, right = self.left[rule], self.right[rule]
            sym, place = np.concatenate([left, right]), np.concatenate([place, place + self.size[left]])
            sym, place = sym[holds[sym]], place[holds[sym]]
        return np.concatenate([np.zeros(0, np.int64), *rules]), np.concatenate([np.zeros(0, np.int64), *places])


class Prefixes:
    """Polynomial hashes of stretches of symbols modulo a prime: equal stretches always agree."""

    def __init__(self, word: np.ndarray, base: int):
        self.p = np.uint64(PRIME)
        n = len(word)
        power = np.ones(n + 1, np.uint64)
        have, scale = 1, base % PRIME
        while have < n + 1:  # by doubling
            more = min(have, n + 1 - have)
            power[have : have + more] = power[:more] * np.uint64(scale) % self.p
            have, scale = have + more, scale * scale % PRIME
        value = tokens.mix(word.astype(np.uint64) + np.uint64(base)) % self.p
        self.power = power
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n] % self.p)])

    def same(self, a: np.ndarray, q: np.ndarray, n) -> np.ndarray:
        """Whether n words from a and from a + q agree."""
        one = (self.sums[a + n] - self.sums[a]) % self.p * self.power[q] % self.p
        return one == (self.sums[a + q + n] - self.sums[a + q]) % self.p

    def ahead(self, a: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from a agree with those from a + q, ``most`` at most."""
        n = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            i = np.flatnonzero(n + step <= most)
            n[i[self.same(a[i] + n[i], q[i], step)]] += step
            step >>= 1
        return n

    def back(self, a: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before a agree with those before a + q, ``most`` at most."""
        n = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            i = np.flatnonzero(n + step <= most)
            n[i[self.same(a[i] - n[i] - step, q[i], step)]] += step
            step >>= 1
        return n


def _crossing(word: np.ndarray, hashes: Prefixes, node: np.ndarray, start: np.ndarray, inner: np.ndarray, end: np.ndarray):
    """(node, period, start, end) of the repetitions of three periods and LEAST words at least that lie within a node and
    cross its inner boundary, as far as the node reaches, each with its smallest period."""
    third = (end - start) // 3
    found = []
    for ahead in (True, False):
        # the words q apart that agree include the last one before the boundary, or the one q before the boundary
        most = np.minimum(third, end - inner if ahead else inner - start)
        total = np.cumsum(most)
        lo = 0
        while lo < len(most):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + CANDIDATES, "right")))
            n = most[lo:hi]
            which = np.repeat(np.arange(lo, hi), n)
            q = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + 1
            a = inner[which] - 1 if ahead else inner[which] - q
            hit = np.flatnonzero(word[a] == word[a + q])
            a, q, which = a[hit], q[hit], which[hit]
            # 16 words in a row agree with those q further: eight of them end or begin at a
            before, after = a + 1 - start[which] >= 8, end[which] - q - a >= 8
            near = np.zeros(len(a), bool)
            near[before] = hashes.same(a[before] - 7, q[before], 8)
            after &= ~near
            near[after] = hashes.same(a[after], q[after], 8)
            a, q, which = a[near], q[near], which[near]
            s = a - hashes.back(a, q, a - start[which])
            e = a + q + hashes.ahead(a, q, end[which] - q - a)
            ok = (e - s >= np.maximum(LEAST, 3 * q)) & (s < inner[which]) & (e > inner[which])
            found.append(np.stack([node[which], q, s, e])[:, ok])
            lo = hi
    got = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    got = got[:, np.lexsort((got[1], got[3], got[2], got[0]))]
    fresh = np.ones(got.shape[1], bool)
    fresh[1:] = (got[[0, 2, 3], 1:] != got[[0, 2, 3], :-1]).any(0)
    return got[:, fresh]


def _merged(q: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Repetitions of one period that overlap by the period or more become one."""
    order = np.lexsort((s, q))
    q, s, e = q[order], s[order], e[order]
    far = int(e.max(initial=0)) + 1
    rank = np.cumsum(np.append(0, q[1:] != q[:-1])) * far if len(q) else q
    reach = np.maximum.accumulate(e + rank)
    fresh = np.ones(len(q), bool)
    fresh[1:] = s[1:] + rank[1:] > reach[:-1] - q[1:]
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(q) - 1) if len(q) else np.zeros(0, np.int64)
    return q[fresh], s[fresh], (reach - rank)[last]


def _periodic(word: np.ndarray, q: np.ndarray, s: np.ndarray, e: np.ndarray) -> bool:
    n = e - s - q
    i = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return bool((word[i] == word[i + np.repeat(q, n)]).all())


def runs_of(word: np.ndarray, doc: np.ndarray):
    """(period, start, end) of all runs of the texts, by start and period. ``word`` numbers the words so that words of different
    texts never have one number; ``doc`` gives each word's text, in order."""
    grammar = Grammar(word, doc)
    long = np.flatnonzero(grammar.size[grammar.words :] >= LEAST)
    start = grammar.at[long]
    tree = grammar.tree()
    node = np.concatenate([long, np.full(tree.shape[1], -1)])
    first, inner, end = (np.concatenate(x) for x in zip((start, start + grammar.size[grammar.left[long]], start + grammar.size[grammar.words + long]), tree, strict=True))
    number = np.arange(len(node))
    for base in range(48_271, PRIME):
        got = _crossing(word, Prefixes(word, base), number, first, inner, end)
        rule = node[got[0]]
        own = got[:, rule >= 0]
        rule, shift = rule[rule >= 0], first[own[0]]
        order = np.argsort(rule, kind="stable")
        rule, own, shift = rule[order], own[:, order], shift[order]
        wanted = np.zeros(len(grammar.left), bool)
        wanted[rule] = True
        at_rule, place = grammar.places(wanted)
        lo, hi = np.searchsorted(rule, at_rule), np.searchsorted(rule, at_rule, "right")
        n = hi - lo
        i = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        move = np.repeat(place, n) - shift[i]
        top = got[:, node[got[0]] < 0]
        q, s, e = _merged(np.concatenate([own[1, i], top[1]]), np.concatenate([own[2, i] + move, top[2]]), np.concatenate([own[3, i] + move, top[3]]))
        if _periodic(word, q, s, e):
            order = np.lexsort((q, s))
            return q[order], s[order], e[order]


def _block(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The runs and the collapsed text of each text."""
    runs = tokens.Runs(data, offsets, tokens.not_space())
    texts = len(offsets) - 1
    doc = np.repeat(np.arange(texts), np.diff(runs.first))
    _, word = np.unique(tokens.mix(runs.hashes() + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True)
    q, s, e = runs_of(word, doc)
    owner = doc[s]
    cut = np.searchsorted(owner, np.arange(texts + 1)).astype(np.int32)
    found = pa.ListArray.from_arrays(
        pa.array(cut),
        pa.StructArray.from_arrays([pa.array(s - runs.first[owner]), pa.array(e - s), pa.array(q)], ["start", "length", "period"]),
    )
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, s + q, 1)
    np.add.at(change, e, -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    size = runs.end[kept] - runs.start[kept] + 1
    after = np.cumsum(size)
    out = np.append(data, np.uint8(32))[np.repeat(runs.start[kept] - (after - size), size) + np.arange(after[-1] if len(after) else 0)]
    out[after - 1] = 32
    # a text's words with a space behind each; the last one is left out
    count = np.searchsorted(doc[kept], np.arange(texts + 1))
    begin = np.append(0, after)[count]
    full = np.diff(count) > 0
    keep = np.ones(len(out), bool)
    keep[begin[1:][full] - 1] = False
    ends = (begin - np.append(0, np.cumsum(full))).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(texts, pa.py_buffer(ends.tobytes()), pa.py_buffer(out[keep].tobytes())).cast(pa.string())
    return found, text


def find(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start and period), collapsed (the words that no run holds after its
    first period, joined by one space) of each row's whole text."""

    def run(batches):
        for batch, data, offsets in tokens.blocks(batches, limit=BLOCK):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_block(data, offsets)], ["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs {FOUND}, collapsed string")


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length / period, of ties the first; null if there is none."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(FOUND[6:-1]), lambda best, r: F.when(better(best, r), r).otherwise(best))


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The query's texts: with h = crc32(doc_id) and g = floor(h / 10), where h % 10 is 0 word i of n becomes word
    a + (i - a) % p for i >= a, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)); other texts, and those of null id, stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = lambda t: F.split(F.btrim(t, F.lit(BLANK)), r"[\x20\x09-\x0D]+")

    def edited(w):
        n = F.size(w)
        return let(F.pmod(g, n), lambda a: let(1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))), lambda p: F.concat_ws(
            " ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))))))

    filled = F.length(F.btrim(text, F.lit(BLANK))) > 0
    return F.when((h % 10 == 0) & filled, let(words(text), edited)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text")))
    top = greatest(F.col("runs"))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
