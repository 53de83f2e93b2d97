"""Operator 12 against brute force: every period of every text, word by word."""

import hashlib
import random
import zlib

import numpy as np

from conftest import prose
from pagelex.llm import periodic
from pagelex.llm.common import table


def words(text):
    return (text or "").encode().split()


def brute(w):
    """(start, length, period) of each run; a stretch counts for its smallest period only."""
    _, x = np.unique(np.array(w, dtype=object), return_inverse=True) if w else (None, np.zeros(0, int))
    seen, out = set(), []
    for q in range(1, len(w) // 3 + 1):
        same = np.concatenate([[0], (x[:-q] == x[q:]).astype(int), [0]])
        for s, e in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1) + q, strict=True):
            if e - s >= max(24, 3 * q) and (s, e) not in seen:
                seen.add((s, e))
                out.append((int(s), int(e - s), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def answer(doc_id, text):
    """The query's row."""
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute(w)
    top = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        top = (s, length, q, 1000 * length // q)
    text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *top, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs)).hexdigest())


def order(rows):
    return sorted(rows, key=repr)


def test_runs_of_random_texts(spark):
    """Nested repeats, chance repeats of small alphabets, repeats of repeats, shared among many texts of a block."""
    rng = random.Random(12)
    rows = [(0, "a " * 23), (1, "a " * 24), (2, "a b c d e f g h " * 3), (3, "a b c d e f g h i " * 2 + "a b c d e f g h"), (4, "a\t" * 5000), (5, "a b " * 40 + "a " * 50 + "b a " * 30), (6, "é 日本\n" * 12)]
    for i in range(300):
        w = [f"w{rng.randrange(rng.choice([1, 2, 3, 5, 50]))}" for _ in range(rng.choice([0, 5, 30, 100, 200]))]
        for _ in range(rng.randrange(4)):
            p, c = rng.randint(1, 14), rng.randint(2, 9)
            at = rng.randrange(len(w) + 1)
            w[at:at] = ([f"u{rng.randrange(3)}" for _ in range(p)] * c)[: max(1, p * c - rng.randrange(p))]
        w = w + w[: rng.randrange(len(w) + 1)] if rng.random() < 0.4 else w
        rows.append((100 + i, " ".join(w * 3 if rng.random() < 0.2 else w)))
    got = periodic.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert order((r[0], [tuple(x) for x in r[1]], r[2]) for r in got) == order((i, brute(words(t)), collapsed(words(t), brute(words(t))).decode()) for i, t in rows)


def test_runs_of_words_that_only_a_weak_hash_confuses():
    """The Thue-Morse word, on which polynomials modulo a power of two agree by construction, repeated and alone."""
    w = [bin(i).count("1") & 1 for i in range(1 << 12)]
    w = w + w + w + w[:77]
    got = periodic.runs_of(np.array(w), np.zeros(len(w), int))
    assert [(int(s), int(e - s), int(q)) for q, s, e in zip(*got, strict=True)] == brute([str(x) for x in w]) == [(0, len(w), 1 << 12)]


def test_runs_of_nulls_blanks_repeated_rows_and_other_columns(docs, rows):
    got = periodic.find(docs).collect()
    assert order((r[0], [tuple(x) for x in r[1]], r[2]) for r in got) == order((i, brute(words(t)), collapsed(words(t), brute(words(t))).decode()) for i, t in rows)


def test_runs_query(spark, docs, rows, none, tmp_path):
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    none.write.parquet(f"{tmp_path}/b/documents.parquet")
    assert order(tuple(r) for r in periodic.query(spark, f"{tmp_path}/a").collect()) == order(answer(*r) for r in rows)
    assert periodic.query(spark, f"{tmp_path}/b").collect() == []


def test_runs_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = periodic.query(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [answer(*r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sum(r[1] > 0 for r in want) > 10
    assert order(tuple(r) for r in got.collect()) == order(want)


def test_one_very_long_text(spark):
    rng = random.Random(4)
    text = prose(rng, 60_000) + " " + (prose(rng, 701) + " ") * 9 + prose(rng, 30_000)
    (got,) = periodic.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in got["runs"]] == brute(words(text)) and len(got["runs"]) == 1
