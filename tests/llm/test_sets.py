"""Operators 3, 4 and 5 against brute force."""

import itertools
import random

from conftest import prose
from pagelex.llm import decontaminate, line_dedup, ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if similar(sets[a], sets[b]):
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def order(rows):
    return sorted(rows, key=repr)


def test_ngram_join(docs, rows):
    assert order(tuple(r) for r in ngram_join.linked(docs).collect()) == order(components(rows))


def test_ngram_join_chains_and_copies(spark):
    """A chain of near copies links its ends; groups of near copies of one text, and one that shares a passage only."""
    rng = random.Random(5)
    text = prose(rng, 80).split()
    chain = [list(text)]
    for at in range(0, 40, 2):
        chain.append(list(chain[-1]))
        chain[-1][at] = f"w{at}"
    passage = prose(rng, 30)
    rows = [(i, " ".join(c)) for i, c in enumerate(chain)]
    rows += [(100 + i, prose(rng, 50) + " " + passage) for i in range(20)]
    rows += [(200 + i, " ".join(f"c{i}" if j == 7 * i % 80 else w for j, w in enumerate(reversed(text)))) for i in range(30)]
    got = ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert order(tuple(r) for r in got.collect()) == order(components(rows))


def test_ngram_join_deals_the_matrix_once(docs, monkeypatch):
    """The rows of tokens and groups are shuffled by token once, whatever their size; window, groups and join share that exchange."""
    plans, real = {}, ngram_join.written

    def written(df, name):
        out = real(df, name)
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    spark = docs.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        ngram_join.linked(docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    dealt = [line for line in plans["met"].splitlines() if "Exchange hashpartitioning(tok" in line and "ReusedExchange" not in line]
    assert "matrix" not in plans and len(dealt) == 1


def test_one_of_each(docs, rows):
    """One row of each component, by row: repeated and null ids are judged by their texts; rows without words all stay."""
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if similar(sets[a], sets[b]):
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert order(r for r in got if not words(r[1])) == order(r for r in rows if not words(r[1]))
    groups = [[rows[i] for i in range(len(rows)) if label[i] == c and sets[i]] for c in set(label)]
    least = [min((r[0] is None, r[0] or 0) for r in g) for g in groups if g]
    assert sorted((r[0] is None, r[0] or 0) for r in got if words(r[1])) == sorted(least)
    assert all(r in rows for r in got)


def test_one_of_each_of_repeated_and_null_ids(spark):
    rng = random.Random(4)
    a, b, c = (prose(rng, 40) for _ in range(3))
    rows = [(1, a), (1, b), (2, a), (None, a), (None, c), (None, c), (3, ""), (3, ""), (None, None), (4, b), (1, b)]
    frame = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, _text_hash long, id string").repartition(3)
    got = ngram_join.one_of_each(frame)
    assert got.columns == frame.columns
    assert order(tuple(r)[:2] for r in got.collect()) == order([(1, a), (1, b), (None, c), (3, ""), (3, ""), (None, None)])


def gone_lines(rows):
    last = 1 << 63
    lines = [((last if d is None else d, i), shingles(x)) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if words(x)]
    return {p for p, s in lines if any(q < p and similar(s, z) for q, z in lines)}


def test_line_dedup(docs, rows):
    got = {((1 << 63) if r.doc_id is None else r.doc_id, r.line_no) for r in line_dedup.repeated(docs).collect()}
    assert got == gone_lines(rows) and len(got) > 5
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    every = [(((1 << 63) if d is None else d, i), shingles(x)) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if words(x)]

    def cut(d, t):
        """Without the lines that match a line at an earlier place, whatever else stands at the same place."""
        at = (1 << 63) if d is None else d
        lines = [] if t is None else t.split("\n")
        return t if t is None else "\n".join(x for i, x in enumerate(lines) if not any(p < (at, i) and similar(s, shingles(x)) for p, s in every))

    assert order((r.doc_id, r.text) for r in kept.collect()) == order((d, cut(d, t)) for d, t in rows)


def test_line_dedup_of_null_ids_and_clashing_names(spark, tmp_path):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(1, line + "\nyes", "k", 1), (None, "own text here\n" + line, "k", 2), (None, "yes\nother", "k", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _gone string, lines int")
    assert order(tuple(r) for r in line_dedup.without_repeated_lines(frame).collect()) == order([rows[0], (None, "own text here", "k", 2), (None, "other", "k", 3)])
    frame.select("doc_id", "text").limit(2).write.parquet(f"{tmp_path}/documents.parquet")
    assert order(tuple(r) for r in line_dedup.query(spark, str(tmp_path)).collect()) == order([(1, 2, 0, ""), (None, 2, 1, "1")])


def test_line_dedup_near_copies(spark):
    rng = random.Random(8)
    text = prose(rng, 60).split()
    rows = []
    for d in range(40):
        own = list(text)
        own[rng.randrange(60)] = f"q{d}"
        rows.append((d, prose(rng, 30) + "\n" + " ".join(own) + "\nshort line here"))
    got = {(r.doc_id, r.line_no) for r in line_dedup.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == gone_lines(rows) and len(got) > 30


def contained(item, text):
    w, k = words(item), min(5, len(words(item)))
    own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    t = words(text)
    there = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)} if k else set()
    return len(own), len(own & there)


def test_decontaminate(spark, docs, rows):
    long = dict((d, t) for d, t in rows if d is not None)[112]
    w = long.split()
    items = [(1, " ".join(w[1000:1030]).upper()), (2, " ".join([*w[2000:2020], "not", "there"])), (3, " ".join([*w[5:15], *w[900:910]])), (4, None), (5, " "),
             (6, "three words"), (7, "words three"), (8, rows[2][1]), (8, rows[2][1]), (None, rows[3][1])]
    table = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    want = set()
    for d, t in rows:
        for i, x in items:
            n, shared = contained(x, t)
            if n and 100 * shared >= 75 * n:
                want.add((d, i, n, shared))
    got = decontaminate.leaks(docs, table).collect()
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got} == want and len(want) > 6
    block = decontaminate.BLOCK
    decontaminate.BLOCK = 20  # several passes
    try:
        assert sorted(map(repr, decontaminate.leaks(docs, table).collect())) == sorted(map(repr, got))
    finally:
        decontaminate.BLOCK = block
    kept = decontaminate.without_leaks(docs, table)
    assert kept.columns == docs.columns
    assert order((r.doc_id, r.text) for r in kept.collect()) == order((d, t) for d, t in rows if not any(n and 100 * s >= 75 * n for n, s in (contained(x, t) for _, x in items)))


def test_decontaminate_sql_and_index(spark, tmp_path):
    """The SQL tells the same as the query, of short items and repeated ones too, and keys are sent without the shingles."""
    import duckdb

    long = " ".join(f"w{i}" for i in range(3000))
    docs = [(1, long + " end"), (2, "only three words here"), (3, None), (4, "Three   WORDS"), (5, "nothing"), (6, "")]
    items = [(1, long), (2, "three words"), (3, "nothing"), (4, ""), (5, None), (6, "w7 w8 w9 w10 w11 w12"), (6, "w7 w8 w9 w10 w11 w12"), (7, "w1 w2 w3 w4 w6")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate.query(spark, str(tmp_path))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(decontaminate.ORACLE)
    rows = sorted(tuple(r) for r in got.select(*want.columns).collect())
    assert rows == sorted(want.fetchall()) == [(1, 1, 2996, 2996), (1, 6, 2, 2), (2, 2, 1, 1), (4, 2, 1, 1), (5, 3, 1, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    sketches = [line for line in plan.splitlines() if "explode(sketch" in line]
    assert sketches and not any("shingles" in line for line in sketches)


def test_empty_tables(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.linked(none).count() == 0
    assert ngram_join.one_of_each(none).count() == 0
    assert line_dedup.without_repeated_lines(none).count() == 0
    assert decontaminate.without_leaks(none, items).count() == 0
