"""Operators 7, 9 and 10: held-out accuracy on the given tables, and defined results."""

import math
import zlib

import numpy as np
import pytest
from pagelex.llm import language, quality, toxicity
from pagelex.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def shares(df, label):
    """Recall of each label among the rows that were held out."""
    got = df.where("held_out").groupBy(label).agg(F.avg((F.col(label) == F.col("predicted")).cast("int")).alias("x")).collect()
    return {r[label]: r.x for r in got}


def test_quality(spark, labels):
    got = shares(quality.query(spark, SF).join(labels, "doc_id"), "quality")
    assert got[1] > 0.99 and got[0] > 0.93


def test_toxicity(spark, labels):
    got = shares(toxicity.query(spark, SF).join(labels, "doc_id"), "toxic")
    assert got[0] > 0.97 and got[1] > 0.8


def test_language(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    got = language.query(spark, SF).join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.99


def test_defined_results(spark, docs, rows, none):
    labels = spark.createDataFrame([(i * 3, i % 2, i % 2, "w") for i in range(12)] + [(3, None, 1, "w"), (None, 1, 0, "w")], "doc_id long, quality int, toxic int, text string")
    for got in (quality.score(docs, quality.fit(docs, labels)), toxicity.score(docs, toxicity.fit(docs, labels))):
        found = got.collect()
        assert sorted(map(repr, (r.doc_id for r in found))) == sorted(map(repr, (d for d, _ in rows)))
        assert all(0 <= r.score <= 1 for r in found)
    kept = toxicity.without_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    no_labels = labels.where("false")
    assert {r.score for r in quality.score(docs, quality.fit(docs, no_labels)).collect()} == {0.5}
    assert toxicity.without_toxic(docs, toxicity.fit(docs, no_labels)).count() == docs.count()
    assert quality.score(none, quality.fit(none, no_labels)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, no_labels)).count() == 0


def test_language_of_nothing(spark, docs, none):
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, language.fit(docs)).collect()}
    assert found[105] == found[106] == found[107] == ("und", 0.0) and found[112][0] == "en"
    assert {r.lang_pred for r in language.predict(docs, language.fit(none)).collect()} == {"und"}
    assert language.predict(none, language.fit(docs)).count() == 0


def test_toxicity_learns_from_every_unlabelled_row(spark):
    """The weights are those of a plain loop over all rows, also where they are more than any sample was."""
    n = 20_000
    words = ["vile", "foul", "calm", "mild"]
    text = lambda i: " ".join(["vile" if i % 40 == 0 else "calm", *(["foul"] if i % 31 == 0 or i % 80 == 0 else []), *(["mild"] if i % 3 else [])])
    docs = spark.createDataFrame([(i, text(i)) for i in range(n)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 40 == 0)) for i in range(0, 4000, 8)], "doc_id long, toxic int")
    fold = [zlib.crc32(str(i).encode()) % 3 != 1 for i in range(n)]
    p = [i for i in range(0, 4000, 40) if fold[i]]
    u = [i for i in range(n) if fold[i]]
    prior = len(p) / sum(fold[i] for i in range(0, 4000, 8))
    x = np.array([[w in text(i).split() for w in words] for i in range(n)], float)
    used = [j for j in range(len(words)) if prior * (x[p, j].sum() + 0.5) / (len(p) + 1) > 0.5 * (x[u, j].sum() + 0.5) / (len(u) + 1) and x[p, j].sum() >= 3 and x[p, j].mean() > x[u, j].mean()]
    # each word stands for itself and its first four bytes, which are the same feature, so one column a word
    a, b = np.c_[x[p][:, used], np.ones(len(p))], np.c_[x[u][:, used], np.ones(len(u))]
    w = np.zeros(a.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = 0 * w, 0 * w
    for step in range(1, 31):
        sp, su = 1 / (1 + np.exp(-a @ w)), 1 / (1 + np.exp(-b @ w))
        low = b.T @ su / len(u) - prior * (a.T @ sp) / len(p)
        positive = np.logaddexp(0, b @ w).mean() >= prior * np.logaddexp(0, a @ w).mean()
        g = prior * (a.T @ (sp - 1)) / len(p) + low if positive else -low
        g[:-1] += 1e-4 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    model = toxicity.fit(docs, labels, steps=30)
    got = sorted(model.weights[:-1].tolist())
    assert len(used) >= 2 and np.allclose(got, sorted(w[:-1]), atol=1e-3) and abs(model.bias - w[-1]) < 1e-3


def test_language_is_the_kernel_solution(spark):
    """The values are those of ridge regression solved directly on kernels counted from sets, ids and texts repeated or not."""
    rng = np.random.default_rng(5)
    signs = {"aa": "abcdef ", "bb": "defghi ", "cc": "ghijkl日 "}
    rows = [(i, lang, "".join(rng.choice(list(signs[lang]), int(rng.integers(1, 60))))) for i, lang in enumerate(rng.choice(list(signs), 90).tolist())]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    marks_n, ridge = 12, 1e-2
    model = language.fit(docs, per_language=15, landmarks=marks_n, ridge=ridge)
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    picked = []
    for lang in signs:
        own = sorted({r for r in rows if r[1] == lang and zlib.crc32(str(r[0]).encode()) % 3 != 1}, key=lambda r: order[r[0]])[:15]
        picked += [(at, lang, text) for at, (_, _, text) in enumerate(own)]
    picked.sort(key=lambda r: r[:2])
    sets = lambda texts: [set(np.flatnonzero(x)) for x in language.presence(texts)]
    kernel = lambda a, b: np.array([[len(p & q) / math.sqrt(max(len(p), 1) * max(len(q), 1)) for q in b] for p in a])
    x = sets([r[2] for r in picked])
    z = x[:marks_n]
    k, within = kernel(x, z), kernel(z, z)
    y = np.array([[1.0 if r[1] == lang else -1.0 for lang in sorted(signs)] for r in picked])
    alpha = np.linalg.solve(k.T @ k + ridge * len(x) * within + 1e-6 * np.eye(marks_n), k.T @ y)
    texts = [r[2] for r in rows]
    value = kernel(sets(texts), z) @ alpha
    want = {(i, sorted(signs)[v.argmax()], round(float(np.clip((1 + v.max()) / 2, 0, 1)), 3)) for (i, _, t), v in zip(rows, value, strict=True) if any(c.isalpha() for c in t)}
    got = {(r.doc_id, r.lang_pred, round(r.score, 3)) for r in language.predict(docs, model).collect() if r.lang_pred != "und"}
    assert len(model.languages) == 3 and len(got & want) >= 0.95 * len(want) and {g[:2] for g in got} == {w[:2] for w in want}


def test_language_of_more_languages_than_landmarks(spark):
    rows = [(i, f"l{i % 20:02}", chr(0x4E00 + 50 * (i % 20)) * 6 + f" {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = language.predict(docs, language.fit(docs, landmarks=4)).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {r[:2] for r in rows}


def test_quality_sums_every_pair():
    """The machine's value is that of all pairs of inputs written out."""
    rng = np.random.default_rng(2)
    texts = ["One two two, three! 4 five.", "", "a b c d e f g", "Mixed CASE words and 12 numbers; (marks) too"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    doc, place, share, stats = quality.words(data, offsets)
    size, width = 1 << quality.BITS, stats.shape[1]
    model = quality.Model(0.3, rng.normal(size=size + width), rng.normal(0, 0.3, (size + width, quality.RANK)), rng.normal(size=width), rng.uniform(1, 2, width))
    for i, value in enumerate(quality._value(model, doc, place, share, stats)):
        inputs = [*zip(place[doc == i].tolist(), share[doc == i].tolist(), strict=True), *((size + j, x) for j, x in enumerate((stats[i] - model.mean) / model.scale))]
        want = model.bias + sum(model.w[f] * x for f, x in inputs)
        want += sum((model.v[f] @ model.v[g]) * x * y for n, (f, x) in enumerate(inputs) for g, y in inputs[n + 1 :])
        assert abs(value - want) < 1e-6 * max(1, abs(want))
