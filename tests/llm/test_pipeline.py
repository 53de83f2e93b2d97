"""The stages of the pipeline, each on what the one before it kept, and the registered SQL."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from pagelex.llm import bpe, toxicity
from pagelex.llm.common import written
from test_sets import components, contained, gone_lines, words

D = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, D), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, D).collect()
    assert len(last) == before
    assert sorted(r.doc_id for r in E.queries()["pipeline"](spark, D).collect()) == sorted(r.doc_id for r in last)


def test_each_stage_against_brute_force(spark):
    """What each stage keeps of all its predecessor kept, told by plain loops over the texts."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{D}/documents.parquet")

    def through(name, docs):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = written(stages[name](spark, docs, D), name)
        return before, after, {r.doc_id: r.text for r in after.select("doc_id", "text").collect()} if "text" in after.columns else None

    model = toxicity.fit(docs, spark.read.parquet(f"{D}/labels.parquet"))
    before, docs, kept = through("toxicity", docs)
    toxic = set()
    for doc_id, text in before:
        data = np.frombuffer((text or "").encode(), np.uint8)
        total = model.bias + sum(float(model.weights[model.column[f]]) for f in set(toxicity.features(data, np.array([0, len(data)]))[1].tolist()))
        if 1 / (1 + np.exp(-total)) >= 0.7:
            toxic.add(doc_id)
    assert kept == {d: t for d, t in before if d not in toxic} and toxic

    before, docs, kept = through("line_dedup", docs)
    gone, left = gone_lines(before), {}
    for doc_id, text in before:
        lines = text.split("\n") if text is not None else []
        rest = "\n".join(x for i, x in enumerate(lines) if (doc_id, i) not in gone)
        if not words(text) or words(rest):
            left[doc_id] = None if text is None else rest
    assert kept == left and gone and len(left) < len(before)

    before, docs, kept = through("ngram_join", docs)
    assert kept == {d: t for (d, t), (_, _, first) in zip(before, components(before), strict=True) if first == d}

    items = [r.text for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    before, docs, kept = through("decontamination", docs)
    leaks = {d for d, t in before if any(n and 100 * shared >= 75 * n for n, shared in (contained(x, t) for x in items))}
    assert kept == {d: t for d, t in before if d not in leaks} and leaks

    before, docs, _ = through("byte_bpe", docs)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for doc_id, text in before:
        ids = plain.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert sorted(tuple(r) for r in docs.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == sorted(want)


@pytest.mark.parametrize("name", ["op2_fingerprint", "op3_ngram_join", "op4_line_dedup", "op5_decontaminate", "op8_warc"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    got = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    df = E.queries()[name](spark, D)
    assert sorted(columns) == sorted(df.columns)
    clean = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(repr, map(clean, df.select(columns).collect()))) == sorted(map(repr, map(clean, got.fetchall())))


def test_short_repeated_lines_go(spark):
    """Copies of lines of one to four words go, whatever their case; other short lines and blank ones stay."""
    texts = ["Yes\n\nsee also here\nleft to right", "yes\n\nSee  also here\nright to left", "see also\n \nfour words are here\nYES", "four words are here\nfour words are here now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, docs, D).collect()}
    assert got == {0: texts[0], 1: "\nright to left", 2: "see also\n \nfour words are here", 3: "four words are here now"}


def test_documents_that_lose_every_line_go(spark):
    rows = [(1, "a line of its own\nyes"), (2, "Yes\n\nA line of its own"), (3, ""), (4, None), (5, " \n"), (6, "yes\nno")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n_chars long, before string")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_repeated_lines(spark, docs, D).collect()}
    assert got == {1: (rows[0][1], 21), 3: ("", 0), 4: (None, None), 5: (" \n", 2), 6: ("no", 2)}
