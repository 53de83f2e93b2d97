"""Operators 1, 2, 6 and 8 against brute force and round trips."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pagelex.llm import bpe, fingerprint, lm_score, tokens, warc
from pagelex.llm.common import written
from pagelex.session import ensure_checkpoint_dir
from pyspark.sql import functions as F

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_bpe(docs, rows):
    got = sorted(map(tuple, bpe.digest(docs).collect()), key=repr)
    want = []
    for d, t in rows:
        ids = ENCODING.encode_ordinary(t or "")
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert got == sorted(want, key=repr)


def test_bpe_without_frequent_words(docs, rows, none):
    got = {(r.doc_id, tuple(r.ids)) for r in bpe.encode(docs, RANKS, most=0).collect()}
    assert got == {(d, tuple(ENCODING.encode_ordinary(t or ""))) for d, t in rows}
    assert bpe.digest(none).count() == 0


def test_bpe_split_and_merge(spark):
    import regex

    rng = random.Random(2)
    signs = list("abst  re'’ll  vem\n\t\r'''ds12 .,!é日　½İ")
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["it's''s '' 's", " ", "'s", "a'", "'"]
    table = bpe.classes()
    found = []
    for part, data, offsets in tokens.blocks([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]):
        w = bpe.Words(data, offsets, table)
        found += [[w.word(j) for j in range(w.first[i], w.first[i + 1])] for i in range(part.num_rows)]
    assert found == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    words = ["thntblere", " worthless", "é日本", "a" * 300, "zq" * 90, "\n\n", " ½", "x"]
    want = [ENCODING._core_bpe.encode_single_piece(w.encode()) for w in words]
    assert [bpe.merge(w.encode(), RANKS) for w in words] == want
    assert [bpe.merge_long(w.encode(), RANKS) for w in words] == want
    folded = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("i", bpe.fold(F.col("w"), RANKS).alias("ids")).collect()
    assert [list(r.ids) for r in sorted(folded)] == want


def brute_tree(text):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    sections, leaves = [([], "")], set()
    for p in text.split("\n"):
        own = [md5(p[i : i + 64]) for i in range(0, len(p), 64)]
        node = md5("".join(own))
        nodes, body = sections.pop()
        ends = node[0] <= "3"
        sections.append(([*nodes, node], body + node[:16] + ":" + "".join(x[:8] for x in own) + ("" if ends else ",")))
        if ends:
            sections.append(([], ""))
        leaves |= {x[:8] for x in own}
    # the last section's paragraphs are each closed by a comma
    at = [md5(",".join(n) + ("," if n and i == len(sections) - 1 else "")) for i, (n, _) in enumerate(sections)]
    return sha(",".join(at)) + "#" + "|".join(f"{n[:16]}={body}" for n, (_, body) in zip(at, sections, strict=True)), leaves


def likeness(a, b):
    if a[0].split("#")[0] == b[0].split("#")[0]:
        return 1.0
    both = len(a[1]) + len(b[1])
    return 2 * len(a[1] & b[1]) / both if both else 0.0


def test_fingerprint(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, fingerprint.query(spark, str(tmp_path)).collect()), key=repr)
    placed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for i, (d, t) in enumerate(placed):
        t, after = t or "", placed[(i + 1) % len(placed)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, e, n = brute_tree(t), brute_tree(edited), brute_tree(after)
        want.append((d, len(t), sha(edited), a[0], e[0], likeness(a, e), likeness(a, n)))
    assert got == sorted(want, key=repr)


def test_fingerprint_order_over_many_buckets(spark):
    ids = random.Random(4).sample(range(10**12), 300) + list(range(700))
    rows = fingerprint.with_next(spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string").repartition(5)).collect()
    ids.sort()
    assert sorted((r.doc_id, int(r.next)) for r in rows) == list(zip(ids, ids[1:] + ids[:1], strict=True))


def test_fingerprint_locates_edits(spark):
    text = "\n".join(f"paragraph {i} says {i * i}" for i in range(30))
    rows = spark.createDataFrame([(text, text), (text, text.replace("says 49", "says 50")), ("", ""), (text, "")], "a string, b string")
    got = rows.select(fingerprint.changed(fingerprint.tree(F.col("a"))["fingerprint"], fingerprint.tree(F.col("b"))["fingerprint"]).alias("x")).collect()
    assert [list(r.x) for r in got] == [[], [7], [], list(range(30))]


def test_fingerprint_holds_its_tree(spark):
    """Each inner node follows from its leaves' branch alone: an edit changes its own paragraph's, its section's and the root."""
    lines = [f"line {i} of {i * 7}" for i in range(60)]
    texts = ["\n".join(lines), "\n".join([*lines[:41], "edited", *lines[42:]])]
    a, b = (r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", fingerprint.tree(F.col("t"))["fingerprint"].alias("x")).orderBy("i").collect())
    assert a.split("#")[0] != b.split("#")[0]
    sections = [x.split("#")[1].split("|") for x in (a, b)]
    gone, new = set(sections[0]) - set(sections[1]), set(sections[1]) - set(sections[0])
    assert 1 <= len(gone) <= 2 and 1 <= len(new) <= 2 and len(sections[0]) > 8
    nodes = lambda s: {p.split(":")[0] for x in s for p in x.split("=")[1].split(",") if p}
    assert len(nodes(gone) - nodes(new)) == len(nodes(new) - nodes(gone)) == 1


def brute_base(rows, training):
    cut = lambda t: [*(t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split(), None]
    count = Counter(w for d, t in rows if training(d) for w in cut(t))
    total, kinds = sum(count.values()), len(count)
    out = []
    for d, t in rows:
        w = cut(t)
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        out.append((d, len(w), sum(count[x] > 0 for x in w), total, round(base, 6)))
    return sorted(out, key=repr)


def test_lm_score(docs, rows, none):
    remainder = lambda d: 0 if d is None else zlib.crc32(str(d).encode()) % 10
    for most in (lm_score.WORDS, 5):
        got = lm_score.score(docs, docs.where(F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)), F.lit(1)) != 0), most).collect()
        assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == brute_base(rows, lambda d: d is None or remainder(d) != 0)
        assert all(r.score <= 1e-9 and r.bits_per_byte >= -1e-9 and math.isfinite(r.score) for r in got)
        same = {}
        for r in got:
            same.setdefault((r.doc_id, r.n_tokens, round(r.base_score, 6)), set()).add(round(r.score, 6))
        assert all(len(x) == 1 for x in same.values())
    assert lm_score.score(none, none).count() == 0
    untrained = lm_score.score(docs, none).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in untrained)


def test_lm_score_is_a_probability(spark):
    """Over a vocabulary of two words, the texts of one word and their rest sum up to at most one."""
    training = spark.createDataFrame([(i, "aa bb aa" if i % 2 else "bb") for i in range(50)], "doc_id long, text string")
    texts = spark.createDataFrame([(0, ""), (1, "aa"), (2, "bb"), (3, "zz"), (4, "aa aa"), (5, "bb aa")], "doc_id long, text string")
    total = sum(10**r.score for r in lm_score.score(texts, training).collect())
    assert 0.2 < total <= 1 + 1e-9


def test_lm_score_knows_the_word_that_follows(spark):
    """Among words of one class, and among those beyond the frequent ones, too."""
    n = 2000
    pairs = [(i, f"a{i} b{i}") for i in range(n)]
    training = spark.createDataFrame([(k * n + i, t) for k in range(4) for i, t in pairs], "doc_id long, text string").repartition(4)
    texts = spark.createDataFrame([*pairs[:200], *[(n + i, f"a{i} b{i + 1}") for i in range(200)]], "doc_id long, text string")
    for most in (lm_score.WORDS, 5):
        got = {r.doc_id: r.score for r in lm_score.score(texts, training, most).collect()}
        assert all(got[i] > got[n + i] + 1 for i in range(200))
        assert sum(got[i] for i in range(200)) / 200 > -4.5  # the first of 2000 words costs 3.3


def test_lm_score_counts_in_every_context(spark, monkeypatch):
    """Parts hold every occurrence once, with how often the nodes of its path follow in each context of training texts."""
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"w{k}" for k in rng.zipf(1.3, rng.integers(0, 40)) % 300), bool(rng.integers(0, 4))) for _ in range(120)]
    texts = spark.createDataFrame(rows, "text string, train boolean").withColumn("text_hash", F.xxhash64("text")).repartition(3)
    monkeypatch.setattr(lm_score, "PART", 200)
    for most, heavy in ((lm_score.WORDS, 300), (20, 3)):
        v = lm_score._vocabulary(lm_score.count_tokens(texts.where("train")), most)
        v["heavy"] = min(heavy, len(v["hash"]))
        held = spark.sparkContext.broadcast(v)
        store = written(lm_score.encoded(texts, held), "texts")
        layout = lm_score._layout(store, v)
        names = [t.split() for t, _ in rows]
        hashes = lambda w: lm_score._tokens(np.frombuffer(" ".join(w).encode(), np.uint8), np.array([0, len(" ".join(w))]))[0]
        for classes in (True, False):
            deep = 0 if classes else int(v["bits"].max())
            brute, counts = Counter(), [Counter(), Counter(), Counter()]
            seen = []
            for w, (_, train) in zip(names, rows, strict=True):
                h = hashes(w)
                at = lm_score.tokens.find(v["hash"], v["top"], h)
                rank = [int(v["rank"][i]) if i >= 0 else len(v["hash"]) for i in at]
                close = int(v["kinds"][rank[-1]])
                before = ["", "", *[int(x) for x in h[:-1]]]
                kinds = [close, close, *[int(v["kinds"][r]) for r in rank]]
                for i, r in enumerate(rank):
                    kind, bits = kinds[i + 2], int(v["bits"][kinds[i + 2]])
                    if not classes and not bits:
                        continue
                    last = r - int(v["start"][kind]) if kind != lm_score.RARE else int(h[i]) >> (64 - bits) if bits else 0
                    path = kind << deep | last << (deep - bits) if deep else kind
                    contexts = (kinds[i + 1], kinds[i]), before[i + 1], (before[i], before[i + 1])
                    seen.append((contexts, path, lm_score.BITS + (0 if classes else bits)))
                    for c, n in zip(contexts, counts, strict=True):
                        n.update((c, b, path >> (lm_score.BITS + deep - b)) for b in range(lm_score.BITS + deep + 1) if train)
            for contexts, path, length in seen:
                for b in range(0 if classes else lm_score.BITS, length + 1):
                    brute[(b, *(n[c, b, path >> (lm_score.BITS + deep - b)] for c, n in zip(contexts, counts, strict=True)))] += 1
            dealt = lm_score.dealt(store, held, spark.sparkContext.broadcast(layout), classes).toArrow()
            got = Counter()
            for part in lm_score._parts(v, layout, dealt.to_batches(), classes):
                for c in part.contexts:
                    c.begin(part.first, False)
                for b in range(part.first, int(part.length.max()) + 1):
                    at = part.row[part.length[part.row] >= b]
                    got.update((b, *map(int, x)) for x in zip(*(c.total[at if c.at is None else c.at[at]] for c in part.contexts[1:]), strict=True))
                    for c in part.contexts:
                        c.step(b)
            assert got == brute


def test_lm_score_writes_little(spark):
    """What is kept between its steps is a few bytes a token; it was some 50."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 3000, 400))) for i in range(150)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in folder.rglob("*.parquet"))
    before = size()
    assert lm_score.score(texts).count() == 150
    assert size() - before < 15 * 150 * 400


def test_lm_score_counts_along_paths():
    rng = np.random.default_rng(4)
    rows = sorted({(int(c), int(k) << 56) for c, k in rng.integers(0, [5, 256], (300, 2))})
    context, code = (np.array(x, np.uint64) for x in zip(*rows, strict=True))
    n = rng.integers(0, 9, len(rows))
    got = lm_score._path_totals(context, code, n, np.full(len(rows), 8))
    for i in range(len(rows)):
        for b in range(9):
            inside = (context == context[i]) & (code // np.uint64(1 << (64 - b)) == code[i] // np.uint64(1 << (64 - b)) if b else True)
            assert got[i, b] == n[inside].sum()


def test_warc(spark, tmp_path):
    pages = [(5, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "http://b/", None), (7, "http://c/", ""), (None, "http://d/", "<p>é</p>"), (3, "http://e/", "y" * 300_000),
             (3, "http://e/", "y" * 300_000), (11, "http://f/", "WARC/1.1\r\n\r\n\x1f\x8b")]
    frame = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    warc.write_pages(frame, f"{tmp_path}/a")
    rows = warc.read(spark, f"{tmp_path}/a", split="1000").collect()
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(x for x in (i, first.get(h or "")) if x is not None)
    want = []
    for i, u, h in pages:
        body = (h or "").encode()
        again = i != first[h or ""]
        want.append((None if i is None else f"urn:page:{i}", "revisit" if again else "response", u and u.replace("\r\n", "%0D%0A"), f"urn:page:{first[h or '']}" if again else None,
                     base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body), None if again else body, None if again else True))
    assert sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in rows), key=repr) == sorted(want, key=repr)
    pushed = warc.read(spark, f"{tmp_path}/a", payload="false").where("record_type = 'revisit'")
    assert pushed.count() == sum(w[1] == "revisit" for w in want)
    reader = warc.WarcReader({"path": f"{tmp_path}/a"})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)])) == [warc.EqualTo(("payload_length",), 3)]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == pushed.count()
    warc.write_pages(frame.where("false"), f"{tmp_path}/none")
    assert warc.read(spark, f"{tmp_path}/none").count() == 0


def test_warc_reads_other_archives(spark, tmp_path):
    """Plain gzip members without lengths, and no compression, without index or manifest."""
    import gzip

    records = [warc.record(f"urn:page:{i}", "response", f"http://x/{i}", None, b"z" * i) for i in (1, 70_000, 3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    got = warc.read(spark, str(tmp_path)).select("payload_length", "digest_ok").collect()
    assert sorted(map(tuple, got)) == sorted([(n, True) for n in (1, 70_000, 3)] * 2)


def test_a_path_holds_the_records_of_all_writes(spark, tmp_path):
    """A second write adds to the first; one in overwrite mode replaces them."""
    pages = spark.createDataFrame([(1, "http://a", "<p>x</p>"), (2, None, None), (3, "http://c", "z")], "page_id long, url string, html string")
    path = f"{tmp_path}/more"
    warc.write_pages(pages.where("page_id < 3"), path)
    warc.write_pages(pages.where("page_id = 3"), path)
    warc.write_pages(pages.where("false"), path)
    assert sorted(r.record_id for r in warc.read(spark, path).collect()) == ["urn:page:1", "urn:page:2", "urn:page:3"]
    one = spark.createDataFrame([("urn:page:9", "response", "http://n", None, b"n")], "record_id string, record_type string, target_uri string, refers_to string, payload binary")
    one.write.format("warc").mode("overwrite").save(path)
    assert [(r.record_id, bytes(r.payload)) for r in warc.read(spark, path).collect()] == [("urn:page:9", b"n")]
