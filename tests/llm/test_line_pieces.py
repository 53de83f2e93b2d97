"""The pieces of the line join against plain Python: hashes of lines, shared tokens in a stream, sketches."""

import random

import numpy as np
import pyarrow as pa

from pagelex.llm import line_dedup, sets

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def test_hashes_of_lines_and_shingles():
    """Equal windows of words have equal hashes, others don't, in every line of every text of a block."""
    rng = random.Random(1)
    seen = {}
    for _ in range(200):
        texts = ["".join(rng.choice(["a", "B", " ", "\n", "\t", "word", "supercalifragilistic", " ", "é", "\x01", "\x00"]) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(6))]
        raw = [x.encode() for x in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)
        h, at, doc, line = line_dedup._lines(data, offsets)
        want = []
        for d, x in enumerate(raw):
            for i, part in enumerate(x.split(b"\n")):
                w = part.translate(LOWER).split()
                if w:
                    want.append((d, i, [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))]))
        assert [(int(a), int(b), int(c)) for a, b, c in zip(doc, line, np.diff(at), strict=True)] == [(d, i, len(s)) for d, i, s in want]
        for s, x in zip([s for *_, all_ in want for s in all_], h.tolist(), strict=True):
            assert seen.setdefault(s, x) == x
    assert len(set(seen.values())) == len(seen) > 1000


def test_shared_tokens_of_a_stream():
    """Tokens of two classes, whatever the batches' bounds; the head is one of the token's postings, the earliest of one batch."""
    rng = random.Random(2)
    for _ in range(500):
        rows = sorted(((rng.randrange(5), rng.randrange(6), rng.randrange(4)) for _ in range(rng.randrange(30))), key=lambda r: r[0])  # token, place, key
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(5)))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], pa.int64()) for i in (0, 2, 1)], ["tok", "key", "place"]) for p in parts]
        got = [tuple(r.values()) for b in line_dedup._shared(iter(batches)) for r in b.to_pylist()]
        want = {(t, k) for t, _, k in rows if len({r[2] for r in rows if r[0] == t}) > 1}
        assert {(t, k) for t, k, *_ in got} == want
        assert len({(t, head, at) for t, _, _, head, at in got}) == len({t for t, _ in want})
        assert all((t, p, k) in rows and (t, at, head) in rows for t, k, p, head, at in got)
        if not cuts:
            assert all(at == min(r[1] for r in rows if r[0] == t) and p == min(r[1] for r in rows if (r[0], r[2]) == (t, k)) for t, k, p, _, at in got)


def test_sketches_never_rule_out_similar_sets(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.append(a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, n // 8).astype(np.uint64)))
        if len(b):
            sa, sb = (sets.sketches(x, np.array([0, len(x)]), line_dedup.SKETCH)[0].tolist() for x in (a, b))
            common = len(np.intersect1d(a, b))
            rows.append((len(a), len(b), sa, sb, 100 * common >= 75 * (len(a) + len(b) - common)))
    got = spark.createDataFrame(rows, "na int, nb int, sa array<long>, sb array<long>, similar boolean").select("similar", line_dedup._may_match("na", "nb").alias("may"))
    assert sum(r[4] for r in rows) > 100 and all(r.may or not r.similar for r in got.collect())
