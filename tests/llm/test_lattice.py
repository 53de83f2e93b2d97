"""Operator 13 against all pairs by brute force."""

import math

import numpy as np

from pagelex.llm import lattice
from pagelex.llm.common import table


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector)."""

    def fine(v):
        return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)

    n = len(rows)
    links, label = [0] * n, list(range(n))
    at = [i for i in range(n) if fine(rows[i][1])]
    for d in {len(rows[i][1]) for i in at}:
        own = [i for i in at if len(rows[i][1]) == d]
        x = np.array([rows[i][1] for i in own], dtype=float)
        x /= np.abs(x).max(1, keepdims=True)
        cosine = x @ x.T / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
        for p, q in zip(*np.nonzero(cosine >= least), strict=True):
            if p != q:
                links[own[p]] += 1
                old, new = label[own[q]], label[own[p]]
                if old != new:
                    label = [new if z == old else z for z in label]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec_id, links[i], component, component is None or vec_id == component))
    return out


def order(rows):
    return sorted(rows, key=repr)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, "x", 1.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, digest string, cell double").repartition(4)


def beside(rng, v, cosine):
    """A vector at the cosine from v."""
    z = rng.standard_normal(len(v))
    z -= (z @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.uniform(-3, 3, (300, 8))
    point = lattice.decode(x)
    assert (np.abs(2 * point - np.rint(2 * point)) < 1e-9).all() and ((point.sum(1) % 2) == 0).all()
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(1), 2)
    near = ((x[:, None] - point[:, None] - lattice.ROOTS[None]) ** 2).sum(2)
    assert (((x - point) ** 2).sum(1)[:, None] <= near + 1e-9).all()


def test_links_and_components(spark):
    """Groups, chains, exact copies, scaled and opposite vectors, other lengths, odd vectors, repeated and null ids."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(32).tolist()) for i in range(300)]
    for k in range(12):
        v = rng.standard_normal(32)
        rows += [(1000 + 100 * k + j, beside(rng, v, 0.992).tolist()) for j in range(int(rng.integers(2, 30)))]
    chain = rng.standard_normal(32)
    for j in range(15):
        rows.append((5000 - j, chain.tolist()))
        chain = beside(rng, chain, 0.965)
    rows += [(6000 + j, rows[7][1]) for j in range(70)] + [(6100, [3 * c for c in rows[7][1]]), (6101, [-c for c in rows[7][1]])]
    rows += [(None, rows[8][1]), (8, rows[8][1]), (None, rng.standard_normal(32).tolist()), (6200, rows[9][1][:31]), (6201, rows[9][1][:31])]
    rows += [(6300, None), (6301, []), (6302, [0.0] * 32), (6303, [0.0] * 32), (6304, [1.0] * 31 + [None]), (6305, [math.nan] + [1.0] * 31), (6306, [math.inf] * 32), (None, None), (6307, [-0.0, 1.0]), (6308, [0.0, 1.0])]
    want = brute([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows])
    got = lattice.near(frame(spark, rows, "double"))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert order(tuple(r) for r in got.collect()) == order(want)


def test_large_cells_are_dealt_into_blocks(spark, monkeypatch):
    """A group far larger than a block, with small limits; every pair still counts once."""
    monkeypatch.setattr(lattice, "CELL", 16)
    monkeypatch.setattr(lattice, "SMALL", 6)
    monkeypatch.setattr(lattice, "STRIPE", 5)
    rng = np.random.default_rng(4)
    v = rng.standard_normal(24)
    rows = [(i, beside(rng, v, 0.985).tolist()) for i in range(220)] + [(500 + i, rng.standard_normal(24).tolist()) for i in range(40)]
    rows += [(900 + i, rows[0][1]) for i in range(5)]
    got = lattice.near(frame(spark, rows, "double"))
    assert order(tuple(r) for r in got.collect()) == order(brute(rows))


def test_recall_of_pairs_at_the_bound(spark):
    """Pairs whose cosine is just above the bound, the hardest ones: 0.98 of them at least are found."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(1500):
        v = rng.standard_normal(64)
        rows += [(2 * k, v.tolist()), (2 * k + 1, beside(rng, v, 0.9501).tolist())]
    got = lattice.near(frame(spark, rows, "double")).collect()
    assert sum(r.n_links == 1 for r in got) >= 0.98 * len(rows) and all(r.n_links <= 1 for r in got)
    assert all(r.component_id in (r.vec_id, r.vec_id - 1) for r in got)


def test_lattices_follow_size_and_dimension():
    assert [lattice.blocks_for(n) for n in (0, 10**5, 10**6, 10**9)] == [2, 2, 2, 3]
    assert 4 <= lattice.tables_for(64, 2) <= 8 <= lattice.tables_for(64, 3) <= 30


def test_query(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert order(tuple(r) for r in lattice.query(spark, sf).collect()) == order(brute(rows))
    frame(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert lattice.query(spark, str(tmp_path)).collect() == []
