"""Operator 11 against plain whole-number arithmetic and numpy."""

import math
import random

import numpy as np
import pytest

from pagelex.llm import whitening
from pagelex.llm.common import table

NAN, INF = float("nan"), float("inf")


def fine(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def checked(rows, got):
    """Compares the result's rows with brute force over (vec_id, vector)."""
    rows = [(i, v) for i, v in rows if fine(v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - s[j] for j in range(d)] for r in x]
    deviation = [sum(c * c for c in r) for r in centred]
    v = np.array([[sum(r[i] * r[j] for r in centred) / n**3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(8, d)
    w = (np.array(centred, dtype=float) / n) @ u[:, :k] / np.sqrt(e[:k])
    want = {(rows[a][0], deviation[a], c + 1, round(abs(w[a, c]), 6)) for a in range(n) for c in range(k)}
    assert {(r.vec_id, r.deviation, r.component, round(abs(r.whitened), 6)) for r in got} == want
    assert len(got) == n * k and {r.n for r in got} == {n}
    for c in range(k):
        column = np.array([r.whitened for r in got if r.component == c + 1])
        assert {r.explained for r in got if r.component == c + 1}.pop() == pytest.approx(e[c] / np.trace(v), rel=1e-9)
        assert abs(column.mean()) < 1e-6 and abs((column**2).mean() - 1) < 1e-6
    (error,) = {r.identity_error for r in got}
    assert 0 <= error < 1e-7


def test_whitening_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    got = whitening.query(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    checked(rows, got.collect())


def test_whitening_of_odd_rows(spark):
    """Nulls, NaN, infinities, empty vectors, repeated ids and rows, null ids, other lengths, extra columns, one wide dimension."""
    rng = random.Random(2)
    rows = [(i % 150, [rng.gauss(0, 1), rng.gauss(5, 3), rng.gauss(0, 1e-2), rng.uniform(-900, 900), rng.random()]) for i in range(300)]
    rows += [rows[0], rows[0], (None, rows[1][1])]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [NAN, 0.0, 0.0, 0.0, 0.0]), (904, [0.0, INF, 0.0, 0.0, 0.0]), (905, [0.0, -INF, 0.0, 0.0, 0.0]), (906, [1.0] * 4), (907, [2.0] * 7)]
    frame = spark.createDataFrame([(i, v, 1.5, 7) for i, v in rows + odd], "vec_id long, embedding array<double>, n double, component int").repartition(5)
    got = whitening.whitened(frame).collect()
    checked(rows, got)


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema)).collect() == []
    got = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [(i, c, 0, None, 0.0, None) for i in (1, 2) for c in (1, 2)]
    got = whitening.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(20)], schema)).collect()
    assert {r.component for r in got if r.whitened is not None} == {1} and {r.identity_error < 1e-9 for r in got} == {True}


def test_exact_sums_beyond_long(spark):
    """Entries as large as they count: cross-products need over 100 bits, deviations exceed a long."""
    top = float(1 << 52)
    rows = spark.createDataFrame([(1, [top, 3e300]), (2, [-top, -3e300]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    w = whitening.fit(whitening.clean(rows))
    a = 1 << 52
    assert (w.n, w.sums) == (3, [300_000, 300_000 + 1024])
    low, high = np.array([-a, 0]), np.array([a, 5])
    data = [[a, 5], [-a, 0], [7, 3]]
    frame = spark.createDataFrame([([float(v - 100_000) / 1024 for v in r],) for r in [[100_000 + 1, 100_000 + 5], [100_000, 100_000]]], "embedding array<double>")
    assert whitening.scatter(frame, np.array([100_000, 100_000]), np.array([100_001, 100_005])) == ([1, 5], [[1, 5], [5, 25]])
    y = np.array(data) - low
    bits = max(int(h - lo).bit_length() for h, lo in zip(high, low, strict=True))
    pairs, single = np.zeros((2, 2, 2 * bits - 1), np.int64), np.zeros((2, bits), np.int64)
    whitening.add_common_ones(whitening.planes(y, bits), bits, pairs, single)
    assert whitening.weighted(pairs[0, 1].tolist()) == sum(int(r[0]) * int(r[1]) for r in y)
    assert whitening.weighted(pairs[0, 0].tolist()) == sum(int(r[0]) ** 2 for r in y)
    got = {r.vec_id: r.deviation for r in whitening.whitened(rows).collect()}
    assert got[1] is None and got[2] is None and got[3] == 0 + (3 * (100_000 + 1024) - 301_024) ** 2 + (3 * 100_000 - 300_000) ** 2
