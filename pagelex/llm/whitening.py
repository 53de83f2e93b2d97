"""Operator 11, embedding whitening with exact cross-products.

Each entry c of a vector becomes the whole number x = floor(1024 * c) + 100000. Covariance, components and deviations
come from exact integer sums:

1. one pass takes n and each dimension's smallest and largest x;
2. one pass takes the sums and cross-products of y = x - smallest: a block's rows become bit planes (one bit of one dimension
   of 64 rows is a word), and the cross-product of two dimensions is the sum of 2**(a + b) times the number of common ones
   of plane a and plane b (AND, then popcount). A task sums its blocks' popcounts and sends one row for each pair of
   dimensions, in limbs of 32 bits, which Spark adds up as long values; a task holds 2 * bits numbers for each pair;
3. the driver, which holds numbers for pairs of dimensions only, centres them as integers, n * sum(y_i * y_j) - sum(y_i) *
   sum(y_j), divides by n squared and takes the eigenvectors;
4. one pass over the whitened rows gives their covariance, the last one the result.

Defined results: rows whose vector is null, empty or holds null, NaN or infinite entries are dropped. So are rows whose
vector has not the most frequent length (of ties the longest): they have no covariance with the others. Entries beyond 2**52
count as 2**52. Repeated rows and ids, and null ids, are rows like others. A table without a remaining row gives no rows.
Components are at most min(8, dimensions), signed so that the largest entry is positive; one whose eigenvalue is zero within
the precision of double has null ``whitened`` and is left out of ``identity_error`` (null if none is left). ``deviation`` is
null where it exceeds a long. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelex.llm.common import table

SCALE = 1024
SHIFT = 100_000
LARGEST = float(1 << 52)
COMPONENTS = 8
ROWS = 4096
LIMB = 32
LIMBS = 5


@dataclass
class Whitening:
    n: int
    low: np.ndarray  # smallest x of each dimension
    high: np.ndarray
    sums: list[int]  # of x
    vectors: np.ndarray  # dimensions x components
    values: np.ndarray  # eigenvalues
    trace: float


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def clean(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that count: usable, and of the most frequent length."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(usable(F.col("embedding")))
    size = F.size("embedding")
    length = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(size == (length[0]["size"] if length else -1))


def _whole(column: pa.Array) -> np.ndarray:
    """The entries as whole numbers, a row for each vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        return np.floor(np.clip(c * float(SCALE), -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _slices(batches, column: str = "embedding"):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, _whole(part.column(column))


def limbs(value: int) -> list[int]:
    return [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS)]


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of the columns, ``bits`` for each from the lowest; 64 rows are one word."""
    out = np.zeros((y.shape[1] * bits, -(-len(y) // 64) * 8), np.uint8)
    for at in range(len(out)):
        packed = np.packbits(((y[:, at // bits] >> (at % bits)) & 1).astype(np.uint8))
        out[at, : len(packed)] = packed
    return out.view(np.uint64)


def add_common_ones(p: np.ndarray, bits: int, pairs: np.ndarray, single: np.ndarray) -> None:
    """Adds the common ones of planes a and b of dimensions i <= j to pairs[i, j, a + b], those of a plane to single[i, a]."""
    d = len(single)
    single += np.bitwise_count(p).sum(1, dtype=np.int64).reshape(d, bits)
    for i in range(d):
        for a in range(bits):
            both = np.bitwise_count(p[i * bits + a] & p[i * bits :]).sum(1, dtype=np.int64)
            pairs[i, i:, a : a + bits] += both.reshape(d - i, bits)


def weighted(ones: list[int]) -> int:
    return sum(n << k for k, n in enumerate(ones))


def scatter(rows: DataFrame, low: np.ndarray, high: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products of x - low over all rows."""
    d = len(low)
    bits = max(int(b - a).bit_length() for a, b in zip(low, high, strict=True)) or 1

    def run(batches):
        pairs, single = np.zeros((d, d, 2 * bits - 1), np.int64), np.zeros((d, bits), np.int64)
        for _, x in _slices(batches):
            add_common_ones(planes(x - low, bits), bits, pairs, single)
        if single.any():
            got = [(i, -1, weighted(single[i].tolist())) for i in range(d)]
            got += [(i, j, weighted(pairs[i, j].tolist())) for i in range(d) for j in range(i, d)]
            i, j, value = zip(*got, strict=True)
            parts = zip(*map(limbs, value), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(x, pa.int64()) for x in parts)], ["i", "j", *(f"l{k}" for k in range(LIMBS))])

    each = rows.select("embedding").mapInArrow(run, "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    sums, cross = [0] * d, [[0] * d for _ in range(d)]
    for r in each.groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).collect():
        value = sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
        if r["j"] < 0:
            sums[r["i"]] = value
        else:
            cross[r["i"]][r["j"]] = cross[r["j"]][r["i"]] = value
    return sums, cross


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of ``clean`` rows; None if there are none."""

    def run(batches):
        n, low, high = 0, None, None
        for _, x in _slices(batches):
            n += len(x)
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low)), pa.int32()), pa.array([n] * len(low), pa.int64()), pa.array(low), pa.array(high)], ["i", "n", "low", "high"])

    spans = rows.select("embedding").mapInArrow(run, "i int, n long, low long, high long").groupBy("i").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    if not spans:
        return None
    n, low, high = spans[0]["n"], np.array([r["low"] for r in spans]), np.array([r["high"] for r in spans])
    sums, cross = scatter(rows, low, high)
    d = len(low)
    # whole numbers divided once: each entry is the nearest double
    covariance = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)])
    trace = sum(n * cross[i][i] - sums[i] * sums[i] for i in range(d)) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    vectors = vectors[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(d)] < 0, -1.0, 1.0)
    return Whitening(n, low, high, [s + n * int(a) for s, a in zip(sums, low, strict=True)], vectors[:, :COMPONENTS], values[::-1][:COMPONENTS], trace)


def _centred(w: Whitening, x: np.ndarray) -> np.ndarray:
    """n * x - S of each entry, exact: long values where they fit, Python's whole numbers elsewhere."""
    most = w.n * int(np.abs([w.low, w.high]).max())
    kind = np.int64 if max(most, *map(abs, w.sums)) < 1 << 62 else object
    return w.n * x.astype(kind) - np.array(w.sums, dtype=kind)


def deviations(centred: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, null beyond a long."""
    most = int(np.abs(centred).max(initial=0))
    if centred.shape[1] * most * most < 1 << 63:
        return (centred.astype(np.int64) ** 2).sum(1).tolist()
    exact = (sum(int(c) ** 2 for c in row) for row in centred)
    return [v if v < 1 << 63 else None for v in exact]


def kept(w: Whitening) -> np.ndarray:
    """Which components have a spread above the precision of double."""
    return w.values > max(w.values.max(), 0) * len(w.low) * np.finfo(float).eps


def project(w: Whitening, centred: np.ndarray) -> np.ndarray:
    """Whitened values, a column for each component; those without spread are NaN."""
    ok = kept(w)
    out = np.full((len(centred), len(w.values)), np.nan)
    out[:, ok] = (centred / w.n).astype(float) @ w.vectors[:, ok] / np.sqrt(w.values[ok])
    return out


def identity_error(rows: DataFrame, w: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    ok = np.flatnonzero(kept(w))
    if not len(ok):
        return None

    def run(batches):
        total, square = np.zeros(len(ok)), np.zeros((len(ok), len(ok)))
        for _, x in _slices(batches):
            z = project(w, _centred(w, x))[:, ok]
            total += z.sum(0)
            square += z.T @ z
        i, j = np.indices(square.shape).reshape(2, -1)
        i, j = np.append(i, np.arange(len(ok))), np.append(j, np.full(len(ok), -1))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.append(square.ravel(), total))], ["i", "j", "value"])

    got = {(r["i"], r["j"]): r["value"] / w.n for r in rows.select("embedding").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    return max(abs(got[i, j] - got[i, -1] * got[j, -1] - (i == j)) for i in range(len(ok)) for j in range(len(ok)))


def whitened(vectors: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each remaining vector and component."""
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = clean(vectors)
    w = fit(rows)
    if w is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, w)
    k = len(w.values)
    explained = w.values / w.trace if w.trace > 0 else np.zeros(k)

    def run(batches):
        for part, x in _slices(batches):
            centred = _centred(w, x)
            m = len(x)
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(row),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, w.n)),
                    pa.array(deviations(centred), pa.int64()).take(row),
                    pa.array(project(w, centred).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m)),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
