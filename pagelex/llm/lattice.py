"""Operator 13, embedding near-dedup by lattice hashing.

Vectors link when their cosine, in double precision, is ``LEAST`` or more. Candidates meet in cells of the lattice E8: a
table projects unit vectors on ``blocks`` random subspaces of 8 dimensions, adds a random shift and decodes each
to its nearest lattice point; the points together are the vector's cell. Each vector also probes the neighbouring cells
(points one of the 240 shortest lattice vectors away) that it lies nearest to, ``PROBES`` cells a table in all. Two vectors are compared
where any of their cells are the same.

Recall. Candidates are found with a probability, links never guessed: ``tables_for`` measures on random pairs of cosine
exactly ``LEAST`` how often one table brings them together and takes as many tables as miss a pair with a chance below
``MISS`` (0.5 %; closer pairs miss far more rarely). ``blocks_for`` adds a block for each 2**10 rows' growth so that
cells stay selective; both follow from the number of vectors and their dimension alone.

Scale. Copies (equal vectors, 0.0 and -0.0 alike, by a 128-bit digest) are one class with a count before anything else, so
they never meet each other. Cells with one vector go before vectors are shuffled. A cell of many vectors is dealt into blocks of
``CELL`` rows and each pair of blocks is a task's unit of its own, so that no task holds more than two blocks whatever the
group; nothing is capped. A pair that meets in several cells counts in the first of its common ones only, which each task tells from the two vectors
alone: no pair is ever written. Tasks return a count for each class and a link from each class to one that its
matches reach in the group, from which ``sets.components`` makes the components. The comparisons in a group of near copies that are not
equal still grow with its square: each has to report its number of links.

Defined results: vectors that are null, empty or zero, or hold null or non-finite entries link with nothing, also not with
their copies; vectors of different lengths don't link. Rows with the same vec_id are rows of their own; null ids
are larger than all others, and a row of null id is kept only if its component has no other id (all of these are kept
then). Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelex.llm import sets, tokens
from pagelex.llm.common import table, written
from pagelex.llm.whitening import usable

LEAST = 0.95
MISS = 0.005
PROBES = 4
WIDTH = 1.5
CELL = 2048
SLICE = 4096
SMALL = 48
STRIPE = 256
_SEED = 8240


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or eight of a half with an even number of minus signs."""
    pairs = [(i, j, a, b) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(whole, pairs, strict=True):
        row[i], row[j] = a, b
    half = np.array([s for s in itertools.product((0.5, -0.5), repeat=8) if math.prod(s) > 0])
    return np.concatenate([whole, half])


ROOTS = _shortest()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-number points with an even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(1) % 2 != 0)
    off = x[odd] - f[odd]
    at = np.abs(off).argmax(1)
    f[odd, at] += np.where(off[np.arange(len(odd)), at] >= 0, 1.0, -1.0)
    return f


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: even whole points, or those moved by a half in each dimension."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


class Lattice:
    """Cells of unit vectors of one dimension."""

    def __init__(self, dimension: int, blocks: int, tables: int):
        self.blocks, self.tables = blocks, tables
        rng = np.random.default_rng([_SEED, dimension, blocks])
        self.turns, self.shifts = [], []
        for _ in range(tables):  # the first tables are the same whatever their number
            turn = rng.standard_normal((dimension, 8 * blocks))
            if dimension >= 8 * blocks:
                turn = np.linalg.qr(turn)[0] * math.sqrt(dimension / 8)
            else:
                turn /= math.sqrt(8)
            self.turns.append(turn * WIDTH)
            self.shifts.append(rng.uniform(0, 4, 8 * blocks))
        self.odd = (rng.integers(1, 1 << 62, (blocks, 8)) * 2 + 1).astype(np.uint64)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """A row for each vector: the hashes of its cells, ``PROBES`` for each table, its own first."""
        out = [self._table(t, unit) for t in range(self.tables)]
        return np.concatenate(out, axis=1) if len(unit) else np.zeros((0, self.tables * PROBES), np.int64)

    def _table(self, t: int, unit: np.ndarray) -> np.ndarray:
        n = len(unit)
        y = unit @ self.turns[t] + self.shifts[t]
        hashes = np.full((n, 1), tokens.mix(np.array([(t + 1) << 32 | len(self.turns[t])], np.uint64))[0], np.uint64)
        far = np.zeros((n, 1))
        for b in range(self.blocks):
            part = y[:, 8 * b : 8 * b + 8]
            point = decode(part)
            gain = (part - point) @ ROOTS.T
            near = np.argpartition(-gain, PROBES - 2, axis=1)[:, : PROBES - 1]
            # squared distance to the neighbouring point less that to the own one
            more = np.concatenate([np.zeros((n, 1)), 2 - 2 * np.take_along_axis(gain, near, 1)], 1)
            points = np.rint(2 * np.concatenate([point[:, None], point[:, None] + ROOTS[near]], 1)).astype(np.int64).view(np.uint64)
            code = tokens.mix((points * self.odd[b]).sum(2))
            # the nearest cells of this block and those before
            far = (far[:, :, None] + more[:, None, :]).reshape(n, -1)
            hashes = tokens.mix((hashes[:, :, None] * np.uint64(0xD6E8FEB86659FD93) + code[:, None, :]).reshape(n, -1))
            best = np.argsort(far, axis=1, kind="stable")[:, :PROBES]
            far, hashes = np.take_along_axis(far, best, 1), np.take_along_axis(hashes, best, 1)
        return hashes.view(np.int64)


def blocks_for(n: int) -> int:
    return max(2, math.ceil(math.log2(max(n, 2)) / 10))


def tables_for(dimension: int, blocks: int, least: float = LEAST, pairs: int = 4000) -> int:
    """As many tables as bring pairs of cosine ``least`` together but for a chance of ``MISS``, by the share of random pairs that one
    table, over eight of them, brings together."""
    rng = np.random.default_rng(_SEED)
    a, z = rng.standard_normal((2, pairs, dimension))
    a /= np.linalg.norm(a, axis=1)[:, None]
    z -= (z * a).sum(1)[:, None] * a
    norm = np.linalg.norm(z, axis=1)[:, None]
    b = least * a + math.sqrt(1 - least * least) * np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-9)
    lattice = Lattice(dimension, blocks, 8)
    x, y = (lattice.cells(u).reshape(pairs, 8, PROBES) for u in (a, b))
    hit = (x[:, :, :, None] == y[:, :, None, :]).any((2, 3)).mean()
    return max(1, math.ceil(math.log(MISS) / math.log(max(1 - hit, 1e-9))))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Scaled first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(batch, most: int | None = SLICE):
    """Parts of a batch with vectors of one length each, in order, of ``most`` rows at most."""
    size = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        for i in range(0, len(rows), most or len(rows)):
            yield d, batch.take(pa.array(rows[i : i + (most or len(rows))]))


def classes(vectors: DataFrame) -> DataFrame:
    """Every row with the digest of its vector, both null where it links with nothing: vec_id, vector, digest."""

    def run(batches):
        for batch in batches:
            digest = np.full(batch.num_rows, None, dtype=object)
            there = np.flatnonzero(batch.column("vector").is_valid().to_numpy(zero_copy_only=False))
            size = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(size[there]).tolist():
                rows = there[size[there] == d]
                for row, x in zip(rows, _matrix(batch.column("vector").take(pa.array(rows))) + 0.0, strict=True):
                    digest[row] = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest, pa.binary())], ["vec_id", "vector", "digest"])

    raw = F.col("embedding").cast("array<double>")
    counts = usable(raw) & F.exists(raw, lambda c: c != 0)
    rows = vectors.select("vec_id", F.when(counts, raw).alias("vector"))
    return rows.mapInArrow(run, f"vec_id {dict(vectors.dtypes)['vec_id']}, vector array<double>, digest binary")


def _whole_groups(batches):
    """Batches sorted by cell, one, two, cut so that no group is in two of them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        got = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        key = np.stack([got.column(c).to_numpy() for c in ("cell", "one", "two")])
        last = np.flatnonzero((key != key[:, -1:]).any(0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield got.slice(0, cut)
        rest = got.slice(cut)
    if rest is not None:
        yield rest


def _candidates(group: np.ndarray):
    """Pairs of places of one group, a < b, a few million at most at a time: small groups by their distance, large
    ones row by row. ``group`` numbers the rows' groups, in order."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, len(group)))
    mine = np.repeat(size, size)
    for step in range(1, min(int(size.max()), SMALL)):
        a = np.flatnonzero((group[:-step] == group[step:]) & (mine[:-step] <= SMALL))
        yield a, a + step
    for at, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        for i in range(0, n - 1, STRIPE):
            a, b = np.nonzero(np.arange(i, min(i + STRIPE, n))[:, None] < np.arange(n)[None, :])
            yield a + at + i, b + at


def _close(x: np.ndarray, unit: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which of the pairs have the cosine; near the bound it is taken from the vectors themselves."""
    cosine = np.empty(len(a))
    for i in range(0, len(a), 1 << 16):
        at = slice(i, i + (1 << 16))
        cosine[at] = np.einsum("ij,ij->i", unit[a[at]], unit[b[at]])
    ok = cosine >= least
    doubt = np.flatnonzero(np.abs(cosine - least) < 1e-9)
    p, q = (y / np.abs(y).max(1, keepdims=True) for y in (x[a[doubt]], x[b[doubt]]))
    ok[doubt] = (p * q).sum(1) / np.sqrt((p * p).sum(1) * (q * q).sum(1)) >= least
    return ok


def _first_common(cells: np.ndarray, a: np.ndarray, b: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether ``cell`` is the smallest of the pair's common cells; ``cells`` is vectors x tables x probes."""
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), 1 << 14):
        at = slice(i, i + (1 << 14))
        own = cells[a[at]]
        shared = (own[:, :, :, None] == cells[b[at]][:, :, None, :]).any(3)
        out[at] = np.where(shared, own, np.iinfo(np.int64).max).min((1, 2)) == cell[at]
    return out


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts the ends of the pairs in one tree each, the smallest place as its root."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


def _compared(batch: pa.RecordBatch, lattice: Lattice, least: float) -> pa.RecordBatch:
    """class, links, to: of the vectors with a link that counts in their group, the number of vectors so linked and a class of
    the group that they reach by links, the same for all that reach each other."""
    x = _matrix(batch.column("vector"))
    unit = _unit(x)
    cell, one, two, own, copies, name = (batch.column(c).to_numpy() for c in ("cell", "one", "two", "own", "copies", "class"))
    group = np.cumsum(np.append(0, (cell[1:] != cell[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
    cells, made = np.zeros((len(x), lattice.tables, PROBES), np.int64), np.zeros(len(x), bool)
    for a, b in _candidates(group):
        across = (one[a] == two[a]) | (own[a] != own[b])  # two rows of one block meet in the block's own group
        a, b = a[across], b[across]
        ok = _close(x, unit, a, b, least)
        a, b = a[ok], b[ok]
        new = np.zeros(len(x), bool)
        new[a] = new[b] = True
        new &= ~made
        if new.any():
            cells[new], made = lattice.cells(unit[new]).reshape(-1, lattice.tables, PROBES), made | new
        ok = _first_common(cells, a, b, cell[a])
        a, b = a[ok], b[ok]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        _joined(parent, a, b)
    at = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(name[at]), pa.array(links[at]), pa.array(name[parent[at]])], ["class", "links", "to"])


def links_of(groups: DataFrame, lattices: dict[int, Lattice], least: float = LEAST) -> DataFrame:
    """class, links, to (``_compared``) over all groups of the classes (class, vector, copies)."""
    held = groups.sparkSession.sparkContext.broadcast(lattices)

    def cells(batches):
        for batch in batches:
            for d, part in _by_length(batch):
                got = held.value[d].cells(_unit(_matrix(part.column("vector"))))
                row = pa.array(np.repeat(np.arange(len(got)), got.shape[1]))
                yield pa.RecordBatch.from_arrays([part.column("class").take(row), pa.array(got.ravel())], ["class", "cell"])

    def compare(batches):
        for batch in _whole_groups(batches):
            for d, part in _by_length(batch, None):
                yield _compared(part, held.value[d], least)

    met = written(groups.select("class", "vector").mapInArrow(cells, "class long, cell long"), "cells")
    counts = met.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    blocks = (
        met.join(counts, "cell")
        .withColumn("of", F.ceil(F.col("n") / CELL))
        .withColumn("own", F.pmod(F.xxhash64("class", "cell"), F.col("of")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1)))
        .select("class", "cell", "own", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    )
    dealt = blocks.join(groups.select("class", "vector", "copies"), "class").repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two")
    columns = ["class", "cell", "own", "one", "two", "copies", "vector"]
    return dealt.select(columns).mapInArrow(compare, "class long, links long, to long")


def near(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    kind = dict(vectors.dtypes)["vec_id"]
    rows = written(classes(vectors), "vectors")
    some = rows.where(F.col("digest").isNotNull())
    groups = some.groupBy("digest").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    groups = written(groups.withColumn("class", F.monotonically_increasing_id()), "classes")
    blocks = blocks_for(groups.count())
    sizes = [r["d"] for r in groups.select(F.size("vector").alias("d")).distinct().collect()]
    lattices = {d: Lattice(d, blocks, tables_for(d, blocks, least)) for d in sizes}
    found = written(links_of(groups, lattices, least), "links")
    component = sets.components(found.select(F.col("class").alias("a"), F.col("to").alias("b")))
    known = (
        groups.select("digest", "class", "copies", "least")
        .join(found.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
        .join(component.withColumnRenamed("node", "class"), "class", "left")
        .select("digest", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"))
    )
    known = written(known, "known")
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = written(known.join(smallest, "component").select("digest", "n_links", "component_id"), "answers")
    linked = some.select("vec_id", "digest").join(answer, "digest").select(
        "vec_id", "n_links", "component_id", (F.col("component_id").isNull() | F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).alias("kept")
    )
    alone = rows.where(F.col("digest").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
n AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, (component_id IS NULL OR coalesce(vec_id = component_id, false)) AS kept
FROM v JOIN least USING (r) LEFT JOIN n USING (r)
"""
