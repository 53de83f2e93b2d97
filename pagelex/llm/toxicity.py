"""Operator 10, toxicity: non-negative positive-unlabelled learning.

A linear classifier learns from confirmed toxic documents (positive) and from documents whose label is
not looked at (unlabelled). With the class prior p, the risk of calling unlabelled text toxic is
corrected by the positives among it: ``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])``; where the
corrected part turns negative, the step goes the other way, as the non-negative estimator asks.

Features are the presence of hashed words (runs of letters, A-Z in lower case) and of their first four
and five bytes. Of the labelled positives at most ``most`` are learned from, picked by a hash of doc_id; unlabelled is
every row of the training fold. Feature counts and each step's sums are made in tasks, over the distinct patterns of
chosen features and how often each occurs; only ``n_features`` numbers a task come to the driver. Scoring covers
every document, in Arrow batches, without a shuffle.

Defined results: a null text counts as empty; texts without words score by the bias alone; null ids
are scored and never trained on; repeated rows are scored each on their own; without any positive
label every score is 0; extra columns of any name are ignored by ``score`` and kept by ``without_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import fold_of, written

BITS = 18
THRESHOLD = 0.7
PREFIXES = (4, 5)


@dataclass
class Model:
    """``column``: the weight's index of each hashed feature (the last one, of weight 0, for the others)."""

    column: np.ndarray
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text as (text index, feature), sorted."""
    runs = tokens.Runs(tokens.lower_ascii(data), offsets, tokens.letters())
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(runs.first)).astype(np.uint64)
    key = [runs.hashes(), *(runs.hashes(n) for n in PREFIXES)]
    both = np.unique(np.concatenate([(doc << np.uint64(BITS)) | (h >> np.uint64(64 - BITS)) for h in key]))
    return (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _counts(df: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and in how many of them each feature occurs. Each task sends one row a feature."""

    def run(batches):
        total = np.zeros((1 << BITS) + 1, np.int64)  # the last one counts the rows
        for _, data, offsets in tokens.blocks(batches):
            total[:-1] += np.bincount(features(data, offsets)[1], minlength=1 << BITS)
            total[-1] += len(offsets) - 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["f", "n"])

    got = df.select("text").mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((1 << BITS) + 1, np.int64)
    total[got.column("f").to_numpy()] = got.column("n").to_numpy()
    return int(total[-1]), total[:-1]


def _patterns(df: DataFrame, column: np.ndarray, n: int) -> DataFrame:
    """x, n: which of the ``n`` chosen features a row has, packed in bits, and how many rows have just these;
    many to a row, one after the other."""

    def made(batches):
        for _, data, offsets in tokens.blocks(batches):
            doc, f = features(data, offsets)
            there = np.zeros((len(offsets) - 1, n + 1), bool)
            there[doc, column[f]] = True
            x, times = np.unique(np.packbits(there[:, :n], axis=1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(times.astype(np.int64))], ["x", "n"])

    def packed(batches):
        for part in batches:
            if len(part):
                yield pa.RecordBatch.from_arrays([
                    pa.array([b"".join(part.column("x").to_pylist())], pa.binary()), pa.array([part.column("n").to_numpy().tobytes()], pa.binary()),
                ], ["x", "n"])

    alike = df.select("text").mapInArrow(made, "x binary, n long").groupBy("x").agg(F.sum("n").alias("n"))
    return alike.mapInArrow(packed, "x binary, n binary")


def _sums(row, w: np.ndarray) -> np.ndarray:
    """Of a row of ``_patterns``: the sums of x s(f), of s(f) (the slopes of l(-f) = log(1 + e^f)) and of l(-f)."""
    times = np.frombuffer(row.n, np.int64)
    bits = np.frombuffer(row.x, np.uint8).reshape(len(times), -1)
    x = np.unpackbits(bits, axis=1, count=len(w) - 1).astype(np.float32)
    f = x @ w[:-1].astype(np.float32) + w[-1]
    s = times / (1 + np.exp(-f))
    return np.concatenate([s @ x, [s.sum(), times @ np.logaddexp(0, f)]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None, most: int = 6_000,
        n_features: int = 128, steps: int = 300) -> Model:
    """Learn from the training fold. ``prior``: the share of toxic documents; by default that of 1 among all
    labels of the training fold (0.1 where they are all 1)."""
    ids = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id"), 3) != 1)
    ).groupBy("doc_id").agg(F.max("label").alias("label"))
    toxic = ids.where("label = 1").orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(most)
    if prior is None:
        prior = ids.agg(F.avg("label")).first()[0]
        prior = 0.1 if prior is None or prior >= 0.95 else max(prior, 1e-4)
    text = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    positive = written(text.join(F.broadcast(toxic), "doc_id").select("text"), "toxic")
    return _train(positive, text.where(fold_of(F.col("doc_id"), 3) != 1), float(prior), n_features, steps)


def _train(p: DataFrame, u: DataFrame, prior: float, n_features: int, steps: int) -> Model:
    """Learn from all rows of both; a step's sums over them are made in tasks."""
    n_p, in_p = _counts(p)
    n_u, in_u = _counts(u) if n_p else (0, None)
    if not n_p or not n_u:
        return Model(np.zeros(1 << BITS, np.int32), np.zeros(1, np.float32), -50.0)
    share_p, share_u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    known = in_p >= max(3, 0.01 * n_p)  # of these, features that mean toxic at least as often as not
    gain = np.where(known & (prior * share_p > 0.5 * share_u), in_p * np.log(share_p / share_u), 0)
    chosen = np.sort(np.argsort(-gain, kind="stable")[:n_features])
    chosen = chosen[gain[chosen] > 0]
    column = np.full(1 << BITS, len(chosen), np.int32)
    column[chosen] = np.arange(len(chosen))
    own = _patterns(p, column, len(chosen)).collect()  # at most as many as positives
    rest = written(_patterns(u, column, len(chosen)), "patterns").rdd
    mean_p = np.append(in_p[chosen] / n_p, 1.0)
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    rate = 0.1
    for step in range(1, steps + 1):
        of_p = sum(_sums(row, w) for row in own) / n_p
        of_u = rest.map(lambda row, w=w: _sums(row, w)).reduce(np.add) / n_u
        corrected = of_u[-1] - prior * of_p[-1]
        of_negative = of_u[:-1] - prior * of_p[:-1]
        g = prior * (of_p[:-1] - mean_p) + of_negative if corrected >= 0 else -of_negative
        g[:-1] += 1e-4 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return Model(column, np.append(w[:-1], 0).astype(np.float32), float(w[-1]))


def _scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    doc, f = features(data, offsets)
    total = np.bincount(doc, model.weights[model.column[f]], len(offsets) - 1) + model.bias
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # bounded: 2**BITS and n_features numbers

    def run(batches):
        for part, data, offsets in tokens.blocks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_scores(Model(**held.value), data, offsets))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        for part, data, offsets in tokens.blocks(batches):
            yield part.filter(pa.array(_scores(Model(**held.value), data, offsets) < threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the score of every document; learned from the folds whose remainder is not 1."""
    from pagelex.llm.common import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
