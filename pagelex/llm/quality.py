"""Operator 7, quality: a factorisation machine over hashed words, structure statistics and metadata.

``y = b + w.x + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``: all pairwise interactions of rank
``RANK`` in time linear in the features of a text. x holds the shares of hashed words (2**12 places),
statistics of the text's form (shares of character classes, word lengths, repetition, lines) and, as
metadata, its length. Trained by AdaGrad on the logistic loss over a bounded sample of labelled documents
(``most``, picked by a hash of doc_id); every document is scored in Arrow batches without a shuffle.

Defined results: a null text counts as empty and is scored by its statistics alone; null ids are scored and
never trained on; repeated rows are scored each on their own; without labels every score is 0.5; if the
labels are all the same, scores lean to that side; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import fold_of, labelled_sample

BITS = 12
RANK = 8


@dataclass
class Model:
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, share) of the hashed words of each text, sorted, and the statistics of its form."""
    n = len(offsets) - 1
    runs = tokens.Runs(tokens.lower_ascii(data), offsets, tokens.not_space())
    count = np.diff(runs.first)
    doc = np.repeat(np.arange(n), count)
    full = (doc.astype(np.uint64) << np.uint64(32)) | (runs.hashes() >> np.uint64(32))
    kind, times = np.unique(full, return_counts=True)
    of = (kind >> np.uint64(32)).astype(np.int64)
    distinct = np.bincount(of, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, of, times)
    place, inverse = np.unique((of << BITS) | ((kind >> np.uint64(32 - BITS)) & np.uint64((1 << BITS) - 1)).astype(np.int64), return_inverse=True)
    per = np.maximum(count, 1)
    share = np.bincount(inverse, times, len(place)) / per[place >> BITS]

    def part(member: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(member[data])])
        return total[offsets[1:]] - total[offsets[:-1]]

    length = np.diff(offsets)
    over = np.maximum(length, 1)
    symbols, marks = tokens.table(35, 36, 37, 38, 42, 94, 126, 64, 43, 61), tokens.table(33, 63)
    wide = np.bincount(doc, runs.end - runs.start, n)
    long = np.bincount(doc, (runs.end - runs.start) > 14, n)
    last = data[np.maximum(runs.end - 1, 0)] if len(doc) else np.zeros(0, np.uint8)
    ends = np.bincount(doc, ~tokens.letters()[last], n)
    stats = np.stack([
        part(tokens.table(slice(65, 91))) / over, part(tokens.table(slice(48, 58))) / over, part(symbols) / over,
        part(marks) / over, part(tokens.table(124, 60, 62, 123, 125, 91, 93, 95, 47, 92)) / over,
        part(tokens.table(44, 46, 59, 58)) / over, part(tokens.table(10)) / over, part(tokens.table(slice(128, 256))) / over,
        wide / per / 10, long / per, ends / per, distinct / per, most / per, np.log1p(count) / 5, np.log1p(length) / 5,
    ], 1)
    return place >> BITS, place & ((1 << BITS) - 1), share, stats


def _rows(batches):
    """A row for each text: its places and shares, and its statistics."""
    for part, data, offsets in tokens.blocks(batches):
        doc, place, share, stats = words(data, offsets)
        cut = pa.array(np.searchsorted(doc, np.arange(len(offsets))), pa.int32())
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(cut, pa.array(place, pa.int32())),
            pa.ListArray.from_arrays(cut, pa.array(share, pa.float64())),
            pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * stats.shape[1], pa.int32()), pa.array(stats.ravel())),
        ], ["doc_id", "label", "place", "share", "stats"])


def _value(model: Model, doc, place, share, stats) -> np.ndarray:
    """The machine's value of each text, by the sum-of-squares identity."""
    n, size = len(stats), 1 << BITS
    x = (stats - model.mean) / model.scale
    rows = share[:, None] * model.v[place]
    total, square = x @ model.v[size:], (x * x) @ (model.v[size:] ** 2)
    for f in range(RANK):
        total[:, f] += np.bincount(doc, rows[:, f], n)
        square[:, f] += np.bincount(doc, rows[:, f] ** 2, n)
    return model.bias + x @ model.w[size:] + np.bincount(doc, share * model.w[place], n) + 0.5 * (total**2 - square).sum(1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 12_000, epochs: int = 6) -> Model:
    got = labelled_sample(docs, labels, label, most).mapInArrow(_rows, "doc_id long, label int, place array<int>, share array<double>, stats array<double>").toArrow()
    got = got.sort_by([("doc_id", "ascending")]).combine_chunks()
    y = np.asarray(got.column("label").to_pylist(), float)
    flat = lambda c: got.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(y) else np.zeros(0)
    stats = flat("stats").reshape(len(y), -1) if len(y) else np.zeros((0, 15))
    lengths = np.array([len(x) for x in got.column("place")], np.int64)
    return _train(y, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), flat("place").astype(np.int64), flat("share"), stats, epochs)


def _train(y, first, place, share, stats, epochs: int) -> Model:
    size, width = 1 << BITS, stats.shape[1]
    rng = np.random.default_rng(11)
    v = rng.normal(0, 0.02, (size + width, RANK))
    if not len(y):
        return Model(0.0, np.zeros(size + width), np.zeros_like(v), np.zeros(width), np.ones(width))
    model = Model(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(size + width), v, stats.mean(0), stats.std(0) + 1e-3)
    gw, gv, rate, batch = np.full(size + width, 1e-3), np.full(v.shape, 1e-3), 0.05, 64
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = order[k : k + batch]
            count = first[rows + 1] - first[rows]
            doc = np.repeat(np.arange(len(rows)), count)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[rows], count)
            p, s = place[at], share[at]
            x = np.clip((stats[rows] - model.mean) / model.scale, -8, 8)
            total = x @ model.v[size:]
            for f in range(RANK):
                total[:, f] += np.bincount(doc, s * model.v[p, f], len(rows))
            error = 1 / (1 + np.exp(-np.clip(_value(model, doc, p, s, stats[rows]), -500, 500))) - y[rows]
            error /= len(rows)
            dw = np.bincount(p, s * error[doc], size)
            dv = np.zeros((size + width, RANK))
            for f in range(RANK):
                dv[:size, f] = np.bincount(p, error[doc] * (s * total[doc, f] - s * s * model.v[p, f]), size)
            dv[size:] = x.T @ (error[:, None] * total) - ((x * x).T @ error)[:, None] * model.v[size:]
            d = np.concatenate([dw, x.T @ error]) + 1e-5 * model.w
            gw += d * d
            gv += dv * dv
            model.w = model.w - rate * d / np.sqrt(gw)
            model.v = model.v - 0.2 * rate * dv / np.sqrt(gv)
            model.bias -= rate * error.sum()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # bounded: (2**BITS + statistics) x (RANK + 1)

    def run(batches):
        for part, data, offsets in tokens.blocks(batches):
            value = _value(Model(**held.value), *words(data, offsets))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(value, -500, 500))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the score of every document; learned from the folds whose remainder is not 1."""
    from pagelex.llm.common import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels)).select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                                                 (F.col("score") >= 0.5).cast("int").alias("predicted"))
