"""Operator 9, language: a string kernel with Nystrom landmarks and one-versus-rest kernel ridge regression.

The kernel is the blended spectrum: the presence of character n-grams of 1 to 3 code points (lower case,
hashed to 2**15 places), as the cosine of two presence vectors. ``landmarks`` texts span the feature
space; ridge regression of +1/-1 targets, one per language, is solved in that space from at most
``per_language`` training texts of each language, picked by a hash of doc_id (the documented bound); its sums are made in
tasks, from packed presence vectors of fixed size, whatever the texts' lengths.
A text's values are one product of its batch's presence matrix with the landmarks' combined matrix.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or if no language was
learned; equal values go to the language that sorts first; null ids or languages are never
trained on; repeated rows are scored each on their own; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelex.llm import tokens
from pagelex.llm.common import fold_of, written

PLACES = 1 << 15
LONGEST = 3
BATCH = 128


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # PLACES x languages


def presence(texts: list[str | None]) -> np.ndarray:
    """One row of 0 and 1 for each text."""
    out = np.zeros((len(texts), PLACES), np.float32)
    shift = np.uint64(64 - 15)
    for row, text in zip(out, texts, strict=True):
        c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(c) < n:
                break
            h = h[: len(c) - n + 1] * np.uint64(0xD6E8FEB86659FD93) + c[n - 1 :] + np.uint64(n)
            row[(h * np.uint64(0x9E3779B97F4A7C15)) >> shift] = 1
    return out


def _normed(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt(x.sum(1, keepdims=True)), 1)


def _unpacked(bits: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(bits.to_pylist()), np.uint8).reshape(len(bits), PLACES // 8)
    return _normed(np.unpackbits(x, axis=1).astype(np.float32))


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """lang, at (1 to ``per_language`` in each language), bits: the presence vectors of the training texts that are learned from, picked
    by a hash of doc_id. Of several texts of an id and language the one of the smallest vector holds."""
    known = docs.select("doc_id", "lang", "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("doc_id"), 3) != 1)
    )

    def packed(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                rows = np.packbits(presence(part.column("text").to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "lang", "at")), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "lang", "at", "bits"])

    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = known.select("doc_id", "lang").distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= per_language)
    rows = known.join(F.broadcast(picked), ["doc_id", "lang"]).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "at", "text")
    made = rows.mapInArrow(packed, "doc_id long, lang string, at int, bits binary")
    return made.groupBy("doc_id", "lang", "at").agg(F.min("bits").alias("bits")).select("lang", "at", "bits")


def fit(docs: DataFrame, per_language: int = 800, landmarks: int = 256, ridge: float = 1e-3) -> Model:
    """Learn from text and language of the training fold (crc32 mod 3 is not 1). Tasks make the sums; to the driver come the landmarks'
    packed vectors (``landmarks``, or one a language if there are more of these) and the sums' numbers."""
    rows = written(sample(docs, per_language), "languages")
    counted = rows.groupBy("lang").count().collect()  # a row a language
    languages = sorted(r["lang"] for r in counted)
    if not languages:
        return Model([], np.zeros((PLACES, 0), np.float32))
    some = rows.orderBy("at", "lang").limit(max(landmarks, len(languages))).toArrow()  # in turn from each language
    some = some.sort_by([("at", "ascending"), ("lang", "ascending")]).combine_chunks()
    marks = _unpacked(some.column("bits").combine_chunks())
    held = docs.sparkSession.sparkContext.broadcast((marks, np.array(languages)))

    def summed(batches):
        marks, names = held.value
        total = np.zeros((len(marks), len(marks) + len(names)))
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                k = _unpacked(part.column("bits")) @ marks.T
                y = np.where(np.array(part.column("lang").to_pylist())[:, None] == names[None, :], 1.0, -1.0)
                total += k.T @ np.concatenate([k, y], axis=1)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["place", "x"])

    sums = rows.mapInArrow(summed, "place int, x double").groupBy("place").agg(F.sum("x").alias("x")).toArrow()
    total = np.zeros(len(marks) * (len(marks) + len(languages)))
    total[sums.column("place").to_numpy()] = sums.column("x").to_numpy()
    left, right = np.hsplit(total.reshape(len(marks), -1), [len(marks)])
    n = sum(r["count"] for r in counted)
    alpha = np.linalg.solve(left + ridge * n * (marks @ marks.T) + 1e-6 * np.eye(len(marks)), right)
    return Model(languages, (marks.T @ alpha).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (half of one plus the winner's value, within 0 and 1)."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # bounded: PLACES x languages

    def run(batches):
        m = Model(**held.value)
        for part, _, _ in tokens.blocks(batches):
            for i in range(0, part.num_rows, BATCH):
                some = part.slice(i, BATCH)
                read = np.asarray(some.column("lettered").to_pylist(), bool) & (len(m.languages) > 0)
                name, score = ["und"] * some.num_rows, np.zeros(some.num_rows)
                if read.any():
                    texts = [t for t, yes in zip(some.column("text").to_pylist(), read, strict=True) if yes]
                    value = _normed(presence(texts)) @ m.matrix
                    best = value.argmax(1)
                    score[read] = np.clip((1 + value[np.arange(len(best)), best]) / 2, 0, 1)
                    for at, b in zip(np.flatnonzero(read), best, strict=True):
                        name[at] = m.languages[b]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(name), pa.array(score)], ["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered).mapInArrow(run, "doc_id long, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the language of every document; learned from the folds whose remainder is not 1."""
    from pagelex.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
