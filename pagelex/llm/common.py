"""Paths, folds and samples that the operators share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelex.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: it survives lost executors and is made once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession):
    """Within it, what an action has shuffled is deleted when it ends, not when the driver happens to collect its garbage; a later
    action that needs it makes it again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where the optimizer inlines the expression."""
    return F.get(F.transform(F.array(value), use), 0)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as decimal text, modulo ``folds``; a null id counts as 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)), F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents of the training fold (crc32 mod 3 is not 1), picked by a hash of their
    id: doc_id, text, label. Rows with a null id or label are left out; of several labels of an id the largest
    holds; a document that is repeated counts as often. The picked ids, bounded by ``most``, are broadcast."""
    picked = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id"), 3) != 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
