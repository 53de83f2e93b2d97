"""Incremental conversion of dump files arriving in a folder.

The reference is a bounded batch job with no stream semantics (no watermark, no state);
this entry point only lets the batch conversion run per micro-batch of newly arrived files, plain or archives. The stream
carries the names of the files; ``foreachBatch`` reads them by splits (``sources.lines``) and converts their articles (the same plan as
``convert_articles``) into a committed dictionary of the batch, ``batch=N``.

Files are numbered in the order of batches and names (``files/batch=N``), and an article's id is the number of its file and its line's place
in it: unique over all batches, and the same when a batch is run again after a failure, which leaves the batch's last commit to be read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import dictionary as DI
from ..plans.convert import ConvertOptions, convert_articles
from ..sources.dump import decode_dump_lines, dump_articles, good_lines, quarantine
from ..sources.lines import PATH_BITS, read_lines
from ..sources.siteinfo import Dims

ARRIVED = "path string, modificationTime timestamp, length long, content binary"
FILES = "path string, number long"
MOST_FILES = 1 << (63 - PATH_BITS)


def _numbered(spark: SparkSession, paths: list[str], out_dir: str, batch_id: int) -> int:
    """Numbers the batch's files behind those of earlier batches; the first number."""
    before = [p for p in range(batch_id) if _exists(spark, f"{out_dir}/files/batch={p}/_SUCCESS")]
    base = 0
    if before:
        known = spark.read.schema(FILES).parquet(*[f"{out_dir}/files/batch={p}" for p in before])
        base = (known.agg(F.max("number")).first()[0] or 0) + 1
    if base + len(paths) > MOST_FILES:
        raise ValueError(f"more than {MOST_FILES} files")
    spark.createDataFrame([(p, base + i) for i, p in enumerate(paths)], FILES).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/files/batch={batch_id}")
    return base


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def start(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, dims: Dims,
          opts: ConvertOptions | None = None, trigger_once: bool = True, files_per_batch: int = 1000):
    """Starts the stream; a batch holds at most ``files_per_batch`` files, whose names are all that the driver gets."""
    opts = opts or ConvertOptions()
    out_dir = out_dir.rstrip("/")
    arrived = spark.readStream.format("binaryFile").schema(ARRIVED).option("maxFilesPerTrigger", files_per_batch).load(in_dir).select("path")

    def batch(df: DataFrame, batch_id: int) -> None:
        session = df.sparkSession
        paths = sorted({r.path for r in df.collect()})
        if not paths:
            return
        base = _numbered(session, paths, out_dir, batch_id)
        lines = read_lines(session, paths).withColumn("article_id", F.col("line_id") + F.lit(base << PATH_BITS)).drop("line_id", "path_number")
        decoded = decode_dump_lines(lines)
        quarantine(decoded).write.mode("overwrite").parquet(f"{out_dir}/quarantine/batch={batch_id}")
        converted = convert_articles(dump_articles(good_lines(decoded)), dims, opts)
        tags = DI.tags_table(session, session.createDataFrame([], "name string, value string"))
        DI.write_dictionary(converted, f"{out_dir}/batch={batch_id}", tags, opts.html_encoding)

    w = arrived.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def read_batches(spark: SparkSession, out_dir: str) -> DI.Dictionary:
    """The dictionaries of all batches as one: their contents, keys and outcomes united; the tags are the last batch's."""
    out_dir = out_dir.rstrip("/")
    batches = sorted(r.batch for r in spark.read.parquet(f"{out_dir}/files").select("batch").distinct().collect())
    made = [DI.read_dictionary(spark, f"{out_dir}/batch={b}") for b in batches if _exists(spark, f"{out_dir}/batch={b}/commits")]
    united = lambda name: reduce(DataFrame.unionByName, [getattr(m, name) for m in made])
    return DI.Dictionary(",".join(m.run for m in made), united("content"), united("keys"), made[-1].tags, united("outcomes"))
