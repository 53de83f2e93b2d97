"""Session helpers: builder defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

def get_spark(master: str | None = None, app: str = "pagelex", partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the call site of each column is not sent to the JVM: it is half of the time it takes to build a deep plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HTML articles can be large: keep Arrow batches into the tokenizer small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of checkpoints and intermediate tables: the one that ``spark.checkpoint.dir`` names, on a cluster a
    shared one and required; where it is unset in local mode, as in tests, a new local one."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="pagelex-checkpoints-"))
    return sc.getCheckpointDir()
