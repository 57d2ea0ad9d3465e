"""Session settings and the shared folder used to cut lineage or hold intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
DENSE = "zstd"  # of written tables whose size counts


def build_session(cores: str = "*", name: str = "ledgerlore", **conf: object) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the submitter supplies the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that folder would exist on
    one machine alone, so a missing setting is an error there.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlore-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str, file_rows: int = 0, dense: bool = False, folder: str | None = None) -> DataFrame:
    """Write a result that is used more than once to the shared folder and go on from there.

    The rows survive the loss of the executors that computed them, and later readers take only the columns
    they need. ``file_rows`` bounds the rows of a file, so that readers can share a partition's rows among tasks.
    ``dense`` spends some time to make tables of texts or terms smaller. ``folder`` is a column, the last one, each value of
    which gets a folder of its own.
    """
    path = scratch_path(df.sparkSession, purpose)
    writer = df.write.option("maxRecordsPerFile", file_rows)
    writer = writer.partitionBy(folder) if folder else writer
    (writer.option("compression", DENSE) if dense else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
