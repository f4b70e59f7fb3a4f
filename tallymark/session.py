"""Session settings and durable cut points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Recording the caller of every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "tallymark", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymark-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for tables written along the way."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint.

    Used where the rows must not be computed twice (range partition numbers) or
    where several outputs hang on one expensive plan.  Survives lost executors.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to files and read again: unlike the parts of a checkpoint, tasks read files in pieces of bounded size and only the columns they use."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
