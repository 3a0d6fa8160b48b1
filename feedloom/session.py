"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Building plans is several times faster without call sites on every column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which every executor can reach.

    A session without that setting uses a folder of its warehouse, which holds tables and so is
    shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_feedloom"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/feedloom/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows computed once, in the folder that all executors share; Spark removes them after use."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint()
