"""Session set-up for tests and benchmarks, and reliable lineage cuts.

On a cluster the caller brings its own session; nothing here overrides it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "fieldprep") -> SparkSession:
    """A session for one machine: UTC clock, adaptive execution, few shuffle partitions."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # Call sites of every column expression cost several JVM calls each while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the caller names it, nothing here guesses one.

    It is ``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` was given.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage so that a lost executor cannot change it.

    Needed wherever a plan asks *which partition a row is in*: a recomputed range
    partitioning may place rows differently, a checkpointed one cannot.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """A small intermediate written as a table in the shared folder and read back.

    Besides cutting the lineage this tells the planner its true size before the plans that use
    it are made, so a short list is broadcast and a long one is not.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
