"""Session factory and the one place that decides where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "ticketry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on, UTC and ANSI.

    Shuffle partitions, memory and the checkpoint folder belong to the cluster and are
    only set here when the caller passes them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="ticketry-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def keep(df: DataFrame) -> DataFrame:
    """Cache a frame that several later steps read; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once below the checkpoint folder and read from there by all later steps.

    Nothing stays in the executors' memory and there is nothing to release: a lost executor costs a reread, and the folder
    goes when the session's JVM ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
