"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.session import checkpoint_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder; it goes when the session's JVM ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read from there: lineage ends here.

    A lost executor costs a reread, not a recomputation, and several readers share one run.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of 8 MB: whole texts times copies in both memories add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def give_back() -> None:
    """Return freed memory of a Python worker to the system; workers live on beside those of the next stage."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def batches_of(items, weigh, most: int):
    """Lists of consecutive items whose weights add up to ``most`` at most; a heavier item comes alone."""
    batch, total = [], 0
    for item in items:
        weight = weigh(item)
        if batch and total + weight > most:
            yield batch
            batch, total = [], 0
        batch.append(item)
        total += weight
    if batch:
        yield batch
