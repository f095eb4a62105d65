"""Cutting lineage in the shared checkpoint folder of the cluster."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Seconds after which a step counts as a long one, whose predecessors' files are worth a collection in the driver.
LONG_STEP = 5.0


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only where none is named."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="tillpoint-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from its reliable copy.

    Used after a large reduction whose result several later steps read, and before
    range chunks are numbered, so a lost executor never leads to a second partitioning.
    """
    shared_folder(df.sparkSession)
    began = time.monotonic()
    done = df.select("*").checkpoint(eager=True)  # of its own, so that ``df`` does not hold on to the shuffles of the run
    release_after(df.sparkSession, began)
    return done


def release_after(spark: SparkSession, began: float) -> None:
    """``release`` if the step that ``began`` then (``time.monotonic()``) was a long one."""
    if time.monotonic() - began > LONG_STEP:
        release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and copies of steps that nothing refers to any more.

    It does so when the driver collects its garbage, which a small plan over large tables may not bring about for long.
    What the first collection lets go of shows in the second, a moment later.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1.0)
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written and read back within one job."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged_table(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: its size is known, so a join can tell whether it is small."""
    path, began = scratch_path(df.sparkSession, name), time.monotonic()
    df.write.options(**options).parquet(path)
    release_after(df.sparkSession, began)
    return df.sparkSession.read.schema(df.schema).parquet(path)
