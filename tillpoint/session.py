"""A local session with the settings the engine expects; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillpoint")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillpoint-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
