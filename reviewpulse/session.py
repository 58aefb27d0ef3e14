"""Session defaults for running the library outside a cluster that brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "reviewpulse", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the library is written for.

    On a cluster leave ``master`` unset. ``shuffle_partitions`` is an upper bound:
    adaptive execution coalesces small partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        # Recording the Python call site of every column costs more than planning a small job.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
