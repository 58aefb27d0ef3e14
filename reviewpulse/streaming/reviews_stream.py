"""Structured Streaming forms of de-duplication, volumes and the quality history.

The batch jobs are the main product; these run the same operators on arriving files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import first_per_key
from ..sources.schemas import QUALITY_HISTORY_COLUMNS
from . import day_state


def read_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet",
                max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def _each_batch(stream: DataFrame, write, log: str, mode: str = "append") -> None:
    """Hand every micro-batch to ``write(batch, id)`` until all files are read; a restart goes on where it stopped."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", log)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def dedupe(stream: DataFrame, folder: str, order: str = "ingest_seq") -> DataFrame:
    """First row per review id over all that arrived, however late a repeat is.

    A micro-batch stores its own first rows in a sub-folder, which a repeated run replaces; the first
    of those by ``order`` counts. A null id is one id, as in the batch step.
    """
    schema = stream.withColumn("review_id", F.coalesce("review_id", F.lit("nan"))).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("review_id", F.coalesce("review_id", F.lit("nan")))
        first_per_key(named, ["review_id"], [order]).write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")

    _each_batch(stream, write, f"{folder}/log")
    stored = stream.sparkSession.read.schema(schema).parquet(f"{folder}/data")
    return first_per_key(stored.select(*stream.columns), ["review_id"], [order])


def volume(stream: DataFrame, ts: str, size: str, folder: str) -> DataFrame:
    """Counts per tumbling window over all rows that arrived; rows without a time are left out.

    Each micro-batch stores the new count of the windows it changed, and the newest count of a window
    is its result. State is one row per window, so nothing needs to be dropped as late.
    """
    counts = stream.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, size).alias("w")).agg(F.count("*").alias("reviews"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "reviews").write.mode(
            "overwrite").parquet(f"{folder}/data/batch={batch_id}")

    _each_batch(counts, write, f"{folder}/log", "update")
    stored = stream.sparkSession.read.schema(
        "window_start timestamp, window_end timestamp, reviews bigint, batch bigint").parquet(f"{folder}/data")
    return stored.groupBy("window_start", "window_end").agg(F.max_by("reviews", "batch").alias("reviews"))


def append_quality_history(stream: DataFrame, folder: str, dataset: str = "reviews") -> DataFrame:
    """Quality row per day, brought up to date whenever a micro-batch brings rows of the day.

    What is kept of a day are counts that can be added up (see ``day_state``), not its rows. A micro-batch counts its
    own rows, adds the newest state of the days it touches, and stores the sums as their state after it; days are
    replaced as whole partitions. A repeated micro-batch starts from the state before it, so neither a
    failure nor the split into micro-batches shows in the history.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        own = day_state.of_rows(batch, f"{folder}/arrived/batch={batch_id}")
        days = day_state.days_of(own)
        state = day_state.merged(own, day_state.read(spark, folder, days, batch_id), folder, batch_id)
        history = day_state.history(state, dataset)
        history.select("dataset", *QUALITY_HISTORY_COLUMNS).withColumn("day", F.col("run_ts")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{folder}/data")

    _each_batch(stream, write, f"{folder}/log")
    return spark.read.parquet(f"{folder}/data").select("dataset", *QUALITY_HISTORY_COLUMNS)
