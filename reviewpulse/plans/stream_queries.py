"""Streaming forms of the batch operators, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.reviews import raw_reviews, table
from ..sources.schemas import QUALITY_HISTORY_COLUMNS
from ..sources.shared import new_path
from ..streaming import reviews_stream as rs
from .base_sql import on_batches, on_raw
from .monitor_queries import QUALITY
from .registry import query


def _landed(spark, sf_dir):
    """Raw reviews as files that arrive in two goes; there are as many files as tasks that write, so no task's share grows."""
    path = new_path(spark, "landing")
    rows = raw_reviews(spark, sf_dir)
    rows.write.parquet(path)
    files = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    return rs.read_stream(spark, path, rows.schema, max_files=-(-2 * files // 3))


@query("s_dedupe", on_raw("""SELECT COALESCE(review_id, 'nan') AS review_id, arg_min(app_id, ingest_seq) AS app_id,
  MIN(ingest_seq) AS ingest_seq FROM raw GROUP BY 1"""))
def s_dedupe(spark, sf_dir):
    return rs.dedupe(_landed(spark, sf_dir).select("review_id", "app_id", "ingest_seq"), new_path(spark, "deduped"))


def _volume_sql(unit: str) -> str:
    return f"SELECT date_trunc('{unit}', ts)::TIMESTAMP AS window_start, COUNT(*) AS reviews FROM events GROUP BY 1"


def _volume(spark, sf_dir, size):
    schema = table(spark, sf_dir, "events").schema
    events = rs.read_stream(spark, sf_dir, schema, "events.parquet").withColumn("event_time", F.col("ts").cast("timestamp"))
    counts = rs.volume(events, "event_time", size, new_path(spark, "volume"))
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "reviews")


@query("s_hourly_volume", _volume_sql("hour"))
def s_hourly_volume(spark, sf_dir):
    return _volume(spark, sf_dir, "1 hour")


@query("s_daily_volume", _volume_sql("day"))
def s_daily_volume(spark, sf_dir):
    return _volume(spark, sf_dir, "1 day")


@query("s_metric_append", on_batches(QUALITY, f"SELECT 'reviews' AS dataset, {', '.join(QUALITY_HISTORY_COLUMNS)} FROM quality"))
def s_metric_append(spark, sf_dir):
    return rs.append_quality_history(_landed(spark, sf_dir), new_path(spark, "stream-history"))
