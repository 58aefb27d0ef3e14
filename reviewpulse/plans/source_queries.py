"""Queries over scans and sinks: each writes a derived table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, monitor, warehouse
from ..sources import readers, sinks
from ..sources.reviews import raw_reviews
from ..sources.schemas import CLEAN_COLUMNS, QUALITY_HISTORY_COLUMNS, RAW_COLUMNS
from ..sources.shared import new_path, settle
from .base_sql import on_batches, on_kept, on_kept_flagged, on_raw
from .registry import batch_rows, flagged, kept, kept_en, query

# Text columns travel through CSV; a hash shows that every character came back.
_RAW_SHOWN = "review_id, app_id, score, \"at\", thumbs_up_count, replied_at, length(content) AS content_len, md5(COALESCE(content, '')) AS content_md5, " \
    "md5(COALESCE(reply_content, '')) AS reply_md5"


@query("scan_raw_reviews", on_raw(f"SELECT {_RAW_SHOWN} FROM raw"))
def scan_raw_reviews(spark, sf_dir):
    path = new_path(spark, "raw-csv")
    sinks.overwrite(raw_reviews(spark, sf_dir).select(*RAW_COLUMNS), path, "csv")
    text = F.coalesce("content", F.lit(""))
    length = F.length(text).cast("bigint")
    return readers.scan_raw_reviews(spark, path).select(
        "review_id", "app_id", "score", "at", "thumbs_up_count", "replied_at", length.alias("content_len"),
        F.md5(text).alias("content_md5"), F.md5(F.coalesce("reply_content", F.lit(""))).alias("reply_md5"))


_CLEAN_SHOWN = ["review_id", "app_id", "score", "content_len", "at_parsed", "text_hash", "detected_lang", "is_noise",
                "hourly_count", "is_spam_bot_suspect"]


@query("scan_clean_reviews", on_kept_flagged(f"SELECT {', '.join(_CLEAN_SHOWN)} FROM kept"))
def scan_clean_reviews(spark, sf_dir):
    path = new_path(spark, "clean-csv")
    sinks.overwrite(clean.clean_all(flagged(spark, sf_dir)).select(*CLEAN_COLUMNS), path, "csv")
    return readers.scan_clean_reviews(spark, path, "csv").select(*_CLEAN_SHOWN)


@query("sink_overwrite", on_kept("SELECT review_id, app_id, content, is_en FROM kept_en"))
def sink_overwrite(spark, sf_dir):
    """The second write replaces the first."""
    path = new_path(spark, "table")
    rows = kept(spark, sf_dir, "content").select("review_id", "app_id", "content", "is_en")
    sinks.overwrite(rows, path, partition_by=["is_en"])
    sinks.overwrite(rows.filter("is_en"), path)
    return spark.read.parquet(path)


@query("scan_source_preset", on_kept("SELECT review_id, app_id, is_en FROM kept_en"))
def scan_source_preset(spark, sf_dir):
    """Of the candidates of the preset the first existing one is read."""
    folder = new_path(spark, "datasets")
    sinks.overwrite(kept_en(spark, sf_dir).select("review_id", "app_id", "is_en"), f"{folder}/clean_en_only")
    registry = {
        "clean_all": [f"{folder}/clean_all_languages"],
        "clean_en": [f"{folder}/clean_en_only.csv", f"{folder}/clean_en_only"],
    }
    return readers.scan_source_preset(spark, registry, path=f"{folder}/missing", preset="clean-en")


_HISTORY_ROWS = """SELECT run_ts, COUNT(*) AS raw_rows, COUNT(DISTINCT app_id) AS apps_count,
  round(1 - COUNT(DISTINCT review_id) / COUNT(*)::DOUBLE, 4) AS duplicate_rate FROM flagged GROUP BY run_ts"""


@query("sink_append_history", on_batches("", f"""SELECT copy, h.* FROM ({_HISTORY_ROWS}) h
  CROSS JOIN (VALUES (1), (2)) v(copy)"""))
def sink_append_history(spark, sf_dir):
    """Two appends, both kept, columns in their fixed order."""
    path = new_path(spark, "history")
    history = settle(monitor.quality_history(clean.flag_labelled(batch_rows(spark, sf_dir), ["run_ts"])), "quality-history")
    for copy in (1, 2):
        sinks.append_history(history.withColumn("copy", F.lit(copy)), path, ["copy", *QUALITY_HISTORY_COLUMNS])
    return spark.read.parquet(path).select("copy", "run_ts", "raw_rows", "apps_count", "duplicate_rate")


@query("warehouse_load", on_kept_flagged("""SELECT 'apps' AS tbl, COUNT(DISTINCT app_id) AS n, NULL AS flags FROM kept
  UNION ALL SELECT 'reviews', COUNT(*), SUM(CAST(is_en AS INT)) + SUM(CAST(is_spam_bot_suspect AS INT)) FROM kept
  UNION ALL SELECT 'ingestion_meta', 5, NULL
  UNION ALL SELECT 'en_apps', COUNT(DISTINCT app_id), NULL FROM kept_en
  UNION ALL SELECT 'en_reviews', COUNT(*), SUM(CAST(is_en AS INT)) + SUM(CAST(is_spam_bot_suspect AS INT)) FROM kept_en
  UNION ALL SELECT 'en_ingestion_meta', 5, NULL"""))
def warehouse_load(spark, sf_dir):
    """Load both targets, all languages and English only, and count what is stored."""
    base = new_path(spark, "warehouse")
    # Both loads read the stored labelled rows; counts and repeats are stored lists that are joined on the way.
    rows = clean.clean_all(flagged(spark, sf_dir))
    out = None
    for prefix, source, subset in (("", "clean_all_languages", rows), ("en_", "clean_en_only", rows.filter("is_en"))):
        loaded = warehouse.load(subset, source, f"{base}/{source}", "2024-02-01T00:00:00Z")
        for name, df in loaded.items():
            flags = F.sum(F.col("is_en") + F.col("is_spam_bot_suspect")) if name == "reviews" else F.lit(None)
            one = df.agg(F.count("*").alias("n"), flags.cast("bigint").alias("flags")).select(
                F.lit(prefix + name).alias("tbl"), "n", "flags")
            out = one if out is None else out.unionByName(one)
    return out
