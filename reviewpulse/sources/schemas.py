"""Column layouts of the raw, clean, history and alert tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw layer is text only; casting happens in the clean step and never fails the job.
RAW_COLUMNS = [
    "app_id", "app_name", "review_id", "score", "content", "at",
    "thumbs_up_count", "reply_content", "replied_at",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

APP_PLAN_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("target_reviews", T.IntegerType()),
])

REVIEW_CLEAN_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("content", T.StringType()),
    T.StructField("at", T.StringType()),
    T.StructField("thumbs_up_count", T.LongType()),
    T.StructField("reply_content", T.StringType()),
    T.StructField("replied_at", T.StringType()),
    T.StructField("content_len", T.LongType()),
    T.StructField("is_short_text", T.BooleanType()),
    T.StructField("has_dev_reply", T.BooleanType()),
    T.StructField("at_parsed", T.TimestampNTZType()),
    T.StructField("text_hash", T.StringType()),
    T.StructField("is_empty_text", T.BooleanType()),
    T.StructField("replied_at_parsed", T.TimestampNTZType()),
    T.StructField("content_clean", T.StringType()),
    T.StructField("detected_lang", T.StringType()),
    T.StructField("is_en", T.BooleanType()),
    T.StructField("is_noise", T.BooleanType()),
    T.StructField("is_missing_key_fields", T.BooleanType()),
    T.StructField("sentiment_keyword", T.StringType()),
    T.StructField("is_inconsistent_rating", T.BooleanType()),
    T.StructField("hour_bucket", T.TimestampNTZType()),
    T.StructField("hourly_count", T.LongType()),
    T.StructField("is_time_anomaly", T.BooleanType()),
    T.StructField("is_spam_bot_suspect", T.BooleanType()),
])
CLEAN_COLUMNS = REVIEW_CLEAN_SCHEMA.fieldNames()

QUALITY_HISTORY_COLUMNS = [
    "run_ts", "raw_rows", "apps_count", "duplicate_rate", "empty_text_rate", "short_text_rate_lt5",
    "parseable_time_rate", "parseable_score_rate", "english_rate_after_p0", "noise_rate_after_p0",
    "missing_key_fields_rate", "inconsistent_rating_rate", "time_anomaly_rate",
    "spam_bot_suspect_rate", "clean_all_rows", "clean_en_rows",
]
DISTRIBUTION_HISTORY_COLUMNS = [
    "run_ts", "score_1_pct", "score_2_pct", "score_3_pct", "score_4_pct", "score_5_pct",
    "len_mean", "len_p50", "len_p90", "en_share", "last7d_reviews_sum", "last7d_daily_mean",
]
ALERT_COLUMNS = [
    "run_ts", "level", "metric", "current", "baseline_or_threshold", "rule", "message",
]
