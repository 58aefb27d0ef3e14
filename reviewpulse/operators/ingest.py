"""Collection step: newest rows per app, per-app counts and the raw collection metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text, values
from ..sources.shared import settle
from .keyed import in_slices, with_scalar


def newest_n_per_app(reviews: DataFrame, plan: DataFrame) -> DataFrame:
    """Per app of the plan the newest ``target_reviews`` rows, newest first, ties by review id.

    Rows without a time rank last. Only ids and times are ranked, in slices first like
    ``top_n_per_key``, so that an app with most rows is ranked by many tasks; texts and all other
    columns are joined to the winners by ``ingest_seq``, which is unique.
    """
    narrow = reviews.select("app_id", "at_parsed", "review_id", "ingest_seq")
    order = [F.desc_nulls_last("at_parsed"), F.asc("review_id"), F.asc("ingest_seq")]
    in_slice = F.row_number().over(Window.partitionBy("app_id", "slice_id").orderBy(*order))
    in_app = F.row_number().over(Window.partitionBy("app_id").orderBy(*order))
    winners = (
        in_slices(narrow.join(plan.select("app_id", "target_reviews"), "app_id"))
        .withColumn("newest_rank", in_slice).filter(F.col("newest_rank") <= F.col("target_reviews")).drop("slice_id")
        .withColumn("newest_rank", in_app).filter(F.col("newest_rank") <= F.col("target_reviews")).drop("target_reviews")
    )
    if set(reviews.columns) == set(narrow.columns):
        return winners
    return reviews.join(winners.select("ingest_seq", "newest_rank"), "ingest_seq")


def per_app_counts(reviews: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows fetched per planned app; an app without rows is listed with zero."""
    counts = reviews.groupBy("app_id").agg(F.count("*").alias("n"))
    fetched = values.zero_if_null(F.col("n"))
    return plan.join(counts, "app_id", "left").select(
        "app_id", "app_name", fetched.alias("fetched"),
        F.when(fetched > 0, "fetched").otherwise("no rows").alias("status"),
    )


def enrich_raw(raw: DataFrame) -> DataFrame:
    """Columns derived while collecting: stripped content, length, reply flag, parsed time, hash."""
    stripped = raw.withColumn("content", text.normalize_text(F.col("content")))
    return stripped.select(
        "*",
        F.length("content").cast("bigint").alias("content_len"),
        (F.length("content") < V.SHORT_TEXT_LEN).alias("is_short_text"),
        text.has_text(F.col("reply_content")).alias("has_dev_reply"),
        values.parse_time(F.col("at")).alias("at_parsed"),
        text.collection_text_hash(F.col("content")).alias("text_hash"),
    )


RAW_METRICS = [
    "total_rows", "unique_review_id_rows", "clean_rows", "dedup_keep_ratio", "empty_text_ratio",
    "short_text_ratio_lt5", "parseable_time_ratio", "parseable_score_ratio", "missing_review_id_ratio",
    "duplicate_review_id_rows", "duplicate_text_hash_rows", "has_dev_reply_ratio",
    "parseable_replied_at_when_reply_ratio", "apps_count",
]


def raw_collection_metrics(raw: DataFrame) -> DataFrame:
    """Fourteen (metric, value) rows over a raw table; an empty table gives one row ``total_rows = 0``.

    The derived columns are stored without the texts, so the texts are parsed once. Sums and the first length per id come from a map-side combined grouping on the id (all null
    ids form one group), hash and app counts from a second aggregate over two narrow columns.
    """
    rows = settle(
        enrich_raw(raw).select(
            "review_id", "app_id", "ingest_seq", "content_len", "is_short_text", "at_parsed", "has_dev_reply", "text_hash",
            values.to_number(F.col("score")).alias("score"), values.parse_time(F.col("replied_at")).alias("replied_at"),
        ), "raw-derived")
    per_id = rows.groupBy("review_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("content_len") == 0).alias("empty"),
        F.count_if("is_short_text").alias("short"),
        F.count_if(F.col("at_parsed").isNotNull()).alias("timed"),
        F.count_if(F.col("score").isNotNull()).alias("scored"),
        F.count_if(F.col("review_id").isNull()).alias("no_id"),
        F.count_if("has_dev_reply").alias("replies"),
        F.count_if(F.col("has_dev_reply") & F.col("replied_at").isNotNull()).alias("timed_replies"),
        F.min_by("content_len", "ingest_seq").alias("first_len"),
    )
    total = F.sum("n")
    ids = per_id.agg(
        F.coalesce(total, F.lit(0)).alias("total_rows"),
        F.count("*").alias("unique_review_id_rows"),
        F.count_if(F.col("first_len") >= V.SHORT_TEXT_LEN).alias("clean_rows"),
        (F.count("*") / total).alias("dedup_keep_ratio"),
        (F.sum("empty") / total).alias("empty_text_ratio"),
        (F.sum("short") / total).alias("short_text_ratio_lt5"),
        (F.sum("timed") / total).alias("parseable_time_ratio"),
        (F.sum("scored") / total).alias("parseable_score_ratio"),
        (F.sum("no_id") / total).alias("missing_review_id_ratio"),
        (total - F.count("*")).alias("duplicate_review_id_rows"),
        (F.sum("replies") / total).alias("has_dev_reply_ratio"),
        F.coalesce(F.try_divide(F.sum("timed_replies"), F.sum("replies")), F.lit(0.0))
        .alias("parseable_replied_at_when_reply_ratio"),
    )
    distinct = rows.agg(F.count_distinct("text_hash").alias("hashes"), F.count_distinct("app_id").alias("apps_count"))
    one = with_scalar(ids, distinct).withColumn("duplicate_text_hash_rows", F.col("total_rows") - F.col("hashes"))

    def entry(name):
        value = F.col(name).cast("double")
        value = F.round(value, 4) if name.endswith(("ratio", "lt5")) else value
        return F.struct(F.lit(name).alias("metric"), value.alias("value"))

    listed = one.select(F.inline(F.array(*[entry(m) for m in RAW_METRICS])), F.col("total_rows"))
    return listed.filter((F.col("total_rows") > 0) | (F.col("metric") == "total_rows")).select("metric", "value")
