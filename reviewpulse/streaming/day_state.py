"""Counts per day that add up, from which the quality numbers of a day follow without its rows.

Four tables: per id the sums over its rows and the values of its first row; rows per text; rows per hour; apps. Each
is partitioned by day and by the micro-batch after which it held, and a micro-batch reads the newest state of the days
it touches and nothing else. Earlier states stay until the folder's retention rule removes them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import clean
from ..sources.readers import path_exists

State = dict[str, DataFrame]
SUMS = ["n", "empty", "short", "timed", "scored", "missing"]
FIRST = ["kept", "en", "noise", "inconsistent", "tiny", "hash", "hour"]
LAYOUTS = {
    "ids": "review_id string, " + ", ".join(f"{c} bigint" for c in SUMS) + ", first_seq bigint, first_kept boolean, first_en boolean, "
           "first_noise boolean, first_inconsistent boolean, first_tiny boolean, first_hash string, first_hour timestamp_ntz",
    "texts": "text_hash string, n bigint",
    "hours": "hour_bucket timestamp_ntz, rows_in_hour bigint",
    "apps": "app_id string",
}
# The day as text: a partition value for rows without a day, too.
DAY = "day"


def of_rows(raw: DataFrame, folder: str) -> State:
    """The state of some raw rows alone, with ``ingest_date`` as their day; texts are parsed once."""
    day = F.coalesce(F.col("ingest_date").cast("string"), F.lit("none")).alias(DAY)
    rows = clean.label(raw).select(
        day, "review_id", "ingest_seq", "app_id", "text_hash", "hour_bucket", "is_empty_text", "is_short_text", "at_parsed", "score",
        "is_missing_key_fields", "is_en", "is_noise", "is_inconsistent_rating",
        ((F.col("content_len") <= V.TINY_TEXT_LEN) & (F.col("thumbs_up_count") == 0)).alias("tiny"))
    rows.write.mode("overwrite").parquet(folder)
    rows = raw.sparkSession.read.schema(rows.schema).parquet(folder)
    first = {**clean.first_row_flags(), "tiny": F.col("tiny"), "hash": F.col("text_hash"), "hour": F.col("hour_bucket")}
    return {
        "ids": clean.per_id_counts(rows, [DAY, "review_id"], first, F.min("ingest_seq").alias("first_seq")),
        "texts": rows.groupBy(DAY, "text_hash").agg(F.count("*").alias("n")),
        "hours": rows.groupBy(DAY, "hour_bucket").agg(F.count("*").alias("rows_in_hour")),
        "apps": rows.filter("app_id IS NOT NULL").select(DAY, "app_id").distinct(),
    }


def days_of(state: State) -> list[str]:
    """The days of a state; a micro-batch holds few."""
    return [r[DAY] for r in state["hours"].select(DAY).distinct().collect()]


def read(spark: SparkSession, folder: str, days: list[str], before: int) -> State | None:
    """The newest state of some days from before a micro-batch; other days' files are not opened."""
    hours = f"{folder}/state/hours"
    if not path_exists(spark, hours):
        return None
    schema = f"{{}}, {DAY} string, batch bigint"
    stored = spark.read.schema(schema.format(LAYOUTS["hours"])).parquet(hours)
    # Every day of a state has an hour row, so the partitions of this small table tell which states there are.
    newest = stored.filter(F.col(DAY).isin(days) & (F.col("batch") < before)).groupBy(DAY).agg(F.max("batch").alias("batch")).collect()
    if not newest:
        return None
    wanted = reduce(or_, [(F.col(DAY) == r[DAY]) & (F.col("batch") == r["batch"]) for r in newest])
    return {name: spark.read.schema(schema.format(layout)).parquet(f"{folder}/state/{name}").filter(wanted).drop("batch")
            for name, layout in LAYOUTS.items()}


def merged(own: State, earlier: State | None, folder: str, batch: int) -> State:
    """Add up two states and store the sum as the state after ``batch``."""
    out = {}
    for name, rows in own.items():
        both = rows if earlier is None else rows.unionByName(earlier[name].select(*rows.columns))
        path = f"{folder}/state/{name}"
        _added(name, both).withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(DAY, "batch").parquet(path)
        stored = both.sparkSession.read.schema(f"{LAYOUTS[name]}, {DAY} string, batch bigint").parquet(path)
        out[name] = stored.filter((F.col("batch") == batch) & F.col(DAY).isin(days_of(own))).drop("batch")
    return out


def _added(name: str, rows: DataFrame) -> DataFrame:
    if name == "apps":
        return rows.distinct()
    if name == "ids":
        return rows.groupBy(DAY, "review_id").agg(
            *[F.sum(c).alias(c) for c in SUMS], *[F.min_by(f"first_{c}", "first_seq").alias(f"first_{c}") for c in FIRST],
            F.min("first_seq").alias("first_seq"))
    key, value = ("text_hash", "n") if name == "texts" else ("hour_bucket", "rows_in_hour")
    return rows.groupBy(DAY, key).agg(F.sum(value).alias(value))


def history(state: State, dataset: str) -> DataFrame:
    """Quality row per day of a state."""
    hours = clean.hour_facts_of(state["hours"], [DAY]).select(
        F.col(DAY).alias("of_day"), "hour_bucket", F.col("is_time_anomaly").alias("first_anomaly"))
    many = state["texts"].filter(F.col("n") >= V.DUPLICATE_TEXT_MIN).select(
        F.col(DAY).alias("copies_day"), F.col("text_hash").alias("copied"))
    ids = (
        state["ids"]
        .join(hours, (F.col(DAY) == F.col("of_day")) & F.col("first_hour").eqNullSafe(F.col("hour_bucket")), "left")
        .join(many, (F.col(DAY) == F.col("copies_day")) & (F.col("first_hash") == F.col("copied")), "left")
        .withColumn("first_spam", F.col("copied").isNotNull() | F.col("first_tiny") | F.col("first_anomaly"))
    )
    apps = state["apps"].groupBy(DAY).agg(F.count("*").alias("apps_count"))
    totals = clean.quality_totals(ids, [DAY]).join(apps, DAY, "left")
    return totals.select(F.lit(dataset).alias("dataset"), F.col(DAY).try_cast("date").alias("run_ts"), "*").drop(DAY)
