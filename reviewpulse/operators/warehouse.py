"""Relational model of apps, reviews and load metadata, with constraints and check queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import values
from ..sources.readers import path_exists
from ..sources.shared import settle
from .keyed import with_scalar

REQUIRED = {
    "apps": ["app_id", "app_name"],
    "reviews": [
        "app_id", "review_id", "is_short_text", "has_dev_reply", "is_empty_text", "is_en", "is_noise",
        "is_missing_key_fields", "is_inconsistent_rating", "is_time_anomaly", "is_spam_bot_suspect",
    ],
    "ingestion_meta": ["key", "value"],
}
PRIMARY_KEYS = {"apps": ["app_id"], "reviews": ["app_id", "review_id"], "ingestion_meta": ["key"]}


def apps_table(clean: DataFrame) -> DataFrame:
    """One row per app with its first name in file order.

    The least ``ingest_seq`` (a unique bigint) per app is a fixed-width aggregate; the name is joined to it.
    """
    names = clean.select(F.col("app_id").cast("string").alias("app_id"), "app_name", "ingest_seq")
    firsts = names.groupBy("app_id").agg(F.min("ingest_seq").alias("first_seq")).select("first_seq")
    return names.join(firsts, F.col("ingest_seq") == F.col("first_seq")).select("app_id", "app_name")


HELPERS = ("app_name", "ingest_seq", "ingest_date", "declared_lang")


def reviews_table(clean: DataFrame, helpers: tuple[str, ...] = ()) -> DataFrame:
    """Stored form of the clean table: flags as 0/1, times as text, ids as text, no app name.

    ``helpers`` names columns to carry along that are no part of the table.
    """
    def stored(field):
        kind = field.dataType.typeName()
        col = F.col(field.name)
        if kind == "boolean":
            return col.cast("tinyint").alias(field.name)
        if kind in ("timestamp", "timestamp_ntz"):
            return values.time_text(col).alias(field.name)
        if field.name in ("review_id", "app_id"):
            return col.cast("string").alias(field.name)
        return col
    return clean.select(*[stored(f) for f in clean.schema.fields if f.name not in HELPERS or f.name in helpers])


def subset_label(source: str) -> str:
    name = source.rsplit("/", 1)[-1].lower()
    if V.SUBSET_EN in name:
        return V.SUBSET_EN
    return V.SUBSET_ALL if "clean_all" in name else V.SUBSET_OTHER


def meta_rows(source: str, source_rows, app_count, loaded_at: str | None = None) -> Column:
    """Five key/value rows about a load; the counts are columns."""
    stamp = F.lit(loaded_at) if loaded_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    facts = [
        ("source_file", F.lit(source)), ("data_subset", F.lit(subset_label(source))),
        ("source_rows", source_rows.cast("string")), ("app_count", app_count.cast("string")), ("loaded_at_utc", stamp),
    ]
    return F.inline(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in facts]))


def meta_table(reviews: DataFrame, apps: DataFrame, source: str, loaded_at: str | None = None) -> DataFrame:
    one = with_scalar(reviews.agg(F.count("*").alias("source_rows")), apps.agg(F.count("*").alias("app_count")))
    return one.select(meta_rows(source, F.col("source_rows"), F.col("app_count"), loaded_at))


def tables(clean: DataFrame, source: str, loaded_at: str | None = None) -> dict[str, DataFrame]:
    apps, reviews = apps_table(clean), reviews_table(clean)
    return {"apps": apps, "reviews": reviews, "ingestion_meta": meta_table(reviews, apps, source, loaded_at)}


def orphan_reviews(reviews: DataFrame, apps: DataFrame, rows=None) -> DataFrame:
    """Reviews whose app is unknown, as rows per app. Distinct app ids are compared first, so no hot app is shuffled whole.

    ``rows`` counts what a row of ``reviews`` stands for, if it is not one review.
    """
    counts = reviews.groupBy("app_id").agg((F.count("*") if rows is None else F.sum(rows)).alias("n_rows"))
    return counts.join(apps.select("app_id"), "app_id", "left_anti").filter(F.col("app_id").isNotNull())


def _violation(table: str, rule: str, columns: str, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(columns).alias("columns"),
                    n.cast("bigint").alias("violations"))


def write_observed(df: DataFrame, name: str, path: str) -> dict[str, int]:
    """Write a table and count its rows and the nulls of its required columns on the way.

    The counts come from the tasks that write, one per split of the input, and a task that runs again counts once. So
    nothing is read for them.
    """
    seen = Observation(f"{name}-counts")
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED[name]]]
    df.observe(seen, *counts).write.parquet(path)
    return {k: v or 0 for k, v in seen.get.items()}


def key_violations(loaded: dict[str, DataFrame]) -> DataFrame:
    """Repeated primary keys and orphan reviews; of the reviews only their keys are read and grouped."""
    checks = []
    for name, key in PRIMARY_KEYS.items():
        per_key = loaded[name].groupBy(*key).agg(F.count("*").alias("n"))
        if name == "reviews":
            per_key = settle(per_key, "review-keys")
            orphans = orphan_reviews(per_key, loaded["apps"], F.col("n")).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
            checks.append(orphans.select(F.inline(F.array(_violation(name, "foreign_key", "app_id", F.col("n"))))))
        repeats = per_key.agg(F.count_if(F.col("n") > 1).alias("repeats"))
        checks.append(repeats.select(F.inline(F.array(_violation(name, "primary_key", ",".join(key), F.col("repeats"))))))
    return reduce(DataFrame.unionByName, checks)


def null_violations(spark: SparkSession, observed: dict[str, dict[str, int]]) -> DataFrame:
    rows = [(name, "not_null", c, counts[f"null_{c}"]) for name, counts in observed.items() for c in REQUIRED[name]]
    return spark.createDataFrame(rows, "table_name string, rule string, columns string, violations bigint")


def constraint_violations(loaded: dict[str, DataFrame]) -> DataFrame:
    """Violations per constraint of tables wherever they are: repeated primary keys, orphan reviews, nulls in required columns."""
    nulls = [
        loaded[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).select(
            F.inline(F.array(*[_violation(name, "not_null", c, F.col(c)) for c in columns])))
        for name, columns in REQUIRED.items()]
    return reduce(DataFrame.unionByName, nulls, key_violations(loaded))


# ---- versions --------------------------------------------------------------------------------

MANIFEST = "version bigint, path string, source string, review_rows bigint, app_rows bigint"


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """All complete loads of a warehouse folder; none where nothing was loaded."""
    if not path_exists(spark, f"{folder}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def current(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """The three tables of the newest complete load, None before the first."""
    newest = versions(spark, folder).orderBy(F.desc("version"), "path").first()
    return _opened(spark, newest.path) if newest else None


def _opened(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    loaded = {name: spark.read.parquet(f"{path}/{name}") for name in REQUIRED}
    # App names and sequence numbers travel in the files of the reviews but are no part of the table.
    return {**loaded, "reviews": loaded["reviews"].drop(*HELPERS)}


def stage(clean: DataFrame, source: str, path: str, loaded_at: str | None = None) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Write the three tables to a new path; the tables as read back, and what was counted while they were written.

    The clean rows are computed once, for the reviews. These carry the helper columns in their files, so that the apps
    are taken from two narrow columns of what is stored. Each file of ``reviews`` is sorted by the columns that a
    database would index, so that a filter on them skips row groups.
    """
    spark = clean.sparkSession
    stamp = F.lit(loaded_at) if loaded_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    order = [c for c in ("at_parsed", "score", "is_en", "text_hash") if c in clean.columns]
    reviews = reviews_table(clean, ("app_name", "ingest_seq")).withColumn("loaded_at", stamp).sortWithinPartitions(*order)
    observed = {"reviews": write_observed(reviews, "reviews", f"{path}/reviews")}
    observed["apps"] = write_observed(apps_table(spark.read.parquet(f"{path}/reviews")), "apps", f"{path}/apps")
    counts = spark.range(1).select(meta_rows(
        source, F.lit(observed["reviews"]["rows"]), F.lit(observed["apps"]["rows"]), loaded_at))
    observed["ingestion_meta"] = write_observed(counts, "ingestion_meta", f"{path}/ingestion_meta")
    return _opened(spark, path), observed


def load(clean: DataFrame, source: str, folder: str, loaded_at: str | None = None) -> dict[str, DataFrame]:
    """Write a new version of the three tables, check it, and make it the current one; a violation stops the load.

    A version becomes current by one appended manifest row, so readers see the whole old load or the whole new one,
    and a load that fails leaves the old one as it was. Loads of one folder run one at a time. Old versions
    stay until the folder's retention rule removes them.
    """
    spark = clean.sparkSession
    path = f"{folder}/versions/{uuid.uuid4().hex}"
    loaded, observed = stage(clean, source, path, loaded_at)
    broken = key_violations(loaded).unionByName(null_violations(spark, observed)).filter("violations > 0").collect()
    if broken:
        raise ValueError("warehouse constraints violated: " + "; ".join(
            f"{r.table_name}.{r.columns} {r.rule}: {r.violations}" for r in broken))
    number = (versions(spark, folder).agg(F.max("version")).first()[0] or 0) + 1
    row = (number, path, source, observed["reviews"]["rows"], observed["apps"]["rows"])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return current(spark, folder)


def _sizes(loaded: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        loaded[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n") for name in ("apps", "reviews")])


def _largest_apps(loaded: dict[str, DataFrame], k: int = 5) -> DataFrame:
    sizes = loaded["reviews"].groupBy("app_id").agg(F.count("*").alias("n"))
    return sizes.orderBy(F.desc("n"), "app_id").limit(k)


def _spread(loaded: dict[str, DataFrame], column: str) -> DataFrame:
    """Rows per value; null is a value."""
    return loaded["reviews"].groupBy(column).agg(F.count("*").alias("n"))


def _bad_ids(loaded: dict[str, DataFrame]) -> DataFrame:
    return loaded["reviews"].agg(F.count_if(F.coalesce("review_id", F.lit("")) == "").alias("bad_review_id"))


def _mean_length(loaded: dict[str, DataFrame]) -> DataFrame:
    return loaded["reviews"].agg(F.round(F.avg("content_len"), 2).alias("mean_len"), F.count("*").alias("n"))


# Control questions to a loaded warehouse; each maps its three tables to a small table.
CHECKS = {
    "v_meta": lambda loaded: loaded["ingestion_meta"].select("key", "value"),
    "v_row_counts": _sizes,
    "v_top5_apps": _largest_apps,
    "v_by_score": lambda loaded: _spread(loaded, "score"),
    "v_null_keys": _bad_ids,
    "v_english_dist": lambda loaded: _spread(loaded, "is_en"),
    "v_avg_len": _mean_length,
}


def check(loaded: dict[str, DataFrame], name: str) -> DataFrame:
    """One of the seven control tables."""
    return CHECKS[name](loaded)
