"""Scans: raw CSV, clean tables, named datasets and the app plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import strip
from .schemas import APP_PLAN_SCHEMA, RAW_COLUMNS, RAW_SCHEMA, REVIEW_CLEAN_SCHEMA
from .shared import settle


def _csv(spark: SparkSession, schema):
    # multiLine: review text holds line breaks. Such files are not split, so land many medium-sized ones.
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("enforceSchema", True)
    )


def scan_raw_reviews(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """Raw review CSV with its row number in file order as ``ingest_seq``, from 0; an empty source is an error.

    The CSV is parsed once and stored as Parquet. A block of a file is read by one task, so its rows have consecutive
    ids there; the rows of the blocks before it are added up over the list of blocks, which has a row per block and
    is joined by its measured size. The numbers are the same however files are packed into tasks. Only an unquoted
    empty field is null; the words NA, None or null in a review stay text.
    """
    rows = settle(_csv(spark, RAW_SCHEMA).csv(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place")), "raw")
    if rows.isEmpty():
        raise ValueError(f"raw input is empty: {path}")
    blocks = rows.groupBy("file", "block").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")
    shifts = settle(blocks.select("file", "block", (before - F.col("first")).alias("shift")), "raw-blocks")
    df = rows.join(shifts, ["file", "block"]).select(*RAW_COLUMNS, (F.col("place") + F.col("shift")).alias("ingest_seq"))
    return df.withColumn("ingest_date", F.lit(ingest_date).cast("date")) if ingest_date else df


def scan_clean_reviews(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Clean review table. The CSV reader drops a byte order mark on its own."""
    if fmt == "csv":
        return _csv(spark, REVIEW_CLEAN_SCHEMA).csv(path)
    return spark.read.format(fmt).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def resolve_source(spark: SparkSession, registry: dict[str, list[str]], path: str | None = None,
                   preset: str | None = None) -> str:
    """Explicit path first, then the named preset, then the first dataset of the registry that exists.

    ``registry`` maps preset names to candidate paths in order of preference.
    """
    if path and path_exists(spark, path):
        return path
    if preset:
        key = preset.strip().lower().replace("-", "_")
        if key not in registry:
            raise ValueError(f"unknown preset {preset!r}, expected one of {sorted(registry)}")
        candidates = registry[key]
    else:
        candidates = [p for paths in registry.values() for p in paths]
    for candidate in candidates:
        if path_exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"no dataset found among {candidates}")


def scan_source_preset(spark: SparkSession, registry: dict[str, list[str]], path: str | None = None,
                       preset: str | None = None) -> DataFrame:
    found = resolve_source(spark, registry, path, preset)
    return scan_clean_reviews(spark, found, "csv" if found.endswith(".csv") else "parquet")


def app_plan(df: DataFrame) -> DataFrame:
    """Ingest plan with defaults filled in; rows without an app id are skipped."""
    app_id = strip(F.col("app_id"))
    name = F.col("app_name") if "app_name" in df.columns else F.lit(None).cast("string")
    target = F.col("target_reviews") if "target_reviews" in df.columns else F.lit(None)
    return df.filter(F.coalesce(app_id, F.lit("")) != "").select(
        app_id.alias("app_id"),
        strip(F.coalesce(name, app_id)).alias("app_name"),
        F.coalesce(target.cast("int"), F.lit(V.DEFAULT_TARGET_REVIEWS)).alias("target_reviews"),
    )


def scan_app_plan(spark: SparkSession, path: str) -> DataFrame:
    return app_plan(_csv(spark, APP_PLAN_SCHEMA).csv(path))
