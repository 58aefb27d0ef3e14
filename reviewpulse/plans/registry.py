"""Registered queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..sources.reviews import raw_reviews
from ..sources.shared import settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows on the same tables."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles with six decimals, so that summation order cannot show."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with row-level columns."""
    return clean.label(raw_reviews(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows written once: raw texts are scanned and parsed in one job, whatever reads them afterwards."""
    return settle(labelled(spark, sf_dir), "labelled-rows")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.flag_labelled(stored(spark, sf_dir))


def flagged_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flags without the texts, for rates and counts."""
    return clean.flag_labelled(clean.narrow(labelled(spark, sf_dir)))


def kept(spark: SparkSession, sf_dir: str, *texts: str) -> DataFrame:
    """Clean table without the flags that need other rows, and of its texts only those named."""
    return clean.clean_all(clean.narrow(labelled(spark, sf_dir), *texts))


def kept_en(spark: SparkSession, sf_dir: str, *texts: str) -> DataFrame:
    return kept(spark, sf_dir, *texts).filter("is_en")


def stored_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English clean rows without the texts, written once: the input of sampling, which reads it often."""
    return settle(kept_en(spark, sf_dir), "clean-en")


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows without texts, with the batch key; written once and read by every history."""
    return clean.narrow(clean.label(batched(spark, sf_dir)))


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with the collection day as batch key."""
    return raw_reviews(spark, sf_dir).withColumn("run_ts", F.col("ingest_date"))
