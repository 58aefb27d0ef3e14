"""Stored report tables of many runs, and the metric histories made of them.

Every report is a small table with ``dataset`` and ``run_ts`` in front; a folder holds one sub-folder per kind. The
histories of all runs come out of one job per history: reports are stacked as (run, kind, name, value) rows and turned
into columns with one grouping, so nothing is joined and a run may lack any report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import path_exists
from ..sources.schemas import DISTRIBUTION_HISTORY_COLUMNS, QUALITY_HISTORY_COLUMNS
from ..sources.sinks import replace_runs
from . import clean

RUN = ["dataset", "run_ts"]
# Kind of report -> its columns behind the run: names first, the value last.
LAYOUTS = {
    "quality": "section string, metric string, value double",
    "collection": "metric string, value double",
    "ratings": "score double, count double",
    "lengths": "stat string, value double",
    "english": "metric string, value double",
    "daily": "day date, reviews double",
}
# Where each metric of the quality history stands in the quality report.
QUALITY_PLACES = {metric: section for section, metrics in clean.QUALITY_LAYOUT for metric in metrics}
ENGLISH_SHARE = "english_share_on_clean_all"


def run_reports(flagged: DataFrame, rows: DataFrame, dataset: str = "reviews") -> dict[str, DataFrame]:
    """All reports of every run in ``flagged`` (raw rows with flags) and ``rows`` (the clean table), keyed by ``run_ts``."""
    name = F.lit(dataset).alias("dataset")

    def long(wide: DataFrame, cells: list[tuple[list[str], Column]], columns: list[str]) -> DataFrame:
        entries = [F.struct(*[F.lit(n).alias(c) for c, n in zip(columns, names)], v.cast("double").alias("value")) for names, v in cells]
        return wide.select(name, "run_ts", F.inline(F.array(*entries)))

    en = rows.filter("is_en")
    metrics = clean.quality_metrics(flagged, ["run_ts"])
    counts = flagged.groupBy("run_ts").agg(F.count("*").alias("n"), F.count_distinct("app_id").alias("apps"))
    half = F.percentile("content_len", F.array(F.lit(0.5), F.lit(0.9)))
    lengths = en.groupBy("run_ts").agg(F.avg("content_len").alias("mean"), half.alias("q"))
    share = rows.groupBy("run_ts").agg(F.round(F.avg(F.col("is_en").cast("int")), 6).alias("share"))
    return {
        "quality": long(metrics, [([s, m], F.col(m)) for m, s in QUALITY_PLACES.items()], ["section", "metric"]),
        "collection": long(counts, [(["total_rows"], F.col("n")), (["apps_count"], F.col("apps"))], ["metric"]),
        "ratings": en.filter("score IS NOT NULL").groupBy(name, "run_ts", "score").agg(F.count("*").cast("double").alias("count")),
        "lengths": long(lengths, [(["mean"], F.col("mean")), (["50%"], F.col("q")[0]), (["90%"], F.col("q")[1])], ["stat"]),
        "english": long(share, [([ENGLISH_SHARE], F.col("share"))], ["metric"]),
        "daily": en.filter("at_parsed IS NOT NULL").groupBy(name, "run_ts", F.to_date("at_parsed").alias("day")).agg(
            F.count("*").cast("double").alias("reviews")),
    }


def store(reports: dict[str, DataFrame], folder: str) -> None:
    """Store reports by run; a run that is stored again replaces its earlier reports."""
    for kind, report in reports.items():
        replace_runs(report, f"{folder}/{kind}", RUN)


def stored(spark: SparkSession, folder: str, run_type: str = "string") -> dict[str, DataFrame]:
    """The stored reports; a kind that was never stored is an empty table."""
    out = {}
    for kind, layout in LAYOUTS.items():
        schema = f"{layout}, dataset string, run_ts {run_type}"
        there = path_exists(spark, f"{folder}/{kind}")
        out[kind] = spark.read.schema(schema).parquet(f"{folder}/{kind}") if there else spark.createDataFrame([], schema)
    return out


def _stacked(parts: list[tuple[str, DataFrame, list[str], Column]]) -> DataFrame:
    """Rows (run, kind, name, value) of several reports; names of one report are joined by a point."""
    return reduce(DataFrame.unionByName, [
        df.select(*RUN, F.lit(kind).alias("kind"), F.trim(F.concat_ws(".", *names)).alias("name"), value.cast("double").alias("value"))
        for kind, df, names, value in parts])


def _pick(kind: str, name: str) -> Column:
    """A report's value under a name; null where it is missing. A name that a report repeats gives its greatest value."""
    return F.max(F.when((F.col("kind") == kind) & (F.col("name") == name) & ~F.isnan("value"), F.col("value")))


def quality_history(reports: dict[str, DataFrame]) -> DataFrame:
    """Quality row per run from its quality report and collection metrics.

    ``raw_rows`` is taken from the collection metrics when they have it. A metric that a run lacks is null; a run
    with one of the two reports has a row.
    """
    rows = _stacked([
        ("quality", reports["quality"], ["section", "metric"], F.col("value")),
        ("collection", reports["collection"], ["metric"], F.col("value")),
    ])
    values = {m: _pick("quality", f"{s}.{m}") for m, s in QUALITY_PLACES.items()}
    values["raw_rows"] = F.coalesce(_pick("collection", "total_rows"), values["raw_rows"])
    values["apps_count"] = _pick("collection", "apps_count")
    return rows.groupBy(*RUN).agg(*[values[c].alias(c) for c in QUALITY_HISTORY_COLUMNS if c != "run_ts"])


def distribution_history(reports: dict[str, DataFrame]) -> DataFrame:
    """Distribution row per run from its rating, length, English and daily reports; what a run lacks is null.

    Shares are of all rated rows. The last seven days are the last ones that the run's own daily report lists.
    """
    newest = F.row_number().over(Window.partitionBy(*RUN).orderBy(F.desc("day")))
    last = reports["daily"].filter("day IS NOT NULL").withColumn("place", newest).filter("place <= 7")
    rows = _stacked([
        ("ratings", reports["ratings"], ["score"], F.col("count")),
        ("lengths", reports["lengths"], ["stat"], F.col("value")),
        ("english", reports["english"], ["metric"], F.col("value")),
        ("daily", last, ["day"], F.col("reviews")),
    ])

    def total(kind, *names):
        named = F.col("name").isin(*names) if names else F.lit(True)
        return F.sum(F.when((F.col("kind") == kind) & named, F.col("value")))

    rated = total("ratings")
    values = {f"score_{k}_pct": F.when(rated > 0, F.coalesce(total("ratings", f"{k}.0"), F.lit(0.0)) / rated) for k in range(1, 6)}
    values |= {"len_mean": _pick("lengths", "mean"), "len_p50": _pick("lengths", "50%"), "len_p90": _pick("lengths", "90%"),
               "en_share": _pick("english", ENGLISH_SHARE), "last7d_reviews_sum": total("daily"),
               "last7d_daily_mean": total("daily") / 7.0}
    return rows.groupBy(*RUN).agg(*[values[c].alias(c) for c in DISTRIBUTION_HISTORY_COLUMNS if c != "run_ts"])
