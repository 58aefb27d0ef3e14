"""Metric histories, threshold and drift rules, mutes, status.

The unit is a batch ``(dataset, run_ts)``. Histories hold one row per batch; the alerts of all
batches come out of one job and "latest only" is a filter on top. Windows over a history run per
dataset over as many rows as there were batches, never over reviews.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import stats
from ..sources.schemas import ALERT_COLUMNS
from ..sources.shared import settle
from ..sources.sinks import replace_runs
from . import reports
from .clean import quality_metrics
from .keyed import with_scalar

BATCH = ["dataset", "run_ts"]
SCORE_SHARES = [f"score_{k}_pct" for k in range(1, 6)]
ALERT_FIELDS = (
    "level string, metric string, current double, baseline_or_threshold double, rule string, "
    "message string, mute_key string"
)
CONFIG_DEFAULTS = {
    "thresholds": {
        "raw_rows_min": V.RAW_ROWS_MIN, "apps_count_min_delta": V.APPS_COUNT_MIN_DELTA,
        "duplicate_rate_max": V.DUPLICATE_RATE_MAX, "empty_text_rate_max": V.EMPTY_TEXT_RATE_MAX,
        "parseable_time_rate_min": V.PARSEABLE_TIME_RATE_MIN,
        "parseable_score_rate_min": V.PARSEABLE_SCORE_RATE_MIN, "english_rate_min": V.ENGLISH_RATE_MIN,
        "clean_en_rows_min": V.CLEAN_EN_ROWS_MIN,
        "missing_key_fields_rate_max": V.MISSING_KEY_FIELDS_RATE_MAX,
        "short_text_rate_lt5_warn": V.SHORT_TEXT_RATE_WARN,
    },
    "drift": {
        "baseline_window": V.BASELINE_WINDOW, "psi_rating_max": V.PSI_RATING_MAX,
        "zscore_len_mean_max": V.ZSCORE_LEN_MEAN_MAX,
        "daily_volume_spike_ratio": V.DAILY_VOLUME_SPIKE_RATIO, "en_share_drop_max": V.EN_SHARE_DROP_MAX,
    },
    "expected": {"apps_count": V.APPS_COUNT_EXPECTED},
}


def config(user: dict | None = None) -> dict:
    """Defaults with the user's values laid over them, section by section."""
    user = user or {}
    return {section: {**values, **(user.get(section) or {})} for section, values in CONFIG_DEFAULTS.items()}


# ---- histories -------------------------------------------------------------------------------

def quality_history(flagged: DataFrame, dataset: str = "reviews") -> DataFrame:
    """Quality row per batch. ``flagged`` carries ``run_ts`` and flags computed per batch."""
    apps = (
        flagged.filter(F.col("app_id").isNotNull()).select("run_ts", "app_id").distinct()
        .groupBy("run_ts").agg(F.count("*").alias("apps_count"))
    )
    rows = quality_metrics(flagged, ["run_ts"]).join(apps, "run_ts", "left")
    return rows.select(F.lit(dataset).alias("dataset"), "*")


def quality_history_from_reports(report: DataFrame, raw_metrics: DataFrame, run_ts: str,
                                 dataset: str = "reviews") -> DataFrame:
    """The row of one run from tables of (metric, value), whatever their sections; missing metrics are null."""
    run = [F.lit(dataset).alias("dataset"), F.lit(run_ts).alias("run_ts")]
    places = F.create_map(*[F.lit(x) for pair in reports.QUALITY_PLACES.items() for x in pair])
    return reports.quality_history({
        "quality": report.select(*run, places[F.col("metric")].alias("section"), "metric", "value"),
        "collection": raw_metrics.select(*run, "metric", "value"),
    })


def last_seven(daily: DataFrame) -> DataFrame:
    """Sum over the last seven present days up to each batch and that sum divided by 7.

    ``daily`` holds ``dataset, run_ts, day, reviews``, with a null day and 0 reviews for a batch that has no
    timed row. Days are counted over the dataset, whatever batch brought them; a batch reads its newest
    day, or the newest one of the batches before it.
    """
    days = daily.filter("day IS NOT NULL AND reviews > 0").groupBy("dataset", "day").agg(F.sum("reviews").alias("reviews"))
    present = Window.partitionBy("dataset").orderBy("day").rowsBetween(-6, 0)
    sums = days.select(F.col("dataset").alias("of"), F.col("day").alias("on_day"), F.sum("reviews").over(present).alias("sum7"))
    upto = Window.partitionBy("dataset").orderBy("run_ts").rowsBetween(Window.unboundedPreceding, 0)
    newest = daily.groupBy(*BATCH).agg(F.max(F.when(F.col("reviews") > 0, F.col("day"))).alias("newest"))
    newest = newest.withColumn("newest", F.max("newest").over(upto))
    filled = newest.join(sums, (F.col("dataset") == F.col("of")) & (F.col("newest") == F.col("on_day")), "left")
    return filled.select(
        *BATCH, F.col("sum7").cast("double").alias("last7d_reviews_sum"), (F.col("sum7") / 7.0).alias("last7d_daily_mean")
    )


def daily_reviews(clean: DataFrame, dataset: str = "reviews") -> DataFrame:
    """English rows per batch and day; every batch has a row, if only one without a day."""
    timed = F.col("is_en") & F.col("at_parsed").isNotNull()
    return clean.groupBy(F.lit(dataset).alias("dataset"), "run_ts", F.when(timed, F.to_date("at_parsed")).alias("day")).agg(
        F.count_if(timed).alias("reviews"))


def distribution_history(clean: DataFrame, dataset: str = "reviews") -> DataFrame:
    """Distribution row per batch from the de-duplicated table (all languages).

    One pass: counts per (batch, length) feed the exact quantiles as frequencies and are summed up
    for everything else.
    """
    en = F.col("is_en")
    stars = [F.count_if(en & (F.col("score") == k)).alias(f"star_{k}") for k in range(1, 6)]
    by_length = clean.groupBy("run_ts", F.col("content_len").alias("value")).agg(
        F.count("*").alias("n_all"), F.count_if(en).alias("n"),
        F.count_if(en & F.col("score").isNotNull()).alias("scored"), *stars,
    )
    q = stats.quantiles([0.5, 0.9])
    rows = by_length.groupBy("run_ts").agg(
        *[F.try_divide(F.sum(f"star_{k}"), F.sum("scored")).alias(f"score_{k}_pct") for k in range(1, 6)],
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("len_mean"),
        q.alias("q"), F.round(F.sum("n") / F.sum("n_all"), 6).alias("en_share"),
    ).select(F.lit(dataset).alias("dataset"), "*")
    seven = last_seven(settle(daily_reviews(clean, dataset), "daily"))
    return rows.join(seven, BATCH).select(
        *BATCH, *SCORE_SHARES, "len_mean", F.col("q")[0].alias("len_p50"), F.col("q")[1].alias("len_p90"),
        "en_share", "last7d_reviews_sum", "last7d_daily_mean",
    )


def latest(history: DataFrame) -> DataFrame:
    """Newest batch of each dataset, by ``run_ts`` and not by position in a file."""
    newest = history.groupBy("dataset").agg(F.max("run_ts").alias("run_ts"))
    return history.join(newest, BATCH, "left_semi")


# ---- rules -----------------------------------------------------------------------------------

def rule_table(spark: SparkSession, cfg: dict) -> DataFrame:
    """Hard rules as rows (metric, op, threshold, level, rule, message)."""
    t, expected = cfg["thresholds"], int(cfg["expected"].get("apps_count") or 0)
    rules = [(m, "missing", None, "WARN", "missing_value", "no value, rule skipped")
             for m in ("raw_rows", "clean_en_rows", "duplicate_rate", "parseable_time_rate", "parseable_score_rate")]
    below = [("raw_rows", "raw_rows_min"), ("parseable_time_rate", "parseable_time_rate_min"),
             ("parseable_score_rate", "parseable_score_rate_min"), ("english_rate_after_p0", "english_rate_min"),
             ("clean_en_rows", "clean_en_rows_min")]
    above = [("duplicate_rate", "duplicate_rate_max"), ("empty_text_rate", "empty_text_rate_max"),
             ("missing_key_fields_rate", "missing_key_fields_rate_max")]
    rules += [(m, "<", float(t[k]), "ERROR", "threshold_min", "below the allowed minimum") for m, k in below]
    rules += [(m, ">", float(t[k]), "ERROR", "threshold_max", "above the allowed maximum") for m, k in above]
    if expected > 0:
        floor = float(expected - int(t["apps_count_min_delta"]))
        rules.append(("apps_count", "<", floor, "ERROR", "threshold_min", "fewer apps than expected"))
    rules.append(("short_text_rate_lt5", ">", float(t["short_text_rate_lt5_warn"]), "WARN", "threshold_max",
                  "many short texts"))
    return spark.createDataFrame(
        rules, "metric string, op string, threshold double, level string, rule string, message string")


def _long(history: DataFrame) -> DataFrame:
    metrics = [c for c in history.columns if c not in BATCH]
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return history.select(*BATCH, F.inline(F.array(*cells)))


def threshold_alerts(history: DataFrame, cfg: dict) -> DataFrame:
    """Join every batch's metrics with the fixed-size rule table and keep the violations; all comparisons are strict."""
    rules = rule_table(history.sparkSession, cfg)
    value, limit = F.col("value"), F.col("threshold")
    violated = (
        F.when(F.col("op") == "missing", value.isNull())
        .when(F.col("op") == "<", value < limit).when(F.col("op") == ">", value > limit)
    )
    return _long(history).join(F.broadcast(rules), "metric").filter(F.coalesce(violated, F.lit(False))).select(
        *BATCH, "level", "metric", value.alias("current"), limit.alias("baseline_or_threshold"), "rule", "message",
        F.col("metric").alias("mute_key"),
    )


def _alert(condition, level, metric, current, limit, rule, message, mute_key=None):
    """Alert struct when the condition holds, else null."""
    def number(c):
        return (F.lit(c) if c is None or isinstance(c, (int, float)) else c).cast("double")

    return F.when(condition, F.struct(
        F.lit(level).alias("level"), F.lit(metric).alias("metric"), number(current).alias("current"),
        number(limit).alias("baseline_or_threshold"), F.lit(rule).alias("rule"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        F.lit(mute_key).cast("string").alias("mute_key"),
    ))


def _alert_rows(df: DataFrame, alerts: list) -> DataFrame:
    return df.select(*BATCH, F.inline(F.array_compact(F.array(*alerts))))


def reconcile_alerts(history: DataFrame, store: DataFrame) -> DataFrame:
    """Compare stored row counts with the history.

    ``store`` has ``dataset, run_ts, stored_rows, data_subset, source_rows``. The subset label
    decides which history metric is the expected count.
    """
    rows = history.select(*BATCH, "clean_en_rows", "clean_all_rows").join(store, BATCH, "left")
    stored, subset = F.col("stored_rows"), F.coalesce("data_subset", F.lit("none"))
    expected = F.when(subset == V.SUBSET_EN, F.col("clean_en_rows")).when(subset == V.SUBSET_ALL, F.col("clean_all_rows"))
    known = subset.isin(V.SUBSET_EN, V.SUBSET_ALL)
    rows = rows.withColumn("expected", expected.cast("bigint"))
    want = F.col("expected")
    name, key = V.STORED_COUNT_METRIC, V.STORED_COUNT_METRIC
    first = F.coalesce(
        _alert(stored.isNull(), "WARN", name, None, None, "missing", "no stored table", key),
        _alert(~known, "INFO", name, stored, None, "unknown_subset",
               F.concat(F.lit("count not compared for subset "), subset), key),
        _alert(want.isNull(), "WARN", name, stored, None, "missing", "expected count unknown", key),
        _alert(stored != want, "ERROR", name, stored, want, "eq", "stored count differs from the history", key),
        _alert(F.col("source_rows") != stored, "WARN", V.STORED_META_METRIC, F.col("source_rows"), stored,
               "mismatch", "load metadata may be stale", key),
    )
    return _alert_rows(rows, [first])


def baseline_features(history: DataFrame, cfg: dict) -> DataFrame:
    """Distribution history with the statistics of the preceding batches, the current one excluded."""
    w = int(cfg["drift"]["baseline_window"])
    order = Window.partitionBy("dataset").orderBy("run_ts")
    before = order.rowsBetween(-w, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return history.select(
        "*", F.count("*").over(upto).alias("history_rows"),
        *[F.avg(c).over(before).alias(f"base_{c}") for c in [*SCORE_SHARES, "len_mean", "last7d_daily_mean", "en_share"]],
        F.stddev_pop("len_mean").over(before).alias("base_len_std"),
        F.count("len_mean").over(before).alias("base_len_n"),
    )


def drift_features(history: DataFrame, cfg: dict) -> DataFrame:
    """PSI, length z-score, volume ratio and English-share drop per batch."""
    base = baseline_features(history, cfg)
    current = [F.col(c) for c in SCORE_SHARES]
    previous = [F.col(f"base_{c}") for c in SCORE_SHARES]

    def normed(cols):
        total = sum(cols[1:], cols[0])
        return [F.try_divide(c, total) for c in cols]

    any_null = lambda cols: reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    psi = stats.population_stability_index(normed(current), normed(previous))
    score_gap = F.abs(F.col("len_mean") - F.col("base_len_mean"))
    return base.select(
        "*", any_null(current).alias("psi_current_missing"),
        (any_null(previous) | (sum(previous[1:], previous[0]) == 0)).alias("psi_baseline_missing"),
        psi.alias("psi"),
        F.when((F.col("base_len_n") >= 2) & (F.col("base_len_std") > 0), score_gap / F.col("base_len_std")).alias("len_z"),
        F.when(F.col("base_last7d_daily_mean") > 0, F.col("last7d_daily_mean") / F.col("base_last7d_daily_mean"))
        .alias("volume_ratio"),
        (F.col("base_en_share") - F.col("en_share")).alias("en_drop"),
    )


def drift_alerts(history: DataFrame, cfg: dict) -> DataFrame:
    d = cfg["drift"]
    need = int(d["baseline_window"]) + 1
    f = drift_features(history, cfg)
    ready = F.col("history_rows") >= need
    psi_max, z_max = float(d["psi_rating_max"]), float(d["zscore_len_mean_max"])
    ratio_max, drop_max = float(d["daily_volume_spike_ratio"]), float(d["en_share_drop_max"])
    psi_ok = ~F.col("psi_current_missing") & ~F.col("psi_baseline_missing")
    return _alert_rows(f, [
        _alert(~ready, "INFO", "drift", F.col("history_rows"), need, "cold_start", "too few batches for drift rules"),
        _alert(ready & F.col("psi_current_missing"), "WARN", "score_dist_psi", None, None, "missing",
               "current star shares incomplete"),
        _alert(ready & ~F.col("psi_current_missing") & F.col("psi_baseline_missing"), "WARN", "score_dist_psi", None, None,
               "missing", "baseline star shares incomplete"),
        _alert(ready & psi_ok & (F.col("psi") > psi_max), "WARN", "score_dist_psi", F.col("psi"), psi_max, "psi_max",
               "star shares moved away from the baseline", "score_dist_psi"),
        _alert(ready & (F.col("len_z") > z_max), "WARN", "len_mean_zscore", F.col("len_z"), z_max, "zscore_max",
               "mean text length is an outlier", "len_mean_zscore"),
        _alert(ready & (F.col("volume_ratio") > ratio_max), "WARN", "last7d_daily_mean", F.col("last7d_daily_mean"),
               F.col("base_last7d_daily_mean") * ratio_max, "spike_ratio", "daily volume above its baseline",
               "last7d_daily_mean"),
        _alert(ready & (F.col("en_drop") > drop_max), "WARN", "en_share_drop", F.col("en_share"),
               F.col("base_en_share") - drop_max, "threshold_min", "English share fell", "en_share_drop"),
    ])


# ---- mutes, guards, status -------------------------------------------------------------------

def mute_table(spark: SparkSession, mutes: list[dict]) -> DataFrame:
    rows = [(str(m.get("metric")), None if not m.get("until") else str(m["until"])) for m in mutes if isinstance(m, dict)]
    return spark.createDataFrame(rows, "metric string, until string")


def apply_mutes(alerts: DataFrame, mutes: DataFrame, today: str) -> DataFrame:
    """Drop alerts whose metric is muted up to today or with an unreadable end date; no end date mutes nothing."""
    until = F.when(F.col("until").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.col("until").try_cast("date"))
    active = mutes.filter(
        F.col("until").isNotNull() & (F.col("until") != "")
        & (until.isNull() | (F.lit(today).cast("date") <= until))
    ).select(F.col("metric").alias("muted_metric")).distinct()
    return alerts.join(active, F.col("mute_key") == F.col("muted_metric"), "left_anti")


def guard_alerts(spark: SparkSession, quality: DataFrame | None, distribution: DataFrame | None,
                 config_state: str = "ok", run_ts: str = "now", dataset: str = "reviews") -> DataFrame:
    """Alerts about absent inputs; these cannot be muted.

    They belong to the batches of the quality history: an unusable configuration concerns each batch, a missing
    distribution row the batch that lacks it. Without any batch they belong to (``dataset``, ``run_ts``), the alert
    run itself. Conditions are columns, so nothing is collected to find them.
    """
    itself = spark.range(1).select(F.lit(dataset).alias("dataset"), F.lit(run_ts).alias("run_ts"))
    unusable = _alert(F.lit(config_state != "ok"), "WARN", "config_file", None, None, config_state, "no usable configuration, defaults apply")
    if quality is None:
        return _alert_rows(itself, [
            unusable, _alert(F.lit(True), "WARN", "data_quality_history", None, None, "missing", "no quality history")])
    kind = dict(quality.dtypes)["run_ts"]
    batches = quality.select(*BATCH)
    listed = batches.limit(0) if distribution is None else distribution.select(*BATCH)
    known = listed.distinct().withColumn("known", F.lit(True))
    of_batches = _alert_rows(batches.join(known, BATCH, "left"), [
        unusable, _alert(F.col("known").isNull(), "WARN", "distribution_history", None, None, "missing",
                         "no distribution row, drift rules skipped")])
    none = with_scalar(itself.withColumn("run_ts", F.lit(run_ts).try_cast(kind)), batches.agg(F.count("*").alias("n_batches")))
    empty = F.col("n_batches") == 0
    of_run = _alert_rows(none.filter(empty), [
        unusable, _alert(empty, "WARN", "data_quality_history", 0.0, None, "empty", "quality history has no rows")])
    return of_batches.unionByName(of_run)


def alerts(quality: DataFrame, distribution: DataFrame | None, cfg: dict, store: DataFrame | None = None,
           mutes: DataFrame | None = None, today: str | None = None) -> DataFrame:
    """All alerts of all batches."""
    parts = [threshold_alerts(quality, cfg)]
    if store is not None:
        parts.append(reconcile_alerts(quality, store))
    if distribution is not None:
        parts.append(drift_alerts(distribution, cfg))
    found = reduce(DataFrame.unionByName, parts)
    if mutes is not None:
        found = apply_mutes(found, mutes, today)
    return found


def published(found: DataFrame) -> DataFrame:
    """Alert columns in their stored order."""
    return found.select("dataset", *ALERT_COLUMNS)


def overall_status(batches: DataFrame, found: DataFrame) -> DataFrame:
    """Counts per level, status and recommendation for every batch, alerts or not."""
    level = F.col("level")
    counts = found.groupBy(*BATCH).agg(*[F.count_if(level == x).alias(f"n_{x.lower()}") for x in ("ERROR", "WARN", "INFO")])
    rows = batches.select(*BATCH).distinct().join(counts, BATCH, "left").na.fill(0, ["n_error", "n_warn", "n_info"])
    errors, warns = F.col("n_error") > 0, F.col("n_warn") > 0
    return rows.select(
        "*", F.when(errors, "ERROR").when(warns, "WARN").otherwise("OK").alias("status"),
        F.when(errors, "hold back and investigate").when(warns, "usable after review").otherwise("all checks passed")
        .alias("recommendation"),
        F.when(errors, 1).otherwise(0).alias("exit_code"),
    )


# ---- alert runs ------------------------------------------------------------------------------

STORED_ALERT = ALERT_FIELDS + ", dataset string, run_ts {kind}"


def alert_run(spark: SparkSession, quality: DataFrame | None, distribution: DataFrame | None, folder: str, cfg: dict | None = None,
              config_state: str = "ok", stored_counts: DataFrame | None = None, mutes: DataFrame | None = None,
              today: str | None = None, run_ts: str = "now", dataset: str = "reviews") -> DataFrame:
    """One run over all batches: guards, rules, reconciliation and drift; stores the alerts, returns the status per batch.

    Alerts are stored by batch and a repeated run replaces those of its batches, so running twice adds nothing; a
    batch without alerts leaves a mark, which replaces the alerts that an earlier run found. Without a quality
    history only the guards speak, under ``run_ts``; the status is then WARN.
    """
    cfg = cfg or config()
    found = guard_alerts(spark, quality, distribution, config_state, run_ts, dataset)
    batches = found.select(*BATCH)
    if quality is not None:
        found = found.unionByName(alerts(quality, distribution, cfg, stored_counts, mutes, today))
        batches = batches.unionByName(quality.select(*BATCH))
    found = settle(found, "alerts")
    batches = settle(batches.distinct(), "batches")
    marks = batches.select("*", *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in ALERT_FIELDS.split(", ")])
    replace_runs(found.unionByName(marks), folder, BATCH)
    return overall_status(batches, found)


def stored_alerts(spark: SparkSession, folder: str, run_type: str = "string") -> DataFrame:
    """All alerts in a store, in their published columns."""
    return published(spark.read.schema(STORED_ALERT.format(kind=run_type)).parquet(folder).filter("level IS NOT NULL"))


def fail_on_error(status: DataFrame) -> None:
    """Non-zero job outcome when any batch has an error."""
    if not status.filter("status = 'ERROR'").isEmpty():
        raise RuntimeError("monitoring found ERROR alerts")


def snapshot(quality: DataFrame, distribution: DataFrame, status: DataFrame) -> DataFrame:
    """Key metrics of the newest batch next to its status."""
    share = distribution.select(*BATCH, "en_share")
    return latest(quality).join(share, BATCH, "left").join(status.select(*BATCH, "status"), BATCH, "left").select(
        *BATCH, "clean_en_rows", "clean_all_rows", "raw_rows", "duplicate_rate", "parseable_time_rate",
        "english_rate_after_p0", "en_share", "status",
    )
