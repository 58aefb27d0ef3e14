"""Queries over metric histories, rules, drift, mutes and status; one batch per collection day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import clean, keyed, monitor, reports
from ..sources.schemas import QUALITY_HISTORY_COLUMNS
from ..sources.shared import new_path, settle
from .base_sql import on_batches
from .registry import batch_rows, batched, query

CFG = monitor.config()
TODAY = "2024-02-01"


def quality(spark, sf_dir, rows=None):
    """One row per batch; settled because rules, status and snapshot all read it."""
    rows = batch_rows(spark, sf_dir) if rows is None else rows
    return settle(monitor.quality_history(clean.flag_labelled(rows, ["run_ts"])), "quality-history")


def distribution(spark, sf_dir, rows=None):
    rows = batch_rows(spark, sf_dir) if rows is None else rows
    return monitor.distribution_history(clean.clean_all(rows, ["run_ts"]))


def histories(spark, sf_dir):
    rows = batch_rows(spark, sf_dir)
    return quality(spark, sf_dir, rows), settle(distribution(spark, sf_dir, rows), "distribution-history")


QUALITY = """raw_side AS (
  SELECT run_ts, COUNT(*) AS raw_rows, COUNT(DISTINCT app_id) AS apps_count,
    round((COUNT(*) - COUNT(DISTINCT review_id)) / COUNT(*)::DOUBLE, 4) AS duplicate_rate,
    round(AVG(CAST(is_empty_text AS INT)), 4) AS empty_text_rate, round(AVG(CAST(is_short_text AS INT)), 4) AS short_text_rate_lt5,
    round(AVG(CAST(at_parsed IS NOT NULL AS INT)), 4) AS parseable_time_rate,
    round(AVG(CAST(score IS NOT NULL AS INT)), 4) AS parseable_score_rate,
    round(AVG(CAST(is_missing_key_fields AS INT)), 4) AS missing_key_fields_rate
  FROM flagged GROUP BY run_ts
), kept_side AS (
  SELECT run_ts, round(AVG(CAST(is_en AS INT)), 4) AS english_rate_after_p0, round(AVG(CAST(is_noise AS INT)), 4) AS noise_rate_after_p0,
    round(AVG(CAST(is_inconsistent_rating AS INT)), 4) AS inconsistent_rating_rate, round(AVG(CAST(is_time_anomaly AS INT)), 4) AS time_anomaly_rate,
    round(AVG(CAST(is_spam_bot_suspect AS INT)), 4) AS spam_bot_suspect_rate, COUNT(*) AS clean_all_rows,
    COUNT(*) FILTER (WHERE is_en) AS clean_en_rows
  FROM kept GROUP BY run_ts
), quality AS MATERIALIZED (
  SELECT r.run_ts, raw_rows, apps_count, duplicate_rate, empty_text_rate, short_text_rate_lt5, parseable_time_rate, parseable_score_rate,
    COALESCE(english_rate_after_p0, 0) AS english_rate_after_p0, COALESCE(noise_rate_after_p0, 0) AS noise_rate_after_p0,
    missing_key_fields_rate, COALESCE(inconsistent_rating_rate, 0) AS inconsistent_rating_rate,
    COALESCE(time_anomaly_rate, 0) AS time_anomaly_rate, COALESCE(spam_bot_suspect_rate, 0) AS spam_bot_suspect_rate,
    COALESCE(clean_all_rows, 0) AS clean_all_rows, COALESCE(clean_en_rows, 0) AS clean_en_rows
  FROM raw_side r LEFT JOIN kept_side k ON k.run_ts = r.run_ts
)"""

_PCT = ", ".join(
    f"COUNT(*) FILTER (WHERE is_en AND score = {k}) / NULLIF(COUNT(score) FILTER (WHERE is_en), 0)::DOUBLE AS score_{k}_pct"
    for k in range(1, 6))
DISTRIBUTION = f"""shape AS (
  SELECT run_ts, {_PCT}, AVG(content_len) FILTER (WHERE is_en) AS len_mean,
    quantile_cont(content_len, 0.5) FILTER (WHERE is_en) AS len_p50, quantile_cont(content_len, 0.9) FILTER (WHERE is_en) AS len_p90,
    round(AVG(CAST(is_en AS INT)), 6) AS en_share, COUNT(at_parsed) FILTER (WHERE is_en) AS volume
  FROM kept GROUP BY run_ts
), present AS (
  SELECT run_ts, SUM(volume) OVER (ORDER BY run_ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sum7 FROM shape WHERE volume > 0
), distribution AS MATERIALIZED (
  SELECT s.* EXCLUDE (volume), CAST(p.sum7 AS DOUBLE) AS last7d_reviews_sum, p.sum7 / 7.0::DOUBLE AS last7d_daily_mean
  FROM shape s ASOF LEFT JOIN present p ON s.run_ts >= p.run_ts
)"""

_DIST_COLS = [*monitor.SCORE_SHARES, "len_mean", "len_p50", "len_p90", "en_share", "last7d_reviews_sum", "last7d_daily_mean"]


@query("m_quality_history", on_batches(QUALITY, f"SELECT 'reviews' AS dataset, {', '.join(QUALITY_HISTORY_COLUMNS)} FROM quality"))
def m_quality_history(spark, sf_dir):
    return quality(spark, sf_dir).select("dataset", *QUALITY_HISTORY_COLUMNS)


@query("m_distribution_history", on_batches(DISTRIBUTION, "SELECT 'reviews' AS dataset, run_ts, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in _DIST_COLS) + " FROM distribution"))
def m_distribution_history(spark, sf_dir):
    return distribution(spark, sf_dir)


@query("w_last7_rows", on_batches(DISTRIBUTION, """SELECT 'reviews' AS dataset, run_ts, round(last7d_reviews_sum, 6) AS last7d_reviews_sum,
  round(last7d_daily_mean, 6) AS last7d_daily_mean FROM distribution"""))
def w_last7_rows(spark, sf_dir):
    rows = clean.clean_all(clean.label(batched(spark, sf_dir)), ["run_ts"])
    return monitor.last_seven(settle(monitor.daily_reviews(rows), "daily"))


@query("w_latest_row", on_batches(QUALITY, "SELECT run_ts, raw_rows, clean_all_rows FROM quality ORDER BY run_ts DESC LIMIT 1"))
def w_latest_row(spark, sf_dir):
    return monitor.latest(quality(spark, sf_dir)).select("run_ts", "raw_rows", "clean_all_rows")


_BEFORE = "(ORDER BY run_ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
_BASES = [*monitor.SCORE_SHARES, "len_mean", "last7d_daily_mean", "en_share"]
FEATURES = f"""based AS (
  SELECT *, COUNT(*) OVER (ORDER BY run_ts) AS history_rows, {', '.join(f'AVG({c}) OVER {_BEFORE} AS base_{c}' for c in _BASES)},
    stddev_pop(len_mean) OVER {_BEFORE} AS base_len_std, COUNT(len_mean) OVER {_BEFORE} AS base_len_n
  FROM distribution
), sums AS (
  SELECT *, {' + '.join(monitor.SCORE_SHARES)} AS cur_sum, {' + '.join('base_' + c for c in monitor.SCORE_SHARES)} AS base_sum FROM based
), floored AS (
  SELECT *, {', '.join(f'greatest(least({c} / cur_sum, 1.0), 1e-6) AS p{i}, greatest(least(base_{c} / base_sum, 1.0), 1e-6) AS q{i}' for i, c in enumerate(monitor.SCORE_SHARES))}
  FROM sums
), shares AS (
  SELECT *, p0 + p1 + p2 + p3 + p4 AS ps, q0 + q1 + q2 + q3 + q4 AS qs FROM floored
), features AS MATERIALIZED (
  SELECT *, {' + '.join(f'(p{i} / ps - q{i} / qs) * ln((p{i} / ps) / (q{i} / qs))' for i in range(5))} AS psi,
    CASE WHEN base_len_n >= 2 AND base_len_std > 0 THEN abs(len_mean - base_len_mean) / base_len_std END AS len_z,
    CASE WHEN base_last7d_daily_mean > 0 THEN last7d_daily_mean / base_last7d_daily_mean END AS volume_ratio,
    base_en_share - en_share AS en_drop
  FROM shares
)"""


@query("w_baseline5", on_batches(f"{DISTRIBUTION}, {FEATURES}", "SELECT run_ts, history_rows, "
       + ", ".join(f"round(base_{c}, 6) AS base_{c}" for c in _BASES)
       + ", round(base_len_std, 6) AS base_len_std, base_len_n FROM features"))
def w_baseline5(spark, sf_dir):
    base = monitor.baseline_features(distribution(spark, sf_dir), CFG)
    return base.select("run_ts", "history_rows", *[f"base_{c}" for c in _BASES], "base_len_std", "base_len_n")


def _feature(name: str, column: str):
    @query(name, on_batches(f"{DISTRIBUTION}, {FEATURES}", f"SELECT run_ts, round({column}, 6) AS {column} FROM features"))
    def run(spark, sf_dir):
        return monitor.drift_features(distribution(spark, sf_dir), CFG).select("run_ts", column)


_feature("m_drift_psi", "psi")
_feature("m_drift_len_z", "len_z")
_feature("m_drift_volume", "volume_ratio")
_feature("m_drift_en_share", "en_drop")


def _threshold_sql() -> str:
    t = CFG["thresholds"]
    rules = [("raw_rows", "<", t["raw_rows_min"]), ("parseable_time_rate", "<", t["parseable_time_rate_min"]),
             ("parseable_score_rate", "<", t["parseable_score_rate_min"]), ("english_rate_after_p0", "<", t["english_rate_min"]),
             ("clean_en_rows", "<", t["clean_en_rows_min"]), ("duplicate_rate", ">", t["duplicate_rate_max"]),
             ("empty_text_rate", ">", t["empty_text_rate_max"]), ("missing_key_fields_rate", ">", t["missing_key_fields_rate_max"]),
             ("apps_count", "<", V.APPS_COUNT_EXPECTED - V.APPS_COUNT_MIN_DELTA), ("short_text_rate_lt5", ">", t["short_text_rate_lt5_warn"])]
    parts = []
    for metric, op, limit in rules:
        level = "WARN" if metric == "short_text_rate_lt5" else "ERROR"
        rule = "threshold_min" if op == "<" else "threshold_max"
        parts.append(f"SELECT run_ts, '{level}' AS level, '{metric}' AS metric, round(CAST({metric} AS DOUBLE), 6) AS current, "
                     f"CAST({limit} AS DOUBLE) AS baseline_or_threshold, '{rule}' AS rule, '{metric}' AS mute_key "
                     f"FROM quality WHERE {metric} {op} {limit}")
    return " UNION ALL ".join(parts)


HARD = f"hard AS ({_threshold_sql()})"
DRIFT = f"""drift AS (
  SELECT run_ts, 'INFO' AS level, 'drift' AS metric, CAST(history_rows AS DOUBLE) AS current, CAST(6 AS DOUBLE) AS baseline_or_threshold,
    'cold_start' AS rule, NULL AS mute_key FROM features WHERE history_rows < 6
  UNION ALL SELECT run_ts, 'WARN', 'score_dist_psi', NULL, NULL, 'missing', NULL FROM features
    WHERE history_rows >= 6 AND (cur_sum IS NULL OR base_sum IS NULL OR base_sum = 0)
  UNION ALL SELECT run_ts, 'WARN', 'score_dist_psi', round(psi, 6), {V.PSI_RATING_MAX}, 'psi_max', 'score_dist_psi' FROM features
    WHERE history_rows >= 6 AND psi > {V.PSI_RATING_MAX}
  UNION ALL SELECT run_ts, 'WARN', 'len_mean_zscore', round(len_z, 6), {V.ZSCORE_LEN_MEAN_MAX}, 'zscore_max', 'len_mean_zscore' FROM features
    WHERE history_rows >= 6 AND len_z > {V.ZSCORE_LEN_MEAN_MAX}
  UNION ALL SELECT run_ts, 'WARN', 'last7d_daily_mean', round(last7d_daily_mean, 6),
    round(base_last7d_daily_mean * {V.DAILY_VOLUME_SPIKE_RATIO}, 6), 'spike_ratio', 'last7d_daily_mean' FROM features
    WHERE history_rows >= 6 AND volume_ratio > {V.DAILY_VOLUME_SPIKE_RATIO}
  UNION ALL SELECT run_ts, 'WARN', 'en_share_drop', round(en_share, 6), round(base_en_share - {V.EN_SHARE_DROP_MAX}, 6), 'threshold_min',
    'en_share_drop' FROM features WHERE history_rows >= 6 AND en_drop > {V.EN_SHARE_DROP_MAX}
)"""
_SHOWN = "run_ts, level, metric, current, baseline_or_threshold, rule"
_SHOWN_COLS = _SHOWN.split(", ")


@query("m_rule_thresholds", on_batches(f"{QUALITY}, {HARD}", f"SELECT {_SHOWN} FROM hard"))
def m_rule_thresholds(spark, sf_dir):
    return monitor.threshold_alerts(quality(spark, sf_dir), CFG).select(*_SHOWN_COLS)


@query("m_rule_missing", on_batches(QUALITY, """SELECT run_ts, 'WARN' AS level, m AS metric, CAST(NULL AS DOUBLE) AS current,
  'missing_value' AS rule FROM quality CROSS JOIN (VALUES ('clean_en_rows'), ('duplicate_rate')) v(m) WHERE raw_rows % 2 = 1"""))
def m_rule_missing(spark, sf_dir):
    """Batches with an odd row count lose two metrics first; the rule has to find exactly these."""
    odd = F.col("raw_rows") % 2 == 1
    gaps = quality(spark, sf_dir).withColumns({
        m: F.when(~odd, F.col(m)) for m in ("clean_en_rows", "duplicate_rate")})
    found = monitor.threshold_alerts(gaps, CFG).filter("rule = 'missing_value'")
    return found.select("run_ts", "level", "metric", "current", "rule")


@query("m_drift_cold_start", on_batches(f"{DISTRIBUTION}, {FEATURES}, {DRIFT}", f"SELECT {_SHOWN} FROM drift WHERE rule = 'cold_start'"))
def m_drift_cold_start(spark, sf_dir):
    return monitor.drift_alerts(distribution(spark, sf_dir), CFG).filter("rule = 'cold_start'").select(*_SHOWN_COLS)


@query("m_drift_alerts", on_batches(f"{DISTRIBUTION}, {FEATURES}, {DRIFT}", f"SELECT {_SHOWN} FROM drift"))
def m_drift_alerts(spark, sf_dir):
    return monitor.drift_alerts(distribution(spark, sf_dir), CFG).select(*_SHOWN_COLS)


def store(history):
    """Stored counts per batch in every state the rule knows, told apart by the day of the batch."""
    kind = F.dayofmonth("run_ts") % 6
    en, every = F.col("clean_en_rows"), F.col("clean_all_rows")
    subset = F.when(kind == 0, V.SUBSET_EN).when(kind.isin(1, 2, 3), V.SUBSET_ALL).when(kind == 4, V.SUBSET_OTHER)
    stored = F.when(kind == 0, en).when(kind == 2, every + 1).otherwise(every)
    source = F.when(kind == 3, stored + 5).otherwise(stored)
    return history.filter(kind != 5).select(
        "dataset", "run_ts", stored.alias("stored_rows"), subset.alias("data_subset"), source.alias("source_rows"))


RECONCILE = f"""kinds AS (SELECT *, day(run_ts) % 6 AS kind FROM quality), reconcile AS (
  SELECT run_ts, 'ERROR' AS level, '{V.STORED_COUNT_METRIC}' AS metric, CAST(clean_all_rows + 1 AS DOUBLE) AS current,
    CAST(clean_all_rows AS DOUBLE) AS baseline_or_threshold, 'eq' AS rule, '{V.STORED_COUNT_METRIC}' AS mute_key FROM kinds WHERE kind = 2
  UNION ALL SELECT run_ts, 'WARN', '{V.STORED_META_METRIC}', clean_all_rows + 5, clean_all_rows, 'mismatch', '{V.STORED_COUNT_METRIC}' FROM kinds WHERE kind = 3
  UNION ALL SELECT run_ts, 'INFO', '{V.STORED_COUNT_METRIC}', clean_all_rows, NULL, 'unknown_subset', '{V.STORED_COUNT_METRIC}' FROM kinds WHERE kind = 4
  UNION ALL SELECT run_ts, 'WARN', '{V.STORED_COUNT_METRIC}', NULL, NULL, 'missing', '{V.STORED_COUNT_METRIC}' FROM kinds WHERE kind = 5
)"""


@query("m_reconcile_rows", on_batches(f"{QUALITY}, {RECONCILE}", f"""SELECT r.run_ts, level, metric, current, baseline_or_threshold, rule,
    CASE rule WHEN 'unknown_subset' THEN 'count not compared for subset {V.SUBSET_OTHER}' WHEN 'eq' THEN 'stored count differs from the history'
      WHEN 'mismatch' THEN 'load metadata may be stale' ELSE 'no stored table' END AS message FROM reconcile r
  UNION ALL SELECT run_ts, 'WARN', '{V.STORED_COUNT_METRIC}', clean_en_rows, NULL, 'missing', 'expected count unknown' FROM kinds
  WHERE kind = 0 AND raw_rows % 2 = 1"""))
def m_reconcile_rows(spark, sf_dir):
    """Every state of the store; batches with an odd row count have no English count to compare with."""
    history = quality(spark, sf_dir)
    gaps = history.withColumn("clean_en_rows", F.when(F.col("raw_rows") % 2 == 0, F.col("clean_en_rows")))
    return monitor.reconcile_alerts(gaps, store(history)).select(*_SHOWN_COLS, "message")


@query("j_reconcile", on_batches(QUALITY, """SELECT 'clean_all_rows' AS label, SUM(clean_all_rows) AS expected, (SELECT COUNT(*) FROM kept) AS stored FROM quality
  UNION ALL SELECT 'clean_en_rows', SUM(clean_en_rows), (SELECT COUNT(*) FROM kept_en) FROM quality"""))
def j_reconcile(spark, sf_dir):
    """Stored rows, counted from the clean table, next to the sums of the history."""
    batches = batch_rows(spark, sf_dir)
    history = quality(spark, sf_dir, batches)
    rows = clean.clean_all(batches, ["run_ts"])
    stored = rows.agg(F.count("*").alias("all_rows"), F.count_if("is_en").alias("en_rows"))
    sums = history.agg(F.sum("clean_all_rows").alias("a"), F.sum("clean_en_rows").alias("e"))
    pairs = F.array(
        F.struct(F.lit("clean_all_rows").alias("label"), F.col("a").alias("expected"), F.col("all_rows").alias("stored")),
        F.struct(F.lit("clean_en_rows").alias("label"), F.col("e").alias("expected"), F.col("en_rows").alias("stored")))
    return keyed.with_scalar(sums, stored).select(F.inline(pairs))


MUTES = [
    {"metric": "raw_rows", "until": "2024-02-01"}, {"metric": "clean_en_rows", "until": "2024-01-31"},
    {"metric": "duplicate_rate"}, {"metric": "empty_text_rate", "until": "whenever"}, {"metric": "drift", "until": "2030-01-01"},
]
_ALL_ALERTS = f"{QUALITY}, {DISTRIBUTION}, {FEATURES}, {HARD}, {DRIFT}, {RECONCILE}, found AS (SELECT * FROM hard UNION ALL SELECT * FROM drift UNION ALL SELECT * FROM reconcile)"


@query("m_mute", on_batches(_ALL_ALERTS, f"SELECT {_SHOWN} FROM found WHERE COALESCE(mute_key, '') NOT IN ('raw_rows', 'empty_text_rate')"))
def m_mute(spark, sf_dir):
    """One entry still valid, one run out, one without an end, one unreadable, one for an alert that cannot be muted."""
    q, d = histories(spark, sf_dir)
    found = monitor.alerts(q, d, CFG, store(q), monitor.mute_table(spark, MUTES), TODAY)
    return monitor.published(found).select(*_SHOWN_COLS)


_STATUS = """per AS (
  SELECT q.run_ts, COUNT(*) FILTER (WHERE level = 'ERROR') AS n_error, COUNT(*) FILTER (WHERE level = 'WARN') AS n_warn,
    COUNT(*) FILTER (WHERE level = 'INFO') AS n_info
  FROM quality q LEFT JOIN found f ON f.run_ts = q.run_ts GROUP BY q.run_ts
), status AS (
  SELECT *, CASE WHEN n_error > 0 THEN 'ERROR' WHEN n_warn > 0 THEN 'WARN' ELSE 'OK' END AS status,
    CASE WHEN n_error > 0 THEN 'hold back and investigate' WHEN n_warn > 0 THEN 'usable after review' ELSE 'all checks passed' END AS recommendation,
    CASE WHEN n_error > 0 THEN 1 ELSE 0 END AS exit_code FROM per
)"""


@query("m_overall_status", on_batches(f"{_ALL_ALERTS}, {_STATUS}", "SELECT 'reviews' AS dataset, * FROM status"))
def m_overall_status(spark, sf_dir):
    q, d = histories(spark, sf_dir)
    return monitor.alert_run(spark, q, d, new_path(spark, "alerts"), CFG, stored_counts=store(q))


@query("m_alert_store", on_batches(f"{QUALITY}, {HARD}, {RECONCILE}", f"""SELECT run_ts, level, metric, current, baseline_or_threshold, rule FROM (
  SELECT * EXCLUDE (mute_key) FROM hard UNION ALL SELECT * EXCLUDE (mute_key) FROM reconcile
  UNION ALL SELECT run_ts, 'WARN', 'config_file', NULL, NULL, 'parse_error' FROM quality
  UNION ALL SELECT run_ts, 'WARN', 'distribution_history', NULL, NULL, 'missing' FROM quality)"""))
def m_alert_store(spark, sf_dir):
    """Two runs into one store, the second without distribution history and configuration: it replaces the first."""
    rows = batch_rows(spark, sf_dir)
    q, folder = quality(spark, sf_dir, rows), new_path(spark, "alerts")
    monitor.alert_run(spark, q.withColumn("raw_rows", F.lit(0)), None, folder, CFG)
    monitor.alert_run(spark, q, None, folder, CFG, "parse_error", store(q))
    return monitor.stored_alerts(spark, folder, "date").select(*_SHOWN_COLS)


@query("m_report_snapshot", on_batches(f"{_ALL_ALERTS}, {_STATUS}", """SELECT 'reviews' AS dataset, q.run_ts, clean_en_rows, clean_all_rows,
  raw_rows, duplicate_rate, parseable_time_rate, english_rate_after_p0, d.en_share, s.status
  FROM quality q LEFT JOIN distribution d ON d.run_ts = q.run_ts JOIN status s ON s.run_ts = q.run_ts ORDER BY q.run_ts DESC LIMIT 1"""))
def m_report_snapshot(spark, sf_dir):
    q, d = histories(spark, sf_dir)
    return monitor.snapshot(q, d, monitor.overall_status(q, monitor.alerts(q, d, CFG, store(q))))


@query("m_input_guards", on_batches(QUALITY, """SELECT run_ts, 'WARN' AS level, 'config_file' AS metric, CAST(NULL AS DOUBLE) AS current,
    'missing' AS rule FROM quality
  UNION ALL SELECT run_ts, 'WARN', 'distribution_history', NULL, 'missing' FROM quality WHERE raw_rows % 2 = 1"""))
def m_input_guards(spark, sf_dir):
    """No configuration; batches with an odd row count have lost their distribution row."""
    q = quality(spark, sf_dir)
    return monitor.guard_alerts(spark, q, q.filter("raw_rows % 2 = 0"), "missing").select("run_ts", "level", "metric", "current", "rule")


def report_store(spark, sf_dir):
    """The reports of every batch, stored twice; the second time replaces the first."""
    flagged = settle(clean.flag_labelled(batch_rows(spark, sf_dir), ["run_ts"]), "flagged")
    found = reports.run_reports(flagged, settle(clean.clean_all(flagged, ["run_ts"]), "clean"))
    folder = new_path(spark, "reports")
    reports.store({"collection": found["collection"].withColumn("value", F.col("value") + 1)}, folder)
    reports.store(found, folder)
    return reports.stored(spark, folder, "date")


@query("m_quality_history_reports", on_batches(QUALITY, "SELECT 'reviews' AS dataset, run_ts, "
       + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in QUALITY_HISTORY_COLUMNS if c != "run_ts") + " FROM quality"))
def m_quality_history_reports(spark, sf_dir):
    return reports.quality_history(report_store(spark, sf_dir))


@query("m_distribution_history_reports", on_batches(DISTRIBUTION, "SELECT 'reviews' AS dataset, run_ts, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in _DIST_COLS if not c.startswith("last7d"))
       + """, CAST(NULLIF(volume, 0) AS DOUBLE) AS last7d_reviews_sum, round(NULLIF(volume, 0) / 7.0::DOUBLE, 6) AS last7d_daily_mean FROM shape"""))
def m_distribution_history_reports(spark, sf_dir):
    """A report's last days are its run's own: here the one day of the batch."""
    return reports.distribution_history(report_store(spark, sf_dir))


@query("set_config_overlay", on_batches(QUALITY, """SELECT run_ts, metric, baseline_or_threshold FROM (
  SELECT run_ts, 'raw_rows' AS metric, CAST(50 AS DOUBLE) AS baseline_or_threshold FROM quality WHERE raw_rows < 50
  UNION ALL SELECT run_ts, 'duplicate_rate', 0.02 FROM quality WHERE duplicate_rate > 0.02)"""))
def set_config_overlay(spark, sf_dir):
    """One user value over the defaults: raw_rows is judged by it, duplicate_rate by the default."""
    cfg = monitor.config({"thresholds": {"raw_rows_min": 50}})
    found = monitor.threshold_alerts(quality(spark, sf_dir), cfg)
    return found.filter(F.col("metric").isin("raw_rows", "duplicate_rate")).select("run_ts", "metric", "baseline_or_threshold")
