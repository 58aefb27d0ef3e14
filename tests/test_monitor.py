from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewpulse.functions import fixed_values as V
from reviewpulse.operators import monitor, reports
from reviewpulse.sources.shared import new_path

Q = ("dataset string, run_ts string, raw_rows double, apps_count double, duplicate_rate double, empty_text_rate double, short_text_rate_lt5 double, "
     "parseable_time_rate double, parseable_score_rate double, english_rate_after_p0 double, missing_key_fields_rate double, clean_all_rows long, clean_en_rows long")
GOOD = dict(dataset="d", run_ts="2024-01-01", raw_rows=5000.0, apps_count=12.0, duplicate_rate=0.02, empty_text_rate=0.01, short_text_rate_lt5=0.3,
            parseable_time_rate=0.99, parseable_score_rate=0.99, english_rate_after_p0=0.5, missing_key_fields_rate=0.005, clean_all_rows=9000, clean_en_rows=8000)
D = "dataset string, run_ts string, score_1_pct double, score_2_pct double, score_3_pct double, score_4_pct double, score_5_pct double, len_mean double, en_share double, last7d_daily_mean double"
CFG = monitor.config()


def quality(spark, **over):
    row = {**GOOD, **over}
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in Q.split(", "))], Q)


def dist(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(dataset="d", run_ts=f"2024-01-{i + 1:02d}", score_1_pct=.2, score_2_pct=.2, score_3_pct=.2, score_4_pct=.2, score_5_pct=.2,
                    len_mean=100.0 + i % 2, en_share=0.8, last7d_daily_mean=10.0)
        base.update(r)
        full.append(tuple(base[c.split()[0]] for c in D.split(", ")))
    return spark.createDataFrame(full, D)


def rules(df):
    return sorted((r.run_ts[-2:], r.metric, r.rule, r.level) for r in df.collect())


def test_limits_are_strict(spark):
    assert monitor.threshold_alerts(quality(spark), CFG).count() == 0


@pytest.mark.parametrize("metric,value,level", [
    ("raw_rows", 4999.0, "ERROR"), ("apps_count", 11.0, "ERROR"), ("duplicate_rate", 0.0201, "ERROR"), ("empty_text_rate", 0.02, "ERROR"),
    ("parseable_time_rate", 0.98, "ERROR"), ("parseable_score_rate", 0.98, "ERROR"), ("english_rate_after_p0", 0.49, "ERROR"),
    ("clean_en_rows", 7999, "ERROR"), ("missing_key_fields_rate", 0.006, "ERROR"), ("short_text_rate_lt5", 0.31, "WARN")])
def test_each_hard_rule(spark, metric, value, level):
    got = monitor.threshold_alerts(quality(spark, **{metric: value}), CFG).collect()
    assert [(r.metric, r.level) for r in got] == [(metric, level)]


def test_null_metrics_warn_or_are_skipped(spark):
    got = monitor.threshold_alerts(quality(spark, raw_rows=None, apps_count=None, empty_text_rate=None), CFG).collect()
    assert [(r.metric, r.rule, r.level) for r in got] == [("raw_rows", "missing_value", "WARN")]
    no_expectation = monitor.config({"expected": {"apps_count": 0}})
    assert monitor.threshold_alerts(quality(spark, apps_count=1.0), no_expectation).count() == 0


def test_reconcile_cases(spark):
    store = "dataset string, run_ts string, stored_rows long, data_subset string, source_rows long"

    def run(*row, **over):
        rows = [("d", "2024-01-01", *row)] if row else []
        found = monitor.reconcile_alerts(quality(spark, **over), spark.createDataFrame(rows, store)).collect()
        return [(r.level, r.rule, r.metric) for r in found]

    count, meta = V.STORED_COUNT_METRIC, V.STORED_META_METRIC
    assert run() == [("WARN", "missing", count)]
    assert run(8000, "clean_en_only", 8000) == []
    assert run(9000, "clean_all_languages", None) == []
    assert run(8000, "clean_all_languages", 8000) == [("ERROR", "eq", count)]
    assert run(8000, "clean_en_only", 7) == [("WARN", "mismatch", meta)]
    assert run(8000, "custom", 7) == [("INFO", "unknown_subset", count)]
    assert run(8000, None, 7) == [("INFO", "unknown_subset", count)]
    assert run(8000, "clean_en_only", 8000, clean_en_rows=None) == [("WARN", "missing", count)]


def test_cold_start_and_quiet_history(spark):
    found = monitor.drift_alerts(dist(spark, [{}] * 7), CFG)
    assert {r[1] for r in rules(found)} == {"drift"} and found.count() == 5


def test_drift_rules_fire(spark):
    last = {"score_1_pct": .9, "score_2_pct": .025, "score_3_pct": .025, "score_4_pct": .025, "score_5_pct": .025,
            "len_mean": 500.0, "en_share": 0.6, "last7d_daily_mean": 30.0}
    found = monitor.drift_alerts(dist(spark, [{}] * 5 + [last]), CFG).filter("rule <> 'cold_start'")
    assert [r[1:] for r in rules(found)] == [
        ("en_share_drop", "threshold_min", "WARN"), ("last7d_daily_mean", "spike_ratio", "WARN"),
        ("len_mean_zscore", "zscore_max", "WARN"), ("score_dist_psi", "psi_max", "WARN")]
    p, q = np.array([.9] + [.025] * 4), np.array([.2] * 5)
    psi = found.filter("metric = 'score_dist_psi'").first()
    assert psi.current == pytest.approx(float(np.sum((p - q) * np.log(p / q)))) and psi.baseline_or_threshold == 0.2
    lens = np.array([100., 101., 100., 101., 100.])
    z = found.filter("metric = 'len_mean_zscore'").first()
    assert z.current == pytest.approx(abs(500 - lens.mean()) / lens.std())
    vol = found.filter("metric = 'last7d_daily_mean'").first()
    assert (vol.current, vol.baseline_or_threshold) == (30.0, 20.0)


def test_incomplete_shares_and_flat_lengths(spark):
    now = monitor.drift_alerts(dist(spark, [{"len_mean": 100.0}] * 5 + [{"score_3_pct": None, "len_mean": 900.0}]), CFG)
    assert rules(now.filter("rule <> 'cold_start'")) == [("06", "score_dist_psi", "missing", "WARN")]
    empty = [{f"score_{k}_pct": None for k in range(1, 6)}] * 5 + [{}]
    assert rules(monitor.drift_alerts(dist(spark, empty), CFG).filter("rule <> 'cold_start'")) == [("06", "score_dist_psi", "missing", "WARN")]
    star_missing = [{"score_1_pct": 0.0, "score_5_pct": 0.4}] * 6
    assert monitor.drift_alerts(dist(spark, star_missing), CFG).filter("rule <> 'cold_start'").count() == 0


def test_mutes(spark):
    found = monitor.threshold_alerts(quality(spark, raw_rows=1.0, clean_en_rows=1, duplicate_rate=1.0, empty_text_rate=1.0), CFG)
    mutes = monitor.mute_table(spark, [{"metric": "raw_rows", "until": "2024-02-01"}, {"metric": "clean_en_rows", "until": "2024-01-31"},
                                       {"metric": "duplicate_rate"}, {"metric": "empty_text_rate", "until": "soon"}])
    left = monitor.apply_mutes(found, mutes, "2024-02-01")
    assert sorted(r.metric for r in left.collect()) == ["clean_en_rows", "duplicate_rate"]
    cold = monitor.drift_alerts(dist(spark, [{}]), CFG)
    assert monitor.apply_mutes(cold, monitor.mute_table(spark, [{"metric": "drift", "until": "2099-01-01"}]), "2024-02-01").count() == 1


def test_status_counts_every_batch(spark):
    batches = quality(spark).unionByName(quality(spark, run_ts="2024-01-02", raw_rows=1.0)).unionByName(
        quality(spark, run_ts="2024-01-03", short_text_rate_lt5=0.9))
    status = monitor.overall_status(batches, monitor.alerts(batches, None, CFG))
    got = {r.run_ts: (r.status, r.n_error, r.n_warn, r.exit_code) for r in status.collect()}
    assert got == {"2024-01-01": ("OK", 0, 0, 0), "2024-01-02": ("ERROR", 1, 0, 1), "2024-01-03": ("WARN", 0, 1, 0)}
    with pytest.raises(RuntimeError):
        monitor.fail_on_error(status)
    monitor.fail_on_error(status.filter("status <> 'ERROR'"))


def test_guards(spark):
    def metrics(*args):
        return [(r.metric, r.rule) for r in monitor.guard_alerts(spark, *args).collect()]

    q, d = quality(spark), dist(spark, [{}])
    assert metrics(None, d) == [("data_quality_history", "missing")]
    assert metrics(q.limit(0), d) == [("data_quality_history", "empty")]
    assert metrics(q, None) == [("distribution_history", "missing")]
    assert metrics(q, d, "parse_error") == [("config_file", "parse_error")]
    assert metrics(q, d) == []


def test_guards_belong_to_batches(spark):
    two = quality(spark).unionByName(quality(spark, run_ts="2024-01-02"))
    found = monitor.guard_alerts(spark, two, dist(spark, [{}]), "missing")
    assert sorted((r.run_ts, r.metric) for r in found.collect()) == [
        ("2024-01-01", "config_file"), ("2024-01-02", "config_file"), ("2024-01-02", "distribution_history")]
    alone = monitor.guard_alerts(spark, two.limit(0), None, "missing", "2024-02-01")
    assert sorted((r.run_ts, r.metric, r.rule) for r in alone.collect()) == [
        ("2024-02-01", "config_file", "missing"), ("2024-02-01", "data_quality_history", "empty")]


def test_alert_runs_replace_their_batches(spark):
    folder = new_path(spark, "alerts")
    two = quality(spark, raw_rows=1.0).unionByName(quality(spark, run_ts="2024-01-02 10:00:00 UTC"))

    def run(q, d):
        status = {r.run_ts: r.status for r in monitor.alert_run(spark, q, d, folder, CFG, run_ts="2024-03-01").collect()}
        return status, sorted((r.run_ts, r.metric) for r in monitor.stored_alerts(spark, folder).collect())

    lost = [("2024-01-01", "distribution_history"), ("2024-01-01", "raw_rows"), ("2024-01-02 10:00:00 UTC", "distribution_history")]
    assert run(two, None) == run(two, None) == ({"2024-01-01": "ERROR", "2024-01-02 10:00:00 UTC": "WARN"}, lost)
    # A clean second run of one batch takes its alerts away and leaves the other batch alone.
    full = dist(spark, [{}]).withColumn("run_ts", F.lit("2024-01-02 10:00:00 UTC"))
    status, stored = run(two.filter("raw_rows > 1"), full)
    assert status == {"2024-01-02 10:00:00 UTC": "OK"} and stored == [*lost[:2], ("2024-01-02 10:00:00 UTC", "drift")]
    # Without a quality history only the guards speak.
    assert run(None, None)[0] == {"2024-03-01": "WARN"} == run(two.limit(0), None)[0]
    assert [r.rule for r in monitor.stored_alerts(spark, folder).filter("run_ts = '2024-03-01'").collect()] == ["empty"]


DAILY = "dataset string, run_ts string, day string, reviews long"


def test_last_seven_present_days(spark):
    days = [(f"2024-01-{i + 1:02d}", v) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 0, 9])]
    rows = [("d", d, d if v else None, v) for d, v in days]
    got = [(r.last7d_reviews_sum, round(r.last7d_daily_mean, 6)) for r in
           monitor.last_seven(spark.createDataFrame(rows, DAILY)).orderBy("run_ts").collect()]
    assert got[0] == (1.0, round(1 / 7, 6)) and got[7] == (35.0, 5.0) and got[8] == got[7] and got[9] == (42.0, 6.0)


def test_last_seven_counts_days_not_batches(spark):
    """A batch of ten days sums up its last seven; the next one goes on with its own day."""
    rows = [("d", "b1", f"2024-01-{i:02d}", i) for i in range(1, 11)] + [("d", "b2", "2024-01-11", 50), ("d", "b3", None, 0)]
    got = {r.run_ts: r.last7d_reviews_sum for r in monitor.last_seven(spark.createDataFrame(rows, DAILY)).collect()}
    assert got == {"b1": 49.0, "b2": 95.0, "b3": 95.0}


def test_published_last_week_sum(spark):
    """Seven published day counts add up to 5550."""
    rows = [("d", f"2026-04-{13 + i}", f"2026-04-{13 + i}", v) for i, v in enumerate([121, 305, 526, 484, 1046, 2884, 184])]
    last = monitor.last_seven(spark.createDataFrame(rows, DAILY)).orderBy(F.desc("run_ts")).first()
    assert last.last7d_reviews_sum == 5550.0


def test_history_from_stored_reports_prefers_collection_counts(spark):
    report = spark.createDataFrame([("raw_rows", 10.0), ("duplicate_rate", 0.1)], "metric string, value double")
    raw = spark.createDataFrame([("total_rows", 12.0), ("apps_count", 3.0)], "metric string, value double")
    one = monitor.quality_history_from_reports(report, raw, "t").first()
    assert (one.raw_rows, one.apps_count, one.duplicate_rate, one.clean_en_rows) == (12.0, 3.0, 0.1, None)
    assert monitor.quality_history_from_reports(report, raw.limit(0), "t").first().raw_rows == 10.0


def test_histories_from_the_reports_of_many_runs(spark):
    def table(kind, rows):
        layout = "dataset string, run_ts string, " + reports.LAYOUTS[kind]
        return spark.createDataFrame([("d", *r) for r in rows], layout)

    some = {
        "quality": table("quality", [("a", "p0", "raw_rows", 10.0), ("a", "p0", "duplicate_rate", 0.1), ("a", "p1", "duplicate_rate", 0.7),
                                     ("b", "output", "clean_en_rows", float("nan")), ("b", "p0", "raw_rows", 3.0)]),
        "collection": table("collection", [("a", "total_rows", 12.0), ("c", "apps_count", 2.0)]),
        "ratings": table("ratings", [("a", 1.0, 3.0), ("a", 5.0, 5.0), ("a", 9.0, 2.0), ("b", 2.0, 0.0)]),
        "lengths": table("lengths", [("a", " mean ", 7.5), ("a", "50%", 6.0), ("a", "max", 99.0)]),
        "english": table("english", [("a", reports.ENGLISH_SHARE, 0.25), ("a", "other", 9.0)]),
    }
    days = [("a", date(2024, 1, i), float(i)) for i in range(1, 10)] + [("a", None, 100.0), ("c", date(2024, 1, 1), 4.0)]
    folder = new_path(spark, "reports")
    reports.store(some, folder)
    reports.store({"daily": table("daily", days)}, folder)
    reports.store({"collection": table("collection", [("a", "total_rows", 11.0)])}, folder)
    back = reports.stored(spark, folder)
    q = {r.run_ts: r for r in reports.quality_history(back).collect()}
    assert sorted(q) == ["a", "b", "c"] and (q["a"].raw_rows, q["a"].duplicate_rate, q["b"].raw_rows) == (11.0, 0.1, 3.0)
    assert q["b"].clean_en_rows is None and (q["c"].raw_rows, q["c"].apps_count) == (None, 2.0)
    d = {r.run_ts: r for r in reports.distribution_history(back).collect()}
    assert (d["a"].score_1_pct, d["a"].score_2_pct, d["a"].score_5_pct) == (0.3, 0.0, 0.5) and d["b"].score_2_pct is None
    assert (d["a"].len_mean, d["a"].len_p50, d["a"].len_p90, d["a"].en_share) == (7.5, 6.0, None, 0.25)
    assert d["a"].last7d_reviews_sum == sum(range(3, 10)) and d["a"].last7d_daily_mean == 6.0 and d["c"].last7d_reviews_sum == 4.0
    assert reports.quality_history(reports.stored(spark, new_path(spark, "none"))).count() == 0


def test_latest_goes_by_time_not_position(spark):
    rows = quality(spark, run_ts="2024-01-09").unionByName(quality(spark, run_ts="2024-01-02"))
    assert monitor.latest(rows).first().run_ts == "2024-01-09"
