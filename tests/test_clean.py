"""Clean step against a plain pandas rendering of the rules, and its skew-safe join paths."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewpulse.operators import clean, keyed
from reviewpulse.sources.reviews import raw_reviews

from .conftest import as_dict

SF = "/root/testdata/sf0.001"
FLAGS = ["hourly_count", "is_time_anomaly", "is_spam_bot_suspect"]


def brute_flags(rows: pd.DataFrame) -> pd.DataFrame:
    hours = rows.dropna(subset=["hour_bucket"]).groupby("hour_bucket").size()
    limit = hours.quantile(0.95) if len(hours) else 0
    count = rows["hour_bucket"].map(hours).fillna(0)
    copies = rows.groupby("text_hash")["text_hash"].transform("count")
    out = rows[["ingest_seq"]].copy()
    out["hourly_count"] = count.astype(int)
    out["is_time_anomaly"] = count >= limit
    out["is_spam_bot_suspect"] = (copies >= 3) | ((rows.content_len <= 6) & (rows.thumbs_up_count == 0)) | out.is_time_anomaly
    return out.sort_values("ingest_seq").reset_index(drop=True)


@pytest.mark.parametrize("broadcast_rows", [keyed.BROADCAST_ROWS, 0])
def test_flags_match_brute_force_on_both_join_paths(spark, broadcast_rows):
    raw = raw_reviews(spark, SF)
    got = clean.flag_reviews(raw, broadcast_rows=broadcast_rows).select("ingest_seq", *FLAGS).toPandas()
    rows = clean.label(raw).select("ingest_seq", "hour_bucket", "text_hash", "content_len", "thumbs_up_count").toPandas()
    got = got.sort_values("ingest_seq").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, brute_flags(rows), check_dtype=False)


def test_hot_key_is_not_sent_to_one_task(spark):
    """Half of the rows share one key: the fallback join serves it by broadcast and spreads the rows."""
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        F.col("id").alias("ingest_seq"))
    facts = rows.groupBy("k").agg(F.count("*").alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = keyed.attach_facts(rows, facts, ["k"], "n", "ingest_seq", broadcast_rows=0)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20000 and max(sizes) < 8000
        wrong = out.join(facts.withColumnRenamed("n", "want"), "k").filter(~F.col("n").eqNullSafe(F.col("want")))
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_are_flagged_on_their_own(spark):
    raw = raw_reviews(spark, SF).withColumn("run_ts", F.col("ingest_date"))
    together = clean.flag_reviews(raw, ["run_ts"]).select("run_ts", "ingest_seq", *FLAGS)
    day = raw.agg(F.min("run_ts")).first()[0]
    alone = clean.flag_reviews(raw.filter(F.col("run_ts") == F.lit(day))).select("run_ts", "ingest_seq", *FLAGS)
    assert sorted(together.filter(F.col("run_ts") == F.lit(day)).collect()) == sorted(alone.collect())


def test_without_times_everything_is_anomalous(spark, raw):
    rows = clean.flag_reviews(raw([{"at": "x"}, {"at": None}, {"content": "other words"}, ][:2])).collect()
    assert all(r.is_time_anomaly and r.hourly_count == 0 for r in rows)


def test_first_arrival_wins_and_null_ids_collapse(spark, raw):
    rows = raw([
        {"review_id": "x", "content": "second of all", "ingest_seq": 5}, {"review_id": "x", "content": "first of all", "ingest_seq": 2},
        {"review_id": None, "ingest_seq": 7}, {"review_id": None, "ingest_seq": 6}, {"review_id": "nan", "ingest_seq": 1},
    ])
    once = clean.dedupe_first(clean.label(rows))
    assert as_dict(once.select("review_id", "ingest_seq")) == {"x": 2, "nan": 1}
    assert once.count() == clean.dedupe_first(once).count()


def test_group_limit_precedes_the_shuffle(spark, raw):
    plan = keyed.first_per_key(clean.label(raw([{}])), ["review_id"], ["ingest_seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_missing_key_fields_and_kept_rows(spark, raw):
    rows = clean.clean_all(clean.label(raw([
        {"score": None}, {"at": "bad"}, {"content": None}, {"content": "abcd"}, {"content": " abcde "}, {"score": "junk"},
    ])))
    got = {r.review_id: r.is_missing_key_fields for r in rows.collect()}
    assert got == {"r0": True, "r1": True, "r4": False, "r5": True}


def test_url_only_review_is_noise_but_kept(spark, raw):
    row = clean.clean_all(clean.label(raw([{"content": "http://only.url/x"}]))).first()
    assert row.is_noise and row.content_clean == "" and row.detected_lang == "unknown"


def test_null_score_is_never_inconsistent(spark, raw):
    rows = clean.label(raw([{"score": None, "content": "good app"}, {"score": "1", "content": "good app"},
                            {"score": "5", "content": "bad app"}, {"score": "3", "content": "bad app"}])).collect()
    assert [r.is_inconsistent_rating for r in rows] == [False, True, True, False]


def test_quality_report_rows(spark, raw):
    flagged = clean.flag_reviews(raw([{}, {"ingest_seq": 9, "review_id": "r0"}, {"content": ""}, {"declared_lang": "fr"}]))
    report = clean.quality_report(flagged, "now", "test")
    got = {r.metric: r.value for r in report.collect()}
    assert report.count() == 16
    assert got["raw_rows"] == 4 and got["duplicate_rate"] == 0.25 and got["empty_text_rate"] == 0.25
    assert got["clean_all_rows"] == 2 and got["clean_en_rows"] == 1 and got["english_rate_after_p0"] == 0.5
    assert got["run_time"] is None


def test_collected_reply_flag_passes_through(spark, raw):
    rows = raw([{"reply_content": "thanks"}]).withColumn("has_dev_reply", F.lit(False))
    assert clean.derive(rows).first().has_dev_reply is False


def test_top_n_per_key_is_exact_and_limited_before_the_shuffle(spark):
    rows = spark.range(0, 6000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 9).alias("k"), F.xxhash64("id").alias("v"), "id")
    top = keyed.top_n_per_key(rows, ["k"], [F.desc("v")], 7)
    pdf = rows.toPandas().sort_values("v", ascending=False).groupby("k").head(7)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Exchange") == 2
    assert sorted(r.id for r in top.collect()) == sorted(pdf["id"])
    many = keyed.top_n_per_key(rows, ["k"], [F.desc("v")], 1500)
    want = rows.toPandas().sort_values("v", ascending=False).groupby("k").head(1500)
    assert sorted(r.id for r in many.collect()) == sorted(want["id"])


def test_wide_rows_are_ranked_by_their_ids_alone(spark):
    """Beyond a thousand rows per key: ids are ranked, texts join the winners."""
    rows = spark.range(6000).select(F.col("id"), (F.col("id") % 3).alias("k"), F.concat(F.lit("text "), F.col("id")).alias("content"))
    top = keyed.top_n_per_key(rows, ["k"], [F.desc("id")], 1200, "id")
    assert top.count() == 3600 and top.agg(F.min("id")).first()[0] == 6000 - 3600
    assert top.filter(F.col("content") != F.concat(F.lit("text "), F.col("id"))).count() == 0
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window"):]
    assert "content" not in ranked


def test_every_document_is_a_whole_review(spark):
    """Edge cases are additional rows: no document's text is cut or replaced."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = raw_reviews(spark, SF).filter("ingest_seq < 1000000000")
    both = docs.join(whole, F.col("doc_id") == F.col("ingest_seq"), "full_outer")
    assert both.filter(~F.col("text").eqNullSafe(F.col("content"))).count() == 0
    assert whole.agg(F.sum(F.length("content"))).first()[0] == docs.agg(F.sum(F.length("text"))).first()[0]
