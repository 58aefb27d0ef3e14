import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewpulse.functions import stats
from reviewpulse.operators import clean, keyed, profile
from reviewpulse.sources import sinks

from .conftest import as_dict


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("a", "App a", s, n, f"r{i}{s}", i) for i, (s, n) in enumerate([(1.0, 5), (1.0, 9), (5.0, 7), (3.0, 100), (None, 4), (7.0, 2)])]
    rows += [("b", "App b", 9.0, 3, "x", 50), (None, "none", 5.0, 1, "y", 51)]
    return spark.createDataFrame(rows, "app_id string, app_name string, score double, content_len long, review_id string, ingest_seq long")


def test_published_star_counts_give_published_mean_and_skew(spark):
    """Known star counts of one app: 894, 72, 52, 20, 72 stars one to five give mean 1.47207..."""
    stars = [(float(s),) for s, n in enumerate([894, 72, 52, 20, 72], start=1) for _ in range(n)]
    df = spark.createDataFrame(stars, "score double").select(
        F.lit("x").alias("app_id"), F.lit("X").alias("app_name"), "score")
    assert profile.mean_score_by_app(df).first().mean_score == pytest.approx(1.4720720720720721)
    want = pd.Series([s[0] for s in stars]).skew()
    assert profile.score_skew_by_app(df).first().score_skew == pytest.approx(want)


def test_null_groups_are_dropped_and_odd_scores_keep_a_zero_row(scores):
    got = {r.app_id: [r[f"star_{k}"] for k in range(1, 6)] for r in profile.rating_counts_by_app(scores).collect()}
    assert got == {"a": [2, 0, 1, 0, 1], "b": [0] * 5}


def test_dense_ratings_fill_zero(scores):
    assert as_dict(profile.rating_distribution_dense(scores)) == {1.0: 2, 2.0: 0, 3.0: 1, 4.0: 0, 5.0: 2}


def test_length_summary_matches_pandas(spark, scores):
    lens = scores.toPandas()["content_len"]
    want = lens.describe(percentiles=[0.5, 0.9, 0.95])
    got = as_dict(profile.length_summary(scores))
    for k, v in got.items():
        assert v == pytest.approx(want[k])
    one = scores.limit(1)
    assert as_dict(profile.length_summary(one))["std"] is None


def test_histogram_matches_numpy(spark):
    # A prime range keeps every value off the bin edges, where floating point edges differ by an ulp.
    data = np.append(np.random.default_rng(1).integers(0, 500, 798), [0, 499])
    df = spark.createDataFrame([(int(x),) for x in data], "v long")
    rows = profile.histogram(stats.frequencies(df, "v"), 60).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=60)
    assert [r.rows for r in rows] == counts.tolist() and sum(r.rows for r in rows) == 800
    assert [r.bin_from for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = profile.histogram(stats.frequencies(df.select(F.lit(3).alias("v")), "v"), 4).collect()
    assert sum(r.rows for r in flat) == 800 and min(r.bin_from for r in flat) == 2.5
    assert profile.histogram(stats.frequencies(df.limit(0), "v"), 4).count() == 0


def test_box_whiskers_leave_outliers_out(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, v double")
    r = profile.box_summary(df, "v", "g").first()
    assert (r.n, r.q1, r["median"], r.q3, r.whisker_low, r.whisker_high) == (6, 2.25, 3.5, 4.75, 1.0, 5.0)


def test_top_texts_show_the_first_content(spark):
    df = spark.createDataFrame([("h1", "B", 5), ("h1", "A", 2), ("h2", "C", 1), ("h1", "D", 9)], "text_hash string, content string, ingest_seq long")
    got = profile.top_duplicate_texts(df, 1).collect()
    assert [(r.text_hash, r.duplicate_count, r.content) for r in got] == [("h1", 3, "A")]


def test_language_tail_row(spark):
    df = spark.createDataFrame([(c,) for c in ["en"] * 5 + ["fr"] * 3 + ["zz"] + [" de "] + [None]], "detected_lang string")
    counts = profile.language_counts(df)
    assert as_dict(counts.select("detected_lang_code", "count")) == {"en": 5, "fr": 3, "zz": 1, "de": 1, "unknown": 1}
    top = profile.language_top_and_other(counts, 2)
    assert as_dict(top.select("language", "count")) == {"English": 5, "French": 3, "Other (remaining languages)": 3}
    assert profile.language_top_and_other(counts, 15).filter("language LIKE 'Other (rem%'").count() == 0


def test_words_skip_stop_words_and_align_bands(spark):
    df = spark.createDataFrame([("the app crashed badly", 1.0), ("love it love", 5.0), ("badly", 5.0), ("meh", 3.0)], "content_clean string, score double")
    assert as_dict(profile.top_words(df)) == {"badly": 2, "love": 2, "crashed": 1, "meh": 1}
    got = {r.token: (r.low_star_1_2, r.high_star_5) for r in profile.top_words_low_vs_high(df).collect()}
    assert got == {"badly": (1, 1), "crashed": (1, None), "love": (None, 2)}


def test_flag_helpers(spark):
    df = spark.createDataFrame([(True, 1), (None, 2), (True, 3)], "f boolean, ingest_seq long")
    assert as_dict(profile.flag_counts(df, "f")) == {False: 1, True: 2}
    assert [r.ingest_seq for r in profile.first_flag_rows(df, "f", ["ingest_seq", "missing"], 1).collect()] == [1]
    assert profile.flag_mean(df, "f", "m").first().value == pytest.approx(2 / 3)
    assert as_dict(profile.quality_flag_rates(df)) == {"noise_rate": None, "has_dev_reply_rate": None}


def test_scale_chain_shows_null_for_an_empty_stage(spark, scores):
    got = as_dict(profile.scale_chain(scores.limit(0), scores, scores.limit(0)))
    assert got == {"raw": None, "after_P0_all_languages": 8, "after_P0_english_only": 0}


def test_daily_note_when_no_time(spark):
    df = spark.createDataFrame([(None,)], "at_parsed timestamp_ntz")
    assert "note" in profile.daily_volume_or_note(df).columns


def test_union_of_frames(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("y", F.lit(2))
    assert profile.union_frames([a, b]).columns == ["id", "x", "y"]
    assert profile.union_frames([]) is None


def test_report_bundle_orders_rows_and_tolerates_missing_tables(spark, scores):
    table = profile.rating_distribution(scores)
    part = sinks.report_rows(table, "A", "A1", "a1", keyed.with_row_numbers(table, ["score"], "row_no"))
    rows = sinks.report_bundle([part, None]).orderBy("row_no").collect()
    assert [r.row_no for r in rows] == [1, 2, 3, 4, 5, 6][:len(rows)]
    assert rows[0].payload == '{"score":"1.000000","count":"2"}'
    with pytest.raises(ValueError):
        sinks.report_bundle([None])


def test_row_numbers_in_range_parts(spark):
    rows = spark.range(5000).select(F.pmod(F.col("id") * 7919, F.lit(5000)).alias("k"), F.lit("x").alias("v"))
    got = keyed.with_row_numbers(rows, [F.desc("k")], "row_no")
    assert sorted((r.row_no, r.k) for r in got.collect()) == [(i + 1, 4999 - i) for i in range(5000)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number()" in plan and "[range_part" in plan
    assert keyed.with_row_numbers(rows.limit(0), ["k"], "row_no").count() == 0
