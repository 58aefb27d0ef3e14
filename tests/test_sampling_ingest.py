import pytest
from pyspark.sql import functions as F

from reviewpulse.operators import clean, ingest, sampling
from reviewpulse.sources import readers

from .conftest import as_dict


@pytest.fixture(scope="module")
def timed(spark):
    rows = [(app, f"{app}-{d}-{i}", f"2024-01-0{d} 0{i % 9}:00:00") for app in "ab" for d in (1, 2, 3) for i in range(d * 3 if app == "a" else 2)]
    rows.append(("a", "no-time", None))
    df = spark.createDataFrame(rows, "app_id string, review_id string, at string")
    return df.withColumn("at_parsed", F.col("at").cast("timestamp_ntz"))


def test_spike_rank_and_share(spark):
    """Published day counts: 2884 of 10169 rows are 28.36 percent."""
    rows = [("2026-04-18", 2884), ("2026-04-17", 1046), ("2026-04-15", 526), ("2026-01-01", 10169 - 2884 - 1046 - 526 - 300), ("2026-01-02", 150), ("2026-01-03", 150)]
    daily = spark.createDataFrame(rows, "d string, reviews long").select(F.to_date("d").alias("day"), "reviews")
    got = [(r["rank"], str(r.day), r.share_of_all_reviews_pct) for r in sampling.spike_days(daily, 5).orderBy("rank").collect()]
    assert got[0][1] == "2026-01-01" and got[1] == (2, "2026-04-18", 28.36) and got[2][2] == 10.29 and got[3][2] == 5.17
    assert [r[0] for r in got] == [1, 2, 3, 4, 5] and got[4][1] == "2026-01-02"


def test_cap_keeps_small_groups_and_is_repeatable(timed):
    rows = sampling.require_time(sampling.with_time(timed), True)
    one, two = (sampling.per_day_cap(rows, 4, seed=1) for _ in range(2))
    assert sorted(r.review_id for r in one.collect()) == sorted(r.review_id for r in two.collect())
    sizes = {(r.app_id, str(r.day)): r["count"] for r in one.groupBy("app_id", "day").count().collect()}
    assert sizes == {("a", "2024-01-01"): 3, ("a", "2024-01-02"): 4, ("a", "2024-01-03"): 4,
                     ("b", "2024-01-01"): 2, ("b", "2024-01-02"): 2, ("b", "2024-01-03"): 2}
    other = sampling.per_day_cap(rows, 4, seed=2)
    assert {r.review_id for r in one.collect()} != {r.review_id for r in other.collect()}


def test_split_is_a_partition_of_the_timed_rows(timed):
    rows = sampling.with_time(timed)
    train, val = sampling.time_split(rows, "2024-01-02")
    assert train.count() + val.count() == rows.filter("ts IS NOT NULL").count()
    assert train.agg(F.max("ts")).first()[0] < val.agg(F.min("ts")).first()[0]


def test_strict_mode_refuses_missing_times(timed):
    with pytest.raises(ValueError, match="1 rows"):
        sampling.require_time(sampling.with_time(timed), False)


def test_at_is_used_only_when_no_time_was_parsed(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", None)], "at string, at_parsed timestamp_ntz")
    assert str(sampling.with_time(rows).first().day) == "2024-01-01"
    mixed = rows.unionByName(rows.withColumn("at_parsed", F.col("at").cast("timestamp_ntz")))
    assert sorted(str(r.day) for r in sampling.with_time(mixed).collect()) == ["2024-01-01", "None"]


def test_excluding_days_keeps_rows_without_a_day(spark, timed):
    spikes = spark.createDataFrame([("2024-01-03",), ("junk",)], "d string").select(F.col("d").try_cast("date").alias("day"))
    left = sampling.exclude_days(sampling.with_time(timed), spikes)
    assert {str(r.day) for r in left.select("day").distinct().collect()} == {"None", "2024-01-01", "2024-01-02"}
    with pytest.raises(ValueError):
        sampling.exclude_days(timed, spikes.withColumnRenamed("day", "date"))


def test_manifest_adds_up(spark, timed):
    spikes = spark.createDataFrame([("2024-01-03",)], "d string").select(F.to_date("d").alias("day"))
    m = sampling.sampling_manifest(timed, spikes, 4, "2024-01-02").first()
    assert m.input_rows == 25 and m.dropped_missing_time == 1 and m.dropped_for_spike_days == 11
    assert m.rows_after_exclude_spikes == 13 and m.rows_after_per_day_cap == 11 and m.dropped_for_cap == 2
    assert m.train_rows == 5 and m.val_rows == 6 and list(m.excluded_spike_days) == ["2024-01-03"]


def test_manifest_tells_of_the_steps_that_ran(timed):
    spikes = sampling.spike_days(timed.groupBy(F.to_date("at_parsed").alias("day")).agg(F.count("*").alias("reviews")), 1)
    full = sampling.sampling_manifest(timed, spikes, 4, "2024-01-02").first()
    assert list(full.steps) == ["exclude_spikes", "per_day_cap", "time_split"] and full.outputs.asDict() == {"train": "train", "val": "val"}
    split = sampling.sampling_manifest(timed, cutoff="2024-01-02")
    assert {"per_day_cap", "excluded_spike_days"}.isdisjoint(split.columns) and list(split.first().steps) == ["time_split"]
    assert split.first().train_rows + split.first().val_rows == split.first().input_rows - 1
    capped = sampling.sampling_manifest(timed, cap=1, cutoff=None).first()
    assert (capped.rows_after_per_day_cap, capped.dropped_for_cap) == (6, 18) and capped.outputs.asDict() == {"single": "single"}
    days = sampling.sampling_manifest(timed, spikes).first()
    assert list(days.steps) == ["exclude_spikes"] and "split_cutoff" not in days and days.dropped_for_spike_days == 11
    with pytest.raises(ValueError, match="nothing to do"):
        sampling.sampling_manifest(timed)
    with pytest.raises(ValueError, match="1 rows"):
        sampling.sampling_manifest(timed, cap=1, drop_missing=False)


def test_nothing_to_do_is_an_error(timed):
    with pytest.raises(ValueError):
        sampling.sample(timed)


def test_app_plan_defaults(spark):
    df = spark.createDataFrame([(" a ", None, None), ("b", "B", 7), ("  ", "x", 1), (None, "y", 1)], "app_id string, app_name string, target_reviews int")
    assert sorted(map(tuple, readers.app_plan(df).collect())) == [("a", "a", 500), ("b", "B", 7)]
    bare = readers.app_plan(df.select("app_id"))
    assert sorted(map(tuple, bare.collect())) == [("a", "a", 500), ("b", "b", 500)]


def test_newest_rows_per_app(spark, raw):
    rows = clean.derive(raw([{"review_id": f"r{i}", "at": f"2024-01-{i + 1:02d} 00:00:00"} for i in range(9)] + [{"app_id": "z"}]))
    plan = readers.app_plan(spark.createDataFrame([("a", 3), ("gone", 5)], "app_id string, target_reviews int"))
    got = ingest.newest_n_per_app(rows, plan)
    assert {r.review_id: r.newest_rank for r in got.collect()} == {"r8": 1, "r7": 2, "r6": 3}
    counts = {r.app_id: (r.fetched, r.status) for r in ingest.per_app_counts(rows, plan).collect()}
    assert counts == {"a": (9, "fetched"), "gone": (0, "no rows")}


def test_raw_metrics(spark, raw):
    got = as_dict(ingest.raw_collection_metrics(raw([
        {"review_id": None, "reply_content": "thanks", "replied_at": "soon"}, {"review_id": None, "content": ""},
        {"reply_content": " ", "score": "x"}, {"content": "abcd", "app_id": None, "reply_content": "ok", "replied_at": "2024-01-01 00:00:00"},
    ])))
    assert len(got) == 14
    assert got["total_rows"] == 4 and got["unique_review_id_rows"] == 3 and got["duplicate_review_id_rows"] == 1
    assert got["missing_review_id_ratio"] == 0.5 and got["clean_rows"] == 2 and got["apps_count"] == 1
    assert got["has_dev_reply_ratio"] == 0.5 and got["parseable_replied_at_when_reply_ratio"] == 0.5
    assert got["duplicate_text_hash_rows"] == 1 and got["parseable_score_ratio"] == 0.75


def test_raw_metrics_of_an_empty_table(raw, spark):
    empty = raw([{}]).limit(0)
    assert [tuple(r) for r in ingest.raw_collection_metrics(empty).collect()] == [("total_rows", 0.0)]
