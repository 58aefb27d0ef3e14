"""Texts of the review table take part in one join, however large events and conversations are."""

from pyspark.sql import functions as F

from reviewpulse.sources import reviews

SF = "/root/testdata/sf0.001"


def test_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reviews.raw_reviews(spark, SF)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [p for p in plan.split("\n\n") if ") Exchange" in p and "lang#" in p and "RoundRobin" not in p and "REPARTITION" not in p]
    assert len(moved) <= 1


def test_a_document_keeps_all_its_facts(spark, tmp_path):
    """Neither, one or both of event and answer; two events of one id give two rows."""
    spark.createDataFrame([(i, f"text {i}", "en", "a", 6) for i in (1, 2, 3, 4)], reviews.LAYOUTS["documents"]).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, 7), (10, 8), (10, 9), (11, 1), (None, 1)], "event_id long, user_id long").select(
        "event_id", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"), "user_id", F.lit("x").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(1, 1, "assistant", "one"), (1, 0, "user", "no"), (3, 2, "assistant", "late"), (3, 1, "assistant", "three"),
                           (9, 1, "assistant", "nobody"), (None, 1, "assistant", "null")],
                          reviews.LAYOUTS["conversations"]).write.parquet(str(tmp_path / "conversations.parquet"))
    got = reviews.raw_reviews(spark, str(tmp_path)).select("review_id", "score", "at", "reply_content").collect()
    assert sorted((r[0], r[1], r[2] is not None, r[3]) for r in got) == sorted(
        [("1", "5", True, "one"), ("2", "3", True, None), ("2", "4", True, None), ("3", None, False, "three"), ("4", None, False, None)],
        key=lambda r: (r[0], r[1] or ""))


def test_warehouse_load_writes_no_copy_of_the_clean_table(spark, monkeypatch):
    from reviewpulse.plans import source_queries

    monkeypatch.setattr(source_queries.sinks, "overwrite", None)
    sizes = {r.tbl: r.n for r in source_queries.warehouse_load(spark, SF).collect()}
    assert sizes["reviews"] > sizes["en_reviews"] > 0 and sizes["ingestion_meta"] == 5
