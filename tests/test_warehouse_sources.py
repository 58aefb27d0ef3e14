import pytest
from pyspark.sql import functions as F

from reviewpulse.operators import clean, ingest, warehouse
from reviewpulse.sources import readers, shared, sinks
from reviewpulse.sources.schemas import RAW_COLUMNS

from .conftest import as_dict


@pytest.fixture
def flagged(raw):
    return clean.clean_all(clean.flag_reviews(raw([
        {}, {"app_id": "b", "app_name": "First", "ingest_seq": 1}, {"app_id": "b", "app_name": "Later", "ingest_seq": 2},
        {"declared_lang": "fr", "at": "bad"},
    ])))


def test_load_and_checks(spark, flagged):
    folder = shared.new_path(spark, "wh")
    warehouse.load(flagged, "clean_all_languages", folder, "2024-01-01T00:00:00Z")
    loaded = warehouse.load(flagged, "clean_all_languages", folder, "2024-01-01T00:00:00Z")
    assert loaded["reviews"].count() == 4
    assert as_dict(loaded["apps"]) == {"a": "App a", "b": "First"}
    assert as_dict(loaded["ingestion_meta"]) == {
        "source_file": "clean_all_languages", "data_subset": "clean_all_languages", "source_rows": "4", "app_count": "2",
        "loaded_at_utc": "2024-01-01T00:00:00Z"}
    row = loaded["reviews"].filter("review_id = 'r3'").first()
    assert row.is_en == 0 and row.at_parsed is None and "app_name" not in loaded["reviews"].columns
    assert as_dict(warehouse.check(loaded, "v_row_counts")) == {"apps": 2, "reviews": 4}
    assert as_dict(warehouse.check(loaded, "v_english_dist")) == {0: 1, 1: 3}
    assert warehouse.check(loaded, "v_null_keys").first()[0] == 0
    for name in warehouse.CHECKS:
        assert warehouse.check(loaded, name).count() > 0


def test_violations_stop_the_load(spark, flagged):
    doubled = flagged.unionByName(flagged)
    with pytest.raises(ValueError, match="primary_key"):
        warehouse.load(doubled, "x", shared.new_path(spark, "wh"))
    with pytest.raises(ValueError, match="not_null"):
        warehouse.load(flagged.withColumn("is_en", F.lit(None).cast("boolean")), "x", shared.new_path(spark, "wh"))


def test_failed_load_leaves_the_old_version(spark, flagged):
    folder = shared.new_path(spark, "wh")
    assert warehouse.current(spark, folder) is None
    warehouse.load(flagged, "first", folder)
    with pytest.raises(ValueError, match="primary_key"):
        warehouse.load(flagged.unionByName(flagged), "second", folder)
    assert as_dict(warehouse.current(spark, folder)["ingestion_meta"])["source_file"] == "first"
    assert warehouse.current(spark, folder)["reviews"].count() == 4
    warehouse.load(flagged.filter("app_id = 'b'"), "third", folder)
    newest = warehouse.current(spark, folder)
    assert as_dict(newest["apps"]) == {"b": "First"} and newest["reviews"].count() == 2
    got = [(r.version, r.source, r.review_rows, r.app_rows) for r in warehouse.versions(spark, folder).orderBy("version").collect()]
    assert got == [(1, "first", 4, 2), (2, "third", 2, 1)]


def test_load_computes_the_clean_rows_once(spark, flagged):
    rows = shared.settle(flagged, "rows")
    passed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        passed.add(1)
        return text

    loaded = warehouse.load(rows.withColumn("content", counted("content")), "x", shared.new_path(spark, "wh"))
    assert passed.value == 4 and loaded["reviews"].count() == 4


def test_observed_nulls(spark, flagged):
    gaps = flagged.withColumn("is_noise", F.when(F.col("review_id") != "r1", F.col("is_noise")))
    loaded, observed = warehouse.stage(gaps, "x", shared.new_path(spark, "wh"))
    assert observed["reviews"]["rows"] == 4 and observed["reviews"]["null_is_noise"] == 1 and observed["apps"] == {
        "rows": 2, "null_app_id": 0, "null_app_name": 0}
    seen = sorted(map(tuple, warehouse.key_violations(loaded).unionByName(warehouse.null_violations(spark, observed)).collect()))
    assert seen == sorted(map(tuple, warehouse.constraint_violations(loaded).collect()))
    assert "app_name" not in loaded["reviews"].columns


def test_orphans_are_counted_in_rows(spark, flagged):
    built = warehouse.tables(flagged, "x")
    built["apps"] = built["apps"].filter("app_id = 'a'")
    got = {(r.table_name, r.rule): r.violations for r in warehouse.constraint_violations(built).filter("violations > 0").collect()}
    assert got == {("reviews", "foreign_key"): 2}


@pytest.mark.parametrize("source,label", [("x/clean_en_only.csv", "clean_en_only"), ("clean_all_languages", "clean_all_languages"), ("other", "custom")])
def test_subset_label(source, label):
    assert warehouse.subset_label(source) == label


def test_csv_round_trip_keeps_text(spark, raw):
    texts = ['say "hi", now', "two\nlines\n\n", "  padded\t", "NA", "None", "", None, "comma, \\ back", "é日本😀"]
    path = shared.new_path(spark, "csv")
    sinks.overwrite(raw([{"content": t} for t in texts]).select(*RAW_COLUMNS), path, "csv")
    back = readers.scan_raw_reviews(spark, path)
    got = {r.review_id: r.content for r in back.collect()}
    assert [got[f"r{i}"] for i in range(len(texts))] == [t if t else None for t in texts[:5]] + [got["r5"], None, texts[7], texts[8]]
    assert got["r5"] in ("", None)


def test_raw_scan_sorts_in_file_order(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    for name, ids in (("part-0", "ab"), ("part-1", "cd")):
        lines = [f"app,App,{i},5,some text,2024-01-01 00:00:00,0,," for i in ids]
        (tmp_path / f"{name}.csv").write_text("﻿" + header + "\n" + "\n".join(lines) + "\n")
    df = readers.scan_raw_reviews(spark, str(tmp_path))
    assert [(r.review_id, r.ingest_seq) for r in df.orderBy("ingest_seq").collect()] == list(zip("abcd", range(4)))
    assert dict(df.dtypes)["ingest_seq"] == "bigint"
    flagged = clean.flag_reviews(df.withColumn("declared_lang", F.lit("en")))
    assert clean.clean_all(flagged).count() == 4


def test_row_numbers_do_not_depend_on_how_files_are_packed(spark, tmp_path):
    header, want = ",".join(RAW_COLUMNS), []
    for k in range(9):
        ids = [f"{k}-{i}" for i in range(k % 4 * 5)]
        want += ids
        lines = [f'app,App,{i},5,"some\ntext",2024-01-01 00:00:00,0,,' for i in ids]
        (tmp_path / f"part-{k}.csv").write_text(header + "\n" + "".join(line + "\n" for line in lines))
    for size in ("200", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = readers.scan_raw_reviews(spark, str(tmp_path))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        assert [(r.review_id, r.ingest_seq) for r in df.orderBy("ingest_seq").collect()] == [(i, n) for n, i in enumerate(want)]


def test_no_sort_aggregate_over_scanned_files(spark, tmp_path):
    lines = [f"app,App,{i},5,some text,2024-01-01 00:00:00,0,," for i in "aab"]
    (tmp_path / "x.csv").write_text(",".join(RAW_COLUMNS) + "\n" + "\n".join(lines) + "\n")
    raw = readers.scan_raw_reviews(spark, str(tmp_path)).withColumn("declared_lang", F.lit("en"))
    flagged = clean.flag_reviews(raw)
    for df in (clean.quality_metrics(flagged), ingest.raw_collection_metrics(raw), warehouse.apps_table(flagged), clean.clean_all(flagged)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
    assert clean.quality_metrics(flagged).first().duplicate_rate == 0.3333


def test_repeats_go_without_moving_texts(spark, raw):
    rows = shared.settle(clean.label(raw([{"review_id": f"r{i % 7}", "content": f"text number {i}"} for i in range(40)])), "rows")
    once = clean.dedupe_first(rows)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort " not in plan
    assert sorted(r.ingest_seq for r in once.collect()) == list(range(7))


def test_empty_or_missing_raw_source(spark, tmp_path):
    (tmp_path / "e.csv").write_text(",".join(RAW_COLUMNS) + "\n")
    with pytest.raises(ValueError):
        readers.scan_raw_reviews(spark, str(tmp_path / "e.csv"))
    with pytest.raises(Exception):
        readers.scan_raw_reviews(spark, str(tmp_path / "none.csv"))


def test_presets(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "en"))
    registry = {"clean_all": [str(tmp_path / "all")], "clean_en": [str(tmp_path / "en.csv"), str(tmp_path / "en")]}
    assert readers.resolve_source(spark, registry).endswith("/en")
    assert readers.resolve_source(spark, registry, preset=" Clean-EN ").endswith("/en")
    assert readers.resolve_source(spark, registry, path=str(tmp_path)) == str(tmp_path)
    with pytest.raises(ValueError):
        readers.resolve_source(spark, registry, preset="nope")
    with pytest.raises(FileNotFoundError):
        readers.resolve_source(spark, registry, preset="clean_all")


def test_history_appends_in_fixed_order(spark):
    path = shared.new_path(spark, "hist")
    sinks.append_history(spark.range(1).select(F.lit(2).alias("b"), F.lit("x").alias("a")), path, ["a", "b"])
    sinks.append_history(spark.range(1).select(F.lit(3).alias("b"), F.lit("y").alias("a")), path, ["a", "b"])
    df = spark.read.parquet(path)
    assert df.columns == ["a", "b"] and as_dict(df) == {"x": 2, "y": 3}


def test_shared_folder_follows_the_session(spark):
    assert shared.new_path(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared.new_path(spark, "t") != shared.new_path(spark, "t")
