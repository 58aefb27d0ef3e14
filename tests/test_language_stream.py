from pyspark.sql import functions as F

from reviewpulse.operators import clean, language, monitor
from reviewpulse.sources.reviews import documents, raw_reviews, table
from reviewpulse.sources.shared import new_path
from reviewpulse.streaming import day_state, reviews_stream as rs

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    """Train on one half of the documents, detect the other half."""
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    model = language.train(docs.filter(half == 0), "text", "lang")
    test = clean.text.preprocess_text(F.col("text"))
    rows = docs.filter(half == 1).withColumn("content_clean", test).filter(F.length("content_clean") >= 50)
    found = language.with_detected_language(rows, model, row_id="doc_id")
    assert found.agg(F.avg((F.col("detected_lang") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_short_and_foreign_text_is_unknown(spark):
    train = spark.createDataFrame([("hello world again", "en"), ("bonjour le monde", "fr")], "t string, l string")
    model = language.train(train, "t", "l")
    df = spark.createDataFrame([(1, "hell"), (2, "日本語のテキスト"), (3, "hello world"), (4, "monde bonjour")], "ingest_seq long, content_clean string")
    got = {r.ingest_seq: r.detected_lang for r in language.with_detected_language(df, model).collect()}
    assert got == {1: "unknown", 2: "unknown", 3: "en", 4: "fr"}


def test_both_ways_of_detection_agree(spark):
    docs = documents(spark, SF)
    model = language.train(docs.filter("doc_id % 3 = 0"), "text", "lang")
    odd = spark.createDataFrame([(-1, "12345 67"), (-2, "日本語のテキスト"), (-3, "Ⅷ²³ ab"), (-4, "e\u0301te\u0301 naïve straße"), (-5, "abc")],
                                "doc_id long, content_clean string")
    rows = docs.select("doc_id", F.lower("text").alias("content_clean")).unionByName(odd)
    one, two = (sorted(map(tuple, language.detect(rows, model, row_id="doc_id", model_bytes=b).collect())) for b in (1 << 30, 0))
    assert one == two and len(one) > docs.count() and {r[0] for r in one} & {-1, -5} == set()


def test_words_are_forgotten_and_scored_again(monkeypatch):
    monkeypatch.setattr(language, "HELD_WORDS", 2)
    scores = language.WordScores({"a": 0, "b": 1}, language.np.array([[5, 1], [1, 9]]))
    assert [scores.best(list(t)) for t in ("ab", "aaa", "cd", "ba", "a", "")] == [1, 0, None, 1, 0, None]


def test_grams_of_a_word(spark):
    row = spark.range(1).select(language.grams(F.lit("abc")).alias("g")).first()
    assert list(row.g) == ["a", "b", "c", " a", "ab", "bc", "c ", " ab", "abc", "bc "]


def test_stream_dedupe_keeps_the_first_row(spark):
    folder = new_path(spark, "in")
    rows = spark.range(100).select((F.col("id") % 40).cast("string").alias("review_id"), F.col("id").alias("ingest_seq"))
    rows.repartition(5).write.parquet(folder)
    out = rs.dedupe(rs.read_stream(spark, folder, rows.schema, max_files=1), new_path(spark, "out"))
    assert sorted((int(r.review_id), r.ingest_seq) for r in out.collect()) == [(i, i) for i in range(40)]


def test_stream_volume_equals_batch_for_all_windows(spark):
    folder = new_path(spark, "in")
    events = table(spark, SF, "events").withColumn("t", F.col("ts").cast("timestamp")).select("t")
    events.repartition(4).write.parquet(folder)
    counts = rs.volume(rs.read_stream(spark, folder, events.schema, max_files=1), "t", "1 day", new_path(spark, "vol"))
    got = {str(r.window_start): r.reviews for r in counts.collect()}
    assert got == {str(r[0]): r[1] for r in events.groupBy(F.date_trunc("day", "t")).count().collect()}


def test_stream_history_does_not_depend_on_micro_batches(spark):
    rows = raw_reviews(spark, SF)
    folder = new_path(spark, "in")
    rows.repartition(4).write.parquet(folder)
    got = rs.append_quality_history(rs.read_stream(spark, folder, rows.schema, max_files=1), new_path(spark, "history"))
    flagged = clean.flag_reviews(rows.withColumn("run_ts", F.col("ingest_date")), ["run_ts"])
    want = monitor.quality_history(flagged).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_micro_batch_reads_the_state_of_its_days_only(spark):
    folder, sizes = new_path(spark, "history"), []
    for batch, days in enumerate([["2024-01-01", "2024-01-02"], ["2024-01-03"], ["2024-01-02"], ["2024-01-02", "2024-01-04"]]):
        own = {
            "ids": [(d, f"r{batch}", 1, 0, 0, 1, 1, 0, batch, True, True, False, False, False, "h", None) for d in days],
            "texts": [(d, "h", 1) for d in days], "hours": [(d, None, 1) for d in days], "apps": [(d, f"a{batch}") for d in days],
        }
        own = {k: spark.createDataFrame(v, f"day string, {day_state.LAYOUTS[k]}") for k, v in own.items()}
        earlier = day_state.read(spark, folder, days, batch)
        sizes.append(0 if earlier is None else sum(len(_opened(df)) for df in earlier.values()))
        # A repeated micro-batch starts from the state before it.
        for _ in range(2):
            state = day_state.merged(own, day_state.read(spark, folder, days, batch), folder, batch)
        got = {r.run_ts and str(r.run_ts): r.raw_rows for r in day_state.history(state, "d").collect()}
        assert got == [{"2024-01-01": 1, "2024-01-02": 1}, {"2024-01-03": 1}, {"2024-01-02": 2}, {"2024-01-02": 3, "2024-01-04": 1}][batch]
    assert sizes[:2] == [0, 0] and sizes[2] == 4 and sizes[3] == 4
    last = day_state.history(state, "d").filter("run_ts = '2024-01-02'").first()
    assert (last.apps_count, last.clean_all_rows, last.duplicate_rate, last.spam_bot_suspect_rate) == (3, 3, 0.0, 1.0)


def _opened(df):
    """Files that a scan opens, after its partitions are pruned."""
    return {r[0] for r in df.select(F.input_file_name()).collect()}
