"""Text, value and statistics expressions, checked against plain Python on small inputs."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewpulse.functions import fixed_values as V
from reviewpulse.functions import stats, text, values

TEXTS = [
    "", "   ", "　  Good App  \n", "GOOD\x1c\tapp\x1f", "see http://x.y/z now", "www.a.b end",
    "http://only.url", "!!!!!!", "aaaaaa", "ababab", "abcabc", "aaaaa", "ok", "OKAY", "ads", "dads love it", "bug",
    "Great but BUGGY", "1234567", "é", "ééééééé", "日本語のレビュー", "😀😀😀😀😀😀", "😀😀x", "a b a b", "İstanbul", "wow", "nice one",
    "line one\n\n  line two", "https://a b www.c\nd",
]


def py_clean(t):
    s = re.sub(r"https?://\S+|www\.\S+", " ", t.lower().strip())
    return re.sub(r"\s+", " ", s).strip()


def py_noise(clean):
    if not clean or not any(c.isalpha() for c in clean):
        return True
    return (len(set(clean)) <= 2 and len(clean) >= 6) or (clean in V.LOW_INFORMATION_WORDS and len(clean) <= 4)


def py_sentiment(clean):
    p = any(w in clean for w in V.POSITIVE_KEYWORDS)
    n = any(w in clean for w in V.NEGATIVE_KEYWORDS)
    return "positive" if p and not n else "negative" if n and not p else "neutral"


def run_texts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    clean = text.preprocess_text(F.col("t"))
    return df.select("i", text.normalize_text(F.col("t")).alias("n"), clean.alias("c")).select(
        "*", F.length("n").alias("len"), text.text_hash(F.col("c")).alias("h"), text.is_noise(F.col("c")).alias("noise"),
        text.sentiment_keyword(F.col("c")).alias("sent"), text.words(F.col("c")).alias("w"),
    ).orderBy("i").collect()


def compare(spark, texts):
    for t, r in zip(texts, run_texts(spark, texts)):
        clean = py_clean(t)
        assert r.n == t.strip()
        assert r.len == len(t.strip())
        assert r.c == clean
        assert r.h == hashlib.md5(clean.encode()).hexdigest()
        assert r.noise == py_noise(clean), t
        assert r.sent == py_sentiment(clean)
        assert list(r.w) == re.findall("[a-z]{2,}", clean)


def test_text_functions_match_python(spark):
    compare(spark, TEXTS)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab !\t\n  \x1chtps:/w.1éßgodlve日😀")), max_size=40),
                min_size=40, max_size=40))
def test_text_functions_match_python_on_generated_text(spark, texts):
    compare(spark, texts)


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.normalize_text(F.col("t"))).first()[0] == ""


def test_known_hash(spark):
    row = spark.range(1).select(text.text_hash(F.lit("good app"))).first()
    assert row[0] == hashlib.md5(b"good app").hexdigest()


def test_collection_hash_keeps_case_and_empty(spark):
    df = spark.createDataFrame([("Good",), ("",)], "t string").select(text.collection_text_hash(F.col("t")))
    assert [r[0] for r in df.collect()] == [hashlib.md5(b"Good").hexdigest(), ""]


def test_word_boundary_option(spark):
    df = spark.createDataFrame([("dads are nice",)], "t string")
    assert df.select(text.sentiment_keyword(F.col("t"))).first()[0] == "negative"
    assert df.select(text.sentiment_keyword(F.col("t"), word_boundary=True)).first()[0] == "neutral"


def test_language_names(spark):
    df = spark.createDataFrame([("EN",), (" zh_CN ",), ("xx",), ("unknown",)], "c string")
    got = [r[0] for r in df.select(text.language_name(F.col("c"))).collect()]
    assert got == ["English", "Chinese (Simplified)", "Other language (xx)", "Unknown (undetected or too short)"]


def test_values(spark):
    df = spark.createDataFrame([("3",), ("abc",), (None,), ("nan",), (" 4.5 ",)], "v string")
    assert [r[0] for r in df.select(values.to_number(F.col("v"))).collect()] == [3.0, None, None, None, 4.5]
    assert [r[0] for r in df.select(values.to_count(F.col("v"))).collect()] == [3, 0, 0, 0, 4]


def test_times_have_one_layout(spark):
    rows = ["2024-01-02 03:04:05", "2024-01-02", "2024-13-02 03:04:05", "x", None, "2024-01-02T03:04:05"]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    got = df.select(values.parse_time(F.col("v")).alias("t")).select("t", values.time_text(F.col("t")).alias("s"))
    assert [r.s for r in got.collect()] == ["2024-01-02 03:04:05", None, None, None, None, None]


def test_hour_floor_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "v string")  # an hour that zone skips
        ts = values.parse_time(F.col("v"))
        row = df.select(values.time_text(values.floor_hour(ts)).alias("h")).first()
        assert row.h == "2024-03-10 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("scores", [[5, 5, 5, 4, 1], [1, 2], [3, 3, 3, 3], [1, 1, 1, 1, 5, 5, 2]])
def test_skewness_matches_pandas(spark, scores):
    df = spark.createDataFrame([(float(x),) for x in scores], "s double")
    got = df.agg(stats.sample_skewness(F.col("s"))).first()[0]
    if len(scores) < 3:
        assert got is None
    else:
        assert got == pytest.approx(pd.Series(scores, dtype=float).skew())


def test_psi_properties(spark):
    p, q = [0.1, 0.2, 0.3, 0.2, 0.2], [0.0, 0.3, 0.3, 0.2, 0.2]

    def run(a, b):
        cols = stats.population_stability_index([F.lit(x) for x in a], [F.lit(x) for x in b])
        return spark.range(1).select(cols).first()[0]

    pc, qc = np.clip(p, 1e-6, 1), np.clip(q, 1e-6, 1)
    pc, qc = pc / pc.sum(), qc / qc.sum()
    assert run(p, q) == pytest.approx(float(np.sum((pc - qc) * np.log(pc / qc))))
    assert run(p, q) == pytest.approx(run(q, p))
    assert run(p, p) == pytest.approx(0.0)
