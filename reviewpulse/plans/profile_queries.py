"""Queries over the section tables A to E and the chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import clean, keyed, profile, warehouse
from ..sources import sinks
from ..sources.reviews import table
from ..sources.shared import new_path, settle
from .base_sql import listed, on_flagged, on_kept, on_kept_flagged, on_labelled
from .clean_queries import _names_sql
from .registry import ORACLES, flagged, flagged_narrow, kept, kept_en, labelled, query, stored_en


# ---- A ---------------------------------------------------------------------------------------

@query("a1_rating_distribution", on_kept(
    "SELECT score, COUNT(*) AS count FROM kept_en WHERE score IS NOT NULL GROUP BY score"))
def a1(spark, sf_dir):
    return profile.rating_distribution(kept_en(spark, sf_dir)).orderBy("score")


@query("a1_rating_distribution_dense", on_kept("""SELECT s.score, COUNT(k.score) AS count
  FROM (SELECT CAST(unnest(range(1, 6)) AS DOUBLE) AS score) s LEFT JOIN kept_en k ON k.score = s.score GROUP BY s.score"""))
def a1_dense(spark, sf_dir):
    return profile.rating_distribution_dense(kept_en(spark, sf_dir)).orderBy("score")


_STARS = ", ".join(f"COUNT(*) FILTER (WHERE score = {k}) AS star_{k}" for k in range(1, 6))


@query("a2_rating_counts_by_app", on_kept(
    f"SELECT app_id, app_name, {_STARS} FROM kept_en WHERE score IS NOT NULL GROUP BY app_id, app_name"))
def a2_counts(spark, sf_dir):
    return profile.rating_counts_by_app(kept_en(spark, sf_dir))


@query("a2_mean_score_by_app", on_kept(
    "SELECT app_id, app_name, round(AVG(score), 6) AS mean_score, COUNT(score) AS n_scores FROM kept_en GROUP BY app_id, app_name"))
def a2_mean(spark, sf_dir):
    return profile.mean_score_by_app(kept_en(spark, sf_dir))


_SUMMARY = [("count", "COUNT(*)"), ("mean", "AVG(content_len)"), ("std", "stddev_samp(content_len)"),
            ("min", "MIN(content_len)"), ("50%", "quantile_cont(content_len, 0.5)"),
            ("90%", "quantile_cont(content_len, 0.9)"), ("95%", "quantile_cont(content_len, 0.95)"),
            ("max", "MAX(content_len)")]


@query("a3_length_summary", on_kept(" UNION ALL ".join(
    f"SELECT '{n}' AS stat, round(CAST({e} AS DOUBLE), 6) AS value FROM kept_en" for n, e in _SUMMARY)))
def a3(spark, sf_dir):
    return profile.length_summary(kept_en(spark, sf_dir))


@query("a4_length_stats_by_rating", on_kept("""SELECT score, round(AVG(content_len), 6) AS mean_len,
  round(quantile_cont(content_len, 0.5), 6) AS median_len, COUNT(*) AS n_rows FROM kept_en WHERE score IS NOT NULL GROUP BY score"""))
def a4(spark, sf_dir):
    return profile.length_stats_by_rating(kept_en(spark, sf_dir))


@query("a5_scale_chain", on_kept("""SELECT 'raw' AS stage, NULLIF((SELECT COUNT(*) FROM raw), 0) AS rows
  UNION ALL SELECT 'after_P0_all_languages', NULLIF((SELECT COUNT(*) FROM kept), 0)
  UNION ALL SELECT 'after_P0_english_only', (SELECT COUNT(*) FROM kept_en)"""))
def a5(spark, sf_dir):
    rows = clean.narrow(labelled(spark, sf_dir))
    return profile.scale_chain(rows, clean.clean_all(rows), clean.clean_en(rows))


@query("a6_a7_quality_flags", on_kept("""SELECT 'noise_rate' AS metric, round(AVG(CAST(is_noise AS INT)), 6) AS value FROM kept_en
  UNION ALL SELECT 'has_dev_reply_rate', round(AVG(CAST(has_dev_reply AS INT)), 6) FROM kept_en"""))
def a6_a7(spark, sf_dir):
    return profile.quality_flag_rates(kept_en(spark, sf_dir))


@query("a7_score_by_dev_reply", on_kept(
    "SELECT has_dev_reply, round(AVG(score), 6) AS mean_score, COUNT(score) AS n_scores FROM kept_en GROUP BY has_dev_reply"))
def a7(spark, sf_dir):
    return profile.score_by_dev_reply(kept_en(spark, sf_dir))


# ---- B ---------------------------------------------------------------------------------------

@query("b1_per_app_stats", on_kept("""SELECT app_id, app_name, COUNT(review_id) AS rows, round(AVG(score), 6) AS mean_score,
  round(AVG(content_len), 6) AS mean_len FROM kept_en GROUP BY app_id, app_name"""))
def b1(spark, sf_dir):
    return profile.per_app_stats(kept_en(spark, sf_dir))


@query("b2_score_skew_by_app", on_kept("""SELECT app_id, app_name, CASE WHEN COUNT(score) >= 3 THEN
  round(COALESCE(skewness(score), 0), 6) END AS score_skew FROM kept_en GROUP BY app_id, app_name"""))
def b2(spark, sf_dir):
    return profile.score_skew_by_app(kept_en(spark, sf_dir))


_DAILY = "SELECT CAST(at_parsed AS DATE) AS day, COUNT(*) AS reviews FROM kept_en WHERE at_parsed IS NOT NULL GROUP BY 1"


@query("b3_daily_volume", on_kept(_DAILY))
def b3(spark, sf_dir):
    return profile.daily_volume(kept_en(spark, sf_dir)).orderBy("day")


@query("b3_daily_volume_orders", "SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS reviews FROM orders GROUP BY 1")
def b3_orders(spark, sf_dir):
    """The same operator over the larger orders table."""
    return profile.daily_volume(table(spark, sf_dir, "orders"), "o_orderdate")


@query("b4_inconsistent_rate", on_kept(
    "SELECT 'inconsistent_rating_rate' AS metric, round(AVG(CAST(is_inconsistent_rating AS INT)), 6) AS value FROM kept_en"))
def b4(spark, sf_dir):
    return profile.flag_mean(kept_en(spark, sf_dir), "is_inconsistent_rating", "inconsistent_rating_rate")


@query("t_inconsistent_sample", on_kept("""SELECT app_name, score, content, sentiment_keyword, is_inconsistent_rating
  FROM kept_en WHERE is_inconsistent_rating ORDER BY ingest_seq LIMIT 15"""))
def t_inconsistent_sample(spark, sf_dir):
    return profile.inconsistent_sample(kept_en(spark, sf_dir, "content"))


@query("b5_top_duplicate_texts", on_kept("""SELECT text_hash, COUNT(*) AS duplicate_count, arg_min(content, ingest_seq) AS content
  FROM kept_en GROUP BY text_hash ORDER BY duplicate_count DESC, text_hash LIMIT 20"""))
def b5(spark, sf_dir):
    stored = settle(kept_en(spark, sf_dir, "content").select("text_hash", "content", "ingest_seq"), "clean-texts")
    return profile.top_duplicate_texts(stored)


@query("t_top_hashes", on_kept(
    "SELECT text_hash, COUNT(*) AS duplicate_count FROM kept GROUP BY text_hash ORDER BY duplicate_count DESC, text_hash LIMIT 20"))
def t_top_hashes(spark, sf_dir):
    return profile.top_text_hashes(kept(spark, sf_dir))


@query("j_example_left", on_kept("""SELECT t.text_hash, t.duplicate_count, e.content
  FROM (SELECT text_hash, COUNT(*) AS duplicate_count FROM kept GROUP BY text_hash ORDER BY duplicate_count DESC, text_hash LIMIT 20) t
  LEFT JOIN (SELECT text_hash, arg_min(content, ingest_seq) AS content FROM kept_en GROUP BY text_hash) e USING (text_hash)"""))
def j_example_left(spark, sf_dir):
    """Top hashes of all languages; the example is English, so some have none."""
    rows = settle(kept(spark, sf_dir, "content").select("text_hash", "content", "ingest_seq", "is_en"), "clean-texts")
    return profile.with_examples(profile.top_text_hashes(rows), rows.filter("is_en"))


# ---- C ---------------------------------------------------------------------------------------

_LANG = "trim(COALESCE(detected_lang, 'unknown'))"
_LANG_COUNTS = (f"SELECT {_names_sql(f'replace(lower({_LANG}), chr(95), chr(45))')} AS language_name_en, COUNT(*) AS count, "
                f"{_LANG} AS detected_lang_code FROM kept GROUP BY ALL")


@query("c1_language_counts", on_kept(_LANG_COUNTS))
def c1(spark, sf_dir):
    return profile.language_counts(kept(spark, sf_dir))


@query("j_lang_lookup", on_labelled(f"""SELECT declared_lang, {_names_sql('declared_lang')} AS language_name_en, COUNT(*) AS n
  FROM labelled GROUP BY ALL"""))
def j_lang_lookup(spark, sf_dir):
    from ..functions.text import language_name
    counts = labelled(spark, sf_dir).groupBy("declared_lang").agg(F.count("*").alias("n"))
    return counts.select("declared_lang", language_name(F.col("declared_lang")).alias("language_name_en"), "n")


def _top_other_sql(counts: str, top: int) -> str:
    return f""", counts AS ({counts}), names AS (
  SELECT language_name_en, SUM(count) AS n FROM counts GROUP BY 1
), ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY n DESC, language_name_en) AS rn FROM names)
SELECT CASE WHEN rn <= {top} THEN language_name_en ELSE '{V.OTHER_LANGUAGES_LABEL}' END AS language,
  CAST(SUM(n) AS BIGINT) AS count, round(SUM(n) / (SELECT SUM(n) FROM names)::DOUBLE, 6) AS share
FROM ranked GROUP BY 1"""


@query("c1_language_top15_other", on_kept(_top_other_sql(_LANG_COUNTS, V.TOP_LANGUAGES)))
def c1_top(spark, sf_dir):
    return profile.language_top_and_other(profile.language_counts(kept(spark, sf_dir)))


@query("c1_language_top3_other", on_kept(_top_other_sql(_LANG_COUNTS, 3)))
def c1_top3(spark, sf_dir):
    """A short list, so that the tail row appears with the languages at hand."""
    return profile.language_top_and_other(profile.language_counts(kept(spark, sf_dir)), 3)


_C2 = """SELECT 'english_share_on_clean_all' AS metric, round(AVG(CAST(is_en AS INT)), 6) AS value, 'clean table' AS source,
    COUNT(*) AS n_rows FROM kept
  UNION ALL SELECT 'raw_rows', (SELECT COUNT(*) FROM raw), 'quality report', NULL
  UNION ALL SELECT 'clean_all_rows', (SELECT COUNT(*) FROM kept), 'quality report', NULL
  UNION ALL SELECT 'english_rate_after_p0', round((SELECT AVG(CAST(is_en AS INT)) FROM kept), 4), 'quality report', NULL
  UNION ALL SELECT 'clean_en_rows', (SELECT COUNT(*) FROM kept_en), 'quality report', NULL"""


@query("c2_english_subset", on_kept(_C2))
def c2(spark, sf_dir):
    rows = flagged_narrow(spark, sf_dir)
    return profile.english_subset(clean.clean_all(rows), clean.quality_report(rows, "", ""))


@query("f_metric_subset", on_kept("""SELECT 'p0' AS section, 'raw_rows' AS metric, CAST((SELECT COUNT(*) FROM raw) AS DOUBLE) AS value
  UNION ALL SELECT 'p0', 'clean_all_rows', (SELECT COUNT(*) FROM kept)
  UNION ALL SELECT 'p1', 'english_rate_after_p0', round((SELECT AVG(CAST(is_en AS INT)) FROM kept), 4)
  UNION ALL SELECT 'output', 'clean_en_rows', (SELECT COUNT(*) FROM kept_en)"""))
def f_metric_subset(spark, sf_dir):
    return profile.metric_subset(clean.quality_report(flagged_narrow(spark, sf_dir), "", ""))


# ---- D ---------------------------------------------------------------------------------------

_STOP = listed(V.STOP_WORDS)
_TOKENS = f""", tokens AS (
  SELECT score, unnest(regexp_extract_all(lower(content_clean), '[a-z]{{2,}}')) AS token FROM kept_en
), words AS (SELECT * FROM tokens WHERE token NOT IN ({_STOP}))
"""


@query("d1_top30_words", on_kept(
    _TOKENS + "SELECT token, COUNT(*) AS count FROM words GROUP BY token ORDER BY count DESC, token LIMIT 30"))
def d1(spark, sf_dir):
    return profile.top_words(kept_en(spark, sf_dir, "content_clean"), 30)


@query("t_topk_words", on_kept(
    _TOKENS + "SELECT token, COUNT(*) AS count FROM words GROUP BY token ORDER BY count DESC, token LIMIT 25"))
def t_topk_words(spark, sf_dir):
    return profile.top_words(kept_en(spark, sf_dir, "content_clean"), 25)


@query("j_stopword_anti", on_kept(_TOKENS + "SELECT token, COUNT(*) AS count FROM words GROUP BY token"))
def j_stopword_anti(spark, sf_dir):
    return profile.tokens(kept_en(spark, sf_dir, "content_clean")).groupBy("token").agg(F.count("*").alias("count"))


_LOW_HIGH = _TOKENS + """, low AS (
  SELECT token, COUNT(*) AS n FROM words WHERE score IN (1, 2) GROUP BY token ORDER BY n DESC, token LIMIT 25
), high AS (
  SELECT token, COUNT(*) AS n FROM words WHERE score = 5 GROUP BY token ORDER BY n DESC, token LIMIT 25
)
SELECT COALESCE(low.token, high.token) AS token, low.n AS low_star_1_2, high.n AS high_star_5
FROM low FULL OUTER JOIN high ON low.token = high.token"""


@query("d2_top_words_low_vs_high", on_kept(_LOW_HIGH))
def d2(spark, sf_dir):
    return profile.top_words_low_vs_high(kept_en(spark, sf_dir, "content_clean"))


@query("j_outer_wordlists", on_kept(_LOW_HIGH))
def j_outer_wordlists(spark, sf_dir):
    """Two separately ranked word lists aligned by a full outer join; the words are counted once."""
    counts = settle(profile.band_word_counts(kept_en(spark, sf_dir, "content_clean")), "band-words").withColumnRenamed("n", "count")

    def leaders(band):
        return counts.filter(F.col("band") == band).orderBy(F.desc("count"), "token").limit(25)

    return profile.align_word_lists(leaders("low"), leaders("high"))


# ---- E ---------------------------------------------------------------------------------------

@query("e1_time_anomaly_rate", on_kept_flagged(
    "SELECT 'time_anomaly_rate' AS metric, round(AVG(CAST(is_time_anomaly AS INT)), 6) AS value FROM kept_en"))
def e1(spark, sf_dir):
    rows = clean.clean_en(clean.with_time_anomaly(labelled(spark, sf_dir)))
    return profile.flag_mean(rows, "is_time_anomaly", "time_anomaly_rate")


@query("e2_spam_rate", on_kept_flagged(
    "SELECT 'spam_bot_suspect_rate' AS metric, round(AVG(CAST(is_spam_bot_suspect AS INT)), 6) AS value FROM kept_en"))
def e2(spark, sf_dir):
    return profile.flag_mean(clean.clean_en(flagged_narrow(spark, sf_dir)), "is_spam_bot_suspect", "spam_bot_suspect_rate")


@query("e_summary_rates", on_kept_flagged("""SELECT 'time_anomaly_rate' AS metric, round(AVG(CAST(is_time_anomaly AS INT)), 6) AS value,
    'share of rows in busy hours' AS note FROM kept_en
  UNION ALL SELECT 'spam_bot_suspect_rate', round(AVG(CAST(is_spam_bot_suspect AS INT)), 6), 'combined heuristic' FROM kept_en"""))
def e_summary(spark, sf_dir):
    return profile.risk_rates(clean.clean_en(flagged_narrow(spark, sf_dir)))


@query("e2_flag_counts", on_kept_flagged("""SELECT FALSE AS flag, COUNT(*) FILTER (WHERE NOT is_spam_bot_suspect) AS n FROM kept_en
  UNION ALL SELECT TRUE, COUNT(*) FILTER (WHERE is_spam_bot_suspect) FROM kept_en"""))
def e2_counts(spark, sf_dir):
    return profile.flag_counts(clean.clean_en(flagged_narrow(spark, sf_dir)), "is_spam_bot_suspect")


@query("t_spam_sample", on_kept_flagged("""SELECT app_name, score, content_len, content, is_spam_bot_suspect, text_hash
  FROM kept_en WHERE is_spam_bot_suspect ORDER BY ingest_seq LIMIT 20"""))
def t_spam_sample(spark, sf_dir):
    return profile.spam_sample(clean.clean_en(flagged(spark, sf_dir)))


@query("hourly_volume", on_flagged("SELECT hour_bucket, hourly_count FROM hourly"))
def hourly_volume(spark, sf_dir):
    return clean.hourly_volume(labelled(spark, sf_dir))


@query("hourly_volume_events", "SELECT date_trunc('hour', ts) AS hour_bucket, COUNT(*) AS hourly_count FROM events GROUP BY 1")
def hourly_volume_events(spark, sf_dir):
    """The same operator over the larger events table."""
    from ..functions.values import floor_hour
    return clean.hourly_volume(table(spark, sf_dir, "events").select(floor_hour(F.col("ts")).alias("hour_bucket")))


# ---- chart data ------------------------------------------------------------------------------

def _histogram_sql(values: str, bins: int) -> str:
    return f""", vals AS ({values}), ends AS (
  SELECT CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo, CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi
  FROM vals
), placed AS (
  SELECT least(CAST(floor((v - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) AS bin FROM vals CROSS JOIN ends
)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS bin_from, round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS bin_to,
  (SELECT COUNT(*) FROM placed p WHERE p.bin = b.bin) AS rows
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN ends WHERE lo IS NOT NULL"""


@query("hist_length_60", on_kept(_histogram_sql("SELECT CAST(content_len AS DOUBLE) AS v FROM kept_en", 60)))
def hist_length(spark, sf_dir):
    return profile.length_histogram(kept_en(spark, sf_dir))


@query("hist_hourly_40", on_kept_flagged(_histogram_sql(
    "SELECT least(CAST(hourly_count AS DOUBLE), (SELECT quantile_cont(hourly_count, 0.99) FROM kept_en)) AS v FROM kept_en", 40)))
def hist_hourly(spark, sf_dir):
    rows = clean.clean_en(clean.with_time_anomaly(labelled(spark, sf_dir)))
    return profile.hourly_count_histogram(rows)


def _box_sql(value: str, by: str, where: str) -> str:
    return f""", rows_in AS (SELECT {by}, CAST({value} AS DOUBLE) AS v FROM kept_en WHERE {where}), box AS (
  SELECT {by}, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM rows_in GROUP BY {by}
)
SELECT b.{by}, ANY_VALUE(n) AS n,
  round(least(MIN(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), ANY_VALUE(q1)), 6) AS whisker_low, round(ANY_VALUE(q1), 6) AS q1,
  round(ANY_VALUE(median), 6) AS median, round(ANY_VALUE(q3), 6) AS q3,
  round(greatest(MAX(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), ANY_VALUE(q3)), 6) AS whisker_high
FROM rows_in r JOIN box b ON b.{by} = r.{by} GROUP BY b.{by}"""


@query("box_length_by_rating", on_kept(_box_sql("content_len", "score", "score IN (1, 2, 3, 4, 5)")))
def box_length(spark, sf_dir):
    return profile.length_boxes_by_rating(kept_en(spark, sf_dir))


@query("box_score_by_app", on_kept(_box_sql("score", "app_name", "score IS NOT NULL")))
def box_score(spark, sf_dir):
    return profile.score_boxes_by_app(kept_en(spark, sf_dir))


# ---- set operations, report bundle -----------------------------------------------------------

@query("union_app_frames", on_labelled("""SELECT app_id, review_id, is_en, CAST(NULL AS BOOLEAN) AS is_noise FROM labelled WHERE is_en
  UNION ALL SELECT app_id, review_id, CAST(NULL AS BOOLEAN), is_noise FROM labelled WHERE NOT is_en"""))
def union_app_frames(spark, sf_dir):
    """Frames with different columns stacked by name."""
    rows = labelled(spark, sf_dir)
    return profile.union_frames([
        rows.filter("is_en").select("app_id", "review_id", "is_en"),
        rows.filter("NOT is_en").select("app_id", "review_id", "is_noise"),
    ])


def report_parts(spark, sf_dir):
    """Every section table with its place in the report and its row order."""
    rows = labelled(spark, sf_dir)
    # The clean table is stored once; every section then reads only the columns it needs.
    all_rows = settle(clean.clean_all(flagged(spark, sf_dir)), "clean")
    en = en_flagged = all_rows.filter("is_en")
    count_desc = F.desc("count")
    return [
        ("A", "A1", "a1_rating_distribution", profile.rating_distribution(en), ["score"]),
        ("A", "A2", "a2_rating_counts_by_app", profile.rating_counts_by_app(en), ["app_id"]),
        ("A", "A2", "a2_mean_score_by_app", profile.mean_score_by_app(en), ["app_id"]),
        ("A", "A3", "a3_length_summary", profile.length_summary(en), ["stat"]),
        ("A", "A4", "a4_length_stats_by_rating", profile.length_stats_by_rating(en), ["score"]),
        ("A", "A5", "a5_scale_chain", profile.scale_chain(rows, all_rows, en), [F.desc("rows")]),
        ("A", "A6", "a6_a7_quality_flags", profile.quality_flag_rates(en), ["metric"]),
        ("A", "A7", "a7_score_by_dev_reply", profile.score_by_dev_reply(en), ["has_dev_reply"]),
        ("B", "B1", "b1_per_app_stats", profile.per_app_stats(en), [F.desc("rows"), "app_id"]),
        ("B", "B2", "b2_score_skew_by_app", profile.score_skew_by_app(en), ["app_id"]),
        ("B", "B3", "b3_daily_volume", profile.daily_volume(en), ["day"]),
        ("B", "B4", "b4_inconsistent_rate", profile.flag_mean(en, "is_inconsistent_rating", "inconsistent_rating_rate"), ["metric"]),
        ("B", "B5", "b5_top_duplicate_texts", profile.top_duplicate_texts(en), [F.desc("duplicate_count"), "text_hash"]),
        ("C", "C1", "c1_language_counts", profile.language_counts(all_rows), [count_desc, "detected_lang_code"]),
        ("D", "D1", "d1_top30_words", profile.top_words(en), [count_desc, "token"]),
        ("D", "D2", "d2_top_words_low_vs_high", profile.top_words_low_vs_high(en), ["token"]),
        ("E", "E_summary", "e_summary_rates", profile.risk_rates(en_flagged), ["metric"]),
    ]


# Per table: place, row order and columns as in the Spark table; "#" marks doubles.
_BUNDLE = [
    ("A", "A1", "a1_rating_distribution", "score", "score# count"),
    ("A", "A2", "a2_rating_counts_by_app", "app_id", "app_id app_name star_1 star_2 star_3 star_4 star_5"),
    ("A", "A2", "a2_mean_score_by_app", "app_id", "app_id app_name mean_score# n_scores"),
    ("A", "A3", "a3_length_summary", "stat", "stat value#"),
    ("A", "A4", "a4_length_stats_by_rating", "score", "score# mean_len# median_len# n_rows"),
    ("A", "A5", "a5_scale_chain", "rows DESC", "stage rows"),
    ("A", "A6", "a6_a7_quality_flags", "metric", "metric value#"),
    ("A", "A7", "a7_score_by_dev_reply", "has_dev_reply", "has_dev_reply mean_score# n_scores"),
    ("B", "B1", "b1_per_app_stats", "rows DESC, app_id", "app_id app_name rows mean_score# mean_len#"),
    ("B", "B2", "b2_score_skew_by_app", "app_id", "app_id app_name score_skew#"),
    ("B", "B3", "b3_daily_volume", "day", "day reviews"),
    ("B", "B4", "b4_inconsistent_rate", "metric", "metric value#"),
    ("B", "B5", "b5_top_duplicate_texts", "duplicate_count DESC, text_hash", "text_hash duplicate_count content"),
    ("C", "C1", "c1_language_counts", "count DESC, detected_lang_code", "language_name_en count detected_lang_code"),
    ("D", "D1", "d1_top30_words", "count DESC, token", "token count"),
    ("D", "D2", "d2_top_words_low_vs_high", "token", "token low_star_1_2 high_star_5"),
    ("E", "E_summary", "e_summary_rates", "metric", "metric value# note"),
]


def _bundle_sql() -> str:
    def cell(name):
        plain = name.rstrip("#")
        value = f"CAST({plain} AS DECIMAL(30, 6))" if name.endswith("#") else plain
        return f"'{plain}': CAST({value} AS VARCHAR)"

    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{sub}' AS subsection, '{name}' AS table_name, "
        f"ROW_NUMBER() OVER (ORDER BY {order}) AS row_no, "
        f"CAST(to_json({{{', '.join(cell(c) for c in columns.split())}}}) AS VARCHAR) AS payload FROM ({ORACLES[name]}) t"
        for section, sub, name, order, columns in _BUNDLE)


@query("section_report_bundle", _bundle_sql())
def section_report_bundle(spark, sf_dir):
    return sinks.report_bundle([
        sinks.report_rows(df, section, sub, name, _numbered(name, df, order)) for section, sub, name, df, order in report_parts(spark, sf_dir)
    ])


# Tables with a row per app or day; all others have a fixed number of rows or one per language.
_GROWING = {"a2_rating_counts_by_app", "a2_mean_score_by_app", "b1_per_app_stats", "b2_score_skew_by_app", "b3_daily_volume"}


def _numbered(name, df, order):
    """Row numbers in range parts, or of a table of bounded size by its places in one ordered array."""
    if name in _GROWING:
        return keyed.with_row_numbers(df, order, "row_no")
    ordered = df.orderBy(*order).agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    return ordered.select(F.posexplode("rows").alias("place", "row")).select("row.*", (F.col("place") + 1).alias("row_no"))


# ---- warehouse checks ------------------------------------------------------------------------

def _check(name: str, sql: str):
    def run(spark, sf_dir):
        stored = clean.narrow(kept(spark, sf_dir))
        return warehouse.check(warehouse.tables(stored, "clean_all_languages", "2024-02-01T00:00:00Z"), name)
    query(name, on_kept(sql))(run)


_META = """SELECT 'source_file' AS key, '{source}' AS value UNION ALL SELECT 'data_subset', '{subset}'
  UNION ALL SELECT 'source_rows', CAST((SELECT COUNT(*) FROM {rows}) AS VARCHAR)
  UNION ALL SELECT 'app_count', CAST((SELECT COUNT(DISTINCT app_id) FROM {rows}) AS VARCHAR)
  UNION ALL SELECT 'loaded_at_utc', '2024-02-01T00:00:00Z'"""

_check("v_meta", _META.format(source="clean_all_languages", subset="clean_all_languages", rows="kept"))
_check("v_row_counts", """SELECT 'apps' AS tbl, COUNT(DISTINCT app_id) AS n FROM kept UNION ALL SELECT 'reviews', COUNT(*) FROM kept""")
_check("v_top5_apps", "SELECT app_id, COUNT(*) AS n FROM kept GROUP BY app_id ORDER BY n DESC, app_id LIMIT 5")
_check("v_by_score", "SELECT score, COUNT(*) AS n FROM kept GROUP BY score")
_check("v_null_keys", "SELECT COUNT(*) FILTER (WHERE review_id IS NULL OR review_id = '') AS bad_review_id FROM kept")
_check("v_english_dist", "SELECT CAST(is_en AS TINYINT) AS is_en, COUNT(*) AS n FROM kept GROUP BY 1")
_check("v_avg_len", "SELECT ROUND(AVG(content_len), 2) AS mean_len, COUNT(*) AS n FROM kept")


@query("t_top_apps", on_kept("SELECT app_id, COUNT(*) AS n FROM kept_en GROUP BY app_id ORDER BY n DESC, app_id LIMIT 5"))
def t_top_apps(spark, sf_dir):
    counts = kept_en(spark, sf_dir).groupBy("app_id").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "app_id").limit(5)


@query("warehouse_meta", on_kept(_META.format(source="tables/clean_en_only", subset="clean_en_only", rows="kept_en")))
def warehouse_meta(spark, sf_dir):
    built = warehouse.tables(stored_en(spark, sf_dir), "tables/clean_en_only", "2024-02-01T00:00:00Z")
    return built["ingestion_meta"]


_NOT_NULL = "".join(
    f" UNION ALL SELECT '{t}', 'not_null', '{c}', 0" for t, cols in warehouse.REQUIRED.items() for c in cols)


@query("warehouse_constraints", on_flagged(f"""SELECT 'apps' AS table_name, 'primary_key' AS rule, 'app_id' AS columns, 0 AS violations
  UNION ALL SELECT 'reviews', 'primary_key', 'app_id,review_id', (SELECT COUNT(*) FROM (
    SELECT 1 FROM labelled GROUP BY app_id, review_id HAVING COUNT(*) > 1))
  UNION ALL SELECT 'ingestion_meta', 'primary_key', 'key', 0
  UNION ALL SELECT 'reviews', 'foreign_key', 'app_id', (SELECT COUNT(*) FROM labelled WHERE app_id NOT IN (
    SELECT app_id FROM labelled WHERE is_en)){_NOT_NULL}"""))
def warehouse_constraints(spark, sf_dir):
    """Checked on rows that still hold repeats, with the apps of the English rows only."""
    loaded, observed = warehouse.stage(flagged_narrow(spark, sf_dir), "raw", new_path(spark, "staged"), "2024-02-01T00:00:00Z")
    english = loaded["reviews"].filter("is_en = 1").select("app_id").distinct()
    return warehouse.key_violations({**loaded, "apps": english}).unionByName(warehouse.null_violations(spark, observed))


@query("j_fk_check", on_kept("""SELECT app_id, COUNT(*) AS n_rows FROM kept WHERE app_id NOT IN (
    SELECT app_id FROM kept WHERE has_dev_reply AND is_inconsistent_rating) GROUP BY app_id"""))
def j_fk_check(spark, sf_dir):
    """Orphans against the apps that ever answered an inconsistent rating."""
    rows = clean.narrow(kept(spark, sf_dir))
    return warehouse.orphan_reviews(rows, warehouse.apps_table(rows.filter("has_dev_reply AND is_inconsistent_rating")))
