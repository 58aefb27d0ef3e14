"""Queries over the clean step: derived columns, flags, de-duplication, quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text, values
from ..operators import clean, keyed, language, profile, sampling, warehouse
from ..sources.reviews import documents, raw_reviews
from ..sources.shared import settle
from .base_sql import FLAGGED, KEPT, on_flagged, on_kept, on_kept_flagged, on_labelled, on_raw, WS
from .registry import flagged, flagged_narrow, kept, kept_en, labelled, query


def _columns(name: str, columns: list[str], sql_columns: str | None = None, source=labelled, wrap=on_labelled,
             sql_source: str = "labelled"):
    """Register a query that shows derived columns of every row."""
    shown = sql_columns or ", ".join(columns)
    query(name, wrap(f"SELECT ingest_seq, {shown} FROM {sql_source}"))(
        lambda s, d: source(s, d).select("ingest_seq", *columns))


_columns("p_numeric_coerce", ["score", "thumbs_up_count"])
_columns("p_content_len", ["content_len"])
_columns("p_is_empty", ["is_empty_text"])
_columns("p_is_short", ["is_short_text"])
_columns("p_parse_times", ["at_parsed", "replied_at_parsed"])
_columns("p_has_dev_reply", ["has_dev_reply"])
_columns("p_text_hash", ["text_hash"])
_columns("p_is_en", ["detected_lang", "is_en"])
_columns("p_is_noise", ["is_noise"])
_columns("p_sentiment_keyword", ["sentiment_keyword"])
_columns("p_inconsistent_rating", ["is_inconsistent_rating"])
_columns("p_missing_key_fields", ["is_missing_key_fields"])
_columns("p_hour_bucket", ["hour_bucket"])
_columns("p_normalize_text", ["content"])
_columns("p_preprocess_text", ["content_clean"])


@query("p_text_hash_raw", on_raw(f"""SELECT ingest_seq, CASE WHEN trim(COALESCE(content, ''), {WS}) = '' THEN ''
  ELSE md5(trim(COALESCE(content, ''), {WS})) END AS text_hash FROM raw"""))
def p_text_hash_raw(spark, sf_dir):
    content = text.normalize_text(F.col("content"))
    return raw_reviews(spark, sf_dir).select("ingest_seq", text.collection_text_hash(content).alias("text_hash"))


@query("p_time_anomaly", on_flagged("SELECT ingest_seq, hourly_count, is_time_anomaly FROM flagged"))
def p_time_anomaly(spark, sf_dir):
    return clean.with_time_anomaly(clean.narrow(labelled(spark, sf_dir))).select("ingest_seq", "hourly_count", "is_time_anomaly")


@query("j_hourly_left", on_flagged("""SELECT l.ingest_seq, l.hour_bucket, COALESCE(h.hourly_count, 0) AS hourly_count
  FROM labelled l LEFT JOIN hourly h ON h.hour_bucket = l.hour_bucket"""))
def j_hourly_left(spark, sf_dir):
    return clean.with_time_anomaly(clean.narrow(labelled(spark, sf_dir))).select("ingest_seq", "hour_bucket", "hourly_count")


@query("j_threshold_scalar", on_flagged("""SELECT h.hour_bucket, h.hourly_count, t.busy_from, h.hourly_count >= t.busy_from AS is_busy
  FROM hourly h CROSS JOIN threshold t"""))
def j_threshold_scalar(spark, sf_dir):
    hourly = clean.hourly_volume(labelled(spark, sf_dir))
    threshold = clean.busy_hour_threshold(hourly)
    return keyed.with_scalar(hourly, threshold).select(
        "hour_bucket", "hourly_count", "busy_from", (F.col("hourly_count") >= F.col("busy_from")).alias("is_busy"))


@query("p_spam_suspect", on_flagged("SELECT ingest_seq, is_spam_bot_suspect FROM flagged"))
def p_spam_suspect(spark, sf_dir):
    return flagged_narrow(spark, sf_dir).select("ingest_seq", "is_spam_bot_suspect")


@query("j_dup_count_self", on_flagged("""SELECT ingest_seq, text_hash, CASE WHEN dup_text_count >= 3 THEN dup_text_count END AS dup_text_count
  FROM flagged"""))
def j_dup_count_self(spark, sf_dir):
    """Row next to the count of its text, for texts that repeat often enough to matter."""
    rows = clean.narrow(labelled(spark, sf_dir))
    return clean.with_duplicate_counts(rows).select("ingest_seq", "text_hash", "dup_text_count")


@query("w_dup_count", on_flagged("SELECT ingest_seq, dup_text_count FROM flagged"))
def w_dup_count(spark, sf_dir):
    rows = clean.narrow(labelled(spark, sf_dir))
    counted = clean.with_duplicate_counts(rows, facts=clean.duplicate_facts(rows, at_least=1))
    return counted.select("ingest_seq", "dup_text_count")


_DETECTED = rf"""
, tokens AS (
  SELECT lang, word, COUNT(*) AS n FROM (
    SELECT lang, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents WHERE lang IS NOT NULL)
  GROUP BY lang, word
), pieces AS (
  SELECT lang, n, unnest(list_concat(
    list_transform(range(1, length(word) + 1), lambda i: substr(word, i, 1)),
    list_transform(range(1, length(word) + 2), lambda i: substr(' ' || word || ' ', i, 2)),
    list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3)))) AS gram
  FROM tokens
), gram_counts AS MATERIALIZED (
  SELECT lang, gram, SUM(n) AS n FROM pieces GROUP BY lang, gram
), vocabulary AS (
  SELECT DISTINCT gram FROM gram_counts
), totals AS (
  SELECT lang, SUM(n) AS total, (SELECT COUNT(*) FROM vocabulary) AS size
  FROM gram_counts GROUP BY lang
), model AS MATERIALIZED (
  SELECT v.gram, t.lang, CAST(round(ln((COALESCE(g.n, 0) + 1) / (t.total + t.size)::DOUBLE) * {language.SCALE}) AS BIGINT) AS s
  FROM vocabulary v CROSS JOIN totals t LEFT JOIN gram_counts g ON g.gram = v.gram AND g.lang = t.lang
), words AS (
  SELECT ingest_seq, unnest(regexp_extract_all(content_clean, '\p{{L}}+')) AS word
  FROM labelled WHERE length(content_clean) >= 5
), cut AS (
  SELECT ingest_seq, gram, COUNT(*) AS n FROM (SELECT ingest_seq, unnest(list_concat(
    list_transform(range(1, length(word) + 1), lambda i: substr(word, i, 1)),
    list_transform(range(1, length(word) + 2), lambda i: substr(' ' || word || ' ', i, 2)),
    list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3)))) AS gram FROM words)
  GROUP BY ingest_seq, gram
), scored AS (
  SELECT ingest_seq, lang, SUM(n * s) AS score FROM cut JOIN model USING (gram) GROUP BY ingest_seq, lang
), best AS (
  SELECT ingest_seq, lang, ROW_NUMBER() OVER (PARTITION BY ingest_seq ORDER BY score DESC, lang) AS rn FROM scored
)
"""


@query("p_detect_lang", on_labelled(_DETECTED + """SELECT l.ingest_seq, COALESCE(b.lang, 'unknown') AS detected_lang
FROM labelled l LEFT JOIN best b ON b.ingest_seq = l.ingest_seq AND b.rn = 1"""))
def p_detect_lang(spark, sf_dir):
    """Train on all labelled documents, then detect the language of every review."""
    return detected(spark, sf_dir).select("ingest_seq", "detected_lang")


def detected(spark, sf_dir):
    """Labelled rows with the detected language in place of the declared one."""
    return clean.label(raw_reviews(spark, sf_dir), language.train(documents(spark, sf_dir), "text", "lang"))


_CODED = """, coded AS MATERIALIZED (
  SELECT l.* EXCLUDE (detected_lang, is_en), COALESCE(b.lang, 'unknown') AS detected_lang, COALESCE(b.lang, 'unknown') = 'en' AS is_en
  FROM labelled l LEFT JOIN best b ON b.ingest_seq = l.ingest_seq AND b.rn = 1
)"""


@query("clean_en_detected", on_labelled(_DETECTED + _CODED + """, firsts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY ingest_seq) AS rn FROM coded)
SELECT review_id, ingest_seq, detected_lang, is_noise, sentiment_keyword FROM firsts
WHERE rn = 1 AND NOT is_empty_text AND NOT is_short_text AND detected_lang = 'en'"""))
def clean_en_detected(spark, sf_dir):
    """The English clean table as the detector finds it: flags, de-duplication and filter on detected codes."""
    return clean.clean_en(detected(spark, sf_dir)).select("review_id", "ingest_seq", "detected_lang", "is_noise", "sentiment_keyword")


def _names_sql(code: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in V.LANGUAGE_NAMES.items())
    return f"CASE {code} {cases} ELSE 'Other language (' || {code} || ')' END"


_CODE = "replace(lower(trim(COALESCE(detected_lang, 'unknown'))), '_', '-')"


@query("p_lang_name", on_labelled(f"SELECT ingest_seq, {_names_sql(_CODE)} AS language_name_en FROM labelled"))
def p_lang_name(spark, sf_dir):
    return labelled(spark, sf_dir).select("ingest_seq", text.language_name(F.col("detected_lang")).alias("language_name_en"))


@query("p_bool_to_int", on_labelled("""SELECT ingest_seq, CAST(is_en AS TINYINT) AS is_en, CAST(is_noise AS TINYINT) AS is_noise,
  CAST(has_dev_reply AS TINYINT) AS has_dev_reply FROM labelled"""))
def p_bool_to_int(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    stored = warehouse.reviews_table(rows.withColumn("row_key", F.col("ingest_seq")))
    return stored.select(F.col("row_key").alias("ingest_seq"), "is_en", "is_noise", "has_dev_reply")


@query("p_ts_to_string", on_labelled("""SELECT ingest_seq, strftime(at_parsed, '%Y-%m-%d %H:%M:%S') AS at_parsed,
  strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') AS hour_bucket FROM labelled"""))
def p_ts_to_string(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    stored = warehouse.reviews_table(rows.withColumn("row_key", F.col("ingest_seq")))
    return stored.select(F.col("row_key").alias("ingest_seq"), "at_parsed", "hour_bucket")


@query("p_day", on_labelled("SELECT ingest_seq, CAST(at_parsed AS DATE) AS day FROM labelled"))
def p_day(spark, sf_dir):
    return sampling.with_time(labelled(spark, sf_dir)).select("ingest_seq", "day")


@query("p_optional_columns", on_labelled("SELECT ingest_seq, app_name, score, CAST(NULL AS BOOLEAN) AS is_spam_bot_suspect FROM labelled"))
def p_optional_columns(spark, sf_dir):
    """Row-level table: the spam flag does not exist there and shows as null."""
    rows = labelled(spark, sf_dir)
    wanted = values.existing(rows, ["app_name", "score", "no_such_column"])
    return rows.select("ingest_seq", *wanted, values.optional(rows, "is_spam_bot_suspect", "boolean"))


@query("p_round", on_labelled("""SELECT app_id, round(AVG(CAST(is_en AS INT)), 4) AS rate4, round(AVG(CAST(is_en AS INT)), 6) AS rate6,
  round(100 * AVG(CAST(is_en AS INT)), 2) AS pct2 FROM labelled GROUP BY app_id"""))
def p_round(spark, sf_dir):
    share = values.rate(F.col("is_en"))
    return labelled(spark, sf_dir).groupBy("app_id").agg(
        F.round(share, 4).alias("rate4"), F.round(share, 6).alias("rate6"), F.round(100 * share, 2).alias("pct2"))


CLEAN_SHOWN = [
    "app_id", "app_name", "review_id", "score", "content", "at", "thumbs_up_count", "reply_content", "replied_at",
    "content_len", "is_short_text", "has_dev_reply", "at_parsed", "text_hash", "is_empty_text", "replied_at_parsed",
    "content_clean", "detected_lang", "is_en", "is_noise", "is_missing_key_fields", "sentiment_keyword",
    "is_inconsistent_rating", "hour_bucket", "hourly_count", "is_time_anomaly", "is_spam_bot_suspect",
]


_CLEAN_SQL = ", ".join(f'"{c}"' for c in CLEAN_SHOWN)


@query("clean_all", on_kept_flagged(f"SELECT {_CLEAN_SQL} FROM kept"))
def clean_all(spark, sf_dir):
    return clean.clean_all(flagged(spark, sf_dir)).select(*CLEAN_SHOWN)


@query("clean_en", on_kept_flagged(f"SELECT {_CLEAN_SQL} FROM kept_en"))
def clean_en(spark, sf_dir):
    return clean.clean_en(flagged(spark, sf_dir)).select(*CLEAN_SHOWN)


@query("w_dedupe_first", on_labelled("SELECT review_id, MIN(ingest_seq) AS ingest_seq FROM labelled GROUP BY review_id"))
def w_dedupe_first(spark, sf_dir):
    return clean.dedupe_first(clean.narrow(labelled(spark, sf_dir))).select("review_id", "ingest_seq")


@query("w_apps_first", on_labelled("SELECT app_id, arg_min(app_name, ingest_seq) AS app_name FROM labelled GROUP BY app_id"))
def w_apps_first(spark, sf_dir):
    return warehouse.apps_table(settle(labelled(spark, sf_dir).select("app_id", "app_name", "ingest_seq"), "app-names"))


_QUALITY = """
, raw_side AS (
  SELECT COUNT(*) AS n, COUNT(DISTINCT review_id) AS ids, AVG(CAST(is_empty_text AS INT)) AS e, AVG(CAST(is_short_text AS INT)) AS s,
    AVG(CAST(at_parsed IS NOT NULL AS INT)) AS t, AVG(CAST(score IS NOT NULL AS INT)) AS sc,
    AVG(CAST(is_missing_key_fields AS INT)) AS m FROM flagged
), kept_side AS (
  SELECT COUNT(*) AS n, AVG(CAST(is_en AS INT)) AS en, AVG(CAST(is_noise AS INT)) AS noise, AVG(CAST(is_spam_bot_suspect AS INT)) AS spam,
    AVG(CAST(is_inconsistent_rating AS INT)) AS inc, AVG(CAST(is_time_anomaly AS INT)) AS an,
    COUNT(*) FILTER (WHERE is_en) AS n_en FROM kept
)
SELECT 'run' AS section, 'run_time' AS metric, CAST(NULL AS DOUBLE) AS value, '2024-02-01 00:00:00' AS detail
UNION ALL SELECT 'run', 'raw_input_file', NULL, 'documents'
UNION ALL SELECT 'p0', 'raw_rows', CAST(n AS DOUBLE), NULL FROM raw_side
UNION ALL SELECT 'p0', 'duplicate_rate', round((n - ids) / n::DOUBLE, 4), NULL FROM raw_side
UNION ALL SELECT 'p0', 'empty_text_rate', round(e, 4), NULL FROM raw_side
UNION ALL SELECT 'p0', 'short_text_rate_lt5', round(s, 4), NULL FROM raw_side
UNION ALL SELECT 'p0', 'parseable_time_rate', round(t, 4), NULL FROM raw_side
UNION ALL SELECT 'p0', 'parseable_score_rate', round(sc, 4), NULL FROM raw_side
UNION ALL SELECT 'p0', 'clean_all_rows', CAST(n AS DOUBLE), NULL FROM kept_side
UNION ALL SELECT 'p1', 'english_rate_after_p0', round(en, 4), NULL FROM kept_side
UNION ALL SELECT 'p1', 'noise_rate_after_p0', round(noise, 4), NULL FROM kept_side
UNION ALL SELECT 'p2', 'missing_key_fields_rate', round(m, 4), NULL FROM raw_side
UNION ALL SELECT 'p2', 'spam_bot_suspect_rate', round(spam, 4), NULL FROM kept_side
UNION ALL SELECT 'p2', 'inconsistent_rating_rate', round(inc, 4), NULL FROM kept_side
UNION ALL SELECT 'p2', 'time_anomaly_rate', round(an, 4), NULL FROM kept_side
UNION ALL SELECT 'output', 'clean_en_rows', CAST(n_en AS DOUBLE), NULL FROM kept_side"""


@query("quality_report", on_kept_flagged(_QUALITY))
def quality_report(spark, sf_dir):
    return clean.quality_report(flagged_narrow(spark, sf_dir), "2024-02-01 00:00:00", "documents")


@query("quality_report_detected", on_labelled(
    _DETECTED + _CODED + ", " + FLAGGED.replace("labelled", "coded") + ", " + KEPT.format(source="flagged") + _QUALITY))
def quality_report_detected(spark, sf_dir):
    """The report of the main clean step with the detector in it: English rates are of detected codes."""
    rows = clean.flag_labelled(clean.narrow(detected(spark, sf_dir)))
    return clean.quality_report(rows, "2024-02-01 00:00:00", "documents")


@query("f_flag_rows", on_kept("""SELECT review_id, app_name, score, sentiment_keyword FROM kept_en WHERE is_inconsistent_rating"""))
def f_flag_rows(spark, sf_dir):
    return profile.flag_rows(kept_en(spark, sf_dir), "is_inconsistent_rating",
                             ["review_id", "app_name", "score", "sentiment_keyword"])


@query("f_star_bands", on_kept("""SELECT CASE WHEN score = 5 THEN 'high' ELSE 'low' END AS band, review_id, score
  FROM kept_en WHERE score IN (1, 2, 5)"""))
def f_star_bands(spark, sf_dir):
    return profile.star_bands(kept_en(spark, sf_dir)).select("band", "review_id", "score")


@query("set_distinct_characters", on_kept("""SELECT ch, COUNT(*) AS n FROM (
  SELECT unnest(list_distinct(string_split(content_clean, ''))) AS ch FROM kept WHERE content_clean <> '') GROUP BY ch"""))
def set_distinct_characters(spark, sf_dir):
    """Reviews per distinct character."""
    chars = F.array_distinct(F.split(F.col("content_clean"), ""))
    rows = kept(spark, sf_dir, "content_clean").filter("content_clean <> ''").select(F.explode(chars).alias("ch"))
    return rows.groupBy("ch").agg(F.count("*").alias("n"))
