"""Common table expressions shared by the SQL equivalents."""

from __future__ import annotations

from ..functions import fixed_values as V
from ..sources.reviews import ARRIVALS, EDGE_SCORES, EDGE_TEXTS

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
TIME = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def contains_any(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _text(value: str) -> str:
    """An SQL literal; control characters as chr()."""
    parts = ["chr(%d)" % ord(c) if ord(c) < 32 else f"'{c}'" for c in value] if any(ord(c) < 32 for c in value) else [f"'{value}'"]
    return " || ".join(parts)


_ARRIVALS = ", ".join(f"('{k}', {shift}, {every})" for k, shift, every in ARRIVALS)
_EDGE_TEXTS = " ".join(f"WHEN '{k}' THEN {_text(v)}" for k, v in EDGE_TEXTS.items())
_EDGE_SCORES = " ".join(f"WHEN s.kind = '{k}' THEN '{v}'" for k, v in EDGE_SCORES.items())

RAW = f"""raw AS MATERIALIZED (
  SELECT d.source AS app_id, 'App ' || d.source AS app_name,
    CASE WHEN s.kind IN ('review', 'repeat') THEN CAST(d.doc_id AS VARCHAR)
         WHEN s.kind <> 'anonymous' THEN CAST(d.doc_id AS VARCHAR) || '-' || s.kind END AS review_id,
    CASE {_EDGE_SCORES} WHEN d.doc_id % 89 <> 0 THEN CAST(1 + (d.doc_id * 7 + e.user_id) % 5 AS VARCHAR) END AS score,
    CASE s.kind WHEN 'short' THEN substr(d.text, 1, d.doc_id % 7) {_EDGE_TEXTS} ELSE d.text END AS content,
    CASE WHEN d.doc_id % 97 = 0 THEN 'not-a-date' ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS "at",
    CAST(CAST(floor(e.value) AS BIGINT) % 4 AS VARCHAR) AS thumbs_up_count,
    c.text AS reply_content,
    CASE WHEN c.text IS NULL THEN NULL WHEN d.doc_id % 7 = 0 THEN 'soon' WHEN d.doc_id % 97 = 0 THEN 'not-a-date'
         ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS replied_at,
    d.lang AS declared_lang, CAST(e.ts AS DATE) AS ingest_date, d.doc_id + s.shift AS ingest_seq
  FROM documents d
  LEFT JOIN events e ON e.event_id = d.doc_id * 5
  LEFT JOIN (
    SELECT conv_id, text FROM (
      SELECT conv_id, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn
      FROM conversations WHERE role = 'assistant') WHERE rn = 1) c ON c.conv_id = d.doc_id
  JOIN (VALUES {_ARRIVALS}) s(kind, shift, every) ON d.doc_id % s.every = 0
)"""

LABELLED = f"""typed AS (
  SELECT * EXCLUDE (score, thumbs_up_count, content, review_id), COALESCE(review_id, 'nan') AS review_id,
    TRY_CAST(score AS DOUBLE) AS score,
    COALESCE(TRY_CAST(thumbs_up_count AS BIGINT), 0) AS thumbs_up_count,
    trim(COALESCE(content, ''), {WS}) AS content,
    trim(COALESCE(reply_content, ''), {WS}) <> '' AS has_dev_reply
  FROM raw
), derived AS (
  SELECT *, length(content) AS content_len, content = '' AS is_empty_text, length(content) < 5 AS is_short_text,
    CASE WHEN regexp_full_match("at", '{TIME}') THEN TRY_CAST("at" AS TIMESTAMP) END AS at_parsed,
    CASE WHEN regexp_full_match(replied_at, '{TIME}') THEN TRY_CAST(replied_at AS TIMESTAMP) END AS replied_at_parsed,
    trim(regexp_replace(regexp_replace(trim(lower(content), {WS}), 'https?://\\S+|www\\.\\S+', ' ', 'g'),
      '\\s+', ' ', 'g'), {WS}) AS content_clean
  FROM typed
), worded AS (
  SELECT *, md5(content_clean) AS text_hash,
    CASE WHEN length(content_clean) < 5 THEN 'unknown' ELSE COALESCE(declared_lang, 'unknown') END AS detected_lang,
    CASE WHEN {contains_any('content_clean', V.POSITIVE_KEYWORDS)} AND NOT {contains_any('content_clean', V.NEGATIVE_KEYWORDS)}
           THEN 'positive'
         WHEN {contains_any('content_clean', V.NEGATIVE_KEYWORDS)} AND NOT {contains_any('content_clean', V.POSITIVE_KEYWORDS)}
           THEN 'negative'
         ELSE 'neutral' END AS sentiment_keyword,
    date_trunc('hour', at_parsed) AS hour_bucket
  FROM derived
), labelled AS MATERIALIZED (
  SELECT *, detected_lang = 'en' AS is_en,
    (content_clean = '' OR NOT regexp_matches(content_clean, '\\p{{L}}')
      OR (length(content_clean) >= 6 AND len(list_distinct(string_split(content_clean, ''))) <= 2)
      OR (length(content_clean) <= 4 AND content_clean IN ({listed(V.LOW_INFORMATION_WORDS)}))
      OR is_short_text OR is_empty_text) AS is_noise,
    (score IS NULL OR at_parsed IS NULL) AS is_missing_key_fields,
    COALESCE((score <= 2 AND sentiment_keyword = 'positive') OR (score >= 4 AND sentiment_keyword = 'negative'), FALSE)
      AS is_inconsistent_rating
  FROM worded
)"""

FLAGGED = """hourly AS (
  SELECT hour_bucket, COUNT(*) AS hourly_count FROM labelled WHERE hour_bucket IS NOT NULL GROUP BY hour_bucket
), threshold AS (
  SELECT COALESCE(quantile_cont(hourly_count, 0.95), 0) AS busy_from FROM hourly
), copies AS (
  SELECT text_hash, COUNT(*) AS dup_text_count FROM labelled GROUP BY text_hash
), timed AS (
  SELECT l.*, COALESCE(h.hourly_count, 0) AS hourly_count, COALESCE(h.hourly_count, 0) >= t.busy_from AS is_time_anomaly,
    c.dup_text_count
  FROM labelled l CROSS JOIN threshold t LEFT JOIN hourly h ON h.hour_bucket = l.hour_bucket
  JOIN copies c ON c.text_hash = l.text_hash
), flagged AS MATERIALIZED (
  SELECT *, dup_text_count >= 3 OR (content_len <= 6 AND thumbs_up_count = 0) OR is_time_anomaly AS is_spam_bot_suspect
  FROM timed
)"""

# The clean tables, on top of the row-level columns only or of all flags.
KEPT = """firsts AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY ingest_seq) AS rn FROM {source}
), kept AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM firsts WHERE rn = 1 AND NOT is_empty_text AND NOT is_short_text
), kept_en AS (
  SELECT * FROM kept WHERE is_en
)"""

BATCH_FLAGGED = """hourly AS (
  SELECT ingest_date AS run_ts, hour_bucket, COUNT(*) AS hourly_count FROM labelled WHERE hour_bucket IS NOT NULL GROUP BY 1, 2
), threshold AS (
  SELECT run_ts, quantile_cont(hourly_count, 0.95) AS busy_from FROM hourly GROUP BY run_ts
), copies AS (
  SELECT ingest_date AS run_ts, text_hash, COUNT(*) AS dup_text_count FROM labelled GROUP BY 1, 2
), timed AS (
  SELECT l.*, l.ingest_date AS run_ts, COALESCE(h.hourly_count, 0) AS hourly_count,
    COALESCE(h.hourly_count, 0) >= COALESCE(t.busy_from, 0) AS is_time_anomaly, c.dup_text_count
  FROM labelled l LEFT JOIN threshold t ON t.run_ts = l.ingest_date
  LEFT JOIN hourly h ON h.hour_bucket = l.hour_bucket AND h.run_ts = l.ingest_date
  JOIN copies c ON c.text_hash = l.text_hash AND c.run_ts = l.ingest_date
), flagged AS MATERIALIZED (
  SELECT *, dup_text_count >= 3 OR (content_len <= 6 AND thumbs_up_count = 0) OR is_time_anomaly AS is_spam_bot_suspect
  FROM timed
), firsts AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY run_ts, review_id ORDER BY ingest_seq) AS rn FROM flagged
), kept AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM firsts WHERE rn = 1 AND NOT is_empty_text AND NOT is_short_text
), kept_en AS (
  SELECT * FROM kept WHERE is_en
)"""


def on_raw(body: str) -> str:
    return f"WITH {RAW}\n{body}"


def on_labelled(body: str) -> str:
    return f"WITH {RAW}, {LABELLED}\n{body}"


def on_flagged(body: str) -> str:
    return f"WITH {RAW}, {LABELLED}, {FLAGGED}\n{body}"


def on_kept(body: str) -> str:
    return f"WITH {RAW}, {LABELLED}, {KEPT.format(source='labelled')}\n{body}"


def on_kept_flagged(body: str) -> str:
    return f"WITH {RAW}, {LABELLED}, {FLAGGED}, {KEPT.format(source='flagged')}\n{body}"


def on_batches(ctes: str, body: str) -> str:
    more = f", {ctes}" if ctes else ""
    return f"WITH {RAW}, {LABELLED}, {BATCH_FLAGGED}{more}\n{body}"
