"""Queries over spike days, time-window samples and the collection step."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest, profile, sampling
from ..sources import readers
from ..sources.reviews import raw_reviews, table
from .base_sql import WS, on_kept, on_labelled, on_raw
from .registry import labelled, query, stored_en

DAILY = "daily AS (SELECT CAST(at_parsed AS DATE) AS day, COUNT(*) AS reviews FROM kept_en WHERE at_parsed IS NOT NULL GROUP BY 1)"
SPIKES = f", {DAILY}, spikes AS (SELECT day FROM daily ORDER BY reviews DESC, day LIMIT {{top}})"
TICKET = "md5('42:' || CAST({id} AS VARCHAR))"
CUTOFF = "2024-01-03"


def _spikes(rows, top=3):
    return sampling.spike_days(profile.daily_volume(rows), top)


def _rank_sql(daily: str) -> str:
    return f"""SELECT ROW_NUMBER() OVER (ORDER BY reviews DESC, day) AS rank, day, reviews,
  round(100 * reviews / (SELECT SUM(reviews) FROM {daily})::DOUBLE, 2) AS share_of_all_reviews_pct
  FROM {daily} ORDER BY reviews DESC, day LIMIT 10"""


@query("w_spike_rank", on_kept(f", {DAILY} {_rank_sql('daily')}"))
def w_spike_rank(spark, sf_dir):
    return _spikes(stored_en(spark, sf_dir), 10)


@query("w_spike_rank_orders", f"""WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS reviews FROM orders GROUP BY 1)
  {_rank_sql('daily')}""")
def w_spike_rank_orders(spark, sf_dir):
    return sampling.spike_days(profile.daily_volume(table(spark, sf_dir, "orders"), "o_orderdate"), 10)


@query("t_spike_days", on_kept(SPIKES.format(top=3) + "SELECT day FROM spikes"))
def t_spike_days(spark, sf_dir):
    return sampling.spike_dates(_spikes(stored_en(spark, sf_dir)))


@query("f_drop_null_time", on_kept("SELECT review_id, at_parsed AS ts FROM kept_en WHERE at_parsed IS NOT NULL"))
def f_drop_null_time(spark, sf_dir):
    return sampling.require_time(sampling.with_time(stored_en(spark, sf_dir)), True).select("review_id", "ts")


@query("f_exclude_spike_days", on_kept(SPIKES.format(top=3) + """SELECT review_id, CAST(at_parsed AS DATE) AS day FROM kept_en
  WHERE at_parsed IS NOT NULL AND CAST(at_parsed AS DATE) NOT IN (SELECT day FROM spikes)"""))
def f_exclude_spike_days(spark, sf_dir):
    rows = stored_en(spark, sf_dir)
    return sampling.sample(rows, _spikes(rows)).select("review_id", "day")


@query("j_spike_anti", on_kept(SPIKES.format(top=3) + """SELECT review_id, CAST(at_parsed AS DATE) AS day FROM kept_en
  WHERE at_parsed IS NULL OR CAST(at_parsed AS DATE) NOT IN (SELECT day FROM spikes)"""))
def j_spike_anti(spark, sf_dir):
    """The bare anti join: rows without a day stay."""
    rows = stored_en(spark, sf_dir)
    return sampling.exclude_days(sampling.with_time(rows), _spikes(rows)).select("review_id", "day")


CAPPED = ", ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY app_id, CAST(at_parsed AS DATE) ORDER BY " \
    + TICKET.format(id="review_id") + ", review_id) AS place FROM kept_en WHERE at_parsed IS NOT NULL{where})"


@query("w_per_day_cap", on_kept(CAPPED.format(where="") + "SELECT app_id, review_id, at_parsed AS ts FROM ranked WHERE place <= 2"))
def w_per_day_cap(spark, sf_dir):
    rows = sampling.sample(stored_en(spark, sf_dir), cap=2)
    return rows.select("app_id", "review_id", "ts").orderBy("ts", "review_id")


@query("w_per_day_cap_orders", f"""WITH ranked AS (SELECT o_orderpriority AS app_id, o_orderkey, CAST(o_orderdate AS DATE) AS day,
  ROW_NUMBER() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY {TICKET.format(id='o_orderkey')}, o_orderkey) AS place
  FROM orders) SELECT app_id, o_orderkey, day FROM ranked WHERE place <= 5""")
def w_per_day_cap_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("app_id"), "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return sampling.per_day_cap(rows, 5, row_id="o_orderkey")


@query("f_time_split", on_kept(f"""SELECT CASE WHEN at_parsed < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'val' END AS side, review_id
  FROM kept_en WHERE at_parsed IS NOT NULL"""))
def f_time_split(spark, sf_dir):
    train, val = sampling.time_split(sampling.with_time(stored_en(spark, sf_dir)), CUTOFF)
    return train.select(F.lit("train").alias("side"), "review_id").unionByName(
        val.select(F.lit("val").alias("side"), "review_id"))


@query("f_time_split_orders", """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'val' END AS side,
  COUNT(*) AS n, CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1""")
def f_time_split_orders(spark, sf_dir):
    side = sampling.side_of("1998-01-01", "o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(side.alias("side")).agg(
        F.count("*").alias("n"), F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("sink_json_manifest", on_kept(SPIKES.format(top=3) + CAPPED.format(
    where=" AND CAST(at_parsed AS DATE) NOT IN (SELECT day FROM spikes)") + f""", capped AS (SELECT * FROM ranked WHERE place <= 2)
SELECT 'clean_en' AS source_file, (SELECT COUNT(*) FROM kept_en) AS input_rows,
  (SELECT COUNT(*) FROM kept_en WHERE at_parsed IS NULL) AS dropped_missing_time,
  (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FROM spikes) AS excluded_spike_days,
  (SELECT COUNT(*) FROM ranked) AS rows_after_exclude_spikes,
  (SELECT COUNT(*) FROM kept_en WHERE at_parsed IS NOT NULL) - (SELECT COUNT(*) FROM ranked) AS dropped_for_spike_days,
  2 AS per_day_cap, 42 AS random_state, (SELECT COUNT(*) FROM capped) AS rows_after_per_day_cap,
  (SELECT COUNT(*) FROM ranked) - (SELECT COUNT(*) FROM capped) AS dropped_for_cap, '{CUTOFF}' AS split_cutoff,
  (SELECT COUNT(*) FROM capped WHERE at_parsed < TIMESTAMP '{CUTOFF}') AS train_rows,
  (SELECT COUNT(*) FROM capped WHERE at_parsed >= TIMESTAMP '{CUTOFF}') AS val_rows"""))
def sink_json_manifest(spark, sf_dir):
    """Write the manifest as JSON and read it back."""
    from ..sources.shared import new_path
    from ..sources.sinks import write_json
    rows = stored_en(spark, sf_dir)
    manifest = sampling.sampling_manifest(rows, _spikes(rows), 2, CUTOFF, generated_at="2024-02-01T00:00:00Z")
    path = new_path(spark, "manifest")
    write_json(manifest, path)
    back = spark.read.schema(manifest.schema).json(path)
    days = F.array_join("excluded_spike_days", ",").alias("excluded_spike_days")
    return back.select(
        "source_file", "input_rows", "dropped_missing_time", days, "rows_after_exclude_spikes", "dropped_for_spike_days",
        "per_day_cap", "random_state", "rows_after_per_day_cap", "dropped_for_cap", "split_cutoff", "train_rows", "val_rows")


@query("sink_json_manifest_single", on_kept(", ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY app_id, CAST(at_parsed AS DATE) ORDER BY "
    + TICKET.format(id="review_id") + """, review_id) AS place FROM kept_en WHERE at_parsed IS NOT NULL)
SELECT 'per_day_cap' AS steps, (SELECT COUNT(*) FROM kept_en) AS input_rows,
  (SELECT COUNT(*) FROM kept_en WHERE at_parsed IS NULL) AS dropped_missing_time,
  (SELECT COUNT(*) FROM ranked WHERE place <= 3) AS rows_after_per_day_cap,
  (SELECT COUNT(*) FROM ranked WHERE place > 3) AS dropped_for_cap, 'sample' AS single"""))
def sink_json_manifest_single(spark, sf_dir):
    """A run with a cap alone: one step, one output."""
    from ..sources.shared import new_path
    from ..sources.sinks import write_json
    manifest = sampling.sampling_manifest(stored_en(spark, sf_dir), cap=3, outputs={"single": "sample"})
    path = new_path(spark, "manifest")
    write_json(manifest, path)
    back = spark.read.schema(manifest.schema).json(path)
    return back.select(F.array_join("steps", ",").alias("steps"), "input_rows", "dropped_missing_time", "rows_after_per_day_cap",
                       "dropped_for_cap", "outputs.single")


# ---- collection ------------------------------------------------------------------------------

def plan_of(spark, sf_dir):
    """App plan with a target per app and one app that has no rows; ids come from the documents."""
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    planned = docs.select(
        F.col("source").alias("app_id"), F.concat(F.lit("App "), F.col("source")).alias("app_name"),
        (F.length("source") * 3 - 2).alias("target_reviews"))
    gone = docs.agg(F.max("source").alias("m")).select(
        F.concat(F.col("m"), F.lit("-gone")).alias("app_id"), F.lit(None).cast("string").alias("app_name"),
        F.lit(None).cast("int").alias("target_reviews"))
    blank = gone.select(F.lit("  ").alias("app_id"), "app_name", "target_reviews")
    return readers.app_plan(planned.unionByName(gone).unionByName(blank))


PLAN = """, docs AS (SELECT DISTINCT source FROM documents), plan AS (
  SELECT source AS app_id, 'App ' || source AS app_name, CAST(length(source) * 3 - 2 AS INT) AS target_reviews FROM docs
  UNION ALL SELECT MAX(source) || '-gone', MAX(source) || '-gone', 500 FROM docs)
"""


@query("scan_app_plan", "WITH " + PLAN.strip(", \n") + " SELECT app_id, app_name, target_reviews FROM plan")
def scan_app_plan(spark, sf_dir):
    """Write the plan as CSV and scan it with defaults filled in."""
    from ..sources.shared import new_path
    from ..sources.sinks import overwrite
    path = new_path(spark, "plan")
    overwrite(plan_of(spark, sf_dir), path, "csv")
    return readers.scan_app_plan(spark, path)


@query("newest_n_per_app", on_labelled(PLAN + """, ranked AS (
  SELECT l.app_id, l.review_id, l.ingest_seq, l.at_parsed, p.target_reviews,
    ROW_NUMBER() OVER (PARTITION BY l.app_id ORDER BY at_parsed DESC NULLS LAST, review_id, ingest_seq) AS newest_rank
  FROM labelled l JOIN plan p ON p.app_id = l.app_id)
SELECT app_id, review_id, ingest_seq, at_parsed, newest_rank FROM ranked WHERE newest_rank <= target_reviews"""))
def newest_n_per_app(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("app_id", "review_id", "ingest_seq", "at_parsed")
    newest = ingest.newest_n_per_app(rows, plan_of(spark, sf_dir))
    return newest.withColumn("newest_rank", F.col("newest_rank").cast("bigint"))


@query("ingest_per_app_counts", on_raw(PLAN + """SELECT p.app_id, p.app_name, COUNT(r.app_id) AS fetched,
  CASE WHEN COUNT(r.app_id) > 0 THEN 'fetched' ELSE 'no rows' END AS status
  FROM plan p LEFT JOIN raw r ON r.app_id = p.app_id GROUP BY p.app_id, p.app_name"""))
def ingest_per_app_counts(spark, sf_dir):
    return ingest.per_app_counts(raw_reviews(spark, sf_dir), plan_of(spark, sf_dir))


@query("raw_collection_metrics", on_raw(f""", enriched AS (
  SELECT *, trim(COALESCE(content, ''), {WS}) AS body, trim(COALESCE(reply_content, ''), {WS}) <> '' AS replied,
    ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY ingest_seq) AS rn FROM raw
), m AS (
  SELECT COUNT(*) AS n, COUNT(DISTINCT review_id) + MAX(CAST(review_id IS NULL AS INT)) AS ids,
    COUNT(*) FILTER (WHERE rn = 1 AND length(body) >= 5) AS clean_rows, AVG(CAST(body = '' AS INT)) AS e,
    AVG(CAST(length(body) < 5 AS INT)) AS s, AVG(CAST("at" <> 'not-a-date' AS INT)) AS t,
    AVG(CAST(TRY_CAST(score AS DOUBLE) IS NOT NULL AS INT)) AS sc, AVG(CAST(review_id IS NULL AS INT)) AS mi,
    COUNT(DISTINCT CASE WHEN body = '' THEN '' ELSE md5(body) END) AS hashes, AVG(CAST(replied AS INT)) AS rep,
    COALESCE(AVG(CAST(replied_at NOT IN ('soon', 'not-a-date') AS INT)) FILTER (WHERE replied), 0) AS rt,
    COUNT(DISTINCT app_id) AS apps FROM enriched
)
SELECT 'total_rows' AS metric, CAST(n AS DOUBLE) AS value FROM m
UNION ALL SELECT 'unique_review_id_rows', ids FROM m UNION ALL SELECT 'clean_rows', clean_rows FROM m
UNION ALL SELECT 'dedup_keep_ratio', round(ids / n::DOUBLE, 4) FROM m UNION ALL SELECT 'empty_text_ratio', round(e, 4) FROM m
UNION ALL SELECT 'short_text_ratio_lt5', round(s, 4) FROM m UNION ALL SELECT 'parseable_time_ratio', round(t, 4) FROM m
UNION ALL SELECT 'parseable_score_ratio', round(sc, 4) FROM m UNION ALL SELECT 'missing_review_id_ratio', round(mi, 4) FROM m
UNION ALL SELECT 'duplicate_review_id_rows', n - ids FROM m UNION ALL SELECT 'duplicate_text_hash_rows', n - hashes FROM m
UNION ALL SELECT 'has_dev_reply_ratio', round(rep, 4) FROM m
UNION ALL SELECT 'parseable_replied_at_when_reply_ratio', round(rt, 4) FROM m UNION ALL SELECT 'apps_count', apps FROM m"""))
def raw_collection_metrics(spark, sf_dir):
    return ingest.raw_collection_metrics(raw_reviews(spark, sf_dir))
