"""Clean step: typed columns, language, quality flags, de-duplication and the quality report.

Every function maps a DataFrame to a DataFrame. ``by`` names batch columns (for example
``run_ts``): with it each batch is treated as a run of its own; without it the table is one run.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import stats, text, values
from ..sources.shared import settle
from .keyed import attach_facts, with_scalar
from .language import LanguageModel, with_detected_language


def derive(raw: DataFrame) -> DataFrame:
    """Typed and normalised columns of a raw review table."""
    id_text = F.coalesce(F.col("review_id"), F.lit("nan"))  # null ids are one id, as text
    reply = F.col("has_dev_reply") if "has_dev_reply" in raw.columns else text.has_text(F.col("reply_content"))
    typed = raw.select(
        *[c for c in raw.columns if c not in
          ("review_id", "score", "thumbs_up_count", "content", "has_dev_reply")],
        id_text.alias("review_id"),
        values.to_number(F.col("score")).alias("score"),
        values.to_count(F.col("thumbs_up_count")).alias("thumbs_up_count"),
        text.normalize_text(F.col("content")).alias("content"),
        reply.alias("has_dev_reply"),
    )
    content = F.col("content")
    sized = typed.select(
        "*",
        F.length(content).cast("bigint").alias("content_len"),
        (content == "").alias("is_empty_text"),
        values.parse_time(F.col("at")).alias("at_parsed"),
        values.parse_time(F.col("replied_at")).alias("replied_at_parsed"),
        text.preprocess_text(content).alias("content_clean"),
    )
    return sized.select(
        "*",
        (F.col("content_len") < V.SHORT_TEXT_LEN).alias("is_short_text"),
        text.text_hash(F.col("content_clean")).alias("text_hash"),
    )


def with_language(df: DataFrame, language: Column | str = "declared_lang") -> DataFrame:
    """``detected_lang`` from a language column; texts below five characters stay unknown."""
    language = F.col(language) if isinstance(language, str) else language
    code = F.when(F.length("content_clean") < V.SHORT_TEXT_LEN, F.lit(V.UNKNOWN_LANGUAGE)).otherwise(
        F.coalesce(language, F.lit(V.UNKNOWN_LANGUAGE))
    )
    return df.withColumn("detected_lang", code).withColumn("is_en", F.col("detected_lang") == "en")


def with_row_flags(df: DataFrame, word_boundary: bool = False) -> DataFrame:
    """Flags that need nothing but the row itself."""
    clean = F.col("content_clean")
    labelled = df.select(
        "*",
        (text.is_noise(clean) | F.col("is_short_text") | F.col("is_empty_text")).alias("is_noise"),
        # Ids and content are never null at this point, which leaves score and time.
        (F.col("score").isNull() | F.col("at_parsed").isNull()).alias("is_missing_key_fields"),
        text.sentiment_keyword(clean, word_boundary).alias("sentiment_keyword"),
        values.floor_hour(F.col("at_parsed")).alias("hour_bucket"),
    )
    return labelled.withColumn(
        "is_inconsistent_rating", text.inconsistent_rating(F.col("score"), F.col("sentiment_keyword"))
    )


def hourly_volume(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per hour; hours without rows are absent."""
    return (
        df.filter(F.col("hour_bucket").isNotNull())
        .groupBy(*(by or []), "hour_bucket")
        .agg(F.count("*").alias("hourly_count"))
    )


def busy_hour_threshold(hourly: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The 95th percentile over hours, not over rows.

    The quantile reads (count, frequency) pairs. Distinct counts k add up to at least k*k/2 rows,
    so N rows give at most sqrt(2N) pairs.
    """
    freq = stats.frequencies(hourly, "hourly_count", by)
    return freq.groupBy(*(by or [])).agg(stats.quantile(V.BUSY_HOUR_QUANTILE).alias("busy_from"))


def hour_facts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per hour with its count and whether it is busy, plus one row for a missing time.

    Without any parseable time the threshold is 0, so every row counts as anomalous. Hours are counted in one pass
    and stored; the threshold and the facts both read that table.
    """
    by = by or []
    counts = df.groupBy(*by, "hour_bucket").agg(F.count("*").alias("rows_in_hour"))
    return hour_facts_of(settle(counts, "hours"), by)


def hour_facts_of(counts: DataFrame, by: list[str]) -> DataFrame:
    """Hour facts from stored counts ``hour_bucket, rows_in_hour``."""
    hourly = counts.withColumn(
        "hourly_count", F.when(F.col("hour_bucket").isNull(), F.lit(0)).otherwise(F.col("rows_in_hour"))
    )
    threshold = busy_hour_threshold(hourly.filter(F.col("hour_bucket").isNotNull()), by)
    if by:
        scored = hourly.join(threshold, by, "left")
    else:
        scored = with_scalar(hourly, threshold)
    busy = F.col("hourly_count") >= F.coalesce(F.col("busy_from"), F.lit(0.0))
    return scored.select(*by, "hour_bucket", "hourly_count", "rows_in_hour", busy.alias("is_time_anomaly"))


def duplicate_facts(df: DataFrame, by: list[str] | None = None,
                    at_least: int = V.DUPLICATE_TEXT_MIN) -> DataFrame:
    """Texts seen ``at_least`` times, counted with map-side combine.

    A window per hash would send a hot text to one task; this count does not.
    """
    counts = df.groupBy(*(by or []), "text_hash").agg(F.count("*").alias("dup_text_count"))
    return counts.filter(F.col("dup_text_count") >= at_least)


def with_time_anomaly(df: DataFrame, by: list[str] | None = None, facts: DataFrame | None = None,
                      **join) -> DataFrame:
    """``hourly_count`` and ``is_time_anomaly``; rows without a time get count 0."""
    by = by or []
    facts = hour_facts(df, by) if facts is None else facts
    return attach_facts(df, facts, [*by, "hour_bucket"], "rows_in_hour", "ingest_seq", **join).drop("rows_in_hour")


def with_duplicate_counts(df: DataFrame, by: list[str] | None = None, facts: DataFrame | None = None,
                          **join) -> DataFrame:
    """``dup_text_count`` for repeated texts, null for texts below the repeat limit."""
    facts = duplicate_facts(df, by) if facts is None else facts
    return attach_facts(df, facts, [*(by or []), "text_hash"], "dup_text_count", "ingest_seq", **join)


def with_spam_suspect(df: DataFrame, by: list[str] | None = None, facts: DataFrame | None = None,
                      **join) -> DataFrame:
    """Repeated text, or tiny text without thumbs, or a busy hour."""
    tiny = (F.col("content_len") <= V.TINY_TEXT_LEN) & (F.col("thumbs_up_count") == 0)
    suspect = F.col("dup_text_count").isNotNull() | tiny | F.col("is_time_anomaly")
    counted = with_duplicate_counts(df, by, facts, **join)
    return counted.withColumn("is_spam_bot_suspect", suspect).drop("dup_text_count")


def label(raw: DataFrame, language: Column | str | LanguageModel = "declared_lang") -> DataFrame:
    """Derived columns, language and row flags: everything that needs no other row.

    ``language`` is a trained model, whose detection decides, or a column that declares the language. With a model the
    derived rows are stored first, since detection and flags both read them.
    """
    if isinstance(language, LanguageModel):
        return with_row_flags(with_detected_language(settle(derive(raw), "derived"), language))
    return with_row_flags(with_language(derive(raw), language))


def flag_reviews(raw: DataFrame, by: list[str] | None = None, language: Column | str | LanguageModel = "declared_lang",
                 **join) -> DataFrame:
    """All flags, computed on the raw rows with repeats still in, before any row is dropped."""
    return flag_labelled(label(raw, language), by, **join)


def narrow(rows: DataFrame, *texts: str) -> DataFrame:
    """Labelled rows without their texts (but for those named), written once.

    Rates, histories and counts need the flags but not the texts. They read this table several
    times instead of scanning and parsing all text again.
    """
    wide = {"content", "content_clean", "reply_content", "at", "replied_at", "replied_at_parsed"}
    return settle(rows.drop(*(wide - set(texts))), "labelled")


def flag_labelled(rows: DataFrame, by: list[str] | None = None, **join) -> DataFrame:
    timed = with_time_anomaly(rows, by, hour_facts(rows, by), **join)
    return with_spam_suspect(timed, by, duplicate_facts(rows, by), **join)


def dedupe_first(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First row per review id in file order, found by its later repeats; ``ingest_seq`` is unique.

    Ids are counted with map-side combine, and only ids that occur again are joined to (id, sequence) rows. What goes
    is a list of sequence numbers of measured size: the rows themselves, with their texts, are neither sorted nor,
    unless most of a large table repeats, shuffled.
    """
    keys = [*(by or []), "review_id"]
    ids = df.select(*keys, "ingest_seq")
    counts = ids.groupBy(*[F.col(k).alias(f"r_{k}") for k in keys]).agg(
        F.min("ingest_seq").alias("first_seq"), F.count("*").alias("times"))
    again = settle(counts.filter("times > 1").drop("times"), "repeated-ids")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys])
    later = settle(ids.join(again, same).filter("ingest_seq > first_seq").select(F.col("ingest_seq").alias("later_seq")), "repeats")
    return df.join(later, F.col("ingest_seq") == F.col("later_seq"), "left_anti")


def clean_all(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """De-duplicate, then drop empty and short text. Missing scores and times are kept."""
    return dedupe_first(df, by).filter(~F.col("is_empty_text") & ~F.col("is_short_text"))


def clean_en(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return clean_all(df, by).filter("is_en")


def quality_metrics(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Quality numbers per run, one row each.

    Raw rates are over all rows, the later rates over the de-duplicated rows with real text. The
    first level combines each review id's rows on the map side and keeps the flags of its first
    row, so one pass gives both denominators and a hot id does no harm.
    """
    by = by or []
    first = {**first_row_flags(), "spam": F.col("is_spam_bot_suspect"), "anomaly": F.col("is_time_anomaly")}
    return quality_totals(per_id_counts(flagged, [*by, "review_id"], first), by)


def first_row_flags() -> dict[str, Column]:
    """What counts of the first row of an id, as far as the row itself tells."""
    return {
        "kept": ~F.col("is_empty_text") & ~F.col("is_short_text"), "en": F.col("is_en"), "noise": F.col("is_noise"),
        "inconsistent": F.col("is_inconsistent_rating"),
    }


def per_id_counts(rows: DataFrame, keys: list[str], first: dict[str, Column], *more: Column) -> DataFrame:
    """Sums over the rows of an id and values of its first row; combined on the map side."""
    sums = {
        "empty": F.col("is_empty_text"), "short": F.col("is_short_text"),
        "timed": F.col("at_parsed").isNotNull(), "scored": F.col("score").isNotNull(),
        "missing": F.col("is_missing_key_fields"),
    }
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in sums.items()],
        *[F.min_by(c, F.col("ingest_seq")).alias(f"first_{k}") for k, c in first.items()], *more)


def quality_totals(per_id: DataFrame, by: list[str]) -> DataFrame:
    """Quality numbers from counts per id."""
    rows = F.sum("n")
    kept = F.count_if(F.col("first_kept"))

    def over_rows(name):
        return F.round(F.sum(name) / rows, 4)

    def over_kept(name):
        hits = F.count_if(F.col("first_kept") & F.col(f"first_{name}"))
        return F.round(F.coalesce(F.try_divide(hits, kept), F.lit(0.0)), 4)

    return per_id.groupBy(*by).agg(
        rows.alias("raw_rows"),
        F.round((rows - F.count("*")) / rows, 4).alias("duplicate_rate"),
        over_rows("empty").alias("empty_text_rate"),
        over_rows("short").alias("short_text_rate_lt5"),
        over_rows("timed").alias("parseable_time_rate"),
        over_rows("scored").alias("parseable_score_rate"),
        kept.alias("clean_all_rows"),
        over_kept("en").alias("english_rate_after_p0"),
        over_kept("noise").alias("noise_rate_after_p0"),
        over_rows("missing").alias("missing_key_fields_rate"),
        over_kept("spam").alias("spam_bot_suspect_rate"),
        over_kept("inconsistent").alias("inconsistent_rating_rate"),
        over_kept("anomaly").alias("time_anomaly_rate"),
        F.count_if(F.col("first_kept") & F.col("first_en")).alias("clean_en_rows"),
    )


QUALITY_LAYOUT = [
    ("p0", ["raw_rows", "duplicate_rate", "empty_text_rate", "short_text_rate_lt5",
            "parseable_time_rate", "parseable_score_rate", "clean_all_rows"]),
    ("p1", ["english_rate_after_p0", "noise_rate_after_p0"]),
    ("p2", ["missing_key_fields_rate", "spam_bot_suspect_rate", "inconsistent_rating_rate", "time_anomaly_rate"]),
    ("output", ["clean_en_rows"]),
]


def quality_report(flagged: DataFrame, run_time: str, source: str) -> DataFrame:
    """Sixteen rows of (section, metric, value, detail); the two run rows carry text in ``detail``."""
    def entry(section, metric, value=None, detail=None):
        return F.struct(
            F.lit(section).alias("section"), F.lit(metric).alias("metric"),
            (value if value is not None else F.lit(None)).cast("double").alias("value"),
            F.lit(detail).cast("string").alias("detail"),
        )

    entries = [entry("run", "run_time", detail=run_time), entry("run", "raw_input_file", detail=source)]
    entries += [entry(s, m, F.col(m)) for s, metrics in QUALITY_LAYOUT for m in metrics]
    return quality_metrics(flagged).select(F.inline(F.array(*entries)))
