"""Section tables A to E: ratings, lengths, apps, days, languages, words and risk flags.

A (value, count) table that feeds several aggregates is written to the shared folder first, so the
reviews are read once for all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import stats, text, values
from ..sources.shared import settle
from .keyed import first_per_key, top_n_per_key, with_scalar

APP = ["app_id", "app_name"]
STARS = [1, 2, 3, 4, 5]


def _known_apps(df: DataFrame) -> DataFrame:
    """Groups with a null key are left out of every per-app table."""
    return df.filter(F.col("app_id").isNotNull() & F.col("app_name").isNotNull())


# ---- A: ratings and lengths ------------------------------------------------------------------

def rating_distribution(df: DataFrame) -> DataFrame:
    return df.filter(F.col("score").isNotNull()).groupBy("score").agg(F.count("*").alias("count"))


def rating_distribution_dense(df: DataFrame) -> DataFrame:
    """Stars 1 to 5 with zero for stars nobody gave."""
    stars = df.sparkSession.range(1, 6).select(F.col("id").cast("double").alias("score"))
    counts = rating_distribution(df)
    return stars.join(counts, "score", "left").select("score", values.zero_if_null(F.col("count")).alias("count"))


def rating_counts_by_app(df: DataFrame) -> DataFrame:
    """App by star counts. An app with only odd scores stays as a row of zeros."""
    rows = _known_apps(df).filter(F.col("score").isNotNull())
    return rows.groupBy(*APP).agg(*[F.count_if(F.col("score") == s).alias(f"star_{s}") for s in STARS])


def mean_score_by_app(df: DataFrame) -> DataFrame:
    return _known_apps(df).groupBy(*APP).agg(
        F.avg("score").alias("mean_score"), F.count("score").alias("n_scores")
    )


def length_summary(df: DataFrame) -> DataFrame:
    """count, mean, std (n-1), min, median, p90, p95, max as (stat, value) rows."""
    freq = settle(stats.frequencies(df, "content_len"), "lengths")
    head = freq.agg(
        F.sum("n").alias("count"), stats.weighted_mean().alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        stats.quantiles([0.5, 0.9, 0.95]).alias("q"),
    )
    spread = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2)))
    # The second look at the frequency table centres on the mean, which keeps the variance stable.
    deviation = with_scalar(freq, head.select("mean", "count")).agg(
        F.when(F.max("count") > 1, F.sqrt(spread / (F.max("count") - 1))).alias("std")
    )
    one = with_scalar(head, deviation)
    named = [("count", F.col("count")), ("mean", F.col("mean")), ("std", F.col("std")), ("min", F.col("min")),
             ("50%", F.col("q")[0]), ("90%", F.col("q")[1]), ("95%", F.col("q")[2]), ("max", F.col("max"))]
    rows = [F.struct(F.lit(k).alias("stat"), c.cast("double").alias("value")) for k, c in named]
    return one.select(F.inline(F.array(*rows)))


def length_stats_by_rating(df: DataFrame) -> DataFrame:
    freq = stats.frequencies(df.filter(F.col("score").isNotNull()), "content_len", ["score"])
    return freq.groupBy("score").agg(
        stats.weighted_mean().alias("mean_len"), stats.quantile(0.5).alias("median_len"), F.sum("n").alias("n_rows")
    )


def scale_chain(raw: DataFrame, all_rows: DataFrame, en_rows: DataFrame) -> DataFrame:
    """Row counts along the chain; an empty stage shows null, except the last."""
    def stage(name, df, null_when_empty=True):
        n = F.count("*")
        return df.agg((F.nullif(n, F.lit(0)) if null_when_empty else n).alias("rows")).select(
            F.lit(name).alias("stage"), "rows")

    return (
        stage("raw", raw).unionByName(stage("after_P0_all_languages", all_rows))
        .unionByName(stage("after_P0_english_only", en_rows, False))
    )


def _metric_rows(one: DataFrame, names: list[str], **extra: dict[str, str]) -> DataFrame:
    rows = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"),
                 *[F.lit(v[n]).alias(k) for k, v in extra.items()])
        for n in names
    ]
    return one.select(F.inline(F.array(*rows)))


def quality_flag_rates(df: DataFrame) -> DataFrame:
    """Noise and reply rates; a table without the flag reports null."""
    def mean_of(name):
        return values.rate(F.col(name)) if name in df.columns else F.lit(None)

    one = df.agg(mean_of("is_noise").alias("noise_rate"), mean_of("has_dev_reply").alias("has_dev_reply_rate"))
    return _metric_rows(one, ["noise_rate", "has_dev_reply_rate"])


def score_by_dev_reply(df: DataFrame) -> DataFrame:
    return df.filter(F.col("has_dev_reply").isNotNull()).groupBy("has_dev_reply").agg(
        F.avg("score").alias("mean_score"), F.count("score").alias("n_scores")
    )


# ---- B: apps, days, repeated texts -----------------------------------------------------------

def per_app_stats(df: DataFrame) -> DataFrame:
    return (
        _known_apps(df).groupBy(*APP)
        .agg(F.count("review_id").alias("rows"), F.avg("score").alias("mean_score"),
             F.avg("content_len").alias("mean_len"))
        .orderBy(F.desc("rows"), "app_id", "app_name")
    )


def score_skew_by_app(df: DataFrame) -> DataFrame:
    skewed = _known_apps(df).groupBy(*APP).agg(stats.sample_skewness(F.col("score")).alias("score_skew"))
    return skewed.orderBy(F.asc_nulls_last("score_skew"), "app_id", "app_name")


def daily_volume(df: DataFrame, ts: str = "at_parsed") -> DataFrame:
    """Rows per calendar day; days without rows are absent."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("reviews"))
    )


def daily_volume_or_note(df: DataFrame, ts: str = "at_parsed") -> DataFrame:
    """Daily volume, or a one-row note when no time could be parsed."""
    days = daily_volume(df, ts)
    if days.isEmpty():
        return df.sparkSession.createDataFrame([("no parseable time, daily volume skipped",)], "note string")
    return days


def flag_mean(df: DataFrame, name: str, metric: str) -> DataFrame:
    return _metric_rows(df.agg(values.rate(F.col(name)).alias(metric)), [metric])


def flag_rows(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Rows whose flag is set, reduced to the listed columns that exist."""
    return df.filter(values.flag(F.col(name))).select(*values.existing(df, columns))


def first_flag_rows(df: DataFrame, name: str, columns: list[str], n: int) -> DataFrame:
    """The first ``n`` flagged rows in file order."""
    hits = df.filter(values.flag(F.col(name))).orderBy("ingest_seq").limit(n)
    return hits.select(*values.existing(df, columns))


def inconsistent_sample(df: DataFrame, n: int = 15) -> DataFrame:
    columns = ["app_name", "score", "content", "sentiment_keyword", "is_inconsistent_rating"]
    return first_flag_rows(df, "is_inconsistent_rating", columns, n)


def spam_sample(df: DataFrame, n: int = 20) -> DataFrame:
    columns = ["app_name", "score", "content_len", "content", "is_spam_bot_suspect", "text_hash"]
    return first_flag_rows(df, "is_spam_bot_suspect", columns, n)


def top_text_hashes(df: DataFrame, k: int = 20) -> DataFrame:
    counts = df.groupBy("text_hash").agg(F.count("*").alias("duplicate_count"))
    return counts.orderBy(F.desc("duplicate_count"), "text_hash").limit(k)


def top_duplicate_texts(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent texts with their first occurrence.

    Only hashes are shuffled for the count. The example text is then fetched for the ``k`` winners.
    """
    return with_examples(top_text_hashes(df, k), df.select("text_hash", "content", "ingest_seq"))


def with_examples(hashes: DataFrame, rows: DataFrame) -> DataFrame:
    """A few hashes left joined with the first content of each among ``rows``; null where it has none.

    Positions are compared first, so texts are read for one row per hash only.
    """
    few = hashes.select(F.col("text_hash").alias("wanted"))
    firsts = rows.join(few, F.col("text_hash") == F.col("wanted"), "left_semi").groupBy("text_hash").agg(
        F.min("ingest_seq").alias("ingest_seq"))
    examples = rows.join(firsts, ["text_hash", "ingest_seq"], "left_semi").select("text_hash", "content")
    return hashes.join(examples, "text_hash", "left")


# ---- C: languages ----------------------------------------------------------------------------

def language_counts(df: DataFrame) -> DataFrame:
    code = text.strip(F.coalesce("detected_lang", F.lit(V.UNKNOWN_LANGUAGE)))
    counts = df.groupBy(code.alias("detected_lang_code")).agg(F.count("*").alias("count"))
    return counts.select(
        text.language_name(F.col("detected_lang_code")).alias("language_name_en"), "count", "detected_lang_code"
    )


def language_top_and_other(counts: DataFrame, top: int = V.TOP_LANGUAGES) -> DataFrame:
    """Counts by display name: the leading names, then one row for all others, with shares.

    Works on the grouped language table, which has one row per language code.
    """
    names = counts.groupBy("language_name_en").agg(F.sum("count").alias("count"))
    leaders = names.orderBy(F.desc("count"), "language_name_en").limit(top)
    marked = names.join(
        F.broadcast(leaders.select("language_name_en", F.lit(True).alias("leads"))), "language_name_en", "left"
    )
    label = F.when(F.col("leads"), F.col("language_name_en")).otherwise(F.lit(V.OTHER_LANGUAGES_LABEL))
    grouped = marked.groupBy(label.alias("language")).agg(F.sum("count").alias("count"))
    total = names.agg(F.sum("count").alias("total"))
    return with_scalar(grouped, total).select("language", "count", (F.col("count") / F.col("total")).alias("share"))


def english_subset(all_rows: DataFrame, quality: DataFrame) -> DataFrame:
    """English share measured on the clean table next to four rows of the quality report."""
    measured = all_rows.agg(
        F.round(values.rate(F.col("is_en")), 6).alias("value"), F.count("*").alias("n_rows")
    ).select(F.lit("english_share_on_clean_all").alias("metric"), "value", F.lit("clean table").alias("source"), "n_rows")
    kept = metric_subset(quality).select(
        "metric", "value", F.lit("quality report").alias("source"), F.lit(None).cast("bigint").alias("n_rows"))
    return measured.unionByName(kept)


def metric_subset(quality: DataFrame) -> DataFrame:
    names = ["english_rate_after_p0", "clean_en_rows", "clean_all_rows", "raw_rows"]
    return quality.filter(F.col("metric").isin(names)).select("section", "metric", "value")


# ---- D: words --------------------------------------------------------------------------------

def tokens(df: DataFrame, *keep: str, drop_stop_words: bool = True) -> DataFrame:
    """One row per word of the clean text (or the content when there is no clean text)."""
    source = "content_clean" if "content_clean" in df.columns else "content"
    out = df.select(*keep, F.explode(text.words(F.col(source))).alias("token"))
    return out.filter(~F.col("token").isin(V.STOP_WORDS)) if drop_stop_words else out


def top_words(df: DataFrame, k: int = 30) -> DataFrame:
    counts = tokens(df).groupBy("token").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "token").limit(k)


def star_band() -> Column:
    return F.when(F.col("score").isin(1.0, 2.0), "low").when(F.col("score") == 5.0, "high")


def star_bands(df: DataFrame) -> DataFrame:
    """Low (1 or 2 stars) and high (5 stars) rows; all others are left out."""
    return df.withColumn("band", star_band()).filter(F.col("band").isNotNull())


def band_word_counts(df: DataFrame) -> DataFrame:
    return tokens(star_bands(df), "band").groupBy("band", "token").agg(F.count("*").alias("n"))


def top_words_low_vs_high(df: DataFrame, k: int = 25) -> DataFrame:
    """The leading words of both bands side by side, from one pass over the text."""
    counts = band_word_counts(df)
    leaders = top_n_per_key(counts, ["band"], [F.desc("n"), F.asc("token")], k)
    return leaders.groupBy("token").agg(
        F.max(F.when(F.col("band") == "low", F.col("n"))).alias("low_star_1_2"),
        F.max(F.when(F.col("band") == "high", F.col("n"))).alias("high_star_5"),
    ).orderBy("token")


def align_word_lists(low: DataFrame, high: DataFrame) -> DataFrame:
    """Two (token, count) lists next to each other, sorted by token."""
    left = low.select("token", F.col("count").alias("low_star_1_2"))
    right = high.select("token", F.col("count").alias("high_star_5"))
    return left.join(right, "token", "full_outer").orderBy("token")


# ---- E: risk flags ---------------------------------------------------------------------------

def risk_rates(df: DataFrame) -> DataFrame:
    one = df.agg(values.rate(F.col("is_time_anomaly")).alias("time_anomaly_rate"),
                 values.rate(F.col("is_spam_bot_suspect")).alias("spam_bot_suspect_rate"))
    notes = {"time_anomaly_rate": "share of rows in busy hours", "spam_bot_suspect_rate": "combined heuristic"}
    return _metric_rows(one, list(notes), note=notes)


def flag_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per flag value; a value that never occurs is listed with zero."""
    one = df.agg(F.count_if(~values.flag(F.col(name))).alias("n_false"), F.count_if(F.col(name)).alias("n_true"))
    rows = [F.struct(F.lit(b).alias("flag"), F.col(c).alias("n")) for b, c in ((False, "n_false"), (True, "n_true"))]
    return one.select(F.inline(F.array(*rows)))


# ---- chart data ------------------------------------------------------------------------------

def histogram(freq: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins over a frequency table, empty bins included, last bin closed on the right."""
    lo, hi = F.min("value").cast("double"), F.max("value").cast("double")
    ends = freq.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))).cast("bigint")
    counts = with_scalar(freq, ends).groupBy(F.least(place, F.lit(bins - 1).cast("bigint")).alias("bin")).agg(
        F.sum("n").alias("n"))
    frame = with_scalar(freq.sparkSession.range(bins).withColumnRenamed("id", "bin"), ends).filter("lo IS NOT NULL")
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * width).alias("bin_from"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_to"), values.zero_if_null(F.col("n")).alias("rows"),
    )


def length_histogram(df: DataFrame, bins: int = 60) -> DataFrame:
    return histogram(settle(stats.frequencies(df, "content_len"), "lengths"), bins)


def hourly_count_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram of rows by the volume of their hour, clipped at the 99th percentile."""
    freq = settle(stats.frequencies(df, "hourly_count"), "hour-counts")
    cap = freq.agg(stats.quantile(0.99).alias("cap"))
    clipped = with_scalar(freq, cap).select(F.least(F.col("value"), F.col("cap")).alias("value"), "n")
    return histogram(clipped, bins)


def box_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and whiskers at 1.5 interquartile ranges per group, outliers left out of the whiskers."""
    freq = settle(stats.frequencies(df.filter(F.col(by).isNotNull()), value, [by]), "box-values")
    boxes = freq.groupBy(by).agg(F.sum("n").alias("n"), stats.quantiles([0.25, 0.5, 0.75]).alias("q"))
    boxes = boxes.select(by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    joined = freq.drop("n").join(boxes, by)
    inside_low = F.min(F.when(F.col("value") >= F.col("q1") - reach, F.col("value"))).cast("double")
    inside_high = F.max(F.when(F.col("value") <= F.col("q3") + reach, F.col("value"))).cast("double")
    return joined.groupBy(by, "n", "q1", "median", "q3").agg(
        inside_low.alias("low"), inside_high.alias("high")
    ).select(by, "n", F.least("low", "q1").alias("whisker_low"), "q1", "median", "q3",
             F.greatest("high", "q3").alias("whisker_high"))


def length_boxes_by_rating(df: DataFrame) -> DataFrame:
    return box_summary(df.filter(F.col("score").isin(1.0, 2.0, 3.0, 4.0, 5.0)), "content_len", "score")


def score_boxes_by_app(df: DataFrame) -> DataFrame:
    return box_summary(df, "score", "app_name")


def union_frames(frames: list[DataFrame]) -> DataFrame | None:
    """Concatenate frames by column name, missing columns null; nothing to concatenate gives None."""
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
