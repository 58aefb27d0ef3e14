"""Spike days and time-window samples: exclusion, per-day cap, train and validation split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values
from .keyed import top_n_per_key, with_scalar


def spike_days(daily: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` busiest days with rank and share of all rows in percent.

    Ranks are positions in an array of at most ``top`` entries, so no global window is needed.
    """
    leaders = daily.orderBy(F.desc("reviews"), "day").limit(top)
    entry = F.struct((-F.col("reviews")).alias("order"), "day", "reviews")
    ranked = leaders.agg(F.array_sort(F.collect_list(entry)).alias("days")).select(
        F.posexplode("days").alias("pos", "d"))
    total = daily.agg(F.sum("reviews").alias("total"))
    return with_scalar(ranked, total).select(
        (F.col("pos") + 1).cast("bigint").alias("rank"), "d.day", "d.reviews",
        F.round(100 * F.col("d.reviews") / F.col("total"), 2).alias("share_of_all_reviews_pct"),
    )


def with_time(df: DataFrame) -> DataFrame:
    """Add ``ts`` and ``day``. ``at`` is parsed only when no row of the table has ``at_parsed``.

    The check stops at the first parsed time, so it costs one small task on a stored table.
    """
    ts = F.col("at_parsed")
    if "at" in df.columns and df.filter(ts.isNotNull()).select("at_parsed").isEmpty():
        ts = values.parse_time(F.col("at").cast("string"))
    return df.withColumn("ts", ts).withColumn("day", F.to_date("ts"))


def require_time(df: DataFrame, drop_missing: bool) -> DataFrame:
    """Drop rows without a time, or refuse the table when dropping is off."""
    if not drop_missing:
        bad = df.filter(F.col("ts").isNull()).count()
        if bad:
            raise ValueError(f"{bad} rows have no parseable time; drop them or repair the input")
    return df.filter(F.col("ts").isNotNull())


def spike_dates(spikes: DataFrame) -> DataFrame:
    """Distinct calendar dates of a spike list; the list must have a ``day`` column."""
    if "day" not in spikes.columns:
        raise ValueError("the spike list needs a 'day' column")
    return spikes.select(F.to_date("day").alias("day")).filter(F.col("day").isNotNull()).distinct()


def exclude_days(df: DataFrame, spikes: DataFrame, day: str = "day") -> DataFrame:
    """Drop rows whose day is listed; rows without a day stay.

    The list is a top-n table, so Catalyst sees its size and broadcasts it by its own threshold.
    """
    listed = spike_dates(spikes).withColumnRenamed("day", "listed_day")
    return df.join(listed, F.col(day) == F.col("listed_day"), "left_anti")


def per_day_cap(df: DataFrame, cap: int, seed: int = 42, row_id: str = "review_id") -> DataFrame:
    """At most ``cap`` rows per (app, day), picked by a seeded hash; smaller groups stay whole.

    The pick depends on seed and row id only, so a recomputed task picks the same rows. Row ids are
    unique, as they are in the clean tables; only keys and ids are ranked.
    """
    keyed = df.filter(F.col("app_id").isNotNull() & F.col("day").isNotNull())
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    picked = top_n_per_key(keyed, ["app_id", "day"], [ticket, F.col(row_id)], cap, row_id)
    return picked.drop("rank_in_key")


def time_split(df: DataFrame, cutoff: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff for training, from the cutoff on for validation; no time, no side."""
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.filter(F.col(ts) < at), df.filter(F.col(ts) >= at)


def side_of(cutoff: str, ts: str = "ts"):
    at = F.lit(cutoff).cast("timestamp_ntz")
    return F.when(F.col(ts) < at, "train").when(F.col(ts) >= at, "val")


def sample(df: DataFrame, spikes: DataFrame | None = None, cap: int | None = None, seed: int = 42,
           drop_missing: bool = True) -> DataFrame:
    """Time parsing, spike exclusion and cap in order; keeps ``ts`` and ``day`` for a later split."""
    if spikes is None and not cap:
        raise ValueError("nothing to do: give a spike list or a cap")
    rows = require_time(with_time(df), drop_missing)
    if spikes is not None:
        rows = exclude_days(rows, spikes)
    return per_day_cap(rows, cap, seed) if cap and cap > 0 else rows


def sampling_manifest(df: DataFrame, spikes: DataFrame | None = None, cap: int | None = None, cutoff: str | None = None, seed: int = 42,
                      source: str = "clean_en", generated_at: str | None = None,
                      outputs: dict[str, str] | None = None, drop_missing: bool = True) -> DataFrame:
    """One row describing a sampling run, ready for ``write_json``; it tells of the steps that ran and no others.

    Spike days, cap and cutoff are optional, but one of them is needed. Step counts are sums over (app, day) counts.
    Only the split of the capped rows needs the capped rows themselves. Without a cutoff there is one output.
    """
    cap = cap if cap and cap > 0 else None
    if spikes is None and cap is None and cutoff is None:
        raise ValueError("nothing to do: give a spike list, a cap or a cutoff")
    timed = with_time(df)
    rows = require_time(timed, drop_missing)
    one = timed.agg(F.count("*").alias("input_rows"), F.count_if(F.col("ts").isNull()).alias("dropped_missing_time"))
    left = F.col("input_rows") - F.col("dropped_missing_time")
    shown = [F.col("input_rows"), *([F.col("dropped_missing_time")] if drop_missing else [])]
    steps = []
    if spikes is not None:
        rows = exclude_days(rows, spikes)
        one = with_scalar(one, rows.agg(F.count("*").alias("rows_after_exclude_spikes")))
        one = with_scalar(one, spike_dates(spikes).agg(
            F.array_sort(F.collect_list(F.col("day").cast("string"))).alias("excluded_spike_days")))
        after = F.col("rows_after_exclude_spikes")
        shown += [F.col("excluded_spike_days"), after, (left - after).alias("dropped_for_spike_days")]
        left, steps = after, [*steps, "exclude_spikes"]
    if cap is not None:
        rows = per_day_cap(rows, cap, seed)
    if cap is not None or cutoff is not None:
        side = side_of(cutoff) if cutoff else F.lit(None)
        one = with_scalar(one, rows.agg(
            F.count("*").alias("rows_after_per_day_cap"), F.count_if(side == "train").alias("train_rows"),
            F.count_if(side == "val").alias("val_rows")))
    if cap is not None:
        after = F.col("rows_after_per_day_cap")
        shown += [F.lit(cap).alias("per_day_cap"), F.lit(seed).alias("random_state"), after, (left - after).alias("dropped_for_cap")]
        steps.append("per_day_cap")
    if cutoff is not None:
        shown += [F.lit(cutoff).alias("split_cutoff"), F.col("train_rows"), F.col("val_rows")]
        steps.append("time_split")
    stamp = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    where = outputs or ({"train": "train", "val": "val"} if cutoff else {"single": "single"})
    return one.select(
        F.lit(source).alias("source_file"), F.col("input_rows").alias("source_rows"), stamp.alias("generated_at_utc"),
        F.array(*[F.lit(s) for s in steps]).alias("steps"), *shown,
        F.struct(*[F.lit(v).alias(k) for k, v in where.items()]).alias("outputs"),
    )
