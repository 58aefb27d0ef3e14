"""Joins and rankings by key that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

# Up to so many facts (fixed-width keys of a settled table) the join is left to Spark, which knows their size.
BROADCAST_ROWS = 1_000_000
# A key is hot above 1/1000 of all rows, so there are fewer than a thousand hot keys.
HOT_SHARE = 1000
# Number of slices that one key is ranked in before its final ranking.
SLICES = 256


def attach_facts(df: DataFrame, facts: DataFrame, keys: list[str], weight: str, spread: str,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join one row of facts per key to every row of ``df``; null keys match null keys.

    ``facts`` is an aggregate of ``df`` and is written to the shared folder first, so its real
    size is known before the join is chosen:

    * up to ``broadcast_rows`` facts: Spark chooses by their measured size, usually a broadcast;
    * more: the hot keys (``weight`` above 1/1000 of the total, hence fewer than 1000 of them)
      are joined by broadcast, and only the others by shuffle. Rows already served get a slot
      from ``spread`` instead of their key, which matches nothing, so no task gets a hot group.
    """
    facts = settle(facts, "facts")
    values = [c for c in facts.columns if c not in keys]
    right = facts.select(*[F.col(k).alias(f"r_{k}") for k in keys], *values)
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys])
    if facts.count() <= broadcast_rows:
        return df.join(right, on, "left").drop(*[f"r_{k}" for k in keys])

    total = facts.agg(F.sum(weight)).first()[0]
    is_hot = F.col(weight) > total / HOT_SHARE
    hot = right.filter(is_hot).select(
        *[f"r_{k}" for k in keys], F.struct(*values).alias("hot"), F.lit(True).alias("is_hot")
    )
    cold = right.filter(~is_hot).select(
        *[f"r_{k}" for k in keys], F.struct(*values).alias("cold"), F.xxhash64(*[f"r_{k}" for k in keys]).alias("r_slot")
    )
    served = (
        df.join(F.broadcast(hot), on, "left")
        .drop(*[f"r_{k}" for k in keys])
        .withColumn("slot", F.when(F.col("is_hot"), F.xxhash64(spread)).otherwise(F.xxhash64(*keys)))
    )
    joined = served.join(cold, on & (F.col("slot") == F.col("r_slot")), "left")
    picked = [F.coalesce(F.col(f"hot.{v}"), F.col(f"cold.{v}")).alias(v) for v in values]
    return joined.select(*df.columns, *picked)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row of each key.

    ``row_number() = 1`` is planned with a group limit before the shuffle: every map task sends
    at most one row per key, so a hot key cannot flood one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_in_key", rank).filter(F.col("rank_in_key") == 1).drop("rank_in_key")


def in_slices(df: DataFrame) -> DataFrame:
    """Add ``slice_id``: all rows of one map task share a slice, and a key spreads over many slices."""
    return df.withColumn("slice_id", F.pmod(F.spark_partition_id(), F.lit(SLICES)))


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, row_id: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each key and their rank as ``rank_in_key``.

    Two levels: first per (key, slice), then per key. A row among the first ``n`` of its key is
    also among the first ``n`` of its slice, so the second ranking is exact. With ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) every map task is cut to ``n`` rows
    per key before the first shuffle. A hot key is ranked by many tasks at the first level and
    reaches the last one with at most ``SLICES * n`` rows.

    With a unique ``row_id``, and an order over keys and row id alone, only these columns are ranked,
    whatever ``n`` is; the other columns are joined to the winners.
    """
    first = F.row_number().over(Window.partitionBy(*keys, "slice_id").orderBy(*order))
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = in_slices(df.select(*keys, row_id) if row_id else df)
    winners = (
        ranked.withColumn("rank_in_key", first).filter(F.col("rank_in_key") <= n).drop("slice_id")
        .withColumn("rank_in_key", last).filter(F.col("rank_in_key") <= n)
    )
    if not row_id:
        return winners
    chosen = winners.select(F.col(row_id).alias("chosen_id"), "rank_in_key")
    return df.join(chosen, F.col(row_id) == F.col("chosen_id")).drop("chosen_id")


def with_row_numbers(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Consecutive numbers from 1 in a unique order, however many rows there are.

    Rows are written in range parts; a row's number is its place in its part, ranked there, behind the rows of the
    parts before it. Only the sizes of the parts, at most one per shuffle partition, reach the driver.
    """
    parts = settle(df.repartitionByRange(*order).withColumn("range_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("range_part").agg(F.count("*").alias("n")).orderBy("range_part").collect()
    before, shifts = 0, []
    for r in sizes:
        shifts.append((r["range_part"], before))
        before += r["n"]
    offsets = df.sparkSession.createDataFrame(shifts, "of_part int, rows_before bigint")
    place = F.row_number().over(Window.partitionBy("range_part").orderBy(*order))
    return parts.join(offsets, F.col("range_part") == F.col("of_part")).withColumn(name, F.col("rows_before") + place).select(
        *df.columns, name)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a global aggregate next to every row, as a scalar subquery: no join, no shuffle."""
    names = one_row.columns
    single = one_row.select(F.struct(*names)).scalar()
    return df.withColumn("scalar", single).select(*df.columns, *[F.col(f"scalar.{c}").alias(c) for c in names])
