"""Mixing sources to target weights: weighted sampling without replacement by exponential keys, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

# Weights by the sources' order, repeating.
SOURCE_WEIGHTS = (5, 2, 1)
# No document is taken more often than this.
MOST_EPOCHS = 3
# The order within a source is cut twice into this many parts before anything is sorted.
PARTS = 1024


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sampling_key(id_text: Column, weight: Column, seed: int) -> Column:
    """Efraimidis-Spirakis key, -ln(u)/w with u in (0, 1) from the id: the smallest keys are drawn first."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_text)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def source_targets(sized: DataFrame) -> DataFrame:
    """Target words per source: shares by weight of all words, cut at three times the source, the excess reshared.

    Resharing until none is above is water filling: with sources ordered by (cap / weight), all before
    the first one that the common level does not fill get their cap. One row per source, null is one.
    """
    weight = F.lit(SOURCE_WEIGHTS[-1])
    for i, w in reversed(list(enumerate(SOURCE_WEIGHTS[:-1]))):
        weight = F.when(F.col("place") % len(SOURCE_WEIGHTS) == i, w).otherwise(weight)
    ranked = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", (F.col("source_size") * MOST_EPOCHS).cast("double"))
    )
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    every = Window.partitionBy()
    filled = (
        ranked.withColumn("before", F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(every).cast("double") - F.col("before")) / F.col("rest"))
        .withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(every))
    )
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return filled.select("source", "source_size", target.alias("target"))


def _first_over(sums: DataFrame, keys: list[str], part: str) -> DataFrame:
    """Per key the part in which the running sum passes ``budget``, and the sum before it."""
    order = Window.partitionBy(*keys).orderBy(part)
    run = sums.withColumn("upto", F.col("prior") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.filter(F.col("upto") > F.col("budget")).groupBy(*keys).agg(
        F.min_by(F.struct(F.col(part).alias(part), (F.col("upto") - F.col("words")).alias("prior")), part).alias("cut")
    ).select(*keys, f"cut.{part}", "cut.prior")


def row_hash(documents: DataFrame) -> Column:
    """A hash of all columns of a row but its mix."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns if c != "mix"])


def mix(documents: DataFrame, weight: Column, size: Column, seed: int = 9, id_column: str = "doc_id",
        source_column: str = "source", own: Column | None = None) -> DataFrame:
    """Decide how often each document is taken, so that each source comes near its target.

    ``weight``: positive quality weight of a row (null counts as 1); ``size``: its words; ``own``: a hash that tells
    rows of one id apart, by default of all columns. Size and hash should be columns
    made before any join, so that texts are not shuffled for them: sums and borders then read no text, which
    is moved at most once, for the result. Returns the input columns and a
    struct ``mix`` of ``size, source_size, target, copies, taken`` (``taken = copies * size``), which
    replaces an input column of that name.

    Every document of a source is taken ``floor(target / source_size)`` times (complete epochs). The
    rest of the budget goes to the documents first in key order, up to the one in whose middle the
    running sum passes it. Null sources form one source; null or empty texts have size 0 and take no
    words. Rows that share an id, or have none, are told apart by a hash of all their columns; of rows that are equal
    altogether as many are taken as the budget has room for. So repeated rows and null ids meet the target like others.

    A hot source is never sorted as a whole: running sums over parts of the key range find the part
    with the border, twice; only the distinct rows of that last part are ordered, with their numbers. All rows are then
    compared with one border per source.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns if c != "mix"]
    own = row_hash(documents) if own is None else own
    # Rows without an id would all have one key.
    id_text = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.concat(F.lit("#"), own.cast("string")))
    key = sampling_key(id_text, F.coalesce(weight, F.lit(1.0)), seed)
    share = (1 - F.exp(-F.col("key"))) * PARTS
    fields = documents.select(
        F.struct(*columns).alias("row"), F.col(f"`{source_column}`").alias("source"),
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), size.alias("size"), key.alias("key"), own.alias("own"),
    ).withColumn("part", F.least(F.floor(share), F.lit(PARTS - 1))).withColumn(
        "subpart", F.least(F.floor((share - F.col("part")) * PARTS), F.lit(PARTS - 1)))
    sized = settle(fields.drop("row"), "sized")
    targets = settle(source_targets(sized), "targets")
    epochs = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = targets.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))

    def same(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
        right = small.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in small.columns])
        on = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
        return df.join(right, on, how).drop(*[f"r_{k}" for k in keys])

    parts = same(sized.groupBy("source", "part").agg(F.sum("size").alias("words")), plan, ["source"])
    first = settle(same(_first_over(parts.withColumn("prior", F.lit(0.0)), ["source"], "part"),
                        plan.select("source", "budget"), ["source"]), "borders")
    subparts = same(sized, first, ["source", "part"]).groupBy("source", "part", "budget", "prior", "subpart").agg(
        F.sum("size").alias("words"))
    second = settle(same(_first_over(subparts, ["source", "part"], "subpart"),
                         plan.select("source", "budget"), ["source"]), "borders")
    # Equal rows are one row with a number; of the last one that is taken, so many as have their middle within the budget.
    order = Window.partitionBy("source").orderBy("key", "id", "size", "own").rowsBetween(Window.unboundedPreceding, -1)
    room = F.when(F.col("size") > 0, F.floor((F.col("budget") - F.col("before")) / F.col("size") + 0.5)).otherwise(
        F.when(F.col("before") <= F.col("budget"), F.col("equal")).otherwise(0))
    last = (
        same(sized, second, ["source", "part", "subpart"])
        .groupBy("source", "budget", "prior", "key", "id", "size", "own").agg(F.count("*").alias("equal"))
        .withColumn("before", F.col("prior") + F.coalesce(F.sum(F.col("size") * F.col("equal")).over(order), F.lit(0)))
        .withColumn("fit", F.least(room, F.col("equal"))).filter("fit > 0")
        .groupBy("source").agg(F.max(F.struct("key", "id", "size", "own", "fit", "equal")).alias("border"))
    )
    borders = settle(
        same(same(plan.drop("budget"), second.select("source", F.col("part").alias("cut_part"), F.col("subpart").alias("cut_subpart")),
                  ["source"], "left"), last, ["source"], "left"), "borders")

    place, cut = F.struct("part", "subpart"), F.struct(F.col("cut_part").alias("part"), F.col("cut_subpart").alias("subpart"))
    mine = F.struct("key", "id", "size", "own")
    at_border = F.struct("border.key", "border.id", "border.size", "border.own")
    within = F.coalesce(mine <= at_border, F.lit(False))
    drawn = F.col("cut_part").isNull() | (place < cut) | ((place == cut) & within)
    placed = same(fields, borders, ["source"]).withColumn("drawn", drawn)
    if not borders.filter("border.fit < border.equal").isEmpty():
        # Some equal rows are taken and some are not: they are counted and numbered.
        split = F.coalesce((place == cut) & (mine == at_border) & (F.col("border.fit") < F.col("border.equal")), F.lit(False))
        numbered = (
            placed.filter(split).groupBy(*placed.columns).agg(F.count("*").cast("int").alias("rows"))
            .withColumn("number", F.explode(F.sequence(F.lit(1), F.col("rows")))).withColumn("drawn", F.col("number") <= F.col("border.fit"))
        )
        placed = placed.filter(~split).unionByName(numbered.select(*placed.columns))
    copies = (F.col("epochs") + F.when(F.col("drawn") & (F.col("source_size") > 0), 1).otherwise(0)).cast("long")
    decided = placed.withColumn("copies", F.least(copies, F.lit(MOST_EPOCHS).cast("long")))
    return decided.select("row.*", F.struct(
        "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")).alias("mix"))


def label_weight(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Add ``quality_weight``: 2 for documents labelled good, 0.5 for those labelled bad, else 1.

    The labels grow with the documents, so they are never broadcast: both sides are dealt by id at any size, unsorted.
    """
    quality = labels.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("quality").alias("label_quality")).hint("shuffle_hash")
    weight = F.when(F.col("label_quality") >= 1, 2.0).when(F.col("label_quality") < 1, 0.5).otherwise(1.0)
    return documents.join(quality, F.col(f"`{id_column}`") == F.col("labelled_id"), "left").withColumn(
        "quality_weight", weight).drop("labelled_id", "label_quality")


SQL = r"""
WITH quality AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(CAST(d.doc_id AS VARCHAR), '') AS id,
         CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST(CAST('0x' || substr(md5('9:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
             / 4503599627370496.0) / (CASE WHEN q.quality >= 1 THEN 2.0 WHEN q.quality < 1 THEN 0.5 ELSE 1.0 END) AS key
  FROM documents d LEFT JOIN quality q ON q.doc_id = d.doc_id),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS DOUBLE) AS cap,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM ranked),
filled AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
plan AS (
  SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM filled WHERE cap / weight >= level) * weight, cap)) AS target
  FROM filled),
ordered AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 0 END AS epochs,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.id, s.size ROWS UNBOUNDED PRECEDING) - s.size / 2.0 AS upto
  FROM sized s JOIN plan p ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * least(3, epochs + CASE WHEN upto <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
