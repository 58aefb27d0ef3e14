"""Raw review table derived from the supplied document, event and conversation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of arrivals per document: (kind, offset of its ingest_seq, every how many documents). The first kind is the
# document itself with its whole text; the others are additional rows and never stand in its place.
ARRIVALS = [
    ("review", 0, 1), ("repeat", 1_000_000_000, 50), ("short", 2_000_000_000, 11), ("praise", 3_000_000_000, 13),
    ("link", 4_000_000_000, 17), ("marks", 5_000_000_000, 19), ("address", 6_000_000_000, 23),
    ("anonymous", 7_000_000_000, 37), ("junk", 8_000_000_000, 29), ("outside", 9_000_000_000, 31),
    ("blank", 10_000_000_000, 41),
]
# Texts of kinds that do not take the document's own.
EDGE_TEXTS = {
    "praise": "good app", "link": "Ads ads, http://x.y/z worst", "marks": "!!!!!!", "address": "http://only.url/x",
    "anonymous": "nobody signed this good one", "junk": "stars given in words", "outside": "great, more than all stars",
    "blank": "\t \n ",
}
EDGE_SCORES = {"junk": "five stars", "outside": "9"}

# Declared layouts save a footer-reading job per scan.
LAYOUTS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Spread a table that arrives as fewer splits than there are cores; leave a large scan alone.

    Text work per row is heavy, so a small unsplittable file is worth one shuffle of its own size.
    A scan with enough splits is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "documents"), "doc_id")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows as a collector would land them: text columns, ``ingest_seq`` and ``ingest_date``.

    Each document is a review with its whole text, timed by its event and answered by the first
    assistant turn of its conversation; a document without either stays, without a time or an
    answer. Every fiftieth document arrives a second time, later in the file. Edge cases (short,
    blank and repeated texts, links, missing ids, scores that are no stars) are additional rows.
    """
    docs = documents(spark, sf_dir)
    events = table(spark, sf_dir, "events").filter("event_id % 5 = 0").select(
        F.expr("event_id div 5").alias("event_doc"), "ts", "user_id", "value")
    replies = (
        table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
        .groupBy("conv_id").agg(F.min(F.struct("turn", "text")).alias("answer"))
        .select(F.col("conv_id"), F.col("answer.text").alias("reply_content"))
    )
    doc, kind = F.col("doc_id"), F.col("arrival.kind")
    at = F.when(doc % 97 == 0, "not-a-date").otherwise(F.substring(F.col("ts").cast("string"), 1, 19))
    score = F.when(doc % 89 != 0, (1 + (doc * 7 + F.col("user_id")) % 5).cast("string"))
    content = F.when(kind == "short", F.substr("text", F.lit(1), (doc % 7).cast("int")))
    for name, edge in EDGE_TEXTS.items():
        content = content.when(kind == name, edge)
    for name, edge in EDGE_SCORES.items():
        score = F.when(kind == name, edge).otherwise(score)
    arrivals = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(shift).cast("bigint").alias("shift"), F.lit(every).alias("every"))
                         for k, shift, every in ARRIVALS])
    own_id = F.when(kind.isin("review", "repeat"), doc.cast("string")).when(
        kind != "anonymous", F.concat(doc.cast("string"), F.lit("-"), kind))
    # Events and answers meet first, so that texts take part in one join; one scan gives all arrivals of a document.
    facts = events.join(replies, F.col("event_doc") == F.col("conv_id"), "full").withColumn(
        "fact_doc", F.coalesce("event_doc", "conv_id"))
    rows = (
        docs.join(facts, F.col("fact_doc") == doc, "left")
        .withColumn("arrival", F.explode(F.filter(arrivals, lambda a: doc % a["every"] == 0)))
    )
    return rows.select(
        F.col("source").alias("app_id"),
        F.concat(F.lit("App "), F.col("source")).alias("app_name"),
        own_id.alias("review_id"),
        score.alias("score"),
        content.otherwise(F.col("text")).alias("content"),
        at.alias("at"),
        (F.floor("value").cast("bigint") % 4).cast("string").alias("thumbs_up_count"),
        "reply_content",
        F.when(F.col("reply_content").isNotNull(), F.when(doc % 7 == 0, "soon").otherwise(at)).alias("replied_at"),
        F.col("lang").alias("declared_lang"),
        F.to_date("ts").alias("ingest_date"),
        (doc + F.col("arrival.shift")).alias("ingest_seq"),
    )
