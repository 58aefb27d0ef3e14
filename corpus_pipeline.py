"""From raw documents to packed training sequences; each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewpulse.llm import fusion, mixing, packing, parity
from reviewpulse.llm.common import table
from reviewpulse.sources.shared import settle

# A row's number in a stage's input: ids may be null or repeat, and the input's files do not change.
ROW = "corpus_pipeline_row"


def numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose number is not in ``gone``, a written table: Spark sees its size before it chooses the join."""
    return rows.join(settle(gone, "gone").withColumnRenamed(ROW, "gone"), F.col(ROW) == F.col("gone"), "left_anti").drop(ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is determined; texts without letters go, as do texts unlike any language."""
    rows = numbered(docs)
    model = fusion.train(rows, ROW, "text", "lang")
    found = fusion.identify(rows, model, ROW, "text", F.col("lang"), F.col("source"))
    return without(rows, found.filter(~F.col("accepted")).select(F.col("id").alias(ROW)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of similar texts, the first one; texts without words stay."""
    rows = numbered(docs)
    groups = parity.similar_groups(rows, ROW, "text")
    return without(rows, groups.filter("component_id <> doc_id").select(F.col("doc_id").alias(ROW)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or once per epoch."""
    # Sizes and hashes are made below the join with the labels: only the last pass takes texts through it.
    sized = docs.withColumns({ROW: mixing.word_count(F.col("text")), f"{ROW}_hash": mixing.row_hash(docs)})
    weighted = mixing.label_weight(sized, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(weighted, F.col("quality_weight"), F.col(ROW), own=F.col(f"{ROW}_hash")).filter("mix.copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packed),
]

# Neither trained language models nor tokenizers can be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
