"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom_lm
from . import fusion
from . import itq
from . import lexical
from . import mixing
from . import packing
from . import parity
from . import repair
from . import runs
from . import token_counts as tc
from . import topk
from . import toxicity
from . import warc
from .common import table
from .registry import query


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_mix_sources", mixing.SQL)
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    weighted = mixing.label_weight(sized, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(weighted, F.col("quality_weight"), F.col("words"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", F.round("mix.target", 6).alias("target"), "mix.taken")


@query("op3_warc", warc.SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op4_harmonic_packing")
def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_repair_ids")
def op8_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_exact_top_k", topk.SQL)
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_itq_near_duplicates", itq.SQL)
def op5_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.links(table(spark, sf_dir, "embeddings"))


@query("op6_parity_jaccard_join", parity.SQL)
def op6_parity_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.similar_groups(table(spark, sf_dir, "documents"))


@query("op1_bloom_lm")
def op1_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: their label is the declaration, their source is the host."""
    documents = table(spark, sf_dir, "documents")
    model = fusion.train(documents, "doc_id", "text", "lang")
    found = fusion.identify(documents, model, "doc_id", "text", F.col("lang"), F.col("source"))
    return found.withColumnRenamed("id", "doc_id")


@query("op11_word_runs")
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    repeated = documents.withColumn("text", runs.with_planted_repeat(F.col("text"), F.col("doc_id")))
    return runs.run_digests(runs.word_runs(repeated))


@query("op12_ranked_lexical_search", lexical.SQL)
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("page_language_id")
def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: the text model comes from labelled documents, the other evidence from markup and address."""
    pages = table(spark, sf_dir, "pages")
    model = fusion.train(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    texts = pages.withColumn("text", fusion.page_text(F.col("html")))
    found = fusion.identify(texts, model, "page_id", "text", fusion.page_language(F.col("html")), fusion.page_host(F.col("url")))
    return found.withColumnRenamed("id", "page_id")
