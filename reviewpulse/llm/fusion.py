"""Language identification by Bayesian fusion of text, declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .common import text_chunks, with_unique_names

# Labelled rows that the text model is fitted on: about this many, chosen by a hash, and of each label at least
# about so many, or all of a rarer one.
TRAIN_ROWS = 20_000
LABEL_ROWS = 2_000
# Three-byte grams are hashed into this many slots; part of each distribution is uniform.
SLOTS = 1 << 15
UNIFORM = 0.1
# A text counts as this many independent grams at most, as grams depend on each other.
MOST_EVIDENCE = 64
# Strength of a parent's prior, in rows.
PARENT_ROWS = 10.0
# Weight of the undetermined class before any evidence, and what a gram of it counts against a uniform one: a text
# falls to it when about four fifths of its grams are such as no language has.
UNDETERMINED, UNDETERMINED_WEIGHT, UNDETERMINED_GRAM = "und", 0.05, 0.3
LEAST_CONFIDENCE = 0.5

LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed three-byte grams of a whole text; all but letters is a blank, blanks alone do not count."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(LETTERS), np.uint8).astype(np.uint32)
    data = np.concatenate([[np.uint32(32)], data, [np.uint32(32)]])
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    grams = grams[grams != 0x202020]
    slots = (grams * np.uint32(2654435761)) >> np.uint32(32 - (SLOTS.bit_length() - 1))
    return np.bincount(slots, minlength=SLOTS)


class TextModel:
    """Log probabilities of grams per class; the last class is the undetermined one, uniform over grams."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        self.classes = [*sorted(counts), UNDETERMINED]
        rows = [(1 - UNIFORM) * counts[c] / max(1, counts[c].sum()) + UNIFORM / SLOTS for c in self.classes[:-1]]
        self.logs = np.log(np.stack([*rows, np.full(SLOTS, UNDETERMINED_GRAM / SLOTS)], 1))

    def evidence(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of grams and log likelihood per class, of at most ``MOST_EVIDENCE`` grams' weight."""
        counts = gram_counts(text)
        n = int(counts.sum())
        return n, (counts @ self.logs) * (min(n, MOST_EVIDENCE) / n) if n else np.zeros(len(self.classes))


def train(labelled: DataFrame, id_column: str, text_column: str, label_column: str, rows: int = TRAIN_ROWS) -> TextModel:
    """Fit the text model on about ``rows`` labelled rows, and at least about ``LABEL_ROWS`` of every label, or all it has.

    Every label of the input is a class at any input size; rows with a null label are left out. Priors do
    not come from here: ``identify`` takes them from all rows.
    """
    data = with_unique_names(labelled, id=id_column, text=text_column, label=label_column).filter("label IS NOT NULL")
    # By id and text: rows whose ids are null or repeat are chosen one by one, too.
    data = data.withColumn("share", F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(1 << 30)) / float(1 << 30))
    labels = settle(data.groupBy("label").agg(F.count("*").alias("n"), F.min("share").alias("least")), "labels")
    total = labels.agg(F.sum("n")).first()[0] or 1
    # Up to its least share at least, so that no label is without rows.
    limits = labels.select(F.col("label").alias("of"), F.greatest(
        F.lit(rows / total), F.lit(float(LABEL_ROWS)) / F.col("n"), F.col("least")).alias("limit"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(SLOTS, np.int64)
        for text in pdf["text"]:
            held += gram_counts(text)
        return pd.DataFrame({"label": [pdf["label"].iloc[0]], "counts": [held.tobytes()]})

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        held = sum(np.frombuffer(counts, np.int64) for counts in pdf["counts"])
        return pd.DataFrame({"label": [pdf["label"].iloc[0]], "counts": [held.tobytes()]})

    # Dealt by row within each label, so that a language most rows have is counted by many tasks.
    sample = data.join(F.broadcast(limits), F.col("label") == F.col("of")).filter("share <= limit").withColumn(
        "deal", F.pmod(F.xxhash64("id", "text"), F.lit(16)))
    parts = sample.groupBy("label", "deal").applyInPandas(count, "label string, counts binary")
    # One row of a fixed size per language.
    sums = parts.groupBy("label").applyInPandas(add_up, "label string, counts binary").toArrow()
    return TextModel({label: np.frombuffer(counts, np.int64) for label, counts in zip(
        *(sums.column(c).to_pylist() for c in ("label", "counts")))})


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """Add ``grams``, ``logs`` (tempered log likelihoods) and ``p`` (posterior of the text alone) to (id, declared, host, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    before = np.log(np.array([1.0] * (len(model.classes) - 1) + [UNDETERMINED_WEIGHT]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for chunk in text_chunks(batches):
            grams, logs, p = [], [], []
            for text in chunk.column("text").to_pylist():
                n, scores = known.evidence(text)
                weights = np.exp(scores + before - (scores + before).max()) if n else np.array([0.0] * (len(scores) - 1) + [1.0])
                grams.append(n)
                logs.append(scores)
                p.append(weights / weights.sum())
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(c) for c in ("id", "declared", "host")), pa.array(grams, pa.int64()),
                 pa.array(logs, pa.list_(pa.float64())), pa.array(p, pa.list_(pa.float64()))],
                names=["id", "declared", "host", "grams", "logs", "p"])

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "declared", "host", "text").mapInArrow(
        read, f"id {kind}, declared string, host string, grams long, logs array<double>, p array<double>")


def identify(rows: DataFrame, model: TextModel, id_column: str, text_column: str, declared: Column, host: Column) -> DataFrame:
    """Identify the language of every row.

    Returns ``id, language, confidence, text_language, declared, accepted`` per input row (repeated rows
    each). The posterior of a class is the product of

    * the text's likelihood, tempered;
    * how likely rows of the class declare what the row declares, learned from all rows' text posteriors;
    * the same for the suffix of the row's host (``org`` of ``a.b.org``), if it has one;
    * the host's prior: its other rows' classes, smoothed by those of its domain (``b.org``), these by all rows.

    Null or blank declarations and hosts give no evidence. A text without letters is undetermined. A row is
    accepted if its class is a language with a confidence of at least ``LEAST_CONFIDENCE``.
    """
    def named(value: Column) -> Column:
        return F.when(F.trim(value) != "", F.lower(F.trim(value)))

    prepared = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"),
                           named(declared).alias("declared"), named(host).alias("host"))
    scored = settle(text_evidence(prepared, model), "evidence")
    classes = model.classes
    each = range(len(classes))

    def sums(prefix: str) -> list[Column]:
        return [F.array(*[F.sum(F.col("p")[i]) for i in each]).alias(f"{prefix}_p"), F.count("*").alias(f"{prefix}_n")]

    everything = scored.agg(*sums("all"), F.count_distinct("declared").alias("kinds")).first()
    n_all = everything["all_n"]
    all_p = [x or 0.0 for x in everything["all_p"]]
    overall = [(p + 1.0 / len(classes)) / (n_all + 1.0) for p in all_p]

    def likelihood(kinds: Column, prefix: str) -> Column:
        return F.array(*[F.log((F.col(f"{prefix}_p")[i] + 0.5) / (F.lit(all_p[i]) + 0.5 * (kinds + 1))) for i in each])

    declarations = scored.filter("declared IS NOT NULL").groupBy(F.col("declared").alias("said")).agg(*sums("said")).select(
        "said", likelihood(F.lit(float(everything["kinds"])), "said").alias("said_logs"))

    dotted = F.col("host").contains(".")
    hosts = scored.filter("host IS NOT NULL").groupBy("host").agg(*sums("host")).withColumn(
        "domain", F.when(dotted, F.substring_index("host", ".", -2))).withColumn("suffix", F.when(dotted, F.substring_index("host", ".", -1)))

    def above(column: str) -> DataFrame:
        return hosts.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"of_{column}")).agg(
            F.array(*[F.sum(F.col("host_p")[i]) for i in each]).alias(f"{column}_p"), F.sum("host_n").alias(f"{column}_n"))

    suffixes = above("suffix")
    suffix_kinds = suffixes.count()
    places = settle(
        hosts.join(above("domain"), F.col("domain") == F.col("of_domain"), "left")
        .join(suffixes.withColumn("suffix_logs", likelihood(F.lit(float(suffix_kinds)), "suffix")), F.col("suffix") == F.col("of_suffix"), "left")
        .select(F.col("host").alias("place"), "host_p", "host_n", "domain_p", "domain_n", "suffix_logs"), "hosts")

    def others(i: int, prefix: str, parent: Column) -> Column:
        # The row's own text is left out of its prior.
        return (F.greatest(F.col(f"{prefix}_p")[i] - F.col("p")[i], F.lit(0.0)) + PARENT_ROWS * parent) / (
            F.col(f"{prefix}_n") - 1 + PARENT_ROWS)

    def prior(i: int) -> Column:
        top = F.lit(overall[i])
        return F.coalesce(others(i, "host", F.coalesce(others(i, "domain", top), top)), top)

    def fused(df: DataFrame) -> DataFrame:
        zero = F.array(*[F.lit(0.0)] * len(classes))
        scores = [F.col("logs")[i] + F.coalesce("said_logs", zero)[i] + F.coalesce("suffix_logs", zero)[i] + F.log(prior(i)) for i in each]
        return df.withColumn("scores", F.array(*scores))

    # Rows without a host are not joined: they would all meet in one task.
    nowhere = [F.lit(None).cast(kind).alias(name) for name, kind in places.dtypes]
    located = scored.filter("host IS NOT NULL").join(places, F.col("host") == F.col("place"), "left").unionByName(
        scored.filter("host IS NULL").select("*", *nowhere))
    heard = located.withColumn("heard", F.coalesce("declared", F.concat(F.lit("\x00"), F.xxhash64("id").cast("string"))))
    joined = fused(heard.join(settle(declarations, "declarations"), F.col("heard") == F.col("said"), "left"))
    best = F.array_max("scores")
    weight = reduce(add, [F.exp(F.col("scores")[i] - best) for i in each])
    names = F.array(*[F.lit(c) for c in classes])
    language = F.when(F.col("grams") > 0, F.element_at(names, F.array_position("scores", best).cast("int"))).otherwise(F.lit(UNDETERMINED))
    out = joined.select(
        "id", language.alias("language"), F.round(1 / weight, 6).alias("confidence"),
        F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("text_language"), "declared")
    return out.withColumn("accepted", (F.col("language") != UNDETERMINED) & (F.col("confidence") >= LEAST_CONFIDENCE))


def page_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")


def page_language(html: Column) -> Column:
    """Declared language of a page's root element, without its region; null if there is none."""
    found = F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    return F.when(found != "", found)


def page_host(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
