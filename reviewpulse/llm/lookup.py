"""Sums of per-term values over documents, where the terms of a corpus do not fit one worker.

Frequent terms (a bounded number) are looked up in a broadcast table inside the task. All other
terms leave as (term, document, count) rows and are joined with the full term table, so every
occurrence is counted and the broadcast never grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_strings, text_chunks

# Bound of the broadcast table: this many terms of at most this many characters (about 10 MB).
FREQUENT_TERMS = 1 << 17
FREQUENT_LENGTH = 48
# Distinct terms a task holds before it passes its partial counts on.
HELD_TERMS = 400_000


def count_terms(texts: DataFrame, split: Callable[[str | None], list]) -> DataFrame:
    """Exact counts ``(term string, n long)`` over all rows of ``texts(text)``; counted per task first."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for chunk in text_chunks(batches):
            for text in chunk.column("text").to_pylist():
                held.update(split(text))
                if len(held) > HELD_TERMS:
                    yield emit(held)
                    held = Counter()
        if held:
            yield emit(held)

    def emit(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [as_strings(list(held)), pa.array(held.values(), pa.int64())], names=["term", "n"])

    return texts.select("text").mapInArrow(partial, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def frequent_terms(terms: DataFrame, limit: int = FREQUENT_TERMS) -> DataFrame:
    """The terms with the highest counts, at most ``limit``: all terms from a count level upwards.

    The level is read from a histogram of a few hundred rows, so no task sorts the vocabulary.
    """
    short = terms.filter(F.length("term") <= FREQUENT_LENGTH).withColumn("level", F.floor(F.log2("n") * 16))
    total, cut = 0, None
    for row in short.groupBy("level").count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > limit:
            break
        cut = row["level"]
    return short.filter(F.col("level") >= cut if cut is not None else F.lit(False)).drop("level")
