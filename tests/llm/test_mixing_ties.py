"""Targets are met by rows that share an id, have none, or are equal altogether."""

import pytest
from pyspark.sql import functions as F

from reviewpulse.llm import mixing


@pytest.mark.parametrize("id_of", [lambda i: None, lambda i: 7, lambda i: i % 3], ids=["null", "one", "three"])
@pytest.mark.parametrize("texts", [1, 5, 3000], ids=["equal", "some", "distinct"])
def test_targets_of_repeated_rows(frame, id_of, texts):
    rows = [(id_of(i), f"w{i % texts} " + "x " * 9, "a") for i in range(2000)]
    rows += [(10_000 + i, "some words here " * 4, "b") for i in range(1500)] + [(None, None, "a"), (None, "", "c")]
    df = frame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = mixing.mix(df.withColumn("words", mixing.word_count(F.col("text"))), F.lit(1.0), F.col("words"))
    got = mixed.groupBy("source").agg(F.sum("mix.taken").alias("taken"), F.max("mix.target").alias("target"),
                                      F.count("*").alias("n"), F.max(F.try_divide(F.col("mix.taken"), F.col("mix.size"))).alias("most")).collect()
    assert sorted((r.source, r.n) for r in got) == [("a", 2001), ("b", 1500), ("c", 1)]
    assert all(abs(r.taken - r.target) <= 12 and (r.most or 0) <= 3 for r in got)
    again = mixing.mix(df.repartition(3).withColumn("words", mixing.word_count(F.col("text"))), F.lit(1.0), F.col("words"))
    shown = ["doc_id", "text", "mix.taken"]
    assert sorted(map(str, mixed.select(*shown).collect())) == sorted(map(str, again.select(*shown).collect()))
