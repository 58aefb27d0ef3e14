"""The corpus pipeline stage by stage over a small table."""

import corpus_pipeline
import pandas as pd
from reviewpulse.llm.common import table

from .conftest import SF
from .test_edges import jaccard_groups


def test_stages(spark):
    docs, kept = table(spark, SF, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        out = corpus_pipeline.settle(stage(spark, docs, SF), name)
        kept[name] = (before, out.toPandas())
        docs = out
        if name != "packing":
            assert out.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "mixture", "packing"]
    before, after = kept["language_id"]
    assert set(before[before.text.str.contains(r"[^\W\d_]", na=False)].doc_id) == set(after.doc_id)
    before, after = kept["near_duplicates"]
    assert sorted(after.doc_id) == sorted({c for _, _, c in jaccard_groups(list(zip(before.doc_id, before.text)))})
    before, after = kept["mixture"]
    copies = after.groupby("doc_id").size()
    assert copies.max() <= 3 and set(after.doc_id) <= set(before.doc_id)
    before, after = kept["packing"]
    assert sorted(after[after.start == 0].doc_id) == sorted(before.doc_id)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert isinstance(out, pd.DataFrame) and (out.groupby("sequence_id").length.sum() <= 2048).all()


def test_rows_with_nulls_and_repeats(spark):
    rows = [(None, "the same words stand here twice over", "en", None, 1), (1, "the same words stand here twice over", None, "a", 1),
            (1, "the same words stand here twice over", "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0),
            (4, "other words that stand alone in here", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one = corpus_pipeline.settle(corpus_pipeline.language_id(spark, docs, SF), "one")
    assert one.count() == 4
    two = corpus_pipeline.settle(corpus_pipeline.near_duplicates(spark, one, SF), "two")
    assert two.count() == 2
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_mixture_shuffles_texts_once(spark, monkeypatch):
    """At any size: no pass over sizes takes texts through a shuffle, the last one does, and no list of labels is broadcast."""
    plans = {}

    def plan_of(df):
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    def recorded(df, name):
        plans[name] = plan_of(df)
        return corpus_pipeline.settle(df, name)

    monkeypatch.setattr(corpus_pipeline.mixing, "settle", recorded)
    out = plan_of(corpus_pipeline.mixture(spark, table(spark, SF, "documents"), SF))

    def exchanged(plan):
        return [part for part in plan.split("\n\n") if ") Exchange" in part]

    assert len(exchanged(plans["sized"])) == 2 and not any("text#" in part for part in exchanged(plans["sized"]))
    assert len([part for part in exchanged(out) if "text#" in part]) == 1
