"""The landing of the stream queries grows by files, not by the size of a file."""

from reviewpulse.plans import stream_queries
from reviewpulse.sources.reviews import raw_reviews

SF = "/root/testdata/sf0.001"


def test_as_many_files_as_splits(spark, monkeypatch):
    seen = []

    def read_stream(spark, path, schema, max_files):
        seen.append((len(spark.read.parquet(path).inputFiles()), max_files, spark.read.parquet(path).count()))

    monkeypatch.setattr(stream_queries.rs, "read_stream", read_stream)
    rows = raw_reviews(spark, SF)
    stream_queries._landed(spark, SF)
    files, at_once, count = seen[0]
    assert files >= spark.sparkContext.defaultParallelism > 3
    assert files / 2 <= at_once < files and count == rows.count()
