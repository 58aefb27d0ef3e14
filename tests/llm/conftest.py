from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema; rows may be tuples."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])
