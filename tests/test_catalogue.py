"""Every registered query against its SQL equivalent on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from reviewpulse import plans

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = plans.QUERIES, plans.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return f"{value + 0.0:.6f}"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table_of(df.columns, df.collect())
    cursor = duck.execute(ORACLES[name])
    want = table_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert [tuple(float(c) if _number(c) else c for c in r) for r in got[1]] == \
        [tuple(float(c) if _number(c) else c for c in r) for r in want[1]]


def _number(text):
    try:
        return math.isfinite(float(text))
    except ValueError:
        return False


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 16 and df.columns == ["section", "metric", "value", "detail"]


def test_report_bundle_covers_all_sections(spark):
    rows = QUERIES["section_report_bundle"](spark, SF).collect()
    assert {r.section for r in rows} == set("ABCDE")
    assert {r.table_name for r in rows} >= {"a1_rating_distribution", "b3_daily_volume", "d1_top30_words"}
