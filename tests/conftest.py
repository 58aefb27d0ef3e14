from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reviewpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=4,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW = ("app_id string, app_name string, review_id string, score string, content string, at string, "
       "thumbs_up_count string, reply_content string, replied_at string, declared_lang string, ingest_seq long")


@pytest.fixture
def raw(spark):
    """Build a raw table from dicts; unnamed columns get plain values."""
    def build(rows):
        filled = []
        for i, row in enumerate(rows):
            base = dict(app_id="a", app_name="App a", review_id=f"r{i}", score="3", content="some text here",
                        at="2024-01-01 10:00:00", thumbs_up_count="0", reply_content=None, replied_at=None,
                        declared_lang="en", ingest_seq=i)
            base.update(row)
            filled.append(tuple(base[c.split()[0]] for c in RAW.split(", ")))
        return spark.createDataFrame(filled, RAW)
    return build


def as_dict(df):
    """A two-column frame as a dict."""
    return {r[0]: r[1] for r in df.collect()}
