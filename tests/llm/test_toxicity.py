"""Toxicity: readings of disguised words, features, held-out accuracy on the whole table, and edge cases."""

import zlib

import pandas as pd
import pytest

from reviewpulse.llm import toxicity as tox
from reviewpulse.llm import QUERIES

from .conftest import SF


@pytest.mark.parametrize("token, word, hidden", [
    ("Idiot!!", "idiot", False), ("id1ot", "idiot", True), ("i.d.i.o.t", "idiot", True), ("stuuupid", "stupid", True),
    ("$cum,", "scum", True), ("2024", "2024", False), ("www.example.org", "wexampleorg", True), ("|", "", False), ("...", "", False),
    ("ÄRGER", "ärger", False),
])
def test_plain_words(token, word, hidden):
    assert tox.plain_word(token) == (word, hidden)


def features(text, odds=None):
    return dict(zip(tox.FEATURES, tox.text_features(text, tox.Words(odds or {"idiot": 5.0, "fool~": 2.0}))))


def test_features():
    one = features("you are an id1ot and IDIOT ... foolish !!")
    assert one["strong_density"] == 2 / 9 and one["strong_kinds"] == 1 and one["mild_density"] == 3 / 9
    assert one["addressed_share"] == 1.0 and one["address_density"] == 1 / 9 and one["greatest_odds"] == 5.0
    assert one["shouted_share"] == 1 / 9 and one["disguised_share"] == 1 / 9 and one["repeated_marks"] == 2 / 9
    assert features("an idiot " + "word " * 20 + "you")["addressed_share"] == 0.0
    assert set(features(None).values()) == set(features("").values()) == set(features(" \n").values()) == {0.0}


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tox, "HELD_WORDS", 5)
    words = tox.Words({"idiot": 5.0})
    for text in ("a b c d", "e f idiot h", "a idiot b c d e f g h i j", "idiot"):
        alone = tox.text_features(text, tox.Words({"idiot": 5.0}))
        assert tox.text_features(text, words) == alone and len(words) <= 5 + len(text.split())


def test_op13_held_out(spark):
    """The words of one table's labels find the toxic documents that the model has not seen."""
    folder = SF.replace("sf0.001", "sf0.01")
    got = QUERIES["op13_toxicity"](spark, folder).toPandas()
    documents = pd.read_parquet(f"{folder}/documents.parquet")
    assert sorted(got.doc_id) == sorted(documents.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all() and got.predicted.dtype == "int32"
    toxic = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id").toxic
    part = got[got.held_out].set_index("doc_id").join(toxic, how="inner").dropna()
    assert part[part.toxic == 1].predicted.mean() > 0.5 and part[part.toxic == 0].predicted.mean() < 0.02
    texts = got.merge(documents, on="doc_id").groupby("text").score.nunique()
    assert (texts == 1).all()


def test_edge_rows(frame):
    insult = "you are a total {} and everybody here knows it number {}"
    rows = [(i, insult.format("wombat" if i % 4 == 0 else "friend", i)) for i in range(400)]
    rows += [(None, rows[0][1]), (0, rows[0][1]), (900, None), (901, ""), (902, "wombat " * 30_000), (903, None)]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 toxic", "'f' features", "0 score", "'x' fold", "1 margin").repartition(3)
    labels = frame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (900, 1), (5, None), (8, 0)], "doc_id long, toxic int")
    got = {}
    for r in tox.score_documents(docs, labels.selectExpr("*", "'t' text", "1 fold")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2 and got[None][0].score == got[0][0].score > 0.7 and not got[None][0].held_out
    assert all(got[i][0].predicted == int(i % 4 == 0) for i in range(400))
    assert got[900][0].score == got[901][0].score == got[903][0].score < 0.7 and got[902][0].predicted == 1
    assert tox.score_documents(docs.limit(0), labels).collect() == []


def test_labels_of_one_class_or_none(frame):
    docs = frame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string")
    none = tox.score_documents(docs, frame([], "doc_id long, toxic int")).collect()
    assert len(none) == 20 and {r.score for r in none} == {0.0}
    clean = tox.score_documents(docs, frame([(i, 0) for i in range(20)], "doc_id long, toxic int")).collect()
    assert len({r.score for r in clean}) == 1 and all(r.predicted == 0 for r in clean)
