"""Sums of grams of whole batches equal those of every word's grams, cut one by one."""

import random

import numpy as np
import pytest
import regex

from reviewpulse.operators import language


def by_words(grams, scores, text):
    place, sums, known = {g: i for i, g in enumerate(grams)}, np.zeros(scores.shape[1], np.int64), 0
    for word in regex.findall(language.WORD_PATTERN, text):
        padded = f" {word} "
        for g in [*word, *(padded[i:i + 2] for i in range(len(word) + 1)), *(padded[i:i + 3] for i in range(len(word)))]:
            if g in place:
                sums, known = sums + scores[place[g]], known + 1
    return int(sums.argmax()) if known else None


@pytest.mark.parametrize("dense", [1 << 21, 1], ids=["by place", "by search"])
@pytest.mark.parametrize("letters", ["ab", "abcdeéß", "aъ中𐐨ñ"])
def test_sums_of_batches(monkeypatch, dense, letters):
    monkeypatch.setattr(language, "DENSE_KEYS", dense)
    monkeypatch.setattr(language, "BATCH_CHARS", 40)
    rng = random.Random(len(letters))
    others = " \n.1²_'" + "xЖ"

    def some(n):
        return "".join(rng.choice(letters * 3 + others) for _ in range(n))

    grams = sorted({rng.choice([" ", ""]) + some(rng.randint(1, 2)) + rng.choice([" ", ""]) for _ in range(60)} | {" ", "  ", "a b", "²"})
    scores = np.array([[rng.randint(-9, -1) for _ in range(3)] for _ in grams], np.int64)
    texts = ["", "1 2", *[some(rng.randint(0, 60)) for _ in range(300)]]
    assert language.GramSums(grams, scores).best(texts) == [by_words(grams, scores, t) for t in texts]
    assert language.GramSums(grams, scores).best([]) == []


def test_texts_are_scored_once(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    model = language.train(spark.createDataFrame([("the cat", "en"), ("le chat", "fr")], "text string, lang string"), "text", "lang")
    rows = spark.createDataFrame([(i, "the cat") for i in range(4)], "ingest_seq long, content_clean string")
    plain = language.detect

    def counted(df, *args, **more):
        def count(batches):
            for batch in batches:
                calls.add(batch.num_rows)
                yield batch
        return plain(df.mapInArrow(count, df.schema), *args, **more)

    monkeypatch.setattr(language, "detect", counted)
    found = language.with_detected_language(rows, model)
    assert found.filter("is_en").count() == 4 and found.select("ingest_seq").distinct().count() == 4
    assert calls.value == 4


@pytest.mark.parametrize("dense", [1 << 21, 1], ids=["by place", "by sorting"])
def test_grams_of_texts(monkeypatch, dense):
    monkeypatch.setattr(language, "DENSE_KEYS", dense)
    texts = ["", "a", "a b", "ab\n ab  éa1中𐐨²", "12"]
    expected = {}
    for word in (w for t in texts for w in regex.findall(language.WORD_PATTERN, t)):
        padded = f" {word} "
        for g in [*word, *(padded[i:i + 2] for i in range(len(word) + 1)), *(padded[i:i + 3] for i in range(len(word)))]:
            expected[g] = expected.get(g, 0) + 1
    assert {g: n for part in language.text_grams(texts) for g, n in part.items()} == expected
    assert [dict(part) for part in language.text_grams(["", "1"])] == [{}, {}, {}]
