"""Periodic runs against a brute-force search, on random words, on edge cases and on the whole small table."""

import hashlib
import random
import zlib

import pandas as pd
import pytest

from reviewpulse.llm import QUERIES, runs

from .conftest import SF


def brute_runs(words, min_length=24, min_exponent=3):
    """Every period by itself: maximal stretches of equal words, the smallest period of each."""
    found, n = {}, len(words)
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_length, min_exponent * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def some_words(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 4:
            start, period = rng.randrange(n), rng.randint(1, 40)
            for i in range(start + period, rng.randint(start, n)):
                words[i] = words[i - period]
    return words


@pytest.mark.parametrize("length, exponent", [(24, 3), (2, 2), (64, 3), (6, 2), (5, 4)])
@pytest.mark.parametrize("slab", [1, 7, 50, 1 << 16])
def test_runs_equal_brute_force(monkeypatch, length, exponent, slab):
    monkeypatch.setattr(runs, "SLAB", slab)
    rng = random.Random(slab)
    for _ in range(150):
        words = some_words(rng, rng.randint(0, 260))
        assert runs.runs_of(words, length, exponent) == brute_runs(words, length, exponent), words


def test_long_texts():
    assert runs.runs_of(["a"] * 300_000) == [(0, 300_000, 1)]
    words = [f"w{i}" for i in range(1000)] * 3 + ["end"]
    assert runs.runs_of(words) == [(0, 3000, 1000)]
    assert runs.runs_of([f"w{i}" for i in range(1000)] * 3 + ["w0"])[0] == (0, 3001, 1000)


def test_periods_have_one_band():
    for length, exponent in ((24, 3), (2, 2), (64, 3), (100, 5)):
        seen = [p for _, low, high in runs.bands(500, length, exponent) for p in range(low, high + 1)]
        assert seen == list(range(1, 501))


def test_collapsed_keeps_the_first_period():
    words = ["x", *["a", "b", "c"] * 9, "y"]
    found = runs.runs_of(words)
    assert found == [(1, 27, 3)]
    assert runs.collapsed(words, found) == ["x", "a", "b", "c", "y"]
    # A word that a run keeps goes if another run repeats it.
    assert runs.collapsed(list("abcdef"), [(0, 4, 2), (1, 5, 1)]) == ["a", "b"]


def test_edge_rows(frame):
    many = " ".join(["tic tac"] * 20)
    docs = frame([(None, many), (1, None), (1, ""), (2, " \t\n"), (3, many), (3, many), (4, "a " * 50_000)],
                 "doc_id long, text string").selectExpr("doc_id", "text", "'x' runs", "1 collapsed", "2 n_words")
    got = {}
    for row in runs.word_runs(docs).collect():
        got.setdefault(row.doc_id, []).append((row.n_words, [tuple(r) for r in row.runs], row.collapsed))
    assert got[None] == [(40, [(0, 40, 2)], "tic tac")]
    assert got[1] == [(0, [], "")] * 2 and got[2] == [(0, [], "")]
    assert got[3] == got[None] * 2 and got[4] == [(50_000, [(0, 50_000, 1)], "a")]
    assert runs.word_runs(docs.filter("doc_id = 9")).collect() == []


def contract(doc_id, text):
    """The query's row, step by step."""
    words = (text or "").encode().split()
    check, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = check // 10
    if check % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    keep = [True] * n
    for s, length, q in found:
        keep[s + q:s + length] = [False] * (length - q)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for w, k in zip(words, keep) if k)).hexdigest(), n)


def test_op11_whole_table(spark):
    documents = pd.read_parquet(f"{SF}/documents.parquet")
    got = QUERIES["op11_word_runs"](spark, SF).orderBy("doc_id").collect()
    want = [contract(i, t) for i, t in sorted(zip(documents.doc_id, documents.text))]
    assert [tuple(r) for r in got] == want and sum(r.n_runs > 0 for r in got) > 5


def test_planted_repeat_of_empty_and_null(frame):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = frame([(i, t) for i in ids for t in (None, "", " \n ", "one", "a b c d e f g h i j " * 30)], "doc_id long, text string")
    changed = docs.withColumn("text", runs.with_planted_repeat(docs.text, docs.doc_id))
    got = sorted(tuple(r) for r in runs.run_digests(runs.word_runs(changed)).collect())
    assert sorted(got, key=str) == sorted((contract(i, t) for i in ids for t in (None, "", " \n ", "one", "a b c d e f g h i j " * 30)), key=str)
