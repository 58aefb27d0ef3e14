"""Ranked search against scores of all documents, on small tables with ties, repeated rows and odd texts."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from reviewpulse.llm import lexical


def brute(docs, items, best=50):
    """Every document's score for every item, best first; equal scores by id, null last."""
    vectors = [Counter(lexical.terms(t)) for _, t in docs]
    sizes = [sum(v.values()) for v in vectors]
    n_docs, total = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for v in vectors for t in v)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), vector, n in zip(docs, vectors, sizes):
            score = 0
            for t in set(lexical.terms(text)) & set(vector):
                norm = 50 + 50 * n * n_docs // total
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10 ** 9 * vector[t] // (1000 * vector[t] + 20 * norm))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:best])]
    return sorted(out, key=str)


def test_terms():
    assert lexical.terms("Ab-c9 É_ß\x7fx\u0085y") == [b"ab", b"c9", "É".encode(), "ß".encode(), b"x\xc2\x85y"]
    assert lexical.terms(None) == lexical.terms(" .\n") == []


@pytest.mark.parametrize("trie, leaf, best", [(16_384, 16, 50), (7, 2, 3), (60, 1, 5)])
def test_equals_brute_force(frame, monkeypatch, trie, leaf, best):
    for name, value in (("TRIE_DOCUMENTS", trie), ("LEAF_DOCUMENTS", leaf), ("BEST", best), ("ITEM_BYTES", 200)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(best)
    names = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(4000)]
    docs = [(i, " ".join(rng.sample(names, rng.randint(1, 40)))) for i in range(150)]
    docs += [(i, docs[3][1]) for i in range(200, 240)]  # equal scores
    docs += [(5, docs[7][1]), (5, docs[7][1]), (None, docs[3][1]), (900, None), (901, ""), (902, " ,.\n"), (903, "w1 " * 5000)]
    items = [(i, " ".join(rng.sample(names, rng.randint(1, 12)))) for i in range(12)]
    items += [(3, docs[3][1]), (None, "w1 w2"), (50, None), (51, ""), (52, "nowhere"), (53, "W1 w1, W1")]
    got = lexical.rank_documents(
        frame(docs, "doc_id long, text string").selectExpr("*", "1 n", "'x' ids", "2 score", "0 first").repartition(3),
        frame(items, "item_id long, text string").selectExpr("*", "1 number", "'y' item", "0 rank"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, best)


def test_empty_tables(frame):
    docs, items = frame([(1, "a b")], "doc_id long, text string"), frame([(1, "a")], "item_id long, text string")
    assert lexical.rank_documents(docs.limit(0), items).collect() == []
    assert lexical.rank_documents(docs, items.limit(0)).collect() == []
    assert [r.doc_id for r in lexical.rank_documents(docs, items).collect()] == [1]


def test_bounds_hold_and_cut():
    """No document scores above a bound of its node, and branches without an item's terms are not scored."""
    rng = np.random.default_rng(1)
    docs = [np.sort(rng.choice(np.arange(30) + 30 * (i % 2), rng.integers(1, 9), replace=False)) for i in range(400)]
    at = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    terms, tf, norms = np.concatenate(docs), rng.integers(1, 5, at[-1]), rng.integers(50, 300, 400)
    trie = lexical.Trie(at, terms, tf, norms, 60)
    todo, leaves = [trie.root], 0
    while todo:
        node = todo.pop()
        inside = [trie.order[i] for i in range(node.first, node.last)]
        assert node.norm == min(norms[i] for i in inside)
        most = {}
        for i in inside:
            for t, f in zip(terms[at[i]:at[i + 1]].tolist(), tf[at[i]:at[i + 1]].tolist()):
                most[t] = max(most.get(t, 0), f)
        assert dict(zip(node.terms.tolist(), node.most.tolist())) == most
        assert len({tuple(docs[i][:node.depth]) for i in inside}) == 1
        assert not node.children or [c.first for c in node.children] + [node.last] == [node.first, *[c.last for c in node.children]]
        leaves += 0 if node.children else node.last - node.first
        todo += node.children
    assert leaves == 400
    search = lexical.Search(np.array([0, 3]), np.array([0, 4, 9]), np.array([5, 3, 9]), 60, np.zeros(1, np.int64))
    search.add(at, terms, tf, norms, np.arange(400))
    assert 0 < search.scored < 300 and len(search.best[0][0]) == 50
