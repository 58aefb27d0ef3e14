"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, per operator."""

import io
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewpulse.llm import bloom_lm, components, fusion, itq, mixing, packing, parity, repair, token_counts, topk, warc

from .conftest import rows_of

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    (1, "The cat sat on the mat today", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (None, "a text without an id here", "en", None),
    (4, "the cat SAT on the mat today", "en", "b"),
    (4, "the cat SAT on the mat today", "en", "b"),
    (5, "many words " * 20000, "en", "a"),
    (6, "x" * 150000, None, "a"),
    (7, " \t\n ", "fr", "c"),
    (8, "<|endoftext|> it's  ÉCOLE 123    ß </s> ▁", "fr", "b"),
    (9, "two words", "en", "b"),
]
# Names that the operators use inside.
CLASH = ["row", "row_id", "term", "n", "key", "part", "size", "mix", "member", "family", "set_id", "kind", "place",
         "task", "held_out", "pieces", "base", "score", "place_", "component_id", "n_shingles", "tie", "weight"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASH)


@pytest.fixture
def texts(frame):
    return frame([(*r, *["z"] * len(CLASH)) for r in TEXTS], SCHEMA)


@pytest.fixture
def no_texts(frame):
    return frame([], SCHEMA)


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def test_lm_edges(texts, no_texts):
    got = bloom_lm.score_documents(texts)
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in TEXTS]
    counts = Counter(w for (_, t, *_), h in zip(TEXTS, held) if not h for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    want = []
    for (i, text, *_), h in zip(TEXTS, held):
        ws = tokens(text)
        want.append((i, h, len(ws), sum(w in counts for w in ws), total,
                     round(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws), 4)))
    rounded = got.withColumn("base_score", F.round("base_score", 4))
    assert rows_of(rounded, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == \
        sorted(want, key=lambda r: [(x is not None, x) for x in r])
    assert got.filter("score > 0 OR score IS NULL").count() == 0
    assert bloom_lm.score_documents(no_texts).count() == 0


def test_lm_without_training_rows(frame):
    row = bloom_lm.score_documents(frame([(2, "held out words")], "doc_id long, text string"), held_fold=zlib.crc32(b"2") % 7).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (4, 0, 0, 0.0, 0.0)


def lm_of(texts, **options):
    counts = bloom_lm.settle(bloom_lm.count_terms(texts, bloom_lm.tokens), "tokens")
    total, types = counts.agg(F.sum("n"), F.count("*")).first()
    model, stored = bloom_lm.train(texts, counts, total, types, **options)
    return model, bloom_lm.gather(stored, model.slices, options.get("hashes", bloom_lm.HASHES))


def test_lm_probabilities_sum_to_at_most_one(frame):
    texts = frame([(i, "a b a c a b") for i in range(5)] + [(9, "c c b a")], "doc_id long, text string")
    model, found = lm_of(texts, hashes=24)
    for context in ("", "a", "b", "c", "a b", "a b a", "c c"):
        read = bloom_lm.Tokens([f"{context} {word}" for word in ("a", "b", "c", "unseen")] + [context])
        p = model.probabilities(read, found.levels)
        at = read.first + len(context.split()) + 1
        assert min(p[at]) > 0 and 0.5 < p[at].sum() <= 1 + 1e-9
    read = bloom_lm.Tokens(["a b", "b b"])
    p = model.probabilities(read, found.levels)
    assert p[2] > p[6]


def exact_scores(texts, held, least=bloom_lm.LEAST):
    """The model's scores from exact counts, without a filter or hashes."""
    read = [["<s>", *tokens(t)] for t in texts]
    counts = Counter(tuple(ws[i:i + n]) for ws, h in zip(read, held) if not h for n in range(1, len(least) + 1) for i in range(len(ws) - n + 1))
    total, types = sum(n for g, n in counts.items() if len(g) == 1 and g != ("<s>",)), sum(len(g) == 1 and g != ("<s>",) for g in counts)
    starts = [sorted({math.ceil(low * bloom_lm.BASE ** k - 1e-9) for k in range(60)}) for low in least]

    def level(gram):
        return sum(counts[gram] >= s for s in starts[len(gram) - 1])

    def probability(ws, i, n):
        low = level(tuple(ws[i - n + 1:i + 1]))
        if n == 1:
            return ((starts[0][low - 1] if low else 0) + 1) / (total + types + 1)
        p = probability(ws, i, n - 1)
        context = level(tuple(ws[i - n + 1:i]))
        size = starts[n - 2][context] - 1 if context else 0
        if size < least[n - 1]:
            return p
        return (min(starts[n - 1][low - 1] if low else 0, size) + size ** bloom_lm.GROWTH * p) / (size + size ** bloom_lm.GROWTH)

    return [sum(math.log10(probability(ws, i, min(len(least), i + 1))) for i in range(1, len(ws))) for ws in read]


def test_lm_scores_match_exact_counts(frame):
    texts = [" ".join(f"w{(i * i + j * (i % 5 + 1)) % 17}" for j in range(i % 40)) for i in range(200)] + \
        ["The cat sat on the mat today, the CAT sat on the mat"] * 3 + ["x" * 150000 + " tail " + "é" * 70, None, "", " \t ", "many words " * 3000]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    # So many hashes that no probe succeeds by chance.
    got = {r.doc_id: r.score for r in bloom_lm.score_documents(docs, hashes=24).collect()}
    want = exact_scores(texts, held)
    assert len(got) == len(texts) and any(held)
    for i, score in enumerate(want):
        assert got[i] == pytest.approx(score, rel=1e-9)


def test_lm_same_scores_from_stored_segments(texts, no_texts):
    names = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    rounded = [rows_of(bloom_lm.score_documents(texts, broadcast_bytes=limit).withColumn("base_score", F.round("base_score", 6))
                       .withColumn("score", F.round("score", 6)), *names) for limit in (bloom_lm.BROADCAST_BYTES, -1)]
    assert rounded[0] == rounded[1] and len(rounded[0]) == len(TEXTS)
    assert bloom_lm.score_documents(no_texts, broadcast_bytes=-1).count() == 0


def test_lm_segments_score_many_blocks(frame, monkeypatch):
    for name, value in (("CHUNK_BYTES", 300), ("BLOCK_BYTES", 1000), ("SLICE_TOKENS", 64)):
        monkeypatch.setattr(bloom_lm, name, value, raising=False)
    texts = [" ".join(f"w{(i * i + j * (i % 5 + 1)) % 17}" for j in range(i % 40)) for i in range(200)] + \
        ["same words here"] * 300 + ["x" * 15000 + " tail " + "é" * 70, None, "", " \t ", "no", "space"]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = Counter(w for t, h in zip(texts, held) if not h for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    scored = bloom_lm.score_documents(docs, hashes=24, broadcast_bytes=-1)
    # Answers come by block: no row for each rare word of each text, which a join with all words would have to take.
    assert "term" not in scored._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == len(texts)
    for i, (text, score) in enumerate(zip(texts, exact_scores(texts, held))):
        ws, row = tokens(text), got[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(ws), sum(w in counts for w in ws), total)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws))
        assert row.score == pytest.approx(score, rel=1e-9)


def test_lm_distinct_keys():
    keys = bloom_lm.mix64(np.arange(3000) % 1000)
    for some in (keys, keys >> np.uint64(20), keys[:0], (keys[:1] >> np.uint64(3)).repeat(5), np.arange(900, 0, -1).astype(np.uint64) | np.uint64(1 << 63)):
        kinds, number = bloom_lm.distinct(some)
        assert kinds.tolist() == sorted(set(some.tolist())) and kinds[number].tolist() == some.tolist()


def test_lm_filter_grows_with_the_corpus(frame):
    sizes = []
    for n in (2000, 8000):
        docs = frame([(i, " ".join(f"w{i * 31 + j}" for j in range(20))) for i in range(n // 20)] + [(-1, "seen once here")] , "doc_id long, text string")
        model, found = lm_of(docs)
        read = bloom_lm.Tokens(["seen once here"])
        # Single words and pairs are there with any count, whatever else the corpus holds.
        assert (found.levels(model.keys(read)) > 0).sum() >= 5 + 4
        sizes.append(len(found.bits))
    assert sizes[1] > 3 * sizes[0]


def test_language_edges(texts, no_texts, frame):
    labelled = frame([(i, t, l) for i in range(20) for t, l in (
        ("the cat and the dog of the house with this", "en"), ("le chat et le chien de la maison avec une", "fr"))], "id long, text string, lang string")
    model = fusion.train(labelled, "id", "text", "lang")
    got = fusion.identify(texts, model, "doc_id", "text", F.col("lang"), F.col("source"))
    by_id = {r.id: r for r in got.collect()}
    assert got.count() == len(TEXTS)
    assert {i for i, r in by_id.items() if r.language == "und"} >= {2, 3, 6, 7} and not by_id[2].accepted
    assert all(by_id[i].language == "en" and by_id[i].accepted for i in (1, 4))
    assert fusion.identify(no_texts, model, "doc_id", "text", F.col("lang"), F.col("source")).count() == 0
    assert fusion.train(no_texts, "doc_id", "text", "lang").classes == ["und"]


def test_language_evidence_decides_short_texts(frame):
    labelled = frame([(i, t, l) for i in range(20) for t, l in (
        ("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr"))], "id long, text string, lang string")
    model = fusion.train(labelled, "id", "text", "lang")
    # One gram that both languages share leaves the decision to the host and the markup.
    pages = [(i, "le chat et le chien de la maison", "fr", "www.x.fr") for i in range(30)]
    pages += [(100 + i, "the cat and the dog of the house", "en", "www.y.com") for i in range(30)]
    pages += [(200, "a", None, "blog.x.fr"), (201, "a", "en", None), (202, "a", None, "www.y.com")]
    found = {r.id: r.language for r in fusion.identify(
        frame(pages, "id long, text string, markup string, host string"), model, "id", "text", F.col("markup"), F.col("host")).collect()}
    assert (found[200], found[201], found[202]) == ("fr", "en", "en")


def test_markup_and_host(frame):
    df = frame([("<html class='x' LANG=de-AT><p>x</p>", "https://u:p@A.b.org:80/x"), (None, None), ("<p>", "no address")], "html string, url string")
    assert rows_of(df.select(fusion.page_language(F.col("html")).alias("l"), fusion.page_host(F.col("url")).alias("h"))) == \
        [(None, None), (None, ""), ("de", "A.b.org")]


PAGES = [(1, "u", "a" * 1000), (2, "u", "a" * 1000), (2, "u", "a" * 1000), (3, None, None), (4, "u\nv", "b"), (5, "u", "b"),
         (None, "u", "a" * 1000), (6, "u", "é" * 500), (7, "u", "é" * 500), (8, "u", "y" * 300000)]


def test_warc_edges(frame):
    pages = frame([(*r, "z", "z") for r in PAGES], "page_id long, url string, html string, digest string, winner string")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()}
    assert warc.round_trip(pages).count() == len(PAGES)
    assert got == {(1, "revisit", 2, 1000), (2, "response", None, 1000), (3, "response", None, 0), (4, "response", None, 1),
                   (5, "response", None, 1), (None, "revisit", 2, 1000), (6, "revisit", 7, 1000), (7, "response", None, 1000),
                   (8, "response", None, 300000)}
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(*records):
    out = io.BytesIO()
    for headers, block in records:
        warc.write_record(out, headers, block)
    return out.getvalue()


def test_warc_reader_frames_and_verifies():
    block = b"x\r\n\r\n" * 50000
    good = {"WARC-Record-ID": "<urn:page:1>", "WARC-Block-Digest": warc.base32_sha1(block)}
    data = archive((good, block), ({"WARC-Record-ID": "<urn:page:2>"}, b""))
    assert [(warc.page_of(h["WARC-Record-ID"]), b) for h, b in warc.read_records(io.BytesIO(data))] == [(1, block), (2, b"")]
    with pytest.raises(warc.BadRecord, match="digest"):
        list(warc.read_records(io.BytesIO(archive((good, block[:-1] + b"y")))))
    with pytest.raises(warc.BadRecord, match="ends inside"):
        list(warc.read_records(io.BytesIO(data[:-10])))
    packed = __import__("gzip").compress(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n")
    with pytest.raises(warc.BadRecord):
        list(warc.read_records(io.BytesIO(packed)))


def test_packing_edges(texts, no_texts):
    encoder = Tokenizer.from_file(WORD_BPE)
    got = packing.pack(texts, WORD_BPE, with_ids=True).cache()
    want = sorted(len(encoder.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in TEXTS)
    starts = [r.doc_tokens for r in got.filter("start = 0").collect()]
    assert sorted(starts) == want and got.agg(F.sum("length")).first()[0] == sum(want)
    whole = packing.sequences(got).collect()
    assert sum(len(r.ids) for r in whole) == sum(want) and max(len(r.ids) for r in whole) <= 2048
    assert packing.pack(no_texts, WORD_BPE).count() == 0


def test_cuts_cover_every_length():
    for length in [*range(1, 3000), 10 ** 6 + 7]:
        pieces = packing.cuts(length)
        assert sum(p for p, _ in pieces) == length and all(0 < p and p * k <= packing.CAPACITY for p, k in pieces)


VECTORS = [(1, [1.0, 0.0, 0.0], 0), (2, [1.0, 0.01, 0.0], 0), (2, [1.0, 0.01, 0.0], 0), (3, [1.0, 0.0, 0.0], 1), (4, None, 0),
           (5, [0.0, 0.0, 0.0], 0), (6, [float("nan"), 1.0, 0.0], 0), (7, [None, 1.0, 0.0], 0), (8, [1.0, 0.0, 0.0], None),
           (9, [2.0, 0.0, 0.0], 0), (10, [], 0), (None, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0], 0), (12, [float("inf"), 1.0, 0.0], 0),
           (20, [-0.0, 1.0, 0.0], 0), (40, [0.0, 1.0, 0.0], 0)]


def test_near_vectors_edges(frame):
    df = frame([(*v, "z", "z") for v in VECTORS], "vec_id long, embedding array<float>, label int, rep string, bucket string")
    got = rows_of(itq.links(df), "vec_id", "n_links", "component_id", "kept")
    linked = {1: (3, 1), 2: (3, 1), 9: (3, 1), 20: (1, 20), 40: (1, 20)}
    want = [(v, *linked.get(v, (0, v)), linked.get(v, (0, v))[1] == v) for v, *_ in VECTORS]
    assert got == sorted(want, key=lambda r: [(x is not None, x) for x in r])
    assert itq.links(df.limit(0)).count() == 0


def test_near_vectors_recall_and_tiles(frame, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 64))
    data = np.concatenate([c + 0.085 * rng.normal(size=(n, 64)) for c, n in zip(centres, [200] + [10] * 29)]).astype(np.float32)
    df = frame([(i, v.tolist(), 0) for i, v in enumerate(data)], "vec_id long, embedding array<float>, label int")
    unit = data.astype(np.float64) / np.linalg.norm(data.astype(np.float64), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.98
    np.fill_diagonal(close, False)
    whole = {r.vec_id: r.n_links for r in itq.links(df).collect()}
    found = np.array([whole[i] for i in range(len(data))])
    assert (found <= close.sum(1)).all() and found.sum() >= 0.9 * close.sum() > 1000
    monkeypatch.setattr(itq, "BUCKET_ROWS", 16)
    assert {r.vec_id: r.n_links for r in itq.links(df).collect()} == whole


def jaccard_groups(rows):
    def shingles(text):
        ws = (text or "").encode().lower().split()
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    low = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return [(i, len(s), low.get(g, i)) for (i, _), s, g in zip(rows, sets, group)]


def test_similar_texts_edges(texts, no_texts):
    got = rows_of(parity.similar_groups(texts))
    assert got == sorted(jaccard_groups([(i, t) for i, t, *_ in TEXTS]), key=lambda r: [(x is not None, x) for x in r])
    assert parity.similar_groups(no_texts).count() == 0


@pytest.mark.parametrize("family_rows", [1024, 8])
def test_similar_texts_brute_force(frame, monkeypatch, family_rows):
    """Families of mutated texts around the threshold at many sizes, with and without tiles."""
    monkeypatch.setattr(parity, "FAMILY_ROWS", family_rows)
    rng = np.random.default_rng(family_rows)
    rows = []
    for size in (1, 4, 5, 6, 8, 12, 20, 61, 64, 70, 90, 250, 265, 300, 1000, 1100):
        base = [f"w{rng.integers(10 ** 6)}" for _ in range(size)]
        for _ in range(10):
            text, cut = list(base), rng.integers(0, 5)
            for _ in range(int(rng.integers(0, max(2, size // 30)))):
                text[rng.integers(len(text))] = f"v{rng.integers(10 ** 6)}"
            rows.append((len(rows), " ".join(text[: max(1, len(text) - cut)])))
    got = rows_of(parity.similar_groups(frame(rows, "doc_id long, text string")))
    assert got == sorted(jaccard_groups(rows))
    assert len({r[2] for r in got}) < len(rows)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 500, rng.integers(1, 300)).astype(np.uint64)) for _ in range(2))
        a, b = parity.mix64(a), parity.mix64(b)
        for band in (0, 1, 2):
            x, y = (np.frombuffer(parity.dense_sketch(s, band), np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components(frame):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(1000, i) for i in range(1001, 1200)]
    edges += [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components.connected(frame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert components.connected(frame([], "a long, b long")).count() == 0


def test_top_k_edges(frame):
    df = frame([(*v, "z", "z") for v in VECTORS], "vec_id long, embedding array<float>, label int, rank string, dim string")
    got = rows_of(topk.top_k(df, F.col("vec_id") % 20 == 0, k=3), "query_id", "rank", "vec_id", "score")
    whole = [(i, [math.floor(64 * np.float32(x)) for x in v]) for i, v, _ in VECTORS
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in whole:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:3]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_blocks(frame, monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(900, 24)).round(2)
    df = frame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 200)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    got = rows_of(topk.top_k(df, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score")
    ints = np.floor(64 * data).astype(np.int64)
    want = []
    for q in range(0, 900, 20):
        scores = ints @ ints[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:20]
        want += [(q, r, i, int(scores[i])) for r, i in enumerate(order, 1)]
    assert got == want


def test_ids_edges(texts, no_texts):
    encoder = Tokenizer.from_file(BYTE_BPE)
    ids = [(i, np.array(encoder.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for i, t, *_ in TEXTS]
    got = repair.round_trip(texts, BYTE_BPE)
    found = rows_of(got, "start", "doc_id", "n_tokens", "ids_crc32")
    assert sorted((n, c) for _, _, n, c in found) == sorted((len(x), zlib.crc32(x)) for _, x in ids)
    assert [s for s, *_ in found] == [0, *np.cumsum([n for _, _, n, _ in found])[:-1].tolist()]
    assert [i for _, i, *_ in found] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    assert repair.round_trip(no_texts, BYTE_BPE).count() == 0


@pytest.mark.parametrize("n, kinds", [(0, 3), (1, 3), (2, 1), (5000, 1), (20000, 4), (100000, 60)])
def test_repair_round_trip_and_random_access(n, kinds):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, kinds, n).astype(np.uint32)
    out = io.BytesIO()
    repair.write_shard(out, [1, 2], np.array([n // 3, n - n // 3]), ids)
    shard = repair.Shard(out.getvalue())
    assert (shard.range(0, n) == ids).all() and (shard.document(1) == ids[n // 3:]).all()
    for _ in range(30):
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert (shard.range(a, b) == ids[a:b]).all()
    if n >= 5000:
        assert len(shard.left) < 0.7 * n
    if n:
        assert shard.lengths.tolist() == [len(repair.expand(np.array([shard.terminals + r]), shard.terminals, shard.rules)) for r in range(len(shard.rules))]


def mixed(df):
    sized = df.withColumn("words", mixing.word_count(F.col("text")))
    return mixing.mix(sized, F.lit(1.0), F.col("words"))


def test_mixing_edges(texts, no_texts):
    out = mixed(texts)
    assert out.columns[:4] == ["doc_id", "text", "lang", "source"] and out.count() == len(TEXTS)
    for r in out.select("doc_id", "text", F.col("mix.*")).collect():
        assert r.taken == r.copies * r.size <= 3 * r.size and r.size == len((r.text or "").encode().split())
    assert mixed(no_texts).count() == 0


def test_mixing_targets_and_epochs(frame):
    # Sources a, b, c weigh 5, 2, 1; a is small, so its excess goes to b and c by 2 : 1.
    rows = [(i, "x " * 10, "a") for i in range(10)] + [(100 + i, "x " * 7, "b") for i in range(200)] + [(1000 + i, "x " * 5, "c") for i in range(400)]
    rows += [(5000 + i, "x", None) for i in range(50)]
    out = mixed(frame(rows, "doc_id long, text string, source string")).select("source", "mix.*").toPandas()
    total = 100 + 1400 + 2000 + 50
    by = out.groupby(out.source.fillna("-")).agg({"target": "first", "taken": "sum", "source_size": "first"})
    assert by.target["a"] == 300 and by.target["-"] == 150 and by.target.sum() == pytest.approx(total)
    assert by.target["b"] == pytest.approx(2 * by.target["c"])
    assert ((by.taken - by.target).abs() <= 10).all()
    assert set(out[out.source == "b"].copies) <= {1, 2} and set(out[out.source == "c"].copies) <= {0, 1}


def test_mixing_prefers_quality(frame):
    rows = [(i, "one two three", "a") for i in range(2000)] + [(9000 + i, "x " * 9, "b") for i in range(100)]
    df = frame(rows, "doc_id long, text string, source string").withColumn("words", mixing.word_count(F.col("text")))
    out = mixing.mix(df, F.when(F.col("doc_id") % 2 == 0, 2.0).otherwise(0.5), F.col("words"), seed=1)
    drawn = out.filter("source = 'a'").select("doc_id", "mix.copies").toPandas().groupby(lambda i: i).first()
    share = drawn.groupby(drawn.doc_id % 2).copies.mean()
    assert drawn.copies.max() == 1 and share[0] > 0.9 and share[1] < 0.75


def test_token_count_edges(texts, no_texts):
    encoder = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), len(encoder.encode(t or ""))) for i, t, *_ in TEXTS]
    got = rows_of(token_counts.token_counts(texts, PIECES, limit=10))
    assert got == sorted(((*w, w[2] > 10) for w in want), key=lambda r: [(x is not None, x) for x in r])
    assert token_counts.token_counts(no_texts, PIECES).count() == 0


def test_rare_terms_are_joined(frame, monkeypatch):
    """Every term beyond the broadcast table is counted by the join."""
    monkeypatch.setattr(token_counts, "frequent_terms", lambda terms: terms.limit(0))
    encoder = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, f"word{i % 7} shared  text {i}") for i in range(50)]
    got = rows_of(token_counts.token_counts(frame(rows, "doc_id long, text string"), PIECES), "doc_id", "n_tokens")
    assert got == [(i, len(encoder.encode(t))) for i, t in rows]
